"""Clusters around centroids, with every search for the nearest one by Orchard's method.

Components become whole numbers, floor(256 * x), so sums, distances and means are
exact and reruns agree. Every centroid has a list of the others by growing distance.
A search starts at some centroid and walks its list; as soon as a centroid nearer to
the vector turns up, it goes on in that one's list from the start. Centroids looked at
are marked and not looked at again. It stops where the list goes strictly beyond twice
the distance to the present centroid: by the triangle inequality nothing behind that
place is as near. All vectors of a batch take their steps together.

Vectors stay where they are: a round broadcasts the centroids and their lists (k * k
numbers, k being a parameter) and gives back one total for each centroid, dimension
and task, which are added up on the map side and then over tasks; k * (width + 1) sums
reach the driver. How many vectors share a cluster, or are equal, does not matter.

Defined cases: vectors that are null, of another width, or hold null or non-finite
components are left out; rows without id are clustered but never start a centroid;
repeated ids are separate rows; with fewer rows than k there are as many centroids as
rows with an id, and without any the result is empty; equal hashes start in the order
of their components; ties go to the smaller number, also between equal centroids;
components are held within +-sqrt(2^58 / width), beyond which distances would leave a
long; sums of distances beyond a long are given as the largest long; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import usable
from claimflow.session import materialise

CENTROIDS, ROUNDS, WIDTH, SCALE = 40, 5, 64, 256
SEED = "2:"
#: Vectors that walk together.
AT_ONCE = 4096
MOST = 2**63 - 1

TOTALS = "cluster int, place int, total long"


def whole_vectors(vectors: DataFrame, width: int = WIDTH) -> DataFrame:
    """A written table of vec_id and x, the components as whole numbers."""
    most = float(math.isqrt(2**58 // width))
    kept = vectors.select("vec_id", "embedding").filter(usable(F.col("embedding")) & (F.size("embedding") == width))
    whole = F.transform(
        "embedding", lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(most)), F.lit(-most))).cast("int")
    )
    return materialise(kept.select("vec_id", whole.alias("x")))


def first_centroids(whole: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> np.ndarray:
    """The k vectors with the smallest hashes of seed and id."""
    drawn = whole.filter(F.col("vec_id").isNotNull())
    hashed = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = drawn.select(hashed.alias("hash"), "x").orderBy("hash", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], "i8")


class Orchard:
    """Centroids with their neighbour lists."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        far = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
        far[np.arange(k), np.arange(k)] = -1  # a centroid comes first in its own list
        self.lists = np.argsort(far, axis=1, kind="stable")[:, 1:]
        self.far = np.take_along_axis(far, self.lists, axis=1)
        # walks start at the centroid next in the dimension in which they differ most
        self.axis = int(centroids.astype("f8").var(axis=0).argmax())
        self.along = np.argsort(centroids[:, self.axis], kind="stable")

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each vector its centroid and squared distance; and how many distances were computed."""
        n, k = len(vectors), len(self.centroids)
        spot = np.searchsorted(self.centroids[self.along, self.axis], vectors[:, self.axis])
        at = self.along[np.minimum(spot, k - 1)]
        distance = ((vectors - self.centroids[at]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), bool)
        seen[np.arange(n), at] = True
        place, walking, looks = np.zeros(n, int), np.arange(n), n
        while True:
            walking = walking[place[walking] < k - 1]
            near = self.far[at[walking], place[walking]] <= 4 * distance[walking]
            walking = walking[near]
            if not len(walking):
                return at, distance, looks
            other = self.lists[at[walking], place[walking]]
            place[walking] += 1
            fresh = ~seen[walking, other]
            rows, other = walking[fresh], other[fresh]
            seen[rows, other] = True
            found = ((vectors[rows] - self.centroids[other]) ** 2).sum(axis=1)
            looks += len(rows)
            nearer = (found < distance[rows]) | ((found == distance[rows]) & (other < at[rows]))
            rows = rows[nearer]
            at[rows], distance[rows], place[rows] = other[nearer], found[nearer], 0


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches of a batch as matrices, with the row each starts at."""
    column = batch.column("x")
    for at in range(0, len(column), AT_ONCE):
        part = column.slice(at, AT_ONCE)
        yield at, part.flatten().to_numpy().astype("i8").reshape(len(part), -1)


def _totals(orchard: Orchard):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = orchard.centroids.shape
        totals = np.zeros((k, width + 1), "i8")
        for batch in batches:
            for _, vectors in _vectors(batch):
                cluster, _, _ = orchard.nearest(vectors)
                ones = np.column_stack([vectors, np.ones(len(vectors), "i8")])
                np.add.at(totals, cluster, ones)
        used = np.flatnonzero(totals[:, width])
        rows, places = np.repeat(used, width + 1), np.tile(np.arange(width + 1), len(used))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype("i4")), pa.array(places.astype("i4")), pa.array(totals[rows, places])], ["cluster", "place", "total"]
        )

    return run


def next_centroids(whole: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of the mean of each centroid's vectors; a centroid without any stays."""
    k, width = centroids.shape
    parts = whole.select("x").mapInArrow(_totals(Orchard(centroids)), TOTALS)
    sums = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {(r["cluster"], r["place"]): int(r["total"]) for r in sums}
    moved = [
        [total[c, d] // total[c, width] if (c, width) in total else int(centroids[c, d]) for d in range(width)] for c in range(k)
    ]
    return np.array(moved, "i8")


def fit(whole: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> np.ndarray:
    """Centroids after so many rounds of assignment and means."""
    centroids = first_centroids(whole, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(whole, centroids)
    return centroids


def assign(whole: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    ids = whole.schema["vec_id"].dataType.simpleString()
    shape = f"vec_id {ids}, cluster int, distance long"
    if not len(centroids):
        return whole.sparkSession.createDataFrame([], shape)
    orchard = Orchard(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in _vectors(batch):
                cluster, distance, _ = orchard.nearest(vectors)
                own = batch.column("vec_id").slice(at, len(vectors))
                yield pa.RecordBatch.from_arrays([own, pa.array(cluster.astype("i4")), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return whole.mapInArrow(run, shape)


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, seed: str = SEED) -> DataFrame:
    """Every vector's cluster and distance, with the sums of distances and the hash of the centroid."""
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, width)
    centroids = fit(whole, k, rounds, seed)
    assigned = materialise(assign(whole, centroids))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = {r["cluster"]: int(r["d"]) for r in sums}
    everything = min(sum(inertia.values()), MOST)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, min(d, MOST), everything, digest[c]) for c, d in inertia.items()]
    shape = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # one row for each of the k centroids
    return assigned.join(F.broadcast(spark.createDataFrame(rows, shape)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
