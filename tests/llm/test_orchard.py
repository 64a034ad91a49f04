"""Clusters by Orchard's search."""

import hashlib
import math
import random

import numpy as np
import pytest

from claimflow.llm import orchard

SHAPE = "vec_id long, embedding array<float>, cluster string, distance string, x int, inertia double"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1, 2.0) for r in rows], SHAPE)


def brute(rows, k, rounds, width):
    """The same in plain Python numbers."""
    most = math.isqrt(2**58 // width)
    kept = []
    for i, v in rows:
        if v is None or len(v) != width or any(c is None or not math.isfinite(c) for c in v):
            continue
        kept.append((i, [int(max(-most, min(most, math.floor(float(np.float32(c)) * 256)))) for c in v]))
    drawn = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in drawn[:k]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(centroids))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), f in zip(kept, found, strict=True) if f == c]
            if own:
                centroids[c] = [sum(d) // len(own) for d in zip(*own, strict=True)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = {c: sum(d for _, d, x in last if x == c) for _, _, c in last}
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in centroids]
    most = 2**63 - 1
    return [(i, c, d, min(most, inertia[c]), min(most, sum(inertia.values())), digest[c]) for i, d, c in last]


def key(row):
    return [(v is None, str(v)) for v in row]


@pytest.mark.parametrize("scale", [1.0, 0.01, 1e9])
def test_like_brute_force(spark, scale):
    rng = random.Random(int(scale * 100))
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(150)]  # one vector holds over half of all rows
    rows += [rows[5], rows[5], (None, rows[7][1]), (None, rows[8][1])]
    rows += [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [1.0] * 5)]
    found = orchard.clusters(table(spark, rows).repartition(7), 9, 3, 6)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(rows, 9, 3, 6), key=key)


def test_few_or_no_rows(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 5.0])]
    assert sorted(map(tuple, orchard.clusters(table(spark, rows), 40, 5, 2).collect())) == sorted(brute(rows, 40, 5, 2))
    assert orchard.clusters(table(spark, []), 40, 5, 2).count() == 0
    assert orchard.clusters(table(spark, [(None, [1.0, 2.0])]), 40, 5, 2).count() == 0
    wide = spark.createDataFrame([("a", [0.5, 1.0]), ("b", None)], "vec_id string, embedding array<double>")
    assert [r["vec_id"] for r in orchard.clusters(wide, width=2).collect()] == ["a"]


def test_search_is_exact_and_looks_at_few():
    rng = np.random.default_rng(1)
    centres = rng.integers(-10_000, 10_000, (60, 3))
    vectors = centres[rng.integers(0, 60, 5000)] + rng.integers(-300, 300, (5000, 3))
    centres[10] = centres[11]  # equal centroids: the smaller number wins
    at, distance, looks = orchard.Orchard(centres).nearest(vectors)
    every = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (at == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert looks < 0.25 * every.size


def test_ties_at_exactly_twice_the_distance():
    # the vector lies halfway between 0 and 1, whose distance is exactly twice its own
    centres = np.array([[4, 0], [0, 0], [100, 0]])
    at, distance, _ = orchard.Orchard(centres).nearest(np.array([[2, 0], [50, 0], [52, 0]]))
    assert at.tolist() == [0, 0, 0] and distance.tolist() == [4, 46**2, 48**2]
