"""Whitening of embeddings by the covariance of their distinct vectors.

Entries become whole numbers, x = floor(64 * c) + 1000000, so equal vectors are equal
keys. Rows are grouped by x; a distinct vector weighs one, or as much as it has copies.
The mean comes from exact sums. Each task then centres its distinct vectors, first by
the whole part of the mean, which is exact, then by the fraction, and adds weighted
products of matrices; one upper triangle of width * (width + 1) / 2 numbers for each
task is added up over tasks, and one reaches the driver, which takes the eigenvectors.
Each distinct vector is whitened once, and rows are joined back to it.

Groups are counted on the map side, and the join back sends vectors that hold a
thousandth of all rows or more by broadcast (at most a thousand vectors), so a vector
that a third of all rows share never meets in one task.

Defined cases: null vectors and those with null or non-finite entries are left out;
rows without id and repeated rows are kept, each with its own result; an empty table
gives an empty result; a missing entry of a shorter vector counts as 0; 64 * c is held
within +-2^40; a component without variance, as when there is but one distinct vector,
is whitened to null and has no part in the identity error, which is null if there is no
component with variance; ``explained`` is null where no entry varies at all; a deviation
beyond a long is null; signs are set so that the entry of a component that is largest
in size is positive; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import join_counted, usable
from claimflow.session import materialise

COMPONENTS = 16
SCALE, OFFSET, MOST = 64, 1_000_000, 2.0**40
#: Distinct vectors centred and multiplied at a time.
AT_ONCE = 8192


@dataclass
class Whitener:
    """What was fitted: exact sums, eigenvalues (falling) and unit eigenvectors (columns)."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the mean is taken off before anything is rounded."""
        whole = np.array([s // self.n for s in self.sums], "i8")
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype("f8") - rest

    def live(self) -> np.ndarray:
        """Which components have variance beyond rounding."""
        least = self.values.max(initial=0) * len(self.sums) * 8 * np.finfo("f8").eps
        return self.values > least

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One row for each row of x; NaN for components without variance."""
        scale = np.sqrt(np.where(self.live(), self.values, np.nan))
        return self.centred(x) @ self.vectors / scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - S)^2, exact."""
        low, high = x.min(axis=0).tolist(), x.max(axis=0).tolist()
        most = max((max(abs(self.n * a - s), abs(self.n * b - s)) for a, b, s in zip(low, high, self.sums, strict=True)), default=0)
        if most * most * max(1, len(self.sums)) < 2**63:
            return ((self.n * x - np.array(self.sums, "i8")) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [d if d < 2**63 else None for d in exact]


def whole_rows(vectors: DataFrame) -> tuple[DataFrame, int]:
    """A written table of vec_id, x and a hash of x, and the width of all x."""
    kept = vectors.select("vec_id", "embedding").filter(usable(F.col("embedding")))
    scaled = F.transform(
        "embedding", lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(MOST)), F.lit(-MOST))) + F.lit(OFFSET).cast("long")
    )
    rows = materialise(kept.select("vec_id", scaled.alias("x")))
    least, width = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != width:
        missing = F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x"))
        rows = rows.withColumn("x", F.concat("x", missing))
    return rows.withColumn("h", F.xxhash64("x")), width or 0


def _matrices(batches: Iterator[pa.RecordBatch], column: str, width: int, kind: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(part.num_rows, width)


def _exact_sums(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (width + 1)
        for part, x in _matrices(batches, "x", width, "i8"):
            w = part.column("weight").to_numpy()
            # both factors in one product of doubles would round; halves of x do not
            high, low = x >> 20, x & 0xFFFFF
            for d, (a, b) in enumerate(zip((w @ high).tolist(), (w @ low).tolist(), strict=True)):
                totals[d] += (a << 20) + b
            totals[width] += int(w.sum())
        rows = [pa.array(range(width + 1), pa.int32()), pa.array([str(t) for t in totals])]
        yield pa.RecordBatch.from_arrays(rows, ["place", "total"])

    return run


def _products(width: int, column: str, kind: str, centre: Callable[[np.ndarray], np.ndarray]):
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for part, x in _matrices(batches, column, width, kind):
            y = centre(x)
            total += (y * part.column("weight").to_numpy()[:, None]).T @ y
        columns = [pa.array(upper[0].astype("i4")), pa.array(upper[1].astype("i4")), pa.array(total[upper])]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "s"])

    return run


def centred_products(table: DataFrame, column: str, kind: str, width: int, centre: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over rows of weight times the outer product of the centred vector with itself."""
    parts = table.select(column, "weight").mapInArrow(_products(width, column, kind, centre), "i int, j int, s double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"]
    return out


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitener:
    """Eigenvectors of the covariance of distinct vectors: columns x and weight."""
    parts = distinct.select("x", "weight").mapInArrow(_exact_sums(width), "place int, total string")
    rows = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {r["place"]: int(r["total"]) for r in rows}
    n = total.get(width, 0)
    model = Whitener(n, [total.get(d, 0) for d in range(width)], 0.0, np.zeros(0), np.zeros((width, 0)))
    if not n:
        return model
    covariance = centred_products(distinct, "x", "i8", width, model.centred) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = np.maximum(values[::-1][:components], 0), vectors[:, ::-1][:, :components]
    largest = np.abs(vectors).argmax(axis=0)
    model.trace, model.values = float(np.trace(covariance)), values
    model.vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    return model


def _whiten(model: Whitener, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, "x", width, "i8"):
            white = model.whitened(x)
            lists = pa.array(white.tolist(), pa.list_(pa.float64()))
            columns = [*[part.column(c) for c in ("h", "x", "weight", "copies")], pa.array(model.deviations(x), pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["h", "x", "weight", "copies", "deviation", "whitened"])

    return run


def identity_error(white: DataFrame, model: Whitener) -> float | None:
    """The largest absolute entry of the covariance of whitened vectors minus the identity."""
    live = model.live()
    k = len(live)
    if not live.any():
        return None
    means = [F.sum(F.col("weight") * F.col("whitened")[i]).alias(f"m{i}") for i in range(k)]
    mean = np.array(white.agg(*means).first(), "f8") / model.n
    covariance = centred_products(white, "whitened", "f8", k, lambda z: z - mean) / model.n
    return float(np.abs(covariance - np.eye(k))[np.ix_(live, live)].max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, by_copies: bool = False) -> DataFrame:
    """Rows of vec_id and component with n, deviation, whitened, explained and identity_error.

    Distinct vectors weigh one in the fit, or their number of copies if ``by_copies``.
    """
    rows, width = whole_rows(vectors)
    counted = rows.groupBy("h", "x").agg(F.count(F.lit(1)).alias("copies"))
    distinct = materialise(counted.withColumn("weight", F.col("copies") if by_copies else F.lit(1).cast("long")))
    model = fit(distinct, width, components)
    shape = "h long, x array<long>, weight long, copies long, deviation long, whitened array<double>"
    white = materialise(distinct.select("h", "x", "weight", "copies").mapInArrow(_whiten(model, width), shape))
    error = identity_error(white, model)
    joined = join_counted(rows, white.select("h", "x", "copies", "deviation", "whitened"), ["h", "x"], "copies")
    explained = [v / model.trace if model.trace else None for v in model.values.tolist()]
    share = F.array(*[F.lit(e).cast("double") for e in explained]) if explained else F.lit(None).cast("array<double>")
    each = joined.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "_value"))
    return each.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.nanvl("_value", F.lit(None).cast("double")).alias("whitened"),
        F.get(share, F.col("_at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
