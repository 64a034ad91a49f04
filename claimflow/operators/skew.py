"""Joins and running totals that stay balanced when one key holds most rows.

Row-wise jobs need none of this. It serves the few places where rows of one key
have to meet: joins on a claim, a term or a category, and ordered totals.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.session import materialise

HOT_ROWS = 1_000_000
SALTS = 64
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
CELL_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, rows: int = HOT_ROWS) -> DataFrame:
    """All keys with more than ``rows`` rows, as a written table of one column.

    One aggregation with map-side combine; there are at most rows of ``df`` divided
    by ``rows`` of them. A NULL row stands for rows without a key.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows)
    return materialise(counted.select(F.col(f"`{key}`").alias("hot_key")))


def mark_hot(df: DataFrame, key: str, hot: DataFrame, name: str = "_busy") -> DataFrame:
    """Add whether a row's key is one of the hot keys, none included."""
    found = hot.select("hot_key", F.lit(True).alias(name))
    found = F.broadcast(found) if hot.count() <= BROADCAST_ROWS else found
    joined = df.join(found, df[f"`{key}`"].eqNullSafe(F.col("hot_key")), "left")
    return joined.select(*[df[f"`{c}`"] for c in df.columns], F.coalesce(name, F.lit(False)).alias(name))


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table was measured to be small enough to copy to every executor.

    One distributed aggregation counts its rows and the bytes of their values.
    """
    values = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(values), F.lit(0)).alias("size")).first()
    return found["n"] <= rows and found["size"] <= size


def _salted(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, hot: DataFrame, salts: int):
    # The salt depends on the row's content alone, so a task that runs again
    # after an executor loss gives every row the same salt as before.
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    left = mark_hot(left, on[0], hot).withColumn("_salt", F.when(F.col("_busy"), spread).otherwise(F.lit(0))).drop("_busy")
    copies = F.when(F.col("_busy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = mark_hot(right, on[0], hot).withColumn("_salt", F.explode(copies)).drop("_busy")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which the left rows of a hot key are spread over many tasks.

    The few right rows of such a key are copied once per salt; all other keys
    take the ordinary join. Only ``inner`` and ``left`` joins are meaningful.
    ``hot`` names the hot keys if the caller has counted them already.
    """
    hot = hot_keys(left, on[0], hot_rows) if hot is None else hot
    if hot.isEmpty():
        return left.join(right, list(on), how)
    return _salted(left, right, list(on), how, hot, salts)


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join to a lookup table: broadcast if measured small, else a salted join."""
    if fits_broadcast(table, broadcast_rows):
        return left.join(F.broadcast(table), list(on), how)
    return salted_join(left, table, on, how, hot_rows)


def cell_edges(df: DataFrame, order: str, cells: int) -> list[float]:
    """Increasing edges that cut the order column into cells of similar size."""
    probabilities = [i / cells for i in range(1, cells)]
    found = df.approxQuantile(order, probabilities, 0.25 / cells) if probabilities else []
    return [float("-inf"), *sorted(set(found)), float("inf")]


def into_cells(df: DataFrame, order: str, edges: list[float], name: str = "_cell") -> DataFrame:
    """Number of the cell each order value falls in (binary search in the JVM)."""
    if len(edges) < 3:
        return df.withColumn(name, F.lit(0.0))
    return Bucketizer(splits=edges, inputCol=order, outputCol=name, handleInvalid="keep").transform(df)


def running_totals(
    df: DataFrame,
    order: str,
    measures: Sequence[str],
    group: Sequence[str] = (),
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Add ``<measure>_before``: its total over rows of the group with a smaller order.

    ``df`` must hold one row per (group, order), already aggregated, and ``order``
    must be a non-null number of any type; its own type orders the rows. The order
    axis is cut into cells of about ``cell_rows`` rows: totals run first over the
    cells of a group and then inside a cell, so neither a global order nor one huge
    group ends up in one task.
    """
    group = list(group)

    def before(partition: Sequence[str], by: str):
        w = Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))
        return w.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)

    def total(m: str, w) -> Column:
        return F.coalesce(F.sum(m).over(w), F.lit(0))

    # a double never changes the order of two numbers, at most it makes them equal,
    # and then they share a cell
    placed = df.withColumn("_place", F.col(order).cast("double"))
    cells = math.ceil(df.count() / cell_rows)
    celled = into_cells(placed, "_place", cell_edges(placed, "_place", cells)).drop("_place")
    sums = celled.groupBy(*group, "_cell").agg(*[F.sum(m).alias(m) for m in measures])
    across = before(group, "_cell")
    offsets = sums.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_cell").alias("_gcell"),
        *[total(m, across).alias(f"_offset_{m}") for m in measures],
    )
    inside = before([*group, "_cell"], order)
    within = celled.select("*", *[total(m, inside).alias(f"{m}_before") for m in measures])
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    matched = reduce(lambda a, b: a & b, same, F.col("_cell") == F.col("_gcell"))
    joined = within.join(offsets, matched, "inner")
    return joined.select(
        *df.columns,
        *[(F.col(f"{m}_before") + F.col(f"_offset_{m}")).alias(f"{m}_before") for m in measures],
    )


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """A written table of all rows with their place in the given order, from 0.

    Rows are sorted by range over all tasks; one count for each range reaches the
    driver and gives the place at which it starts. Rows are written first, and their
    number in that table is the last thing they are sorted by. So no two rows are
    equal to the sort, and however many share one value, or have none, the sampled
    range borders cut through them; a task that runs again finds the same numbers.
    """
    given = materialise(df).withColumn("_tie", F.monotonically_increasing_id())
    sorted_ = given.orderBy(*order, "_tie").drop("_tie").withColumn("_id", F.monotonically_increasing_id())
    written = materialise(sorted_)
    part, inside = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["p"]: r["count"] for r in written.groupBy(part.alias("p")).count().collect()}
    starts, before = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(p, 0)
    place = F.get(F.from_json(F.lit(json.dumps(starts)), "array<bigint>"), part.cast("int")) + inside
    return written.withColumn(name, place).drop("_id")
