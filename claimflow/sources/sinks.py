"""Outputs: JSON records and result envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.operators.projection import quoted
from claimflow.operators.skew import fits_broadcast, numbered

PART_ROWS = 10_000


def json_record(columns: Sequence[str]) -> Column:
    """The columns as one JSON object in which NULL keeps its key."""
    return F.to_json(F.struct(*[quoted(c) for c in columns]), {"ignoreNullFields": "false"})


def to_json_records(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(json_record(columns or df.columns).alias("record"))


def write_json_records(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """One JSON object per line, written in parallel."""
    to_json_records(df, columns).write.mode("overwrite").text(path)


def envelope(df: DataFrame, entity: str, result: Sequence[str], as_list: bool = False) -> DataFrame:
    """(inputDataSource, entityId, predictedResult), one per row.

    ``as_list`` wraps the result into a list of one entry.
    """
    value = F.struct(*[quoted(c) for c in result])
    return df.select(
        F.concat(quoted(entity).cast("string"), F.lit(":0")).alias("inputDataSource"),
        quoted(entity).alias("entityId"),
        (F.array(value) if as_list else value).alias("predictedResult"),
    )


def envelope_batch(
    df: DataFrame,
    batch: str,
    position: str,
    result: Sequence[str],
    part_rows: int = PART_ROWS,
    present: Column | None = None,
) -> DataFrame:
    """Envelopes of batches: ``part`` numbers stretches of ``part_rows`` rows.

    A batch is as long as its data, so one list for all of it would have to fit
    in one task. Rows are numbered over all tasks in the order of their position
    (NULL first, ties by the result columns), and each envelope holds one stretch;
    parts of a batch, read in order, are its whole result. ``present`` tells rows
    from place holders of batches without rows, which have one part with an empty
    list; without it every row counts.
    """
    given = df.select(
        quoted(batch).alias("entityId"),
        quoted(position).alias("_position"),
        F.struct(*[quoted(c) for c in result]).alias("_value"),
        (F.lit(True) if present is None else present).alias("_present"),
    )
    placed = numbered(given, [F.col("entityId"), F.col("_position"), F.col("_value")], "_place")
    starts = placed.groupBy("entityId").agg(F.min("_place").alias("_start")).withColumnRenamed("entityId", "_batch")
    starts = F.broadcast(starts) if fits_broadcast(starts) else starts
    joined = placed.join(starts, placed["entityId"].eqNullSafe(starts["_batch"]))
    part = F.floor((F.col("_place") - F.col("_start")) / F.lit(part_rows)).cast("long").alias("part")
    rows = F.sort_array(F.collect_list(F.when(F.col("_present"), F.struct("_place", "_value"))))
    grouped = joined.groupBy("entityId", part).agg(rows.alias("_rows"))
    return grouped.select(
        F.concat(F.col("entityId").cast("string"), F.lit(":0")).alias("inputDataSource"),
        "entityId",
        "part",
        F.transform("_rows", lambda r: r["_value"]).alias("predictedResult"),
    )


def transaction_envelope(df: DataFrame, position: str, result: Sequence[str], part_rows: int = PART_ROWS) -> DataFrame:
    """The envelope of an annuity batch, which goes under one fixed name."""
    named = df.withColumn("_batch", F.lit(fixed.BATCH_ENTITY))
    parts = envelope_batch(named, "_batch", position, result, part_rows)
    return parts.withColumn("inputDataSource", F.lit(fixed.BATCH_SOURCE))
