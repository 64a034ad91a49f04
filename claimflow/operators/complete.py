"""Marking rows that lack a required value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.operators.projection import quoted


def incomplete(columns: Sequence[str]) -> Column:
    """Y if any of the columns is NULL, else N."""
    lacking = reduce(lambda a, b: a | b, [quoted(c).isNull() for c in columns])
    return F.when(lacking, F.lit("Y")).otherwise(F.lit("N"))


def flag_incomplete(df: DataFrame, columns: Sequence[str], name: str = "NA_row") -> DataFrame:
    return df.withColumn(name, incomplete(columns))


def unreadable(df: DataFrame, entity: str, readers: Mapping[str, Column]) -> DataFrame:
    """(entity, rejects) of rows in which a reader made NULL of text that is not blank."""
    bad = [
        F.when(
            value.isNull() & (F.trim(quoted(c).cast("string")) != ""),
            F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")),
        )
        for c, value in readers.items()
    ]
    listed = df.select(quoted(entity), F.array_compact(F.array(*bad)).alias("rejects"))
    return listed.filter(F.size("rejects") > 0)
