"""Required columns, eligibility, duplicates and renames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.functions.categories import is_in
from claimflow.session import keep_compiled

DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def quoted(name: str) -> Column:
    """A column whose name may hold dots, spaces or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns in that order; a missing one is an error. Wide jobs begin here."""
    keep_compiled(df.sparkSession)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing input columns: {missing}")
    return df.select(*[quoted(c) for c in columns])


def eligible(
    df: DataFrame, status: str, code: str, allowed: Sequence[str], review: str, closed: str
) -> DataFrame:
    """Rows with an allowed status, except those under review that are closed.

    A NULL status is not allowed; a NULL code is not closed.
    """
    shut = F.col(status).eqNullSafe(review) & F.col(code).eqNullSafe(closed)
    return df.filter(is_in(F.col(status), allowed) & ~shut)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Projection without exact duplicates; NULLs count as equal.

    The aggregation keys on every column, so copies collapse on the map side and
    the different rows of one busy claim spread over all tasks.
    """
    return require(df, columns).dropDuplicates()


def drop_dates(df: DataFrame) -> DataFrame:
    """Without the date and timestamp columns."""
    kept = [f.name for f in df.schema.fields if not isinstance(f.dataType, DATE_TYPES)]
    return df.select(*[quoted(c) for c in kept])


def date_named(df: DataFrame) -> list[str]:
    """Columns whose name contains "date", in any letter case."""
    return [c for c in df.columns if "date" in c.lower()]


def with_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in one projection."""
    return df.withColumns(dict(columns))


def payload(df: DataFrame, entity: str, probability: str, value: str) -> DataFrame:
    """Output names of a scored claim."""
    return df.select(
        quoted(entity).alias("claimNumber"),
        quoted(probability).alias("predictedProbability"),
        quoted(value).alias("predictedValue"),
    )
