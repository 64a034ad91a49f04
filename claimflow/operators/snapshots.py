"""Several snapshots per claim: ranking them and picking the earliest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimflow.operators.projection import quoted
from claimflow.operators.skew import HOT_ROWS, hot_keys, mark_hot, running_totals, salted_join
from claimflow.session import materialise


def approval_rank(
    df: DataFrame, key: str, date: str, hot_rows: int = HOT_ROWS, **bounds: int
) -> DataFrame:
    """Add ``approval_date_rank``: average rank of the date in its claim, cut to int.

    A NULL date has rank -1 and does not move the others. Claims with very many
    snapshots are ranked from counts per date instead of in one window.
    """
    hot = hot_keys(df, key, hot_rows)
    crowds = not hot.isEmpty()
    marked = mark_hot(df, key, hot) if crowds else df
    calm = marked.filter("NOT _busy").drop("_busy") if crowds else df

    in_claim = Window.partitionBy(key).orderBy(F.asc_nulls_last(date))
    ties = Window.partitionBy(key, date)
    average = F.rank().over(in_claim) + (F.count(F.lit(1)).over(ties) - 1) / 2
    rank = F.when(quoted(date).isNull() | quoted(key).isNull(), F.lit(-1)).otherwise(F.floor(average)).cast("int")
    ranked = calm.withColumn("approval_date_rank", rank)
    if not crowds:
        return ranked

    crowded = marked.filter("_busy").drop("_busy").withColumn("_at", F.unix_micros(quoted(date).cast("timestamp")))
    per_date = materialise(
        crowded.filter(F.col("_at").isNotNull()).groupBy(key, "_at").agg(F.count(F.lit(1)).alias("_n"))
    )
    totals = running_totals(per_date, "_at", ["_n"], [key], **bounds)
    table = totals.select(
        key, "_at", F.floor(F.col("_n_before") + (F.col("_n") + 1) / 2).cast("int").alias("_rank")
    )
    joined = salted_join(crowded, table, [key, "_at"], "left", hot=hot)
    far = joined.select(
        *[quoted(c) for c in df.columns],
        F.coalesce(F.col("_rank"), F.lit(-1)).alias("approval_date_rank"),
    )
    return ranked.unionByName(far)


def first_snapshot(
    df: DataFrame, key: str, date: str, columns: Sequence[str], tiebreak: Sequence[str]
) -> DataFrame:
    """The chosen columns of each claim's earliest row; a NULL date comes first.

    An aggregate, not a window: each map task sends one candidate per claim, so
    a claim with any number of snapshots costs no more than another. Rows with
    equal dates are told apart by ``tiebreak``, then by the chosen columns.
    """
    order = F.struct(*[quoted(c) for c in [date, *tiebreak, *columns]])
    best = F.min_by(F.struct(*[quoted(c) for c in columns]), order).alias("_first")
    return df.filter(quoted(key).isNotNull()).groupBy(key).agg(best).select(key, "_first.*")


def attach_snapshot(
    features: DataFrame, snapshot: DataFrame, key: str, hot_rows: int = HOT_ROWS, hot: DataFrame | None = None
) -> DataFrame:
    """Inner join of feature rows with their claim's snapshot row.

    A claim with several feature rows yields several results.
    """
    return salted_join(features, snapshot, [key], "inner", hot_rows, hot=hot)
