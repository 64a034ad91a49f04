"""Scoring claims as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimflow.operators.projection import quoted
from claimflow.session import shared_dir


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet",
    partitions: int | None = None, **options: str,
) -> DataFrame:
    """New files of a folder. ``partitions`` spreads micro-batches that consist of
    fewer files than there are cores; leave it out for sources with many files."""
    stream = spark.readStream.format(form).schema(schema).options(**options).load(path)
    return stream.repartition(partitions) if partitions else stream


def score_stream(
    claims: DataFrame, job: Callable[[DataFrame], DataFrame], out: str, name: str
) -> StreamingQuery:
    """Run a row-wise job on a stream and append its results to parquet files.

    The file sink and the offset log in the shared folder together write every
    claim exactly once, also across restarts and executor losses.
    """
    return (
        job(claims)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", f"{shared_dir(claims.sparkSession)}/streams/{name}")
        .trigger(availableNow=True)
        .start()
    )


def first_snapshot_stream(
    snapshots: DataFrame,
    key: str,
    date: str,
    columns: Sequence[str],
    tiebreak: Sequence[str],
    sink: Callable[[DataFrame, int], None],
    name: str,
    period: str = "7 days",
    delay: str = "1 hour",
) -> StreamingQuery:
    """Hand on each claim's earliest snapshot whenever it is new or has changed.

    Rows are grouped by claim and by the period in which they arrive, so the state
    holds one row per claim seen lately and is dropped once its period has passed.
    A claim that comes back later starts a new state; its rows carry ``ORDER``, by
    which the sink keeps the earliest of all, whatever batch it came in. Arrival is
    the micro-batch's own time, so no row counts as late unless the driver's clock
    goes back by more than ``delay``.
    """
    arrival = snapshots.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", delay)
    best = F.min(snapshot_order(date, columns, tiebreak)).alias(ORDER)
    earliest = (
        arrival.filter(quoted(key).isNotNull())
        .groupBy(quoted(key), F.window("_arrival", period))
        .agg(best)
        .select(quoted(key), *[F.col(ORDER)[f"_{i}"].alias(c) for i, c in enumerate(columns)], ORDER)
    )
    return (
        earliest.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", f"{shared_dir(snapshots.sparkSession)}/streams/{name}")
        .trigger(availableNow=True)
        .start()
    )


#: The column by which two snapshots of a claim are compared.
ORDER = "_order"


def snapshot_order(date: str, columns: Sequence[str], tiebreak: Sequence[str]) -> Column:
    """What orders the snapshots of a claim, with the chosen columns as its last fields."""
    chosen = [quoted(c).alias(f"_{i}") for i, c in enumerate(columns)]
    before = [quoted(c).alias(f"_by{i}") for i, c in enumerate([date, *tiebreak])]
    return F.struct(*before, *chosen)


def _numbered(spark: SparkSession, folder: str) -> dict[int, str]:
    """Complete tables in a folder by the number in their name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return {}
    named = {f.getPath().getName(): f.getPath() for f in fs.listStatus(path)}
    done = {n: p for n, p in named.items() if fs.exists(p.suffix("/_SUCCESS"))}
    return {int(n.partition("=")[2]): str(p) for n, p in done.items()}


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def replace_by_key(table: str, key: str, merge_every: int = 32) -> Callable[[DataFrame, int], None]:
    """A sink that writes each micro-batch under its number and merges them by claim.

    A batch that runs twice overwrites itself. After every ``merge_every`` batches
    they and the last merged table become one table of one row per claim, so what
    ``current_rows`` reads is bounded by the claims there are, not by the batches
    that have run. The tables a merge replaces stay until the next merge, for jobs
    that are still reading them.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batches/number={number}")
        if (number + 1) % merge_every == 0:
            merge_batches(batch.sparkSession, table, key, number)

    return write


def merge_batches(spark: SparkSession, table: str, key: str, number: int) -> None:
    """Write one row per claim of all batches up to ``number``, then drop what an earlier merge replaced.

    A merge that was cut off left no mark of success and is done again. Call it from
    the sink only: one writer at a time.
    """
    merged = _numbered(spark, f"{table}/merged")
    if number in merged:
        return
    _earliest(_logged(spark, table, number), key).write.mode("overwrite").parquet(f"{table}/merged/number={number}")
    last = max(merged, default=-1)
    for n, path in merged.items():
        if n < last:
            _drop(spark, path)
    for n, path in _numbered(spark, f"{table}/batches").items():
        if n <= last:
            _drop(spark, path)


def _logged(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """Rows of the newest merged table and of the batches after it."""
    merged, batches = _numbered(spark, f"{table}/merged"), _numbered(spark, f"{table}/batches")
    last = max(merged, default=-1)
    newer = [p for n, p in batches.items() if n > last and (number is None or n <= number)]
    return spark.read.parquet(*([merged[last]] if merged else []), *newer)


def _earliest(rows: DataFrame, key: str) -> DataFrame:
    kept = [c for c in rows.columns if c not in (key, ORDER)]
    best = F.min_by(F.struct(*[quoted(c) for c in [*kept, ORDER]]), ORDER).alias("_row")
    return rows.groupBy(quoted(key)).agg(best).select(quoted(key), "_row.*")


def current_rows(spark: SparkSession, table: str, key: str) -> DataFrame:
    """The earliest snapshot per key of a table written by ``replace_by_key``."""
    return _earliest(_logged(spark, table), key).drop(ORDER)
