"""What several operators of this package share."""

from __future__ import annotations

import string
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.session import materialise

#: A word of white-space separated text.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
#: A word made of ASCII letters and digits and of anything outside ASCII. In Java these
#: two classes are matched about seven times faster than the same as a list of ranges.
PLAIN_WORD = r"[\p{Alnum}\P{ASCII}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; rows without id fall in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def fold_of(doc_id: int | None, folds: int) -> int:
    """``fold`` of one id, in plain Python."""
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def rounded_up_prime(n: int) -> int:
    """The smallest prime that is at least ``n``."""
    n = max(2, n)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def unused(name: str, df: DataFrame) -> str:
    """The name, or one like it that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


#: Rows and bytes of a table that may be copied to every executor.
BROADCAST_ROWS = 2_000_000


def broadcast_if_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of a few numbers per row, marked for broadcast if it has few rows.

    The table is counted first; beyond the limit it is left as it is, for a shuffled
    join. Two million rows of two longs are 32 MB.
    """
    table = materialise(table)
    return F.broadcast(table) if table.count() <= rows else table


def usable(embedding: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & finite


#: A key counts as hot from one row in so many on, so there are at most so many hot keys.
HOT_KEYS = 1000


def join_counted(rows: DataFrame, table: DataFrame, on: list[str], copies: str, how: str = "inner") -> DataFrame:
    """Join rows to a written table of one row per key in which ``copies`` counts the rows of the key.

    Keys that hold a thousandth of all rows or more are broadcast, at most a thousand of
    them; the rows of other keys are shuffled. ``how`` is inner or left.
    """
    n = rows.count()
    hot = table.filter(F.col(copies) * HOT_KEYS >= n)
    if hot.isEmpty():
        return rows.join(table, on, how)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    cold = rest.join(table.filter(F.col(copies) * HOT_KEYS < n), on, how)
    return rows.join(F.broadcast(hot), on).unionByName(cold)
