"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table,
``(offset + i * skip) mod size``. Shards take turns; each claims the next slot on
its list that is still free, until the table is full. A row's key is hashed to a
slot, and the broadcast table gives its shard in constant time. Shares are even to
a slot per turn, and taking a shard away moves little else than its own rows.

The table depends on the shards' names and weights alone, never on the data, and
has the size asked for; that is the proof of its bound when it is broadcast. Rows
are placed one by one, without a shuffle, so a hot source, key or group of copies
needs no care: keys of rows decide, not their content.

Defined cases: a null key, or null among several key columns, hashes like an empty
text; equal keys share a shard; an empty table gives an empty result; columns of
the input named ``slot`` or ``shard`` are replaced, all others are kept.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.common import rounded_up_prime

#: Slots for each shard, so that shares differ by less than a hundredth.
SLOTS_PER_SHARD = 128


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: Sequence[str], size: int, weights: Sequence[float] | None = None) -> list[int]:
    """For every slot the position of the shard that claimed it.

    A shard with half the largest weight claims at every second turn. ``size`` must
    be a prime, so that every skip visits every slot.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be named, each once")
    if size != rounded_up_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime, not below the number of shards")
    weights = list(weights) if weights else [1.0] * len(shards)
    if len(weights) != len(shards) or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    at = [_number(f"{s}#offset") % size for s in shards]
    skip = [_number(f"{s}#skip") % (size - 1) + 1 for s in shards]
    credit, step = [0.0] * len(shards), [w / max(weights) for w in weights]
    table, free = [-1] * size, size
    while free:
        for i in range(len(shards)):
            credit[i] += step[i]
            if credit[i] < 1 or not free:
                continue
            credit[i] -= 1
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            free -= 1
    return table


def lookup_table(
    spark: SparkSession, shards: Sequence[str], size: int | None = None, weights: Sequence[float] | None = None
) -> DataFrame:
    """The filled table as rows (slot, shard)."""
    size = size or rounded_up_prime(SLOTS_PER_SHARD * len(shards))
    names = [shards[i] for i in fill(shards, size, weights)]
    listed = F.from_json(F.lit(json.dumps(names)), "array<string>")
    return spark.range(1).select(F.posexplode(listed).alias("slot", "shard"))


def slot_of(keys: Sequence[Column], size: int) -> Column:
    """The slot that key columns hash to."""
    text = F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(
    df: DataFrame,
    keys: Sequence[str],
    shards: Sequence[str],
    size: int | None = None,
    weights: Sequence[float] | None = None,
) -> DataFrame:
    """All rows with their ``slot`` and ``shard``."""
    size = size or rounded_up_prime(SLOTS_PER_SHARD * len(shards))
    table = lookup_table(df.sparkSession, shards, size, weights)
    kept = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    slotted = df.select(*[F.col(f"`{c}`") for c in kept], slot_of([F.col(f"`{k}`") for k in keys], size).alias("slot"))
    return slotted.join(F.broadcast(table), "slot").select(*[F.col(f"`{c}`") for c in kept], "slot", "shard")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder for every shard; tasks write their own files, nothing is gathered."""
    placed.write.partitionBy("shard").mode("error").parquet(path)
