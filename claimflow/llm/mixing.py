"""Mixing sources to target weights, in blocks of tokens drawn per output shard.

The words of a source, in a pseudorandom order of its documents, are packed into
blocks of a fixed number of words. Output shards of a fixed number of slots draw
multinomial counts of the sources; a source's slots are numbered through all shards
and mapped through pseudorandom permutations of its block indices, one permutation
for each pass over the source, and the blocks are joined by source and index.

A source's quota is exact: draws beyond it go to the sources that drew too few, and
its last slot is cut to the words still missing. So no block is used more often than
the limit of passes, and rerunning gives the same mix.

Only one row for each source reaches the driver. Word offsets inside a source are
running sums in two levels, over about sqrt(rows) cells and inside each cell, so a
source that holds a third of all rows is many tasks; block numbers spread a source
over the join in the same way.

Defined cases: a null text has no words and is never taken; a null source is a source
of its own, last in order; documents without words, and sources without, have target
and take 0; repeated rows are separate documents; an empty table gives an empty
result; other columns are kept only by ``mixed_documents``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.llm.common import SPACED_WORD
from claimflow.session import materialise

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
PASSES = 2
BLOCK_WORDS = 128
SLOTS_PER_SHARD = 512
#: Shards whose slots are numbered in one go, and slots unfolded by one task.
SHARDS_PER_CELL = 4096
SLOTS_PER_TASK = 100_000
SEED = "mix-1"


@dataclass(frozen=True)
class Plan:
    """What the mix takes from one source; ``quota`` counts slots."""

    source: str | None
    size: int
    target: float
    blocks: int
    quota: int
    last_cut: int  # words left out at the end of the last slot


# --- targets ---------------------------------------------------------------


def targets(sizes: Sequence[float], weights: Sequence[float], share: float = SHARE, limit: float = PASSES) -> list[float]:
    """Words to take from each source.

    Sources share ``share`` of all words by weight; whoever would exceed ``limit``
    times its size stops there, and the rest is shared again among the others.
    """
    left, given = share * sum(sizes), [0.0] * len(sizes)
    open_ = [i for i in range(len(sizes)) if sizes[i] > 0]
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > limit * sizes[i]]
        if not full:
            for i in open_:
                given[i] = left * weights[i] / total
            break
        for i in full:
            given[i] = float(limit * sizes[i])
        left -= sum(given[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return given


# --- pseudorandom permutations ---------------------------------------------


def _keys(*name: object) -> np.ndarray:
    digest = hashlib.sha256("\x1f".join(map(str, name)).encode()).digest()
    return np.frombuffer(digest, "<u8")


def _round(half: np.ndarray, key: np.uint64, bits: np.uint64) -> np.ndarray:
    mixed = (half + key) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(33)) & ((np.uint64(1) << bits) - np.uint64(1))


def permuted(index: np.ndarray, n: int, *name: object) -> np.ndarray:
    """The image of indices below ``n`` under the permutation of that name.

    A four-round Feistel network over the next even number of bits, walked until
    the value lies below n again.
    """
    bits = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    keys = _keys(*name)
    out = index.astype("u8")
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & ((np.uint64(1) << bits) - np.uint64(1))
        for key in keys:
            left, right = right, left ^ _round(right, key, bits)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= n]
    return out.astype("i8")


def position_of(value: int, n: int, *name: object) -> int:
    """The index that ``permuted`` maps to ``value``."""
    bits = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    keys = _keys(*name)
    out = np.array([value], "u8")
    while True:
        left, right = out >> bits, out & ((np.uint64(1) << bits) - np.uint64(1))
        for key in keys[::-1]:
            left, right = right ^ _round(left, key, bits), left
        out = (left << bits) | right
        if out[0] < n:
            return int(out[0])


def quota(size: int, target: float, block_words: int, source: str | None, passes: int = PASSES) -> tuple[int, int, int]:
    """Blocks of a source, slots it fills, and words left out at the end of the last."""
    blocks = -(-size // block_words)
    wanted = min(round(target), passes * size)
    if not wanted:
        return blocks, 0, 0
    full, m = divmod(wanted, size)
    last_words = size - (blocks - 1) * block_words
    slots, rest = full * blocks, wanted - full * size
    if not rest:
        return blocks, slots, 0
    short_at = position_of(blocks - 1, blocks, SEED, source, full)
    m = -(-rest // block_words)
    words = lambda m: m * block_words - (block_words - last_words) * (short_at < m)
    while words(m) < rest:
        m += 1
    return blocks, slots + m, words(m) - rest


# --- documents as spans of blocks ------------------------------------------


def word_count(text: Column) -> Column:
    """Words in a text, none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and a hash of the text, for every document."""
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")
    )


def with_offsets(sizes: DataFrame, rows: int) -> DataFrame:
    """Add each document's first word in its source's stream of words."""
    cells = max(1, math.isqrt(rows))
    order = F.xxhash64(F.lit(SEED), "doc_id", "source", "text_hash")
    celled = sizes.withColumn("_order", order).withColumn("_cell", F.pmod("_order", F.lit(cells)))
    inside = Window.partitionBy("source", "_cell").orderBy("_order", "doc_id", "size", "text_hash")
    across = Window.partitionBy("source").orderBy("_cell")
    before = celled.groupBy("source", "_cell").agg(F.sum("size").alias("_words"))
    starts = before.select(
        F.col("source").alias("_source"),
        F.col("_cell").alias("_at"),
        (F.sum("_words").over(across) - F.col("_words")).alias("_start"),
    )
    inner = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = celled.withColumn("_inner", inner)
    same = placed["source"].eqNullSafe(starts["_source"]) & (placed["_cell"] == starts["_at"])
    return placed.join(starts, same).select(*sizes.columns, (F.col("_inner") + F.col("_start")).alias("offset"))


def fragments(offsets: DataFrame, block_words: int) -> DataFrame:
    """The piece of each block that a document holds: block, from, to (words of the block)."""
    held = offsets.filter(F.col("size") > 0)
    first = F.floor(F.col("offset") / block_words)
    last = F.floor((F.col("offset") + F.col("size") - 1) / block_words)
    spread = held.withColumn("block", F.explode(F.sequence(first, last)))
    at = F.col("block") * block_words
    return spread.withColumn("from", F.greatest(F.col("offset") - at, F.lit(0))).withColumn(
        "to", F.least(F.col("offset") + F.col("size") - at, F.lit(block_words))
    )


# --- slots of the output ----------------------------------------------------


def _drawn(shares: list[float], slots: int, per_shard: int):
    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            shards = frame["id"].to_numpy()
            counts = [
                np.random.Generator(np.random.Philox(key=_keys(SEED, "draw", int(s))[:2])).multinomial(
                    min(per_shard, slots - int(s) * per_shard), shares
                )
                for s in shards
            ]
            counts = np.array(counts).reshape(len(shards), len(shares))
            at, source = np.nonzero(counts)
            yield pd.DataFrame({"shard": shards[at], "source_no": source, "count": counts[at, source]})

    return draw


def _mapped(plans: list[Plan], drawn: list[int], block_words: int):
    over = [max(0, d - p.quota) for p, d in zip(plans, drawn, strict=True)]
    lack = [max(0, p.quota - d) for p, d in zip(plans, drawn, strict=True)]
    over_start, lack_end = np.concatenate([[0], np.cumsum(over)]), np.cumsum(lack)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        quotas, blocks = np.array([p.quota for p in plans]), np.array([p.blocks for p in plans])
        for frame in batches:
            for part in np.array_split(np.arange(len(frame)), max(1, len(frame) // 256)):
                rows = frame.iloc[part]
                n = rows["count"].to_numpy()
                source = np.repeat(rows["source_no"].to_numpy(), n)
                shard = np.repeat(rows["shard"].to_numpy(), n)
                step = np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
                slot = np.repeat(rows["first"].to_numpy(), n) + step
                extra = np.flatnonzero(slot >= quotas[source])
                if len(extra):
                    rank = over_start[source[extra]] + slot[extra] - quotas[source[extra]]
                    to = np.searchsorted(lack_end, rank, side="right")
                    slot[extra] = np.array(drawn)[to] + rank - (lack_end - lack)[to]
                    source[extra] = to
                block, words = np.empty(len(slot), "i8"), np.full(len(slot), block_words)
                for s in np.unique(source):
                    plan, mine = plans[s], np.flatnonzero(source == s)
                    run = slot[mine] // plan.blocks
                    for r in np.unique(run):
                        at = mine[run == r]
                        block[at] = permuted(slot[at] % plan.blocks, plan.blocks, SEED, plan.source, int(r))
                    last = mine[slot[mine] == plan.quota - 1]
                    if plan.last_cut:
                        whole = np.where(block[last] == plan.blocks - 1, plan.size - (plan.blocks - 1) * block_words, block_words)
                        words[last] = whole - plan.last_cut
                yield pd.DataFrame(
                    {"shard": shard, "source_no": source, "slot": slot, "pass": slot // blocks[source], "block": block, "words": words}
                )

    return place


def slots(spark: SparkSession, plans: list[Plan], block_words: int, per_shard: int) -> DataFrame:
    """All slots: shard, source_no, slot (in the source), pass, block, words taken."""
    total = sum(p.quota for p in plans)
    shares = [p.quota / total for p in plans] if total else []
    shape = "shard long, source_no int, count long"
    shards = spark.range(-(-total // per_shard))
    drawn = materialise(shards.mapInPandas(_drawn(shares, total, per_shard), shape))
    got = {r["source_no"]: r["n"] for r in drawn.groupBy("source_no").agg(F.sum("count").alias("n")).collect()}
    # numbers run over cells of shards, and then inside a cell
    cell = F.floor(F.col("shard") / SHARDS_PER_CELL).alias("cell")
    sums = drawn.groupBy("source_no", cell).agg(F.sum("count").alias("sum"))
    before = Window.partitionBy("source_no").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "cell", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_no", "cell").orderBy("shard")
    numbered = drawn.select("*", cell).withColumn("first", F.sum("count").over(inside) - F.col("count"))
    numbered = numbered.join(sums, ["source_no", "cell"]).withColumn("first", F.col("first") + F.col("offset"))
    # a few counts unfold to very many slots: as many tasks as those need
    tasks = max(1, -(-total // SLOTS_PER_TASK))
    numbered = numbered.select("shard", "source_no", "count", "first").repartition(tasks, "shard")
    shape = "shard long, source_no int, slot long, pass int, block long, words int"
    return numbered.mapInPandas(_mapped(plans, [got.get(i, 0) for i in range(len(plans))], block_words), shape)


# --- the operator ------------------------------------------------------------


@dataclass
class Mix:
    """A mix: its plans, its documents with offsets, and the pieces taken."""

    plans: list[Plan]
    sizes: DataFrame
    pieces: DataFrame


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    block_words: int = BLOCK_WORDS,
    per_shard: int = SLOTS_PER_SHARD,
) -> Mix:
    """Draw a mix of ``docs`` (doc_id, source, text).

    ``pieces`` has one row for each document's part of a drawn block: shard, slot,
    pass, source, block, doc_id, text_hash, size, offset, and the words of the
    document taken, from ``first`` up to but not including ``end``.
    """
    spark = docs.sparkSession
    sizes = materialise(sized(docs))
    found = sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    wanted = targets([r["size"] for r in found], [weights[i % len(weights)] for i in range(len(found))], share, passes)
    plans = [
        Plan(r["source"], r["size"], t, *quota(r["size"], t, block_words, r["source"], passes))
        for r, t in zip(found, wanted, strict=True)
    ]
    offsets = with_offsets(sizes, sum(r["rows"] for r in found))
    names = source_table(spark, plans)
    numbered = offsets.join(names, offsets["source"].eqNullSafe(names["_name"])).drop("_name")
    parts = fragments(numbered, block_words)
    drawn = slots(spark, plans, block_words, per_shard)
    # Spark takes the slots to be as few as the counts they are unfolded from, and
    # would broadcast them
    joined = drawn.hint("merge").join(parts, ["source_no", "block"]).filter(F.col("from") < F.col("words"))
    begin = F.col("block") * block_words - F.col("offset")
    pieces = joined.select(
        "shard", "slot", "pass", "source", "block", "doc_id", "text_hash", "size", "offset",
        (begin + F.col("from")).alias("first"),
        (begin + F.least("to", "words")).alias("end"),
    )
    return Mix(plans, numbered, pieces)


def source_table(spark: SparkSession, plans: list[Plan]) -> DataFrame:
    """Sources by number, with their size and target; one row each."""
    rows = [(i, p.source, p.size, p.target) for i, p in enumerate(plans)]
    return spark.createDataFrame(rows, "source_no int, _name string, source_size long, target double")


def taken(mixed: Mix) -> DataFrame:
    """Every document with the words taken of it, repeats counted."""
    key = ["source", "doc_id", "size", "text_hash", "offset"]
    words = mixed.pieces.groupBy(*key).agg(F.sum(F.col("end") - F.col("first")).alias("_taken"))
    renamed = words.select(*[F.col(c).alias(f"_{c}") for c in key], "_taken")
    same = mixed.sizes["offset"] == renamed["_offset"]
    for c in ("source", "doc_id", "size", "text_hash"):
        same = same & mixed.sizes[c].eqNullSafe(renamed[f"_{c}"])
    # documents without words share offsets with others, but have no pieces
    joined = mixed.sizes.join(renamed, same & (mixed.sizes["size"] > 0), "left")
    return joined.select(
        "doc_id", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).cast("long").alias("taken")
    )


def _cut(columns: list[str]):
    word = re.compile(SPACED_WORD)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            lists = zip(*[batch.column(c).to_pylist() for c in ("text", "_size", "_spans")], strict=True)
            for i, (whole, size, spans) in enumerate(lists):
                ends = None
                for span in sorted(spans, key=lambda s: (s["pass"], s["first"])):
                    text = whole
                    if span["first"] > 0 or span["end"] < size:
                        ends = ends or [m.span() for m in word.finditer(whole)]
                        text = whole[ends[span["first"]][0] : ends[span["end"] - 1][1]]
                    rows.append(i)
                    texts.append(text)
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([new.get(c, taken.column(c)) for c in columns], columns)

    return cut


def mixed_documents(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The mix as documents: every run of words taken in one pass is one row.

    A document taken whole keeps its text as it is; a run keeps the white space
    between its words. ``n_chars`` is the length of the new text, all other columns
    are those of the document.
    """
    key = ["doc_id", "source", "text_hash"]
    lined = mixed.pieces.select(*key, "size", "offset", "pass", "first", "end")
    by_doc = Window.partitionBy(*key, "offset", "pass").orderBy("first")
    starts = F.coalesce(F.col("first") > F.lag("end").over(by_doc), F.lit(True)).cast("int")
    runs = lined.withColumn("_new", starts).withColumn("_run", F.sum("_new").over(by_doc))
    spans = runs.groupBy(*key, "size", "offset", "pass", "_run").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    listed = spans.groupBy(*key, "size").agg(F.collect_list(F.struct("pass", "first", "end")).alias("_spans"))
    listed = listed.select(*[F.col(c).alias(f"_{c}") for c in key], F.col("size").alias("_size"), "_spans")
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.col("n_chars").cast("long"))
    hashed = docs.withColumn("_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "source", "_hash"])
    same = (
        hashed["doc_id"].eqNullSafe(listed["_doc_id"])
        & hashed["source"].eqNullSafe(listed["_source"])
        & (hashed["_hash"] == listed["_text_hash"])
    )
    joined = hashed.join(listed, same).select(*[hashed[c] for c in docs.columns], "_size", "_spans")
    return joined.mapInArrow(_cut(docs.columns), docs.schema)
