"""Near-duplicates by SimHash, found through popcounts of segments.

A fingerprint has a bit set where over half of the text's shingle hashes have it.
For the search each fingerprint is cut into 32 segments of two bits and mapped to
their 32 popcounts. The Manhattan distance of two such vectors never exceeds the
number of differing bits, so vectors further apart than the limit need no look.

The range join on the vectors is a grid: coordinates are put in G groups. Two
vectors at distance four or less differ in at most four groups, so they agree on all
coordinates of the other G-4. Every choice of G-4 groups is one grid, its cells are
the coordinates in them, and partners meet in a cell of some grid. G grows with the
number of different fingerprints so that cells stay small. In a cell the Manhattan
bound is tested first and then the exact number of differing bits; a cell reports a
star for each of its components, never all pairs, so nothing grows with the square
of a group of copies and no link is lost for the components.

Equal fingerprints are one entry throughout. Cells that hold more than ``CELL_ROWS``
of them are left to an exact search of linear size: fingerprints within four bits
have a common value within two bits of both, so each is spread to its 2,081 such
values and neighbours in the order of these are linked.

Defined cases: a null text, or one without words, has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle; repeated rows and equal
texts share a component; a component's name is its smallest id, nulls aside; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import broadcast_if_small, unused
from claimflow.llm.components import components
from claimflow.session import materialise

SHINGLE_WORDS = 4
SEED = 42
BITS = 4
SEGMENTS = 32
#: Fingerprints that an average cell may hold before a finer grid is taken.
CELL_MEAN = 64
#: Fingerprints of one cell that are compared with each other in one task.
CELL_ROWS = 50_000
ODD = np.uint64(0x5555555555555555)
ONE = np.uint64(1)
HASHES_AT_ONCE = 1 << 16


def _hashes(text: str, width: int, seed: int) -> Iterator[np.ndarray]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), "i8", len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHES_AT_ONCE):
        pairs = zip(starts[at : at + HASHES_AT_ONCE].tolist(), ends[at : at + HASHES_AT_ONCE].tolist(), strict=True)
        yield np.array([digest(joined[s:e], seed) for s, e in pairs], "u8")


def fingerprint_of(text: str | None, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text."""
    counts, n = np.zeros(64, "i8"), 0
    for hashes in _hashes(text or "", width, seed):
        bits = np.unpackbits(hashes.astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype="i8")
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id and fingerprint (its 64 bits as a long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint_of(t, width, seed) for t in batch.column("text").to_pylist()], "u8")
            columns = [batch.column("doc_id"), pa.array(found.view("i8"))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {ids}, fingerprint long")


def embedded(fp: np.ndarray) -> np.ndarray:
    """The popcounts of the 32 two-bit segments, each as a count of low bits.

    A popcount of 0, 1 or 2 is written 00, 01 or 11, so the Manhattan distance of two
    vectors is the number of bits in which these words differ.
    """
    either = (fp | (fp >> ONE)) & ODD
    return either | ((fp & (fp >> ONE) & ODD) << ONE)


def groups_for(n: int, bits: int = BITS) -> int:
    """How many groups of coordinates keep an average cell below ``CELL_MEAN``."""
    for g in range(bits + 1, SEGMENTS // 2):
        if n * 0.375 ** (SEGMENTS * (g - bits) / g) <= CELL_MEAN:
            return g
    return SEGMENTS // 2


def grids(groups: int, bits: int = BITS) -> list[np.uint64]:
    """For every choice of all but ``bits`` groups the bits of its segments."""
    edges = [SEGMENTS * i // groups for i in range(groups + 1)]
    masks = [sum(3 << (2 * s) for s in range(edges[i], edges[i + 1])) for i in range(groups)]
    return [np.uint64(sum(masks[i] for i in kept)) for kept in combinations(range(groups), groups - bits)]


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt * 0xD1B54A32D192ED03 % 2**64)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def cells(distinct: DataFrame, groups: int, bits: int = BITS) -> DataFrame:
    """Every fingerprint in its cell of every grid: cell, fingerprint."""
    masks = grids(groups, bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            fp = frame["fingerprint"].to_numpy("i8").view("u8")
            vectors = embedded(fp)
            for i, mask in enumerate(masks):
                yield pd.DataFrame({"cell": _mixed(vectors & mask, i).view("i8"), "fingerprint": fp.view("i8")})

    return distinct.select("fingerprint").mapInPandas(run, "cell long, fingerprint long")


def close(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Which fingerprints differ in ``bits`` bits or fewer, by the bound and then exactly."""
    near = np.bitwise_count(embedded(a) ^ embedded(b)) <= bits
    near &= np.bitwise_count(a ^ b) <= bits
    return near


def stars(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each component of one cell to one of its members.

    Visited fingerprints leave the search, so a cell full of near copies costs about
    as much as it has members.
    """
    vectors, left = embedded(fp), np.arange(len(fp))
    if len(fp) <= 1024:
        linked = (np.bitwise_count(vectors[:, None] ^ vectors) <= bits) & (np.bitwise_count(fp[:, None] ^ fp) <= bits)
        left = np.flatnonzero(linked.sum(axis=1) > 1)
    ones, others = [], []
    while len(left):
        seed, left = left[0], left[1:]
        frontier = np.array([seed])
        while len(frontier) and len(left):
            part, frontier = frontier[:64], frontier[64:]
            near = np.bitwise_count(vectors[part][:, None] ^ vectors[left]) <= bits
            near &= np.bitwise_count(fp[part][:, None] ^ fp[left]) <= bits
            near = near.any(axis=0)
            new, left = left[near], left[~near]
            ones.append(np.full(len(new), fp[seed]))
            others.append(fp[new])
            frontier = np.concatenate([frontier, new])
    empty = np.zeros(0, "u8")
    return np.concatenate([empty, *ones]), np.concatenate([empty, *others])


def _cell_links(cell: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    begins = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    sizes = np.diff(np.concatenate([begins, [len(cell)]]))
    ones, others = [], []
    # small cells, all at once: each row with the one so many places further on
    small = np.repeat(sizes <= 8, sizes)
    for step in range(1, 8):
        at = np.flatnonzero((cell[:-step] == cell[step:]) & small[:-step]) if step < len(cell) else []
        if not len(at):
            break
        at = at[close(fp[at], fp[at + step], bits)]
        ones.append(fp[at])
        others.append(fp[at + step])
    for i in np.flatnonzero(sizes > 8):
        a, b = stars(fp[begins[i] : begins[i] + sizes[i]], bits)
        ones.append(a)
        others.append(b)
    empty = np.zeros(0, "u8")
    return np.concatenate([empty, *ones]), np.concatenate([empty, *others])


def _in_cells(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_cell, held = np.zeros(0, "i8"), np.zeros(0, "u8")

        def links(cell: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
            a, b = _cell_links(cell, fp, bits) if len(cell) else (fp, fp)
            return pd.DataFrame({"a": a.view("i8"), "b": b.view("i8")})

        for frame in batches:
            cell = np.concatenate([held_cell, frame["cell"].to_numpy("i8")])
            fp = np.concatenate([held, frame["fingerprint"].to_numpy("i8").view("u8")])
            if not len(cell):
                continue
            open_ = int(np.searchsorted(cell, cell[-1]))
            yield links(cell[:open_], fp[:open_])
            held_cell, held = cell[open_:], fp[open_:]
        yield links(held_cell, held)

    return run


def _halfway(bits: int) -> np.ndarray:
    """All values with at most half of ``bits`` bits set."""
    chosen = [c for r in range(bits // 2 + 1) for c in combinations(range(64), r)]
    return np.array([sum(1 << i for i in c) for c in chosen], "u8")


def _spread(bits: int):
    values = _halfway(bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            fp = frame["fingerprint"].to_numpy("i8").view("u8")
            for at in range(0, len(fp), 256):
                part = fp[at : at + 256]
                between = (part[:, None] ^ values).ravel()
                yield pd.DataFrame({"between": between.view("i8"), "fingerprint": np.repeat(part, len(values)).view("i8")})

    return run


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last = np.zeros((0, 2), "i8")
    for frame in batches:
        rows = np.concatenate([last, frame[["between", "fingerprint"]].to_numpy("i8")])
        same = np.flatnonzero(rows[1:, 0] == rows[:-1, 0])
        yield pd.DataFrame({"a": rows[same, 1], "b": rows[same + 1, 1]})
        last = rows[-1:]


def links(distinct: DataFrame, bits: int = BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``bits`` bits.

    ``distinct`` holds each fingerprint once. ``bits`` may be 0, 2 or 4.
    """
    if bits not in (0, 2, 4):
        raise ValueError("bits must be 0, 2 or 4")
    n = distinct.count()
    placed = cells(distinct, groups_for(n, bits), bits)
    crowded = None
    if n > cell_rows:
        full = placed.groupBy("cell").count().filter(F.col("count") > cell_rows).select("cell")
        crowded = materialise(full)
        crowded = crowded if crowded.count() else None
    ordinary = placed if crowded is None else placed.join(crowded, "cell", "left_anti")
    found = ordinary.repartition("cell").sortWithinPartitions("cell").mapInPandas(_in_cells(bits), "a long, b long")
    if crowded is None:
        return found
    rest = placed.join(crowded, "cell", "left_semi").select("fingerprint").distinct()
    spread = rest.mapInPandas(_spread(bits), "between long, fingerprint long")
    chained = spread.repartition("between").sortWithinPartitions("between", "fingerprint")
    chained = chained.mapInPandas(_chained, "a long, b long")
    return found.unionByName(chained)


def near_duplicates(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Every document with its fingerprint and component: doc_id, fingerprint, component_id."""
    marked = materialise(fingerprints(docs))
    classes = materialise(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("_first")))
    tied = components(links(classes.select("fingerprint"), bits))
    named = classes.join(tied.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = materialise(named.withColumn("_component", F.coalesce("component", "fingerprint")))
    smallest = named.groupBy("_component").agg(F.min("_first").alias("component_id"))
    by_print = named.join(smallest, "_component").select("fingerprint", "component_id")
    return marked.join(by_print, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """One row of each component, the one with the smallest id, all columns kept.

    Rows are told apart by all their values; of equal rows one is kept. Components hold
    rows by a hash of 64 bits. Should two different rows share it, both are kept where one
    is: rows are equal only by two hashes, so none is taken for another and lost.
    """
    row, again = unused("_row", docs), unused("_again", docs)
    values = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.withColumn(row, F.xxhash64(*values)).withColumn(again, F.xxhash64(F.lit(1), *values))
    keyed = named.select(F.col(row).alias("_row"), "doc_id", "text")
    marked = near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text"), bits)
    ids = keyed.select("_row", "doc_id").distinct()
    tied = marked.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_component")).distinct()
    smallest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    kept = ids.join(tied, "_row").groupBy("_component").agg(smallest.alias("_best")).select("_best._row")
    chosen = named.join(broadcast_if_small(kept.withColumnRenamed("_row", row)), row, "left_semi")
    return chosen.dropDuplicates([row, again]).drop(row, again)
