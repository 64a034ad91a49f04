"""Text jobs that need a dictionary: stems, TF-IDF, token ids, entities.

A dictionary that was counted to be small is looked up where the texts lie, batch by
batch, without a shuffle. For a larger one, texts are written as numbers of words, and
each block of neighbouring texts asks for its distinct words by a join; the answers meet
the texts by block. A block holds about a million words, however long the table is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimflow import fixed_values as fixed
from claimflow.functions.stemming import stem
from claimflow.functions.text import words
from claimflow.operators.projection import quoted
from claimflow.operators.skew import fits_broadcast, lookup_join, numbered
from claimflow.session import materialise

WORD = r"[\p{L}\p{N}]+"
PLAIN_WORD = re.compile(r"[^\W_]+")
#: Entries of a dictionary that each task may hold, and their bytes.
HELD_ENTRIES, HELD_BYTES = 500_000, 64 << 20


#: Words of the texts that are numbered together, and the bytes that count as a word before texts are split.
BLOCK_WORDS, WORD_BYTES = 1 << 20, 6


def coded_texts(
    df: DataFrame, key: str, given: Column, clean: Callable[[Column], Column] | None = None, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(key, block, codes, words, n): a written table of texts as numbers of words.

    ``given`` has lists of words, or texts whose words stand between white space. Neighbouring
    texts form a block; its first row has its distinct words and how often each occurs in it,
    and a word's code is its place among them, -1 for NULL. So texts are split once for all
    that is asked of their words, and a block asks for a word once. ``clean`` is what becomes
    of a word; where nothing is left there is no word, and NULL stands among ``words``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            own = batch.column(1)
            of_words = pa.types.is_list(own.type)
            size = pc.list_value_length(own) if of_words else pc.divide(pc.binary_length(own), WORD_BYTES)
            size = pc.fill_null(size, 0).to_numpy().astype("i8")
            stretch = (np.cumsum(size) - size) // block_words
            starts = np.flatnonzero(np.diff(stretch, prepend=-1)).tolist()
            for first, end in zip(starts, [*starts[1:], len(size)], strict=True):
                part, met = own.slice(first, end - first), size[first:end]
                if not of_words:
                    split = [text.split() if text else [] for text in part.to_pylist()]
                    met = np.fromiter(map(len, split), "i8", len(split))
                    part = pa.array([word for listed in split for word in listed], pa.string())
                coded = (part.flatten() if of_words else part).dictionary_encode()
                codes = pc.fill_null(coded.indices, -1)
                n = np.bincount(codes.to_numpy() + 1, minlength=len(coded.dictionary) + 1)[1:]
                once = pa.array([0, *[len(n)] * (end - first)], pa.int32())
                columns = [
                    batch.column(0).slice(first, end - first), pa.array(np.full(end - first, block)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(met)), pa.int32()), codes),
                    pa.ListArray.from_arrays(once, coded.dictionary), pa.ListArray.from_arrays(once, pa.array(n.astype("i8"))),
                ]
                yield pa.RecordBatch.from_arrays(columns, [key, "block", "codes", "words", "n"])
                block += 1

    asked = df.select(quoted(key).alias(key), given.alias("_words"))
    empty = {"block": "long", "codes": "array<int>", "words": "array<string>", "n": "array<long>"}
    made = asked.select(key, *[F.lit(None).cast(t).alias(c) for c, t in empty.items()]).schema
    coded = asked.mapInArrow(run, made)
    if clean is not None:
        coded = coded.withColumn("words", F.transform(F.transform("words", clean), lambda w: F.nullif(w, F.lit(""))))
    return materialise(coded)


def coded_totals(coded: DataFrame) -> DataFrame:
    """(token, n): how often each word occurs in coded texts."""
    counted = coded.select(F.inline(F.arrays_zip(F.col("words").alias("token"), F.col("n").alias("n"))))
    return counted.filter("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n"))


def _answered(
    coded: DataFrame, key: str, table: DataFrame, value: str, name: str, kind: str, shape, held: int
) -> DataFrame:
    """(key, name): coded texts turned into ``kind`` by a table of (token, value).

    Words are asked for once by each block, so no word can be more frequent than blocks
    are many, and the join needs no salt.
    """
    item = pa.string() if kind == "string" else pa.int32()
    asked = coded.select(F.col("block").alias("asker"), F.posexplode("words").alias("code", "token"))
    table = F.broadcast(table) if fits_broadcast(table, held, HELD_BYTES) else table
    found = asked.join(table, "token").select("asker", "code", value, F.lit(False).alias("gone"))
    none = F.lit(None).cast(table.schema[value].dataType).alias(value)
    found = found.union(asked.filter("token IS NULL").select("asker", "code", none, F.lit(True).alias("gone")))

    def fill(texts: pa.Table, words: pa.Table) -> pa.Table:
        codes, code = texts.column("codes").combine_chunks(), words.column("code").to_numpy()
        flat, row = codes.flatten().to_numpy(), pc.list_parent_indices(codes).to_numpy()
        # a code of -1 reads the last entry, which no word has
        last = max(flat.max(initial=-1), code.max(initial=-1)) + 1
        at, gone = np.full(last + 1, -1, "i8"), np.zeros(last + 1, bool)
        at[code], gone[code] = np.arange(len(code)), words.column("gone").to_numpy()
        kept = ~gone[flat]
        places, sizes = at[flat[kept]], np.bincount(row[kept], minlength=len(codes))
        known = words.column(value).combine_chunks().cast(item).take(pa.array(places, mask=places < 0))
        gathered = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), shape(known))
        if kind == "string":
            gathered = pc.binary_join(gathered, " ")
        return pa.Table.from_arrays([texts.column(key), gathered], [key, name])

    texts = coded.select(key, "block", "codes")
    made = coded.select(F.lit(None).cast(kind).alias(name)).schema
    return texts.groupBy("block").cogroup(found.groupBy("asker")).applyInArrow(fill, StructType([texts.schema[key], made[0]]))


def _word_numbers(listed: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a batch of lists, and for each word met its number and its row."""
    flat, row = listed.flatten(), pc.list_parent_indices(listed)
    if flat.null_count:
        row, flat = row.filter(pc.is_valid(flat)), flat.drop_null()
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype("i8"), row.to_numpy().astype("i8")


def word_totals(df: DataFrame, lists: Column, name: str, texts: bool = False) -> DataFrame:
    """(``name``, n): how often each word occurs, or in how many lists.

    Each batch is counted as a whole before anything leaves it, so a word costs a row for
    each batch, not for each place where it stands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, number, row = _word_numbers(batch.column(0))
            if texts and len(found):
                number = np.unique(row * len(found) + number) % len(found)
            n = np.bincount(number, minlength=len(found)).astype("i8")
            yield pa.RecordBatch.from_arrays([found, pa.array(n)], ["token", "n"])

    counted = df.select(lists.alias("_words")).mapInArrow(run, "token string, n long")
    return counted.groupBy(F.col("token").alias(name)).agg(F.sum("n").alias("n"))


def stem_table(df: DataFrame, text: str) -> DataFrame:
    """(token, stem) for every distinct word of the column, computed once."""
    vocabulary = word_totals(df, words(quoted(text)), "token")
    return materialise(vocabulary.select("token", stem("token").alias("stem")))


def _looked_up(df: DataFrame, key: str, lists: Column, held: list, name: str, kind: str, shape):
    """(key, name): word lists turned into ``kind`` by a held table of (token, value).

    ``shape`` makes the result of the values found, NULL for words not in the table.
    """
    item = pa.string() if kind == "string" else pa.int32()
    shared = df.sparkSession.sparkContext.broadcast(([r[0] for r in held], [r[1] for r in held]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, values = pa.array(shared.value[0], pa.string()), pa.array(shared.value[1], item)
        for batch in batches:
            listed = batch.column(1)
            listed = pc.if_else(pc.is_valid(listed), listed, pa.scalar([], listed.type))
            found = values.take(pc.index_in(listed.flatten(), value_set=tokens))
            sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
            offsets = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
            gathered = pa.ListArray.from_arrays(offsets, shape(found))
            if kind == "string":
                gathered = pc.binary_join(gathered, " ")
            yield pa.RecordBatch.from_arrays([batch.column(0), gathered], [key, name])

    given = df.select(quoted(key).alias(key), lists.alias("_words"))
    made = given.select(F.lit(None).cast(kind).alias(name)).schema
    return given.mapInArrow(run, StructType([given.schema[0], made[0]]))


def stem_text(df: DataFrame, key: str, text: str, name: str, held: int = HELD_ENTRIES) -> DataFrame:
    """(key, name): the words of each text replaced by their stems, in order."""
    coded = coded_texts(df, key, quoted(text).cast("string"))
    stems = materialise(coded_totals(coded).select("token", stem("token").alias("stem")))
    return _answered(coded, key, stems, "stem", name, "string", lambda found: found, held)


def term_counts(df: DataFrame, key: str, terms: Column) -> DataFrame:
    """(key, term, n). A text is counted where it lies; only keys that several texts
    share make the counts meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, number, row = _word_numbers(batch.column(1))
            pair, n = np.unique(row * max(len(found), 1) + number, return_counts=True)
            row, number = np.divmod(pair, max(len(found), 1))
            columns = [batch.column(0).take(pa.array(row)), found.take(pa.array(number)), pa.array(n.astype("i8"))]
            yield pa.RecordBatch.from_arrays(columns, [key, "term", "n"])

    given = df.select(quoted(key).alias(key), terms.alias("_words"))
    made = given.select(key, F.lit("").alias("term"), F.lit(1).cast("long").alias("n")).schema
    counted = given.mapInArrow(run, made)
    shared = given.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if shared.isEmpty():
        return counted
    return counted.groupBy(key, "term").agg(F.sum("n").alias("n"))


@dataclass
class TfIdf:
    """Term weights n * (ln((1 + texts) / (1 + texts with the term)) + 1), L2-normed per text."""

    idf: DataFrame | None = None

    def fit(self, df: DataFrame, key: str, terms: Column) -> "TfIdf":
        """From one row per text; texts without terms count as texts."""
        return self._weigh(word_totals(df, terms, "term", texts=True), df.count())

    def fit_counts(self, counts: DataFrame, key: str) -> "TfIdf":
        """From (key, term, n)."""
        frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        return self._weigh(frequency, counts.select(key).distinct().count())

    def _weigh(self, frequency: DataFrame, texts: int) -> "TfIdf":
        """From (term, n), n being the texts that have the term."""
        weight = F.log(F.lit(1.0 + texts) / (F.lit(1.0) + F.col("n"))) + F.lit(1.0)
        self.idf = materialise(frequency.select("term", weight.alias("idf")))
        return self

    def transform(self, df: DataFrame, key: str, terms: Column) -> DataFrame:
        """(key, term, weight) of the terms that are in the vocabulary."""
        return self.weigh(term_counts(df, key, terms), key)

    def weigh(self, counts: DataFrame, key: str) -> DataFrame:
        known = lookup_join(counts, self.idf, ["term"], "inner")
        raw = F.col("n") * F.col("idf")
        in_text = Window.partitionBy(key)
        norm = F.sqrt(F.sum(raw * raw).over(in_text))
        return known.select(key, "term", (raw / norm).alias("weight"))

    def wide(self, weights: DataFrame, key: str, terms: Sequence[str]) -> DataFrame:
        """One column per listed term, 0 where a text lacks it."""
        columns = [
            F.coalesce(F.sum(F.when(F.col("term") == t, F.col("weight"))), F.lit(0.0)).alias(t)
            for t in terms
        ]
        return weights.groupBy(key).agg(*columns)


def build_vocabulary(df: DataFrame, terms: Column, reserved: int = 2) -> DataFrame:
    """(token, id) of all words, the most frequent first; the first ids are reserved."""
    return ranked_words(word_totals(df, terms, "token"), reserved)


def ranked_words(counted: DataFrame, reserved: int = 2) -> DataFrame:
    """(token, id) from (token, n), the most frequent first; the first ids are reserved."""
    ranked = numbered(counted, [F.desc("n"), F.asc("token")], "place")
    return ranked.select("token", (F.col("place") + F.lit(reserved)).cast("int").alias("id"))


def token_ids(
    df: DataFrame, key: str, terms: Column, vocabulary: DataFrame, unknown: int = 1, held: int = HELD_ENTRIES
) -> DataFrame:
    """(key, ids): word ids in text order, ``unknown`` for words outside the vocabulary."""
    vocabulary = materialise(vocabulary.select("token", F.col("id").cast("int").alias("id")))
    if fits_broadcast(vocabulary, held, HELD_BYTES):
        known = lambda found: pc.fill_null(found, unknown)
        return _looked_up(df, key, terms, vocabulary.collect(), "ids", "array<int>", known)
    return coded_ids(coded_texts(df, key, terms), key, vocabulary, unknown, held)


def coded_ids(coded: DataFrame, key: str, vocabulary: DataFrame, unknown: int = 1, held: int = HELD_ENTRIES) -> DataFrame:
    """(key, ids) of coded texts, ``unknown`` for words outside the vocabulary."""
    known = lambda found: pc.fill_null(found, unknown)
    listed = materialise(vocabulary.select("token", F.col("id").cast("int").alias("id")))
    return _answered(coded, key, listed, "id", "ids", "array<int>", known, held)


FOUND = "array<struct<pos:int,label:string,words:string>>"


def _spans(text: str | None) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m.group().lower()) for m in PLAIN_WORD.finditer(text or "")]


def _longest_first(matches: Iterator[tuple[int, int, str, str]]) -> list[dict]:
    """From (pos, words, label, text), sorted, the matches that overlap none before them."""
    kept, end = [], 0
    for pos, n, label, text in matches:
        if pos >= end:
            kept.append({"pos": pos, "label": label, "words": text})
            end = pos + n
    return kept


class PhraseAutomaton:
    """Finds all phrases of a table in one pass over the words of a text.

    Phrases are paths of word numbers in a trie. A failure link leads from a path to the
    longest path that is an ending of it, and a second link to the longest such ending
    that is a whole phrase, so no word is looked at twice for the phrases it may begin.
    The trie is flat: one table of (node, word) -> node, and arrays.
    """

    def __init__(self, phrases: Sequence[tuple[str, str]]):
        self.words: dict[str, int] = {}
        self.next: dict[tuple[int, int], int] = {}
        depth, labels = [0], [None]
        children: list[list[tuple[int, int]]] = [[]]
        for phrase, label in phrases:
            node = 0
            for w in phrase.split(" "):
                number = self.words.setdefault(w, len(self.words))
                to = self.next.get((node, number))
                if to is None:
                    to = self.next[node, number] = len(depth)
                    children[node].append((number, to))
                    depth.append(depth[node] + 1)
                    labels.append(None)
                    children.append([])
                node = to
            labels[node] = label
        self.depth, self.labels = depth, labels
        self.fail, self.ends = [0] * len(depth), [0] * len(depth)
        level = [to for _, to in children[0]]
        while level:
            deeper = []
            for node in level:
                self.ends[node] = node if labels[node] is not None else self.ends[self.fail[node]]
                for number, to in children[node]:
                    at = self.fail[node]
                    while at and (at, number) not in self.next:
                        at = self.fail[at]
                    self.fail[to] = self.next.get((at, number), 0)
                    deeper.append(to)
            level = deeper

    def matches(self, words: Sequence[str]) -> list[tuple[int, int, str]]:
        """(first word, words, label) of every phrase, sorted by place and, at one place, the longest first."""
        found, node = [], 0
        get, step, fail, ends, depth = self.words.get, self.next.get, self.fail, self.ends, self.depth
        for pos, w in enumerate(words):
            number = get(w)
            if number is None:
                node = 0
                continue
            to = step((node, number))
            while to is None and node:
                node = fail[node]
                to = step((node, number))
            node = to or 0
            end = ends[node]
            while end:
                found.append((pos - depth[end] + 1, depth[end], self.labels[end]))
                end = ends[fail[end]]
        return sorted(found, key=lambda m: (m[0], -m[1]))


def _scanned(text: str | None, automaton: PhraseAutomaton) -> Iterator[tuple[int, int, str, str]]:
    """Phrases of a held table in one text, longest first at each word."""
    spans = _spans(text)
    for pos, n, label in automaton.matches([w for _, _, w in spans]):
        yield pos, n, label, text[spans[pos][0] : spans[pos + n - 1][1]]


#: Bits of a filter for each phrase, and how many of them a phrase sets.
FILTER_BITS, FILTER_HASHES = 12, 4


def _filter_places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits that hashes set, from two halves of each."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    for i in range(FILTER_HASHES):
        yield (low + np.uint64(i) * (high | np.uint64(1))) % np.uint64(bits)


def phrase_filter(phrases: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of the phrases, as bytes: each task sets its bits, and they are put together by place."""
    bits = max(64, n * FILTER_BITS)
    step = 8 << 20

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy().view("u8")
            places = np.unique(np.concatenate(list(_filter_places(hashes, bits)))).astype("i8")
            parts = np.split(places, np.searchsorted(places, np.arange(step, bits, step)))
            for i, part in enumerate(parts):
                if len(part):
                    own = np.zeros(min(step, bits - i * step) // 8 + 1, "u1")
                    np.bitwise_or.at(own, (part - i * step) >> 3, (1 << ((part - i * step) & 7)).astype("u1"))
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([own.tobytes()])], ["part", "own"])

    def put_together(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = None
        for frame in frames:
            for own in frame["own"]:
                one = np.frombuffer(own, "u1")
                whole = one.copy() if whole is None else whole | one
        yield pd.DataFrame({"part": [key[0]], "own": [whole.tobytes()]})

    hashed = phrases.select(F.xxhash64("phrase").alias("hash")).mapInArrow(set_bits, "part long, own binary")
    out = np.zeros(bits // 8 + 1, "u1")
    for row in hashed.groupBy("part").applyInPandas(put_together, "part long, own binary").toLocalIterator():
        own = np.frombuffer(row["own"], "u1")
        at = row["part"] * (step // 8)
        out[at : at + len(own)] |= own[: len(out) - at]
    return out


#: Phrases beyond which the filter itself would be too large to hold.
FILTER_PHRASES = 200_000_000


def _maybe(hashes: np.ndarray, held: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes may be in the filter."""
    out = np.ones(len(hashes), bool)
    for place in _filter_places(hashes, bits):
        out &= (held[(place >> np.uint64(3)).astype("i8")] >> (place & np.uint64(7)).astype("u1")) & 1 == 1
    return out


def find_phrases(df: DataFrame, key: str, text: str, gazetteer: DataFrame, held: int = HELD_ENTRIES) -> DataFrame:
    """(key, found): non-overlapping phrase matches of each text in text order.

    The gazetteer has ``phrase`` and ``label``; phrases may have any number of words,
    and what stands between words does not matter. Reading from the left, the longest
    phrase that starts at a word is taken and its words are used up. ``words`` is the
    match as it stands in the text. Keys must be unique.
    """
    split = F.regexp_extract_all(F.lower("phrase"), F.lit(WORD), F.lit(0))
    phrases = gazetteer.select(split.alias("_split"), "label").filter(F.size("_split") > 0)
    phrases = phrases.groupBy(F.array_join("_split", " ").alias("phrase"), F.size("_split").alias("n")).agg(
        F.min("label").alias("label")
    )
    phrases = materialise(phrases)
    given = df.select(quoted(key).alias(key), quoted(text).cast("string").alias("_text"))
    made = given.select(key, F.lit(None).cast(FOUND).alias("found")).schema
    if fits_broadcast(phrases, held, HELD_BYTES):
        rows = phrases.select("phrase", "label").collect()
        shared = df.sparkSession.sparkContext.broadcast([(r["phrase"], r["label"]) for r in rows])

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = PhraseAutomaton(shared.value)
            for batch in batches:
                found = [_longest_first(_scanned(t, automaton)) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, FOUND_ARROW)], [key, "found"])

        return given.mapInArrow(scan, made)
    n = phrases.count()
    sizes = [r["n"] for r in phrases.select("n").distinct().collect()]
    bits = max(64, n * FILTER_BITS)
    holds = df.sparkSession.sparkContext.broadcast(phrase_filter(phrases, n) if n <= FILTER_PHRASES else None)
    begins = materialise(_beginnings(phrases))
    n_begins = begins.count()
    begin_bits = max(64, n_begins * FILTER_BITS)
    begun = df.sparkSession.sparkContext.broadcast(phrase_filter(begins, n_begins) if n_begins <= FILTER_PHRASES else None)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, end in _portions(texts):
                for part in _candidates_in(texts[first:end], sizes, holds.value, bits, begun.value, begin_bits):
                    yield _candidate_rows(batch.column(0).slice(first), key, *part)

    shape = given.select(key, *[F.lit(None).cast(t).alias(c) for c, t in (("n", "int"), ("phrase", "string"), ("pos", "array<int>"), ("words", "array<string>"))]).schema
    # written once: texts are not scanned again for hot keys and for the join
    asked = materialise(given.mapInArrow(candidates, shape))
    met = lookup_join(asked, phrases.select("phrase", "label"), ["phrase"], "inner")
    listed = met.groupBy(key).agg(F.collect_list(F.struct("n", "label", "pos", "words")).alias("_all"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _picked(batch.column(1))], [key, "found"])

    return given.select(key).join(listed, key, "left").mapInArrow(pick, made)


FOUND_ARROW = pa.list_(pa.struct([("pos", pa.int32()), ("label", pa.string()), ("words", pa.string())]))
#: Characters of the texts whose words are numbered together.
PORTION_CHARS = 1 << 21


def _beginnings(phrases: DataFrame) -> DataFrame:
    """(phrase): what longer phrases begin with, each once."""
    split = F.split("phrase", " ")
    ends = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda k: k > 0)
    return phrases.select(F.explode(F.transform(ends, lambda k: F.array_join(F.slice(split, 1, k), " "))).alias("phrase")).distinct()


def _portions(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Stretches of texts that are worked on together, as first and end."""
    first = size = 0
    for end, text in enumerate(texts, 1):
        size += len(text or "")
        if size >= PORTION_CHARS or end == len(texts):
            yield first, end
            first, size = end, 0


def _maybe_any(runs: Sequence[str], held: np.ndarray | None, bits: int) -> np.ndarray:
    """Which texts the filter does not rule out."""
    if held is None:
        return np.ones(len(runs), bool)
    # the hash that Spark gave the phrases
    return _maybe(np.array([xxhash.xxh64_intdigest(r.encode(), 42) for r in runs], "u8"), held, bits)


def _candidates_in(
    texts: Sequence[str | None], sizes: Sequence[int], held: np.ndarray | None, bits: int,
    begins: np.ndarray | None = None, begin_bits: int = 64,
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[str], list[str]]]:
    """(n, row, pos, run, runs, words) of all runs of n words that the filter does not rule out.

    A run is known by its number in ``runs``, so however often it is met, it is hashed
    once. A place is left as soon as no phrase begins with the words read from there.
    """
    split = [PLAIN_WORD.findall(t or "") for t in texts]
    counts = np.fromiter(map(len, split), "i8", len(split))
    coded = pa.array([w for listed in split for w in listed], pa.string()).dictionary_encode()
    numbers: dict[str, int] = {}
    same = np.array([numbers.setdefault(w.lower(), len(numbers)) for w in coded.dictionary.to_pylist()], "i8")
    listed, word = list(numbers), same[coded.indices.to_numpy()]
    row, first = np.repeat(np.arange(len(split)), counts), np.cumsum(counts) - counts
    left = (first + counts)[row] - np.arange(len(word))
    starts: dict[int, list[int]] = {}
    place, run, runs = np.arange(len(word)), word, listed
    for n in range(1, max(sizes, default=0) + 1):
        if n > 1:
            kept = _maybe_any(runs, begins, begin_bits)[run] & (left[place] >= n)
            place = place[kept]
            pairs, run = np.unique(run[kept] * len(listed) + word[place + n - 1], return_inverse=True)
            runs = [f"{runs[p // len(listed)]} {listed[p % len(listed)]}" for p in pairs.tolist()]
        if not len(place):
            return
        if n not in sizes:
            continue
        kept = _maybe_any(runs, held, bits)[run]
        at, own = row[place[kept]], place[kept] - first[row[place[kept]]]
        if n == 1:
            words = coded.dictionary.take(coded.indices.take(pa.array(place[kept]))).to_pylist()
        else:
            words = []
            for r, pos in zip(at.tolist(), own.tolist(), strict=True):
                if r not in starts:
                    starts[r] = _starts(texts[r], split[r])
                words.append(texts[r][starts[r][pos] : starts[r][pos + n - 1] + len(split[r][pos + n - 1])])
        yield n, at, own, run[kept], runs, words


def _starts(text: str, words: Sequence[str]) -> list[int]:
    """Where the words of a text start, from what stands before each of them."""
    between = np.fromiter(map(len, PLAIN_WORD.split(text)), "i8", len(words) + 1)[:-1]
    sizes = np.fromiter(map(len, words), "i8", len(words))
    return (np.cumsum(between) + np.cumsum(sizes) - sizes).tolist()


def _candidates_of(text: str | None, sizes: Sequence[int], held: np.ndarray | None, bits: int) -> Iterator[tuple[int, int, str, str]]:
    """(pos, words, phrase, text) of the runs of one text."""
    for n, _, own, run, runs, words in _candidates_in([text], sizes, held, bits):
        yield from zip(own.tolist(), [n] * len(own), [runs[r] for r in run.tolist()], words, strict=True)


def _lists(values: pa.Array, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _candidate_rows(
    keys: pa.Array, key: str, n: int, row: np.ndarray, pos: np.ndarray, run: np.ndarray, runs: list[str], words: list[str]
) -> pa.RecordBatch:
    """One row for each text and run met in it, with all places."""
    pair = row * len(runs) + run
    order = np.argsort(pair, kind="stable")
    _, starts = np.unique(pair[order], return_index=True)
    one = order[starts]
    columns = [
        keys.take(pa.array(row[one])), pa.array(np.full(len(one), n), pa.int32()),
        pa.array([runs[r] for r in run[one].tolist()], pa.string()),
        _lists(pa.array(pos[order], pa.int32()), starts), _lists(pa.array(words, pa.string()).take(pa.array(order)), starts),
    ]
    return pa.RecordBatch.from_arrays(columns, [key, "n", "phrase", "pos", "words"])


def _picked(listed: pa.Array) -> pa.Array:
    """From all matches of each text, as (n, label, places, words), those that overlap none before them."""
    met, row = listed.flatten(), pc.list_parent_indices(listed).to_numpy()
    n, label, places, words = met.flatten()
    own, pos = pc.list_parent_indices(places).to_numpy(), places.flatten().to_numpy()
    row, n, words = row[own], n.to_numpy()[own], words.flatten()
    order = np.lexsort((-n, pos, row))
    kept, at, end = [], -1, 0
    for i, r, p, size in zip(order.tolist(), row[order].tolist(), pos[order].tolist(), n[order].tolist(), strict=True):
        if r != at:
            at, end = r, 0
        if p >= end:
            kept.append(i)
            end = p + size
    kept = np.array(kept, "i8")
    columns = [pa.array(pos[kept], pa.int32()), label.take(pa.array(own[kept])), words.take(pa.array(kept))]
    found = pa.StructArray.from_arrays(columns, fields=list(FOUND_ARROW.value_type))
    return _lists(found, np.searchsorted(row[kept], np.arange(len(listed)))).cast(FOUND_ARROW)


def extract_entities(df: DataFrame, key: str, text: str, gazetteer: DataFrame, held: int = HELD_ENTRIES) -> DataFrame:
    """(key, entities): one list of texts per output label; other labels are dropped."""
    found = find_phrases(df, key, text, gazetteer, held)

    def of_label(label: str) -> Column:
        own = F.filter("found", lambda m: m["label"] == F.lit(label))
        return F.transform(own, lambda m: m["words"])

    lists = [of_label(label).alias(name) for label, name in fixed.ENTITY_LISTS.items()]
    return found.select(key, F.struct(*lists).alias("entities"))
