"""Likelihood of documents under a unigram model of subword pieces.

The pieces are those of an existing vocabulary file, which is read and never changed;
their probabilities are estimated from the training documents. A word's probability
is the sum over all its segmentations into pieces, by a forward recursion in log
space over the lattice of its substrings; pieces never cross white space, so a
document's marginal log probability is the sum over its words and one end symbol.

1. Each task packs its documents into blocks of a few megabytes: a block has its own
   dictionary, and a document is the numbers and counts of its words in it.
2. Dictionaries are split by a hash of the word and merged, so each different word
   of the corpus stands once with its training count. A word as common as may be is
   one entry for each block.
3. Expectation maximisation runs over the merged words, forward and backward, and
   only sums for each piece of the vocabulary reach the driver.
4. Words are scored once each, scores go back to the blocks that hold the word, and
   a block's documents are added up.

The corpus is read once, and what grows with it is shuffled in packed form.

Defined cases: a null text, or one without words, consists of the end symbol alone;
characters the vocabulary lacks are spelled in bytes, so every text has a positive
probability; without training documents the probabilities are the starting ones;
repeated rows are scored each and count each in training; rows without id are kept;
an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.session import materialise

PIECES_FILE = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 2
#: Bytes of text in a block, and different words in a part of the merged dictionary.
BLOCK_BYTES = 8 << 20
PART_WORDS = 300_000
#: Added to every piece's expected count.
SMOOTHING = 0.1
#: Words up to this many characters are scored many at a time; longer ones one at a
#: time, with the edges of so many places held at once.
LONG_WORD = 48
PLACES_AT_ONCE = 4_096
WORDS_AT_ONCE = 4_096
SPACE = "▁"
MULTIPLIER = 0x9E3779B97F4A7C15


# --- the model -----------------------------------------------------------------


def vocabulary(path: str = PIECES_FILE) -> list[str]:
    """The pieces of a vocabulary file, best first; bytes are written ``<0xNN>``."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [i for i in range(pieces.get_piece_size()) if not pieces.is_control(i) and not pieces.is_unknown(i)]
    return [pieces.id_to_piece(i) for i in sorted(kept, key=lambda i: -pieces.get_score(i))]


def piece_hashes(texts: list[str]) -> np.ndarray:
    """A hash of each text, the same that ``Pieces`` computes for substrings."""
    out = np.zeros(len(texts), "u8")
    for i, text in enumerate(texts):
        h = 0
        for c in text:
            h = (h * MULTIPLIER + ord(c) + 1) % 2**64
        out[i] = h
    return out


@dataclass
class Pieces:
    """Pieces with their log probabilities; the last one is the end symbol."""

    texts: list[str]
    logs: np.ndarray

    def __post_init__(self) -> None:
        self.byte = np.full(256, -1)
        plain = []
        for i, t in enumerate(self.texts):
            if m := re.fullmatch(r"<0x([0-9A-F]{2})>", t):
                self.byte[int(m[1], 16)] = i
            else:
                plain.append(i)
        self.longest = max((len(self.texts[i]) for i in plain), default=1)
        self.number = {self.texts[i]: i for i in plain}
        hashes = piece_hashes([self.texts[i] for i in plain])
        order = np.argsort(hashes)
        self.sorted, self.at = hashes[order], np.array(plain, "i8")[order]
        self.lengths = sorted({len(self.texts[i]) for i in plain})

    @classmethod
    def start(cls, texts: list[str]) -> Pieces:
        """Probabilities falling with the rank in the vocabulary."""
        weights = 1 / (100 + np.arange(len(texts) + 1))
        return cls(texts, np.log(weights / weights.sum()))

    def spelled(self, char: str) -> list[int]:
        """The byte pieces of one character."""
        return [int(self.byte[b]) for b in char.encode("utf-8", "surrogatepass") if self.byte[b] >= 0]

    def _groups(self, words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            by_length[len(w)].append(i)
        for n, members in sorted(by_length.items()):
            size = 1 if n > LONG_WORD else WORDS_AT_ONCE
            for at in range(0, len(members), size):
                part = members[at : at + size]
                joined = "".join([words[i] for i in part]).encode("utf-32-le", "surrogatepass")
                yield part, np.frombuffer(joined, "<u4").reshape(len(part), n).astype("u8")

    def edges(self, codes: np.ndarray, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For each substring place (from, to) the piece or -1, and its log probability."""
        m, n = codes.shape
        prefix = np.zeros((m, n + 1), "u8")
        power = {length: np.uint64(pow(MULTIPLIER, length, 2**64)) for length in self.lengths}
        for j in range(n):
            prefix[:, j + 1] = prefix[:, j] * np.uint64(MULTIPLIER) + codes[:, j] + np.uint64(1)
        for j in range(1, n + 1):
            for length in self.lengths:
                i = j - length
                if i < 0:
                    break
                h = prefix[:, j] - prefix[:, i] * power[length]
                place = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
                known = self.sorted[place] == h
                ids = np.where(known, self.at[place], -1)
                logs = np.where(known, self.logs[ids], -np.inf)
                if length == 1 and not known.all():
                    for r in np.flatnonzero(~known):
                        logs[r] = self.logs[self.spelled(words[r][i])].sum()
                yield i, j, ids, logs

    def _prefixes(self, codes: np.ndarray) -> np.ndarray:
        """Hashes of all beginnings of one word."""
        h, out = 0, np.zeros(len(codes) + 1, "u8")
        for j, c in enumerate(codes.tolist(), 1):
            h = (h * MULTIPLIER + c + 1) % 2**64
            out[j] = h
        return out

    def _ending(self, prefix: np.ndarray, word: str, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Pieces or -1, and log probabilities, by length and by place of the end, a + 1 to b."""
        ids, logs = np.full((len(self.lengths), b - a), -1), np.full((len(self.lengths), b - a), -np.inf)
        for row, length in enumerate(self.lengths):
            j = np.arange(max(a + 1, length), b + 1)
            if not len(j):
                continue
            h = prefix[j] - prefix[j - length] * np.uint64(pow(MULTIPLIER, length, 2**64))
            place = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
            known = self.sorted[place] == h
            at = j - a - 1
            ids[row, at] = np.where(known, self.at[place], -1)
            logs[row, at] = np.where(known, self.logs[ids[row, at]], -np.inf)
            if length == 1:
                for k in at[~known].tolist():
                    logs[row, k] = self.logs[self.spelled(word[a + k])].sum()
        return ids, logs

    def _ahead(self, codes: np.ndarray, word: str, prefix: np.ndarray | None = None) -> np.ndarray:
        """The forward sums of one word, behind as many empty places as the longest piece has."""
        n, back = len(codes), self.lengths[-1] - np.array(self.lengths)
        prefix = self._prefixes(codes) if prefix is None else prefix
        ahead = np.full(self.lengths[-1] + n + 1, -np.inf)
        ahead[self.lengths[-1]] = 0
        for a in range(0, n, PLACES_AT_ONCE):
            _, logs = self._ending(prefix, word, a, min(n, a + PLACES_AT_ONCE))
            for k in range(logs.shape[1]):
                j = a + k + 1
                ahead[self.lengths[-1] + j] = np.logaddexp.reduce(ahead[back + j] + logs[:, k])
        return ahead

    def _add_long(self, total: np.ndarray, codes: np.ndarray, word: str, times: float) -> None:
        """Add the expected pieces of one long word, whose edges are made again going back."""
        n, off, back = len(codes), self.lengths[-1], self.lengths[-1] - np.array(self.lengths)
        prefix = self._prefixes(codes)
        ahead, behind = self._ahead(codes, word, prefix), np.full(off + n + 1, -np.inf)
        behind[-1] = 0
        for a in reversed(range(0, n, PLACES_AT_ONCE)):
            ids, logs = self._ending(prefix, word, a, min(n, a + PLACES_AT_ONCE))
            for k in reversed(range(logs.shape[1])):
                i = back + a + k + 1
                behind[i] = np.logaddexp(behind[i], behind[off + a + k + 1] + logs[:, k])
            ends = np.arange(a + 1, a + 1 + logs.shape[1])
            uses = times * np.exp(ahead[back[:, None] + ends] + logs + behind[off + ends] - ahead[-1])
            known = ids >= 0
            total += np.bincount(ids[known], uses[known], len(total))
            if self.lengths[0] == 1:
                for k in np.flatnonzero(~known[0]).tolist():
                    np.add.at(total, self.spelled(word[a + k]), uses[0, k])

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word over all its segmentations."""
        out = np.zeros(len(words))
        for members, codes in self._groups(words):
            if codes.shape[1] > LONG_WORD:
                out[members] = self._ahead(codes[0], words[members[0]])[-1]
                continue
            ahead = np.full((codes.shape[1] + 1, len(members)), -np.inf)
            ahead[0] = 0
            for i, j, _, logs in self.edges(codes, [words[m] for m in members]):
                ahead[j] = np.logaddexp(ahead[j], ahead[i] + logs)
            out[members] = ahead[-1]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece when the words stand so often."""
        total = np.zeros(len(self.logs))
        for members, codes in self._groups(words):
            mine = [words[m] for m in members]
            if codes.shape[1] > LONG_WORD:
                self._add_long(total, codes[0], mine[0], float(counts[members[0]]))
                continue
            held = list(self.edges(codes, mine))
            n, m = codes.shape[1], len(members)
            ahead, behind = np.full((n + 1, m), -np.inf), np.full((n + 1, m), -np.inf)
            ahead[0] = behind[n] = 0
            for i, j, _, logs in held:
                ahead[j] = np.logaddexp(ahead[j], ahead[i] + logs)
            for i, j, _, logs in reversed(held):
                behind[i] = np.logaddexp(behind[i], behind[j] + logs)
            times = counts[members]
            for i, j, ids, logs in held:
                uses = times * np.exp(ahead[i] + logs + behind[j] - ahead[n])
                known = ids >= 0
                total += np.bincount(ids[known], uses[known], len(total))
                if j - i == 1 and not known.all():
                    for r in np.flatnonzero(~known):
                        np.add.at(total, self.spelled(mine[r][i]), uses[r])
        return total


# --- packed tables --------------------------------------------------------------


def _packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _numbers(a: np.ndarray) -> bytes:
    """Small whole numbers, byte planes apart so that they compress well."""
    return _packed(np.ascontiguousarray(a.astype("<u4").view("u1").reshape(-1, 4).T).tobytes())


def _unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _unnumbered(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpacked(data), "u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype("i8")


BLOCKS = (
    "block long, n_words long, doc_ids binary, held binary, n_tokens binary, n_different binary, "
    "numbers binary, times binary, words binary, trained binary"
)


def _columns(shape: str) -> list[str]:
    return [c.split()[0] for c in shape.split(", ")]


def _block(number: int, docs: list[tuple], words: dict) -> dict:
    sizes, steps, times = [], [], []
    trained = np.zeros(len(words), "i8")
    for _, held, ids in docs:
        different, n = np.unique(np.array(ids, "i8"), return_counts=True)
        sizes.append(len(different))
        steps.append(np.diff(different, prepend=0))
        times.append(n)
        if not held:
            trained[different] += n
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, "i8")
    return {
        "block": number,
        "n_words": len(words),
        "doc_ids": _packed(json.dumps([None if d is None else str(d) for d, _, _ in docs]).encode()),
        "held": _numbers(np.array([h for _, h, _ in docs])),
        "n_tokens": _numbers(np.array([len(ids) + 1 for _, _, ids in docs])),
        "n_different": _numbers(np.array(sizes)),
        "numbers": _numbers(join(steps)),
        "times": _numbers(join(times)),
        "words": _packed(b" ".join(words)),
        "trained": _numbers(trained),
    }


def _pack_blocks(limit: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 24
        docs, words, size = [], defaultdict(), 0
        words.default_factory = words.__len__
        for frame in batches:
            for doc_id, text, held in zip(frame["doc_id"], frame["text"], frame["held"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass").lower()
                docs.append((doc_id, bool(held), [words[w] for w in data.split()]))
                size += len(data)
                if size >= limit:
                    yield pd.DataFrame([_block(number, docs, words)])
                    number, docs, words, size = number + 1, [], defaultdict(), 0
                    words.default_factory = words.__len__
        if docs:
            yield pd.DataFrame([_block(number, docs, words)])

    return run


ENTRIES = "part int, block long, words binary, trained binary, places binary"


def _split_words(parts: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples(index=False):
                words = _unpacked(row.words).split()
                trained = _unnumbered(row.trained)
                part = np.fromiter(map(zlib.crc32, words), "i8", len(words)) % parts
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                out = []
                for p in range(parts):
                    at = order[cuts[p] : cuts[p + 1]]
                    if len(at):
                        mine = b" ".join([words[i] for i in at.tolist()])
                        places = _numbers(np.diff(at, prepend=0))
                        out.append((p, row.block, _packed(mine), _numbers(trained[at]), places))
                yield pd.DataFrame(out, columns=_columns(ENTRIES))

    return run


#: One row of a part holds its words, the others what a block has of them.
MERGED = "part int, block long, words binary, trained binary, places binary, at binary, n_known long, n_trained long"


def _merge_words(frame: pd.DataFrame) -> pd.DataFrame:
    words: dict = defaultdict()
    words.default_factory = words.__len__
    rows, held = [], []
    part = int(frame["part"].iloc[0])
    for row in frame.itertuples(index=False):
        at = np.array([words[w] for w in _unpacked(row.words).split()], "i8")
        held.append((at, _unnumbered(row.trained)))
        rows.append((part, row.block, None, None, row.places, _numbers(at), 0, 0))
    trained = np.zeros(len(words), "i8")
    for at, n in held:
        trained[at] += n
    own = (part, None, _packed(b" ".join(words)), _numbers(trained), None, None, int((trained > 0).sum()), int(trained.sum()))
    return pd.DataFrame([own, *rows], columns=_columns(MERGED))


def _texts(words: bytes) -> list[str]:
    return [SPACE + w.decode("utf-8", "surrogatepass") for w in _unpacked(words).split()]


def _count_pieces(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, total = shared.value, np.zeros(len(shared.value.logs))
        for frame in batches:
            for row in frame.itertuples(index=False):
                trained = _unnumbered(row.trained)
                words = _texts(row.words)
                seen = np.flatnonzero(trained)
                total += pieces.expected([words[i] for i in seen.tolist()], trained[seen].astype("f8"))
        used = np.flatnonzero(total)
        yield pd.DataFrame({"piece": used, "n": total[used]})

    return run


VALUES = "block long, places binary, trained binary, logs binary"


def _score_words(shared):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame[frame["words"].notna()].iloc[0]
        trained, logs = _unnumbered(own["trained"]), shared.value.score(_texts(own["words"]))
        out = []
        for row in frame[frame["words"].isna()].itertuples(index=False):
            at = _unnumbered(row.at)
            out.append((row.block, row.places, _numbers(trained[at]), _packed(logs[at].astype("<f8").tobytes())))
        return pd.DataFrame(out, columns=_columns(VALUES))

    return run


def _add_up(n: int, v: int, ends: int, end_log: float):
    def run(docs: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block in docs.itertuples(index=False):
            trained, logs = np.zeros(block.n_words, "i8"), np.zeros(block.n_words)
            for row in values.itertuples(index=False):
                at = np.cumsum(_unnumbered(row.places))
                trained[at] = _unnumbered(row.trained)
                logs[at] = np.frombuffer(_unpacked(row.logs), "<f8")
            base = np.log10((trained + 1) / (n + v + 1))
            numbers, times = _unnumbered(block.numbers), _unnumbered(block.times)
            names = json.loads(_unpacked(block.doc_ids))
            held, tokens, sizes = (_unnumbered(x) for x in (block.held, block.n_tokens, block.n_different))
            at = 0
            for name, h, k, size in zip(names, held.tolist(), tokens.tolist(), sizes.tolist(), strict=True):
                mine, often = np.cumsum(numbers[at : at + size]), times[at : at + size]
                at += size
                known = int(often[trained[mine] > 0].sum()) + (ends > 0)
                base_score = float(often @ base[mine]) + math.log10((ends + 1) / (n + v + 1))
                score = (float(often @ logs[mine]) + end_log) / math.log(10)
                out.append((name, bool(h), k, known, n, base_score, score))
        return pd.DataFrame(out, columns=_columns(SCORED))

    return run


SCORED = (
    "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


# --- the operator ------------------------------------------------------------------


def score(docs: DataFrame, held_out: Column, path: str = PIECES_FILE, rounds: int = ROUNDS) -> DataFrame:
    """Score all texts with a model of those that are not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score:
    the log10 probability under the add-one model of whole words, and under the
    pieces.
    """
    spark = docs.sparkSession
    # ids travel as text, since null ones would turn whole numbers into doubles
    given = docs.select(F.col("doc_id").cast("string"), "text", held_out.alias("held"))
    blocks = materialise(given.mapInPandas(_pack_blocks(BLOCK_BYTES), BLOCKS))
    listed = blocks.agg(F.sum("n_words")).first()[0] or 0
    parts = max(1, math.ceil(listed / PART_WORDS))
    entries = blocks.select("block", "words", "trained").mapInPandas(_split_words(parts), ENTRIES)
    merged = materialise(entries.groupBy("part").applyInPandas(_merge_words, MERGED))
    known, words = merged.agg(F.sum("n_known"), F.sum("n_trained")).first()
    ends = given.filter(~F.col("held")).count()
    n, v = (words or 0) + ends, (known or 0) + (ends > 0)

    pieces = Pieces.start(vocabulary(path))
    dictionary = merged.filter(F.col("words").isNotNull()).select("words", "trained")
    for _ in range(rounds if ends else 0):
        shared = spark.sparkContext.broadcast(pieces)
        counted = dictionary.mapInPandas(_count_pieces(shared), "piece int, n double")
        total = np.full(len(pieces.logs), SMOOTHING)
        for row in counted.groupBy("piece").agg(F.sum("n").alias("n")).collect():
            total[row["piece"]] += row["n"]
        total[-1] += ends
        pieces = Pieces(pieces.texts, np.log(total / total.sum()))
    shared = spark.sparkContext.broadcast(pieces)
    values = merged.groupBy("part").applyInPandas(_score_words(shared), VALUES)
    add_up = _add_up(n, v, ends, float(pieces.logs[-1]))
    scored = blocks.groupBy("block").cogroup(values.groupBy("block")).applyInPandas(add_up, SCORED)
    return scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
