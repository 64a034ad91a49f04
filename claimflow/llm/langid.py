"""Language identification by character language models, one for each language.

Each model is an interpolated Kneser-Ney model of order five over the letters of
lower-cased words, with marks for a word's start and end. Seen n-grams hold their
interpolated probability and their back-off weight; all languages share one array of
sorted n-gram hashes for each order, searched by bisection. A text gets the language
whose cross-entropy per letter is lowest. It is rejected if it has no letters, or if
that cross-entropy is more than a margin above a high quantile of what labelled texts
of the language show, with an allowance that shrinks with the number of letters; the
limit is fitted on labelled rows that the n-gram counts have not seen. A language
without such rows takes a code of equally likely letters in place of the quantile.

Fitting takes at most about ``sample_rows`` labelled rows for each language, chosen
by a hash of the row, so the model has a bound that does not grow with the data; it
is counted by Spark and only n-gram counts of that sample reach the driver. Every
text is then scored whole, in one pass without a shuffle.

Defined cases: a null text, and a text without letters, is ``und`` with score 0 and
rejected; with no labelled rows at all every text is ``und``; languages that score
alike go to the first in code point order; repeated rows get equal results; columns
named like those added are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import fold

ORDER = 5
SAMPLE_ROWS = 2_000
UNKNOWN = "und"
BEGIN, FINISH = "\x02", "\x03"
#: Letters a model knows nothing about share what is left over as if there were so many.
ALPHABET = 65_536
#: The quantile of unseen labelled texts that sets the limit, bits per letter above it
#: at which a text is rejected, and standard deviations of a mean over its letters that
#: are allowed besides.
QUANTILE = 0.99
MARGIN_BITS = 1.5
DEVIATIONS = 4
LETTERS_FOR_SCORE = 32
CHUNK = 1 << 20
CHARACTERS_AT_ONCE = 600_000

WORD = re.compile(r"[^\W\d_]+")
RESULT = "lang_pred string, score double, cross_entropy double, letters long, rejected boolean"


def words(text: str | None) -> Counter:
    """The lower-cased words of letters in a text, counted; long texts go piece by piece."""
    found: Counter = Counter()
    at, n = 0, len(text or "")
    while at < n:
        end = min(n, at + CHUNK)
        while end < n and text[end - 1].isalpha():
            end += 1
        found.update(WORD.findall(text[at:end].lower()))
        at = end
    return found


def _codes(listed: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words with their marks, and the positions to score."""
    joined = "".join([BEGIN * (ORDER - 1) + w + FINISH for w in listed])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    return codes, np.flatnonzero(codes != ord(BEGIN))


def gram_hashes(codes: np.ndarray, at: np.ndarray, length: int, back: int = 0) -> np.ndarray:
    """Hashes of the n-grams that end ``back`` places before each position."""
    h = np.full(len(at), length, "u8")
    for i in range(length - 1, -1, -1):
        h = (h ^ codes[at - back - i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


@dataclass
class Model:
    """Languages with, for each order, sorted hashes, log2 probabilities and back-offs."""

    languages: list[str]
    keys: list[np.ndarray] = field(default_factory=list)
    probability: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    floor: np.ndarray = field(default_factory=lambda: np.zeros(0))
    limit: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _find(self, order: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys[order - 1]
        if not len(keys):
            return np.zeros(len(hashes), int), np.zeros(len(hashes), bool)
        place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return place, keys[place] == hashes

    def grams(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log2 probability of the letter at each position, in every language."""
        value = np.tile(self.floor, (len(at), 1))
        for order in range(1, ORDER + 1):
            if order > 1:
                place, known = self._find(order - 1, gram_hashes(codes, at, order - 1, back=1))
                value += np.where(known[:, None], self.backoff[order - 2][place], 0.0)
            place, known = self._find(order, gram_hashes(codes, at, order))
            seen = self.probability[order - 1][place]
            value = np.where(known[:, None] & ~np.isnan(seen), seen, value)
        return value

    def score_words(self, listed: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """log2 probability of each word in every language, and its letters with the end mark."""
        if not listed:
            return np.zeros((0, len(self.languages))), np.zeros(0, "i8")
        codes, at = _codes(listed)
        _, first, same = np.unique(gram_hashes(codes, at, ORDER), return_index=True, return_inverse=True)
        each = self.grams(codes, at[first])[same]
        lengths = np.array([len(w) + 1 for w in listed])
        return np.add.reduceat(each, np.cumsum(lengths) - lengths), lengths

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per letter of each text in every language, and its letters."""
        counted = [words(t) for t in texts]
        number: dict[str, int] = {}
        for c in counted:
            for w in c:
                number.setdefault(w, len(number))
        value, lengths = self.score_words(list(number))
        total, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), "i8")
        for i, c in enumerate(counted):
            if c:
                ids = np.fromiter((number[w] for w in c), "i8", len(c))
                n = np.fromiter(c.values(), "f8", len(c))
                total[i] = n @ value[ids]
                letters[i] = int(n @ lengths[ids])
        return -total / np.maximum(letters, 1)[:, None], letters


def _log2(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log2(x)


def kneser_ney(grams: pd.DataFrame) -> tuple[list[pd.DataFrame], float]:
    """Probabilities and back-offs of every order, from counts of the highest order.

    ``grams`` has gram and n. The counts below the highest order are numbers of
    distinct left neighbours, as the method asks for. Returns one table (gram,
    probability, backoff) for each order, and the floor of an unseen letter.
    """
    levels = [grams]
    for _ in range(ORDER - 1):
        shorter = levels[-1]["gram"].str[1:]
        levels.append(shorter.to_frame("gram").groupby("gram", as_index=False).size().rename(columns={"size": "n"}))
    levels.reverse()
    lower: pd.Series | None = None
    tables, floor = [], 0.0
    for level in levels:
        once, twice = int((level["n"] == 1).sum()), int((level["n"] == 2).sum())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        context = level["gram"].str[:-1]
        by = level.assign(context=context).groupby("context")["n"]
        total, distinct = by.transform("sum"), by.transform("size")
        rest = discount * distinct / total
        below = 1 / ALPHABET if lower is None else level["gram"].str[1:].map(lower).to_numpy()
        probability = (level["n"] - discount) / total + rest * below
        if lower is None:
            floor = float(_log2(rest.iloc[0] / ALPHABET))
        else:
            weights = pd.Series(rest.to_numpy(), index=context).groupby(level=0).first()
            tables[-1] = tables[-1].assign(backoff=_log2(tables[-1]["gram"].map(weights).fillna(1.0).to_numpy()))
            # contexts made of start marks alone are never predicted, only looked up
            missing = weights[~weights.index.isin(tables[-1]["gram"])]
            extra = pd.DataFrame({"gram": missing.index, "probability": np.nan, "backoff": _log2(missing.to_numpy())})
            tables[-1] = pd.concat([tables[-1], extra], ignore_index=True) if len(extra) else tables[-1]
        lower = pd.Series(probability.to_numpy(), index=level["gram"])
        tables.append(pd.DataFrame({"gram": level["gram"], "probability": _log2(probability.to_numpy()), "backoff": 0.0}))
    return tables, floor


def build(counts: pd.DataFrame) -> Model:
    """The models from counts (lang, gram, n) of the highest order."""
    languages = sorted(counts["lang"].unique())
    per = [kneser_ney(counts.loc[counts["lang"] == lang, ["gram", "n"]]) for lang in languages]
    model = Model(languages, floor=np.array([f for _, f in per]))
    for order in range(1, ORDER + 1):
        parts = [tables[order - 1] for tables, _ in per]
        texts = pd.Index(np.unique(np.concatenate([p["gram"].to_numpy(object) for p in parts]))) if parts else pd.Index([])
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
        hashes = gram_hashes(codes, np.arange(order - 1, len(codes), order), order)
        by_hash = np.argsort(hashes)
        probability = np.full((len(texts), len(languages)), np.nan, "f4")
        backoff = np.zeros((len(texts), len(languages)), "f4")
        for i, p in enumerate(parts):
            at = texts.get_indexer(p["gram"])
            probability[at, i], backoff[at, i] = p["probability"], p["backoff"]
        model.keys.append(hashes[by_hash])
        model.probability.append(probability[by_hash])
        model.backoff.append(backoff[by_hash])
    return model


def sample(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of each language, or all, chosen by a hash of text and id.

    Copies of one text are drawn one by one, so a text that most rows share fills no more
    than its share of the sample. Rows that repeat both text and id go together; what is
    counted of the sample does not grow with repeats, see ``calibrate``.
    """
    counted = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counted:
        return labelled
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counted.items()) for x in (lang, min(1.0, rows / n))])
    drawn = F.pmod(F.xxhash64(*labelled.columns), F.lit(1_000_003)) / 1_000_003
    return labelled.filter(drawn < F.element_at(share, F.col("lang")))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches, "text"):
        found: dict[str, Counter] = {}
        for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
            found.setdefault(lang, Counter()).update(words(text))
        for lang, counted in found.items():
            columns = [pa.array([lang] * len(counted), pa.string()), pa.array(list(counted), pa.string()), pa.array(counted.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        for lang, part in frame.groupby("lang"):
            found: Counter = Counter()
            for word, n in zip(part["word"], part["n"], strict=True):
                marked = BEGIN * (ORDER - 1) + word + FINISH
                for i in range(len(word) + 1):
                    found[marked[i : i + ORDER]] += n
            yield pd.DataFrame({"lang": lang, "gram": list(found), "n": list(found.values())})


def fit(labelled: DataFrame, unseen: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Models from ``labelled`` (text, lang), limits from ``unseen`` (text, lang).

    An id, ``doc_id``, tells rows with one text apart as they are drawn, and is used for
    nothing else.
    """
    given = ["doc_id", "text", "lang"] if "doc_id" in labelled.columns and "doc_id" in unseen.columns else ["text", "lang"]
    rows = sample(labelled.select(*given).dropna(subset=["text", "lang"]), sample_rows)
    counted = rows.select("text", "lang").mapInArrow(_count_words, "lang string, word string, n long")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    grams = counted.mapInPandas(_count_grams, "lang string, gram string, n long")
    model = build(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    return calibrate(model, sample(unseen.select(*given).dropna(subset=["text", "lang"]), sample_rows).select("text", "lang"))


def fit_on_folds(docs: DataFrame, folds: int = 4, held_out: int = 2, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on labelled rows outside one fold: counts from the folds below it, limits from those above."""
    at = fold(F.col("doc_id"), folds)
    return fit(docs.filter(at < held_out), docs.filter(at > held_out), sample_rows)


def _measure(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches, "text"):
        known = part.filter(pc.is_in(part.column("lang"), pa.array(model.languages, pa.string())))
        langs = known.column("lang").to_pylist()
        bits, letters = model.entropies(known.column("text").to_pylist())
        own = bits[np.arange(len(langs)), [model.languages.index(x) for x in langs]].round(9)
        columns = [pa.array(langs, pa.string()), pa.array(own, pa.float64()), pa.array(letters, pa.int64())]
        measured = pa.RecordBatch.from_arrays(columns, ["lang", "bits", "letters"])
        yield measured.filter(pc.greater(measured.column("letters"), 0))


def calibrate(model: Model, unseen: DataFrame) -> Model:
    """Set each language's limit of cross-entropy, and its spread per letter."""
    # equal texts measure alike and count once: neither do they rule the quantile, nor
    # does their number reach the driver
    got = unseen.mapInArrow(lambda batches: _measure(model, batches), "lang string, bits double, letters long").distinct()
    got = got.toPandas() if model.languages else pd.DataFrame({"lang": [], "bits": [], "letters": []})
    limits, spreads = [], []
    for i, lang in enumerate(model.languages):
        mine = got[got["lang"] == lang]
        spread, usual = 0.0, math.log2(max(2, np.count_nonzero(~np.isnan(model.probability[0][:, i]))))
        if len(mine):
            middle = float(mine["bits"].median())
            spread = 1.5 * float(((mine["bits"] - middle).abs() * np.sqrt(mine["letters"])).median())
            usual = float((mine["bits"] - DEVIATIONS * spread / np.sqrt(mine["letters"])).quantile(QUANTILE))
        limits.append(usual + MARGIN_BITS)
        spreads.append(spread)
    model.limit, model.spread = np.array(limits), np.array(spreads)
    return model


def predict(model: Model, texts: list[str | None]) -> pd.DataFrame:
    """Language, score, cross-entropy, letters and rejection of each text."""
    n = len(texts)
    if not model.languages:
        letters = [sum((len(w) + 1) * c for w, c in words(t).items()) for t in texts]
        return pd.DataFrame(
            {"lang_pred": UNKNOWN, "score": 0.0, "cross_entropy": None, "letters": letters, "rejected": True},
            index=range(n),
        )
    bits, letters = model.entropies(texts)
    best = bits.argmin(axis=1)
    lowest = bits[np.arange(n), best]
    scale = np.minimum(letters, LETTERS_FOR_SCORE)[:, None]
    score = 1 / np.exp2((lowest[:, None] - bits) * scale).sum(axis=1)
    empty = letters == 0
    allowed = model.limit[best] + DEVIATIONS * model.spread[best] / np.sqrt(np.maximum(letters, 1))
    names = np.array(model.languages, object)[best]
    return pd.DataFrame(
        {
            "lang_pred": np.where(empty, UNKNOWN, names),
            "score": np.where(empty, 0.0, score),
            "cross_entropy": np.where(empty, np.nan, lowest),
            "letters": letters,
            "rejected": empty | (lowest > allowed),
        }
    )


def _portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and number of texts taken at once: so many characters, or one text of more."""
    sizes, at, held = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).tolist(), 0, 0
    for i, size in enumerate(sizes):
        if i > at and held + size > CHARACTERS_AT_ONCE:
            yield at, i - at
            at, held = i, 0
        held += size
    if at < len(sizes):
        yield at, len(sizes) - at


def _parts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches in portions, so that what Python holds of them is not as large as a batch."""
    for batch in batches:
        for at, n in _portions(batch.column(text)):
            yield batch.slice(at, n)


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with lang_pred, score, cross_entropy, letters, rejected."""
    added = [c.split()[0] for c in RESULT.split(", ")]
    kept = [c for c in docs.columns if c.lower() not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, text):
            found = pa.RecordBatch.from_pandas(predict(shared.value, part.column(text).to_pylist()), preserve_index=False)
            yield pa.RecordBatch.from_arrays([*part.columns, *found.columns], [*kept, *added])

    shape = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind in (c.split() for c in RESULT.split(", ")):
        shape = shape.add(name, kind)
    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, shape)
