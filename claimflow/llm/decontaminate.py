"""Benchmark decontamination by winnowed fingerprints.

A window is so many words of an item in a row (an item of fewer words is one window).
On both sides every window is represented by the smallest hash among its k-grams, so
two equal windows always meet; windows in a row with the same smallest hash are one
fingerprint. Fingerprints of documents are joined to those of the items, and a hit is
extended to the windows it stands for, which are compared word by word. So every
shared span of a window's length is found, and none that only shares a hash.

Everything is array functions and joins. A fingerprint carries the few words it
stands for, so texts are read once for the search and never shuffled; only words of
hits travel. The table of item fingerprints is broadcast where it was counted to be
small, else joined by a shuffle. A passage that very many documents share costs one
row in each document; windows are equated one to one with the distinct windows of
all items, so no pairs of documents or of items arise.

Defined cases: a null text has no words; items without words have no windows; an item
without id counts as an item with an empty id, and rows of one item id are one item;
documents are told apart by id and text, so repeated rows get equal results; without
documents the result is empty, without items nothing is hit; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import PLAIN_WORD, ascii_lower, broadcast_if_small
from claimflow.session import materialise

WINDOW_WORDS = 13
GRAM_WORDS = 6
#: Rows of texts that may be copied to every executor.
BROADCAST_WINDOWS = 200_000


def word_list(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.regexp_extract_all(F.coalesce(ascii_lower(text), F.lit("")), F.lit(PLAIN_WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """How many words a text has."""
    return F.coalesce(F.regexp_count(text, F.lit(PLAIN_WORD)), F.lit(0)).cast("long")


def fingerprints(df: DataFrame, words: int, gram: int = GRAM_WORDS) -> DataFrame:
    """Winnowed fingerprints of texts given as ``_words``.

    Adds hash, first and last (windows it stands for, from 0) and span, their words.
    Texts of fewer than ``words`` words have none.
    """
    gram = min(gram, words)
    kept = [c for c in df.columns if c != "_words"]
    grams = F.transform(
        F.sequence(F.lit(0), F.size("_words") - gram),
        lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(gram)]),
    )
    hashed = df.select(*kept, "_words", F.when(F.size("_words") >= words, grams).alias("_least"))
    width = words - gram + 1
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        shifted = F.slice("_least", step + 1, F.size("_least"))
        hashed = hashed.withColumn("_least", F.zip_with("_least", shifted, lambda a, b: F.least(a, b)))
        covered += step
    hashed = hashed.withColumn("_windows", F.size("_words") - (words - 1))
    begins = F.filter(
        F.sequence(F.lit(0), F.col("_windows") - 1),
        lambda i: (i == 0) | (F.get("_least", i) != F.get("_least", i - 1)),
    )
    begun = hashed.withColumn("_begins", F.when(F.col("_windows") > 0, begins))

    def marked(first: Column, at: Column) -> Column:
        last = F.coalesce(F.get("_begins", at + 1), F.col("_windows")) - 1
        return F.struct(
            F.get("_least", first).alias("hash"),
            first.alias("first"),
            last.alias("last"),
            F.array_join(F.slice("_words", first + 1, last - first + words), " ").alias("span"),
        )

    return begun.select(*kept, F.explode(F.transform("_begins", marked)).alias("_f")).select(*kept, "_f.*")


def spelled_out(marked: DataFrame, words: int) -> DataFrame:
    """Each fingerprint's windows: their place ``at`` and ``window``, the words."""
    kept = [c for c in marked.columns if c not in ("hash", "first", "last", "span")]
    split = marked.withColumn("_span", F.split("span", " "))
    each = F.transform(
        F.sequence(F.lit(0), F.col("last") - F.col("first")),
        lambda j: F.struct(
            (F.col("first") + j).alias("at"), F.array_join(F.slice("_span", j + 1, words), " ").alias("window")
        ),
    )
    return split.select(*kept, F.explode(each).alias("_w")).select(*kept, "_w.*")


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> tuple[DataFrame, DataFrame]:
    """Windows of items met in documents, and the windows of all items.

    ``docs`` has doc_id, text_hash and text, ``items`` has item_id and text. Returns
    (doc_id, text_hash, at, words, window) and (words, window, item_id).
    """
    split = materialise(items.select("item_id", word_list(F.col("text")).alias("_words")).filter(F.size("_words") > 0))
    lengths = [r[0] for r in split.select(F.least(F.size("_words"), F.lit(window))).distinct().collect()]
    listed = docs.select("doc_id", "text_hash", word_list(F.col("text")).alias("_words"))
    found, known = [], []
    for n in sorted(lengths):
        mine = split.filter(F.size("_words") >= n if n == window else F.size("_words") == n)
        marked = materialise(fingerprints(mine, n, gram))
        prints = broadcast_if_small(marked.select("hash").distinct())
        spelled = spelled_out(marked, n).select(F.lit(n).alias("words"), "window", "item_id").distinct()
        known.append(spelled)
        candidates = fingerprints(listed, n, gram).join(prints, "hash")
        found.append(spelled_out(candidates, n).withColumn("words", F.lit(n)))
    if not lengths:
        empty = docs.select("doc_id", "text_hash", F.lit(0).alias("at"), F.lit(0).alias("words"), F.lit("").alias("window"))
        none = items.select(F.lit(0).alias("words"), F.lit("").alias("window"), "item_id")
        return empty.limit(0), none.limit(0)
    windows, met = known[0], found[0]
    for w, m in zip(known[1:], found[1:], strict=True):
        windows, met = windows.unionByName(w), met.unionByName(m)
    windows = materialise(windows)
    exact = broadcast_if_small(windows.select("words", "window").distinct(), BROADCAST_WINDOWS)
    met = met.join(exact, ["words", "window"]).select("doc_id", "text_hash", "at", "words", "window")
    return materialise(met), windows


def _covered(spans: Column) -> Column:
    """Words inside at least one of the sorted spans (from, to)."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))

    def grow(seen: Column, s: Column) -> Column:
        new = F.greatest(s["to"] - F.greatest(s["from"], seen["upto"]), F.lit(0))
        return F.struct(F.greatest(seen["upto"], s["to"]).alias("upto"), (seen["n"] + new).alias("n"))

    return F.aggregate(spans, start, grow, lambda seen: seen["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> DataFrame:
    """How much of each document stands in items.

    Returns doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated: a
    document is contaminated if at least one word in twenty is inside a window of an
    item.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    met, windows = hits(docs, items.select("item_id", "text"), window, gram)
    span = F.struct(F.col("at").alias("from"), (F.col("at") + F.col("words")).alias("to"))
    spans = met.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(span)).alias("_spans"))
    per_doc = spans.select(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_hash"), _covered(F.col("_spans")).alias("_hit")
    )
    named = broadcast_if_small(
        windows.select("words", "window", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("_item")).distinct(),
        BROADCAST_WINDOWS,
    )
    pairs = met.select("doc_id", "text_hash", "words", "window").distinct().join(named, ["words", "window"])
    pairs = pairs.select("doc_id", "text_hash", "_item").distinct()
    per_items = pairs.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("_item")).alias("_items"))
    per_items = per_items.select(F.col("doc_id").alias("_doc_id2"), F.col("text_hash").alias("_hash2"), "_items")
    base = docs.select("doc_id", "text_hash", word_count(F.col("text")).alias("n_words"))
    same = base["doc_id"].eqNullSafe(per_doc["_doc_id"]) & (base["text_hash"] == per_doc["_hash"])
    also = base["doc_id"].eqNullSafe(per_items["_doc_id2"]) & (base["text_hash"] == per_items["_hash2"])
    joined = base.join(per_doc, same, "left").join(per_items, also, "left")
    n_hit = F.coalesce("_hit", F.lit(0)).cast("long")
    items_ = F.coalesce("_items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "text_hash",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> DataFrame:
    """The rows whose text is not contaminated, all columns kept."""
    judged = contamination(docs.select("doc_id", "text"), items, window, gram).filter("contaminated")
    found = judged.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_doc_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))
    return docs.join(broadcast_if_small(found), same, "left_anti")
