"""Language identification and lattice likelihood."""

import copy
import itertools
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimflow.llm import common, langid, lattice
from claimflow.llm.common import fold_of
from tests.llm.data import documents, words_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit_on_folds(common.read(spark, SF, "documents"))


def test_held_out_accuracy(spark, model):
    docs = common.read(spark, SF, "documents").filter(common.fold(F.col("doc_id"), 4) == 2)
    found = langid.classify(docs, model).toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.98
    assert not found["rejected"].any()
    assert found["score"].between(0, 1).all()


def test_foreign_text_is_rejected(spark, model):
    texts = ["zxqj kvwpy " * 30, "привет как дела " * 10, "the of and " * 20, None, "12 !?", "漢字 " * 40]
    got = langid.predict(model, texts)
    assert got["rejected"].tolist() == [True, True, False, True, True, True]
    assert got["lang_pred"].tolist()[2:5] == ["en", "und", "und"]


def test_language_left_out_is_rejected(spark):
    docs = common.read(spark, SF, "documents")
    without = langid.fit_on_folds(docs.filter("lang != 'de'"))
    foreign = langid.classify(docs.filter("lang = 'de'"), without).toPandas()
    assert foreign["rejected"].mean() > 0.95
    clean = docs.filter("lang != 'de'").filter(common.fold(F.col("doc_id"), 4) == 2)
    assert langid.classify(clean, without).toPandas()["rejected"].mean() < 0.01


def test_kneser_ney_sums_to_one():
    counts = Counter()
    for word in ["abba", "abc", "cab", "b", "bab"]:
        marked = langid.BEGIN * 4 + word + langid.FINISH
        for i in range(len(word) + 1):
            counts[marked[i : i + 5]] += 1
    frame = pd.DataFrame({"lang": "x", "gram": list(counts), "n": list(counts.values())})
    built = langid.build(frame)
    letters = ["a", "b", "c", langid.FINISH]
    for context in ["\x02\x02\x02\x02", "\x02\x02ab", "abba"[:4], "\x02cab", "bbbb"]:
        codes = np.array([ord(c) for c in "".join(context + x for x in letters)], "u8")
        logs = built.grams(codes, np.arange(4, len(codes), 5))[:, 0]
        unseen = built.grams(np.array([ord(c) for c in context + "q"], "u8"), np.array([4]))[0, 0]
        assert np.exp2(logs).sum() + np.exp2(unseen) * (langid.ALPHABET - 4) == pytest.approx(1, rel=1e-5)


def test_long_texts_are_cut_between_words(monkeypatch):
    text = "Abc défg h1i " * 50
    whole = langid.words(text)
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert langid.words(text) == whole


def test_language_of_odd_documents(spark, model):
    docs = documents(spark)
    found = langid.classify(docs, model)
    assert found.count() == docs.count()
    assert [c for c in found.columns if c in ("score", "rejected")] == ["score", "rejected"]
    none = langid.fit_on_folds(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in langid.classify(docs, none).collect()} == {"und"}
    assert langid.classify(docs.limit(0), model).count() == 0


def brute_log(pieces, word):
    """All segmentations, spelled out."""
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for i, c in enumerate([*cuts, 1], 1):
            if c:
                parts.append(word[start:i])
                start = i
        p = 0.0
        for part in parts:
            if part in pieces.number:
                p += pieces.logs[pieces.number[part]]
            elif len(part) == 1:
                p += sum(pieces.logs[i] for i in pieces.spelled(part))
            else:
                p = -math.inf
        total += math.exp(p)
    return math.log(total)


@pytest.fixture(scope="module")
def pieces():
    texts = ["▁", "a", "b", "ab", "ba", "▁a", "▁ab", "abb", *[f"<0x{b:02X}>" for b in range(256)]]
    return lattice.Pieces.start(texts)


def test_forward_sums_over_all_segmentations(pieces):
    words = ["▁a", "▁ab", "▁abba", "▁abéba", "▁zz", "▁" + "ab" * 5, "▁漢"]
    assert pieces.score(words) == pytest.approx([brute_log(pieces, w) for w in words])
    long = "▁" + "ab" * 40
    assert np.isfinite(pieces.score([long])).all()


def test_expected_counts_match_the_gradient(pieces):
    words, counts = ["▁abba", "▁aéb", "▁" + "ab" * 30], np.array([2.0, 1.0, 3.0])
    got = pieces.expected(words, counts)
    for i in [0, 1, 3, 7, 8 + 0xC3]:
        up = lattice.Pieces(pieces.texts, pieces.logs + 1e-5 * (np.arange(len(pieces.logs)) == i))
        slope = (counts @ up.score(words) - counts @ pieces.score(words)) / 1e-5
        assert got[i] == pytest.approx(slope, abs=1e-3)


def test_long_words_take_the_same_sums_in_little_memory(pieces, monkeypatch):
    words, counts = ["▁" + "abbaé漢b" * 30, "▁" + "ab" * 40, "▁zz" * 50], np.array([2.0, 1.0, 3.0])
    monkeypatch.setattr(lattice, "PLACES_AT_ONCE", 7, raising=False)
    one = pieces.score(words), pieces.expected(words, counts)
    monkeypatch.setattr(lattice, "LONG_WORD", 1_000)
    assert one[0] == pytest.approx(pieces.score(words), rel=1e-12)
    assert one[1] == pytest.approx(pieces.expected(words, counts), rel=1e-9, abs=1e-12)
    monkeypatch.undo()
    tracemalloc.start()
    pieces.expected(["▁" + "ab" * 10_000], np.array([1.0]))
    assert tracemalloc.get_traced_memory()[1] < 5_000_000
    tracemalloc.stop()


def test_scores_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK_BYTES", 500)
    monkeypatch.setattr(lattice, "PART_WORDS", 40)
    rng = random.Random(4)
    rows = [(i, words_of(rng, rng.randint(0, 40), "aBé")) for i in range(60)]
    rows += [(None, "no id"), (7, None), (8, ""), (9, "x" * 300), (10, rows[1][1]), (10, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lattice.score(docs, common.fold(F.col("doc_id"), 7) == 2, rounds=1).collect()
    seen = Counter()
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    for i, t in rows:
        if fold_of(i, 7) != 2:
            seen.update(tokens(t))
    n, v = sum(seen.values()), len(seen)
    expected = sorted(
        (str(i), fold_of(i, 7) == 2, len(tokens(t)), sum(seen[w] > 0 for w in tokens(t)), n,
         round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in tokens(t)), 6))
        for i, t in rows
    )
    got = sorted(
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found
    )
    assert got == expected
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_training_raises_the_likelihood(spark):
    docs = common.read(spark, "/root/testdata/sf0.001", "documents")
    held = common.fold(F.col("doc_id"), 7) == 2
    totals = [lattice.score(docs, held, rounds=r).filter("held_out").agg(F.sum("score")).first()[0] for r in (0, 1)]
    assert totals[1] > totals[0]


def test_scores_of_nothing_and_no_training(spark):
    docs = documents(spark)
    assert lattice.score(docs.limit(0), F.lit(False)).count() == 0
    rows = lattice.score(docs, F.lit(True)).collect()
    assert len(rows) == docs.count() and {r["n_known"] for r in rows} == {0}


def test_ids_with_line_breaks_and_empty_ones(spark):
    ids = ["a\nb", "", None, "\n", '"', "c"]
    docs = spark.createDataFrame([(i, f"some words {n}") for n, i in enumerate(ids)], "doc_id string, text string")
    got = [r["doc_id"] for r in lattice.score(docs, F.lit(False), rounds=0).collect()]
    assert sorted(got, key=str) == sorted(ids, key=str)


def test_sample_does_not_hang_on_copies(spark):
    """Three quarters of all rows share one text."""
    copies = spark.range(30_000).selectExpr("id AS doc_id", "'one licence text' AS text", "'en' AS lang")
    others = spark.range(10_000).selectExpr("-1 - id AS doc_id", "concat('text ', id) AS text", "'en' AS lang")
    drawn = langid.sample(copies.unionByName(others), 2000)
    n, alike = drawn.agg(F.count(F.lit(1)), F.sum((F.col("text") == "one licence text").cast("int"))).first()
    assert 1700 < n < 2300 and 1200 < alike < 1700


def test_limits_do_not_hang_on_copies(model, spark):
    """A text that most rows share is one of many where limits are set."""
    docs = common.read(spark, SF, "documents").filter("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").distinct().orderBy("text").limit(200)
    copies = docs.orderBy("text").limit(1).crossJoin(spark.range(3000)).select("text", "lang")
    plain = langid.calibrate(copy.deepcopy(model), docs).limit.tolist()
    assert langid.calibrate(copy.deepcopy(model), docs.unionByName(copies)).limit.tolist() == pytest.approx(plain)


def test_texts_are_taken_by_their_size(monkeypatch):
    monkeypatch.setattr(langid, "CHARACTERS_AT_ONCE", 10)
    texts = pa.array(["a" * 4, None, "b" * 6, "c" * 50, "", "d" * 10, "e"])
    assert list(langid._portions(texts)) == [(0, 3), (3, 1), (4, 2), (6, 1)]
    assert list(langid._portions(texts.slice(0, 0))) == []


def test_fitting_holds_a_portion_and_not_a_batch(monkeypatch):
    monkeypatch.setattr(langid, "CHARACTERS_AT_ONCE", 10)
    asked = []

    class Recorder:
        languages = ["a", "b"]

        def entropies(self, texts):
            asked.append(len(texts))
            return np.array([[float(len(t)), 1.0] for t in texts]).reshape(-1, 2), np.array([len(t) for t in texts], "i8")

    batch = pa.record_batch({"text": ["abcd"] * 7 + ["", "x y"], "lang": ["a", "b", "c"] * 3})
    got = pa.Table.from_batches(langid._measure(Recorder(), [batch])).to_pydict()
    assert got == {"lang": ["a", "b"] * 2 + ["a"], "bits": [4.0, 1.0] * 2 + [4.0], "letters": [4] * 5}
    assert max(asked) <= 2
    counted = pa.Table.from_batches(langid._count_words([batch])).group_by(["lang", "word"]).aggregate([("n", "sum")])
    assert sorted(zip(*counted.to_pydict().values(), strict=True)) == [
        ("a", "abcd", 3), ("b", "abcd", 2), ("c", "abcd", 2), ("c", "x", 1), ("c", "y", 1),
    ]
