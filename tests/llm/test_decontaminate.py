"""Winnowing against a plain search for every window."""

import hashlib
import random

import pytest

from claimflow.llm import decontaminate
from tests.llm.data import documents, words_of


def brute(docs, items, window):
    split = lambda t: decontaminate_words(t or "")
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = split(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def decontaminate_words(text):
    import re

    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@pytest.mark.parametrize("window,gram", [(13, 6), (5, 3), (4, 6), (1, 1)])
def test_like_plain_search(spark, window, gram):
    rng = random.Random(window)
    docs = [(i, words_of(rng, rng.randint(0, 80), "aB")) for i in range(60)]
    items = [(i % 9, " ".join(rng.choice(docs)[1].split()[3 : 3 + rng.randint(0, 20)])) for i in range(14)]
    items += [(None, docs[0][1]), (7, None), (8, "?!"), (9, "É,é;x"), (9, "b")]
    docs += [(100, None), (100, ""), (None, docs[1][1]), (101, "é É X " * 3), (102, docs[0][1]), (102, docs[0][1])]
    given = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(given, bench, window, gram).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, window)


def test_odd_documents_and_empty_tables(spark):
    docs = documents(spark)
    bench = spark.createDataFrame([(1, "the lazy dog")], "item_id long, text string")
    judged = decontaminate.contamination(docs, bench)
    assert judged.count() == docs.count()
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, 2, 3, 4, 5, 6, 7, 8}
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
