"""Repeated strings against a count of every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from claimflow.llm import suffix
from tests.llm.data import documents, words_of


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts_with_repeats(rng):
    base = [words_of(rng, rng.randint(0, 120), "abcdé") for _ in range(25)]
    shared = words_of(rng, 40, "xyz")
    texts = list(base)
    for t in base:
        cut = rng.randint(0, len(t))
        texts.append(t[:cut] + rng.choice(["", "Q", shared]) + t[cut:])
        texts.append(words_of(rng, 6, "klm") + shared + words_of(rng, 6, "nop"))
    return [*texts, None, "", "a" * 500, "a" * 90, "ab" * 200, base[0], base[0]]


@pytest.mark.parametrize("length,group,ranges", [(60, 128, 20_000), (60, 2, 20), (24, 8, 40)])
def test_like_counting_every_window(spark, monkeypatch, length, group, ranges):
    monkeypatch.setattr(suffix, "GROUP_ROWS", group)
    monkeypatch.setattr(suffix, "RANGE_ROWS", ranges)
    monkeypatch.setattr(suffix, "RUN_ROWS", ranges)
    texts = texts_with_repeats(random.Random(length))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffix.without_repeats(docs, length).collect()}
    for i, expected in enumerate(brute(texts, length)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == expected
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_groups_cut_into_small_ranges(spark, monkeypatch):
    rng = random.Random(5)
    passages = [words_of(rng, 30, "xyz") for _ in range(3)]
    texts = []
    for _ in range(150):
        passage = rng.choice(passages)
        at, end = rng.randint(0, 20), rng.randint(60, len(passage))
        texts.append(words_of(rng, rng.randint(0, 9), "abcdé") + passage[at:end] + words_of(rng, rng.randint(0, 9), "abcdé"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = dict(enumerate(brute(texts, 40)))
    for group, ranges in ((4, 12), (128, 25), (2, 5)):
        monkeypatch.setattr(suffix, "GROUP_ROWS", group)
        monkeypatch.setattr(suffix, "RANGE_ROWS", ranges)
        monkeypatch.setattr(suffix, "RUN_ROWS", 40)
        got = suffix.without_repeats(docs, 40).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == expected


def test_lists_of_copies_do_not_grow(spark):
    rng = random.Random(8)
    text, other = words_of(rng, 700, "abcde"), words_of(rng, 200, "fghij")
    longest = {}
    for n in (2, 1_000):
        texts = [text] * n + [other + text[:900]] * (n // 2)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        spans = suffix.repeated_windows(suffix.keyed(docs))
        longest[n] = max(r["count"] for r in spans.groupBy("k1", "k2").count().collect())
        got = Counter((r["n_bytes"], r["n_removed"]) for r in suffix.without_repeats(docs).collect())
        part = 900 if n == 2 else len(other) + 900
        assert got == {(len(text), len(text)): n, (len(other) + 900, part): n // 2}
    assert longest[1_000] == longest[2] > 1


def test_merge_orders_and_shares():
    rng = np.random.default_rng(3)
    keys = rng.integers(97, 99, (500, 40), "u1")
    runs = []
    for part in np.array_split(keys, 7):
        part = part[suffix.sort_rows(part)]
        shared, rest = suffix.front_code(part)
        decoded = suffix.front_decode(shared, rest, 40)
        assert decoded == [bytes(r) for r in part]
        runs.append((decoded, np.frombuffer(shared, "<i4").tolist()))
    merged = [(runs[r][0][i], n) for r, i, n in suffix.merge(runs)]
    assert [k for k, _ in merged] == sorted(bytes(r) for r in keys)
    for (a, _), (b, n) in zip(merged[:-1], merged[1:], strict=True):
        assert suffix.common_prefix(a, b, 0) == n


def test_odd_documents(spark):
    docs = documents(spark)
    got = suffix.without_repeats(docs)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == docs.count()
    assert rows[5]["n_removed"] == rows[5]["n_bytes"] > 0
    assert rows[2]["n_bytes"] == 0 and rows[8]["n_removed"] == 0
    assert suffix.without_repeats(docs.limit(0)).count() == 0
