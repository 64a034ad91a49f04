"""SimHash components against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from claimflow.llm import simhash
from claimflow.llm.components import components
from tests.llm.data import documents


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, linked):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprint():
    for text in [None, "", "  ", "One two", "a b c d e f g A B C D", "é É " * 9, "x " * 70_000]:
        assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def near_prints(rng, n):
    out = {rng.getrandbits(64) for _ in range(n)}
    centre = rng.getrandbits(64)
    while len(out) < 2 * n:
        base = rng.choice([centre, *list(out)[:20]])
        for _ in range(rng.randint(1, 5)):
            base ^= 1 << rng.randrange(64)
        out.add(base)
    return sorted(out)


@pytest.mark.parametrize("bits,cell_rows", [(4, 50_000), (4, 20), (2, 20), (0, 50_000)])
def test_links_have_the_components_of_all_pairs(spark, bits, cell_rows):
    prints = np.array(near_prints(random.Random(bits), 150), "u8").view("i8").tolist()
    pairs = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if bin((a ^ b) & (2**64 - 1)).count("1") <= bits]
    expected = roots(prints, pairs)
    given = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    got = {r["node"]: r["component"] for r in components(simhash.links(given, bits, cell_rows)).collect()}
    assert {p: got.get(p, p) for p in prints} == expected


def test_bound_never_exceeds_the_distance():
    a, b = (np.random.default_rng(s).integers(0, 2**64, 1000, "u8") for s in (1, 2))
    bound = np.bitwise_count(simhash.embedded(a) ^ simhash.embedded(b))
    assert (bound <= np.bitwise_count(a ^ b)).all()


def test_long_chain_of_links(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components(chain).select("component").distinct().count() == 1
    assert components(chain.limit(0)).count() == 0


def test_odd_documents(spark):
    docs = documents(spark)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    zero = [r for r in found if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {2, 3, 4} and {r["component_id"] for r in zero} == {2}
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 5, 7, 8]
    assert simhash.representatives(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        simhash.links(docs, 3)


def test_representatives_keep_columns_of_any_name(spark):
    rows = [(1, "a b c d e", "x", "y"), (2, "a b c d e", "x", "y"), (2, "a b c d e", "x", "y"), (3, "quite another text here", "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string, _again string")
    assert sorted(map(tuple, simhash.representatives(docs).collect())) == [rows[0], rows[3]]
