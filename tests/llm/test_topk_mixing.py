"""Exact search and mixing."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimflow.llm import mixing, topk
from tests.llm.data import documents, words_of


def brute_top(vectors, queries, k):
    usable = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    whole = lambda v: [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]
    good = [(i, whole(v)) for i, v in vectors if i is not None and usable(v)]
    out = []
    for q, v in queries:
        if q is None or not usable(v):
            continue
        scored = [(-sum(a * b for a, b in zip(whole(v), c, strict=False)), i) for i, c in good if i != q]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale,step", [(1.0, 3), (1e6, 5), (3e5, 4)])
def test_top_k_like_brute_force(spark, scale, step):
    rng = random.Random(step)
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(10)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # ties
    rows += [(300, None), (301, [None] * 10), (302, [float("nan")] * 10), (303, [float("inf")] * 10), (None, rows[0][1])]
    rows += [(304, []), (305, rows[5][1][:4]), (0, rows[9][1])]
    asked = [r for r in rows if r[0] is not None and r[0] % 25 == 0]
    shape = "vec_id long, embedding array<float>, rank string"
    vectors = spark.createDataFrame([(*r, "x") for r in rows], shape)
    found = topk.top_k(vectors, spark.createDataFrame([(*r, "x") for r in asked], shape), 5, step, 3, 40)
    assert sorted(map(tuple, found.collect())) == brute_top(rows, asked, 5)


def test_top_k_of_huge_components(spark):
    rows = [(1, [1e8, 1.0]), (2, [1e30, 1.0]), (3, [1e30, 2.0]), (4, [-1e30, 0.0]), (5, [0.5, 0.5]), (50, [1e8, 3.0]), (100, [1e30, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    most = 2**63 - 1
    found = {(r[0], r[2]): (r[1], r[3]) for r in topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 6).collect()}
    whole = lambda v: [max(-(2**62), min(2**62, int(np.floor(np.float64(np.float32(x)) * 256)))) for x in v]
    for q, v in [rows[5], rows[6]]:
        score = lambda c: max(-most, min(most, sum(a * b for a, b in zip(whole(v), whole(c), strict=True))))  # noqa: E731, B023
        best = sorted((-score(c), i) for i, c in rows if i != q)
        assert [found[q, i] for _, i in best] == [(r + 1, -s) for r, (s, _) in enumerate(best)]


def test_top_k_of_few_or_none(spark):
    two = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(two, two).count() == 2
    assert topk.top_k(two.limit(0), two).count() == 0
    assert topk.top_k(two, two.limit(0)).count() == 0


def test_top_k_joins_no_blocks(spark):
    """Neither table is copied for each block of the other one, in the driver or in a shuffle."""
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(vectors, vectors.filter("vec_id % 10 = 0"), 3, 2, 4, 20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Broadcast", "Join", "Generate", "CartesianProduct"))
    assert sorted(map(tuple, found.collect())) == brute_top(rows, [r for r in rows if r[0] % 10 == 0], 3)


@pytest.mark.parametrize("at_once,share", [(16, 2), (7, 3), (50, 1000)])
def test_top_k_in_portions_of_bounded_size(spark, monkeypatch, at_once, share):
    """Portions of queries, ties, repeated ids and rows, and huge components, over many tasks."""
    for name, value in {"BYTES_SENT": at_once * 8 * 9, "LIMIT_SHARE": share, "LOOK_AT": 6, "FEW": 4}.items():
        monkeypatch.setattr(topk, name, value)
    sent, broadcast = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sent.append(value) or broadcast(value))
    rng = random.Random(at_once)
    rows = [(i, [rng.gauss(0, 1) / (1 + d) for d in range(9)]) for i in range(300)]
    rows += [(1000 + i, rows[4][1]) for i in range(150)] + rows[:20] + [rows[10]] * 30
    rows += [(2000 + i, [x * 10.0 ** rng.randint(0, 6) for x in rows[i][1]]) for i in range(0, 40, 2)]
    rows += [(3000, [0.0] * 9), (3001, []), (3010, rows[5][1][:4]), (None, rows[0][1]), (3020, None)]
    asked = [r for r in rows if r[0] is not None and r[0] % 10 == 0]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(vectors, vectors.filter("vec_id % 10 = 0"), 4, 2, 5, 30)
    assert sorted(map(tuple, found.collect())) == brute_top(rows, asked, 4)
    portions = [value for value in sent if isinstance(value, list)]
    assert len(portions) > 1
    assert all(sum(len(numbers) for _, numbers in value) <= at_once * 8 * 9 for value in portions)


def test_portions():
    assert topk.portions([], 5) == [[]]
    assert topk.portions([(7, 2), (9, 3), (12, 1), (40, 5), (41, 9), (50, 1)], 5) == [[7, 9], [12], [40], [41], [50]]


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 1.5, 2) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mixing.targets([10, 0, 10], [1, 1, 1], 1.5, 2) == [15.0, 0.0, 15.0]
    assert mixing.targets([], [], 1.5, 2) == []
    assert mixing.targets([0], [1], 1.5, 2) == [0.0]
    rng = random.Random(1)
    sizes = [rng.randint(0, 1000) for _ in range(50)]
    got = mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(50)], 1.5, 2)
    assert sum(got) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes, strict=True))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation(n):
    image = mixing.permuted(np.arange(n), n, "a", 1)
    assert sorted(image.tolist()) == list(range(n))
    assert all(mixing.position_of(int(v), n, "a", 1) == i for i, v in enumerate(image[:50]))


def mixed(docs, **how):
    m = mixing.mix(docs, block_words=8, per_shard=16, **how)
    return m, {(r["doc_id"], r["size"]): r for r in mixing.taken(m).collect()}


def test_mix_meets_its_targets(spark):
    rng = random.Random(5)
    rows = [(i, words_of(rng, rng.randint(0, 90)), f"s{min(i % 9, 4)}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    m, found = mixed(docs)
    by_source = {}
    for i, text, source in rows:
        r = found[i, len(text.split())]
        assert r["taken"] <= 2 * r["size"]
        by_source.setdefault(source, []).append(r)
    for source, got in by_source.items():
        plan = next(p for p in m.plans if p.source == source)
        assert got[0]["target"] == plan.target and got[0]["source_size"] == plan.size == sum(r["size"] for r in got)
        assert abs(sum(r["taken"] for r in got) - plan.target) <= 0.5
    again = mixed(docs.repartition(3))[1]
    assert {k: r["taken"] for k, r in found.items()} == {k: r["taken"] for k, r in again.items()}


def test_taken_like_a_loop_over_slots(spark, monkeypatch):
    """Words of documents marked one by one, from the plans, slots and permutations."""
    monkeypatch.setattr(mixing, "SHARDS_PER_CELL", 3)
    monkeypatch.setattr(mixing, "SLOTS_PER_TASK", 20)
    rng = random.Random(8)
    rows = [(i, words_of(rng, rng.randint(0, 50)), f"s{min(i % 7, 3)}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    m, found = mixed(docs)
    drawn = mixing.slots(spark, m.plans, 8, 16)
    assert drawn.rdd.getNumPartitions() > 5
    drawn = drawn.collect()
    slots = {i: [] for i in range(len(m.plans))}
    for r in drawn:
        slots[r["source_no"]].append(r)
    taken = {}
    for i, plan in enumerate(m.plans):
        # every slot of the quota once, and every pass a permutation of the blocks
        assert sorted(r["slot"] for r in slots[i]) == list(range(plan.quota))
        used = {}
        for r in slots[i]:
            assert r["pass"] == r["slot"] // plan.blocks
            assert r["block"] == mixing.permuted(np.array([r["slot"] % plan.blocks]), plan.blocks, mixing.SEED, plan.source, r["pass"])[0]
            used.setdefault(r["pass"], []).append(r["block"])
        assert all(len(set(b)) == len(b) for b in used.values())
        own = sorted((r for r in m.sizes.collect() if r["source"] == plan.source), key=lambda r: r["offset"])
        words = [r["doc_id"] for r in own for _ in range(r["size"])]
        assert len(words) == plan.size
        for r in slots[i]:
            for doc in words[r["block"] * 8 : r["block"] * 8 + r["words"]]:
                taken[doc] = taken.get(doc, 0) + 1
    assert {d: r["taken"] for (d, _), r in found.items()} == {i: taken.get(i, 0) for i, _, _ in rows}


def test_shards_are_drawn_and_filled(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, words_of(rng, 60), f"s{i % 3}") for i in range(60)], "doc_id long, text string, source string")
    m, _ = mixed(docs)
    per_shard = m.pieces.groupBy("shard").agg(F.countDistinct("source", "slot").alias("n")).orderBy("shard").collect()
    assert all(r["n"] == 16 for r in per_shard[:-1])
    shares = m.pieces.groupBy("shard", "source").agg(F.countDistinct("slot").alias("n"))
    assert shares.select("n").distinct().count() > 1
    uses = m.pieces.groupBy("source", "block", "doc_id").count()
    assert uses.agg(F.max("count")).first()[0] <= 2


def test_mixed_documents_hold_the_words_taken(spark):
    docs = documents(spark)
    m = mixing.mix(docs, block_words=4, per_shard=8)
    out = mixing.mixed_documents(docs.withColumn("n_chars", F.length("text")), m)
    wanted = mixing.taken(m).groupBy("doc_id").agg(F.sum("taken").alias("n")).filter("n > 0").collect()
    got = out.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {r["doc_id"]: r["n"] for r in wanted}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.collect():
        assert r["text"] in texts[r["doc_id"]] and r["n_chars"] == len(r["text"])


def test_mix_of_nothing(spark):
    docs = documents(spark)
    assert mixing.taken(mixing.mix(docs.limit(0))).count() == 0
    blank = docs.filter("text IS NULL OR trim(text) = ''")
    rows = mixing.taken(mixing.mix(blank)).collect()
    assert len(rows) == blank.count() and all(r["taken"] == 0 for r in rows)
    assert mixing.taken(mixing.mix(docs)).count() == docs.count()
