"""Paths for hot keys and large tables, forced with small limits, against brute force."""

import collections
import datetime as dt
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimflow.operators import encode, evaluate, skew
from claimflow.operators import vocabulary as vocab
from claimflow.operators.scale import QuantileTransform, Scaler, grid_quantiles
from claimflow.operators.snapshots import approval_rank, attach_snapshot, first_snapshot

SMALL = dict(cell_rows=9)


def hot_rows(n=400, seed=3):
    """A third of all rows share one key."""
    rng = random.Random(seed)
    return [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(25)}", rng.randrange(40)) for i in range(n)]


@pytest.mark.parametrize("group", [[], ["k"]])
def test_running_totals(spark, group):
    counts = collections.Counter((k if group else None, float(x)) for _, k, x in hot_rows())
    df = spark.createDataFrame([(k, x, n) for (k, x), n in counts.items()], "k string, x double, n int")
    got = skew.running_totals(df, "x", ["n"], group, **SMALL).collect()
    assert len(got) == len(counts)
    for r in got:
        below = sum(n for (k, x), n in counts.items() if x < r["x"] and (not group or k == r["k"]))
        assert r["n_before"] == below
    plain = skew.running_totals(df, "x", ["n"], group).collect()
    assert sorted(map(tuple, plain), key=str) == sorted(map(tuple, got), key=str)


def test_running_totals_with_null_group(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", float(i), 1) for i in range(30)], "k string, x double, n int")
    got = skew.running_totals(df, "x", ["n"], ["k"], **SMALL).collect()
    assert sorted(r["n_before"] for r in got) == sorted([i // 2 for i in range(30)])


def test_salted_join_equals_plain(spark):
    left = spark.createDataFrame(hot_rows(), "i int, k string, x int")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("k2", 4)], "k string, y int")
    assert [r[0] for r in skew.hot_keys(left, "k", 100).collect()] == ["hot"]
    for how in ("inner", "left"):
        salted = skew.salted_join(left, right, ["k"], how, hot_rows=100, salts=4)
        plain = left.join(right, ["k"], how)
        assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_rows_without_a_key_are_spread_and_kept(spark):
    left = spark.createDataFrame([(i, None if i % 3 else f"k{i % 5}") for i in range(300)], "i int, k string")
    right = spark.createDataFrame([("k1", 1), (None, 2)], "k string, y int")
    assert [r[0] for r in skew.hot_keys(left, "k", 100).collect()] == [None]
    for how in ("inner", "left"):
        salted = skew.salted_join(left, right, ["k"], how, hot_rows=100, salts=4)
        plain = left.join(right, ["k"], how)
        assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.createDataFrame(hot_rows(3000), "i int, k string, x int")
    right = spark.createDataFrame([("hot", 1)], "k string, y int")
    salted = skew._salted(left, right, ["k"], "inner", skew.hot_keys(left, "k", 900), 16)
    assert "_salt" not in salted.columns and salted.count() == 1000
    spread = F.pmod(F.xxhash64("i", "k", "x"), F.lit(16))
    sizes = [r[1] for r in left.filter("k = 'hot'").groupBy(spread).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2.5 * 1000 / 16


def test_lookup_beyond_broadcast(spark):
    left = spark.createDataFrame(hot_rows(), "i int, k string, x int")
    table = spark.createDataFrame([(f"k{i}", i) for i in range(0, 25, 2)] + [("hot", -1)], "k string, y int")
    big = skew.lookup_join(left, table, ["k"], broadcast_rows=3, hot_rows=100)
    small = skew.lookup_join(left, table, ["k"])
    assert sorted(map(tuple, big.collect()), key=str) == sorted(map(tuple, small.collect()), key=str)


def snapshots(spark, n=500):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        day = rng.choice([None, *range(1, 29)])
        date = None if day is None else dt.datetime(2020, 1, day, rng.randrange(3))
        rows.append(("hot" if i % 3 == 0 else f"c{rng.randrange(60)}", date, i))
    rows += [(None, dt.datetime(2020, 1, 2), n + i) for i in range(80)]
    return rows, spark.createDataFrame(rows, "claim string, approved timestamp_ntz, i int")


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_approval_rank(spark, limit):
    rows, df = snapshots(spark)
    expected = {}
    for claim, date, i in rows:
        own = [d for c, d, _ in rows if c == claim and d is not None]
        unranked = claim is None or date is None
        expected[i] = -1 if unranked else int(sum(d < date for d in own) + (own.count(date) + 1) / 2)
    got = approval_rank(df, "claim", "approved", hot_rows=limit, **SMALL).collect()
    assert {r["i"]: r["approval_date_rank"] for r in got} == expected


def test_first_snapshot_and_join(spark):
    rows, df = snapshots(spark)
    rows = [r for r in rows if r[0] is not None]
    best = {}
    for claim, date, i in rows:
        rank = (date is not None, date or dt.datetime.min, i)
        best[claim] = min(best.get(claim, rank), rank)
    got = first_snapshot(df, "claim", "approved", ["i"], ["i"])
    assert {r["claim"]: r["i"] for r in got.collect()} == {c: r[2] for c, r in best.items()}
    joined = attach_snapshot(df, got.withColumnRenamed("i", "first"), "claim", hot_rows=50)
    assert joined.count() == len(rows)
    assert all(r["first"] == best[r["claim"]][2] for r in joined.collect())


def test_grid_quantiles(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=700), 1)
    y = rng.integers(0, 4, 700).astype(float)
    df = spark.createDataFrame([(float(a), float(b) if i % 5 else None) for i, (a, b) in enumerate(zip(x, y))], "x double, y double")
    kept = y[np.arange(700) % 5 != 0]
    for points in (5, 33):
        for bounds in ({}, SMALL):
            got = grid_quantiles(df, ["x", "y"], points, **bounds)
            at = np.linspace(0, 1, points)
            assert got["x"] == pytest.approx(np.quantile(x, at)) and got["y"] == pytest.approx(np.quantile(kept, at))


def test_quantile_transform(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([np.round(rng.exponential(size=300), 2), np.zeros(120), [np.nan]])
    df = spark.createDataFrame([(i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)], "i int, x double")
    fitted = QuantileTransform(50).fit(df, ["x"])
    knots, at = np.array(fitted.knots["x"]), np.linspace(0, 1, 50)
    probes = [-1.0, 0.0, 0.005, 0.333, 1.0, float(knots[30]), 99.0, None]
    got = [r[0] for r in fitted.transform(spark.createDataFrame([(p,) for p in probes], "x double")).collect()]
    for p, g in zip(probes, got):
        if p is None:
            assert g is None
        elif p <= knots[0]:
            assert g == 0
        else:
            up = np.interp(p, knots, at)
            down = -np.interp(-p, -knots[::-1], -at[::-1])
            assert g == pytest.approx((up + down) / 2)


@pytest.mark.parametrize("kind", ["standard", "minmax", "robust"])
def test_scaler_of_constant_and_null(spark, kind):
    df = spark.createDataFrame([(3.0, None), (3.0, 1.0), (3.0, 5.0)], "a double, b double")
    got = Scaler(kind).fit(df, ["a", "b"]).transform(df).collect()
    assert [r["a"] for r in got] == [0, 0, 0] and got[0]["b"] is None


def test_curves_in_cells(spark):
    rng = random.Random(9)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(600)]
    df = spark.createDataFrame(rows, "y int, p double")
    pos = [p for y, p in rows if y]
    neg = [p for y, p in rows if not y]
    won = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    thresholds = sorted({p for _, p in rows})
    ap = 0.0
    for t in thresholds:
        tp, fp = sum(p >= t for p in pos), sum(p >= t for p in neg)
        ap += tp / (tp + fp) * sum(p == t for p in pos) / len(pos)
    for bounds in ({}, SMALL):
        assert evaluate.auc(df, "y", "p", **bounds).first()[0] == pytest.approx(won)
        assert evaluate.auc_pr(df, "y", "p", **bounds).first()[0] == pytest.approx(ap)
        curve = {r["threshold"]: r for r in evaluate.threshold_curve(df, "y", "p", **bounds).collect()}
        assert sorted(curve) == thresholds
        for t in thresholds[::17]:
            assert curve[t]["fpr"] == pytest.approx(sum(p >= t for p in neg) / len(neg))
            assert curve[t]["fnr"] == pytest.approx(sum(p < t for p in pos) / len(pos))


def test_rare_grouper_with_many_categories(spark, monkeypatch):
    df = spark.createDataFrame([(i, k, None if x == 0 else str(x)) for i, k, x in hot_rows()], "i int, k string, x string")
    short = encode.RareGrouper(12).fit(df, ["k", "x"]).transform(df)
    monkeypatch.setattr(encode, "LITERAL_LIMIT", 1)
    joined = encode.RareGrouper(12).fit(df, ["k", "x"]).transform(df)
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, joined.collect()))
    counts = collections.Counter(k for _, k, _ in hot_rows())
    assert {r["k"] for r in short.collect()} == {k if n >= 12 else "OOV" for k, n in counts.items()}
    with pytest.raises(ValueError):
        encode.RareGrouper(3).transform(df)


def test_target_encoder(spark, monkeypatch):
    rows = [(i, k if x else None, int(x > 20)) for i, k, x in hot_rows()] + [(9999, "once", 1)]
    df = spark.createDataFrame(rows, "i int, k string, y int")
    prior = sum(y for *_, y in rows) / len(rows)
    sums, sizes = collections.Counter(), collections.Counter()
    for _, k, y in rows:
        sums[k] += y
        sizes[k] += 1
    expected = {
        i: prior if k is None or sizes[k] == 1 else (sums[k] + prior) / (sizes[k] + 1) for i, k, _ in rows
    }
    for limit in (200, 1):
        monkeypatch.setattr(encode, "LITERAL_LIMIT", limit)
        got = encode.TargetEncoder().fit(df, ["k"], "y").transform(df)
        assert {r["i"]: r["k"] for r in got.collect()} == pytest.approx(expected)
    unseen = spark.createDataFrame([(1, "new", 0)], "i int, k string, y int")
    assert encode.TargetEncoder().fit(df, ["k"], "y").transform(unseen).first()["k"] == pytest.approx(prior)
    for bounds in ({}, SMALL):
        ordered = encode.TargetEncoder().fit_transform(df, "k", "y", "i", **bounds).collect()
        for r in ordered[::23]:
            earlier = [y for i, k, y in rows if k == r["k"] and i < r["i"]]
            want = prior if r["k"] is None else (sum(earlier) + prior) / (len(earlier) + 1)
            assert r["k_encoded"] == pytest.approx(want)


def test_template_levels_take_the_longest_name():
    levels = encode.template_levels(["a_b_c", "a_x", "other"], ["a", "a_b"])
    assert levels == {"a_b_c": ("a_b", "c"), "a_x": ("a", "x")}


TEXTS = {
    1: "Acute pain in the right knee, knee pain; right knee joint", 2: "no match here", 3: "", 4: None,
    5: "RIGHT right knee KNEE joint pain",
}
PHRASES = [
    ("right knee", "SYSTEM_ORGAN_SITE"), ("right", "DIRECTION"), ("knee pain", "DX_NAME"), ("pain", "DX_NAME"),
    ("acute", "ACUITY"), ("knee joint pain", "DX_NAME"), ("joint", "BRAND_NAME"),
]


def greedy(text):
    tokens, at, found = re.findall(r"[^\W_]+", text or ""), 0, []
    while at < len(tokens):
        best = None
        for phrase, label in PHRASES:
            w = phrase.split()
            if [t.lower() for t in tokens[at : at + len(w)]] == w and (best is None or len(w) > best[0]):
                best = (len(w), label)
        if best:
            found.append((best[1], " ".join(tokens[at : at + best[0]])))
        at += best[0] if best else 1
    return found


def test_entities_against_scanning(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "i int, t string")
    gazetteer = spark.createDataFrame(PHRASES, "phrase string, label string")
    for held in (1000, 0):
        found = vocab.find_phrases(df, "i", "t", gazetteer, held).collect()
        plain = lambda m: " ".join(re.findall(r"[^\W_]+", m["words"]))
        assert {r["i"]: [(m["label"], plain(m)) for m in r["found"]] for r in found} == {
            i: greedy(t) for i, t in TEXTS.items()
        }
    lists = {r["i"]: r["entities"] for r in vocab.extract_entities(df, "i", "t", gazetteer).collect()}
    assert lists[1]["system_organ_site"] == ["right knee", "right knee"] and lists[1]["acuity"] == ["Acute"]
    assert "joint" not in sum((list(v) for v in lists[1].asDict().values()), [])
    assert len(lists) == len(TEXTS) and lists[3]["name"] == []


@pytest.mark.parametrize("held", [1000, 0])
def test_long_phrases_and_spans(spark, held):
    text = "Old diseases of the musculoskeletal system; Crohn's  disease, then crohn-s-disease."
    df = spark.createDataFrame([(1, text), (2, "pad " * 100_000 + "Crohn's disease")], "i int, t string")
    phrases = [("diseases of the musculoskeletal system", "DX_NAME"), ("crohn's disease", "DX_NAME"), ("diseases of", "NAME")]
    gazetteer = spark.createDataFrame(phrases, "phrase string, label string")
    found = {r["i"]: [m["words"] for m in r["found"]] for r in vocab.find_phrases(df, "i", "t", gazetteer, held).collect()}
    assert found[1] == ["diseases of the musculoskeletal system", "Crohn's  disease", "crohn-s-disease"]
    assert found[2] == ["Crohn's disease"]


def test_numbering_over_many_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(13)
    got = skew.numbered(df, [F.desc("x")], "n").collect()
    assert {r["x"]: r["n"] for r in got} == {x: 999 - x for x in range(1000)}
    assert skew.numbered(df.limit(0), [F.desc("x")], "n").count() == 0


def test_numbering_spreads_equal_rows(spark):
    """Half of all rows have no position, and are equal in all else."""
    position = F.when(F.col("id") % 2 == 1, F.col("id"))
    df = spark.range(160_000).select(position.alias("x"), F.lit(1).alias("y")).repartition(8)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = skew.numbered(df, [F.asc_nulls_first("x"), F.col("y")], "n")
        sizes = sorted(r[1] for r in got.groupBy(F.input_file_name()).count().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]
    rows = got.agg(F.count("n"), F.countDistinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(rows) == (160_000, 160_000, 0, 159_999)
    wrong = got.filter((F.col("x").isNull() != (F.col("n") < 80_000)) | (F.col("n") != 80_000 + (F.col("x") - 1) / 2))
    assert wrong.count() == 0


def test_orders_beyond_doubles_and_no_rows(spark):
    ids = [2**53 + i for i in range(8)]
    df = spark.createDataFrame([(i, "a", 1) for i in ids], "i long, k string, y int")
    got = encode.TargetEncoder().fit_transform(df, "k", "y", "i").orderBy("i").collect()
    assert [r["k_encoded"] for r in got] == pytest.approx([1.0] * 8)
    y = spark.createDataFrame([(i, "a", n % 2) for n, i in enumerate(ids)], "i long, k string, y int")
    got = encode.TargetEncoder().fit_transform(y, "k", "y", "i", cell_rows=3).orderBy("i").collect()
    assert [r["k_encoded"] for r in got] == pytest.approx([(n // 2 + 0.5) / (n + 1) for n in range(8)])
    none = encode.TargetEncoder().fit(df.limit(0), ["k"], "y")
    assert none.transform(df).first()["k"] is None and none.transform(df.limit(0)).count() == 0
    assert grid_quantiles(df.limit(0), ["i"], 5) == {"i": []}


def test_no_join_but_for_long_columns(spark):
    rows = [(i, f"c{i % 1500}", *[f"s{i % (3 + j)}" for j in range(6)], i % 2) for i in range(6000)]
    names = ["long", *[f"s{j}" for j in range(6)]]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} string" for n in names) + ", y int")
    encoder = encode.TargetEncoder().fit(df, names, "y")
    plan = encoder.transform(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 1


@pytest.mark.parametrize("held", [1 << 30, 0])
def test_wide_columns_take_one_lookup(spark, monkeypatch, held):
    monkeypatch.setattr(encode, "LITERAL_LIMIT", 5)
    monkeypatch.setattr(encode, "HELD_ENTRIES", held)
    rng = random.Random(3)
    rows = [(i, *[rng.choice([None, "", *[f"{c}{rng.randrange(40)}" for _ in range(9)]]) for c in "ab"], "same", f"u{i}", f"s{i % 3}", i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "i int, `a x` string, b string, _found string, d string, s string, y int")
    names = ["a x", "b", "d", "s"]
    encoder = encode.TargetEncoder().fit(df, names, "y")
    got = {r["i"]: r for r in encoder.transform(df).collect()}
    prior = 0.5
    for k, c in enumerate(["a x", "b", None, "d", "s"], 1):
        if c is None:
            continue
        totals = collections.defaultdict(lambda: [0, 0])
        for r in rows:
            totals[r[k]][0] += r[-1]
            totals[r[k]][1] += 1
        for r in rows:
            y, n = totals[r[k]]
            want = prior if r[k] is None or n < 2 else (y + prior) / (n + 1)
            assert got[r[0]][c] == pytest.approx(want), (c, r)
    assert {r["_found"] for r in got.values()} == {"same"} and len(got) == 900
    grouper = encode.RareGrouper(20).fit(df, ["a x", "b", "d"])
    frequent = {c: {v for v, n in collections.Counter(r[k] for r in rows).items() if n >= 20 and v is not None} for k, c in ((1, "a x"), (2, "b"), (4, "d"))}
    assert len(frequent["a x"]) > 5
    for r in grouper.transform(df).collect():
        own = rows[r["i"]]
        assert [r["a x"], r["b"], r["d"]] == [v if v in frequent[c] else "OOV" for c, v in (("a x", own[1]), ("b", own[2]), ("d", own[4]))]
    if held:
        plan = encoder.transform(df)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
    assert encoder.transform(df.limit(0)).count() == 0


def brute_phrases(text, phrases):
    spans = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W_]+", text or "")]
    table, found, pos = dict(phrases), [], 0
    longest = max(len(p.split()) for p in table)
    while pos < len(spans):
        for n in range(min(longest, len(spans) - pos), 0, -1):
            label = table.get(" ".join(w for _, _, w in spans[pos : pos + n]))
            if label:
                found.append((pos, label, text[spans[pos][0] : spans[pos + n - 1][1]]))
                pos += n - 1
                break
        pos += 1
    return found


@pytest.mark.parametrize("held", [500_000, 0])
def test_phrases_of_few_words_that_overlap(spark, held):
    rng = random.Random(9)
    draw = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    phrases = sorted({(draw(rng.randint(1, 6)), "X") for _ in range(60)})
    phrases = [(p, f"L{i}") for i, (p, _) in enumerate(phrases) if p not in ("a", "b")]
    texts = [(i, draw(rng.randint(0, 60)).replace(" ", rng.choice([" ", ", ", " - "])).title()) for i in range(150)] + [(500, None), (501, "a é 漢 d")]
    df = spark.createDataFrame(texts, "i int, t string").repartition(4)
    gazetteer = spark.createDataFrame(phrases, "phrase string, label string")
    got = {r["i"]: [tuple(m) for m in r["found"]] for r in vocab.find_phrases(df, "i", "t", gazetteer, held).collect()}
    assert got == {i: brute_phrases(t, phrases) for i, t in texts}


def test_large_gazetteer_is_met_by_few_candidates(spark):
    """A hundred thousand phrases: the filter leaves hardly more candidates than there are matches."""
    gazetteer = spark.range(100_000).selectExpr("concat('w', id % 997, ' w', id % 89, ' z', id) AS phrase", "'NAME' AS label")
    texts = spark.range(200).selectExpr("id AS i", "concat_ws(' ', transform(sequence(0, 300), k -> concat('w', (id * 31 + k * k) % 997)), 'w5 w5 z5') AS t")
    for held in (500_000, 0):
        got = vocab.find_phrases(texts, "i", "t", gazetteer, held).select("i", F.size("found").alias("n"), F.col("found")[0]["words"].alias("w"))
        assert {(r["n"], r["w"]) for r in got.collect()} == {(1, "w5 w5 z5")}
    n = 100_000
    held, bits = vocab.phrase_filter(gazetteer.select("phrase"), n), n * vocab.FILTER_BITS
    kept = [c for r in texts.collect() for c in vocab._candidates_of(r["t"], [3], held, bits)]
    assert 200 <= len(kept) < 200 + 0.02 * 200 * 300


def test_tfidf_norm_and_width(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"]), (3, ["c"])], "i int, w array<string>")
    tfidf = vocab.TfIdf().fit(df, "i", F.col("w"))
    weights = tfidf.transform(df, "i", F.col("w"))
    got = {(r["i"], r["term"]): r["weight"] for r in weights.collect()}
    a, b = 2 * (math.log(4 / 2) + 1), math.log(4 / 3) + 1
    assert got[1, "a"] == pytest.approx(a / math.hypot(a, b)) and got[2, "b"] == pytest.approx(1)
    wide = {r["i"]: r for r in tfidf.wide(weights, "i", ["a", "zz"]).collect()}
    assert wide[2]["a"] == 0 and wide[1]["zz"] == 0 and wide[1]["a"] == pytest.approx(got[1, "a"])


def test_large_tables_are_not_dealt_out(spark):
    from queries.views import spread

    table = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plans = [spread(table, small)._jdf.queryExecution().toString() for small in (1000, 10_000_000)]
    assert ["Repartition" in p for p in plans] == [False, True]


def test_words_are_counted_where_they_lie(spark):
    rows = [(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["b", None, "c"]), (None, ["a"])]
    df = spark.createDataFrame(rows, "k long, w array<string>")
    for texts, want in ((False, {"a": 3, "b": 2, "c": 1}), (True, {"a": 2, "b": 2, "c": 1})):
        assert {r["t"]: r["n"] for r in vocab.word_totals(df, F.col("w"), "t", texts).collect()} == want
    counts = vocab.term_counts(df, "k", F.col("w"))
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    want = [(1, "a", 2), (1, "b", 1), (4, "b", 1), (4, "c", 1), (None, "a", 1)]
    assert sorted(map(tuple, counts.collect()), key=str) == sorted(want, key=str)
    twice = vocab.term_counts(df.union(df.limit(1)), "k", F.col("w")).filter("k = 1")
    assert sorted(map(tuple, twice.collect())) == [(1, "a", 4), (1, "b", 2)]
    assert vocab.term_counts(df.filter("k < 0"), "k", F.col("w")).count() == 0


def test_runs_of_words_are_hashed_once_and_left_early(spark, monkeypatch):
    """Each run of words is hashed once for all texts, and only where a phrase may go on."""
    phrases = spark.createDataFrame([("a b c", 3), ("d", 1)], "phrase string, n int")
    begins = vocab._beginnings(phrases)
    assert sorted(r["phrase"] for r in begins.collect()) == ["a", "a b"]
    filters = [(vocab.phrase_filter(t.select("phrase"), 2), 64) for t in (phrases, begins)]
    hashed = []
    real = vocab.xxhash.xxh64_intdigest
    monkeypatch.setattr(vocab.xxhash, "xxh64_intdigest", lambda b, seed: hashed.append(b.decode()) or real(b, seed))
    texts = ["A b x d", None, "", "x a  B-c d D " * 50]
    met = {}
    for n, row, pos, run, runs, words in vocab._candidates_in(texts, [1, 3], *filters[0], *filters[1]):
        for r, p, u, w in zip(row.tolist(), pos.tolist(), run.tolist(), words, strict=True):
            met.setdefault((runs[u], w), []).append((r, p))
    assert met["a b c", "a  B-c"] == [(3, 6 * i + 1) for i in range(50)]
    assert met["d", "D"] == [(3, 6 * i + 5) for i in range(50)] and met["d", "d"][0] == (0, 3)
    assert len(hashed) <= 2 * (len({"a", "b", "x", "d", "c"}) + 3) and hashed.count("a b c") == 1
    # a text sends one row for each phrase, with all its places
    gazetteer = spark.createDataFrame([("d", "X"), ("a b c", "Y")], "phrase string, label string")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: [tuple(m) for m in r["found"]] for r in vocab.find_phrases(df, "i", "t", gazetteer, 0).collect()}
    both = [(6 * i + p, x, w) for i in range(50) for p, x, w in ((1, "Y", "a  B-c"), (4, "X", "d"), (5, "X", "D"))]
    assert got == {0: [(3, "X", "d")], 1: [], 2: [], 3: both}


def test_texts_are_split_once_and_ask_once_for_a_word(spark, monkeypatch):
    """Blocks of few words: every block asks for a word once, and ids and stems stay in place."""
    rng = random.Random(4)
    words = ["Hopes", "hoped", "a-b", "--", "Σας", "x y", "running", "run."]
    rows = [(i, rng.choice(["  ", "\t", " "]).join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    df = spark.createDataFrame([*rows, (60, None), (61, " -- "), (62, "")], "i int, t string").repartition(3)
    clean = lambda c: F.regexp_replace(F.lower(c), "[-.]", "")
    listed = {i: [w for w in re.sub("[-.]", "", (t or "").lower()).split() if w] for i, t in [*rows, (60, None), (61, " -- "), (62, "")]}
    coded = vocab.coded_texts(df, "i", F.col("t"), clean, block_words=50)
    assert coded.select("block").distinct().count() > 6
    totals = collections.Counter(w for x in listed.values() for w in x)
    assert {r["token"]: r["n"] for r in vocab.coded_totals(coded).collect()} == totals
    asked = coded.select("block", F.explode("words").alias("w")).filter("w IS NOT NULL")
    assert asked.count() < sum(totals.values()) / 2
    known = {w: i + 2 for i, (w, _) in enumerate(sorted(totals.items(), key=lambda x: (-x[1], x[0])))}
    vocabulary = vocab.ranked_words(vocab.coded_totals(coded)).filter("token <> 'hoped'")
    for held in (1000, 0):
        got = {r["i"]: r["ids"] for r in vocab.coded_ids(coded, "i", vocabulary, held=held).collect()}
        assert got == {i: [1 if w == "hoped" else known[w] for w in x] for i, x in listed.items()}
    lists = spark.createDataFrame([(1, ["a", None, "b", "a"]), (2, None), (3, []), (4, ["", "zz"])], "i int, w array<string>")
    numbers = spark.createDataFrame([("a", 7), ("", 8), ("b", 9)], "token string, id int")
    want = {1: [7, 1, 9, 7], 2: [], 3: [], 4: [8, 1]}
    for held in (1000, 0):
        assert {r["i"]: r["ids"] for r in vocab.token_ids(lists, "i", F.col("w"), numbers, held=held).collect()} == want
    stems = {r["i"]: r["s"] for r in vocab.stem_text(df, "i", "t", "s", held=0).collect()}
    from claimflow.functions.stemming import stem_word

    assert stems == {i: " ".join(stem_word(w) for w in (t or "").split()) for i, t in [*rows, (60, None), (61, " -- "), (62, "")]}


def test_a_description_is_cleaned_once_not_for_each_claim(spark):
    from claimflow.plans import bridging

    texts = ["Low back pain", None, "_na_", "", "pain, low", "the Pain"]
    rows = [(i, texts[i % len(texts)]) for i in range(60)]
    features = spark.createDataFrame(rows, f"i int, {bridging.DESCRIPTION} string")
    given = bridging.described(features, ["the"])
    assert {r["_given"]: r["cleaned"] for r in given.collect()} == {
        "Low back pain": "Low back pain", "_na_": "_na_", "": "", "pain, low": "pain low", "the Pain": "Pain"
    }
    stems = bridging.description_stems(features, ["the"])
    tfidf = vocab.TfIdf().fit_counts(stems, "text_key")
    worded = bridging.add_terms(features, stems, tfidf, ["pain", "low", "_na_", "zz"], ["the"])
    assert "regexp_replace" not in worded._jdf.queryExecution().optimizedPlan().toString()
    got = {r["i"]: r for r in worded.collect()}
    assert len(got) == 60 and set(worded.columns) == {*features.columns, "pain", "low", "_na_", "zz"}
    assert got[1]["_na_"] == got[2]["_na_"] == 1.0 and got[3]["pain"] == 0.0 and got[5]["pain"] == 1.0
    for i, r in got.items():
        assert [r[c] for c in worded.columns[2:]] == [got[i % 6][c] for c in worded.columns[2:]]
        assert (r["low"] > 0) == (i % 6 in (0, 4)) and r["zz"] == 0.0 and r[bridging.DESCRIPTION] == texts[i % 6]
