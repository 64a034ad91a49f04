"""External models, fitted models, sinks, sources, and streams over several batches."""

import datetime as dt
import json
import math
import random
import re
import struct
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimflow.operators import models
from claimflow import fixed_values as fixed
from claimflow.functions import cleaning
from claimflow.plans import claims, headers
from claimflow.plans.specs import STD
from claimflow.operators.vocabulary import build_vocabulary
from claimflow.session import shared_dir
from claimflow.sources import readers, sinks
from claimflow.streaming import scoring as streams
from queries import views


def varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 127
        out += bytes([low | (128 if n else 0)])
        if not n:
            return out


def message(number, body):
    return varint(number << 3 | 2) + varint(len(body)) + body


def number(field, value):
    return varint(field << 3) + varint(value)


def tensor_type(name, dims):
    shape = b"".join(message(1, number(1, d) if d else message(2, b"n")) for d in dims)
    return message(1, name) + message(2, message(1, number(1, 1) + message(2, shape)))


def logistic_graph(weights):
    """A network file with one matrix product and a sigmoid."""
    raw = struct.pack(f"<{len(weights)}f", *weights)
    constant = number(1, len(weights)) + number(1, 1) + number(2, 1) + message(8, b"w") + message(9, raw)
    product = message(1, b"x") + message(1, b"w") + message(2, b"z") + message(4, b"MatMul")
    squash = message(1, b"z") + message(2, b"p") + message(4, b"Sigmoid")
    graph = (
        message(1, product) + message(1, squash) + message(2, b"g") + message(5, constant)
        + message(11, tensor_type(b"x", [0, len(weights)])) + message(12, tensor_type(b"p", [0, 1]))
    )
    return number(1, 8) + message(7, graph) + message(8, number(2, 13))


def test_onnx_model(spark):
    pytest.importorskip("onnxruntime")
    weights = [0.5, -1.0, 0.25]
    rows = [(float(i), float(i % 3), float(-i)) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    model = models.onnx_model(logistic_graph(weights), ["a", "b", "c"])
    got = model.score(df, "p", F.col("a") != 7).collect()
    for r in got:
        z = np.dot(weights, [r["a"], r["b"], r["c"]])
        assert r["p"] is None if r["a"] == 7 else r["p"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_fitted_models_agree_with_the_signal(spark):
    df = spark.range(400).select(
        (F.col("id") % 20).cast("double").alias("x"), ((F.col("id") % 20) > 9).cast("int").alias("y")
    )
    for model in (models.fit_linear(df, ["x"], "y", ridge=0.01), models.fit_trees(df, ["x"], "y", trees=2)):
        scored = model.score(df, "p", F.col("x") < 19)
        assert scored.filter("x < 19 AND (p >= 0.5) != (y = 1)").count() == 0
        assert scored.filter("x = 19 AND p IS NOT NULL").count() == 0


def test_linear_model_from_table(spark):
    table = spark.createDataFrame([("x", 2.0), ("(intercept)", -1.0)], "feature string, coefficient double")
    model = models.LinearModel.from_table(table)
    df = spark.createDataFrame([(0.5,)], "x double")
    assert model.score(df, "p").first()["p"] == pytest.approx(0.5)


def test_rejected_rows_are_listed(spark):
    row = dict.fromkeys(fixed.STD_COLUMNS, "1") | {"Claim Identifier": "c1", "Loss Date": "13/32/2019", "Policy Lives": "many"}
    good = row | {"Claim Identifier": "c2", "Loss Date": "15-Jan-2019", "Policy Lives": " "}
    df = spark.createDataFrame([row, good], ", ".join(f"`{c}` string" for c in fixed.STD_COLUMNS))
    found = {r["Claim Identifier"]: {x["column"]: x["value"] for x in r["rejects"]} for r in claims.rejected(df, STD).collect()}
    assert found["c1"]["Loss Date"] == "13/32/2019" and found["c1"]["Policy Lives"] == "many"
    assert not {"Loss Date", "Policy Lives"} & set(found.get("c2", {}))


def test_first_items_and_dates(spark):
    lists = ["['a', None]", "('x','y')", '["q"]', "[None]", "[]", None, "[7, 8]", "['it,s']", "plain"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(cleaning.list_first("t")).collect()]
    assert got == ["a", "x", "q", None, None, "Unknown", "7", "it,s", None]
    spelled = ["13/01/2019", "1/5/2019 1:30 PM", "2019-01-15T10:00:00+05:00", "01/05/85", "2019-01-15T10:00:00Z", "31/31/2019", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(spelled)], "i int, t string")
    got = [str(r[0]) for r in df.orderBy("i").select(cleaning.parse_timestamp("t")).collect()]
    assert got == [
        "2019-01-13 00:00:00", "2019-01-05 13:30:00", "2019-01-15 05:00:00", "1985-01-05 00:00:00", "2019-01-15 10:00:00", "None", "None",
    ]


def test_empty_and_sparse_batches(spark):
    rows = [("a", None, 1), ("a", 7, 2), ("a", None, 3), ("b", None, 0), (None, 900, 4)]
    df = spark.createDataFrame(rows, "batch string, pos long, v int")
    every = sinks.envelope_batch(df, "batch", "pos", ["v"], part_rows=2).collect()
    got = {(p["entityId"], p["part"]): [r["v"] for r in p["predictedResult"]] for p in every}
    assert got == {("a", 0): [1, 3], ("a", 1): [2], ("b", 0): [0], (None, 0): [4]}
    known = sinks.envelope_batch(df, "batch", "pos", ["v"], present=F.col("v") > 0).collect()
    assert {p["entityId"]: len(p["predictedResult"]) for p in known} == {"a": 3, "b": 0, None: 1}


def test_parts_hold_the_whole_batch(spark):
    df = spark.range(2500).select(F.lit("b").alias("batch"), F.col("id").alias("pos"), (F.col("id") * 2).alias("v"))
    parts = sinks.envelope_batch(df, "batch", "pos", ["v"], part_rows=1000).orderBy("part").collect()
    assert [len(p["predictedResult"]) for p in parts] == [1000, 1000, 500]
    assert [r["v"] for p in parts for r in p["predictedResult"]] == [2 * i for i in range(2500)]


def test_json_records(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    sinks.write_json_records(df, str(tmp_path / "out"))
    lines = sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect())
    assert lines == ['{"a":1,"b":null}', '{"a":2,"b":"x"}']


def test_record_files(spark, tmp_path):
    path = str(tmp_path / "claims")
    spark.createDataFrame([("1", None)], "a string, b string").write.json(path)
    assert readers.read_claims(spark, path, ["a", "b"], "json").collect() == [("1", None)]
    with pytest.raises(KeyError):
        readers.read_claims(spark, path, ["a", "z"], "json", readers.claim_schema(["a", "b"]))


def test_header_envelopes(spark):
    df = spark.createDataFrame([("d1", ["firstName", "blank_header_1", "firstName"]), ("d2", [])], "dataset_id string, columns array<string>")
    names = readers.explode_headers(df).filter("column_name IS NOT NULL")
    vocabulary = build_vocabulary(names, headers.header_words(F.col("column_name")))

    def score(encoded):
        hot = {"prod_scores": 30, "hdr_scores": 36, "ent_scores": 26}
        sizes = {"prod_scores": 32, "hdr_scores": 96, "ent_scores": 29}
        return encoded.withColumns(
            {n: F.transform(F.sequence(F.lit(0), F.lit(sizes[n] - 1)), lambda i: F.when(i == k, 5.0).otherwise(0.0)) for n, k in hot.items()}
        )

    got = {r["entityId"]: r for r in headers.label_headers(df, vocabulary, score).collect()}
    assert got["d2"]["predictedResult"] == [] and got["d2"]["inputDataSource"] == "d2:0"
    first, blank, again = got["d1"]["predictedResult"]
    assert [t["label"] for t in first["triplet"]] == ["UNK", "FirstName", "Primary"] and first == again
    assert [tuple(t) for t in blank["triplet"]] == [("UNK", 1.0)] * 3


def test_snapshot_stream_over_batches(spark, tmp_path):
    """An earlier snapshot that arrives late replaces the one in the state."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    schema = "claim string, approved timestamp_ntz, kind string, i int"
    batches = [
        [("a", "2020-01-05", "STD", 1), ("b", "2020-01-01", "LTD", 2)],
        [("a", "2020-01-02", "LTD", 3), ("c", "2020-03-01", "STD", 4)],
        [("a", None, "STD", 5), ("b", "2020-01-01", "STD", 1)],
    ]
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "claim string, approved string, kind string, i int")
        df.withColumn("approved", F.col("approved").cast("timestamp_ntz")).coalesce(1).write.parquet(str(source / f"b{n}"))
    declared = spark.createDataFrame([], schema).schema
    stream = streams.read_stream(
        spark, str(source), declared, recursiveFileLookup="true", maxFilesPerTrigger="1", pathGlobFilter="*.parquet"
    )
    query = streams.first_snapshot_stream(
        stream, "claim", "approved", ["kind"], ["i"], streams.replace_by_key(out, "claim"), "late"
    )
    query.awaitTermination()
    got = {r["claim"]: r["kind"] for r in streams.current_rows(spark, out, "claim").collect()}
    assert got == {"a": "STD", "b": "STD", "c": "STD"}


def test_snapshot_stream_after_expiry_and_merge(spark, tmp_path):
    """State goes with its period, a late earlier snapshot still counts, and what is read stays one row per claim."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    declared = spark.createDataFrame([], "claim string, approved timestamp_ntz, kind string, i int").schema
    rows = [[(f"c{i}", f"2020-02-{1 + (i * 7 + n * 5) % 28:02d}", f"k{n}", i) for i in range(20)] for n in range(5)]
    rows.append([(None, "2019-01-01", "none", 0), ("c3", None, "undated", 1)])
    state = []
    for n, batch in enumerate(rows):
        df = spark.createDataFrame(batch, "claim string, approved string, kind string, i int")
        df.withColumn("approved", F.col("approved").cast("timestamp_ntz")).coalesce(1).write.parquet(str(source / f"b{n}"))
        stream = streams.read_stream(spark, str(source), declared, recursiveFileLookup="true", pathGlobFilter="*.parquet")
        query = streams.first_snapshot_stream(
            stream, "claim", "approved", ["kind"], ["i"], streams.replace_by_key(out, "claim", merge_every=2),
            f"expiring-{tmp_path.name}", period="1 second", delay="0 seconds",
        )
        query.awaitTermination()
        state.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress))
        time.sleep(1.1)
    expected = {}
    for claim, approved, kind, i in sum(rows, []):
        if claim is not None:
            expected[claim] = min(expected.get(claim, ("9", 0, "")), (approved or "", i, kind))
    got = {r["claim"]: r["kind"] for r in streams.current_rows(spark, out, "claim").collect()}
    assert got == {claim: kind for claim, (_, _, kind) in expected.items()}
    assert max(state) <= 40  # of 100 rows of five periods, those of the last two
    merged = sorted((tmp_path / "out" / "merged").iterdir(), key=lambda p: int(p.name.split("=")[1]))
    assert 1 <= len(merged) <= 2 and spark.read.parquet(str(merged[-1])).count() == 20
    assert len(list((tmp_path / "out" / "batches").iterdir())) < 6


def test_merge_again_after_it_was_cut_off(spark, tmp_path):
    """A merge without its mark is not read and is done again; a batch that runs twice changes nothing."""
    out = str(tmp_path / "out")
    write = streams.replace_by_key(out, "claim", merge_every=2)
    order = streams.snapshot_order("approved", ["kind"], []).alias(streams.ORDER)

    def batch(*rows):
        return spark.createDataFrame(list(rows), "claim string, approved int, kind string").select("claim", "kind", order)

    write(batch(("a", 3, "x"), ("b", 1, "y")), 0)
    write(batch(("a", 2, "z")), 1)
    mark = tmp_path / "out" / "merged" / "number=1" / "_SUCCESS"
    mark.unlink()
    write(batch(("a", 2, "z")), 1)
    assert mark.exists()
    write(batch(("a", 2, "z")), 1)
    write(batch(("b", 5, "late")), 2)
    assert {r["claim"]: r["kind"] for r in streams.current_rows(spark, out, "claim").collect()} == {"a": "z", "b": "y"}


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def spelled_days():
    """A day written in every way, with what it should be read as."""
    day, short = dt.datetime(2019, 3, 25), dt.datetime(2019, 3, 5)
    clock, noon = dt.timedelta(hours=15, minutes=4), dt.timedelta(hours=12, minutes=30)
    return {
        "25/3/2019": day, "3/25/2019 15:04": day + clock, "25/03/2019 15:04:00": day + clock, "3/25/19": day, "25/3/19": day,
        "2019/3/25": day, "2019/03/25 15:04": day + clock, "20190325": day, "3-25-2019": day, "25-3-2019 15:04:00": day + clock,
        "25.3.2019": day, "5.3.2019 15:04": short + clock, "25-Mar-2019": day, "25-mar-19": day, "Mar 25, 2019": day, "March 25 2019": day,
        "MARCH 5, 2019": short, "25 Mar 2019": day, "25 March 2019": day, " 25 March 2019 ": day, "3/25/2019 3:04 PM": day + clock,
        "3/25/2019 3:04:00 pm": day + clock, "3/25/2019 12:30 AM": day + noon - dt.timedelta(hours=12), "3/25/2019 12:30 PM": day + noon,
        "3/5/2019": short, "3-5-2019": short, "3/5/69": dt.datetime(1969, 3, 5), "3/5/68": dt.datetime(2068, 3, 5), "May 1, 2020": dt.datetime(2020, 5, 1),
        "29 February 2020": dt.datetime(2020, 2, 29), "29 February 2019": None, "31/4/2019": None, "13/13/2019": None, "25 Marc 2019": None,
        "3/25/2019 13:04 PM": None, "3/25/2019 0:04 PM": None, "n/a": None, "   ": None, "": None, "Mar": None, "25-3-19": None, "20191325": None,
        "1 of 2": None, "@-2019": None, "2019-@-1": None, "25 Mar 19 2019": None, "12/2019": None, "99/99/99": None, None: None,
    }


def test_every_spelling_of_a_date(spark):
    days = spelled_days()
    df = spark.createDataFrame([(t,) for t in days], "t string")
    got = {r[0]: r[1] for r in df.select("t", cleaning.parse_timestamp("t")).collect()}
    assert got == days


def random_tree(rng, tree, leaves, features):
    """A node table grown by splitting leaves at random."""
    nodes, open_ = {0: None}, [0]
    while len(open_) < leaves:
        at = open_.pop(rng.randrange(len(open_)))
        left, right = len(nodes), len(nodes) + 1
        nodes[at] = (rng.choice(features), rng.choice([rng.uniform(-2, 2), float(rng.randint(-2, 2))]), left, right)
        nodes[left] = nodes[right] = None
        open_ += [left, right]
    shape = ("feature", "threshold", "left", "right")
    return [
        {"tree": tree, "node": n, **dict(zip(shape, v or (None,) * 4, strict=True)), "value": None if v else rng.uniform(-1, 1)}
        for n, v in nodes.items()
    ]


@pytest.mark.parametrize("leaves", [1, 2, 40, 64, 65, 400])
def test_forest_like_expressions(spark, leaves):
    rng = random.Random(leaves)
    features = ["a", "b c", "d"]
    nodes = [r for t in range(3) for r in random_tree(rng, t * 2, max(1, leaves - t), features)]
    draw = lambda: rng.choice([None, float(rng.randint(-2, 2)), rng.uniform(-3, 3)])
    rows = [(i, draw(), draw(), draw(), i % 5 > 0) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, a double, `b c` double, d double, done boolean").repartition(3)
    by_tree = {}
    for r in nodes:
        by_tree.setdefault(r["tree"], {})[r["node"]] = r

    def walk(tree, row):
        at = tree[0]
        while at["feature"] is not None:
            x = row[features.index(at["feature"]) + 1]
            at = tree[at["right"] if x is not None and x >= at["threshold"] else at["left"]]
        return at["value"]

    model = models.ForestModel(nodes, 0.3, trees_at_once=2, rows_at_once=70)
    got = {r["i"]: r["p"] for r in model.score(df, "p", F.col("done")).collect()}
    for row in rows:
        want = 1 / (1 + math.exp(-sum(walk(t, row) for t in by_tree.values()) - 0.3)) if row[4] else None
        assert got[row[0]] == (pytest.approx(want, abs=1e-12) if row[4] else None)
    if leaves < 60:
        plain = {r["i"]: r["p"] for r in models.TreeModel(nodes, 0.3).score(df, "p", F.col("done")).collect()}
        assert plain == {i: pytest.approx(p, abs=1e-12) if p is not None else None for i, p in got.items()}
    assert model.score(df.limit(0), "p").count() == 0


def test_maps_that_list_other_rows(spark):
    batches = [
        ({"0": 1, "1": 2}, {"0": "a", "1": "b"}), ({"5": 7, "3": 8}, {"3": "c", "9": "d", "5": None}), ({}, {"1": "x"}), (None, {"1": "x"}),
        ({"2": 4}, None),
    ]
    df = spark.createDataFrame(batches, "x map<string,int>, y map<string,string>")
    got = sorted(map(tuple, readers.rows_from_columns(df, ["x", "y"]).collect()))
    assert got == [(0, 1, "a"), (1, 2, "b"), (2, 4, None), (3, 8, "c"), (5, 7, None)]


@pytest.mark.parametrize("piece", [200, 1 << 20])
def test_column_map_files(spark, tmp_path, piece):
    rng = random.Random(piece)
    odd = ["a,b", 'say "x", then', "back\\slash,", '\\",', "{br}ace}, {", "", "é漢🙂, \u2028", "x" * 300 + ",", "line\nbreak", '"n": {"0": 1', ",,,,"]
    want = {}
    for b in range(3):
        rows = {i: (rng.randint(0, 9) / 4, rng.choice([*odd, None]), rng.randint(0, 2**40)) for i in range(200 * (b > 0) + 3)}
        batch = {c: {str(i): r[k] for i, r in rows.items()} for k, c in enumerate(["n", "te xt", "id"])}
        batch["n"] = {k: v for k, v in batch["n"].items() if int(k) % 3}  # a column that lacks rows
        batch["left out"], batch["empty"] = {"0": True}, {}
        indent = [None, 1, None][b]
        (tmp_path / f"{b}.json").write_text(json.dumps(batch, indent=indent, ensure_ascii=b == 0), encoding="utf-8")
        want.update({(f"{b}.json", i): (r[0] if i % 3 else None, *r[1:]) for i, r in rows.items()})
    (tmp_path / "none.json").write_text("{}")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(piece))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = readers.read_column_maps(spark, str(tmp_path), "n double, `te xt` string, id long, missing int")
        got = {(r["batch"].rsplit("/", 1)[1], r["index"]): tuple(r)[2:5] for r in read.collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == want and {r["missing"] for r in read.collect()} == {None}


def test_wide_stages_are_compiled_in_a_session_built_elsewhere(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    plain = spark.newSession()
    for given, kept in (("65535", "8000"), ("20000", "20000")):
        plain.conf.set(limit, given)
        raw = plain.range(1).select(*[F.lit(None).cast("string").alias(c) for c in STD.columns])
        assert claims.std_features(raw).count() == 1
        assert plain.conf.get(limit) == kept
        plain.conf.set(limit, given)
        views.view(plain, "/root/testdata/sf0.001", "claims")
        assert plain.conf.get(limit) == kept


def test_column_map_files_are_told_by_number(spark, tmp_path):
    """Entries meet by the number of their file; each row still names its own file."""
    for name in ("one", "two"):
        (tmp_path / f"{name}.json").write_text('{"t": {"1": "%s, {\\"x\\": \\\\", "2": null}, "n": {"2": 5}}' % name)
    read = readers.read_column_maps(spark, str(tmp_path), "t string, n long")
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[_file#\d+L", plan) and not re.search(r"Aggregate \[[^\]]*_path", plan)
    got = sorted((r["batch"].split("/")[-1], r["index"], r["t"], r["n"]) for r in read.collect())
    assert [g[:2] for g in got] == [("one.json", 1), ("one.json", 2), ("two.json", 1), ("two.json", 2)]
    assert [g[2:] for g in got] == [('one, {"x": \\', None), (None, 5), ('two, {"x": \\', None), (None, 5)]
