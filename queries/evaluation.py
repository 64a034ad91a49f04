"""Evaluation, employee totals, and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from claimflow.operators import employee, evaluate
from claimflow.plans import bridging
from claimflow.session import shared_dir
from claimflow.streaming import scoring as streams
from queries import sqltext as q
from queries.jobs import STD_SQL, std_job
from queries.registry import query
from queries.views import SNAPSHOT_TIEBREAK, SPARK, VIEWS, is_small, table

JUDGED = """judged AS (SELECT l.doc_id, quality AS y, toxic, d.n_chars / (d.n_chars + 2000.0::DOUBLE) AS p,
 CAST(d.n_chars / (d.n_chars + 2000.0::DOUBLE) >= 0.5 AS INT) AS yhat FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def judged(spark, sf):
    """Labels against a score made of the text length."""
    p = F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0))
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return joined.select("doc_id", F.col("quality").alias("y"), "toxic", p.alias("p"), (p >= 0.5).cast("int").alias("yhat"))


COUNTS = """counts AS (SELECT count(*) FILTER (y = 0 AND yhat = 0) AS tn, count(*) FILTER (y = 0 AND yhat = 1) AS fp,
 count(*) FILTER (y = 1 AND yhat = 0) AS fn, count(*) FILTER (y = 1 AND yhat = 1) AS tp FROM judged)"""


@query("K1", f"WITH {JUDGED}, {COUNTS} SELECT * FROM counts")
def confusion_matrix(spark, sf):
    return evaluate.confusion(judged(spark, sf), "y", "yhat")


REPORT = """SELECT tn, fp, fn, tp, round(p0, 6) AS class0_precision, round(r0, 6) AS class0_recall, round(2 * p0 * r0 / (p0 + r0), 6) AS class0_f1,
 round(p1, 6) AS class1_precision, round(r1, 6) AS class1_recall, round(2 * p1 * r1 / (p1 + r1), 6) AS class1_f1,
 round((tn + tp) / n, 6) AS accuracy, round(1.25 * p1 * r1 / (0.25 * p1 + r1), 6) AS f05, round(2 * p1 * r1 / (p1 + r1), 6) AS f1,
 round(5 * p1 * r1 / (4 * p1 + r1), 6) AS f2, round(p0 * s + p1 * (1 - s), 6) AS weighted_precision, round(r0 * s + r1 * (1 - s), 6) AS weighted_recall,
 round(2 * p0 * r0 / (p0 + r0) * s + 2 * p1 * r1 / (p1 + r1) * (1 - s), 6) AS weighted_f1
 FROM (SELECT *, tn + fp + fn + tp AS n, (tn + fp)::DOUBLE / (tn + fp + fn + tp) AS s, tn::DOUBLE / (tn + fn) AS p0, tn::DOUBLE / (tn + fp) AS r0,
 tp::DOUBLE / (tp + fp) AS p1, tp::DOUBLE / (tp + fn) AS r1 FROM counts)"""


@query("K2", f"WITH {JUDGED}, {COUNTS} {REPORT}")
def classification_report(spark, sf):
    report = evaluate.classification_report(evaluate.confusion(judged(spark, sf), "y", "yhat"))
    exact = ("tn", "fp", "fn", "tp")
    return report.select(*exact, *[F.round(c, 6).alias(c) for c in report.columns if c not in exact])


SCORED = """scored AS (SELECT event_id, CAST((event_id * 31 + user_id) % 10 < 3 OR value > 60 AS INT) AS y,
 value / (value + 50.0::DOUBLE) AS p FROM events)"""


def scored(spark, sf):
    y = ((F.col("event_id") * 31 + F.col("user_id")) % 10 < 3) | (F.col("value") > 60)
    p = F.col("value") / (F.col("value") + F.lit(50.0))
    return table(spark, sf, "events").select("event_id", y.cast("int").alias("y"), p.alias("p"))


RANKED = """per AS (SELECT p, sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg FROM scored GROUP BY p),
 ranked AS (SELECT *, coalesce(sum(pos) OVER w, 0)::BIGINT AS pb, coalesce(sum(neg) OVER w, 0)::BIGINT AS nb,
   sum(pos) OVER ()::DOUBLE AS pt, sum(neg) OVER ()::DOUBLE AS nt FROM per
   WINDOW w AS (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query("K3", f"WITH {SCORED}, {RANKED} SELECT round(sum(pos * (nb + neg / 2)) / any_value(pt * nt), 6) AS auc FROM ranked")
def roc_auc(spark, sf):
    return evaluate.auc(scored(spark, sf), "y", "p").select(F.round("auc", 6).alias("auc"))


@query("K3", f"WITH {SCORED}, {RANKED} SELECT round(sum(pos * (pt - pb) / (pt - pb + nt - nb)) / any_value(pt), 6) AS auc_pr FROM ranked")
def average_precision(spark, sf):
    return evaluate.auc_pr(scored(spark, sf), "y", "p").select(F.round("auc_pr", 6).alias("auc_pr"))


@query("K4", f"WITH {SCORED}, {RANKED} SELECT round(p, 6) AS threshold, round((nt - nb) / nt, 6) AS fpr, round(pb / pt, 6) AS fnr FROM ranked")
def threshold_curve(spark, sf):
    curve = evaluate.threshold_curve(scored(spark, sf), "y", "p")
    return curve.select(*[F.round(c, 6).alias(c) for c in curve.columns])


@query("K5", f"WITH {JUDGED} SELECT round(avg(CAST(y = yhat AND toxic = doc_id % 2 AS INT)), 6) AS emr FROM judged")
def exact_match(spark, sf):
    rows = judged(spark, sf).withColumn("parity", F.col("doc_id") % 2)
    emr = evaluate.exact_match_ratio(rows, {"y": "yhat", "toxic": "parity"})
    return emr.select(F.round("emr", 6).alias("emr"))


_changed = "CASE WHEN turn % 3 = 0 THEN upper(role) WHEN turn % 5 = 0 THEN NULL ELSE role END"


@query("K6", f"""SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.turn, b.turn) AS turn, a.role AS role_left, b.role AS role_right
 FROM conversations a FULL JOIN (SELECT conv_id, turn, {_changed} AS role FROM conversations WHERE turn <> 1) b ON a.conv_id = b.conv_id AND a.turn = b.turn
 WHERE a.conv_id IS NULL OR b.conv_id IS NULL OR a.role IS DISTINCT FROM b.role""")
def label_differences(spark, sf):
    ours = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    theirs = ours.filter("turn <> 1").withColumn("role", F.expr(_changed))
    return evaluate.compare_labels(ours, theirs, ["conv_id", "turn"], ["role"])


def _share(salt: str) -> str:
    return f"('0x' || substr(md5(concat(doc_id, '{salt}')), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


@query("K7", f"SELECT doc_id, CASE WHEN {_share('')} < 0.7::DOUBLE THEN 'train' ELSE 'test' END AS part, CAST(floor({_share('fold')} * 5) AS INT) AS fold FROM documents")
def split_assignment(spark, sf):
    keys = table(spark, sf, "documents").select("doc_id")
    return evaluate.folds(evaluate.split(keys, "doc_id", {"train": 0.7, "test": 0.3}), "doc_id", 5)


# --- employee totals: a user is an employee, the value of k is a policy ----

_policy = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
EVENTS = f"e AS (SELECT *, {_policy} AS policy FROM events)"


def events(spark, sf):
    policy = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf, "events").withColumn("policy", policy)


@query("L1", f"""WITH {EVENTS}, per AS (SELECT user_id, policy, count(*) FILTER (event_type IN ('click', 'view')) AS t FROM e GROUP BY ALL)
 SELECT user_id, count(*) AS policy_count, sum(t)::BIGINT AS task_count, count(*) FILTER (t >= 2) AS high_task_count, count(*) FILTER (t = 0) AS zero_task_count,
 round(count(*) FILTER (t >= 2) / nullif(count(*) - count(*) FILTER (t = 0), 0), 6) AS ratio FROM per GROUP BY user_id""")
def employee_tasks(spark, sf):
    is_task = F.col("event_type").isin("click", "view")
    totals = employee.task_ratio(events(spark, sf), "user_id", "policy", is_task, high_at=2)
    return totals.withColumn("ratio", F.round("ratio", 6))


@query("L2", f"""WITH {EVENTS}, per AS (SELECT user_id, policy, count(*) FILTER (event_type = 'error') AS t,
 sum(CASE WHEN event_type = 'error' THEN date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) END) AS d FROM e GROUP BY ALL)
 SELECT user_id, count(*) AS policy_count, count(*) FILTER (t > 0) AS change_policy_count, sum(t)::BIGINT AS party_change_count,
 round(sum(d) / nullif(sum(t), 0), 6) AS mean_change_days, round(count(*) FILTER (t > 0) / count(*), 6) AS ratio FROM per GROUP BY user_id""")
def employee_changes(spark, sf):
    days = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    totals = employee.change_ratio(events(spark, sf), "user_id", "policy", F.col("event_type") == "error", days)
    return totals.withColumns({c: F.round(c, 6) for c in ("mean_change_days", "ratio")})


@query("L3", f"""WITH {EVENTS}, per AS (SELECT user_id, policy, max(value) AS v, max(CAST(event_type = 'purchase' AS INT)) AS w,
 sum(value) FILTER (event_type = 'purchase') AS a FROM e GROUP BY ALL)
 SELECT user_id, count(*) AS total_policy_count, sum(w)::BIGINT AS withdrawal_policy_count, round(sum(v), 4) AS policy_value,
 round(coalesce(sum(a), 0), 4) AS policy_withdrawal, round(sum(w) / (count(*) + 10), 6) AS ratio FROM per GROUP BY user_id""")
def employee_policies(spark, sf):
    totals = employee.policy_totals(
        events(spark, sf), "user_id", "policy", F.col("value"), F.col("event_type") == "purchase",
        F.col("value"), F.col("total_policy_count") + 10,
    )
    return totals.withColumns(
        {"policy_value": F.round("policy_value", 4), "policy_withdrawal": F.round("policy_withdrawal", 4), "ratio": F.round("ratio", 6)}
    )


_flag_columns = {
    "uc2": "CASE WHEN user_id % 4 = 0 THEN NULL ELSE event_id % 2 END",
    "uc5": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id % 2 END",
    "uc7": "CASE WHEN user_id % 4 = 0 AND event_id % 7 = 0 THEN NULL ELSE 1 END",
}


@query("L4", f"""WITH f AS (SELECT event_id, {', '.join(f'{x} AS {n}' for n, x in _flag_columns.items())} FROM events)
 SELECT event_id, CAST(n AS INT) AS numerator, 3 AS denominator, round((coalesce(uc2, 0) + coalesce(uc5, 0) + coalesce(uc7, 0)) / nullif(n, 0), 6) AS score,
 concat(n, '/3') AS eligible_hypothesis FROM (SELECT *, CAST(uc2 IS NOT NULL AS INT) + CAST(uc5 IS NOT NULL AS INT) + CAST(uc7 IS NOT NULL AS INT) AS n FROM f)""")
def hypothesis_score(spark, sf):
    flagged = table(spark, sf, "events").selectExpr("event_id", *[f"{x} AS {n}" for n, x in _flag_columns.items()])
    found = flagged.withColumns(employee.hypothesis_score(list(_flag_columns)))
    return found.select("event_id", "numerator", "denominator", F.round("score", 6).alias("score"), "eligible_hypothesis")


@query("L5", f"""WITH {EVENTS} SELECT policy, string_agg(login, ',' ORDER BY login) AS logins
 FROM (SELECT DISTINCT policy, concat('u', user_id) AS login FROM e) GROUP BY policy""")
def transaction_logins(spark, sf):
    named = events(spark, sf).withColumn("login", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    found = employee.logins_per_transaction(named, "policy", "login")
    return found.select("policy", F.array_join("logins", ",").alias("logins"))


# --- streams ---------------------------------------------------------------


def stream_view(spark, sf, name):
    """A bound view on a stream of the table's files."""
    source, fields = VIEWS[name]
    files = spark.read.parquet(f"{sf}/{source}.parquet")
    cores = spark.sparkContext.defaultParallelism if is_small(files) else None
    raw = streams.read_stream(spark, sf, files.schema, partitions=cores, pathGlobFilter=f"{source}.parquet")
    return raw.selectExpr(*[f"{x} AS {SPARK.name(c)}" for c, x in fields(SPARK).items()])


@query("M1", STD_SQL)
def streamed_claims(spark, sf):
    """The short-term job on a stream gives what it gives on a table."""
    name = f"std-{uuid.uuid4().hex}"
    out = f"{shared_dir(spark)}/streamed/{name}"
    streams.score_stream(stream_view(spark, sf, "claims"), std_job, out, name).awaitTermination()
    return spark.read.parquet(out)


@query("M2", q.with_views(["snapshots"], q.BRIDGING_ROWS, q.FIRST_SNAPSHOT, select="""SELECT "ClaimNumber", "BenefitCaseType",
 strftime("DurationDate", '%Y-%m-%d %H:%M:%S') AS duration FROM first_rows"""))
def streamed_snapshots(spark, sf):
    """Earliest snapshot per claim kept as state over micro-batches."""
    name = f"first-{uuid.uuid4().hex}"
    out = f"{shared_dir(spark)}/streamed/{name}"
    rows = bridging.eligible_rows(stream_view(spark, sf, "snapshots"))
    streams.first_snapshot_stream(
        rows, "ClaimNumber", "ApprovalDate", ["BenefitCaseType", "DurationDate"], SNAPSHOT_TIEBREAK,
        streams.replace_by_key(out, "ClaimNumber"), name,
    ).awaitTermination()
    current = streams.current_rows(spark, out, "ClaimNumber")
    return current.select(
        "ClaimNumber", "BenefitCaseType", F.date_format("DurationDate", "yyyy-MM-dd HH:mm:ss").alias("duration")
    )
