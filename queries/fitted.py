"""Snapshots, joins, encoders, scalers and what they are fitted on."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.operators import encode, scale
from claimflow.operators.projection import quoted
from claimflow.operators.snapshots import approval_rank, first_snapshot
from claimflow.plans import bridging, claims
from queries import sqltext as q
from queries.registry import query
from queries.views import SNAPSHOT_TIEBREAK, table, view

SNAPSHOTS = ["snapshots"]


def r6(c):
    return F.round(c, 6)


# --- snapshots -------------------------------------------------------------


@query("G1", q.with_views(SNAPSHOTS, q.BRIDGING_ROWS, select="""SELECT "ClaimNumber", l_linenumber, l_partkey, l_suppkey, l_extendedprice,
 CAST(CASE WHEN "ApprovalDate" IS NULL THEN -1 ELSE floor(rank() OVER (PARTITION BY "ClaimNumber" ORDER BY "ApprovalDate" ASC NULLS LAST)
  + (count(*) OVER (PARTITION BY "ClaimNumber", "ApprovalDate") - 1) / 2) END AS INT) AS approval_date_rank FROM eligible_rows"""))
def snapshot_rank(spark, sf):
    rows = bridging.eligible_rows(view(spark, sf, "snapshots"))
    ranked = approval_rank(rows, "ClaimNumber", "ApprovalDate")
    return ranked.select("ClaimNumber", *SNAPSHOT_TIEBREAK, "approval_date_rank")


@query("G2", q.with_views(SNAPSHOTS, q.BRIDGING_ROWS, q.FIRST_SNAPSHOT, select="""SELECT "ClaimNumber", "BenefitCaseType",
 strftime("DurationDate", '%Y-%m-%d %H:%M:%S') AS duration FROM first_rows"""))
def earliest_snapshot(spark, sf):
    rows = bridging.eligible_rows(view(spark, sf, "snapshots"))
    first = first_snapshot(rows, "ClaimNumber", "ApprovalDate", ["BenefitCaseType", "DurationDate"], SNAPSHOT_TIEBREAK)
    return first.select(
        "ClaimNumber", "BenefitCaseType", F.date_format("DurationDate", "yyyy-MM-dd HH:mm:ss").alias("duration")
    )


BRIDGING_OUT = [
    "ClaimNumber", "CaseSize", "PrimaryDiagnosisDecription", "pd_code_1", "pd_code_2", "SIC_category",
    "InsuredAnnualizedSalary", "emp_tenure", "initial_prognosis_days",
]


@query("G3", q.with_views(SNAPSHOTS, q.BRIDGING_FEATURES, select=f"SELECT {', '.join(map(q.name, BRIDGING_OUT))} FROM bridging_features"))
def snapshot_features(spark, sf):
    return bridging.bridging_features(view(spark, sf, "snapshots"), SNAPSHOT_TIEBREAK).select(*BRIDGING_OUT)


RARE = ["Primary Diagnosis Code", "Insured Salary Ind", "Coverage Code", "SIC Code"]


def _counts(c: str) -> str:
    return f"SELECT {q.lit(c)} AS column_name, {q.name(c)} AS category, count(*) AS counts FROM claims WHERE {q.name(c)} IS NOT NULL GROUP BY 2"


_all_counts = "counts AS (" + "\nUNION ALL ".join(map(_counts, RARE)) + ")"


@query("G4", q.with_views(["claims"], _all_counts, select="SELECT * FROM counts"))
def category_frequency(spark, sf):
    return encode.category_counts(view(spark, sf, "claims"), RARE)


@query("E11a", q.with_views(["claims"], _all_counts, select="SELECT column_name, category FROM counts WHERE counts >= 40"))
def frequent_categories(spark, sf):
    return encode.RareGrouper(40).fit(view(spark, sf, "claims"), RARE).frequent


def _oov(c: str) -> str:
    kept = f"SELECT category FROM counts WHERE column_name = {q.lit(c)} AND counts >= 40"
    return f"CASE WHEN {q.name(c)} IN ({kept}) THEN {q.name(c)} ELSE 'OOV' END AS {q.name(c)}"


@query("E11b", q.with_views(["claims"], _all_counts, select=f'SELECT "Claim Identifier", {", ".join(map(_oov, RARE))} FROM claims'))
def rare_to_oov(spark, sf):
    raw = view(spark, sf, "claims").select("Claim Identifier", *[quoted(c) for c in RARE])
    return encode.RareGrouper(40).fit(raw, RARE).transform(raw)


# --- encoding --------------------------------------------------------------

HOT = {"Insured Gender": ["F", "M"], "Claim State": ["CA", "IL", "NY"], "DOT Exertion Level (Primary)": ["Light", "Heavy"]}
_hot = ", ".join(
    f"CAST(coalesce({q.name(c)} = {q.lit(v)}, FALSE) AS INT) AS {q.name(f'{c}_{v}')}" for c, vs in HOT.items() for v in vs
)


@query("H1", q.with_views(["claims"], select=f'SELECT "Claim Identifier", {_hot} FROM claims'))
def one_hot(spark, sf):
    raw = view(spark, sf, "claims").select("Claim Identifier", *[quoted(c) for c in HOT])
    return encode.one_hot(raw, HOT)


STD_TEMPLATE = [
    "Insured Age at Loss", "Insured Annualized Salary", "Policy Lives", "policy_tenure", "days_to_report",
    "emp_tenure", "prognosis_days", "Insured Gender_F", "Insured Gender_M", "Insured Salary Ind_WEEKLY",
    "Insured Salary Ind_M", "Primary Diagnosis Category_OTHERS", "Primary Diagnosis Category_UNKNOWN",
    "Primary Diagnosis Category_RESPIRATORY SYSTEM", "Primary Diagnosis Category_NOT SEEN",
    "SIC_risk_ind_High", "SIC_risk_ind_Low", "SIC_risk_ind_Medium", "Coverage Code_OTHERS",
    "Coverage Code_STDCORE", "Coverage Code_STDVOL", "never_made",
]
STD_HOT = encode.template_levels(STD_TEMPLATE, fixed.STD_CATEGORICAL)
_numeric = STD_TEMPLATE[:7]


def _aligned(f: str) -> str:
    x = q.feature(f, STD_HOT, ["never_made"])
    return f"{f'round({x}, 6)' if f in _numeric else x} AS {q.name(f)}"


@query("H2", q.with_views(["claims"], q.STD_FEATURES, select=f'SELECT "Claim Identifier", {", ".join(map(_aligned, STD_TEMPLATE))} FROM std_features'))
def aligned_features(spark, sf):
    features = claims.std_features(view(spark, sf, "claims"))
    matrix = encode.align(features, STD_TEMPLATE, fixed.STD_CATEGORICAL, carry=["Claim Identifier"])
    return matrix.withColumns({c: r6(quoted(c)) for c in _numeric})


_gaps = """CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'Infinity'::DOUBLE WHEN 3 THEN '-Infinity'::DOUBLE ELSE l_tax END"""


@query("H3", f"""SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN x IS NULL THEN 0 WHEN x = 'Infinity'::DOUBLE THEN 1.0 WHEN x = '-Infinity'::DOUBLE THEN -1.0 ELSE x END AS x
 FROM (SELECT l_orderkey, l_partkey, l_linenumber, {_gaps} AS x FROM lineitem)""")
def finite_features(spark, sf):
    """Gaps and infinities put in by line number; the huge finite values are shown as +-1."""
    x = (
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double"))
        .when(F.col("l_linenumber") == 2, F.lit(float("inf")))
        .when(F.col("l_linenumber") == 3, F.lit(float("-inf")))
        .otherwise(F.col("l_tax"))
    )
    raw = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", x.alias("x"))
    shown = F.when(F.abs("x") == encode.DOUBLE_MAX, F.signum("x")).otherwise(F.col("x"))
    return encode.nan_to_num(raw, ["x"]).withColumn("x", shown)


# --- scaling ---------------------------------------------------------------

SCALED = ["l_quantity", "l_extendedprice", "l_tax", "l_discount"]
KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]


def _scaled_sql(center: str, spread: str) -> str:
    stats = ", ".join(f"{center.format(c)} AS m{i}, {spread.format(c)} AS s{i}" for i, c in enumerate(SCALED))
    listed = ", ".join(f"round(({c} - m{i}) / s{i}, 6) AS {c}" for i, c in enumerate(SCALED))
    return f"WITH stats AS (SELECT {stats} FROM lineitem) SELECT {', '.join(KEYS)}, {listed} FROM lineitem, stats"


def scaled(spark, sf, kind):
    raw = table(spark, sf, "lineitem").select(*KEYS, *SCALED)
    return scale.Scaler(kind).fit(raw, SCALED).transform(raw).withColumns({c: r6(F.col(c)) for c in SCALED})


@query("H4", _scaled_sql("avg({0})", "stddev_pop({0})"))
def standard_scaled(spark, sf):
    return scaled(spark, sf, "standard")


@query("H4", _scaled_sql("min({0})", "(max({0}) - min({0}))"))
def minmax_scaled(spark, sf):
    return scaled(spark, sf, "minmax")


@query("H5", _scaled_sql("quantile_cont({0}, 0.5)", "(quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25))"))
def robust_scaled(spark, sf):
    return scaled(spark, sf, "robust")


def quantile_sql(x: str, k: str, points: int) -> str:
    """Share of x in the knot list k."""
    below, upto = f"len(list_filter({k}, lambda v: v < {x}))", f"len(list_filter({k}, lambda v: v <= {x}))"
    step = f"{points - 1}::DOUBLE"
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= {k}[1] THEN 0 WHEN {x} >= {k}[{points}] THEN 1
      WHEN {upto} > {below} THEN ({below} / {step} + ({upto} - 1) / {step}) / 2
      ELSE ({upto} - 1) / {step} + (({x} - {k}[{upto}]) / ({k}[{upto} + 1] - {k}[{upto}])) / {step} END"""


def knots_sql(x: str, points: int) -> str:
    at = ", ".join(repr(i / (points - 1)) for i in range(points))
    return f"quantile_cont({x}, [{at}])"


QUANTILE_POINTS = 101


@query("H6", f"""WITH knots AS (SELECT {', '.join(f'{knots_sql(c, QUANTILE_POINTS)} AS k{i}' for i, c in enumerate(SCALED))} FROM lineitem)
 SELECT {', '.join(KEYS)}, {', '.join(f'round({quantile_sql(c, f"k{i}", QUANTILE_POINTS)}, 6) AS {c}' for i, c in enumerate(SCALED))} FROM lineitem, knots""")
def quantile_transformed(spark, sf):
    raw = table(spark, sf, "lineitem").select(*KEYS, *SCALED)
    fitted = scale.QuantileTransform(QUANTILE_POINTS).fit(raw, SCALED)
    return fitted.transform(raw).withColumns({c: r6(F.col(c)) for c in SCALED})


# --- target encoding -------------------------------------------------------

TARGETS = ["l_returnflag", "l_suppkey", "l_partkey"]
_label = "CASE WHEN (l_partkey * 31 + l_orderkey * 7 + l_linenumber) % 10 < 3 THEN 1 ELSE 0 END"
_stats = ",\n".join(
    f"t{i} AS (SELECT {c} AS v, sum(y) AS s, count(*) AS n FROM labelled GROUP BY 1 HAVING count(*) > 1)" for i, c in enumerate(TARGETS)
)
_joins = " ".join(f"LEFT JOIN t{i} ON l.{c} = t{i}.v" for i, c in enumerate(TARGETS))
_shares = ", ".join(f"coalesce((t{i}.s + prior) / (t{i}.n + 1), prior) AS {c}" for i, c in enumerate(TARGETS))


@query("H7a", f"""WITH labelled AS (SELECT *, {_label} AS y FROM lineitem), p AS (SELECT avg(y) AS prior FROM labelled), {_stats}
 SELECT l.l_orderkey, l.l_linenumber, {_shares} FROM labelled l CROSS JOIN p {_joins}""")
def target_encoded(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", *TARGETS, f"{_label} AS y")
    encoder = encode.TargetEncoder().fit(raw, TARGETS, "y")
    return encoder.transform(raw).drop("y")


_event_label = "CASE WHEN (event_id * 31 + user_id) % 10 < 3 THEN 1 ELSE 0 END"


@query("H7b", f"""WITH l AS (SELECT event_id, user_id, {_event_label} AS y FROM events), p AS (SELECT avg(y) AS prior FROM l)
 SELECT event_id, user_id, (coalesce(sum(y) OVER w, 0) + prior) / (count(*) OVER w + 1) AS share FROM l, p
 WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def ordered_target_encoded(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", "user_id", f"{_event_label} AS y")
    encoded = encode.TargetEncoder().fit_transform(raw, "user_id", "y", "event_id")
    return encoded.select("event_id", "user_id", F.col("user_id_encoded").alias("share"))
