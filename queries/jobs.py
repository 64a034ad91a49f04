"""Scores, corrections, label rules, and the complete jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.functions import scoring
from claimflow.operators import models, rules, scale
from claimflow.operators.encode import RareGrouper, TargetEncoder, align
from claimflow.operators.projection import quoted
from claimflow.plans import annuity, bridging, claims, headers
from claimflow.operators.vocabulary import TfIdf
from claimflow.session import materialise
from claimflow.sources.sinks import envelope, envelope_batch, transaction_envelope
from queries import sqltext as q
from queries.fitted import STD_HOT, STD_TEMPLATE, knots_sql, quantile_sql
from queries.registry import SQL, query
from queries.texts import STOPWORDS
from queries.views import DUCK, SNAPSHOT_TIEBREAK, SPARK, VIEWS, table, view

ID = "Claim Identifier"
RESULT = ["claimNumber", "predictedProbability", "predictedValue"]


def weights(features: list[str], numeric: dict[str, float] | None = None) -> dict[str, float]:
    """A coefficient table; numeric features get the small weights given."""
    return {f: (numeric or {}).get(f, ((i * 37) % 13 - 6) / 8) for i, f in enumerate(features)}


def rounded(df):
    return df.withColumn("predictedProbability", F.round("predictedProbability", 6))


# --- scores ----------------------------------------------------------------

KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]
LINE_WEIGHTS = {"l_quantity": 0.03, "l_discount": -4.0, "l_tax": 9.0, "l_linenumber": -0.2}


@query("J1a", f"SELECT {', '.join(KEYS)}, round({q.linear(LINE_WEIGHTS, -0.4)}, 6) AS p FROM lineitem")
def linear_score(spark, sf):
    scored = models.LinearModel(LINE_WEIGHTS, -0.4).score(table(spark, sf, "lineitem"), "p")
    return scored.select(*KEYS, F.round("p", 6).alias("p"))


def node(tree, number, feature=None, threshold=None, left=None, right=None, value=None):
    return dict(tree=tree, node=number, feature=feature, threshold=threshold, left=left, right=right, value=value)


TREES = [
    node(0, 0, "l_quantity", 24.5, 1, 2), node(0, 1, value=-0.6), node(0, 2, "l_discount", 0.05, 3, 4),
    node(0, 3, value=0.2), node(0, 4, value=0.9),
    node(1, 0, "l_tax", 0.04, 1, 2), node(1, 1, "l_linenumber", 4, 3, 4), node(1, 2, value=0.35),
    node(1, 3, value=-0.45), node(1, 4, value=0.1),
]


@query("J1b", f"""SELECT {', '.join(KEYS)}, round(1 / (1 + exp(-(
  CASE WHEN l_quantity < 24.5 THEN -0.6::DOUBLE WHEN l_discount < 0.05::DOUBLE THEN 0.2 ELSE 0.9 END
  + CASE WHEN l_tax >= 0.04::DOUBLE THEN 0.35::DOUBLE WHEN l_linenumber >= 4 THEN 0.1 ELSE -0.45 END - 0.1::DOUBLE))), 6) AS p FROM lineitem""")
def tree_score(spark, sf):
    scored = models.TreeModel(TREES, -0.1).score(table(spark, sf, "lineitem"), "p")
    return scored.select(*KEYS, F.round("p", 6).alias("p"))


FOREST, FOREST_DEPTH = 500, 5
FOREST_FEATURES = {"o_totalprice": 40, "o_custkey": 1, "o_orderkey": 1}
#: Features, thresholds and leaf values of node ``n`` (children 2n + 1 and 2n + 2) of tree ``t``.
FOREST_NODE = "(t * 7919 + n * 104729 + t * n * 31) % 1009"


def forest_nodes():
    """Full trees by rule."""
    nodes, inner = [], 2**FOREST_DEPTH - 1
    for t in range(FOREST):
        for n in range(2 * inner + 1):
            drawn = (t * 7919 + n * 104729 + t * n * 31) % 1009
            if n < inner:
                feature, scale = list(FOREST_FEATURES.items())[drawn % len(FOREST_FEATURES)]
                nodes.append(node(t, n, feature, drawn * 10 * scale, 2 * n + 1, 2 * n + 2))
            else:
                nodes.append(node(t, n, value=(drawn - 504) / 10000))
    return nodes


@query("J1b", f"""WITH RECURSIVE nodes AS (
  SELECT t, n, drawn % {len(FOREST_FEATURES)} + 1 AS f,
    drawn * 10 * [{', '.join(f'{s}::DOUBLE' for s in FOREST_FEATURES.values())}][(drawn % {len(FOREST_FEATURES)} + 1)::BIGINT] AS threshold, (drawn - 504) / 10000 AS value
  FROM (SELECT t, n, {FOREST_NODE} AS drawn FROM range({FOREST}) a(t), range({2 ** (FOREST_DEPTH + 1) - 1}) b(n))),
 walk AS (
  SELECT o_orderkey, [{', '.join(f'{c}::DOUBLE' for c in FOREST_FEATURES)}] AS x, t, 0::BIGINT AS n, 0 AS depth FROM orders, range({FOREST}) a(t)
  UNION ALL
  SELECT o_orderkey, x, w.t, 2 * w.n + CASE WHEN x[f] >= threshold THEN 2 ELSE 1 END, depth + 1
  FROM walk w JOIN nodes USING (t, n) WHERE depth < {FOREST_DEPTH})
 SELECT o_orderkey, round(1 / (1 + exp(-sum(value) - 0.2::DOUBLE)), 6) AS p
 FROM walk w JOIN nodes USING (t, n) WHERE depth = {FOREST_DEPTH} GROUP BY o_orderkey""")
def forest_score(spark, sf):
    """Five hundred trees of 32 leaves."""
    scored = models.ForestModel(forest_nodes(), 0.2).score(table(spark, sf, "orders"), "p")
    return scored.select("o_orderkey", F.round("p", 6).alias("p"))


@query("J1c", f"SELECT {', '.join(KEYS)}, CASE WHEN l_linenumber <> 3 THEN round({q.linear(LINE_WEIGHTS, 0.0)}, 6) END AS p FROM lineitem")
def external_score(spark, sf):
    """A predictor outside Spark, loaded once per task; line 3 counts as incomplete."""
    vector = list(LINE_WEIGHTS.values())

    def load():
        w = np.array(vector)
        return lambda matrix: 1 / (1 + np.exp(-(matrix @ w)))

    model = models.BatchModel(load, tuple(LINE_WEIGHTS), "float64")
    scored = model.score(table(spark, sf, "lineitem"), "p", F.col("l_linenumber") != 3)
    return scored.select(*KEYS, F.round("p", 6).alias("p"))


@query("J1c")
def fitted_logistic(spark, sf):
    """Logistic regression fitted on the cluster, then scored as plain columns."""
    rows = table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    model = models.fit_linear(rows, list(LINE_WEIGHTS), "y", ridge=0.01)
    return model.score(rows, "p").select(*KEYS, F.round("p", 4).alias("p"))


@query("J1c")
def fitted_trees(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    model = models.fit_trees(rows, list(LINE_WEIGHTS), "y", trees=3)
    return model.score(rows, "p").select(*KEYS, F.round("p", 4).alias("p"))


STD_SMALL = {
    "Insured Age at Loss": 0.01, "Insured Annualized Salary": 2e-5, "Policy Lives": 0.001,
    "policy_tenure": -0.0002, "days_to_report": 0.004, "emp_tenure": -0.0003, "prognosis_days": 0.01,
}
STD_WEIGHTS = weights(STD_TEMPLATE, STD_SMALL)
STD_P = q.linear(STD_WEIGHTS, 2.5, {f: q.feature(f, STD_HOT, ["never_made"]) for f in STD_TEMPLATE})


@query("J2", q.with_views(["claims"], q.STD_FEATURES, select=f"""SELECT "Claim Identifier", "NA_row", CASE WHEN "NA_row" = 'N' THEN round({STD_P}, 6) END AS p FROM std_features"""))
def masked_scores(spark, sf):
    """Incomplete rows are never scored."""
    features = claims.std_features(view(spark, sf, "claims"))
    matrix = align(features, STD_TEMPLATE, fixed.STD_CATEGORICAL, carry=[ID, "NA_row"])
    scored = models.LinearModel(STD_WEIGHTS, 2.5).score(matrix, "p", claims.complete_rows())
    return scored.select(quoted(ID), "NA_row", F.round("p", 6).alias("p"))


_p = "(l_extendedprice / (l_extendedprice + 30000))"


def line_probability(spark, sf):
    p = F.col("l_extendedprice") / (F.col("l_extendedprice") + F.lit(30000))
    return table(spark, sf, "lineitem").withColumn("p", p)


@query("J3", f"""SELECT {', '.join(KEYS)}, round({q.corrected(_p, 0.00795, 0.1792)}, 6) AS std, round({q.corrected(_p, 0.1, 0.5)}, 6) AS settlement FROM lineitem""")
def prior_correction(spark, sf):
    p = F.col("p")
    return line_probability(spark, sf).select(
        *KEYS,
        F.round(scoring.prior_correct(p, fixed.STD_PRIOR_ORIGINAL, fixed.STD_PRIOR_TRAIN), 6).alias("std"),
        F.round(scoring.prior_correct(p, fixed.SETTLEMENT_PRIOR_ORIGINAL, fixed.SETTLEMENT_PRIOR_TRAIN), 6).alias("settlement"),
    )


@query("J4", f"""SELECT {', '.join(KEYS)}, round({q.corrected(_p, 0.00795, 0.1792)}, 6) AS p FROM lineitem""")
def calibrated(spark, sf):
    """The alternative form gives the same number as the prior correction."""
    p = scoring.calibrate(F.col("p"), fixed.STD_PRIOR_TRAIN, fixed.STD_PRIOR_ORIGINAL)
    return line_probability(spark, sf).select(*KEYS, F.round(p, 6).alias("p"))


@query("J5", f"""SELECT {', '.join(KEYS)}, round({_p} * 0.3::DOUBLE + l_discount * 0.7::DOUBLE, 6) AS p FROM lineitem""")
def blended(spark, sf):
    p = scoring.blend([F.col("p"), F.col("l_discount")], fixed.SETTLEMENT_WEIGHTS)
    return line_probability(spark, sf).select(*KEYS, F.round(p, 6).alias("p"))


@query("J6", f"""SELECT {', '.join(KEYS)}, CAST({_p} >= 0.5 AS INT) AS claim, CAST({_p} >= {fixed.APPLICATION_THRESHOLD}::DOUBLE AS INT) AS application,
 CAST({_p} >= {fixed.TRANSACTION_THRESHOLD}::DOUBLE AS INT) AS transaction FROM lineitem""")
def threshold_labels(spark, sf):
    cuts = {"claim": 0.5, "application": fixed.APPLICATION_THRESHOLD, "transaction": fixed.TRANSACTION_THRESHOLD}
    return line_probability(spark, sf).select(
        *KEYS, *[scoring.label(F.col("p"), t).alias(n) for n, t in cuts.items()]
    )


@query("J7", q.with_views(["claims"], q.LTD_FEATURES, select="""SELECT "Claim Identifier", CASE WHEN "NA_row" = 'N' THEN days_to_report END AS p,
 CAST(CASE WHEN "NA_row" = 'N' THEN days_to_report >= 20 END AS INT) AS label FROM ltd_features"""))
def blanked_results(spark, sf):
    """Probability and label of an incomplete row are both NULL."""
    features = claims.ltd_features(view(spark, sf, "claims"))
    p = scoring.if_complete(F.col("days_to_report"))
    return features.select(quoted(ID), p.alias("p"), scoring.label(p, 20.0).alias("label"))


# --- header labels ---------------------------------------------------------

_heads = {
    "prod": ("embedding[1:32]", fixed.PRODUCT_LABELS),
    "hdr": ("list_concat(embedding, list_reverse(embedding[1:32]))", fixed.HEADER_LABELS),
    "ent": ("embedding[33:61]", fixed.PARTY_LABELS),
}


def _label_list(labels: list[str]) -> str:
    return "[" + ", ".join(q.lit(x) for x in labels) + "]"


HEADS_SQL = f"""heads AS (SELECT vec_id, label, {", ".join(f"list_transform({s}, lambda x: CAST(x AS DOUBLE)) AS {n}_scores" for n, (s, _) in _heads.items())} FROM embeddings),
 decoded AS (SELECT vec_id, label AS dataset, {DUCK.pick(["Employee_Address", "Employee_Address_2", "blank_header_7", "Child#1 DOB", "Hospital.Election", "Class/Set"], "vec_id")} AS column_name,
 {", ".join(f"{_label_list(labels)}[list_position({n}_scores, list_max({n}_scores))] AS {n}" for n, (_, labels) in _heads.items())},
 {", ".join(f"list_position({n}_scores, list_max({n}_scores)) - 1 AS {n}_class" for n in _heads)},
 {", ".join(f"round(1 / list_sum(list_transform({n}_scores, lambda x: exp(x - list_max({n}_scores)))), 4) AS {n}_confidence" for n in _heads)} FROM heads)"""


def add_heads(df):
    """Three score arrays out of one vector."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    return df.withColumns(
        {
            "prod_scores": F.slice(vector, 1, 32),
            "hdr_scores": F.concat(vector, F.reverse(F.slice(vector, 1, 32))),
            "ent_scores": F.slice(vector, 33, 29),
        }
    )


@query("J8", f"WITH {HEADS_SQL} SELECT vec_id, {', '.join(f'CAST({n}_class AS INT) AS {n}_class' for n in _heads)} FROM decoded")
def argmax_classes(spark, sf):
    scored = add_heads(table(spark, sf, "embeddings"))
    return scored.select("vec_id", *[scoring.argmax(F.col(f"{n}_scores")).alias(f"{n}_class") for n in _heads])


@query("J9", f"WITH {HEADS_SQL} SELECT vec_id, {', '.join(f'{n}_confidence' for n in _heads)} FROM decoded")
def softmax_confidence(spark, sf):
    scored = add_heads(table(spark, sf, "embeddings"))
    return scored.select("vec_id", *[scoring.softmax_top(F.col(f"{n}_scores")).alias(f"{n}_confidence") for n in _heads])


@query("J10", f"WITH {HEADS_SQL} SELECT vec_id, {', '.join(_heads)} FROM decoded")
def decoded_labels(spark, sf):
    return headers.decode_heads(add_heads(table(spark, sf, "embeddings"))).select("vec_id", *_heads)


def rules_sql(source: str, carry: str) -> str:
    """The rule bank over (column_name, prod, hdr, ent), last rule first."""
    name = "column_name"
    return f"""ruled AS (SELECT {carry}, column_name,
  CASE WHEN prod <> 'UNK' AND hdr IN {q.members(fixed.PERSONAL_HEADERS)} THEN 'UNK'
    WHEN prod = 'ADDSUP' AND hdr = 'EffectiveDate' AND ent = 'Primary' AND {name} = 'Supplemental/Voluntary_Employee_AD&D_Effective_Date' THEN 'ADDVOL'
    WHEN prod = 'LIFESUP' AND hdr = 'Inforce Amount' AND ent = 'Primary' AND {name} = 'Supplemental/Voluntary_Employee_Life_In_Force_Amount' THEN 'LIFEVOL'
    WHEN prod = 'LIFESUP' AND hdr = 'EffectiveDate' AND {name} = 'Supplemental/Voluntary_Employee_Life_Effective_Date' THEN 'LIFEVOL'
    WHEN prod = 'LTD' AND ent = 'Primary' AND {name} IN {q.members(fixed.BASIC_LIFE_AMOUNTS)} THEN 'LIFE'
    WHEN prod = 'LIFEVOL' AND {name} IN {q.members(fixed.SUPPLEMENTAL_LIFE_BENEFITS)} THEN 'LIFESUP'
    WHEN prod = 'ADDSUP' AND {name} IN {q.members(fixed.VOLUNTARY_ADD_AMOUNTS)} THEN 'ADDVOL'
    WHEN prod = 'LIFESUP' AND {name} IN {q.members(fixed.VOLUNTARY_LIFE_AMOUNTS)} THEN 'LIFEVOL'
    WHEN prod IN ('VIS', 'DEN') AND ent IN ('Spouse', 'Child', 'Dependent') THEN 'UNK' ELSE prod END AS prod,
  CASE WHEN prod = 'UNK' AND hdr = 'Zip' AND ent = 'Primary' AND {name} = 'Employee_Address_3' THEN 'State'
    WHEN prod NOT IN ('UNK', 'primary') AND hdr = 'BinaryResponse' AND ent = 'Primary' THEN 'Applied For Amount'
    WHEN hdr = 'GF_BenefitAmount' THEN 'Grandfathered Amount'
    WHEN {name} = 'Employee_Address_3' AND hdr = 'AddressLine3' THEN 'Zip'
    WHEN {name} = 'Class/Set' THEN 'BenefitClass' WHEN {name} = 'Eligibility_DOH' THEN 'HireDate'
    WHEN {name} = 'Employee_Address' AND hdr = 'Zip' THEN 'AddressLine1' ELSE hdr END AS hdr,
  CASE WHEN ent = 'Child' AND prod IN ('CHLIFE', 'CHADD') THEN 'Primary'
    WHEN ent = 'UNK' AND hdr NOT IN ('GroupNumber', 'AccountNumber') THEN 'Primary'
    WHEN prod = 'UNK' AND hdr = 'UNK' AND ent = 'Primary' THEN 'UNK'
    WHEN prod <> 'UNK' AND hdr = 'UNK' AND ent = 'Primary' THEN 'UNK'
    WHEN hdr = 'AccountNumber' AND ent = 'Primary' AND prod = 'UNK' THEN 'UNK'
    WHEN ent = 'Dependent' AND {name} = 'Dependent_Relationship_Dependent_Relationship' THEN 'Spouse' ELSE ent END AS ent
 FROM {source})"""


def patterns_sql(source: str, carry: str) -> str:
    numbered, deep = "^.+([0-9])", "^dependent_relationship_dependent.+([0-9])"
    line = "regexp_extract(low, '^employee_address(_[0-9])?', 1)"
    return f"""low1 AS (SELECT *, lower(column_name) AS low FROM {source}),
 low2 AS (SELECT * REPLACE (CASE WHEN regexp_matches(low, '^hos.') AND hdr = 'CoverageTier' AND ent = 'UNK' THEN 'HI' ELSE prod END AS prod) FROM low1),
 low3 AS (SELECT * REPLACE (CASE WHEN regexp_matches(low, '{deep}') AND starts_with(lower(ent), 'dependent') AND hdr = 'Relationship' AND prod = 'UNK'
   THEN concat('Child-', regexp_extract(low, '{deep}', 1)) ELSE ent END AS ent) FROM low2),
 patterned AS (SELECT {carry}, column_name, prod,
   CASE WHEN NOT starts_with(low, 'employee_address') THEN hdr WHEN {line} = '' THEN 'AddressLine1' WHEN {line} = '_1' THEN 'City'
     WHEN {line} = '_2' THEN 'State' WHEN {line} = '_3' THEN 'Zip' ELSE hdr END AS hdr,
   CASE WHEN ent = 'Child' AND prod = 'UNK' AND regexp_matches(low, '{numbered}') THEN concat('Child-', regexp_extract(low, '{numbered}', 1)) ELSE ent END AS ent
 FROM low3)"""


@query("J11", q.with_views(["headers"], rules_sql("headers", "event_id"), select="SELECT * FROM ruled"))
def rule_bank(spark, sf):
    return rules.apply_rules(view(spark, sf, "headers"))


@query("J12", q.with_views(["headers"], rules_sql("headers", "event_id"), patterns_sql("ruled", "event_id"), select="SELECT * FROM patterned"))
def pattern_rules(spark, sf):
    return rules.apply_pattern_rules(rules.apply_rules(view(spark, sf, "headers")))


def _triplet_text(blank: str) -> str:
    pairs = " || '|' || ".join(f"{n} || '=' || CAST(round({n}_confidence * 10000) AS BIGINT)" for n in _heads)
    return f"CASE WHEN {blank} THEN 'UNK=10000|UNK=10000|UNK=10000' ELSE {pairs} END"


def triplet_text(c):
    parts = F.transform(
        c, lambda t: F.concat(t["label"], F.lit("="), F.round(t["confidence"] * 10000).cast("long").cast("string"))
    )
    return F.array_join(parts, "|")


SAMPLE_NAMES = ["Employee_Address", "Employee_Address_2", "blank_header_7", "Child#1 DOB", "Hospital.Election", "Class/Set"]


def decoded_headers(spark, sf):
    """Each vector is one header; its ten labels are the datasets."""
    name = F.get(F.array(*[F.lit(x) for x in SAMPLE_NAMES]), (F.col("vec_id") % len(SAMPLE_NAMES)).cast("int"))
    named = add_heads(table(spark, sf, "embeddings")).withColumns({"column_name": name, "dataset_id": F.col("label")})
    return headers.decode_heads(named)


@query("J13", f"WITH {HEADS_SQL} SELECT vec_id, column_name, {_triplet_text('''regexp_full_match(column_name, 'blank_header_[0-9]+')''')} AS triplet FROM decoded")
def blank_override(spark, sf):
    plain = rules.override_blank(rules.triplets(decoded_headers(spark, sf)))
    return plain.select("vec_id", "column_name", triplet_text(F.col("triplet")).alias("triplet"))


@query("J14", f"WITH {HEADS_SQL} SELECT vec_id, column_name, {_triplet_text('FALSE')} AS triplet FROM decoded")
def label_triplets(spark, sf):
    plain = rules.triplets(decoded_headers(spark, sf))
    return plain.select("vec_id", "column_name", triplet_text(F.col("triplet")).alias("triplet"))


# --- complete jobs ---------------------------------------------------------

STD_CORRECTED = q.corrected(STD_P, fixed.STD_PRIOR_ORIGINAL, fixed.STD_PRIOR_TRAIN)
STD_SQL = q.with_views(["claims"], q.STD_FEATURES, select=f"""SELECT "Claim Identifier" AS "claimNumber",
 CASE WHEN "NA_row" = 'N' THEN round({STD_CORRECTED}, 6) END AS "predictedProbability",
 CASE WHEN "NA_row" = 'N' THEN CAST({STD_CORRECTED} >= 0.5 AS INT) END AS "predictedValue" FROM std_features""")


def std_job(raw):
    return rounded(claims.score_std(raw, STD_TEMPLATE, models.LinearModel(STD_WEIGHTS, 2.5)))


@query("std", STD_SQL)
def std_claims(spark, sf):
    return std_job(view(spark, sf, "claims"))


LTD_TEMPLATE = [
    "Insured Age at Loss", "Insured Annualized Salary", "Policy Lives", "Duration Months", "days_to_report",
    "emp_tenure", "last_first_payment_lag", "prognosis_days", "Insured Salary Ind_WEEKLY", "Insured Salary Ind_YEARLY",
    "Insured Gender_F", "Claim State_TX", "Pre-Ex Outcome_Y", "SS Pursue Ind_YES", "Coverage Code_LTDBU",
    "Primary Diagnosis Code_M51.27", "DOT Exertion Level (Primary)_Light", "SIC Category_Retail", "gone",
]
LTD_SMALL = {
    "Insured Age at Loss": -0.01, "Insured Annualized Salary": 1e-5, "Policy Lives": 0.001, "Duration Months": 0.05,
    "days_to_report": 0.01, "emp_tenure": -0.0002, "last_first_payment_lag": 0.003, "prognosis_days": 0.002,
}
LTD_WEIGHTS = weights(LTD_TEMPLATE, LTD_SMALL)
_ltd_hot = {f: tuple(f.rsplit("_", 1)) for f in LTD_TEMPLATE[8:18]}
LTD_P = q.linear(LTD_WEIGHTS, -0.3, {f: f"coalesce({q.feature(f, _ltd_hot, ['gone'])}, 0)" for f in LTD_TEMPLATE})


@query("ltd", q.with_views(["claims"], q.LTD_FEATURES, select=f"""SELECT "Claim Identifier" AS "claimNumber",
 CASE WHEN "NA_row" = 'N' THEN round({LTD_P}, 6) END AS "predictedProbability",
 CASE WHEN "NA_row" = 'N' THEN CAST({LTD_P} >= 0.5 AS INT) END AS "predictedValue" FROM ltd_features"""))
def ltd_claims(spark, sf):
    return rounded(claims.score_ltd(view(spark, sf, "claims"), LTD_TEMPLATE, models.LinearModel(LTD_WEIGHTS, -0.3)))


SETTLEMENT_TEMPLATE = [
    "policy_tenure", "days_to_report", "prognosis_days", "Insured Annualized Salary", "Insured Age at Loss",
    "Policy Lives", "Insured Gender_F", "TSA Ind_Y", "SS Pri Status_others", "SS Pri Status_Approved",
    "Pre-Ex Outcome_Y", "SS Pri Award Amt_(1250-1500)", "SS Pri Award Amt_others",
    "Primary Diagnosis Category_injury_poisonining", "Primary Diagnosis Category_disease_respiratory_system",
    "Coverage Code_LTDVOL", "SIC Category_others", "pd_1_cat_very_high", "pd_1_cat_others", "pd_2_cat_medium",
    "medical_cond_comb_fracture", "medical_cond_comb_pain", "medical_cond_comb_radiculopathy",
    "medical_cond_comb_others", "sys_organ_comb_calcaneus", "sys_organ_comb_back", "sys_organ_comb_others",
    "sys_organ_comb_thoracic region",
]
NETWORK = weights(SETTLEMENT_TEMPLATE)
BOOSTER = {f: -w / 2 for f, w in NETWORK.items()}


def _settlement_expr() -> dict[str, str]:
    def holds(parts):
        return " OR ".join(f"contains(description, {q.lit(p)})" for p in parts)

    expr = {}
    for f in SETTLEMENT_TEMPLATE:
        if f in fixed.SETTLEMENT_KEYWORDS:
            expr[f] = f"CASE WHEN {holds(fixed.SETTLEMENT_KEYWORDS[f])} THEN 1 ELSE 0 END"
        elif f == "medical_cond_comb_others":
            expr[f] = f"CASE WHEN {holds(fixed.SETTLEMENT_CONDITIONS)} THEN 0 ELSE 1 END"
        elif f == "sys_organ_comb_others":
            expr[f] = f"CASE WHEN {holds(fixed.SETTLEMENT_ORGANS)} THEN 0 ELSE 1 END"
        elif f.startswith(fixed.CONDITION_PREFIX):
            expr[f] = f"CASE WHEN {holds([f[len(fixed.CONDITION_PREFIX):]])} THEN 1 ELSE 0 END"
        elif f.startswith(fixed.ORGAN_PREFIX):
            expr[f] = f"CASE WHEN {holds([f[len(fixed.ORGAN_PREFIX):]])} THEN 1 ELSE 0 END"
        elif f in fixed.SETTLEMENT_SCALED:
            i = fixed.SETTLEMENT_SCALED.index(f)
            expr[f] = f"(({q.name(f)} - m{i}) / s{i})"
        else:
            c = next(c for c in fixed.SETTLEMENT_ONE_HOT if f.startswith(c + "_"))
            expr[f] = f"CASE WHEN {q.name(c)} = {q.lit(f[len(c) + 1:])} THEN 1 ELSE 0 END"
    return expr


_expr = _settlement_expr()
_sstats = ", ".join(f"avg({q.name(c)}) AS m{i}, stddev_pop({q.name(c)}) AS s{i}" for i, c in enumerate(fixed.SETTLEMENT_SCALED))
_blend = "({} * 0.3::DOUBLE + {} * 0.7::DOUBLE)".format(
    *[q.corrected(q.linear(w, b, _expr), 0.1, 0.5) for w, b in ((NETWORK, 1.5), (BOOSTER, 2.0))]
)


@query("settlement", q.with_views(["claims"], q.SETTLEMENT_FEATURES, f"stats AS (SELECT {_sstats} FROM settlement_raw)", f"""scored AS (SELECT "Claim Identifier", "NA_row", {_blend} AS p FROM settlement_features, stats)""",
 select="""SELECT "Claim Identifier" AS "claimNumber", CASE WHEN "NA_row" = 'N' THEN round(p, 6) END AS "predictedProbability",
 CASE WHEN "NA_row" = 'N' THEN CAST(p >= 0.5 AS INT) END AS "predictedValue" FROM scored"""))
def settlement_claims(spark, sf):
    raw = view(spark, sf, "claims")
    scaler = scale.Scaler("standard").fit(claims.settlement_durations(raw), fixed.SETTLEMENT_SCALED)
    return rounded(
        claims.score_settlement(
            raw, SETTLEMENT_TEMPLATE, scaler, models.LinearModel(NETWORK, 1.5), models.LinearModel(BOOSTER, 2.0)
        )
    )


BRIDGING_TERMS = ["pain", "disc", "region", "fractur", "syndrom", "lumbar", "unspecifi", "diseas"]
BRIDGING_TEMPLATE = [
    "InsuredAnnualizedSalary", "emp_tenure", "initial_prognosis_days", "InsuredAgeatLoss", "pd_code_1_M51",
    "pd_code_2_27", "SIC_category_OOV", "InsuredGender_Male", "CaseSize_175-200", *BRIDGING_TERMS,
]
BRIDGING_SMALL = {
    "InsuredAnnualizedSalary": 1e-5, "emp_tenure": -0.0002, "initial_prognosis_days": 0.004, "InsuredAgeatLoss": 0.02,
}
# Stems of the words in the description samples, by the published description.
DESCRIPTION_STEMS = {
    "Other": "other", "intervertebral": "intervertebr", "disc": "disc", "displacement": "displac",
    "lumbosacral": "lumbosacr", "region": "region", "Unspecified": "unspecifi", "fracture": "fractur",
    "unspecified": "unspecifi", "calcaneus": "calcaneus", "initial": "initi", "encounter": "encount",
    "Unilateral": "unilater", "primary": "primari", "osteoarthritis": "osteoarthr", "right": "right",
    "knee": "knee", "Low": "low", "back": "back", "pain": "pain", "Sprain": "sprain", "ligaments": "ligament",
    "lumbar": "lumbar", "pelvis": "pelvi", "Carpal": "carpal", "tunnel": "tunnel", "syndrome": "syndrom",
    "bilateral": "bilater", "upper": "upper", "limbs": "limb", "Type": "type", "2": "2", "diabetes": "diabet",
    "mellitus": "mellitus", "proliferative": "prolif", "diabetic": "diabet", "retinopathy": "retinopathi",
    "eye": "eye", "Crohns": "crohn", "disease": "diseas", "small": "small", "large": "larg",
    "intestine": "intestin", "Major": "major", "depressive": "depress", "disorder": "disord", "single": "singl",
    "episode": "episod", "Malignant": "malign", "neoplasm": "neoplasm", "endometrium": "endometrium",
    "Spondylosis": "spondylosi", "radiculopathy": "radiculopathi", "cervical": "cervic", "Laceration": "lacer",
    "spleen": "spleen", "Complete": "complet", "rotator": "rotat", "cuff": "cuff", "tear": "tear", "or": "or",
    "rupture": "ruptur", "left": "left", "shoulder": "shoulder", "Migraine": "migrain", "without": "without",
    "aura": "aura", "intractable": "intract", "Cerebrovascular": "cerebrovascular", "thorax": "thorax",
    "Ankle": "ankl", "joint": "joint", "after": "after", "running": "run", "ABNORMAL": "abnorm",
    "FINDINGS": "find", "2019": "2019", "follow_up": "follow_up", "_na_": "_na_",
}
_cleaned = (
    "regexp_replace(array_to_string(list_filter(string_split(coalesce(\"PrimaryDiagnosisDecription\", '_na_'), ' '), "
    f"lambda w: NOT list_contains([{', '.join(q.lit(w) for w in STOPWORDS)}], w)), ' '), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')"
)
_stem_rows = ", ".join(f"({q.lit(k)}, {q.lit(v)})" for k, v in DESCRIPTION_STEMS.items())
_grouped = ["pd_code_1", "pd_code_2", "SIC_category", "InsuredGender", "CaseSize"]
_frequent = ", ".join(
    f"{c}_f AS (SELECT {q.name(c)} AS v FROM features GROUP BY 1 HAVING count({q.name(c)}) >= 20)" for c in _grouped
)


def _bridging_expr() -> dict[str, str]:
    expr = {}
    for f in BRIDGING_TEMPLATE:
        if f in BRIDGING_TERMS:
            expr[f] = f"coalesce(w.{f}, 0)"
        elif f in BRIDGING_SMALL:
            expr[f] = f"coalesce(f.{q.name(f)}, 0)"
        else:
            c = next(c for c in _grouped if f.startswith(c + "_"))
            kept = f"CASE WHEN f.{q.name(c)} IN (SELECT v FROM {c}_f) THEN f.{q.name(c)} ELSE 'OOV' END"
            expr[f] = f"CASE WHEN {kept} = {q.lit(f[len(c) + 1:])} THEN 1 ELSE 0 END"
    return expr


BRIDGING_WEIGHTS = weights(BRIDGING_TEMPLATE, BRIDGING_SMALL)
BRIDGING_P = q.linear(BRIDGING_WEIGHTS, -0.5, _bridging_expr())


BRIDGING_SQL = q.with_views(["snapshots"], q.BRIDGING_FEATURES, f"""features AS (SELECT *, {_cleaned} AS cleaned FROM bridging_features)""", _frequent,
 f"stems(word, stem) AS (VALUES {_stem_rows})",
 """texts AS (SELECT DISTINCT cleaned FROM features)""",
 """counts AS (SELECT cleaned, stem, count(*) AS n FROM (SELECT cleaned, unnest(string_split_regex(cleaned, '\\s+')) AS word FROM texts) JOIN stems USING (word) GROUP BY ALL)""",
 """idf AS (SELECT stem, ln((1 + (SELECT count(DISTINCT cleaned) FROM counts))::DOUBLE / (1 + count(*))) + 1 AS w FROM counts GROUP BY stem)""",
 """raw AS (SELECT cleaned, stem, n * w AS x FROM counts JOIN idf USING (stem))""",
 """normed AS (SELECT cleaned, stem, x / sqrt(sum(x * x) OVER (PARTITION BY cleaned)) AS x FROM raw)""",
 f"""w AS (SELECT cleaned, {', '.join(f"sum(CASE WHEN stem = {q.lit(t)} THEN x END) AS {t}" for t in BRIDGING_TERMS)} FROM normed GROUP BY cleaned)""",
 f"""scored AS (SELECT f."ClaimNumber", {BRIDGING_P} AS p FROM features f LEFT JOIN w ON f.cleaned = w.cleaned)""",
 select="""SELECT "ClaimNumber" AS "claimNumber", round(p, 6) AS "predictedProbability", CAST(p >= 0.5 AS INT) AS predicted_bridged_ind FROM scored""")


@query("bridging", BRIDGING_SQL)
def bridging_claims(spark, sf):
    features = materialise(bridging.bridging_features(view(spark, sf, "snapshots"), SNAPSHOT_TIEBREAK))
    given = bridging.described(features, STOPWORDS)
    stems = bridging.description_stems(features, STOPWORDS, given)
    tfidf = TfIdf().fit_counts(stems, "text_key")
    worded = bridging.add_terms(features, stems, tfidf, BRIDGING_TERMS, STOPWORDS, given)
    filled = worded.fillna(0.0, subset=list(BRIDGING_SMALL))
    grouper = RareGrouper(20).fit(features, fixed.BRIDGING_CATEGORICAL)
    model = models.LinearModel(BRIDGING_WEIGHTS, -0.5)
    return rounded(bridging.score_bridging(filled, BRIDGING_TEMPLATE, grouper, model))


@query("A9", f"""SELECT concat("claimNumber", ':0') AS source, "claimNumber" AS entity, 1 AS entries,
 "predictedProbability", predicted_bridged_ind FROM ({BRIDGING_SQL})""")
def bridging_envelopes(spark, sf):
    """One envelope per scored row, its result a list of one entry."""
    wrapped = envelope(bridging_claims(spark, sf), "claimNumber", ["predictedProbability", "predicted_bridged_ind"], as_list=True)
    entry = F.get("predictedResult", F.lit(0))
    return wrapped.select(
        F.col("inputDataSource").alias("source"), F.col("entityId").alias("entity"), F.size("predictedResult").alias("entries"),
        entry["predictedProbability"].alias("predictedProbability"), entry["predicted_bridged_ind"].alias("predicted_bridged_ind"),
    )


def _annuity_sql(defaults, logins, numeric, categorical, flags, skip, scaled, knots, intercept, threshold) -> str:
    """Both annuity jobs: filled and derived columns, fitted numbers, encoded categories, score."""
    who = '"V_SYSTEM_LOGON_ID"'
    derived = {"webservices": f"CASE WHEN contains({who}, 'WebServices') THEN 1 ELSE 0 END",
               "no_employees": f"len(string_split(coalesce({who}, 'None'), ','))"}
    columns = []
    for c in numeric:
        x = derived.get(c) or q.name(c)
        columns.append(f"CAST({f'coalesce({x}, {q.lit(defaults[c])})' if c in defaults else x} AS DOUBLE) AS {q.name(c)}")
    for c in categorical:
        x = q.name(c)
        if c == "CONTRACTDATA_WRITINGCODE":
            x = f"coalesce(regexp_extract({x}, '''([^'']*)''', 1), 'Unknown')"
        elif c in defaults:
            x = f"coalesce({x}, {q.lit(defaults[c])})"
        columns.append(f"{x} AS {q.name(c)}")
    columns += [f"CAST(coalesce({q.name(c)}, FALSE) AS INT) AS {q.name(c)}" for c in flags]
    levels = []
    for i, x in enumerate(logins, 1):
        if f"emp_level_{i}" not in skip:
            levels.append(f"emp_level_{i}")
            columns.append(f"CASE WHEN contains({who}, {q.lit(x)}) THEN 1 ELSE 0 END AS emp_level_{i}")
    fitted = ", ".join(f"{knots(q.name(c))} AS k{i}" for i, c in enumerate(scaled))
    stats = [
        f"t{i} AS (SELECT {q.name(c)} AS v, sum(\"class\") AS s, count(*) AS n FROM built GROUP BY 1 HAVING count(*) > 1)"
        for i, c in enumerate(categorical)
    ]
    joins = " ".join(f"LEFT JOIN t{i} ON b.{q.name(c)} = t{i}.v" for i, c in enumerate(categorical))
    expr = {c: f"b.{q.name(c)}" for c in [*numeric, *flags, *levels]}
    for i, c in enumerate(scaled):
        expr[c] = scaled_expr(f"b.{q.name(c)}", f"k{i}", knots)
    expr.update({c: f"coalesce((t{i}.s + prior) / (t{i}.n + 1), prior)" for i, c in enumerate(categorical)})
    p = q.linear(weights([*numeric, *categorical, *flags, *levels]), intercept, expr)
    parts = [f"built AS (SELECT \"TRXNUM\", \"class\", {', '.join(columns)} FROM annuities)", *stats]
    parts += ["p AS (SELECT avg(\"class\") AS prior FROM built)", f"fitted AS (SELECT {fitted} FROM built)"]
    return q.with_views(["annuities"], *parts, select=f'SELECT b."TRXNUM", CAST({p} >= {q.lit(threshold)} AS INT) AS predicted_disposition FROM built b CROSS JOIN p CROSS JOIN fitted {joins}')


ANNUITY_POINTS = 21


def robust_knots(x: str) -> str:
    return f"quantile_cont({x}, [0.25, 0.5, 0.75])"


def share_knots(x: str) -> str:
    return knots_sql(x, ANNUITY_POINTS)


def scaled_expr(x: str, k: str, knots) -> str:
    if knots is share_knots:
        return quantile_sql(x, k, ANNUITY_POINTS)
    spread = f"({k}[3] - {k}[1])"
    return f"(({x} - {k}[2]) / CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END)"


_txn_levels = [
    f"emp_level_{i}" for i in range(1, len(fixed.TRANSACTION_LOGINS) + 1)
    if f"emp_level_{i}" not in fixed.TRANSACTION_UNUSED_LEVELS
]
_app_levels = [f"emp_level_{i}" for i in range(1, len(fixed.APPLICATION_LOGINS) + 1)]


@query("transactions", _annuity_sql(
    fixed.TRANSACTION_DEFAULTS, fixed.TRANSACTION_LOGINS, fixed.TRANSACTION_NUMERIC, fixed.TRANSACTION_CATEGORICAL,
    fixed.TRANSACTION_BOOLEAN, fixed.TRANSACTION_UNUSED_LEVELS, fixed.TRANSACTION_NUMERIC, robust_knots, -0.8,
    fixed.TRANSACTION_THRESHOLD))
def annuity_transactions(spark, sf):
    raw = view(spark, sf, "annuities")
    features = annuity.transaction_features(raw, carry=["class"])
    scaler = scale.Scaler("robust").fit(features, fixed.TRANSACTION_NUMERIC)
    encoder = TargetEncoder().fit(features, fixed.TRANSACTION_CATEGORICAL, "class")
    names = [*fixed.TRANSACTION_NUMERIC, *fixed.TRANSACTION_CATEGORICAL, *fixed.TRANSACTION_BOOLEAN, *_txn_levels]
    return annuity.score_transactions(raw, scaler, encoder, models.LinearModel(weights(names), -0.8))


_event_dates = [c.removesuffix("diff") for c in fixed.TRANSACTION_NUMERIC if c.endswith("diff")]


def _transaction_dates(d) -> dict[str, str]:
    """The date of processing and those of the events, some unknown and some later."""
    dates = {
        c: f"CASE WHEN event_id % {i + 5} = 0 THEN NULL ELSE {d.us(d.shift('ts', f'60 - event_id * {i + 3} % 900'))} END"
        for i, c in enumerate(_event_dates)
    }
    return {"employee": "user_id", "TRXHDRDATA_PROCESSEDDATE": d.iso("ts"), **dates}


_at = "date_diff('day', CAST(strptime({}, '%m/%d/%Y') AS DATE), CAST(d.\"TRXHDRDATA_PROCESSEDDATE\"::TIMESTAMP AS DATE))"
_lags = {f"{c}diff": _at.format(f"d.{q.name(c)}") for c in _event_dates}
_own = {
    "uc2_employee_total_policy_count": "t.n", "uc7_employee_zero_task_count": "t.idle", "uc7_employee_ratio": "t.high / nullif(t.n - t.idle, 0)",
    "uc8_employee_policy_count": "t.n", "uc8_employee_mean_change_days": "t.days / nullif(t.changes, 0)", "uc8_employee_ratio": "t.changed / t.n",
    **{c: f"CASE WHEN {x} >= 0 THEN {x} ELSE -1 END" for c, x in _lags.items()},
}
_EVENT_JOB = f"""dates AS (SELECT event_id, {', '.join(f'{x} AS {q.name(c)}' for c, x in _transaction_dates(DUCK).items())} FROM events),
 per AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS policy, count(*) FILTER (event_type IN ('click', 'view')) AS tasks,
   count(*) FILTER (event_type = 'error') AS changes,
   sum(CASE WHEN event_type = 'error' THEN date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) END) AS days FROM events GROUP BY ALL),
 totals AS (SELECT user_id, count(*) AS n, count(*) FILTER (tasks = 0) AS idle, count(*) FILTER (tasks >= 2) AS high,
   sum(changes) AS changes, count(*) FILTER (changes > 0) AS changed, sum(days) AS days FROM per GROUP BY user_id),
 joined AS (SELECT a.* REPLACE ({', '.join(f'{x} AS {q.name(c)}' for c, x in _own.items())})
   FROM annuities a JOIN dates d ON a."TRXNUM" = d.event_id LEFT JOIN totals t ON d.employee = t.user_id),
 built AS ("""
EVENT_JOB_SQL = (
    SQL["annuity_transactions"].replace("built AS (", _EVENT_JOB, 1).replace("FROM annuities)", "FROM joined)", 1)
)


@query("transactions from events", f"""WITH scored AS ({EVENT_JOB_SQL}),
 placed AS (SELECT *, row_number() OVER (ORDER BY "TRXNUM") AS place FROM scored)
 SELECT 'RANDN1209:0' AS source, 'RAND1209' AS entity, (place - 1) // 500 AS part, CAST(count(*) AS INT) AS n,
 CAST(sum(predicted_disposition) AS BIGINT) AS flagged, CAST(min("TRXNUM") AS BIGINT) AS first FROM placed GROUP BY ALL""")
def annuity_events_to_envelopes(spark, sf):
    """The whole transaction job: raw events to employee totals and lags, features, scores and envelopes."""
    fields = {**VIEWS["annuities"][1](SPARK), **_transaction_dates(SPARK)}
    events = table(spark, sf, "events").withColumn("policy", F.get_json_object("props", "$.k").cast("long"))
    named = events.selectExpr(*[f"{x} AS {SPARK.name(c)}" for c, x in fields.items()])
    days = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    kind = F.col("event_type")
    totals = annuity.employee_totals(
        events, "user_id", "policy", kind.isin("click", "view"), kind == "error", days, F.col("value"), kind == "purchase", F.col("value"), 2
    )
    raw = annuity.transactions_of_events(
        named, totals.withColumnRenamed("user_id", "employee"), "employee", "TRXHDRDATA_PROCESSEDDATE", _event_dates
    )
    raw = materialise(raw)
    features = annuity.transaction_features(raw, carry=["class"])
    scaler = scale.Scaler("robust").fit(features, fixed.TRANSACTION_NUMERIC)
    encoder = TargetEncoder().fit(features, fixed.TRANSACTION_CATEGORICAL, "class")
    names = [*fixed.TRANSACTION_NUMERIC, *fixed.TRANSACTION_CATEGORICAL, *fixed.TRANSACTION_BOOLEAN, *_txn_levels]
    scored = annuity.score_transactions(raw, scaler, encoder, models.LinearModel(weights(names), -0.8))
    parts = transaction_envelope(scored, "TRXNUM", ["TRXNUM", "predicted_disposition"], part_rows=500)
    flagged = F.aggregate("predictedResult", F.lit(0).cast("long"), lambda acc, r: acc + r["predicted_disposition"])
    return parts.select(
        F.col("inputDataSource").alias("source"), F.col("entityId").alias("entity"), "part", F.size("predictedResult").alias("n"),
        flagged.alias("flagged"), F.get("predictedResult", F.lit(0))["TRXNUM"].alias("first"),
    )


@query("applications", _annuity_sql(
    fixed.APPLICATION_DEFAULTS, fixed.APPLICATION_LOGINS, fixed.APPLICATION_NUMERIC, fixed.APPLICATION_CATEGORICAL,
    [], [], annuity.APPLICATION_TRANSFORMED, share_knots, -0.4, fixed.APPLICATION_THRESHOLD))
def annuity_applications(spark, sf):
    raw = view(spark, sf, "annuities")
    features = annuity.application_features(raw, carry=["class"])
    quantiles = scale.QuantileTransform(ANNUITY_POINTS).fit(features, annuity.APPLICATION_TRANSFORMED)
    encoder = TargetEncoder().fit(features, fixed.APPLICATION_CATEGORICAL, "class")
    names = [*fixed.APPLICATION_NUMERIC, *fixed.APPLICATION_CATEGORICAL, *_app_levels]
    return annuity.score_applications(raw, quantiles, encoder, models.LinearModel(weights(names), -0.4))


@query("headers", f"""WITH {HEADS_SQL}, {rules_sql("decoded", "vec_id, dataset, prod_confidence, hdr_confidence, ent_confidence")},
 {patterns_sql("ruled", "vec_id, dataset, prod_confidence, hdr_confidence, ent_confidence")},
 texts AS (SELECT vec_id, dataset, column_name || ':' || {_triplet_text("regexp_full_match(column_name, 'blank_header_[0-9]+')")} AS t FROM patterned)
 SELECT concat(dataset, ':0') AS source, dataset AS entity, (place - 1) // 100 AS part, CAST(count(*) AS INT) AS n, string_agg(t, ';' ORDER BY vec_id) AS result
 FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY vec_id) AS place FROM texts) GROUP BY ALL""")
def labelled_headers(spark, sf):
    """Score arrays to envelopes: decode, rules, patterns, override, assembly."""
    labelled = headers.correct_labels(decoded_headers(spark, sf))
    parts = envelope_batch(labelled, "dataset_id", "vec_id", ["column_name", "triplet"], part_rows=100)
    lines = F.transform("predictedResult", lambda r: F.concat(r["column_name"], F.lit(":"), triplet_text(r["triplet"])))
    return parts.select(
        F.col("inputDataSource").alias("source"), F.col("entityId").alias("entity"), "part",
        F.size("predictedResult").alias("n"), F.array_join(lines, ";").alias("result"),
    )


@query("A10", """WITH scored AS (SELECT CASE WHEN event_id % 2 <> 0 THEN event_id * 3 END AS id, CAST(value >= 0.3193858391936 AS INT) AS flag FROM events),
 placed AS (SELECT *, row_number() OVER (ORDER BY id NULLS FIRST, flag) AS place FROM scored)
 SELECT 'RANDN1209:0' AS source, 'RAND1209' AS entity, (place - 1) // 500 AS part, CAST(count(*) AS INT) AS n,
 CAST(sum(flag) AS BIGINT) AS flagged FROM placed GROUP BY ALL""")
def transaction_envelopes(spark, sf):
    """Sparse transaction numbers, every other row without one."""
    number = F.when(F.col("event_id") % 2 != 0, F.col("event_id") * 3)
    events = table(spark, sf, "events").withColumn("TRXNUM", number)
    scored = annuity.disposition(events, "value", fixed.TRANSACTION_THRESHOLD)
    parts = transaction_envelope(scored, "TRXNUM", ["TRXNUM", "predicted_disposition"], part_rows=500)
    flagged = F.aggregate("predictedResult", F.lit(0).cast("long"), lambda acc, r: acc + r["predicted_disposition"])
    return parts.select(
        F.col("inputDataSource").alias("source"), F.col("entityId").alias("entity"), "part",
        F.size("predictedResult").alias("n"), flagged.alias("flagged"),
    )


@query("A9", STD_SQL.replace('SELECT "Claim Identifier" AS "claimNumber",', """SELECT concat("Claim Identifier", ':0') AS source, "Claim Identifier" AS entity,"""))
def scored_envelope(spark, sf):
    wrapped = envelope(std_job(view(spark, sf, "claims")), "claimNumber", RESULT)
    return wrapped.select(
        F.col("inputDataSource").alias("source"), F.col("entityId").alias("entity"),
        F.col("predictedResult.predictedProbability").alias("predictedProbability"),
        F.col("predictedResult.predictedValue").alias("predictedValue"),
    )
