"""Pieces of DuckDB SQL shared by the SQL forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from claimflow import fixed_values as fixed
from queries.views import DUCK, view_sql


def lit(value) -> str:
    return DUCK.text(value) if isinstance(value, str) or value is None else f"CAST({value!r} AS DOUBLE)"


def name(c: str) -> str:
    return f'"{c}"'


def ts(c: str) -> str:
    return f"try_strptime({c}, ['%m/%d/%Y', '%Y-%m-%d %H:%M:%S'])"


def num(c: str) -> str:
    return f"TRY_CAST(nullif(trim(CAST({c} AS VARCHAR)), '') AS DOUBLE)"


def days(a: str, b: str) -> str:
    return f"(CAST(epoch_us({b}) - epoch_us({a}) AS DOUBLE) / 86400000000)"


def pos(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN {x} END"


def members(values: Sequence[str]) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def groups(x: str, table: Mapping[str, Sequence[str]], default: str) -> str:
    arms = " ".join(f"WHEN {x} IN {members(v)} THEN {lit(k)}" for k, v in table.items())
    return f"CASE {arms} ELSE {default} END"


def prefixes(x: str, table, allowed, unknown: str, other: str) -> str:
    arms = " ".join(f"WHEN {x} LIKE {lit(p + '%')} THEN {lit(g)}" for p, g in table)
    filled = f"CASE WHEN {x} IS NULL OR {x} = '' THEN {lit(unknown)} ELSE {x} END"
    return (
        f"CASE {arms} WHEN {filled} IN {members(allowed)} THEN {filled} ELSE {lit(other)} END"
    )


def blank(c: str) -> str:
    return f"CASE WHEN NOT regexp_full_match({c}, '\\s*') THEN {c} END"


def lacking(columns: Sequence[str]) -> str:
    test = " OR ".join(f"{name(c)} IS NULL" for c in columns)
    return f"CASE WHEN {test} THEN 'Y' ELSE 'N' END"


def feature(template_name: str, hot: Mapping[str, tuple[str, str]], absent: Sequence[str] = ()) -> str:
    if template_name in absent:
        return "0"
    if template_name in hot:
        c, v = hot[template_name]
        return f"(CASE WHEN {name(c)} = {lit(v)} THEN 1 ELSE 0 END)"
    return name(template_name)


def linear(weights: Mapping[str, float], intercept: float, expr: Mapping[str, str] | None = None) -> str:
    z = lit(float(intercept))
    for f, w in weights.items():
        z = f"({z} + CAST({(expr or {}).get(f, name(f))} AS DOUBLE) * {lit(float(w))})"
    return f"(1 / (1 + exp(-({z}))))"


def corrected(p: str, original: float, trained: float) -> str:
    up, down = original / trained, (1 - original) / (1 - trained)
    return f"(({p} * {lit(up)}) / ({p} * {lit(up)} + (1 - {p}) * {lit(down)}))"


STD_GROUP = prefixes(
    'upper("Primary Diagnosis Category")', fixed.STD_DIAGNOSIS_PREFIXES,
    fixed.STD_DIAGNOSIS_GROUPS, "UNKNOWN", "OTHERS",
)
STD_RISK = groups('"SIC Code"', {"High": fixed.STD_SIC_HIGH, "Medium": fixed.STD_SIC_MEDIUM}, "'Low'")
STD_COVERAGE = groups(
    '"Coverage Code"', {"STDCORE": fixed.STD_COVERAGE_CORE, "STDVOL": fixed.STD_COVERAGE_VOLUNTARY}, "'OTHERS'"
)
SETTLEMENT_GROUP = prefixes(
    'lower("Primary Diagnosis Category")', fixed.SETTLEMENT_DIAGNOSIS_PREFIXES,
    fixed.SETTLEMENT_DIAGNOSIS_GROUPS, "unknown", "others",
)
AWARD = "CASE WHEN {0} IS NULL OR {0} = '' THEN 'NA' ELSE substr({0}, 2) END".format('"SS Pri Award Amt"')
AWARD_BIN = groups(f"({AWARD})", fixed.SETTLEMENT_AWARD_BINS, f"({AWARD})")
SALARY_WORDS = groups('"Insured Salary Ind"', {v: [k] for k, v in fixed.LTD_SALARY_FREQUENCY.items()}, '"Insured Salary Ind"')
PRE_EX = groups('"Pre-Ex Outcome"', {v: [k] for k, v in fixed.LTD_PRE_EXISTING.items()}, '"Pre-Ex Outcome"')

LOSS, RECEIVED = ts('"Loss Date"'), ts('"Received Date"')
HIRED, DURATION = ts('"Insured Hire Date"'), ts('"Duration Date"')
MONTHS = num('"Duration Months"')
EMP = days(HIRED, LOSS)
REPORT = days(LOSS, RECEIVED)
POLICY = "coalesce({}, {})".format(
    days(ts('"Policy Effective Date"'), ts('"Policy Termination Date"')),
    days(ts('"Policy Effective Date"'), RECEIVED),
)
PROGNOSIS = f"coalesce({pos(days(LOSS, DURATION))}, {pos(f'{MONTHS} * 30')})"
LAG = days(ts('"First Payment From Date"'), ts('"Last Payment To Date"'))
FIRST_PAY = days(LOSS, ts('"First Payment From Date"'))

STD_FEATURES = f"""std_raw AS (SELECT "Claim Identifier", "SIC Code", "Insured Gender", "Insured Salary Ind",
  {num('"Insured Age at Loss"')} AS "Insured Age at Loss",
  {num('"Insured Annualized Salary"')} AS "Insured Annualized Salary",
  {num('"Policy Lives"')} AS "Policy Lives",
  {STD_GROUP} AS "Primary Diagnosis Category", {STD_RISK} AS "SIC_risk_ind",
  {STD_COVERAGE} AS "Coverage Code",
  {pos(POLICY)} AS policy_tenure,
  CASE WHEN {REPORT} < 0 THEN 0 ELSE {REPORT} END AS days_to_report,
  {pos(EMP)} AS emp_tenure, {PROGNOSIS} AS prognosis_days
FROM claims),
std_features AS (SELECT *, {lacking(fixed.STD_REQUIRED)} AS "NA_row" FROM std_raw)"""

LTD_TEXT = [c for c in fixed.LTD_CATEGORICAL if c not in ("Insured Salary Ind", "Pre-Ex Outcome")]
LTD_FEATURES = f"""ltd_raw AS (SELECT "Claim Identifier", "Claim Status Code", {", ".join(name(c) for c in LTD_TEXT)},
  {SALARY_WORDS} AS "Insured Salary Ind", {PRE_EX} AS "Pre-Ex Outcome",
  {num('"Insured Age at Loss"')} AS "Insured Age at Loss",
  {num('"Insured Annualized Salary"')} AS "Insured Annualized Salary",
  {num('"Policy Lives"')} AS "Policy Lives", {MONTHS} AS "Duration Months",
  CASE WHEN {REPORT} >= 0 THEN {REPORT} END AS days_to_report,
  {pos(EMP)} AS emp_tenure, {PROGNOSIS} AS prognosis_days,
  CASE WHEN {LAG} >= 0 THEN {LAG} END AS last_first_payment_lag
FROM claims),
ltd_features AS (SELECT *, {lacking(fixed.LTD_REQUIRED)} AS "NA_row" FROM ltd_raw)"""

_text = [c for c in fixed.SETTLEMENT_CATEGORICAL + ["Primary Diagnosis Code", "Primary Diagnosis Desc"]]
SETTLEMENT_RAW = f"""settlement_raw AS (SELECT "Claim Identifier",
  {", ".join(f"{blank(name(c))} AS {name(c)}" for c in _text)},
  {num('"Insured Age at Loss"')} AS "Insured Age at Loss",
  {num('"Insured Annualized Salary"')} AS "Insured Annualized Salary",
  {num('"Policy Lives"')} AS "Policy Lives",
  {POLICY} AS policy_tenure, {REPORT} AS days_to_report, {EMP} AS emp_tenure,
  {PROGNOSIS} AS prognosis_days, {FIRST_PAY} AS days_to_first_payment
FROM claims),
settlement_flagged AS (SELECT *, {lacking(fixed.SETTLEMENT_REQUIRED)} AS "NA_row" FROM settlement_raw)"""


def collapse_listed(c: str, values: Sequence[str], to: str) -> str:
    return f"CASE WHEN {c} IN {members(values)} THEN {lit(to)} ELSE {c} END"


def code_part(c: str, i: int, missing: str) -> str:
    return f"(string_split(coalesce({c}, {lit(missing)}), '.'))[{i + 1}]"


SETTLEMENT_MAPPED = {
    "Primary Diagnosis Category": SETTLEMENT_GROUP,
    "SIC Category": f"""CASE WHEN substr("SIC Code", 1, 2) IN {members(fixed.SETTLEMENT_SIC_KEPT)} THEN substr("SIC Code", 1, 2) ELSE 'others' END""",
    "SS Pri Status": collapse_listed('"SS Pri Status"', fixed.SETTLEMENT_SS_STATUS_DROPPED, "others"),
    "Coverage Code": collapse_listed('"Coverage Code"', fixed.SETTLEMENT_COVERAGE_MERGED, "LTDVOL"),
    "SS Pri Award Amt": AWARD_BIN,
    "pd_1_cat": groups(code_part('"Primary Diagnosis Code"', 0, "_na"), fixed.SETTLEMENT_CODE1_TIERS, "'others'"),
    "pd_2_cat": groups(code_part('"Primary Diagnosis Code"', 1, "_na"), fixed.SETTLEMENT_CODE2_TIERS, "'others'"),
    "description": """lower(coalesce("Primary Diagnosis Desc", '__na__'))""",
}
SETTLEMENT_FEATURES = f"""{SETTLEMENT_RAW},
settlement_features AS (SELECT * REPLACE ({", ".join(f"{x} AS {name(c)}" for c, x in SETTLEMENT_MAPPED.items() if c in ("Primary Diagnosis Category", "SS Pri Status", "Coverage Code", "SS Pri Award Amt"))}),
  {", ".join(f"{x} AS {name(c)}" for c, x in SETTLEMENT_MAPPED.items() if c in ("SIC Category", "pd_1_cat", "pd_2_cat", "description"))}
FROM settlement_flagged)"""

_dates = ["ApprovalDate", "DurationDate", "ReceivedDate", "LossDate", "InsuredHireDate"]
BRIDGING_ROWS = f"""eligible_rows AS (SELECT * REPLACE ({", ".join(f"{ts(name(c))} AS {name(c)}" for c in _dates)})
FROM snapshots WHERE "ClaimStatusDescription" IN {members(fixed.BRIDGING_ELIGIBLE)}
  AND NOT ("ClaimStatusDescription" = {lit(fixed.BRIDGING_REVIEW_STATUS)} AND coalesce("ClaimStatusCode", '-') = {lit(fixed.BRIDGING_CLOSED_CODE)}))"""
FIRST_SNAPSHOT = """first_rows AS (SELECT "ClaimNumber", "BenefitCaseType", "DurationDate" FROM (
  SELECT *, row_number() OVER (PARTITION BY "ClaimNumber" ORDER BY "ApprovalDate" ASC NULLS FIRST,
    l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place FROM eligible_rows) WHERE place = 1)"""
MIDPOINT = """(CASE WHEN {0} IS NULL THEN 0 ELSE (TRY_CAST((string_split({0}, '-'))[1] AS DOUBLE) + TRY_CAST((string_split({0}, '-'))[2] AS DOUBLE)) / 2 END)""".format('"InsuredAnnualizedSalary"')
BRIDGING_FEATURES = f"""{BRIDGING_ROWS},
{FIRST_SNAPSHOT},
distinct_features AS (SELECT DISTINCT {", ".join(name(c) for c in fixed.BRIDGING_COLUMNS)} FROM eligible_rows),
bridging_features AS (SELECT f."ClaimNumber", f."InsuredGender", f."InsuredSalaryIndicator",
  f."DOTPrimaryExertionLevel", f."CaseSize", f."PrimaryDiagnosisDecription", f."PrimaryDiagnosisCategory",
  f."InsuredAgeatLoss", {MIDPOINT} AS "InsuredAnnualizedSalary",
  substr(CAST(f."SICCode" AS VARCHAR), 1, 2) AS "SIC_category",
  {code_part('f."PrimaryDiagnosisCode"', 0, "na.na")} AS pd_code_1,
  {code_part('f."PrimaryDiagnosisCode"', 1, "na.na")} AS pd_code_2,
  {days('f."InsuredHireDate"', 'f."LossDate"')} AS emp_tenure,
  {pos(days('f."LossDate"', 's."DurationDate"'))} AS initial_prognosis_days
FROM distinct_features f JOIN first_rows s ON f."ClaimNumber" = s."ClaimNumber"
WHERE s."BenefitCaseType" = 'STD')"""


def with_views(views: Sequence[str], *parts: str, select: str) -> str:
    return "WITH " + ",\n".join([*(view_sql(v) for v in views), *parts]) + "\n" + select
