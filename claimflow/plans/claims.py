"""Short-term, long-term and settlement scoring: one narrow stage each.

Nothing in these jobs looks at a second row, so they run without a shuffle on
any number of claims, and unchanged on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow import fixed_values as fixed
from claimflow.functions import categories, cleaning, scoring, tenure, text
from claimflow.operators.complete import flag_incomplete, unreadable
from claimflow.operators.encode import align, nan_to_num
from claimflow.operators.projection import drop_dates, payload, quoted, require
from claimflow.operators.scale import Scaler
from claimflow.plans.specs import LTD, SETTLEMENT, STD, ModelSpec

ENTITY = "Claim Identifier"


def parsed(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Required columns with dates and numbers in their types.

    Text that is no number is NULL, which makes the row incomplete and leaves the job
    running; ``rejected`` lists such rows.
    """
    numbers = dict.fromkeys([*spec.numeric, "Duration Months"])
    return require(df, spec.columns).withColumns(
        {
            **{c: cleaning.parse_timestamp(quoted(c)) for c in spec.dates},
            **{c: cleaning.parse_number(quoted(c), strict=False) for c in numbers},
        }
    )


def rejected(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Rows with text that could not be read: their id and (column, value) of each."""
    numbers = [c for c in dict.fromkeys([*spec.numeric, "Duration Months"]) if c in df.columns]
    readers = {
        **{c: cleaning.parse_timestamp(quoted(c)) for c in spec.dates if c in df.columns},
        **{c: cleaning.parse_number(quoted(c), strict=False) for c in numbers},
    }
    return unreadable(df, ENTITY, readers)


def std_groups() -> dict[str, Column]:
    coverage = {"STDCORE": fixed.STD_COVERAGE_CORE, "STDVOL": fixed.STD_COVERAGE_VOLUNTARY}
    risk = {"High": fixed.STD_SIC_HIGH, "Medium": fixed.STD_SIC_MEDIUM}
    return {
        "Primary Diagnosis Category": categories.map_prefix(
            F.upper(quoted("Primary Diagnosis Category")), fixed.STD_DIAGNOSIS_PREFIXES,
            fixed.STD_DIAGNOSIS_GROUPS, "UNKNOWN", "OTHERS",
        ),
        "SIC_risk_ind": categories.map_members(quoted("SIC Code").cast("string"), risk, "Low"),
        "Coverage Code": categories.map_members(quoted("Coverage Code"), coverage, "OTHERS"),
    }


def std_features(df: DataFrame) -> DataFrame:
    col = quoted
    built = parsed(df, STD).withColumns(
        {
            **std_groups(),
            "policy_tenure": tenure.policy_tenure(
                col("Policy Effective Date"), col("Policy Termination Date"), col("Received Date")
            ),
            "days_to_report": tenure.days_to_report(col("Loss Date"), col("Received Date"), "zero"),
            "emp_tenure": tenure.emp_tenure(col("Insured Hire Date"), col("Loss Date")),
            "prognosis_days": tenure.prognosis_days(
                col("Loss Date"), col("Duration Date"), col("Duration Months")
            ),
        }
    )
    kept = drop_dates(built).drop("Insured Zip", "Duration Months")
    return flag_incomplete(kept, STD.required)


def ltd_features(df: DataFrame) -> DataFrame:
    col = quoted
    built = parsed(df, LTD).withColumns(
        {
            "days_to_report": tenure.days_to_report(col("Loss Date"), col("Received Date"), "null"),
            "emp_tenure": tenure.emp_tenure(col("Insured Hire Date"), col("Loss Date")),
            "last_first_payment_lag": tenure.payment_lag(
                col("First Payment From Date"), col("Last Payment To Date")
            ),
            "prognosis_days": tenure.prognosis_days(
                col("Loss Date"), col("Duration Date"), col("Duration Months")
            ),
            "Insured Salary Ind": categories.remap(
                col("Insured Salary Ind"), fixed.LTD_SALARY_FREQUENCY
            ),
            "Pre-Ex Outcome": categories.remap(col("Pre-Ex Outcome"), fixed.LTD_PRE_EXISTING),
        }
    )
    kept = drop_dates(built).drop("Claim Status Category")
    return flag_incomplete(kept, LTD.required)


def settlement_groups() -> dict[str, Column]:
    col = quoted
    code = col("Primary Diagnosis Code")
    return {
        "Primary Diagnosis Category": categories.map_prefix(
            F.lower(col("Primary Diagnosis Category")), fixed.SETTLEMENT_DIAGNOSIS_PREFIXES,
            fixed.SETTLEMENT_DIAGNOSIS_GROUPS, "unknown", "others",
        ),
        "SIC Category": categories.collapse_except(
            categories.sic_division(col("SIC Code")), fixed.SETTLEMENT_SIC_KEPT
        ),
        "Insured Salary Ind": categories.collapse_listed(
            col("Insured Salary Ind"), fixed.SETTLEMENT_SALARY_DROPPED
        ),
        "SS Pri Status": categories.collapse_listed(
            col("SS Pri Status"), fixed.SETTLEMENT_SS_STATUS_DROPPED
        ),
        "Coverage Code": categories.collapse_listed(
            col("Coverage Code"), fixed.SETTLEMENT_COVERAGE_MERGED, "LTDVOL"
        ),
        "SS Pri Award Amt": categories.award_bin(col("SS Pri Award Amt"), fixed.SETTLEMENT_AWARD_BINS),
        "pd_1_cat": categories.map_members(
            categories.code_part(code, 0, "_na"), fixed.SETTLEMENT_CODE1_TIERS, "others"
        ),
        "pd_2_cat": categories.map_members(
            categories.code_part(code, 1, "_na"), fixed.SETTLEMENT_CODE2_TIERS, "others"
        ),
    }


def settlement_durations(df: DataFrame) -> DataFrame:
    """Required columns, blanks as NULL, types and durations; the scaler is fitted on this."""
    blank = {
        f.name: cleaning.blank_to_null(quoted(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name in SETTLEMENT.columns
    }
    col = quoted
    built = parsed(df.withColumns(blank), SETTLEMENT).withColumns(
        {
            "policy_tenure": tenure.policy_tenure(
                col("Policy Effective Date"), col("Policy Termination Date"),
                col("Received Date"), positive_only=False,
            ),
            "days_to_report": tenure.days_to_report(col("Loss Date"), col("Received Date"), "keep"),
            "emp_tenure": tenure.emp_tenure(
                col("Insured Hire Date"), col("Loss Date"), positive_only=False
            ),
            "prognosis_days": tenure.prognosis_days(
                col("Loss Date"), col("Duration Date"), col("Duration Months")
            ),
            "days_to_first_payment": tenure.days_to_first_payment(
                col("Loss Date"), col("First Payment From Date")
            ),
        }
    )
    return drop_dates(built)


def settlement_features(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Mapped categories, scaled numbers, and the keyword flags of the description.

    Completeness is judged before mapping, since mapping fills most gaps.
    """
    scaled = scaler.transform(settlement_durations(df)).drop("Duration Months")
    flagged = flag_incomplete(scaled, SETTLEMENT.required)
    description = text.lowered(quoted("Primary Diagnosis Desc"))
    mapped = flagged.withColumns({**settlement_groups(), "Primary Diagnosis Desc": description})
    phrases = mapped.withColumns(
        {
            **text.keyword_flags(quoted("Primary Diagnosis Desc"), fixed.SETTLEMENT_KEYWORDS),
        }
    )
    return phrases.drop(
        "DOT Exertion Level (Primary)", "Primary Diagnosis Code", "Insured Salary Ind",
        "days_to_first_payment", "emp_tenure", "SIC Code",
    )


def settlement_matrix(features: DataFrame, template: Sequence[str]) -> DataFrame:
    """Features in template order; only the phrase columns it names are made."""
    description = quoted("Primary Diagnosis Desc")
    flags = {
        **text.phrase_flags(description, fixed.SETTLEMENT_CONDITIONS, fixed.CONDITION_PREFIX, template),
        **text.phrase_flags(description, fixed.SETTLEMENT_ORGANS, fixed.ORGAN_PREFIX, template),
    }
    wide = features.withColumns(flags) if flags else features
    return align(wide, template, SETTLEMENT.categorical, carry=[ENTITY, "NA_row"])


def _result(df: DataFrame, probability: Column, threshold: float) -> DataFrame:
    """Entity, probability and label; both are NULL for an incomplete row."""
    kept = df.withColumn("probability", scoring.if_complete(probability))
    labelled = kept.withColumn("p_label", scoring.label(F.col("probability"), threshold))
    return payload(labelled, ENTITY, "probability", "p_label")


def complete_rows() -> Column:
    return F.col("NA_row") == "N"


def score_std(df: DataFrame, template: Sequence[str], model) -> DataFrame:
    matrix = align(std_features(df), template, STD.categorical, carry=[ENTITY, "NA_row"])
    scored = model.score(matrix, "p", complete_rows())
    corrected = scoring.prior_correct(F.col("p"), STD.prior_original, STD.prior_train)
    return _result(scored, corrected, STD.threshold)


def score_ltd(df: DataFrame, template: Sequence[str], model) -> DataFrame:
    """No prior correction; missing features count as 0."""
    matrix = align(ltd_features(df), template, LTD.categorical, carry=[ENTITY, "NA_row"])
    scored = model.score(nan_to_num(matrix, template), "p", complete_rows())
    return _result(scored, F.col("p"), LTD.threshold)


def score_settlement(df: DataFrame, template: Sequence[str], scaler: Scaler, network, booster) -> DataFrame:
    """Two models, each corrected, then blended."""
    matrix = settlement_matrix(settlement_features(df, scaler), template)
    scored = booster.score(network.score(matrix, "p1", complete_rows()), "p2", complete_rows())
    members = [
        scoring.prior_correct(F.col(p), SETTLEMENT.prior_original, SETTLEMENT.prior_train)
        for p in ("p1", "p2")
    ]
    return _result(scored, scoring.blend(members, fixed.SETTLEMENT_WEIGHTS), SETTLEMENT.threshold)
