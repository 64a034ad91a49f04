"""Will a short-term claim turn into a long-term one: several snapshots per claim."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.functions import categories, cleaning, scoring, tenure, text
from claimflow.operators.encode import RareGrouper, align
from claimflow.operators.projection import date_named, eligible, quoted, require
from claimflow.operators.skew import lookup_join
from claimflow.operators.snapshots import attach_snapshot, first_snapshot
from claimflow.operators.vocabulary import TfIdf, stem_table, term_counts
from claimflow.session import materialise

KEY = "ClaimNumber"
DESCRIPTION = "PrimaryDiagnosisDecription"
SNAPSHOT = ["BenefitCaseType", "DurationDate"]


def eligible_rows(df: DataFrame) -> DataFrame:
    """Snapshots under review that are not closed, with their dates parsed."""
    dated = df.withColumns({c: cleaning.parse_timestamp(quoted(c)) for c in date_named(df)})
    return eligible(
        dated, "ClaimStatusDescription", "ClaimStatusCode", fixed.BRIDGING_ELIGIBLE,
        fixed.BRIDGING_REVIEW_STATUS, fixed.BRIDGING_CLOSED_CODE,
    )


def claim_features(rows: DataFrame) -> DataFrame:
    """The features made of the columns of each row."""
    code = F.col("PrimaryDiagnosisCode")
    return rows.withColumns(
        {
            "SIC_category": categories.sic_division(F.col("SICCode")),
            "pd_code_1": categories.code_part(code, 0, "na.na"),
            "pd_code_2": categories.code_part(code, 1, "na.na"),
            "emp_tenure": tenure.emp_tenure(
                F.col("InsuredHireDate"), F.col("LossDate"), positive_only=False
            ),
            "InsuredAnnualizedSalary": cleaning.range_midpoint(F.col("InsuredAnnualizedSalary")),
        }
    ).drop("PrimaryDiagnosisCode", "InsuredHireDate")


def short_term_snapshots(rows: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    """Earliest snapshot of each claim, kept if that one is short-term.

    The benefit type is tested on the chosen snapshot, never before choosing.
    """
    return _short_term(first_snapshot(rows, KEY, "ApprovalDate", SNAPSHOT, tiebreak))


def _short_term(first: DataFrame) -> DataFrame:
    return first.filter(F.col("BenefitCaseType") == fixed.BRIDGING_BENEFIT_TYPE).select(
        KEY, F.col("DurationDate").alias("first_duration_date")
    )


def bridging_features(df: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    """Distinct feature rows of the claims beside their claim's earliest snapshot.

    The input is read and its dates are parsed once: rows are reduced to distinct
    feature rows, each with the earliest of the snapshots it stands for. That table
    is written; the busy claims, the earliest snapshot of a claim and the join all
    come from it.
    """
    rows = require(eligible_rows(df), list(dict.fromkeys([*fixed.BRIDGING_COLUMNS, "ApprovalDate", *tiebreak, *SNAPSHOT])))
    order = F.struct(*[quoted(c).alias(f"_by{i}") for i, c in enumerate(["ApprovalDate", *tiebreak])], *map(quoted, SNAPSHOT))
    distinct = materialise(rows.groupBy(*map(quoted, fixed.BRIDGING_COLUMNS)).agg(F.min(order).alias("_earliest")))
    first = distinct.filter(quoted(KEY).isNotNull()).groupBy(KEY).agg(F.min("_earliest").alias("_first"))
    joined = attach_snapshot(claim_features(distinct.drop("_earliest")), _short_term(first.select(KEY, "_first.*")), KEY)
    prognosis = tenure.initial_prognosis_days(F.col("LossDate"), F.col("first_duration_date"))
    return joined.withColumn("initial_prognosis_days", prognosis)


def clean_description(c: Column, stopwords: Sequence[str]) -> Column:
    """Stop words go before punctuation, so "word," is never one."""
    return text.strip_punctuation(text.remove_stopwords(c, stopwords))


def _given() -> Column:
    """A description as it was given; one that is missing reads like the text that stands for it."""
    return F.coalesce(F.col(DESCRIPTION), F.lit("_na_")).alias("_given")


def described(features: DataFrame, stopwords: Sequence[str]) -> DataFrame:
    """(_given, text_key, cleaned): every different description, cleaned once, as a written table."""
    cleaned = clean_description(F.col("_given"), stopwords).alias("cleaned")
    texts = features.select(_given()).distinct().select("_given", cleaned)
    return materialise(texts.select("_given", F.md5("cleaned").alias("text_key"), "cleaned"))


def description_stems(features: DataFrame, stopwords: Sequence[str], given: DataFrame | None = None) -> DataFrame:
    """(text_key, term, n): how often each stem occurs in each distinct description.

    Descriptions repeat, so text work is done once per description, not per
    claim; the table is kept, as fitting and scoring both need it. ``given`` is the
    table of descriptions, if the caller has it already.
    """
    given = described(features, stopwords) if given is None else given
    texts = materialise(given.select("text_key", "cleaned").distinct())
    counts = term_counts(texts, "text_key", text.words(F.col("cleaned"))).withColumnRenamed("term", "token")
    stems = lookup_join(counts, stem_table(texts, "cleaned"), ["token"])
    return materialise(stems.groupBy("text_key", F.col("stem").alias("term")).agg(F.sum("n").alias("n")))


def add_terms(
    features: DataFrame, stems: DataFrame, tfidf: TfIdf, terms: Sequence[str], stopwords: Sequence[str],
    given: DataFrame | None = None,
) -> DataFrame:
    """Append one weight column per listed term."""
    given = described(features, stopwords) if given is None else given
    wide = tfidf.wide(tfidf.weigh(stems, "text_key"), "text_key", terms)
    weights = materialise(given.select("_given", "text_key").join(wide, "text_key").drop("text_key"))
    joined = lookup_join(features.withColumn("_given", _given()), weights, ["_given"])
    return joined.fillna(0.0, subset=list(terms)).drop("_given")


def score_bridging(
    features: DataFrame, template: Sequence[str], grouper: RareGrouper, model,
    threshold: float = 0.5,
) -> DataFrame:
    """(claimNumber, predictedProbability, predicted_bridged_ind) per feature row."""
    grouped = grouper.transform(features, fixed.BRIDGING_CATEGORICAL)
    matrix = align(grouped, template, fixed.BRIDGING_CATEGORICAL, carry=[KEY])
    scored = model.score(matrix, "p")
    return scored.select(
        F.col(KEY).alias("claimNumber"),
        F.col("p").alias("predictedProbability"),
        scoring.label(F.col("p"), threshold).alias("predicted_bridged_ind"),
    )
