"""Quality of predictions, as distributed counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.operators.projection import quoted
from claimflow.operators.skew import running_totals
from claimflow.session import materialise


def confusion(df: DataFrame, actual: str, predicted: str, weight: str | None = None) -> DataFrame:
    """One row ``tn, fp, fn, tp``."""
    w = quoted(weight) if weight else F.lit(1)

    def cell(a: int, p: int) -> Column:
        hit = (quoted(actual) == a) & (quoted(predicted) == p)
        return F.coalesce(F.sum(F.when(hit, w)), F.lit(0)).cast("long")

    return df.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def _f(precision: Column, recall: Column, beta: float) -> Column:
    b = beta * beta
    return F.try_divide((1 + b) * precision * recall, b * precision + recall)


def classification_report(counts: DataFrame) -> DataFrame:
    """Class, weighted and F-beta figures from the one row of ``confusion``."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    figures = counts.select(
        "tn", "fp", "fn", "tp",
        F.try_divide(tn, tn + fn).alias("class0_precision"),
        F.try_divide(tn, tn + fp).alias("class0_recall"),
        F.try_divide(tp, tp + fp).alias("class1_precision"),
        F.try_divide(tp, tp + fn).alias("class1_recall"),
        F.try_divide(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        F.try_divide(tn + fp, tn + fp + fn + tp).alias("_share0"),
    )
    p0, r0, p1, r1 = (F.col(f"class{k}_{m}") for k in (0, 1) for m in ("precision", "recall"))
    figures = figures.withColumns(
        {
            "class0_f1": _f(p0, r0, 1),
            "class1_f1": _f(p1, r1, 1),
            "f05": _f(p1, r1, 0.5),
            "f1": _f(p1, r1, 1),
            "f2": _f(p1, r1, 2),
        }
    )
    share = F.col("_share0")

    def weighted(metric: str) -> Column:
        return F.col(f"class0_{metric}") * share + F.col(f"class1_{metric}") * (1 - share)

    names = ("precision", "recall", "f1")
    return figures.withColumns({f"weighted_{m}": weighted(m) for m in names}).drop("_share0")


def score_counts(df: DataFrame, actual: str, score: str) -> DataFrame:
    """(score, pos, neg): rows of either class per distinct score."""
    y = quoted(actual)
    return (
        df.filter(quoted(score).isNotNull())
        .groupBy(quoted(score).cast("double").alias("score"))
        .agg(
            F.sum(F.when(y == 1, 1).otherwise(0)).alias("pos"),
            F.sum(F.when(y == 0, 1).otherwise(0)).alias("neg"),
        )
    )


def _ranked(df: DataFrame, actual: str, score: str, **bounds: int) -> tuple[DataFrame, float, float]:
    """Counts per score with totals below each score, and the class sizes.

    The counts are kept, so that the rows behind them are read once.
    """
    counts = materialise(score_counts(df, actual, score))
    sizes = counts.agg(F.sum("pos"), F.sum("neg")).first()
    p, n = (float(x or 0) for x in sizes)
    return running_totals(counts, "score", ["pos", "neg"], **bounds), p, n


def auc(df: DataFrame, actual: str, score: str, **bounds: int) -> DataFrame:
    """One row ``auc``: chance that a positive outranks a negative, ties half."""
    ranked, p, n = _ranked(df, actual, score, **bounds)
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    return ranked.agg(F.try_divide(won, F.lit(p * n)).alias("auc"))


def auc_pr(df: DataFrame, actual: str, score: str, **bounds: int) -> DataFrame:
    """One row ``auc_pr``: average precision over the distinct scores."""
    ranked, p, n = _ranked(df, actual, score, **bounds)
    tp = F.lit(p) - F.col("pos_before")
    fp = F.lit(n) - F.col("neg_before")
    gained = F.col("pos") * F.try_divide(tp, tp + fp)
    return ranked.agg(F.try_divide(F.sum(gained), F.lit(p)).alias("auc_pr"))


def threshold_curve(df: DataFrame, actual: str, score: str, **bounds: int) -> DataFrame:
    """(threshold, fpr, fnr) when rows at or above the threshold count as positive."""
    ranked, p, n = _ranked(df, actual, score, **bounds)
    return ranked.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.lit(n) - F.col("neg_before"), F.lit(n)).alias("fpr"),
        F.try_divide(F.col("pos_before"), F.lit(p)).alias("fnr"),
    )


def exact_match_ratio(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """One row ``emr``: share of rows on which all label pairs agree."""
    agree = reduce(lambda a, b: a & b, [quoted(a).eqNullSafe(quoted(b)) for a, b in pairs.items()])
    return df.agg(F.avg(F.when(agree, 1.0).otherwise(0.0)).alias("emr"))


def compare_labels(
    left: DataFrame, right: DataFrame, on: Sequence[str], labels: Sequence[str]
) -> DataFrame:
    """Rows of which a label differs, or that only one side has."""
    ours = left.select(*[quoted(c) for c in on], *[quoted(c).alias(f"{c}_left") for c in labels], F.lit(1).alias("_l"))
    theirs = right.select(*[quoted(c) for c in on], *[quoted(c).alias(f"{c}_right") for c in labels], F.lit(1).alias("_r"))
    same = [F.col(f"{c}_left").eqNullSafe(F.col(f"{c}_right")) for c in labels]
    present = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    agree = reduce(lambda a, b: a & b, same, present)
    return ours.join(theirs, list(on), "full").filter(~agree).drop("_l", "_r")


def hash_share(key: Column, salt: str = "") -> Column:
    """A number in [0, 1) that depends on the key alone."""
    digits = F.substring(F.md5(F.concat(key.cast("string"), F.lit(salt))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(4294967296.0)


def split(df: DataFrame, key: str, ratios: Mapping[str, float], name: str = "part") -> DataFrame:
    """Name a part for every row by the hash of its key: stable and shuffle-free."""
    share = hash_share(quoted(key))
    total = sum(ratios.values())
    chain, edge = None, 0.0
    names = list(ratios)
    for part in names[:-1]:
        edge += ratios[part] / total
        start = F if chain is None else chain
        chain = start.when(share < edge, F.lit(part))
    last = F.lit(names[-1])
    return df.withColumn(name, last if chain is None else chain.otherwise(last))


def folds(df: DataFrame, key: str, k: int, name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 by an independent hash of the key."""
    return df.withColumn(name, F.floor(hash_share(quoted(key), "fold") * k).cast("int"))
