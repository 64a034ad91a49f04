"""Probabilities, corrections and labels as column arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimflow.functions.text import constant_list


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear(coefficients: Mapping[str, float], intercept: float) -> Column:
    """Weighted sum of the named features plus the intercept."""
    terms = [f"CAST(`{name}` AS DOUBLE) * {float(weight)!r}D" for name, weight in coefficients.items()]
    return F.expr(" + ".join([f"{float(intercept)!r}D", *terms]))


def tree_sum(nodes: Sequence[Mapping]) -> Column:
    """Sum of the leaf values of an ensemble given as rows of a node table.

    A row has ``tree, node, feature, threshold, left, right, value``; a leaf has
    no feature. Values below the threshold, and NULL, go left.
    """
    by_tree: dict[int, dict[int, Mapping]] = {}
    for row in nodes:
        by_tree.setdefault(row["tree"], {})[row["node"]] = row

    def branch(tree: dict[int, Mapping], node: int) -> Column:
        row = tree[node]
        if row["feature"] is None:
            return F.lit(float(row["value"]))
        x = F.col(f"`{row['feature']}`")
        right = x >= F.lit(float(row["threshold"]))
        return F.when(right, branch(tree, row["right"])).otherwise(branch(tree, row["left"]))

    total = F.lit(0.0)
    for _, tree in sorted(by_tree.items()):
        total = total + branch(tree, 0)
    return total


def prior_correct(p: Column, original: float, trained: float) -> Column:
    """Probability under the original class share of a model trained on another."""
    up = F.lit(original / trained)
    down = F.lit((1 - original) / (1 - trained))
    return (p * up) / (p * up + (F.lit(1.0) - p) * down)


def calibrate(p: Column, trained: float, original: float) -> Column:
    """The same correction written as a ratio of two weighted parts."""
    one = p / F.lit(trained / original)
    zero = (F.lit(1.0) - p) / F.lit((1 - trained) / (1 - original))
    return one / (one + zero)


def blend(members: Sequence[Column], weights: Sequence[float]) -> Column:
    total = members[0] * F.lit(weights[0])
    for p, w in zip(members[1:], weights[1:]):
        total = total + p * F.lit(w)
    return total


def label(p: Column, threshold: float) -> Column:
    """1 at or above the threshold; NULL stays NULL."""
    return (p >= F.lit(threshold)).cast("int")


def if_complete(x: Column, incomplete: str = "NA_row") -> Column:
    """The value of complete rows only."""
    return F.when(F.col(incomplete) == "N", x)


def argmax(scores: Column) -> Column:
    """Index of the largest entry; the first one of equals."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def softmax_top(scores: Column, digits: int = 4) -> Column:
    """Softmax share of the largest entry, rounded."""
    top = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return F.round(F.lit(1.0) / total, digits)


def decode(index: Column, labels: Sequence[str]) -> Column:
    """Label of a class index."""
    return F.get(constant_list(labels), index)
