"""Scalers and the quantile transform: fit once, then plain column arithmetic."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.operators.projection import quoted
from claimflow.operators.skew import running_totals
from claimflow.session import materialise


def grid_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    points: int,
    **bounds: int,
) -> dict[str, list[float]]:
    """Exact quantiles at 0, 1/(points-1), ..., 1 with linear interpolation.

    Each distinct value is counted, totals run over the counts, and the values at the
    wanted ranks are read off. A column without values has no quantiles.
    """
    columns = list(columns)
    step = points - 1
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("feature"), quoted(c).cast("double").alias("x"))
            for i, c in enumerate(columns)
        ]
    )
    # counted once, read by each of the steps below
    counts = materialise(
        df.select(F.inline(pairs))
        .filter(F.col("x").isNotNull())
        .groupBy("feature", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sizes = {r["feature"]: r["size"] for r in counts.groupBy("feature").agg(F.sum("n").alias("size")).collect()}
    if not sizes:
        return {c: [] for c in columns}
    # ranks around each grid point: position p of the grid needs floor(p) and floor(p)+1
    last = F.element_at(F.create_map(*[F.lit(v) for f, s in sizes.items() for v in (f, s - 1)]), F.col("feature"))
    ranked = running_totals(counts, "x", ["n"], ["feature"], **bounds).withColumn("last", last)
    low = F.greatest(F.lit(0), F.floor((F.col("n_before") - 1) * step / F.greatest(F.col("last"), F.lit(1))))
    high = F.least(F.lit(step), F.ceil((F.col("n_before") + F.col("n")) * step / F.greatest(F.col("last"), F.lit(1))))
    near = ranked.filter(low <= high).select(
        "feature", "x", "n_before", "n", "last", F.explode(F.sequence(low, high)).alias("i")
    )
    floor_rank = F.floor(F.col("i") * F.col("last") / F.lit(step))

    def covers(rank):
        return (rank >= F.col("n_before")) & (rank < F.col("n_before") + F.col("n"))

    ends = (
        near.filter(covers(floor_rank) | covers(F.least(floor_rank + 1, F.col("last"))))
        .groupBy("feature", "i")
        .agg(F.min("x").alias("a"), F.max("x").alias("b"))
        .collect()
    )
    knots: dict[str, list[float]] = {c: [0.0] * points if f in sizes else [] for f, c in enumerate(columns)}
    for r in ends:
        position = r["i"] * (sizes[r["feature"]] - 1) / step
        share = position - int(position)
        knots[columns[r["feature"]]][r["i"]] = r["a"] if share == 0 else r["a"] + (r["b"] - r["a"]) * share
    return knots


@dataclass
class Scaler:
    """(x - center) / scale per feature; NULL passes through.

    ``standard`` uses mean and population deviation, ``minmax`` minimum and
    range, ``robust`` median and interquartile range. A scale of 0 counts as 1.
    """

    kind: str = "standard"
    params: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame, columns: Sequence[str]) -> "Scaler":
        columns = list(columns)
        if self.kind == "robust":
            quartiles = grid_quantiles(df, columns, 5)
            found = {c: (q[2], q[3] - q[1]) if q else (0.0, 1.0) for c, q in quartiles.items()}
        else:
            first, second = {
                "standard": (F.avg, F.stddev_pop),
                "minmax": (F.min, lambda x: F.max(x) - F.min(x)),
            }[self.kind]
            aggregates = []
            for i, c in enumerate(columns):
                x = quoted(c).cast("double")
                aggregates += [first(x).alias(f"c{i}"), second(x).alias(f"s{i}")]
            row = df.agg(*aggregates).first()
            found = {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}
        self.params = {c: (m or 0.0, s or 1.0) for c, (m, s) in found.items()}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (quoted(c).cast("double") - F.lit(float(center))) / F.lit(float(scale))
                for c, (center, scale) in self.params.items()
            }
        )


@dataclass
class QuantileTransform:
    """Empirical distribution function with interpolation, clipped to [0, 1].

    Between two knots the share is interpolated; on a knot that repeats, it is
    the middle of the first and the last share of the run.
    """

    points: int = 1000
    knots: dict[str, list[float]] = field(default_factory=dict)

    def fit(self, df: DataFrame, columns: Sequence[str], **bounds: int) -> "QuantileTransform":
        self.knots = grid_quantiles(df, columns, self.points, **bounds)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        fitted = {c: k for c, k in self.knots.items() if k}
        names = {c: f"_cell{i}" for i, c in enumerate(fitted)}
        runs = {}
        for c, knots in fitted.items():
            step = len(knots) - 1
            values = sorted(set(knots))
            first = {v: i / step for i, v in reversed(list(enumerate(knots)))}
            last = {v: i / step for i, v in enumerate(knots)}
            runs[c] = (values, [first[v] for v in values], [last[v] for v in values])
        inputs = {c: f"_in{i}" for i, c in enumerate(fitted)}
        wide = df.withColumns({inputs[c]: quoted(c).cast("double") for c in fitted})
        wide = Bucketizer(
            splitsArray=[[float("-inf"), *runs[c][0], float("inf")] for c in fitted],
            inputCols=[inputs[c] for c in fitted],
            outputCols=[names[c] for c in fitted],
            handleInvalid="keep",
        ).transform(wide)

        def share(c: str) -> Column:
            values, first, last = (f"from_json('{json.dumps(v)}', 'array<double>')" for v in runs[c])
            x, cell = f"`{inputs[c]}`", f"CAST(`{names[c]}` AS INT)"
            left, right = f"get({last}, {cell} - 1)", f"get({first}, {cell})"
            left_x, right_x = f"get({values}, {cell} - 1)", f"get({values}, {cell})"
            return F.expr(
                f"""CASE WHEN {x} IS NULL THEN CAST(NULL AS DOUBLE)
                  WHEN {x} <= {runs[c][0][0]!r}D THEN 0D WHEN {x} >= {runs[c][0][-1]!r}D THEN 1D
                  WHEN {x} = {left_x} THEN (get({first}, {cell} - 1) + {left}) / 2
                  ELSE {left} + ({right} - {left}) * (({x} - {left_x}) / ({right_x} - {left_x})) END"""
            )

        return wide.select(*[share(c).alias(c) if c in fitted else quoted(c) for c in df.columns])
