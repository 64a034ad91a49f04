"""Models that turn feature columns into the probability of class 1.

Parameters are plain tables (coefficients, tree nodes) that become column
expressions, or a model fitted by Spark ML, or any external predictor that is
loaded once per task and fed Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.functions.scoring import linear, sigmoid, tree_sum
from claimflow.operators.projection import quoted


def only(x: Column, complete: Column | None) -> Column:
    return x if complete is None else F.when(complete, x)


@dataclass(frozen=True)
class LinearModel:
    """Logistic model from a coefficient table."""

    coefficients: Mapping[str, float]
    intercept: float = 0.0

    @classmethod
    def from_table(cls, table: DataFrame, intercept: str = "(intercept)") -> "LinearModel":
        """From rows (feature, coefficient), one of which is the intercept."""
        rows = {r["feature"]: r["coefficient"] for r in table.collect()}
        return cls({k: v for k, v in rows.items() if k != intercept}, rows.get(intercept, 0.0))

    def score(self, df: DataFrame, name: str, complete: Column | None = None) -> DataFrame:
        return df.withColumn(name, only(sigmoid(linear(self.coefficients, self.intercept)), complete))


@dataclass(frozen=True)
class TreeModel:
    """Sum of tree leaves, as log-odds, from a node table."""

    nodes: Sequence[Mapping]
    bias: float = 0.0

    def score(self, df: DataFrame, name: str, complete: Column | None = None) -> DataFrame:
        return df.withColumn(name, only(sigmoid(tree_sum(self.nodes) + F.lit(self.bias)), complete))


@dataclass(frozen=True)
class LeafMasks:
    """A block of trees as masks of the leaves that a failed test leaves reachable.

    For every feature, its thresholds in order; and for every number of thresholds that
    a value reaches, the leaves of each tree that remain, one bit each, the leftmost leaf
    lowest. The masks of the thresholds passed are already ANDed with each other.
    """

    features: list[str]
    thresholds: list[np.ndarray]
    remaining: list[np.ndarray]
    values: np.ndarray

    @classmethod
    def of(cls, trees: Sequence[Mapping[int, Mapping]]) -> "LeafMasks":
        tests: dict[str, list[tuple[float, int, int]]] = {}
        values = np.zeros((len(trees), 64))

        def leaves(t: int, number: int, first: int) -> int:
            """Number the leaves below a node from ``first`` on; returns the next free number."""
            row = trees[t][number]
            if row["feature"] is None:
                values[t, first] = float(row["value"])
                return first + 1
            middle = leaves(t, row["left"], first)
            # a value that reaches the threshold goes right: the leaves on the left are out
            out = ((1 << middle) - 1) ^ ((1 << first) - 1)
            tests.setdefault(row["feature"], []).append((float(row["threshold"]), t, ~out & (2**64 - 1)))
            return leaves(t, row["right"], middle)

        for t in range(len(trees)):
            leaves(t, 0, 0)
        features, thresholds, remaining = sorted(tests), [], []
        for f in features:
            at = np.unique([x for x, _, _ in tests[f]])
            masks = np.full((len(at) + 1, len(trees)), 2**64 - 1, "u8")
            for x, t, mask in tests[f]:
                masks[np.searchsorted(at, x) + 1, t] &= np.uint64(mask)
            thresholds.append(at)
            remaining.append(np.bitwise_and.accumulate(masks, axis=0))
        return cls(features, thresholds, remaining, values)

    def total(self, columns: Mapping[str, np.ndarray], n: int) -> np.ndarray:
        """The sum over the trees of the leaf that each row reaches."""
        left = np.full((n, len(self.values)), 2**64 - 1, "u8")
        for f, at, masks in zip(self.features, self.thresholds, self.remaining, strict=True):
            x = columns[f]
            # missing values reach no threshold
            reached = np.where(np.isnan(x), 0, np.searchsorted(at, x, side="right"))
            left &= masks[reached]
        lowest = left & (~left + np.uint64(1))
        # a power of two is exact as a double, so is its logarithm
        leaf = np.log2(lowest.astype("f8")).astype("i8")
        return self.values[np.arange(len(self.values)), leaf].sum(axis=1)


def split_deep(trees: Sequence[Mapping[int, Mapping]], most: int = 64) -> list[dict[int, Mapping]]:
    """Trees of at most ``most`` leaves with the same sum.

    A larger tree becomes several: a subtree of at most that many leaves is cut off and
    stands alone behind the tests that lead to it, with zeros everywhere else, and a zero
    takes its place.
    """
    out: list[dict[int, Mapping]] = []

    def leaf(value: float) -> Mapping:
        return {"feature": None, "value": value}

    for tree in trees:
        tree = dict(tree)

        def count(number: int, tree: dict = tree) -> int:
            row = tree[number]
            return 1 if row["feature"] is None else count(row["left"]) + count(row["right"])

        while count(0) > most:
            # down the larger side, until what is left fits behind the path to it
            number, path = 0, []
            while count(number) + len(path) > most:
                row = tree[number]
                side = "left" if count(row["left"]) >= count(row["right"]) else "right"
                path.append((number, side))
                number = row[side]
                if len(path) >= most:
                    raise ValueError("a tree is deeper than a mask has bits")
            cut = dict(tree)
            for at, side in path:
                other = "right" if side == "left" else "left"
                cut[tree[at][other]] = leaf(0.0)
            out.append(cut)
            tree[number] = leaf(0.0)
        out.append(tree)
    return out


@dataclass(frozen=True)
class ForestModel:
    """``TreeModel`` for ensembles too large to be compiled as expressions.

    Values below the threshold, and NULL, go left. Trees are taken in blocks; a batch of
    rows finds the interval of each value among a feature's sorted thresholds, ANDs the
    masks of all features, and the lowest bit left is the leaf. Planning does not depend
    on the number of trees; the masks of a block hold (thresholds + features) x trees
    numbers and reach each executor once.
    """

    nodes: Sequence[Mapping]
    bias: float = 0.0
    trees_at_once: int = 64
    rows_at_once: int = 8192

    def blocks(self) -> list[LeafMasks]:
        by_tree: dict[int, dict[int, Mapping]] = {}
        for row in self.nodes:
            by_tree.setdefault(row["tree"], {})[row["node"]] = row
        trees = split_deep([t for _, t in sorted(by_tree.items())])
        return [LeafMasks.of(trees[i : i + self.trees_at_once]) for i in range(0, len(trees), self.trees_at_once)]

    def score(self, df: DataFrame, name: str, complete: Column | None = None) -> DataFrame:
        built = self.blocks()
        features = sorted({f for b in built for f in b.features})
        shared = df.sparkSession.sparkContext.broadcast(built)
        most = self.rows_at_once

        @F.pandas_udf(T.DoubleType())
        def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                parts = [np.zeros(0)]
                for at in range(0, len(batch), most):
                    rows = batch.iloc[at : at + most]
                    columns = {f: rows[f"f{i}"].to_numpy("f8", na_value=np.nan) for i, f in enumerate(features)}
                    parts.append(sum((b.total(columns, len(rows)) for b in shared.value), np.zeros(len(rows))))
                yield pd.Series(np.concatenate(parts))

        if not features:
            constant = sum(float(b.values[:, 0].sum()) for b in built) + self.bias
            return df.withColumn(name, only(sigmoid(F.lit(constant)), complete))
        inputs = F.struct(*[quoted(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
        return df.withColumn(name, only(sigmoid(total(inputs) + F.lit(self.bias)), complete))


@dataclass(frozen=True)
class BatchModel:
    """An external predictor over batches.

    ``load`` runs once per task and returns a function from a float matrix, in
    feature order, to one probability per row. Incomplete rows never reach it.
    """

    load: Callable[[], Callable[[np.ndarray], np.ndarray]]
    features: Sequence[str] = field(default_factory=tuple)
    dtype: str = "float32"

    def score(self, df: DataFrame, name: str, complete: Column | None = None) -> DataFrame:
        load, dtype = self.load, self.dtype

        @F.pandas_udf(T.DoubleType())
        def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                wanted = batch.pop("_complete").to_numpy(dtype=bool)
                result = np.full(len(batch), np.nan)
                if wanted.any():
                    result[wanted] = np.ravel(model(batch[wanted].to_numpy(dtype=dtype)))
                yield pd.Series(result).astype(object).where(wanted, None)

        flag = F.lit(True) if complete is None else complete
        inputs = F.struct(
            flag.alias("_complete"),
            *[quoted(c).cast("double").alias(f"f{i}") for i, c in enumerate(self.features)],
        )
        return df.withColumn(name, predict(inputs))


def onnx_model(graph: bytes, features: Sequence[str], output: int = 0) -> BatchModel:
    """A network in ONNX form; the last column of its output is the probability."""

    def load() -> Callable[[np.ndarray], np.ndarray]:
        import onnxruntime

        session = onnxruntime.InferenceSession(graph, providers=["CPUExecutionProvider"])
        source = session.get_inputs()[0].name
        target = session.get_outputs()[output].name

        def run(matrix: np.ndarray) -> np.ndarray:
            result = session.run([target], {source: matrix})[0]
            return result.reshape(len(matrix), -1)[:, -1]

        return run

    return BatchModel(load, tuple(features))


@dataclass(frozen=True)
class MlModel:
    """A classifier fitted by Spark ML."""

    fitted: PipelineModel

    def score(self, df: DataFrame, name: str, complete: Column | None = None) -> DataFrame:
        stages = self.fitted.transform(df)
        p = vector_to_array("_probability")[1]
        return stages.select(*[quoted(c) for c in df.columns], only(p, complete).alias(name))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")


def fit_linear(df: DataFrame, features: Sequence[str], label: str, ridge: float = 0.0) -> LinearModel:
    """Logistic regression fitted on the cluster, returned as its coefficient table."""
    vectors = _assembler(features).transform(df)
    found = LogisticRegression(featuresCol="_features", labelCol=label, regParam=ridge).fit(vectors)
    weights = [float(w) for w in found.coefficients]
    return LinearModel(dict(zip(features, weights)), float(found.intercept))


def fit_trees(df: DataFrame, features: Sequence[str], label: str, trees: int = 20, seed: int = 7) -> MlModel:
    """Gradient-boosted trees fitted on the cluster."""
    assembler = _assembler(features)
    booster = GBTClassifier(
        featuresCol="_features", labelCol=label, predictionCol="_predicted", maxIter=trees, seed=seed
    )
    booster.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    fitted = booster.fit(assembler.transform(df))
    return MlModel(PipelineModel([assembler, fitted]))
