"""Turning categories into numbers, with the layout given by a template."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.operators.projection import quoted
from claimflow.operators.skew import lookup_join, running_totals
from claimflow.session import materialise

DOUBLE_MAX = 1.7976931348623157e308
LITERAL_LIMIT = 200


def template_levels(template: Sequence[str], categorical: Sequence[str]) -> dict[str, tuple[str, str]]:
    """Template name -> (column, level) for the names that are one-hot columns.

    Where one categorical name is the beginning of another, the longer wins.
    """
    by_length = sorted(categorical, key=len, reverse=True)
    levels = {}
    for name in template:
        for column in by_length:
            if name.startswith(column + "_"):
                levels[name] = (column, name[len(column) + 1 :])
                break
    return levels


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by one 0/1 column per level; NULL is 0 in all of them."""
    kept = [quoted(c) for c in df.columns if c not in levels]
    hot = [
        quoted(c).cast("string").eqNullSafe(F.lit(v)).cast("int").alias(f"{c}_{v}")
        for c, values in levels.items()
        for v in values
    ]
    return df.select(*kept, *hot)


def align(
    df: DataFrame,
    template: Sequence[str],
    categorical: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """The template's features in its order: absent ones 0, others dropped.

    One-hot features of ``categorical`` columns are made on the way, so that
    encoding and alignment are one projection. ``carry`` columns stay in front.
    """
    levels = template_levels([t for t in template if t not in df.columns], categorical)

    def feature(name: str) -> Column:
        if name in levels:
            column, level = levels[name]
            if column in df.columns:
                return quoted(column).cast("string").eqNullSafe(F.lit(level)).cast("int")
        if name in df.columns and name not in categorical:
            return quoted(name)
        return F.lit(0)

    return df.select(*[quoted(c) for c in carry], *[feature(t).alias(t) for t in template])


def finite(x: Column) -> Column:
    """NULL and NaN to 0, infinities to the largest double of their sign."""
    value = F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.least(F.greatest(value, F.lit(-DOUBLE_MAX)), F.lit(DOUBLE_MAX))


def nan_to_num(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: finite(quoted(c)) for c in columns})


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, category) pairs of several columns from one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), quoted(c).cast("string").alias("category"))
            for c in columns
        ]
    )
    return df.select(F.inline(pairs))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per category of every column; NULL is not counted."""
    long = _long(df, columns).filter(F.col("category").isNotNull())
    return long.groupBy("column_name", "category").agg(F.count(F.lit(1)).alias("counts"))


def _by_length(table: DataFrame, columns: Sequence[str]) -> tuple[list, list[str]]:
    """Rows of the columns with few categories, and the names of the other columns.

    Short lists become constants: no lookup, and it works on streams. Columns whose own
    list is long are looked up together.
    """
    mine = table.filter(F.col("column_name").isin(list(columns)))
    sizes = mine.groupBy("column_name").count().filter(F.col("count") > LITERAL_LIMIT)
    long = {r["column_name"] for r in sizes.collect()}
    return mine.filter(~F.col("column_name").isin(long)).collect(), [c for c in columns if c in long]


#: Entries of a table of categories that each task may hold, and the bytes of their texts.
HELD_ENTRIES, HELD_BYTES = 2_000_000, 64 << 20


def _looked_up(df: DataFrame, columns: Sequence[str], table: DataFrame, otherwise: Column) -> DataFrame:
    """Replace wide columns by the values of ``table`` (column_name, category, value), all in one pass.

    A table measured to be small is held by each task: one sorted array of hashes of
    (column, category) for all columns, searched for a whole batch at a time. Beyond
    that, the distinct values of all columns are brought into long form and meet the
    table in one join; a row then gets its values back by one more, on its number.
    """
    if not columns:
        return df
    mine = materialise(table.filter(F.col("column_name").isin(list(columns))))
    size = F.octet_length("column_name") + F.octet_length("category") + 8
    n, total = mine.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    kind = mine.schema["value"].dataType
    name = _unused("_found", df)
    if n <= HELD_ENTRIES and total <= HELD_BYTES:
        found = _held_values(df, columns, mine, name)
    else:
        found = _joined_values(df, columns, mine, name)
    values = {c: F.coalesce(F.col(name)[c], otherwise.cast(kind)) for c in columns}
    return found.select(*[values[c].alias(c) if c in values else quoted(c) for c in df.columns])


def _unused(name: str, df: DataFrame) -> str:
    """The name, or one like it that no column has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _held_values(df: DataFrame, columns: Sequence[str], table: DataFrame, name: str) -> DataFrame:
    kind = table.schema["value"].dataType.simpleString()
    # sorted by hash; the texts themselves tell categories with equal hashes apart
    rows = table.select(F.xxhash64("column_name", "category").alias("hash"), "column_name", "category", "value").orderBy("hash").toArrow()
    shared = df.sparkSession.sparkContext.broadcast(rows.combine_chunks())
    names = list(columns)

    @F.pandas_udf("struct<" + ",".join(f"`{c}`:{kind}" for c in names) + ">")
    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = shared.value
        hashes = rows.column("hash").to_numpy()
        column, category = rows.column("column_name"), rows.column("category")
        values = rows.column("value").to_pandas().astype(object)
        for batch in batches:
            out = {}
            for i, c in enumerate(names):
                asked, wanted = batch[f"h{i}"].to_numpy("i8", na_value=0), pa.array(batch[f"t{i}"], pa.string())
                at = np.searchsorted(hashes, asked)
                hit = np.zeros(len(asked), bool)
                if len(hashes):
                    while True:
                        inside = at < len(hashes)
                        near = np.minimum(at, len(hashes) - 1)
                        open_ = inside & (hashes[near] == asked) & ~hit
                        if not open_.any():
                            break
                        same = pc.and_(pc.equal(category.take(pa.array(near)), wanted), pc.equal(column.take(pa.array(near)), c))
                        hit |= open_ & pc.fill_null(same, False).to_numpy(zero_copy_only=False)
                        at = np.where(open_ & ~hit, at + 1, at)
                found = np.full(len(asked), None, object)
                found[hit] = values.to_numpy()[at[hit]]
                out[c] = found
            yield pd.DataFrame(out, columns=names)

    texts = [quoted(c).cast("string") for c in names]
    given = [x for i, (c, t) in enumerate(zip(names, texts, strict=True)) for x in (F.xxhash64(F.lit(c), t).alias(f"h{i}"), t.alias(f"t{i}"))]
    return df.withColumn(name, look_up(F.struct(*given)))


def _joined_values(df: DataFrame, columns: Sequence[str], table: DataFrame, name: str) -> DataFrame:
    # written, so that a row keeps its number
    number = _unused("_number", df)
    rows = materialise(df.withColumn(number, F.monotonically_increasing_id()))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(c).cast("string").alias("category")) for c in columns])
    long = rows.select(number, F.inline(pairs)).filter(F.col("category").isNotNull())
    key = F.concat_ws("\0", "column_name", "category")
    met = lookup_join(long.select(number, "column_name", key.alias("_key")), table.select(key.alias("_key"), "value"), ["_key"], "inner")
    by_row = met.groupBy(number).agg(*[F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(c) for c in columns])
    found = by_row.select(number, F.struct(*[quoted(c) for c in columns]).alias(name))
    return rows.join(found, number, "left").drop(number)


@dataclass
class RareGrouper:
    """Pushes categories seen fewer than ``min_freq`` times into one bucket."""

    min_freq: int
    frequent: DataFrame | None = None

    def fit(self, df: DataFrame, columns: Sequence[str]) -> "RareGrouper":
        self.columns = list(columns)
        counts = category_counts(df, columns).filter(F.col("counts") >= self.min_freq)
        self.frequent = materialise(counts.select("column_name", "category"))
        return self

    def transform(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        if self.frequent is None:
            raise ValueError("fit the grouper before transforming")
        columns = list(columns or self.columns)
        other = F.lit(fixed.OUT_OF_VOCABULARY)
        short, long = _by_length(self.frequent, columns)

        def grouped(c: str) -> Column:
            keep = [r["category"] for r in short if r["column_name"] == c]
            text = quoted(c).cast("string")
            return F.when(text.isin(keep), text).otherwise(other) if keep else other

        df = df.withColumns({c: grouped(c) for c in columns if c not in long})
        return _looked_up(df, long, self.frequent.select("column_name", "category", F.col("category").alias("value")), other)


@dataclass
class TargetEncoder:
    """Category -> smoothed share of the label, (sum + a*prior) / (count + a)."""

    a: float = 1.0
    prior: float | None = None
    stats: DataFrame | None = None

    def fit(self, df: DataFrame, columns: Sequence[str], label: str) -> "TargetEncoder":
        self.columns = list(columns)
        self.prior = df.agg(F.avg(quoted(label).cast("double"))).first()[0]
        pairs = F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), quoted(c).cast("string").alias("category"))
                for c in columns
            ]
        )
        long = df.select(quoted(label).cast("double").alias("_y"), F.inline(pairs))
        self.stats = (
            long.filter(F.col("category").isNotNull())
            .groupBy("column_name", "category")
            .agg(F.sum("_y").alias("total"), F.count(F.lit(1)).alias("n"))
        )
        self.stats = materialise(self.stats)
        return self

    def transform(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Unseen, NULL and once-seen categories get the prior."""
        if self.stats is None:
            raise ValueError("fit the encoder before transforming")
        prior = self._prior()
        share = (F.col("total") + F.lit(self.a) * prior) / (F.col("n") + F.lit(self.a))
        # a category seen once equals an unseen one, so it need not be looked up
        columns = list(columns or self.columns)
        repeated = self.stats.filter(F.col("n") > 1)
        short, long = _by_length(repeated, columns)

        def encoded(c: str) -> Column:
            own = [r for r in short if r["column_name"] == c]
            if not own:
                return prior
            value = [(r["total"] + self.a * self.prior) / (r["n"] + self.a) for r in own]
            table = F.create_map(*[F.lit(x) for r, v in zip(own, value) for x in (r["category"], v)])
            return F.coalesce(F.try_element_at(table, quoted(c).cast("string")), prior)

        df = df.withColumns({c: encoded(c) for c in columns if c not in long})
        return _looked_up(df, long, repeated.select("column_name", "category", share.alias("value")), prior)

    def _prior(self) -> Column:
        """The share of the label in all rows; NULL if there were none."""
        return F.lit(self.prior).cast("double")

    def fit_transform(
        self, df: DataFrame, column: str, label: str, order: str, **bounds: int
    ) -> DataFrame:
        """Training rows, each encoded from the rows before it in ``order``.

        ``order`` must be unique. Adds ``<column>_encoded``; a NULL category is
        the prior.
        """
        self.fit(df, [column], label)
        prior = self._prior()
        ordered = df.withColumns(
            {
                "_order": quoted(order),
                "_y": quoted(label).cast("double"),
                "_one": F.lit(1),
            }
        )
        totals = running_totals(ordered, "_order", ["_y", "_one"], [column], **bounds)
        share = (F.col("_y_before") + F.lit(self.a) * prior) / (F.col("_one_before") + F.lit(self.a))
        value = F.when(quoted(column).isNull(), prior).otherwise(share)
        return totals.select(*[quoted(c) for c in df.columns], value.alias(f"{column}_encoded"))
