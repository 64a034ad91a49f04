"""Inputs: claim records, columnar batches, header lists, templates, artifact lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.operators.projection import quoted, require
from claimflow.operators.skew import lookup_join
from claimflow.session import materialise


def claim_schema(columns: Sequence[str], doubles: Sequence[str] = ()) -> T.StructType:
    """Declared schema of a claim record: text, except for the named doubles."""
    return T.StructType(
        [T.StructField(c, T.DoubleType() if c in doubles else T.StringType()) for c in columns]
    )


def read_claims(
    spark: SparkSession,
    source: str | Iterable[Mapping],
    columns: Sequence[str],
    form: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Claim records from files, or from dicts handed over by a caller.

    File formats with types of their own keep them; JSON and CSV are read with a
    declared schema, never an inferred one. Only the named columns are read.
    """
    if not isinstance(source, str):
        schema = schema or claim_schema(columns)
        rows = [
            tuple(None if r.get(c) is None else r[c] if schema[c].dataType != T.StringType() else str(r[c]) for c in columns)
            for r in source
        ]
        return spark.createDataFrame(rows, schema)
    reader = spark.read.format(form)
    if form in ("json", "csv"):
        reader = reader.schema(schema or claim_schema(columns))
    if form == "csv":
        reader = reader.option("header", True)
    return require(reader.load(source), columns)


def read_batch(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A batch of transactions from a columnar file."""
    df = spark.read.parquet(path)
    return require(df, columns) if columns else df


def rows_from_columns(df: DataFrame, columns: Sequence[str], index: str = "index") -> DataFrame:
    """Rows out of column maps {row number: value}, one map per column.

    The row numbers are those of the first column; the number is kept as the
    order of the batch. Maps that list the same numbers in the same order are laid side
    by side; for others, numbers are looked up by a join for each column. A batch given
    as one row is worked on by one task: ``read_column_maps`` reads files in pieces.
    """
    keys = [F.map_keys(quoted(c)) for c in columns]
    alike = reduce(lambda a, b: a & b, [k == keys[0] for k in keys[1:]], F.lit(True))
    given = df.select(*[quoted(c) for c in columns], F.coalesce(alike, F.lit(False)).alias("_alike"))
    zipped = F.arrays_zip(keys[0].alias("_0"), *[F.map_values(quoted(c)).alias(f"_{i}") for i, c in enumerate(columns, 1)])
    beside = given.filter("_alike").select(F.explode(zipped).alias("_row"))
    beside = beside.select(
        F.col("_row._0").cast("long").alias(index), *[F.col(f"_row._{i}").alias(c) for i, c in enumerate(columns, 1)]
    )
    # written, so that a batch keeps its number
    others = materialise(given.filter("NOT _alike").drop("_alike").withColumn("_batch", F.monotonically_increasing_id()))
    if others.isEmpty():
        return beside
    joined = others.select("_batch", F.explode(F.map_keys(quoted(columns[0]))).alias("_key"))
    for c in columns:
        joined = joined.join(others.select("_batch", F.explode(quoted(c)).alias("_key", c)), ["_batch", "_key"], "left")
    return beside.unionByName(joined.select(F.col("_key").cast("long").alias(index), *[quoted(c) for c in columns]))


#: A JSON text in quotes, without anything that could be tried in two ways.
QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: An entry of a column map: the head of a new column, number and value, closing braces.
ENTRY = rf"(?s)^\s*+(?:\{{\s*+)?(?:({QUOTED})\s*+:\s*+\{{\s*+)?(?:({QUOTED})\s*+:\s*+(.*?))?[\s}}]*+$"


def _quotes(piece: Column) -> Column:
    """How many quotes of a piece open or close a text."""
    bare = F.when(F.contains(piece, F.lit("\\")), F.regexp_replace(piece, r"\\.", "")).otherwise(piece)
    return F.length(bare) - F.length(F.translate(bare, '"', ""))


def read_column_maps(spark: SparkSession, path: str, schema: T.StructType | str, index: str = "index") -> DataFrame:
    """Rows of batch files, each one JSON object {column: {row number: value}}.

    Files are split at commas wherever they are large, by the reader that splits lines,
    so a batch is read by many tasks and never held as one row. A comma inside a text is
    told by the quotes before it: each block counts its own, one number for each block
    is added up, and only pieces that such a comma cut are put together again. The
    column an entry belongs to is the last one whose head stands before it. Entries
    then meet by file and row number, and are read with their types.

    A row has every number that occurs in any column; columns that a row lacks, and
    nulls, are NULL; a value that does not have its column's type is NULL; columns
    beyond ``schema`` are left out. Values are single values, not lists or objects. The
    file of a row is kept as ``batch``.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    place = ["_file", "_block"]
    meta = F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")
    lines = spark.read.option("lineSep", ",").text(path).select("value", *meta)
    named = materialise(lines.withColumn("_at", F.monotonically_increasing_id()).withColumn("_quotes", _quotes(F.col("value"))))
    # pieces go by the number of their file: sorts would compare long paths that begin alike
    files = materialise(named.select("_path").distinct().withColumn("_file", F.monotonically_increasing_id()))
    pieces = lookup_join(named, files, ["_path"], "inner").drop("_path")

    # one row for each block of a file from here ...
    blocks = pieces.groupBy(*place).agg(F.sum("_quotes").alias("_quotes"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    open_ = (F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2).alias("_open")
    blocks = blocks.select(*place, open_)
    # ... to here
    inside = Window.partitionBy(*place).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    counted = pieces.join(F.broadcast(blocks), place).withColumn(
        "_starts", (F.col("_open") + F.coalesce(F.sum("_quotes").over(inside), F.lit(0))) % 2 == 0
    )
    upto = Window.partitionBy(*place).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("_n", F.sum(F.col("_starts").cast("long")).over(upto))
    whole = (F.col("_starts")) & (F.col("_quotes") % 2 == 0)
    counted = materialise(counted.withColumn("_whole", whole).select("value", *place, "_at", "_starts", "_n", "_whole"))
    # what stands before a block's first start belongs to the last entry of a block before
    lasts = counted.groupBy(*place).agg(F.max("_n").alias("_last"))
    owner = F.last(F.when(F.col("_last") > 0, F.struct("_block", "_last")), ignorenulls=True).over(earlier)
    lasts = lasts.select(*place, owner.alias("_owner"))
    cut = counted.filter("NOT _whole").join(F.broadcast(lasts), place)
    own = F.struct(F.col("_block").alias("_block"), F.col("_n").alias("_last"))
    cut = cut.withColumn("_entry", F.when(F.col("_n") > 0, own).otherwise(F.col("_owner")))
    mended = cut.groupBy("_file", "_entry").agg(F.sort_array(F.collect_list(F.struct("_block", "_at", "value"))).alias("_parts"))
    mended = mended.select(
        F.array_join(F.transform("_parts", lambda p: p["value"]), ",").alias("value"), "_file", "_entry._block",
        F.col("_entry._last").alias("_n"),
    )
    entries = counted.filter("_whole").select("value", *place, "_n").unionByName(mended)

    group = [F.regexp_extract("value", ENTRY, i) for i in (1, 2, 3)]
    group[0] = F.when(F.contains("value", F.lit("{")), group[0]).otherwise("")  # a head ends in a brace
    split = entries.select(*place, "_n", group[0].alias("_head"), group[1].alias("_key"), group[2].alias("_value"))
    split = split.withColumn("_head", F.nullif("_head", F.lit("")))
    upto = Window.partitionBy(*place).orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = materialise(split.withColumn("_head", F.last("_head", ignorenulls=True).over(upto)))
    heads = split.groupBy(*place).agg(F.max_by("_head", "_n").alias("_head"))
    heads = heads.select(*place, F.last("_head", ignorenulls=True).over(earlier).alias("_before"))
    told = split.join(F.broadcast(heads), place).filter("_key != ''")
    entry = F.concat(F.coalesce("_head", "_before"), F.lit(":"), F.trim("_value"))
    rows = told.groupBy("_file", "_key").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ","), F.lit("}")).alias("_row"))
    number = F.regexp_replace("_key", '"', "").cast("long").alias(index)
    rows = lookup_join(rows, files, ["_file"], "inner")
    read = rows.select(F.col("_path").alias("batch"), number, F.from_json("_row", schema).alias("_row"))
    return read.select("batch", index, *[F.col("_row")[c].alias(c) for c in schema.names])


def explode_headers(df: DataFrame, dataset: str = "dataset_id", headers: str = "columns") -> DataFrame:
    """(dataset, pos, column_name); a dataset without headers keeps one row of NULLs."""
    return df.select(
        quoted(dataset), F.posexplode_outer(quoted(headers)).alias("pos", "column_name")
    )


def load_template(spark: SparkSession, path: str) -> list[str]:
    """Feature names in order, from the header line of a CSV file."""
    return spark.read.option("header", True).csv(path).columns


def resolve_artifacts(manifest: DataFrame) -> DataFrame:
    """(data_name, data_value) of a manifest with ``pos``; the last entry of a name wins."""
    last = F.max_by("data_value", "pos").alias("data_value")
    return manifest.groupBy("data_name").agg(last)
