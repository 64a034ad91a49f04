"""The corpus pipeline: raw documents to a mix placed in shards.

Each stage takes (spark, docs, sf_dir) and returns a table with the columns of
``documents``, the last one with a slot and a shard besides. A stage works on all
that the one before it kept; ``run`` writes each stage's rows to the shared folder
and reads them again, so a lost executor never costs more than the stage at work.

Defined cases are those of the operators: a null or letterless text is rejected by
the first stage; an empty table stays empty through all stages; other columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import decontaminate, langid, mixing, sharding, simhash
from claimflow.llm.common import read
from claimflow.session import materialise

SHARDS = [f"shard-{i:03d}" for i in range(32)]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts in no known language; name the language where none was given."""
    found = langid.classify(docs, langid.fit_on_folds(docs)).filter("NOT rejected")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.representatives(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark items."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their target weights; runs of words taken are the documents now."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give every document its shard."""
    return sharding.place(docs, ["doc_id"], SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", shards),
]

#: SimHash, language models and pseudorandom draws have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to rows with a shard."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
