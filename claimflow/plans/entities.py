"""Medical entities in diagnosis texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.operators.vocabulary import HELD_ENTRIES, extract_entities


def entity_envelopes(df: DataFrame, claim: str, text: str, gazetteer: DataFrame, held: int = HELD_ENTRIES) -> DataFrame:
    """One envelope per claim with a list of texts for every output label."""
    found = extract_entities(df, claim, text, gazetteer, held)
    return found.select(
        F.concat(F.col(claim).cast("string"), F.lit(":0")).alias("inputDataSource"),
        F.col(claim).alias("entityId"),
        F.col("entities").alias("predictedResult"),
    )
