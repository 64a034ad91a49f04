"""Labels for the column headers of client files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.functions import scoring, text
from claimflow.operators import rules
from claimflow.operators.skew import lookup_join
from claimflow.operators.vocabulary import WORD, token_ids
from claimflow.sources.readers import explode_headers
from claimflow.sources.sinks import PART_ROWS, envelope_batch

HEADS = {"prod": fixed.PRODUCT_LABELS, "hdr": fixed.HEADER_LABELS, "ent": fixed.PARTY_LABELS}


def header_words(header: Column) -> Column:
    """Lower-cased words of a normalised header."""
    return F.regexp_extract_all(F.lower(text.normalise_header(header)), F.lit(WORD), F.lit(0))


def encode_headers(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Add ``ids``: the header's word ids, padded in front to the fixed length.

    Equal headers are encoded once; the join back is on the header text.
    """
    distinct = df.select("column_name").filter(F.col("column_name").isNotNull()).distinct()
    ids = token_ids(distinct, "column_name", header_words(F.col("column_name")), vocabulary)
    padded = ids.withColumn("ids", text.pad_left(F.col("ids"), fixed.HEADER_SEQUENCE_LENGTH))
    return lookup_join(df, padded, ["column_name"])


def decode_heads(df: DataFrame) -> DataFrame:
    """Label and confidence of each head from ``prod_scores``, ``hdr_scores``, ``ent_scores``."""
    columns = {}
    for head, labels in HEADS.items():
        scores = F.col(f"{head}_scores")
        columns[head] = scoring.decode(scoring.argmax(scores), labels)
        columns[f"{head}_confidence"] = scoring.softmax_top(scores)
    return df.withColumns(columns)


def correct_labels(df: DataFrame) -> DataFrame:
    """Rule bank, pattern rules, triplets, and the override of placeholder headers."""
    ruled = rules.apply_pattern_rules(rules.apply_rules(df))
    return rules.override_blank(rules.triplets(ruled))


def label_headers(
    datasets: DataFrame,
    vocabulary: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Envelopes of header lists. ``score`` adds the three score arrays to encoded rows."""
    encoded = encode_headers(explode_headers(datasets), vocabulary)
    labelled = correct_labels(decode_heads(score(encoded)))
    return envelope_batch(labelled, "dataset_id", "pos", ["column_name", "triplet"], part_rows, F.col("pos").isNotNull())
