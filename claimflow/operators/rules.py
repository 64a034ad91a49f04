"""Correction of predicted header labels by a bank of rules.

A row has the raw header ``column_name`` and the labels ``prod``, ``hdr`` and
``ent``. The rule table comes first: every condition looks at the labels as they
were predicted, and of several rules that hit one label the last one counts. The
pattern rules follow; each of them sees what the one before it left.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.functions.categories import is_in

TARGETS = ("prod", "hdr", "ent")


@dataclass(frozen=True)
class Rule:
    """Set ``target`` to ``value`` where all listed fields match."""

    target: str
    value: str
    match: dict[str, list[str]] = field(default_factory=dict)
    unless: dict[str, list[str]] = field(default_factory=dict)

    def condition(self) -> Column:
        parts = [is_in(F.col(c), v) for c, v in self.match.items()]
        parts += [~is_in(F.col(c), v) for c, v in self.unless.items()]
        return reduce(lambda a, b: a & b, parts)


UNK = fixed.UNKNOWN_LABEL
PRIMARY = ["Primary"]

# Which labels and headers a correction looks at, in order of application.
HEADER_RULES = [
    Rule("prod", UNK, {"ent": ["Spouse", "Child", "Dependent"], "prod": ["VIS", "DEN"]}),
    Rule("hdr", "AddressLine1", {"column_name": ["Employee_Address"], "hdr": ["Zip"]}),
    Rule("hdr", "HireDate", {"column_name": ["Eligibility_DOH"]}),
    Rule("hdr", "BenefitClass", {"column_name": ["Class/Set"]}),
    Rule("hdr", "Zip", {"column_name": ["Employee_Address_3"], "hdr": ["AddressLine3"]}),
    Rule("hdr", "Grandfathered Amount", {"hdr": ["GF_BenefitAmount"]}),
    Rule("prod", "LIFEVOL", {"column_name": fixed.VOLUNTARY_LIFE_AMOUNTS, "prod": ["LIFESUP"]}),
    Rule("prod", "ADDVOL", {"column_name": fixed.VOLUNTARY_ADD_AMOUNTS, "prod": ["ADDSUP"]}),
    Rule("prod", "LIFESUP", {"column_name": fixed.SUPPLEMENTAL_LIFE_BENEFITS, "prod": ["LIFEVOL"]}),
    Rule("ent", "Spouse", {"column_name": ["Dependent_Relationship_Dependent_Relationship"], "ent": ["Dependent"]}),
    Rule("ent", UNK, {"hdr": ["AccountNumber"], "ent": PRIMARY, "prod": [UNK]}),
    Rule("prod", "LIFE", {"column_name": fixed.BASIC_LIFE_AMOUNTS, "ent": PRIMARY, "prod": ["LTD"]}),
    Rule("prod", "LIFEVOL", {"column_name": ["Supplemental/Voluntary_Employee_Life_Effective_Date"], "hdr": ["EffectiveDate"], "prod": ["LIFESUP"]}),
    Rule("hdr", "Applied For Amount", {"hdr": ["BinaryResponse"], "ent": PRIMARY}, {"prod": [UNK, "primary"]}),
    Rule("ent", UNK, {"hdr": [UNK], "ent": PRIMARY}, {"prod": [UNK]}),
    Rule("prod", "LIFEVOL", {"prod": ["LIFESUP"], "hdr": ["Inforce Amount"], "ent": PRIMARY, "column_name": ["Supplemental/Voluntary_Employee_Life_In_Force_Amount"]}),
    Rule("prod", "ADDVOL", {"prod": ["ADDSUP"], "hdr": ["EffectiveDate"], "ent": PRIMARY, "column_name": ["Supplemental/Voluntary_Employee_AD&D_Effective_Date"]}),
    Rule("hdr", "State", {"prod": [UNK], "hdr": ["Zip"], "ent": PRIMARY, "column_name": ["Employee_Address_3"]}),
    Rule("ent", UNK, {"prod": [UNK], "hdr": [UNK], "ent": PRIMARY}),
    Rule("ent", "Primary", {"ent": [UNK]}, {"hdr": ["GroupNumber", "AccountNumber"]}),
    Rule("ent", "Primary", {"ent": ["Child"], "prod": ["CHLIFE", "CHADD"]}),
    Rule("prod", UNK, {"hdr": fixed.PERSONAL_HEADERS}, {"prod": [UNK]}),
]

HOSPITAL = r"^hos."
DEPENDENT_HEADER = r"^dependent_relationship_dependent.+([0-9])"
DEPENDENT_LABEL = r"^dependent"
NUMBERED = r"^.+([0-9])"
ADDRESS = r"^employee_address(_[0-9])?"
BLANK = r"^blank_header_[0-9]+$"


def apply_rules(df: DataFrame, rules: list[Rule] = HEADER_RULES) -> DataFrame:
    """All rules at once, each judged on the incoming labels; the last hit wins."""

    def corrected(target: str) -> Column:
        chain = None
        for rule in reversed([r for r in rules if r.target == target]):
            start = F if chain is None else chain
            chain = start.when(rule.condition(), F.lit(rule.value))
        return F.col(target) if chain is None else chain.otherwise(F.col(target))

    return df.withColumns({t: corrected(t) for t in TARGETS})


def apply_pattern_rules(df: DataFrame) -> DataFrame:
    """The pattern rules, one after the other."""
    header = F.lower("column_name")

    hospital = header.rlike(HOSPITAL) & (F.col("hdr") == "CoverageTier") & (F.col("ent") == UNK)
    df = df.withColumn("prod", F.when(hospital, F.lit("HI")).otherwise(F.col("prod")))

    dependent = (
        header.rlike(DEPENDENT_HEADER)
        & F.lower("ent").rlike(DEPENDENT_LABEL)
        & (F.col("hdr") == "Relationship")
        & (F.col("prod") == UNK)
    )
    nth_dependent = F.concat(F.lit("Child-"), F.regexp_extract(header, DEPENDENT_HEADER, 1))
    df = df.withColumn("ent", F.when(dependent, nth_dependent).otherwise(F.col("ent")))

    child = (F.col("ent") == "Child") & (F.col("prod") == UNK) & header.rlike(NUMBERED)
    nth_child = F.concat(F.lit("Child-"), F.regexp_extract(header, NUMBERED, 1))
    line = F.regexp_extract(header, ADDRESS, 1)
    address = (
        F.when(~header.rlike(ADDRESS), F.col("hdr"))
        .when(line == "", F.lit("AddressLine1"))
        .when(line == "_1", F.lit("City"))
        .when(line == "_2", F.lit("State"))
        .when(line == "_3", F.lit("Zip"))
        .otherwise(F.col("hdr"))
    )
    return df.withColumns({"ent": F.when(child, nth_child).otherwise(F.col("ent")), "hdr": address})


def triplets(df: DataFrame) -> DataFrame:
    """Add ``triplet``: (label, confidence) of product, header and party.

    Confidences are those of the prediction, whatever the rules changed.
    """
    pairs = [
        F.struct(F.col(t).alias("label"), F.col(f"{t}_confidence").alias("confidence")) for t in TARGETS
    ]
    return df.withColumn("triplet", F.array(*pairs))


def override_blank(df: DataFrame) -> DataFrame:
    """Placeholder headers have no meaning: unknown in all three places, for certain."""
    unknown = F.struct(F.lit(UNK).alias("label"), F.lit(1.0).alias("confidence"))
    blank = F.col("column_name").rlike(BLANK)
    return df.withColumn("triplet", F.when(blank, F.array_repeat(unknown, 3)).otherwise(F.col("triplet")))
