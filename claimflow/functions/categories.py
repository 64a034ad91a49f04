"""Consolidation of codes and categories into a few groups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_in(c: Column, values: Iterable[str]) -> Column:
    """Membership that is false, not NULL, for NULL."""
    return F.coalesce(c.isin(*values), F.lit(False))


def sic_division(c: Column) -> Column:
    """First two characters of an industry code."""
    return F.substring(c.cast("string"), 1, 2)


def code_part(c: Column, part: int, missing: str) -> Column:
    """Part 0 or 1 of a diagnosis code around its dot; NULL where there is none."""
    return F.get(F.split(F.coalesce(c, F.lit(missing)), r"\."), F.lit(part))


def map_prefix(
    c: Column,
    prefixes: Sequence[tuple[str, str]],
    allowed: Iterable[str],
    unknown: str,
    other: str,
) -> Column:
    """Group of the prefix that a category starts with.

    NULL and empty count as ``unknown``. A category without a known prefix stays
    only if it already is an allowed group name; everything else is ``other``.
    ``c`` must already have the letter case of the prefixes.
    """
    text = F.when(c.isNull() | (c == ""), F.lit(unknown)).otherwise(c)
    chain = None
    for prefix, group in prefixes:
        hit = text.startswith(prefix)
        chain = F.when(hit, F.lit(group)) if chain is None else chain.when(hit, F.lit(group))
    return chain.when(text.isin(*allowed), text).otherwise(F.lit(other))


def map_members(c: Column, groups: Mapping[str, Sequence[str]], default: Column | str) -> Column:
    """Name of the group whose member list holds the value, else the default."""
    chain = None
    for group, members in groups.items():
        hit = c.isin(*members)
        chain = F.when(hit, F.lit(group)) if chain is None else chain.when(hit, F.lit(group))
    return chain.otherwise(F.lit(default) if isinstance(default, str) else default)


def remap(c: Column, pairs: Mapping[str, str]) -> Column:
    """Exact value replacement; values that are not listed pass through."""
    return map_members(c, {new: [old] for old, new in pairs.items()}, c)


def collapse_except(c: Column, keep: Iterable[str], to: str = "others") -> Column:
    """Everything outside the keep list, NULL included, becomes ``to``."""
    return F.when(is_in(c, keep), c).otherwise(F.lit(to))


def collapse_listed(c: Column, drop: Iterable[str], to: str = "others") -> Column:
    """Listed values become ``to``; NULL stays NULL."""
    return F.when(c.isin(*drop), F.lit(to)).otherwise(c)


def award_bin(c: Column, bins: Mapping[str, Sequence[str]]) -> Column:
    """Bin of an award range. The sign character in front is dropped first.

    NULL and empty count as ``NA``; ranges that no bin lists pass through.
    """
    amount = F.when(c.isNull() | (c == ""), F.lit("NA")).otherwise(F.substring(c, F.lit(2), F.length(c)))
    return map_members(amount, bins, amount)


def mentions(c: Column, login: str) -> Column:
    """1 if the login occurs in the text of a login list; NULL text mentions none."""
    return F.coalesce(c.contains(login), F.lit(False)).cast("int")
