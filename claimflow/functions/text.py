"""Text as columns: everything here stays inside one narrow stage."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anything that is neither a letter, a number, an underscore nor white space.
PUNCTUATION = (
    r"[^\p{L}\p{N}_\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WHITE_SPACE = (
    r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def constant_list(values: Sequence, item: str = "string") -> Column:
    """A constant array as one literal that the optimizer folds, however long."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{item}>")


def remove_stopwords(c: Column, words: Sequence[str], missing: str = "_na_") -> Column:
    """Drop stop words between single spaces. Case counts: a leading "Other" stays."""
    stop = constant_list(words)
    kept = F.filter(F.split(F.coalesce(c, F.lit(missing)), " "), lambda w: ~F.array_contains(stop, w))
    return F.array_join(kept, " ")


def strip_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, PUNCTUATION, "")


def words(c: Column) -> Column:
    """White-space tokens in order, without empty ones."""
    return F.filter(F.split(c, WHITE_SPACE), lambda w: w != "")


def lowered(c: Column, missing: str = "__na__") -> Column:
    return F.lower(F.coalesce(c, F.lit(missing)))


def keyword_flags(c: Column, keywords: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """One 0/1 column per name: set if any of its substrings occurs in ``c``."""
    flags = {}
    for name, parts in keywords.items():
        hit = c.contains(parts[0])
        for part in parts[1:]:
            hit = hit | c.contains(part)
        flags[name] = F.coalesce(hit, F.lit(False)).cast("int")
    return flags


def phrase_flags(
    c: Column, phrases: Sequence[str], prefix: str, only: Sequence[str] | None = None
) -> dict[str, Column]:
    """One 0/1 column per phrase that occurs in ``c``, and "others" where none does.

    ``only`` limits the columns to the names that are needed. All phrases together
    are tested by one pattern, so "others" does not ask for their columns.
    """
    names = {prefix + p: p for p in phrases}
    others = prefix + "others"
    wanted = [*names, others] if only is None else [n for n in only if n in names or n == others]
    flags = {n: F.coalesce(F.contains(c, F.lit(names[n])), F.lit(False)).cast("int") for n in wanted if n in names}
    if others in wanted:
        flags[others] = (~F.coalesce(c.rlike(any_of(phrases)), F.lit(False))).cast("int")
    return flags


def any_of(phrases: Sequence[str]) -> str:
    """A pattern that finds any of the phrases, written as a tree of their beginnings.

    A list of alternatives is tried from its start at every place of a text; in a tree a
    place is left as soon as no phrase goes on with its letters.
    """
    tree: dict = {}
    for phrase in phrases:
        node = tree
        for letter in phrase:
            node = node.setdefault(letter, {})
        node[""] = {}

    def written(node: dict) -> str:
        # where a phrase ends, longer ones that begin with it add nothing
        if "" in node or not node:
            return ""
        parts = [re.escape(letter) + written(below) for letter, below in node.items()]
        if len(parts) == 1:
            return parts[0]
        firsts = "".join(re.escape(letter) for letter in node)
        return f"(?=[{firsts}])(?:{'|'.join(parts)})"

    return written(tree)


def normalise_header(c: Column) -> Column:
    """A raw column header as a readable phrase.

    Camel case and dashes become word breaks, a trailing ``_id`` is dropped, and
    only the first letter is a capital.
    """
    split_caps = F.regexp_replace(c, r"([A-Z]+)([A-Z][a-z])", "$1_$2")
    split_camel = F.regexp_replace(split_caps, r"([a-z\d])([A-Z])", "$1_$2")
    snake = F.lower(F.translate(split_camel, "-", "_"))
    phrase = F.translate(F.regexp_replace(snake, r"_id$", ""), "_", " ")
    return F.concat(F.upper(F.substring(phrase, 1, 1)), F.substring(phrase, F.lit(2), F.length(phrase)))


def pad_left(ids: Column, length: int) -> Column:
    """Zeros in front up to ``length``; a longer sequence keeps its first entries."""
    missing = F.lit(length) - F.size(ids)
    return F.when(
        missing >= 0, F.concat(F.array_repeat(F.lit(0).cast("int"), missing), ids)
    ).otherwise(F.slice(ids, 1, length))
