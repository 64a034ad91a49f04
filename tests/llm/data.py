"""Small tables with the odd cases every operator must stand."""

from __future__ import annotations

import random

LONG = "b" * 3_000 + " " + "lorem ipsum dolor sit amet " * 400

ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here now", "en", "s0"),
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here now", "en", "s0"),
    (2, None, None, None),
    (3, "", "en", "s1"),
    (4, "   \t\n ", None, "s1"),
    (None, "no id but some text", "en", None),
    (5, LONG, "en", "s0"),
    (6, LONG, "en", "s2"),
    (7, "!!! 123 ???", "en", "s2"),
    (8, "éÉ ÄÖ ß 漢字 🙂", None, "s0"),
]


def documents(spark, rows=ODD):
    """Documents with columns that clash with those operators add."""
    clash = [(*r, "x", 7, "y", True, "z") for r in rows]
    return spark.createDataFrame(
        clash,
        "doc_id long, text string, lang string, source string, "
        "slot string, size long, score string, rejected boolean, n_replaced string",
    )


def words_of(rng: random.Random, n: int, letters: str = "abc") -> str:
    """A text of n short words from few letters, so that it repeats itself."""
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(n))
