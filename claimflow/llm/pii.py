"""Surrogates for personal data.

Detected entities (mail addresses, phone and card numbers, IBANs, social security
numbers, IP addresses, secrets given as ``password=...``, and persons named with a
title) are replaced by keyed surrogates of the same type and format: digits become
digits, letters letters of their case and script, separators, brand and country
prefixes stay, check digits are right (numbers whose check digits are wrong are no cards
and no IBANs, and stay), given names keep the
gender of the title. Letters of other scripts become letters of the same sort near them
in the same script. Where a format has too few values, surrogates grow by a digit or a
letter, and internet addresses become ones of the longer kind. All addresses of a mail
domain move to one new domain, and no two domains to the same. The same entity gets the same surrogate everywhere, in whatever
format it is written; a person's given and family names are entities of their own, so
a family shares its new name. Bare mentions of either in the same text follow, and a
given name met there with several titles has the gender of the one that tells it.

1. Every text is searched once; its distinct entities are written as rows.
2. All distinct entities get a surrogate by HMAC of type, value and attempt. Where
   two values met in one surrogate, or a surrogate is the value of some entity, all
   but the smallest value draw again, until none collide. The check is an aggregation
   over all entities of all texts.
3. Surrogates go back to the texts that mention them, and only those are rewritten
   and shuffled. An entity that very many texts mention is one row of the entity
   table; its side of the join is split by the adaptive skew join.

Defined cases: a null text stays null; an empty text stays empty; equal texts get
equal results and repeated rows stay repeated; texts are told apart by content, so
null or repeated ids do no harm; overlapping finds go to the type first in ``TYPES``
and then to the earlier start; columns named ``n_replaced`` are replaced, all others
kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hmac
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimflow.llm.common import broadcast_if_small, unused
from claimflow.session import materialise

NAMES = ("family", "given_m", "given_f", "given_x")
TYPES = ("email", "iban", "ip", "phone", "ssn", "card", "secret", *NAMES)
#: Rounds of drawing again after which something other than chance is at work.
ROUNDS = 64
#: Draws after which a name or address may grow by a character.
GROW_AFTER = 4

EMAIL = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
NUMBERS = re.compile(
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<phone>(?<![\w+.-])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}|\+\d{9,14})(?![\w-]))"
)
SECRET = re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b\s*[:=]\s*[\"']?([^\s\"',;]{6,})")
MALE = ("Mr", "Herr", "Monsieur", "Sr", "Señor", "Don", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Madame", "Sra", "Srta", "Señora", "Doña", "г-жа")
NEITHER = ("Dr", "Prof", "Mx")
NAME = r"[^\W\d_a-zа-яα-ω][^\W\d_]+(?:[-'’][^\W\d_]+)*"
PERSON = re.compile(
    rf"\b({'|'.join(sorted((*MALE, *FEMALE, *NEITHER), key=len, reverse=True))})\.?[ \t]+({NAME}(?:[ \t]+{NAME}){{0,2}})"
)

# Letters that surrogates are drawn from, by script: vowels, then consonants.
LATIN = ("aeiou", "bcdfghjklmnprstvwz")
CYRILLIC = ("аеиоу", "бвгдзклмнпрст")
GREEK = ("αεηιου", "βγδζθκλμνπρστ")
# The last letters of given names, by gender and script.
ENDINGS = {"m": ("us", "ей", "ος"), "f": ("a", "а", "α"), "x": ("ey", "и", "ι")}


# --- detection -------------------------------------------------------------------


def digits_of(text: str) -> str:
    """The decimal digits in a text."""
    return "".join(c for c in text if c.isdigit())


def canonical(kind: str, mention: str) -> str:
    """The entity that a mention stands for, whatever its format."""
    if kind in ("card", "ssn"):
        return digits_of(mention)
    if kind == "phone":
        digits = digits_of(mention)
        return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
    if kind == "iban":
        return mention.replace(" ", "")
    return mention if kind == "secret" else mention.lower()


def luhn(digits: str) -> int:
    """The sum of a card number, 0 modulo 10 where its check digit is right."""
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def iban_rest(iban: str) -> int:
    """The remainder of an IBAN, 1 where its check digits are right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _plausible(kind: str, mention: str) -> bool:
    if kind == "ip":
        return all(int(o) < 256 for o in mention.split("."))
    if kind == "card":
        return luhn(digits_of(mention)) == 0
    return iban_rest(canonical(kind, mention)) == 1 if kind == "iban" else True


def _words(kind: str, person: re.Match) -> Iterator[tuple[int, int, str]]:
    words = [(m.start(), m.end()) for m in re.finditer(r"\S+", person[2])]
    at = person.start(2)
    for i, (s, e) in enumerate(words):
        yield at + s, at + e, "family" if i == len(words) - 1 else kind


def mentions(text: str | None) -> list[tuple[int, int, str]]:
    """All mentions as (start, end, type), in order and not overlapping."""
    if not text:
        return []
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    if re.search(r"\d", text):
        found += [(m.start(), m.end(), m.lastgroup) for m in NUMBERS.finditer(text) if _plausible(m.lastgroup, m[0])]
    if "=" in text or ":" in text:
        found += [(m.start(1), m.end(1), "secret") for m in SECRET.finditer(text)]
    known: dict[str, str] = {}
    for m in PERSON.finditer(text):
        gender = "m" if m[1] in MALE else "f" if m[1] in FEMALE else "x"
        for s, e, kind in _words(f"given_{gender}", m):
            # a title that tells the gender settles it for the name; a name once met as a
            # family's stays one
            known[text[s:e]] = min(kind, known.get(text[s:e], kind), key=NAMES.index)
    if known:
        again = re.compile(rf"\b(?:{'|'.join(map(re.escape, sorted(known, key=len, reverse=True)))})\b")
        found += [(m.start(), m.end(), known[m[0]]) for m in again.finditer(text)]
    taken: list[tuple[int, int, str]] = []
    # by type first: a mail address inside a secret stays a mail address
    busy = bytearray(len(text)) if found else b""
    for s, e, kind in sorted(set(found), key=lambda f: (TYPES.index(f[2]), f[0])):
        if not any(busy[s:e]):
            busy[s:e] = b"\x01" * (e - s)
            taken.append((s, e, kind))
    return sorted(taken)


# --- surrogates --------------------------------------------------------------------


class Draw:
    """Keyed pseudorandom numbers for one entity."""

    def __init__(self, key: bytes, *name: object):
        self.key, self.name, self.held, self.block = key, "\x1f".join(map(str, name)).encode(), b"", 0

    def below(self, n: int) -> int:
        if len(self.held) < 8:
            self.held += hmac.digest(self.key, self.name + b"\x1f%d" % self.block, "sha256")
            self.block += 1
        number, self.held = int.from_bytes(self.held[:8], "big"), self.held[8:]
        return number % n


def _script(c: str) -> int | None:
    """The alphabet of a letter: Latin, Cyrillic, Greek, or none of these."""
    code = ord(c)
    if 0x400 <= code < 0x530:
        return 1
    if 0x370 <= code < 0x400 or 0x1F00 <= code < 0x2000:
        return 2
    return 0 if code < 0x250 or 0x1E00 <= code < 0x1F00 else None


@lru_cache(1024)
def _neighbours(block: int, category: str) -> str:
    """The letters of one sort among 128 characters."""
    return "".join(c for c in map(chr, range(block * 128, block * 128 + 128)) if unicodedata.category(c) == category)


def _like(c: str, draw: Draw) -> str:
    """A character of the same kind: a digit, a letter of that script and case, or itself."""
    if c.isdigit():
        return str(draw.below(10))
    if not c.isalpha():
        return c
    script = _script(c)
    if script is None:
        # any other script: a letter of the same sort from the same stretch of the script
        letters = _neighbours(ord(c) >> 7, unicodedata.category(c))
        return letters[draw.below(len(letters))]
    letters = "".join((LATIN, CYRILLIC, GREEK)[script])
    new = letters[draw.below(len(letters))]
    return new.upper() if c.isupper() else new


def _name(value: str, draw: Draw, ending: str, longer: int) -> str:
    """A pronounceable name in the script of ``value``."""
    if _script(value[0]) is None:
        return "".join(_like(c, draw) for c in value + value[-1] * longer)
    vowels, consonants = (LATIN, CYRILLIC, GREEK)[_script(value[0])]
    size = max(3, len(value)) + longer
    made = "".join((consonants, vowels)[i % 2][draw.below(len((consonants, vowels)[i % 2]))] for i in range(size))
    return made[: max(2, size - len(ending))] + ending


def _digits(value: str, kept: int, draw: Draw) -> str:
    """The same number of digits, the first ``kept`` unchanged; a first digit is never 0 or 1 unless it was."""
    out = value[:kept]
    for i, c in enumerate(value[kept:]):
        out += str(2 + draw.below(8)) if i == 0 and c > "1" else str(draw.below(10))
    return out


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The surrogate of an entity at that attempt, in its canonical form."""
    draw, longer = Draw(key, kind, value, attempt), attempt // GROW_AFTER
    if kind == "email":
        # the domain is an entity of its own, and is put in its place later
        local, _, domain = value.rpartition("@")
        return "".join(_like(c, draw) for c in local + "x" * longer) + "@" + domain
    if kind == "domain":
        host, _, top = value.rpartition(".")
        return "".join(_like(c, draw) for c in host + "x" * longer) + "." + top
    if kind == "card":
        new = _digits(value, 1, draw)
        return new[:-1] + str((10 - luhn(new[:-1] + "0")) % 10)
    if kind == "phone":
        return _digits(value + "2" * longer, max(0, min(3, len(value) - 10)), draw)
    if kind == "ssn":
        return _digits(value + "2" * longer, 0, draw)
    if kind == "ip" and longer:
        # so many that those of four numbers run out: one of the longer kind
        return "2001:db8:" + ":".join(f"{1 + draw.below(65535):x}" for _ in range(6))
    if kind == "ip":
        return ".".join(str(1 + draw.below(223) if i == 0 else draw.below(256)) for i in range(4))
    if kind == "iban":
        body = "".join(_like(c, draw) for c in value[4:]).upper()
        return f"{value[:2]}{98 - iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind == "secret":
        if re.fullmatch("[0-9a-f]+", value):
            return "".join("0123456789abcdef"[draw.below(16)] for _ in range(len(value) + longer))
        return "".join(_like(c, draw) for c in value + "x" * longer)
    script = _script(value[0])
    ending = ENDINGS[kind[-1]][script] if kind.startswith("given") and script is not None else ""
    return _name(value, draw, ending, longer)


def rendered(kind: str, mention: str, new: str) -> str:
    """A canonical surrogate in the format of the mention."""
    if kind in ("card", "ssn", "phone", "iban"):
        own = canonical(kind, mention)
        plain = [i for i, c in enumerate(mention) if (c != " " if kind == "iban" else c.isdigit())]
        out = list(mention)
        for i, c in zip(plain[len(plain) - len(own) :], new, strict=False):
            out[i] = c
        # digits by which a surrogate had to grow follow the last one
        return "".join(out[: plain[-1] + 1]) + new[len(own) :] + "".join(out[plain[-1] + 1 :])
    if kind in ("secret", "ip"):
        return new
    if kind == "email":
        return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new, strict=False)) + new[len(mention) :]
    return new.upper() if len(mention) > 1 and mention.isupper() else new[:1].upper() + new[1:]


# --- the operator -------------------------------------------------------------------

ENTITIES = "kind string, value string"


def _found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        rows = {
            (k1, k2, kind, canonical(kind, text[s:e]))
            for text, k1, k2 in zip(frame["text"], frame["k1"], frame["k2"], strict=True)
            for s, e, kind in mentions(text)
        }
        rows |= {(k1, k2, "domain", v.rpartition("@")[2]) for k1, k2, kind, v in rows if kind == "email"}
        yield pd.DataFrame(sorted(rows), columns=["k1", "k2", "kind", "value"])


def _drawn(key: bytes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = zip(frame["kind"], frame["value"], frame["attempt"], strict=True)
            yield frame.assign(surrogate=[surrogate(key, *r) for r in rows])

    return run


def distinct_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """Each entity (kind, value) with a surrogate that no other entity has or is."""
    shape = f"{ENTITIES}, attempt int, surrogate string"
    drawn = materialise(entities.withColumn("attempt", F.lit(0)).mapInPandas(_drawn(key), shape))
    values = entities.select("kind", F.col("value").alias("_taken"))
    for _ in range(ROUNDS):
        met = drawn.groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_first"))
        is_value = (met["kind"] == values["kind"]) & (met["surrogate"] == values["_taken"])
        met = met.join(values, is_value, "left").select(met["kind"], "surrogate", "_n", "_first", "_taken")
        met = met.filter((F.col("_n") > 1) | F.col("_taken").isNotNull())
        judged = drawn.join(met, ["kind", "surrogate"], "left")
        again = F.col("_taken").isNotNull() | (F.col("_n").isNotNull() & (F.col("value") != F.col("_first")))
        judged = materialise(judged.select("kind", "value", "attempt", "surrogate", F.coalesce(again, F.lit(False)).alias("_again")))
        if not judged.filter("_again").count():
            return drawn
        redo = judged.filter("_again").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        kept = judged.filter("NOT _again").drop("_again")
        drawn = materialise(kept.unionByName(redo.mapInPandas(_drawn(key), shape)))
    raise RuntimeError("surrogates still collide; the format leaves too few values")


def _replaced(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for text, pairs in zip(batch.column("text").to_pylist(), batch.column(len(columns)).to_pylist(), strict=True):
                new = {(p["kind"], p["value"]): p["surrogate"] for p in pairs}
                for kind, value in [k for k in new if k[0] == "email"]:
                    new[kind, value] = new[kind, value].rpartition("@")[0] + "@" + new["domain", value.rpartition("@")[2]]
                out, at, found = [], 0, mentions(text)
                for s, e, kind in found:
                    out += [text[at:s], rendered(kind, text[s:e], new[kind, canonical(kind, text[s:e])])]
                    at = e
                texts.append("".join([*out, text[at:]]))
                counts.append(len(found))
            kept = [pa.array(texts, pa.string()) if c == "text" else batch.column(i) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], [*columns, "n_replaced"])

    return run


def with_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """All rows with personal data in ``text`` replaced, and ``n_replaced`` mentions."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "n_replaced"])
    k1, k2, listed = unused("_k1", docs), unused("_k2", docs), unused("_pairs", docs)
    keyed = docs.withColumns({k1: F.xxhash64("text"), k2: F.xxhash64(F.lit(1), "text")})
    searched = keyed.select("text", F.col(k1).alias("k1"), F.col(k2).alias("k2"))
    found = materialise(searched.mapInPandas(_found, f"k1 long, k2 long, {ENTITIES}").distinct())
    resolved = distinct_surrogates(found.select("kind", "value").distinct(), key)
    pair = F.struct("kind", "value", "surrogate")
    pairs = found.join(resolved.drop("attempt"), ["kind", "value"]).groupBy("k1", "k2").agg(F.collect_list(pair).alias(listed))
    pairs = pairs.withColumnsRenamed({"k1": k1, "k2": k2})
    touched = broadcast_if_small(found.select(F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct())
    here = keyed.join(touched, [k1, k2], "left_semi").join(pairs, [k1, k2])
    shape = StructType([*docs.schema.fields, StructField("n_replaced", LongType())])
    changed = here.select(*[F.col(f"`{c}`") for c in docs.columns], listed).mapInArrow(_replaced(docs.columns), shape)
    same = keyed.join(touched, [k1, k2], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns], F.lit(0).cast("long").alias("n_replaced"))
    return changed.unionByName(same)
