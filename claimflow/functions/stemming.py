"""English suffix stripping after the published Porter2 description.

Called on a vocabulary, once per distinct word, never on running text.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
# Words with a form of their own, and words left alone.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie",
    "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky",
    "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
FINISHED = {
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed",
    "succeed",
}
SECOND = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"),
    ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"),
    ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"),
    ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"),
    ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"),
    ("ogi", "og"), ("li", ""),
]
THIRD = [
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"),
    ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
]
FOURTH = [
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism",
    "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic",
]

REGION = re.compile(r"[aeiouy][^aeiouy]")
FORCED_REGION = re.compile(r"gener|commun|arsen")
SHORT_END = re.compile(r"(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")


def _regions(word: str) -> tuple[int, int]:
    forced = FORCED_REGION.match(word)
    first = forced or REGION.search(word)
    r1 = first.end() if first else len(word)
    second = REGION.search(word, r1)
    return r1, second.end() if second else len(word)


def _has_vowel(text: str) -> bool:
    return any(ch in VOWELS for ch in text)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and _has_vowel(word[:-2]):
        return word[:-1]
    return word


def _participle(word: str, r1: int) -> str:
    for suffix in ("eedly", "eed"):
        if word.endswith(suffix):
            at = len(word) - len(suffix)
            return word[:at] + "ee" if at >= r1 else word
    for suffix in ("ingly", "edly", "ing", "ed"):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if not _has_vowel(stem):
                return word
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if stem.endswith(DOUBLES):
                return stem[:-1]
            return stem + "e" if r1 >= len(stem) and SHORT_END.search(stem) else stem
    return word


def _derived(word: str, r1: int, r2: int) -> str:
    for suffix, new in SECOND:
        if word.endswith(suffix):
            at = len(word) - len(suffix)
            fits = at >= r1
            if suffix == "ogi":
                fits = fits and word[at - 1 : at] == "l"
            elif suffix == "li":
                fits = fits and word[at - 1 : at] in LI_ENDINGS
            word = word[:at] + new if fits else word
            break
    for suffix, new in THIRD:
        if word.endswith(suffix):
            at = len(word) - len(suffix)
            word = word[:at] + new if at >= (r2 if suffix == "ative" else r1) else word
            break
    for suffix in FOURTH:
        if word.endswith(suffix):
            at = len(word) - len(suffix)
            fits = at >= r2 and (suffix != "ion" or word[at - 1 : at] in ("s", "t"))
            return word[:at] if fits else word
    return word


def stem_word(token: str) -> str:
    """Stem of one word, in lower case."""
    word = token.lower().replace("’", "'").replace("‘", "'").replace("‛", "'")
    if len(word) <= 2:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    word = word[1:] if word.startswith("'") else word
    word = re.sub(r"(^|(?<=[aeiouy]))y", "Y", word)
    r1, r2 = _regions(word)
    word = re.sub(r"('s'|'s|')$", "", word)
    word = _plural(word)
    if word in FINISHED:
        return word
    word = _participle(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    word = _derived(word, r1, r2)
    if word.endswith("e"):
        at = len(word) - 1
        if at >= r2 or (at >= r1 and not SHORT_END.search(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.replace("Y", "y")


@F.pandas_udf(T.StringType())
def stem(tokens: pd.Series) -> pd.Series:
    return tokens.map(stem_word)
