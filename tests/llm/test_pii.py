"""Surrogates for personal data."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from claimflow.llm import pii
from tests.llm.data import documents

KEY = b"k"
TEXT = (
    "Mail bob.S@Mail8.example.com or BOB.s@mail8.example.com, call +1 (269) 555-3296 or 269-555-3296, "
    "card 4111 1111 1111 1111 / 4111111111111111, ip 42.144.35.254 not 1.2.3.999. Mr. John Smith met Mrs Anna Schmidt-Mayer; "
    "Smith left. IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789, password=b7db7aa4a5fcc78305 г-жа Анна Петрова."
)


def test_mentions():
    found = [(TEXT[s:e], k) for s, e, k in pii.mentions(TEXT)]
    assert found == [
        ("bob.S@Mail8.example.com", "email"),
        ("BOB.s@mail8.example.com", "email"),
        ("+1 (269) 555-3296", "phone"),
        ("269-555-3296", "phone"),
        ("4111 1111 1111 1111", "card"),
        ("4111111111111111", "card"),
        ("42.144.35.254", "ip"),
        ("John", "given_m"),
        ("Smith", "family"),
        ("Anna", "given_f"),
        ("Schmidt-Mayer", "family"),
        ("Smith", "family"),
        ("DE89 3704 0044 0532 0130 00", "iban"),
        ("123-45-6789", "ssn"),
        ("b7db7aa4a5fcc78305", "secret"),
        ("Анна", "given_f"),
        ("Петрова", "family"),
    ]


def shape(text):
    return re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "0", text))


def test_format_script_and_check_digits():
    for s, e, kind in pii.mentions(TEXT):
        mention = TEXT[s:e]
        new = pii.rendered(kind, mention, pii.surrogate(KEY, kind, pii.canonical(kind, mention)))
        assert new != mention
        if kind in ("phone", "card", "ssn", "iban", "email"):
            assert re.sub(r"[a0]+", "x", shape(new)) == re.sub(r"[a0]+", "x", shape(mention)) and len(new) == len(mention)
        if kind == "card":
            assert pii.luhn(pii.digits_of(new)) == 0 and new[0] == "4"
        if kind == "iban":
            assert pii.iban_rest(new.replace(" ", "")) == 1 and new[:2] == "DE"
        if kind == "family" and mention == "Петрова":
            assert re.fullmatch("[А-Я][а-я]+", new)
        if kind == "given_f":
            assert new[-1] in "aа"
        if kind == "secret":
            assert re.fullmatch("[0-9a-f]{18}", new)


def test_coreference_distinctness_and_rest_untouched(spark):
    rows = [(1, TEXT), (2, "again bob.s@mail8.example.com and 4111-1111-1111-1111"), (3, "nobody here")]
    rows += [(10 + i, f"a{i}@b.org and 10.0.{i // 256}.{i % 256} end") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.with_surrogates(docs, KEY).collect()}
    assert got[3]["text"] == "nobody here" and got[3]["n_replaced"] == 0
    assert got[1]["n_replaced"] == len(pii.mentions(TEXT))
    first, second = (re.findall(r"[\w.]+@[\w.]+\w", got[i]["text"]) for i in (1, 2))
    assert {m.lower() for m in first + second} == {second[0].lower()}
    cards = [pii.digits_of(x) for i in (1, 2) for x in re.findall(r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}", got[i]["text"])]
    assert len(set(cards[:2] + cards[-1:])) == 1
    mails = {got[10 + i]["text"].split()[0] for i in range(300)}
    assert len(mails) == 300 and not mails & {f"a{i}@b.org" for i in range(300)}
    assert len({m.split("@")[1] for m in mails}) == 1
    assert len({got[10 + i]["text"].split()[2] for i in range(300)}) == 300


def test_collisions_are_drawn_again(spark, monkeypatch):
    # a one-letter local part leaves few values, so nearly all draws collide at first
    values = [("email", f"{c}@x.org") for c in "abcdefghijklmnop"]
    entities = spark.createDataFrame(values, "kind string, value string")
    found = pii.distinct_surrogates(entities, KEY).collect()
    assert len(found) == len(values)
    new = {r["surrogate"] for r in found}
    assert len(new) == len(values) and not new & {v for _, v in values}
    assert max(r["attempt"] for r in found) > 0


def test_odd_documents(spark):
    docs = documents(spark, [(1, TEXT, "en", "s0"), (1, TEXT, "en", "s0"), (None, TEXT, None, None), (2, None, None, None), (3, "", "en", "s")])
    got = pii.with_surrogates(docs, KEY)
    assert got.columns == [c for c in docs.columns if c != "n_replaced"] + ["n_replaced"]
    assert got.groupBy("doc_id", "text").count().filter(F.col("doc_id") == 1).first()["count"] == 2
    assert {r["text"] for r in got.filter("doc_id = 2 OR doc_id = 3").collect()} == {None, ""}
    assert pii.with_surrogates(docs.limit(0), KEY).count() == 0


@pytest.mark.parametrize("text", ["", None, "12 34", "1.2.3", "a@b", "x@y.z1", "Mr. and Mrs."])
def test_nothing_to_find(text):
    assert pii.mentions(text) == []


def test_any_script_and_coreference(spark):
    texts = [
        "Dr. 王小明 met Frau דנה כהן and Mr أحمد علي", "Dr Anna Berg wrote. Frau Anna Berg signed. Later Anna called; Berg did not.",
        "Mr John Smith came. John said so.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.with_surrogates(docs, b"k").collect()}
    block = lambda s: {unicodedata.name(c).split()[0] for c in s if c.isalpha()}
    old, new = texts[0].split(), got[0].split()
    assert [block(w) for w in old] == [block(w) for w in new] and old[1] != new[1] and old[-1] != new[-1]
    first = re.fullmatch(r"Dr (\w+) (\w+) wrote. Frau (\w+) (\w+) signed. Later (\w+) called; (\w+) did not.", got[1]).groups()
    assert first[0] == first[2] == first[4] != "Anna" and first[1] == first[3] == first[5] != "Berg"
    john = re.fullmatch(r"Mr (\w+) \w+ came. (\w+) said so.", got[2]).groups()
    assert john[0] == john[1] != "John"


def test_domains_stay_distinct(spark):
    letters = "abcdefghij"
    hosts = [a + b for a in letters for b in letters]
    docs = spark.createDataFrame([(i, f"to x{i}@{h}.org and y@{h}.org") for i, h in enumerate(hosts)], "doc_id long, text string")
    got = pii.with_surrogates(docs, b"k").collect()
    moved = {}
    for r in got:
        new = re.findall(r"@(\w+\.org)", r["text"])
        assert len(new) == 2 and new[0] == new[1]
        moved[hosts[r["doc_id"]]] = new[0]
    assert len(set(moved.values())) == 100 and not set(moved.values()) & {f"{h}.org" for h in hosts}


def test_dense_formats_grow(spark):
    """All numbers of a format taken: surrogates grow instead of ending the job."""
    entities = [("ssn", f"{i:01d}") for i in range(10)] + [("ip", f"{i}.1.1.1") for i in range(30)]
    found = pii.distinct_surrogates(spark.createDataFrame(entities, "kind string, value string"), b"k").collect()
    made = [(r["kind"], r["surrogate"]) for r in found]
    assert len(set(made)) == 40 and not set(made) & set(entities)
    assert pii.rendered("phone", "(12) 345-678.", "9876543210") == "(98) 765-43210."
    assert pii.surrogate(b"k", "ip", "1.2.3.4", pii.GROW_AFTER).startswith("2001:db8:")


def test_numbers_that_are_no_cards():
    assert pii.mentions("at 1700000000000 ms, 9807915762804490") == []
    assert [k for _, _, k in pii.mentions("card 4111 1111 1111 1111")] == ["card"]
