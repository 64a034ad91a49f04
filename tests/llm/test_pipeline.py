"""The corpus pipeline, stage by stage."""

import re

import xxhash

import corpus_pipeline
from claimflow.llm import common, langid, mixing
from tests.llm.data import documents

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    docs = common.read(spark, SF, "documents").cache()
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        kept[name] = docs
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in kept.items()}
    assert ids["language_id"] == ids["documents"]
    assert ids["source_mix"] <= ids["decontamination"] < ids["near_dedup"] < ids["language_id"]
    assert kept["sharding"].count() == kept["source_mix"].count()
    for name in ("language_id", "near_dedup", "decontamination", "source_mix"):
        assert kept[name].columns == kept["documents"].columns
    assert kept["sharding"].columns == [*kept["documents"].columns, "slot", "shard"]
    words = kept["decontamination"].select(mixing.word_count(kept["decontamination"]["text"]).alias("n")).toPandas()["n"].sum()
    mixed = kept["source_mix"].select(mixing.word_count(kept["source_mix"]["text"]).alias("n")).toPandas()["n"].sum()
    assert abs(mixed - 1.5 * words) < 20


def test_odd_and_empty_documents(spark, tmp_path):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert docs.columns == documents(spark).columns
    assert {r["doc_id"] for r in docs.select("doc_id").collect()}.isdisjoint({2, 3, 4, 7})
    empty = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_fingerprint(text):
    found = SPACED.findall(lowered(text))
    shingles = [found[i : i + 4] for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def one_of_each_group(rows):
    """Ids of the first document of each group, by comparing all pairs."""
    ids, prints = zip(*sorted((r["doc_id"], plain_fingerprint(r["text"])) for r in rows), strict=True)
    group = list(range(len(ids)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((top(i), top(j)))
                group[b] = a
    return {ids[i] for i in range(len(ids)) if top(i) == i}


def contaminated(text, windows):
    words, hit = PLAIN.findall(lowered(text)), set()
    for n in {len(w) for w in windows}:
        for at in range(len(words) - n + 1):
            if tuple(words[at : at + n]) in windows:
                hit.update(range(at, at + n))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_stages_against_plain_python(spark):
    """What the first three stages keep, from each stage's whole input, by loops over all of it."""
    docs = common.read(spark, SF, "documents").cache()
    stages = dict(corpus_pipeline.STAGES)

    model = langid.fit_on_folds(docs)
    one_by_one = {r["doc_id"] for r in docs.collect() if not langid.predict(model, [r["text"]])["rejected"][0]}
    known = stages["language_id"](spark, docs, SF).cache()
    assert {r["doc_id"] for r in known.collect()} == one_by_one

    distinct = stages["near_dedup"](spark, known, SF).cache()
    kept = distinct.collect()
    assert {r["doc_id"] for r in kept} == one_of_each_group(known.collect()) and len(kept) < known.count()

    windows = set()
    for item in common.read(spark, SF, "benchmark").collect():
        words = PLAIN.findall(lowered(item["text"]))
        windows.update(tuple(words[i : i + 13]) for i in range(max(1, len(words) - 12)) if words)
    clean = stages["decontamination"](spark, distinct, SF).collect()
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in kept if not contaminated(r["text"], windows)}
    assert len(clean) < len(kept)


def test_mix_takes_runs_of_words(spark):
    """Every text of the mix is a run of its document's words; none is taken more than twice over."""
    docs = common.read(spark, SF, "documents").cache()
    given = {r["doc_id"]: SPACED.findall(r["text"] or "") for r in docs.collect()}
    taken = dict.fromkeys(given, 0)
    for r in dict(corpus_pipeline.STAGES)["source_mix"](spark, docs, SF).collect():
        run = SPACED.findall(r["text"])
        taken[r["doc_id"]] += len(run)
        assert f" {' '.join(run)} " in f" {' '.join(given[r['doc_id']])} "
    assert all(n <= 2 * len(given[i]) for i, n in taken.items())
