"""Text features over documents, diagnosis descriptions and headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.functions import text
from claimflow.operators import vocabulary as vocab
from claimflow.operators.projection import quoted
from claimflow.plans import entities, headers
from queries import sqltext as q
from queries.registry import query
from queries.views import DUCK, SPARK, table, view

ID = "Claim Identifier"
STOPWORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on",
    "with", "be", "by", "as", "this", "are", "at", "from", "not", "other", "both",
]
_stop = q.members(STOPWORDS).replace("(", "[", 1)[:-1] + "]"
SPACE = text.WHITE_SPACE
STRIPPED = f"regexp_replace(lower(text), '{text.PUNCTUATION}', '', 'g')"
DOC_WORDS = f"list_filter(string_split_regex({STRIPPED}, '{SPACE}'), lambda w: w <> '')"


def document_words():
    return text.words(text.strip_punctuation(F.lower("text")))


@query("F1", f"""SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda w: NOT list_contains({_stop}, w)), ' ') AS cleaned FROM documents""")
def stopword_removal(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.remove_stopwords(F.col("text"), STOPWORDS).alias("cleaned")
    )


@query("F2", f"""SELECT doc_id, regexp_replace(text, '{text.PUNCTUATION}', '', 'g') AS stripped FROM documents""")
def punctuation_strip(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.strip_punctuation(F.col("text")).alias("stripped"))


# Words and their stems by the published description.
STEMS = {
    "small": "small", "ring": "ring", "red": "red", "widget": "widget",
    "blue": "blue", "bolt": "bolt", "hot": "hot", "plate": "plate",
    "cold": "cold", "gear": "gear", "new": "new", "anvil": "anvil",
    "old": "old", "gizmo": "gizmo", "large": "larg", "rod": "rod",
    "ECONOMY": "economi", "STANDARD": "standard", "MEDIUM": "medium",
    "PROMO": "promo", "SMALL": "small", "LARGE": "larg",
    "consigned": "consign", "consistency": "consist",
    "knackeries": "knackeri", "knightly": "knight",
    "generously": "generous", "hopping": "hop", "hoped": "hope",
    "happily": "happili", "relational": "relat", "conditional": "condit",
    "hopefulness": "hope", "digitizer": "digit", "radically": "radic",
    "skis": "ski", "dying": "die", "news": "news", "cries": "cri",
    "ties": "tie", "adjustable": "adjust", "fractures": "fractur",
    "diseases": "diseas", "intervertebral": "intervertebr",
}
STEM_SAMPLES = list(STEMS)[22:]


def _phrase(d) -> str:
    first, second = d.pick(STEM_SAMPLES, "p_partkey"), d.pick(STEM_SAMPLES, "p_partkey * 7 + 3")
    return f"concat(p_name, ' ', p_type, ' ', {first}, ' ', {second})"


_pairs = ", ".join(f"({q.lit(k)}, {q.lit(v)})" for k, v in STEMS.items())


@query("F3", f"""WITH stems(word, stem) AS (VALUES {_pairs}),
 words AS (SELECT p_partkey, i, string_split(phrase, ' ')[i] AS word
   FROM (SELECT p_partkey, {_phrase(DUCK)} AS phrase FROM part), range(1, 6) r(i) WHERE i <= len(string_split(phrase, ' ')))
 SELECT p_partkey, string_agg(stem, ' ' ORDER BY i) AS stemmed FROM words JOIN stems USING (word) GROUP BY p_partkey""")
def stemmed_names(spark, sf):
    named = table(spark, sf, "part").selectExpr("p_partkey", f"{_phrase(SPARK)} AS phrase")
    return vocab.stem_text(named, "p_partkey", "phrase", "stemmed")


@query("F3")
def stemmed_documents(spark, sf):
    """Whole texts; the stems of real words have no SQL form."""
    cleaned = table(spark, sf, "documents").select("doc_id", text.strip_punctuation(F.col("text")).alias("text"))
    return vocab.stem_text(cleaned, "doc_id", "text", "stemmed")


@query("F4", f"""WITH tokens AS (SELECT doc_id, unnest({DOC_WORDS}) AS term FROM documents),
 counts AS (SELECT doc_id, term, count(*) AS n FROM tokens GROUP BY ALL),
 idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + count(*))) + 1 AS w
   FROM counts GROUP BY term),
 raw AS (SELECT doc_id, term, n * w AS x FROM counts JOIN idf USING (term))
 SELECT doc_id, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""")
def tfidf_weights(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", document_words().alias("words"))
    tfidf = vocab.TfIdf().fit(documents, "doc_id", F.col("words"))
    weights = tfidf.transform(documents, "doc_id", F.col("words"))
    return weights.withColumn("weight", F.round("weight", 6))


_desc = q.SETTLEMENT_MAPPED["description"]


def _flag_sql(flags: dict[str, str]) -> str:
    listed = ",\n ".join(f"CAST({x} AS INT) AS {q.name(n)}" for n, x in flags.items())
    return q.with_views(["claims"], f"texts AS (SELECT {q.name(ID)}, {_desc} AS d FROM claims)", select=f"SELECT {q.name(ID)}, {listed} FROM texts")


def _phrase_sql(phrases: list[str], prefix: str) -> str:
    hits = {prefix + p: f"contains(d, {q.lit(p)})" for p in phrases}
    none = " OR ".join(hits.values())
    return _flag_sql({**hits, prefix + "others": f"NOT ({none})"})


@query("F5", _flag_sql({n: " OR ".join(f"contains(d, {q.lit(p)})" for p in parts) for n, parts in fixed.SETTLEMENT_KEYWORDS.items()}))
def keyword_flags(spark, sf):
    lowered = view(spark, sf, "claims").withColumn("d", text.lowered(quoted("Primary Diagnosis Desc")))
    flags = text.keyword_flags(F.col("d"), fixed.SETTLEMENT_KEYWORDS)
    return lowered.select(quoted(ID), *[c.alias(n) for n, c in flags.items()])


def phrase_flags(spark, sf, phrases, prefix):
    lowered = view(spark, sf, "claims").select(quoted(ID), text.lowered(quoted("Primary Diagnosis Desc")).alias("d"))
    return lowered.select(quoted(ID), *[c.alias(n) for n, c in text.phrase_flags(F.col("d"), phrases, prefix).items()])


@query("F6", _phrase_sql(fixed.SETTLEMENT_CONDITIONS, fixed.CONDITION_PREFIX))
def condition_phrases(spark, sf):
    return phrase_flags(spark, sf, fixed.SETTLEMENT_CONDITIONS, fixed.CONDITION_PREFIX)


@query("F7", _phrase_sql(fixed.SETTLEMENT_ORGANS, fixed.ORGAN_PREFIX))
def organ_phrases(spark, sf):
    return phrase_flags(spark, sf, fixed.SETTLEMENT_ORGANS, fixed.ORGAN_PREFIX)


def _normal_sql(c: str) -> str:
    caps = f"regexp_replace({c}, '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')"
    camel = f"regexp_replace({caps}, '([a-z\\d])([A-Z])', '\\1_\\2', 'g')"
    snake = f"lower(replace({camel}, '-', '_'))"
    phrase = f"replace(regexp_replace({snake}, '_id$', ''), '_', ' ')"
    return f"concat(upper(substr({phrase}, 1, 1)), substr({phrase}, 2))"


@query("F8", q.with_views(["headers"], select=f"""SELECT event_id, {_normal_sql('column_name')} AS header FROM headers
 UNION ALL SELECT -1 - page_id, {_normal_sql('url')} FROM pages"""))
def normalised_headers(spark, sf):
    """Column headers, and page addresses as headers nobody foresaw."""
    ours = view(spark, sf, "headers").select("event_id", text.normalise_header(F.col("column_name")).alias("header"))
    odd = table(spark, sf, "pages").select((-1 - F.col("page_id")).alias("event_id"), text.normalise_header(F.col("url")).alias("header"))
    return ours.unionByName(odd)


TOKEN_IDS_SQL = f"""WITH listed AS (SELECT doc_id, {DOC_WORDS} AS words FROM documents),
 tokens AS (SELECT doc_id, i, words[i] AS token FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM listed)),
 counted AS (SELECT token, count(*) AS n FROM tokens GROUP BY token),
 vocabulary AS (SELECT token, 1 + row_number() OVER (ORDER BY n DESC, token) AS id FROM counted)
 SELECT l.doc_id, coalesce(string_agg(CAST(CASE WHEN t.token IS NOT NULL THEN coalesce(v.id, 1) END AS VARCHAR), ' ' ORDER BY t.i), '') AS ids
 FROM listed l LEFT JOIN tokens t ON l.doc_id = t.doc_id LEFT JOIN vocabulary v ON t.token = v.token GROUP BY l.doc_id"""


def numbered_words(spark, sf, **how):
    cleaned = lambda w: text.strip_punctuation(F.lower(w))
    coded = vocab.coded_texts(table(spark, sf, "documents"), "doc_id", F.col("text"), cleaned)
    ids = vocab.coded_ids(coded, "doc_id", vocab.ranked_words(vocab.coded_totals(coded)), **how)
    return ids.select("doc_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"))


@query("F9", TOKEN_IDS_SQL)
def document_token_ids(spark, sf):
    return numbered_words(spark, sf)


@query("F9", TOKEN_IDS_SQL)
def joined_token_ids(spark, sf):
    """The same with a vocabulary that is joined, as a very large one is."""
    return numbered_words(spark, sf, held=0)


_header_words = f"regexp_extract_all(lower({_normal_sql('column_name')}), '[\\p{{L}}\\p{{N}}]+')"


@query("F10", q.with_views(["headers"], f"""listed AS (SELECT event_id, column_name, {_header_words} AS words FROM headers),
 tokens AS (SELECT event_id, i, words[i] AS token FROM (SELECT event_id, words, unnest(range(1, len(words) + 1)) AS i FROM listed)),
 counted AS (SELECT token, count(*) AS n FROM tokens GROUP BY token),
 vocabulary AS (SELECT token, 1 + row_number() OVER (ORDER BY n DESC, token) AS id FROM counted),
 ids AS (SELECT event_id, list(coalesce(v.id, 1) ORDER BY i) AS ids FROM tokens LEFT JOIN vocabulary v USING (token) GROUP BY event_id)""",
 select="""SELECT event_id, array_to_string(CASE WHEN len(ids) > 16 THEN ids[1:16]
   ELSE list_concat(list_transform(range(0, 16 - len(ids)), lambda z: 0::BIGINT), ids) END, ' ') AS ids FROM ids"""))
def padded_ids(spark, sf):
    named = view(spark, sf, "headers").select("event_id", "column_name")
    vocabulary = vocab.build_vocabulary(named, headers.header_words(F.col("column_name")))
    encoded = headers.encode_headers(named, vocabulary)
    return encoded.select("event_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"))


GAZETTEER = [
    ("the", "SYSTEM_ORGAN_SITE"), ("of the", "DX_NAME"), ("in", "DIRECTION"),
    ("in the", "ACUITY"), ("is that", "PROCEDURE_NAME"), ("that", "TEST_NAME"),
    ("and", "BRAND_NAME"), ("with a", "GENERIC_NAME"), ("it is", "NAME"),
    ("is", "DX_NAME"), ("for the", "TREATMENT_NAME"), ("to the", "DIRECTION"),
    ("de", "NAME"), ("of the and", "ACUITY"), ("is, the", "TEST_NAME"),
    ("the in the", "PROCEDURE_NAME"), ("the of and to", "DX_NAME"),
    ("the of the and in", "NAME"), ("the of and to in of the", "ACUITY"), ("y de la", "NAME"),
]


def _entity_sql() -> str:
    # at each word the alternatives are tried in order: phrases by length, then any
    # word, so that the next match starts at a word again
    apart, letter = r"[^\p{L}\p{N}]+", r"[\p{L}\p{N}]+"
    words = {p: p.replace(",", "").split() for p, _ in GAZETTEER}
    by_length = sorted(words.values(), key=lambda w: -len(w))
    pattern = "(?i)" + "|".join(f"{apart.join(w)}(?:[^\\p{{L}}\\p{{N}}]|$)".replace("\\\\", "\\") for w in by_length) + "|" + letter
    lists = []
    for label, output in fixed.ENTITY_LISTS.items():
        own = [" ".join(words[p]) for p, x in GAZETTEER if x == label]
        plain = f"trim(lower(regexp_replace(m, '{apart}', ' ', 'g')))"
        hits = f"list_filter(found, lambda m: {plain} IN {q.members(own)})"
        cut = f"list_transform({hits}, lambda m: regexp_replace(m, '[^\\p{{L}}\\p{{N}}]$', ''))".replace("\\\\", "\\")
        lists.append(f"array_to_string({cut}, '|') AS {output}")
    return f"""WITH scanned AS (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS found FROM documents)
 SELECT doc_id, {", ".join(lists)} FROM scanned"""


def listed_entities(spark, sf, **how):
    gazetteer = spark.createDataFrame(GAZETTEER, "phrase string, label string")
    found = entities.entity_envelopes(table(spark, sf, "documents"), "doc_id", "text", gazetteer, **how)
    return found.select(
        F.col("entityId").alias("doc_id"),
        *[F.array_join(f"predictedResult.{n}", "|").alias(n) for n in fixed.ENTITY_LISTS.values()],
    )


@query("F11", _entity_sql())
def entity_lists(spark, sf):
    return listed_entities(spark, sf)


@query("F11", _entity_sql())
def joined_entity_lists(spark, sf):
    """The same with a gazetteer that is joined, as a very large one is."""
    return listed_entities(spark, sf, held=0)
