"""Sources, projections, cleaning, durations, categories and completeness."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.functions import categories, cleaning, tenure
from claimflow.operators import encode, projection
from claimflow.operators.complete import flag_incomplete
from claimflow.operators.projection import quoted
from claimflow.plans import annuity, bridging, claims
from claimflow.session import shared_dir
from claimflow.sources import readers, sinks
from queries import sqltext as q
from queries.registry import query
from queries.views import HEADER_NAMES, SNAPSHOT_TIEBREAK, table, view

ID = "Claim Identifier"
CLAIMS = ["claims"]


def text_of(c):
    """A timestamp as text, so that both engines show it alike."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def r6(c):
    return F.round(c, 6)


# --- sources ---------------------------------------------------------------


@query("A1", "SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem")
def claim_source(spark, sf):
    return readers.read_claims(
        spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"]
    )


@query("A2", "SELECT event_id, user_id, event_type, value FROM events")
def batch_source(spark, sf):
    return readers.read_batch(spark, f"{sf}/events.parquet", ["event_id", "user_id", "event_type", "value"])


@query(
    "A2",
    """SELECT vec_id, CAST(i - 1 AS BIGINT) AS index, CAST(embedding[i] AS DOUBLE) AS value,
       CAST(i - 1 AS BIGINT) * vec_id AS product
       FROM embeddings, range(1, 65) r(i)""",
)
def column_maps_to_rows(spark, sf):
    """Batches given as one map per column, here one batch per vector."""
    vectors = table(spark, sf, "embeddings")
    index = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: i.cast("string"))
    maps = vectors.select(
        F.map_from_arrays(index, F.transform("embedding", lambda x: x.cast("double"))).alias("value"),
        F.map_from_arrays(index, F.transform(index, lambda i: i.cast("long") * F.col("vec_id"))).alias("product"),
        F.map_from_arrays(index, F.array_repeat(F.col("vec_id"), F.size("embedding"))).alias("vec_id"),
    )
    return readers.rows_from_columns(maps, ["vec_id", "value", "product"])


@query(
    "A2",
    """SELECT o_orderkey // 100000 AS batch, (o_orderkey % 100000)::BIGINT AS index, o_orderkey, o_totalprice,
       o_orderstatus || ', "' || o_orderpriority || '" {' AS note, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS o_custkey
       FROM orders""",
)
def column_map_files(spark, sf):
    """All orders written as JSON objects of columns, one file a batch, and read back from pieces of files."""
    path = f"{shared_dir(spark)}/column_maps/{uuid.uuid4().hex}"
    columns = ["o_orderkey", "o_totalprice", "note", "o_custkey"]
    note = F.concat("o_orderstatus", F.lit(', "'), "o_orderpriority", F.lit('" {'))
    orders = table(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / 100_000).alias("batch"), (F.col("o_orderkey") % 100_000).alias("row"),
        "o_orderkey", "o_totalprice", note.alias("note"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("o_custkey"),
    )
    # a row that lacks a column's value has no entry there, or a null
    values = [F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}) for c in columns]
    entries = [
        F.struct(F.lit(i).alias("column"), F.lit(c).alias("name"), F.substr(v, F.lit(6), F.length(v) - 6).alias("value"))
        for i, (c, v) in enumerate(zip(columns, values, strict=True))
    ]
    cells = orders.select("batch", "row", F.inline(F.array(*entries)))
    cells = cells.filter("name <> 'o_custkey' OR row % 2 = 0 OR value <> 'null'")
    order = Window.partitionBy("batch").orderBy("column", "row")
    first, last = F.row_number().over(order) == 1, F.lead("row").over(order).isNull()
    new = F.coalesce(F.lag("column").over(order) != F.col("column"), F.lit(True))
    line = F.concat(
        F.when(first, "{").when(new, "},").otherwise(","), F.when(new, F.concat(F.lit('"'), "name", F.lit('": {'))).otherwise(""),
        F.lit('"'), F.col("row").cast("string"), F.lit('": '), "value", F.when(last, "}}").otherwise(""),
    )
    lines = cells.select("batch", "column", "row", line.alias("line"))
    lines.repartition("batch").sortWithinPartitions("batch", "column", "row").select("batch", "line").write.partitionBy("batch").text(path)
    schema = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.lit("").alias("note"), "o_custkey").schema
    rows = readers.read_column_maps(spark, f"{path}/*/*.txt", schema)
    return rows.withColumn("batch", F.regexp_extract("batch", "batch=([0-9]+)/", 1).cast("long"))


HEADER_LISTS = """lists AS (SELECT page_id AS dataset_id, string_split(url, '/') AS columns FROM pages
  UNION ALL SELECT -1 - page_id, [] FROM pages WHERE page_id % 10 = 0)"""


def header_lists_of_pages(spark, sf):
    """The pieces of every page address serve as the header list of a file; there are empty files besides."""
    pages = table(spark, sf, "pages")
    lists = pages.select(F.col("page_id").alias("dataset_id"), F.split("url", "/").alias("columns"))
    empty = pages.filter("page_id % 10 = 0").select((-1 - F.col("page_id")).alias("dataset_id"), F.array().cast("array<string>").alias("columns"))
    return lists.unionByName(empty)


@query(
    "A3",
    f"""WITH {HEADER_LISTS}
    SELECT dataset_id, CAST(i - 1 AS INT) AS pos, columns[i] AS column_name
    FROM lists, range(1, 100) r(i) WHERE i <= len(columns)
    UNION ALL SELECT dataset_id, NULL, NULL FROM lists WHERE len(columns) = 0""",
)
def header_lists(spark, sf):
    return readers.explode_headers(header_lists_of_pages(spark, sf))


@query(
    "A4",
    f"""WITH {HEADER_LISTS}
    SELECT concat(dataset_id, ':0') AS source, dataset_id, CAST(len(columns) AS INT) AS n,
      array_to_string(columns, '|') AS headers FROM lists""",
)
def empty_lists(spark, sf):
    """A dataset without headers still gets its envelope, with an empty list."""
    exploded = readers.explode_headers(header_lists_of_pages(spark, sf))
    parts = sinks.envelope_batch(exploded, "dataset_id", "pos", ["column_name"], present=F.col("pos").isNotNull())
    names = F.transform("predictedResult", lambda r: r["column_name"])
    return parts.select(
        F.col("inputDataSource").alias("source"), F.col("entityId").alias("dataset_id"),
        F.size("predictedResult").alias("n"), F.array_join(names, "|").alias("headers"),
    )


PART_TEMPLATE = ["p_size", "p_type_PROMO", "p_type_SMALL", "p_type_NOT SEEN", "p_retailprice", "p_brand_Brand#2"]


@query(
    "A5",
    """SELECT p_partkey, p_size, CAST(p_type = 'PROMO' AS INT) AS "p_type_PROMO",
    CAST(p_type = 'SMALL' AS INT) AS "p_type_SMALL", 0 AS "p_type_NOT SEEN", p_retailprice,
    CAST(p_brand = 'Brand#2' AS INT) AS "p_brand_Brand#2" FROM part""",
)
def feature_template(spark, sf):
    """Layout taken from the header line of a CSV file in the shared folder."""
    path = f"{shared_dir(spark)}/templates/part"
    row = spark.createDataFrame([tuple("0" for _ in PART_TEMPLATE)], PART_TEMPLATE)
    row.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    template = readers.load_template(spark, path)
    return encode.align(table(spark, sf, "part"), template, ["p_type", "p_brand"], carry=["p_partkey"])


@query(
    "A6",
    """SELECT concat('artifact_', page_id % 7) AS data_name, arg_max(url, page_id) AS data_value
    FROM pages GROUP BY 1""",
)
def last_artifact(spark, sf):
    name = F.concat(F.lit("artifact_"), (F.col("page_id") % 7).cast("string"))
    manifest = table(spark, sf, "pages").select(
        name.alias("data_name"), F.col("url").alias("data_value"), F.col("page_id").alias("pos")
    )
    return readers.resolve_artifacts(manifest)


@query(
    "A7",
    """SELECT page_id, string_split(url, '/')[3] AS bucket,
    substr(url, len(string_split(url, '/')[1]) + len(string_split(url, '/')[3]) + 4) AS key FROM pages""",
)
def uri_parts(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", cleaning.uri_bucket("url").alias("bucket"), cleaning.uri_key("url").alias("key")
    )


@query(
    "A8",
    """SELECT CAST(json_object('c_custkey', c_custkey, 'c_name', CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END,
    'c_nationkey', CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END) AS VARCHAR) AS record FROM customer""",
)
def json_records(spark, sf):
    gaps = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"),
    )
    return sinks.to_json_records(gaps)


@query(
    "A9",
    """SELECT concat(o_orderkey, ':0') AS source, o_orderkey AS entity, o_totalprice AS probability,
    o_orderstatus AS label, 1 AS listed FROM orders""",
)
def claim_envelope(spark, sf):
    orders = table(spark, sf, "orders")
    bare = sinks.envelope(orders, "o_orderkey", ["o_totalprice", "o_orderstatus"])
    listed = sinks.envelope(orders, "o_orderkey", ["o_totalprice", "o_orderstatus"], as_list=True)
    listed = listed.select("entityId", F.col("predictedResult").alias("listed"))
    both = bare.join(listed, "entityId")
    return both.select(
        F.col("inputDataSource").alias("source"), F.col("entityId").alias("entity"),
        F.col("predictedResult.o_totalprice").alias("probability"),
        F.col("predictedResult.o_orderstatus").alias("label"), F.size("listed").alias("listed"),
    )


@query(
    "A10",
    """SELECT concat(event_type, ':0') AS source, event_type AS entity, (place - 1) // 1000 AS part,
    CAST(count(*) AS INT) AS n, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY event_id) AS users
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events) GROUP BY ALL""",
)
def batch_envelope(spark, sf):
    parts = sinks.envelope_batch(
        table(spark, sf, "events"), "event_type", "event_id", ["user_id"], part_rows=1000
    )
    users = F.transform("predictedResult", lambda r: r["user_id"].cast("string"))
    return parts.select(
        F.col("inputDataSource").alias("source"), F.col("entityId").alias("entity"), "part",
        F.size("predictedResult").alias("n"), F.array_join(users, ",").alias("users"),
    )


# --- projection ------------------------------------------------------------


@query("B1", q.with_views(CLAIMS, select=f"SELECT {', '.join(map(q.name, fixed.LTD_COLUMNS))} FROM claims"))
def required_columns(spark, sf):
    return projection.require(view(spark, sf, "claims"), fixed.LTD_COLUMNS)


@query("B2", q.with_views(["snapshots"], q.BRIDGING_ROWS, select="""SELECT "ClaimNumber", l_linenumber, l_partkey,
 l_suppkey, "ClaimStatusDescription", "ClaimStatusCode" FROM eligible_rows"""))
def eligible_status(spark, sf):
    rows = projection.eligible(
        view(spark, sf, "snapshots"), "ClaimStatusDescription", "ClaimStatusCode",
        fixed.BRIDGING_ELIGIBLE, fixed.BRIDGING_REVIEW_STATUS, fixed.BRIDGING_CLOSED_CODE,
    )
    return rows.select(
        "ClaimNumber", "l_linenumber", "l_partkey", "l_suppkey", "ClaimStatusDescription", "ClaimStatusCode"
    )


@query("B3", q.with_views(["snapshots"], select=f"SELECT DISTINCT {', '.join(map(q.name, fixed.BRIDGING_COLUMNS))} FROM snapshots"))
def distinct_claims(spark, sf):
    return projection.distinct_rows(view(spark, sf, "snapshots"), fixed.BRIDGING_COLUMNS)


@query("B4", q.with_views(["snapshots"], q.BRIDGING_ROWS, q.FIRST_SNAPSHOT, select="""SELECT "ClaimNumber",
 strftime("DurationDate", '%Y-%m-%d %H:%M:%S') AS first_duration_date FROM first_rows WHERE "BenefitCaseType" = 'STD'"""))
def first_is_short_term(spark, sf):
    rows = bridging.eligible_rows(view(spark, sf, "snapshots"))
    found = bridging.short_term_snapshots(rows, SNAPSHOT_TIEBREAK)
    return found.select("ClaimNumber", text_of("first_duration_date").alias("first_duration_date"))


@query("B5", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def without_dates(spark, sf):
    return projection.drop_dates(table(spark, sf, "orders"))


@query("B6", q.with_views(CLAIMS, q.STD_FEATURES, select="SELECT * FROM std_features").replace("SELECT * FROM std_features", """SELECT * REPLACE (round(policy_tenure, 6) AS policy_tenure, round(days_to_report, 6) AS days_to_report,
 round(emp_tenure, 6) AS emp_tenure, round(prognosis_days, 6) AS prognosis_days) FROM std_features"""))
def helper_columns_dropped(spark, sf):
    """All short-term features; dates, zip code and month count are gone."""
    features = claims.std_features(view(spark, sf, "claims"))
    return features.withColumns(
        {c: r6(F.col(c)) for c in ("policy_tenure", "days_to_report", "emp_tenure", "prognosis_days")}
    )


@query("B7", 'SELECT o_orderkey AS "claimNumber", o_totalprice AS "predictedProbability", o_custkey AS "predictedValue" FROM orders')
def payload_names(spark, sf):
    return projection.payload(table(spark, sf, "orders"), "o_orderkey", "o_totalprice", "o_custkey")


@query("B8", 'SELECT event_id AS "TRXNUM", CAST(value >= 0.5056200992793571 AS INT) AS predicted_disposition FROM events')
def entity_beside_features(spark, sf):
    """The entity stays on its row all along; nothing is reattached by position."""
    scored = table(spark, sf, "events").withColumnRenamed("event_id", "TRXNUM")
    return annuity.disposition(scored, "value", fixed.APPLICATION_THRESHOLD)


# --- types and cleaning ----------------------------------------------------


@query("C1", q.with_views(CLAIMS, select=f"""SELECT {q.name(ID)}, {', '.join(f"strftime({q.ts(q.name(c))}, '%Y-%m-%d %H:%M:%S') AS {q.name(c)}" for c in fixed.LTD_DATES)} FROM claims"""))
def parsed_dates(spark, sf):
    return view(spark, sf, "claims").select(
        quoted(ID), *[text_of(cleaning.parse_timestamp(quoted(c))).alias(c) for c in fixed.LTD_DATES]
    )


@query("C2", q.with_views(CLAIMS, select=f"""SELECT {q.name(ID)}, {', '.join(f"{q.num(q.name(c))} AS {q.name(c)}" for c in fixed.LTD_NUMERIC)} FROM claims"""))
def parsed_numbers(spark, sf):
    return view(spark, sf, "claims").select(
        quoted(ID), *[cleaning.parse_number(quoted(c)).alias(c) for c in fixed.LTD_NUMERIC]
    )


@query("C3", 'SELECT l_orderkey, l_partkey, CAST(l_linenumber AS VARCHAR) AS line, CAST(l_suppkey AS VARCHAR) AS supplier FROM lineitem')
def categories_as_text(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_linenumber").cast("string").alias("line"),
        F.col("l_suppkey").cast("string").alias("supplier"),
    )


@query("C4", q.with_views(["annuities"], select=f"""SELECT "TRXNUM", {', '.join(f'CAST(coalesce({q.name(c)}, FALSE) AS INT) AS {q.name(c)}' for c in ("POLICYHDRDATA_ISGROUP_VALUE", "POLICYHDRDATA_QUALIFIED_VALUE"))} FROM annuities"""))
def flags(spark, sf):
    columns = ["POLICYHDRDATA_ISGROUP_VALUE", "POLICYHDRDATA_QUALIFIED_VALUE"]
    return view(spark, sf, "annuities").select(
        "TRXNUM", *[cleaning.as_flag(quoted(c)).cast("int").alias(c) for c in columns]
    )


@query("C6", q.with_views(CLAIMS, select=f"""SELECT {q.name(ID)}, {', '.join(f"{q.blank(q.name(c))} AS {q.name(c)}" for c in ("Primary Diagnosis Category", "Primary Diagnosis Desc", "SS Pri Award Amt", "TSA Ind"))} FROM claims"""))
def blank_to_null(spark, sf):
    columns = ["Primary Diagnosis Category", "Primary Diagnosis Desc", "SS Pri Award Amt", "TSA Ind"]
    return view(spark, sf, "claims").select(
        quoted(ID), *[cleaning.blank_to_null(quoted(c)).alias(c) for c in columns]
    )


@query("C7", q.with_views(["snapshots"], select=f'SELECT "ClaimNumber", l_partkey, {q.MIDPOINT} AS salary FROM snapshots'))
def salary_midpoint(spark, sf):
    return view(spark, sf, "snapshots").select(
        "ClaimNumber", "l_partkey", cleaning.range_midpoint("InsuredAnnualizedSalary").alias("salary")
    )


# Ways to spell a date, for Spark and for DuckDB.
SPELLINGS = [
    ("MM/dd/yyyy", "%m/%d/%Y"), ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"), ("yyyy/MM/dd", "%Y/%m/%d"),
    ("yyyyMMdd", "%Y%m%d"), ("dd-MMM-yyyy", "%d-%b-%Y"), ("MM/dd/yy", "%m/%d/%y"), ("MM-dd-yyyy", "%m-%d-%Y"),
    ("M/d/yyyy h:mm a", "%-m/%-d/%Y %-I:%M %p"), ("MMM d, yyyy", "%b %-d, %Y"), ("MMMM d, yyyy", "%B %-d, %Y"),
    ("d MMMM yyyy", "%-d %B %Y"), ("yyyy-MM-dd'T'HH:mm:ss'+05:00'", "%Y-%m-%dT%H:%M:%S+05:00"),
]


@query("C1", f"""SELECT o_orderkey, strftime(CASE WHEN o_orderkey % {len(SPELLINGS)} = {len(SPELLINGS) - 1}
   THEN CAST(o_orderdate AS TIMESTAMP) - INTERVAL 5 HOUR ELSE CAST(o_orderdate AS TIMESTAMP) END, '%Y-%m-%d %H:%M:%S') AS day FROM orders""")
def spelled_dates(spark, sf):
    """Order dates written in a dozen ways, read back; the last way is five hours east."""
    at = F.col("o_orderdate").cast("timestamp_ntz")
    spelled = F.coalesce(*[F.when(F.col("o_orderkey") % len(SPELLINGS) == i, F.date_format(at, s)) for i, (s, _) in enumerate(SPELLINGS)])
    return table(spark, sf, "orders").select(
        "o_orderkey", text_of(cleaning.parse_timestamp(spelled)).alias("day")
    )


@query("C8", q.with_views(["annuities"], select="""SELECT "TRXNUM", coalesce(regexp_extract("CONTRACTDATA_WRITINGCODE", '''([^'']*)''', 1), 'Unknown') AS code FROM annuities"""))
def first_of_list(spark, sf):
    return view(spark, sf, "annuities").select(
        "TRXNUM", cleaning.list_first("CONTRACTDATA_WRITINGCODE").alias("code")
    )


_filled = [c for c in fixed.APPLICATION_DEFAULTS if c not in ("uc2_employee_ratio", "uc8_employee_mean_change_days")]


@query("C9", q.with_views(["annuities"], select=f"""SELECT "TRXNUM", {', '.join(f'coalesce({q.name(c)}, {q.lit(fixed.APPLICATION_DEFAULTS[c])}) AS {q.name(c)}' for c in _filled)} FROM annuities"""))
def default_fill(spark, sf):
    filled = annuity.fill_defaults(view(spark, sf, "annuities"), fixed.APPLICATION_DEFAULTS)
    return filled.select("TRXNUM", *_filled)


# --- durations -------------------------------------------------------------


def dated(spark, sf):
    """Claims with parsed dates and month count."""
    raw = view(spark, sf, "claims")
    parsed = {c: cleaning.parse_timestamp(quoted(c)) for c in fixed.LTD_DATES}
    return raw.withColumns({**parsed, "Duration Months": cleaning.parse_number("Duration Months")})


def duration_sql(**columns: str) -> str:
    listed = ", ".join(f"round({x}, 6) AS {c}" for c, x in columns.items())
    return q.with_views(CLAIMS, select=f"SELECT {q.name(ID)}, {listed} FROM claims")


LOSS, RECEIVED, HIRED = "Loss Date", "Received Date", "Insured Hire Date"
EFFECTIVE, TERMINATED = "Policy Effective Date", "Policy Termination Date"
DURATION, MONTHS = "Duration Date", "Duration Months"
FIRST_PAID, LAST_PAID = "First Payment From Date", "Last Payment To Date"


@query("D1", duration_sql(days=q.EMP, months=f"{q.EMP} / (365.2425::DOUBLE / 12)", years=f"{q.EMP} / 365.2425::DOUBLE"))
def date_difference(spark, sf):
    units = {"days": "D", "months": "M", "years": "Y"}
    return dated(spark, sf).select(
        quoted(ID), *[r6(tenure.elapsed(quoted(HIRED), quoted(LOSS), u)).alias(n) for n, u in units.items()]
    )


@query("D2", duration_sql(positive=q.pos(q.EMP), signed=q.EMP))
def employment_tenure(spark, sf):
    return dated(spark, sf).select(
        quoted(ID), r6(tenure.emp_tenure(quoted(HIRED), quoted(LOSS))).alias("positive"),
        r6(tenure.emp_tenure(quoted(HIRED), quoted(LOSS), positive_only=False)).alias("signed"),
    )


@query("D3", duration_sql(positive=q.pos(q.POLICY), signed=q.POLICY))
def policy_tenure(spark, sf):
    return dated(spark, sf).select(
        quoted(ID), r6(tenure.policy_tenure(quoted(EFFECTIVE), quoted(TERMINATED), quoted(RECEIVED))).alias("positive"),
        r6(tenure.policy_tenure(quoted(EFFECTIVE), quoted(TERMINATED), quoted(RECEIVED), positive_only=False)).alias("signed"),
    )


@query("D4", duration_sql(zeroed=f"greatest({q.REPORT}, CASE WHEN {q.REPORT} IS NOT NULL THEN 0 END)", nulled=f"CASE WHEN {q.REPORT} >= 0 THEN {q.REPORT} END", kept=q.REPORT))
def days_to_report(spark, sf):
    how = {"zeroed": "zero", "nulled": "null", "kept": "keep"}
    return dated(spark, sf).select(
        quoted(ID), *[r6(tenure.days_to_report(quoted(LOSS), quoted(RECEIVED), h)).alias(n) for n, h in how.items()]
    )


@query("D5", duration_sql(prognosis=q.PROGNOSIS))
def prognosis(spark, sf):
    return dated(spark, sf).select(
        quoted(ID), r6(tenure.prognosis_days(quoted(LOSS), quoted(DURATION), quoted(MONTHS))).alias("prognosis")
    )


@query("D6", duration_sql(lag=f"CASE WHEN {q.LAG} >= 0 THEN {q.LAG} END"))
def payment_lag(spark, sf):
    return dated(spark, sf).select(quoted(ID), r6(tenure.payment_lag(quoted(FIRST_PAID), quoted(LAST_PAID))).alias("lag"))


@query("D7", duration_sql(first_payment=q.FIRST_PAY))
def first_payment(spark, sf):
    return dated(spark, sf).select(
        quoted(ID), r6(tenure.days_to_first_payment(quoted(LOSS), quoted(FIRST_PAID))).alias("first_payment")
    )


@query("D8", q.with_views(["snapshots"], q.BRIDGING_FEATURES, select="""SELECT "ClaimNumber", "CaseSize", "PrimaryDiagnosisDecription",
 round(initial_prognosis_days, 6) AS initial_prognosis_days FROM bridging_features"""))
def initial_prognosis(spark, sf):
    features = bridging.bridging_features(view(spark, sf, "snapshots"), SNAPSHOT_TIEBREAK)
    return features.select(
        "ClaimNumber", "CaseSize", "PrimaryDiagnosisDecription",
        r6(F.col("initial_prognosis_days")).alias("initial_prognosis_days"),
    )


def _lag_sql(c: str) -> str:
    gap = f"date_diff('day', CAST({q.ts(q.name(c))} AS DATE), CAST({q.RECEIVED} AS DATE))"
    return f"CAST(CASE WHEN {gap} >= 0 THEN {gap} ELSE -1 END AS INT) AS {q.name(c + 'diff')}"


_lagged = ["Loss Date", "Insured Hire Date", "Duration Date", "First Payment From Date"]


@query("D9", q.with_views(CLAIMS, select=f"SELECT {q.name(ID)}, {', '.join(map(_lag_sql, _lagged))} FROM claims"))
def event_lags(spark, sf):
    lagged = annuity.lag_features(view(spark, sf, "claims"), "Received Date", _lagged)
    return lagged.select(quoted(ID), *[quoted(f"{c}diff") for c in _lagged])


# --- categories ------------------------------------------------------------


def category_sql(**columns: str) -> str:
    listed = ", ".join(f"{x} AS {c}" for c, x in columns.items())
    return q.with_views(CLAIMS, select=f"SELECT {q.name(ID)}, {listed} FROM claims")


@query("E1", category_sql(division='substr("SIC Code", 1, 2)'))
def sic_division(spark, sf):
    return view(spark, sf, "claims").select(
        quoted(ID), categories.sic_division(quoted("SIC Code")).alias("division")
    )


_code = '"Primary Diagnosis Code"'


@query("E2", category_sql(b1=q.code_part(_code, 0, "na.na"), b2=q.code_part(_code, 1, "na.na"), s1=q.code_part(_code, 0, "_na"), s2=q.code_part(_code, 1, "_na")))
def diagnosis_code_parts(spark, sf):
    code = quoted("Primary Diagnosis Code")
    return view(spark, sf, "claims").select(
        quoted(ID),
        *[categories.code_part(code, i, "na.na").alias(f"b{i + 1}") for i in (0, 1)],
        *[categories.code_part(code, i, "_na").alias(f"s{i + 1}") for i in (0, 1)],
    )


@query("E3", category_sql(grp=q.STD_GROUP))
def std_diagnosis_group(spark, sf):
    grouped = view(spark, sf, "claims").withColumns(claims.std_groups())
    return grouped.select(quoted(ID), quoted("Primary Diagnosis Category").alias("grp"))


@query("E4", category_sql(grp=q.SETTLEMENT_GROUP))
def settlement_diagnosis_group(spark, sf):
    grouped = view(spark, sf, "claims").withColumns(claims.settlement_groups())
    return grouped.select(quoted(ID), quoted("Primary Diagnosis Category").alias("grp"))


@query("E5", category_sql(risk=q.STD_RISK))
def sic_risk(spark, sf):
    grouped = view(spark, sf, "claims").withColumns(claims.std_groups())
    return grouped.select(quoted(ID), F.col("SIC_risk_ind").alias("risk"))


@query("E6", category_sql(std=q.STD_COVERAGE, settlement=q.collapse_listed('"Coverage Code"', fixed.SETTLEMENT_COVERAGE_MERGED, "LTDVOL")))
def coverage_group(spark, sf):
    raw = view(spark, sf, "claims")
    return raw.select(
        quoted(ID), claims.std_groups()["Coverage Code"].alias("std"),
        claims.settlement_groups()["Coverage Code"].alias("settlement"),
    )


@query("E7", category_sql(salary=q.SALARY_WORDS, pre_ex=q.PRE_EX, pursue='"SS Pursue Ind"'))
def value_remap(spark, sf):
    return view(spark, sf, "claims").select(
        quoted(ID),
        categories.remap(quoted("Insured Salary Ind"), fixed.LTD_SALARY_FREQUENCY).alias("salary"),
        categories.remap(quoted("Pre-Ex Outcome"), fixed.LTD_PRE_EXISTING).alias("pre_ex"),
        quoted("SS Pursue Ind").alias("pursue"),
    )


@query("E8", category_sql(division=q.SETTLEMENT_MAPPED["SIC Category"], status=q.SETTLEMENT_MAPPED["SS Pri Status"], salary=q.collapse_listed('"Insured Salary Ind"', fixed.SETTLEMENT_SALARY_DROPPED, "others")))
def collapsed_categories(spark, sf):
    g = claims.settlement_groups()
    return view(spark, sf, "claims").select(
        quoted(ID), g["SIC Category"].alias("division"), g["SS Pri Status"].alias("status"),
        g["Insured Salary Ind"].alias("salary"),
    )


@query("E9", category_sql(award=q.AWARD_BIN))
def award_bins(spark, sf):
    return view(spark, sf, "claims").select(
        quoted(ID), claims.settlement_groups()["SS Pri Award Amt"].alias("award")
    )


@query("E10", category_sql(tier1=q.SETTLEMENT_MAPPED["pd_1_cat"], tier2=q.SETTLEMENT_MAPPED["pd_2_cat"]))
def diagnosis_risk_tiers(spark, sf):
    g = claims.settlement_groups()
    return view(spark, sf, "claims").select(quoted(ID), g["pd_1_cat"].alias("tier1"), g["pd_2_cat"].alias("tier2"))


def _login_sql() -> str:
    def levels(prefix: str, logins: list[str]) -> list[str]:
        return [
            f"CAST(coalesce(contains(\"V_SYSTEM_LOGON_ID\", {q.lit(x)}), FALSE) AS INT) AS {prefix}{i}"
            for i, x in enumerate(logins, 1)
        ]

    web = f"CAST(coalesce(contains(\"V_SYSTEM_LOGON_ID\", {q.lit(fixed.WEB_LOGIN)}), FALSE) AS INT) AS webservices"
    listed = [web, *levels("appn", fixed.APPLICATION_LOGINS), *levels("txn", fixed.TRANSACTION_LOGINS)]
    return q.with_views(["logins"], select=f"SELECT event_id, {', '.join(listed)} FROM logins")


@query("E12", _login_sql())
def login_flags(spark, sf):
    who = F.col("V_SYSTEM_LOGON_ID")
    sets = {"appn": fixed.APPLICATION_LOGINS, "txn": fixed.TRANSACTION_LOGINS}
    return view(spark, sf, "logins").select(
        "event_id", categories.mentions(who, fixed.WEB_LOGIN).alias("webservices"),
        *[categories.mentions(who, x).alias(f"{p}{i}") for p, xs in sets.items() for i, x in enumerate(xs, 1)],
    )


@query("E13", q.with_views(["logins"], select="""SELECT event_id, CAST(len(string_split(coalesce("V_SYSTEM_LOGON_ID", 'None'), ',')) AS INT) AS n FROM logins"""))
def login_count(spark, sf):
    return view(spark, sf, "logins").select("event_id", cleaning.list_length("V_SYSTEM_LOGON_ID").alias("n"))


# --- completeness ----------------------------------------------------------


@query("I1", q.with_views(CLAIMS, q.STD_FEATURES, q.LTD_FEATURES, q.SETTLEMENT_RAW, select="""
 SELECT 'std' AS model, "Claim Identifier", "NA_row" FROM std_features
 UNION ALL SELECT 'ltd', "Claim Identifier", "NA_row" FROM ltd_features
 UNION ALL SELECT 'settlement', "Claim Identifier", "NA_row" FROM settlement_flagged"""))
def incomplete_rows(spark, sf):
    raw = view(spark, sf, "claims")
    flagged = {
        "std": claims.std_features(raw),
        "ltd": claims.ltd_features(raw),
        "settlement": flag_incomplete(claims.settlement_durations(raw), fixed.SETTLEMENT_REQUIRED),
    }
    parts = [df.select(F.lit(m).alias("model"), quoted(ID), "NA_row") for m, df in flagged.items()]
    return parts[0].union(parts[1]).union(parts[2])
