"""Insurance records bound to the test tables, in Spark SQL and in DuckDB SQL.

The tables are clean, so the bindings put in NULLs, blanks, bad dates and other
dirt by arithmetic on keys. Every row of the bound table becomes one record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimflow import fixed_values as fixed
from claimflow.session import keep_compiled


#: Files that hold more than this are cut by the reader and left as they lie.
SMALL_BYTES = 64 << 20


def is_small(df: DataFrame, small: int = SMALL_BYTES) -> bool:
    """Whether a table read from files holds little, by the size of its files."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) <= small


def spread(df: DataFrame, small: int = SMALL_BYTES) -> DataFrame:
    """All cores on a small test table that comes in fewer files than there are cores.

    A larger one has more than one row group. Dealing it out would send all of it through
    a shuffle into as many tasks as there are cores, each larger the larger the table.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores or not is_small(df, small) else df.repartition(cores)


class Dialect:
    """The handful of expressions that the two SQL dialects spell differently."""

    def __init__(self, duck: bool):
        self.duck = duck

    def text(self, value: str | None) -> str:
        if value is None:
            return "NULL"
        return "'" + value.replace("'", "''" if self.duck else "\\'") + "'"

    def name(self, value: str) -> str:
        return f'"{value}"' if self.duck else f"`{value}`"

    def pick(self, values: list[str | None], index: str) -> str:
        items = ", ".join(self.text(v) for v in values)
        at = f"CAST(({index}) % {len(values)} AS INT)"
        return f"([{items}])[1 + {at}]" if self.duck else f"array({items})[{at}]"

    def shift(self, stamp: str, days: str, hours: str | None = None) -> str:
        if self.duck:
            late = f" + to_hours(CAST({hours} AS BIGINT))" if hours else ""
            return f"({stamp} + to_days(CAST({days} AS INT)){late})"
        moved = f"timestampadd(DAY, CAST({days} AS INT), {stamp})"
        return f"timestampadd(HOUR, CAST({hours} AS INT), {moved})" if hours else moved

    def us(self, stamp: str) -> str:
        return f"strftime({stamp}, '%m/%d/%Y')" if self.duck else f"date_format({stamp}, 'MM/dd/yyyy')"

    def iso(self, stamp: str) -> str:
        if self.duck:
            return f"strftime({stamp}, '%Y-%m-%d %H:%M:%S')"
        return f"date_format({stamp}, 'yyyy-MM-dd HH:mm:ss')"

    def string(self, x: str) -> str:
        return f"CAST({x} AS {'VARCHAR' if self.duck else 'STRING'})"

    def stamp(self, text: str) -> str:
        return f"{'TIMESTAMP' if self.duck else 'TIMESTAMP_NTZ'} '{text}'"

    def div(self, a: str, b: str) -> str:
        return f"({a}) // ({b})" if self.duck else f"({a}) div ({b})"


SPARK, DUCK = Dialect(False), Dialect(True)

DIAGNOSIS_CATEGORIES = [
    "Diseases of the musculoskeletal system & connectiv",
    "Injury, poisoning & certain other consequences of",
    "Mental, Behavioral & Neurodevelopmental disorders",
    "Diseases of the nervous system", "Diseases of the respiratory system",
    "Diseases of the skin & subcutaneous tissue",
    "Diseases of the blood & blood-forming organs",
    "Congenital malformations, deformations & chromosom",
    "Diseases of the circulatory system", "Diseases of the eye & adnexa",
    "Diseases of the ear & mastoid process", "Neoplasms", None, "", "  ",
    "ILL-DEFINED CONDITIONS",
]
DESCRIPTIONS = [
    "Other intervertebral disc displacement, lumbosacral region",
    "Unspecified fracture of unspecified calcaneus, initial encounter",
    "Unilateral primary osteoarthritis, right knee", "Low back pain",
    "Sprain of ligaments of the lumbar region and the pelvis",
    "Carpal tunnel syndrome, bilateral upper limbs",
    "Type 2 diabetes mellitus with proliferative diabetic retinopathy, right eye",
    "Crohn's disease of both small and large intestine",
    "Major depressive disorder, single episode",
    "Malignant neoplasm of endometrium",
    "Spondylosis with radiculopathy, cervical region", "Laceration of spleen",
    "Complete rotator cuff tear or rupture of the left shoulder",
    "Migraine without aura; not intractable",
    "Cerebrovascular disease and pain in the thorax", None, "", "   ",
    "Ankle joint pain after running", "ABNORMAL FINDINGS (2019) - follow_up",
]
DIAGNOSIS_CODES = [
    "S92.009A", "M51.27", "H35", "G43.109", "M54.5", "B20", "I67.82", None,
    "C54.1", "E11.3", "S52.5XXA", "Z51.14", "X99.9.1", "M06.9",
]
COVERAGES = ["STD", "STDCORE", "STDBU", "STD1", "STDVOL", "VS1", "VS2", "STDATP", None, "LTDBU", "LTDCORE", "LTDVOL"]
SICS = ["7371", "6321", "3841", "6371", "8999", "5311", None, "59"]
SALARY_INDS = ["A", "M", "W", "B", "H", "WEEKLY", "YEARLY", "Unknown", None, "BI-WEEKLY", "MONTHLY"]
AWARDS = [
    "-(0-250)", "-(500-750)", "-(1000-1250)", "-(1250-1500)", "-(1500-1750)",
    "-(2750-3000)", "-(3000-3250)", "-(3250-3500)", None, "", " ",
]


def _claim_fields(d: Dialect) -> dict[str, str]:
    ship, pk, sk, ln, ok, q = "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_orderkey", "l_quantity"
    loss = d.shift(ship, f"-(({pk} * 7 + {ln}) % 140 - 20)")

    def gap(key: str, n: int, value: str) -> str:
        return f"CASE WHEN {key} % {n} = 0 THEN NULL ELSE {value} END"

    return {
        "Claim Identifier": f"concat('CLM-', {d.string(ok)}, '-', {d.string(ln)}, '-', {d.string(pk)}, '-', {d.string(sk)})",
        "Received Date": d.us(ship),
        "Loss Date": f"CASE WHEN {pk} % 97 = 0 THEN 'not known' WHEN {pk} % 89 = 0 THEN NULL ELSE {d.us(loss)} END",
        "Insured Hire Date": d.iso(d.shift(ship, f"-(({sk} * 131 + {pk}) % 4000 - 200)", ln)),
        "Duration Date": f"CASE WHEN l_returnflag = 'N' THEN NULL ELSE {d.us(d.shift(ship, f'{q} - 30'))} END",
        "Duration Months": gap(pk, 41, f"concat(' ', {d.string(f'{ln} - 1')}, ' ')"),
        "Policy Effective Date": d.us(d.shift(ship, f"-({q} * 30 + {pk} % 400)")),
        "Policy Termination Date": f"CASE WHEN l_linestatus = 'O' THEN NULL ELSE {d.us(d.shift(ship, f'({ln} - 4) * 300 - {q} * 30'))} END",
        "First Payment From Date": gap(pk, 43, d.us(d.shift(ship, f"{ln} * 9 - 10"))),
        "Last Payment To Date": d.us(d.shift(ship, f"{q} * 3 - 20")),
        "Insured Age at Loss": gap(pk, 61, d.string(f"18 + {pk} % 60")),
        "Insured Annualized Salary": "l_extendedprice",
        "Policy Lives": gap(pk, 67, f"{sk} * 10 + 1"),
        "Insured Gender": d.pick(["M", "F", "M", "F", "M", "F", None], pk),
        "Insured Salary Ind": d.pick(SALARY_INDS, f"{pk} + {ln}"),
        "Insured Zip": d.string(f"10000 + {pk} % 80000"),
        "Insured State": d.pick(["CA", "IL", "TX", "NY", None], sk),
        "Primary Diagnosis Category": d.pick(DIAGNOSIS_CATEGORIES, f"{pk} + {sk}"),
        "Primary Diagnosis Code": d.pick(DIAGNOSIS_CODES, f"{sk} + {ln}"),
        "Primary Diagnosis Desc": d.pick(DESCRIPTIONS, f"{pk} + 3 * {ln}"),
        "SIC Code": f"CASE WHEN {pk} % 3 = 0 THEN {d.string(f'1000 + {pk} % 9000')} ELSE {d.pick(SICS, pk)} END",
        "SIC Category": d.pick(["Services", "Retail", None], pk),
        "Coverage Code": d.pick(COVERAGES, f"{ok} + {ln}"),
        "Claim Status Category": d.pick(["ACTIVE", "CLOSED"], ok),
        "Claim Status Code": d.pick(["Open", "Closed", None], ok),
        "Claim Cause Desc": d.pick(["OTHER ACCIDENT", "OTHER SICKNESS", None], sk),
        "Claim State": d.pick(["CA", "IL", "TX", None], ok),
        "DOT Exertion Level (Primary)": d.pick(["Light", "Medium", "Unknown", None], ok),
        "Eligibility Outcome": d.pick(["Approved", "Denied"], ok),
        "Mental Nervous Ind": d.pick(["Y", "N", None], pk),
        "Pre-Ex Outcome": d.pick(["YES", "NO", "Y", "N", None], f"{pk} + {ln}"),
        "Occ Category": d.pick(["Office", "Field", None], sk),
        "SS Adjustment Ind": d.pick(["Y", "N", "Y", "N", "N", None], f"{sk} + {ln}"),
        "SS Eligible Ind": d.pick(["Y", "N"], sk),
        "SS Pursue Ind": d.pick(["YES", "NO", "Yes", "No", None], pk),
        "SS Reject Code": d.pick([None, "R1"], pk),
        "SS Pri Status": d.pick(["Approved", "Appealed", "Pending", "Denied", "Unknown", "Not Applied", None], f"{pk} + {ln}"),
        "SS Pri Award Amt": d.pick(AWARDS, f"{pk} + 2 * {ln}"),
        "TSA Ind": d.pick(["N", "Y", "N", "N", " "], f"{sk} + {pk}"),
        "Voc Rehab Active Status": d.pick([None, "A"], ok),
        "Voc Rehab Outcome": d.pick([None, "O"], sk),
    }


def _snapshot_fields(d: Dialect) -> dict[str, str]:
    ok, ln, pk, sk = "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    loss = d.shift(d.stamp("2018-01-01 00:00:00"), f"{ok} % 1500")
    return {
        "ClaimNumber": f"concat('C-', {d.string(ok)})",
        "BenefitCaseType": d.pick(["STD", "STD", "LTD", "STD"], ln),
        "ClaimStatusDescription": d.pick(["Benefit Case Under Review"] * 5 + ["Closed - Approved", None], pk),
        "ClaimStatusCode": d.pick(["Open", "Closed", None, "Open", "Open"], sk),
        "ApprovalDate": f"CASE WHEN l_returnflag = 'R' THEN NULL ELSE {d.iso('l_shipdate')} END",
        "DurationDate": f"CASE WHEN {pk} % 11 = 0 THEN NULL ELSE {d.iso(d.shift(loss, f'{pk} % 400 - 40'))} END",
        "ReceivedDate": d.iso(d.shift(loss, f"{ok} % 30", f"{ok} % 24")),
        "LossDate": d.iso(loss),
        "InsuredHireDate": d.iso(d.shift(loss, f"-({ok} * 37 % 5000 - 100)")),
        "PrimaryDiagnosisCode": d.pick(DIAGNOSIS_CODES, ok),
        "PrimaryDiagnosisDecription": d.pick(DESCRIPTIONS, f"{ok} + {ln} % 2"),
        "PrimaryDiagnosisCategory": d.pick(DIAGNOSIS_CATEGORIES, ok),
        "SICCode": f"CASE WHEN {ok} % 13 = 0 THEN NULL ELSE CAST(1000 + {ok} * 7 % 9000 AS DOUBLE) END",
        "InsuredGender": d.pick(["Male", "Female", None], ok),
        "InsuredSalaryIndicator": d.pick(["MONTHLY", "WEEKLY", "YEARLY", "HOURLY", None], ok),
        "DOTPrimaryExertionLevel": d.pick(["Light", "Medium", "Heavy", None], ok),
        "CaseSize": d.pick(["0-25", "25-50", "175-200", "1000+"], f"{ok} + {ln} % 2"),
        "InsuredAgeatLoss": f"CASE WHEN {ok} % 17 = 0 THEN NULL ELSE CAST(18 + {ok} % 50 AS DOUBLE) END",
        "InsuredAnnualizedSalary": f"CASE WHEN {ok} % 19 = 0 THEN NULL WHEN {ok} % 23 = 0 THEN '-NA-' ELSE concat({d.string(f'{ok} % 400 * 250')}, '-', {d.string(f'{ok} % 400 * 250 + 250')}) END",
        "l_linenumber": ln, "l_partkey": pk, "l_suppkey": sk, "l_extendedprice": "l_extendedprice",
    }


SNAPSHOT_TIEBREAK = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

HEADER_NAMES = [
    "Employee_Address", "Employee_Address_1", "Employee_Address_2", "Employee_Address_3",
    "Employee_Address_4", "Eligibility_DOH", "Class/Set",
    "Supplemental/Voluntary_Employee_Life_In_Force_Amount",
    "Supplemental/Voluntary_Employee_AD&D_Applied_For_Amount",
    "EMPLOYEE_Voluntary/Supplemental_Coverage_LIFE_Benefit_Amount",
    "Dependent_Relationship_Dependent_Relationship",
    "Dependent_Relationship_Dependent_Child_3", "Basic_Life_In_Force_Amount",
    "Supplemental/Voluntary_Employee_Life_Effective_Date",
    "Supplemental/Voluntary_Employee_AD&D_Effective_Date",
    "Hospital Indemnity ELECTION", "Hos. ELECTION \"EE\", \"ES\", \"EC\", or \"EF\"_1",
    "Dependent CHILD #3 SSN", "Child#1 DOB", "Ch1.LastName", "blank_header_1",
    "blank_header_20", "ACC Effective Date", "Member_Information_Last_Name",
]
RULE_PRODUCTS = ["UNK", "LIFESUP", "ADDSUP", "LTD", "VIS", "CHLIFE", "LIFEVOL", "primary"]
RULE_HEADERS = [
    "Zip", "AddressLine3", "GF_BenefitAmount", "EffectiveDate", "BinaryResponse", "UNK",
    "AccountNumber", "Inforce Amount", "CoverageTier", "Relationship", "DateOfBirth", "GroupNumber",
]
RULE_PARTIES = ["Primary", "UNK", "Child", "Dependent", "Spouse", "Dependent-1"]


def _header_fields(d: Dialect) -> dict[str, str]:
    return {
        "event_id": "event_id",
        "column_name": d.pick(HEADER_NAMES, "event_id"),
        "prod": d.pick(RULE_PRODUCTS, d.div("event_id", "24")),
        "hdr": d.pick(RULE_HEADERS, f"{d.div('event_id', '192')} + user_id"),
        "ent": d.pick(RULE_PARTIES, f"{d.div('event_id', '2304')} + {d.div('user_id', '12')}"),
    }


def _annuity_columns() -> tuple[list[str], list[str], list[str]]:
    """Text, numeric and flag columns of the two annuity batches, each once."""
    text = list(dict.fromkeys(fixed.APPLICATION_CATEGORICAL + fixed.TRANSACTION_CATEGORICAL))
    derived = {"no_employees", "webservices"}
    numeric = [
        c for c in dict.fromkeys(fixed.APPLICATION_NUMERIC + fixed.TRANSACTION_NUMERIC) if c not in derived
    ]
    flags = [c for c in fixed.TRANSACTION_BOOLEAN if c not in text]
    return text, numeric, flags


LEVELS = {
    "CONTRACTDATA_WRITINGCODE": ["['IND1']", "['IND2', 'IND3']", None, "['IND4']"],
    "NBANNUITYDATA_OWNERPARTYTYPE_VALUE": ["Person", "Trust", None],
}


def _annuity_fields(d: Dialect) -> dict[str, str]:
    text, numeric, flags = _annuity_columns()
    fields = {"TRXNUM": "event_id", "batch": "event_type", "position": "event_id"}
    logins = ["['WebServices', '%s']" % fixed.TRANSACTION_LOGINS[i] for i in range(6)]
    logins += ["['%s']" % x for x in fixed.APPLICATION_LOGINS[:6]] + [None, "['WebServices', '470bpx', '470max']"]
    fields["V_SYSTEM_LOGON_ID"] = d.pick(logins, "user_id")
    for i, c in enumerate(text):
        levels = LEVELS.get(c) or [f"v{k}" for k in range(2 + i % 5)] + [None]
        fields[c] = d.pick(levels, f"event_id + {d.div(f'user_id * {i + 3}', '2')}")
    for i, c in enumerate(numeric):
        value = f"CAST((event_id * {i + 7} + user_id * {2 * i + 3}) % {40 + 3 * i} AS DOUBLE) / {1 + i % 4}"
        if c.endswith(("ratio", "change_days")):
            value = f"CASE WHEN user_id % {5 + i % 3} = 0 THEN NULL ELSE {value} END"
        fields[c] = value
    for i, c in enumerate(flags):
        fields[c] = f"CASE WHEN event_id % {7 + i} = 0 THEN NULL ELSE (event_id + {i}) % 3 = 0 END"
    fields["class"] = "CASE WHEN (event_id * 31 + user_id) % 10 < 3 THEN 1 ELSE 0 END"
    return fields


def _login_fields(d: Dialect) -> dict[str, str]:
    names = fixed.APPLICATION_LOGINS[:8] + fixed.TRANSACTION_LOGINS[:8]
    texts = ["['WebServices', '%s']" % x for x in names] + [None, "['470fjx']", "['110btw', '725rtr', 'WebServices']"]
    return {"event_id": "event_id", "V_SYSTEM_LOGON_ID": d.pick(texts, "user_id + event_id")}


VIEWS = {
    "claims": ("lineitem", _claim_fields),
    "snapshots": ("lineitem", _snapshot_fields),
    "headers": ("events", _header_fields),
    "annuities": ("events", _annuity_fields),
    "logins": ("events", _login_fields),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. The file of a small one is one row group, so it is spread over the cores."""
    keep_compiled(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bound view as a Spark table; unused columns are pruned from the scan."""
    source, fields = VIEWS[name]
    exprs = [f"{x} AS {SPARK.name(c)}" for c, x in fields(SPARK).items()]
    return table(spark, sf_dir, source).selectExpr(*exprs)


def view_sql(name: str) -> str:
    """The same view as a DuckDB common table expression."""
    source, fields = VIEWS[name]
    exprs = ",\n  ".join(f"{x} AS {DUCK.name(c)}" for c, x in fields(DUCK).items())
    return f"{name} AS (SELECT\n  {exprs}\nFROM {source})"
