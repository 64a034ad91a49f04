"""Hand-derived results of sample claims and published figures."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.functions import scoring, text
from claimflow.functions.stemming import stem_word
from claimflow.operators import evaluate, rules
from claimflow.operators.scale import Scaler
from claimflow.plans import annuity, bridging, claims
from claimflow.sources.readers import read_claims


def claim(columns, **values):
    return {c: values.get(c) for c in columns}


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_short_term_sample(spark):
    row = claim(
        fixed.STD_COLUMNS,
        **{
            "Claim Identifier": "CLM-1", "Policy Effective Date": "01/01/2017", "Duration Months": 1,
            "Insured Salary Ind": "BI-WEEKLY", "SIC Code": 7349, "Insured Age at Loss": 53,
            "Received Date": "02/12/2021", "Insured Hire Date": "04/30/2012", "Insured Gender": "M",
            "Primary Diagnosis Category": "Diseases of the musculoskeletal system & connectiv",
            "Loss Date": "01/28/2021", "Coverage Code": "STDATP", "Insured Annualized Salary": 85125.0,
            "Policy Lives": 2012, "Insured Zip": "93447",
        },
    )
    got = one(claims.std_features(read_claims(spark, [row], fixed.STD_COLUMNS)))
    assert got["days_to_report"] == 15 and got["emp_tenure"] == 3195
    assert got["policy_tenure"] == 1503 and got["prognosis_days"] == 30
    assert got["Primary Diagnosis Category"] == "OTHERS" and got["Coverage Code"] == "OTHERS"
    assert got["SIC_risk_ind"] == "Low" and got["NA_row"] == "N"
    assert "Insured Zip" not in got and "Loss Date" not in got


def test_long_term_sample(spark):
    row = claim(
        fixed.LTD_COLUMNS,
        **{
            "Claim Identifier": "CLM-2", "Coverage Code": "LTD", "Received Date": "09/10/2020",
            "Loss Date": "09/01/2020", "Insured Gender": "M", "Insured Age at Loss": "20",
            "Insured Salary Ind": "W", "Insured Annualized Salary": 70125, "Insured Hire Date": "05/12/2015",
            "First Payment From Date": "09/08/2020", "Last Payment To Date": "09/08/2020",
            "Duration Months": "19", "Pre-Ex Outcome": "YES", "SS Pursue Ind": "YES", "Policy Lives": 62,
        },
    )
    got = one(claims.ltd_features(read_claims(spark, [row], fixed.LTD_COLUMNS)))
    assert got["days_to_report"] == 9 and got["emp_tenure"] == 1939
    assert got["last_first_payment_lag"] == 0 and got["prognosis_days"] == 570
    assert got["Insured Salary Ind"] == "WEEKLY" and got["Pre-Ex Outcome"] == "Y"
    assert got["SS Pursue Ind"] == "YES" and got["NA_row"] == "Y"


def test_settlement_sample(spark):
    row = claim(
        fixed.SETTLEMENT_COLUMNS,
        **{
            "Claim Identifier": "CLM-3", "Policy Effective Date": "06/01/2014", "Duration Months": "65",
            "SS Pri Award Amt": "-(1250-1500)", "Pre-Ex Outcome": "N", "Primary Diagnosis Code": "S92.009A",
            "Insured Salary Ind": "MONTHLY", "SIC Code": "5961", "First Payment From Date": "01/17/2016",
            "Insured Age at Loss": "56", "Received Date": "01/12/2016", "TSA Ind": "N",
            "Primary Diagnosis Category": "Injury, poisoning & certain other consequences of",
            "SS Pri Status": "Approved", "Duration Date": "07/02/2026", "Insured Hire Date": "12/23/2013",
            "Primary Diagnosis Desc": "Unspecified fracture of unspecified calcaneus, ini",
            "Insured Gender": "F", "Loss Date": "10/19/2015", "Coverage Code": "LTDVOL",
            "SS Adjustment Ind": "Y", "Insured Annualized Salary": 31625.0, "Policy Lives": 912.0,
            "DOT Exertion Level (Primary)": "Unknown",
        },
    )
    raw = read_claims(spark, [row], fixed.SETTLEMENT_COLUMNS)
    days = one(claims.settlement_durations(raw))
    assert days["policy_tenure"] == 590 and days["days_to_report"] == 85 and days["emp_tenure"] == 665
    assert days["prognosis_days"] == 3909 and days["days_to_first_payment"] == 90
    unscaled = Scaler("standard", {c: (0.0, 1.0) for c in fixed.SETTLEMENT_SCALED})
    features = claims.settlement_features(raw, unscaled)
    got = one(features)
    assert (got["pd_1_cat"], got["pd_2_cat"]) == ("very_high", "very_high")
    assert got["SIC Category"] == "59" and got["SS Pri Award Amt"] == "(1250-1500)"
    assert got["Primary Diagnosis Category"] == "injury_poisonining"
    assert got["medical_cond_comb_fracture"] == 1 and got["NA_row"] == "N"
    template = ["medical_cond_comb_others", "sys_organ_comb_calcaneus", "sys_organ_comb_others", "SIC Category_59"]
    flags = one(claims.settlement_matrix(features, template))
    assert [flags[c] for c in template] == [1, 1, 0, 1]


def snapshot(**values):
    base = {
        "ClaimNumber": "C-1", "BenefitCaseType": "STD", "ReceivedDate": "2018-11-29 15:10:16",
        "LossDate": "2018-11-29 00:00:00", "ClaimStatusCode": "Open",
        "ClaimStatusDescription": "Benefit Case Under Review", "InsuredGender": "Male",
        "InsuredAgeatLoss": 59.0, "InsuredSalaryIndicator": "MONTHLY",
        "InsuredAnnualizedSalary": "67500-67750", "InsuredHireDate": "2014-08-25 00:00:00",
        "PrimaryDiagnosisCode": "M51.27",
        "PrimaryDiagnosisDecription": "Other intervertebral disc displacement, lumbosacra",
        "PrimaryDiagnosisCategory": "Diseases of the musculoskeletal system & connectiv",
        "ApprovalDate": "2018-12-20 14:41:19", "DurationDate": "2019-02-27 00:00:00",
        "SICCode": 3451.0, "DOTPrimaryExertionLevel": "Light", "CaseSize": "175-200", "row": 1,
    }
    return {**base, **values}


def features_of(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{k} {'double' if isinstance(v, float) else 'int' if k == 'row' else 'string'}" for k, v in snapshot().items()))
    return bridging.bridging_features(df, ["row"])


def test_bridging_sample(spark):
    got = one(features_of(spark, [snapshot()]))
    assert got["emp_tenure"] == 1557 and got["InsuredAnnualizedSalary"] == 67625
    assert got["initial_prognosis_days"] == 90 and got["SIC_category"] == "34"
    assert (got["pd_code_1"], got["pd_code_2"]) == ("M51", "27")


def test_bridging_snapshot_choice(spark):
    later = "2018-12-25 00:00:00"
    # an unapproved snapshot comes first
    got = one(features_of(spark, [snapshot(), snapshot(ApprovalDate=None, DurationDate="2018-12-09 00:00:00", row=2)]))
    assert got["initial_prognosis_days"] == 10
    # equal dates: the tie-break decides
    got = one(features_of(spark, [snapshot(DurationDate="2018-12-09 00:00:00", row=2), snapshot()]))
    assert got["initial_prognosis_days"] == 90
    # a claim whose first snapshot is long-term is dropped, though a later one is short-term
    assert features_of(spark, [snapshot(BenefitCaseType="LTD"), snapshot(ApprovalDate=later, row=2)]).count() == 0
    # closed under review is not eligible
    assert features_of(spark, [snapshot(ClaimStatusCode="Closed")]).count() == 0
    # equal feature rows collapse, different ones fan out
    assert features_of(spark, [snapshot(), snapshot(ApprovalDate=later, row=2)]).count() == 1
    assert features_of(spark, [snapshot(), snapshot(CaseSize="0-25", row=2)]).count() == 2


def test_prior_correction(spark):
    p = spark.createDataFrame([(0.99,), (0.5,), (0.964594,)], "p double")
    std = [r[0] for r in p.select(scoring.prior_correct(F.col("p"), 0.00795, 0.1792)).collect()]
    assert std == pytest.approx([0.784197, 0.035406, 0.5], abs=1e-5)
    nine = spark.createDataFrame([(0.9,)], "p double")
    assert nine.select(scoring.prior_correct(F.col("p"), 0.1, 0.5)).first()[0] == pytest.approx(0.5)


PUBLISHED = [
    (
        (524, 249, 88, 121),
        dict(
            class0_precision=0.856, class0_recall=0.678, class0_f1=0.757, class1_precision=0.327,
            class1_recall=0.579, class1_f1=0.418, weighted_precision=0.744, weighted_recall=0.657,
            weighted_f1=0.685, accuracy=0.657, f05=0.358, f1=0.418, f2=0.502,
        ),
    ),
    (
        (603, 305, 31, 51),
        dict(
            class0_precision=0.951, class0_recall=0.664, class0_f1=0.782, class1_precision=0.143,
            class1_recall=0.622, class1_f1=0.233, weighted_precision=0.884, weighted_recall=0.661,
            weighted_f1=0.737, accuracy=0.661, f05=0.169, f1=0.233, f2=0.373,
        ),
    ),
]


@pytest.mark.parametrize("matrix, figures", PUBLISHED)
def test_published_figures(spark, matrix, figures):
    tn, fp, fn, tp = matrix
    rows = [(0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)]
    df = spark.createDataFrame(rows, "y int, yhat int, w int")
    got = one(evaluate.classification_report(evaluate.confusion(df, "y", "yhat", "w")))
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == matrix
    for name, value in figures.items():
        assert got[name] == pytest.approx(value, abs=6e-4), name


def test_event_lags(spark):
    rows = [("2021-05-13", "2018-07-02", "2021-05-13 19:45:01.413850300", None, "2029-07-02")]
    df = spark.createDataFrame(rows, "base string, issued string, stamp string, gone string, later string")
    got = one(annuity.lag_features(df, "base", ["issued", "stamp", "gone", "later"]))
    assert [got[f"{c}diff"] for c in ("issued", "stamp", "gone", "later")] == [1046, 0, -1, -1]


def test_logins(spark):
    df = spark.createDataFrame([("['WebServices', '470kjr']",), (None,), ("['470FJX']",)], f"{annuity.LOGINS} string")
    rows = annuity.login_features(df, fixed.TRANSACTION_LOGINS).collect()
    assert (rows[0]["webservices"], rows[0]["emp_level_1"], rows[0]["no_employees"]) == (1, True, 2)
    assert (rows[1]["webservices"], rows[1]["no_employees"]) == (0, 1)
    app = annuity.login_features(df, fixed.APPLICATION_LOGINS).collect()
    assert app[2]["emp_level_4"] and not app[0]["emp_level_4"]


def label(spark, name, prod, hdr, ent):
    df = spark.createDataFrame([(name, prod, hdr, ent)], "column_name string, prod string, hdr string, ent string")
    row = one(rules.apply_pattern_rules(rules.apply_rules(df)))
    return row["prod"], row["hdr"], row["ent"]


@pytest.mark.parametrize(
    "name, before, after",
    [
        # two rules hit the product: the later one counts
        ("x", ("VIS", "Zip", "Spouse"), ("UNK", "Zip", "Spouse")),
        ("Supplemental/Voluntary_Employee_Life_In_Force_Amount", ("LIFESUP", "Inforce Amount", "Primary"), ("LIFEVOL", "Inforce Amount", "Primary")),
        # conditions see the labels as predicted: UNK set by one rule does not trigger the next
        ("x", ("LTD", "UNK", "Primary"), ("LTD", "UNK", "UNK")),
        ("x", ("UNK", "UNK", "UNK"), ("UNK", "UNK", "Primary")),
        ("Employee_Address_3", ("UNK", "Zip", "Primary"), ("UNK", "Zip", "Primary")),
        ("Employee_Address", ("UNK", "Zip", "Primary"), ("UNK", "AddressLine1", "Primary")),
        ("Employee_Address_4", ("UNK", "Zip", "Primary"), ("UNK", "Zip", "Primary")),
        ("Hospital Indemnity ELECTION", ("UNK", "CoverageTier", "UNK"), ("UNK", "CoverageTier", "Primary")),
        ("Dependent_Relationship_Dependent_Child_3", ("UNK", "Relationship", "Dependent"), ("UNK", "Relationship", "Child-3")),
        ("Dependent CHILD #3 SSN", ("UNK", "SSN", "Child"), ("UNK", "SSN", "Child-3")),
    ],
)
def test_header_rules(spark, name, before, after):
    assert label(spark, name, *before) == after


def test_hospital_pattern_needs_unknown_party(spark):
    df = spark.createDataFrame([("Hos. ELECTION", "UNK", "CoverageTier", "UNK")], "column_name string, prod string, hdr string, ent string")
    assert one(rules.apply_pattern_rules(df))["prod"] == "HI"


@pytest.mark.parametrize(
    "header, phrase",
    [
        ("Hospital Indemnity.Election", "Hospital indemnity.election"), ("firstName", "First name"),
        ("Employee_Address_1", "Employee address 1"), ("SSNNumber", "Ssn number"), ("member-id", "Member"),
        ("Child#1 DOB", "Child#1 dob"), ("", ""), ("ADD2Life", "Add2 life"),
    ],
)
def test_normalised_header(spark, header, phrase):
    df = spark.createDataFrame([(header,)], "h string")
    assert df.select(text.normalise_header(F.col("h"))).first()[0] == phrase


@pytest.mark.parametrize("ids, padded", [([1, 2], [0] * 14 + [1, 2]), (list(range(1, 20)), list(range(1, 17))), ([], [0] * 16)])
def test_pad_left(spark, ids, padded):
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert df.select(text.pad_left(F.col("ids"), 16)).first()[0] == padded


def test_stems():
    pairs = {
        "consolingly": "consol", "knocked": "knock", "generalization": "general", "happy": "happi", "by": "by",
        "dog's": "dog", "bias": "bias", "proceed": "proceed", "controlled": "control", "troubled": "troubl",
        "argued": "argu", "argument": "argument", "Fractures": "fractur", "agreed": "agre", "feed": "feed",
    }
    assert {w: stem_word(w) for w in pairs} == pairs


def test_parse_timestamp(spark):
    from claimflow.functions.cleaning import parse_timestamp

    texts = ["01/28/2021", "1/2/2021", "2018-11-29 15:10:16", "2020-10-29 11:13:42.935540500", "13/45/2021", "soon", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_timestamp("t")).collect()]
    assert got == [
        dt.datetime(2021, 1, 28), dt.datetime(2021, 1, 2), dt.datetime(2018, 11, 29, 15, 10, 16),
        dt.datetime(2020, 10, 29, 11, 13, 42, 935540), None, None, None, None,
    ]


def test_strict_numbers_raise(spark):
    from claimflow.functions.cleaning import parse_number

    df = spark.createDataFrame([(" 7 ",), ("",), ("NaN",)], "x string")
    assert [r[0] for r in df.select(parse_number("x")).collect()] == [7.0, None, None]
    bad = spark.createDataFrame([("seven",)], "x string")
    assert bad.select(parse_number("x", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        bad.select(parse_number("x")).collect()


def test_missing_column_is_an_error(spark):
    from claimflow.operators.projection import require

    with pytest.raises(KeyError):
        require(spark.range(1), ["id", "absent"])


def test_pattern_of_phrases_is_a_tree():
    phrases = [*fixed.SETTLEMENT_CONDITIONS, *fixed.SETTLEMENT_ORGANS, "a.b", "a[b", "a^c", "a-d", "a&&e", "ab"]
    pattern = text.any_of(phrases)
    # each beginning stands once
    assert len(pattern) < sum(map(len, phrases)) + 40 * len(phrases)
    assert "|".join(map(re.escape, phrases)) != pattern
    found = re.compile(pattern)
    for phrase in phrases:
        assert found.search(f"xx {phrase} yy")
        for cut in (phrase[:-1], phrase[1:]):
            assert bool(found.search(cut)) == any(p in cut for p in phrases)
    assert text.any_of(["", "a"]) == ""


def test_pattern_of_phrases_in_spark(spark):
    phrases = ["back", "back pain", "a.b", "a[b", "a^c", "a-d", "a&&e", "b\\c", "tear"]
    rows = ["my back", "bac", "a.b", "axb", "a[b", "a^c", "a-d", "a&&e", "b\\c", "tea", "a tear", "", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r["o"] for r in df.select(text.phrase_flags(F.col("t"), phrases, "p_")["p_others"].alias("o")).collect()]
    assert got == [0 if r and any(p in r for p in phrases) else 1 for r in rows]


def test_dates_told_by_place(spark):
    from claimflow.functions import cleaning

    rows = [
        ("12/31/2020", "2020-12-31"), ("2020-12-31 01:02:03", "2020-12-31 01:02:03"),
        ("2020-12-31T01:02:03", "2020-12-31T01:02:03"), ("13/31/2020", "2020-13-31"),
        # nineteen characters that may hold an offset, and other marks
        ("2020-1-1 1:00+05:30", None), ("2020-12-31 01:02:3Z", None), ("12/31/2020 10:20:30", None), ("1/2/2020", None), (None, None),
    ]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    got = df.select(cleaning._by_place(F.col("t")).alias("p"), cleaning.parse_timestamp("t").alias("d")).collect()
    assert [r["p"] for r in got] == [p for _, p in rows]
    day, clock = dt.datetime(2020, 12, 31), dt.datetime(2020, 12, 31, 1, 2, 3)
    assert [r["d"] for r in got[:3]] == [day, clock, clock]
    assert got[6]["d"] == dt.datetime(2020, 12, 31, 10, 20, 30) and got[8]["d"] is None
    blank = spark.createDataFrame([(t,) for t in ("", "  ", "\t\n", "a ", " a", "é", None)], "t string")
    assert [r[0] for r in blank.select(cleaning.blank_to_null("t")).collect()] == [None, None, None, "a ", " a", "é", None]
