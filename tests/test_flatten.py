"""Flattening, severity, list columns, ids."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from casewatch import schemas
from casewatch.functions import ids, numbers, severity, text
from casewatch.operators import flatten, ranking


def raw(id="1", age=None, sex=None, drugs=(), reactions=(), received=None, patient=True, **flags):
    person = None
    if patient:
        person = (age, sex, [(r,) for r in reactions], [(d,) for d in drugs])
    names = ("death", "hospitalization", "lifethreatening", "disabling")
    return (id, received, "1", *[flags.get(n) for n in names], person)


def reports(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.RAW_REPORT)


def flat(spark, row, drug="metformin"):
    return flatten.flatten_reports(reports(spark, row).withColumn("drug", F.lit(drug))).first()


def test_full_report(spark):
    got = flat(
        spark,
        raw(age="54", sex="2", drugs=["A", "B"], reactions=["Nausea", "Rash"], received="20220307", hospitalization="1"),
    )
    assert got.patient_summary_text == (
        "A 54 year old female patient taking A, B experienced: Nausea, Rash. "
        "Seriousness: hospitalization. Report received 20220307."
    )
    assert (got.drugs_involved, got.reactions, got.seriousness_flags) == ("A; B", "Nausea; Rash", "hospitalization")


def test_sparse_report(spark):
    got = flat(spark, raw(patient=False))
    assert got.patient_summary_text == (
        "A unknown-age year old unknown patient taking metformin experienced: unspecified reaction(s). "
        "Seriousness: non-serious/other. Report received unknown date."
    )
    assert (got.drugs_involved, got.reactions, got.patient_age, got.receivedate) == ("", "", None, None)


def test_empty_names_are_dropped(spark):
    assert flat(spark, raw(reactions=["", None, "Rash"])).reactions == "Rash"


def test_flag_needs_the_string_one(spark):
    assert flat(spark, raw(death="2")).seriousness_flags == ""


@pytest.mark.parametrize("code,name", [("1", "male"), ("2", "female"), ("0", "unknown"), (None, "unknown"), ("3", "unknown")])
def test_sex(spark, code, name):
    assert flat(spark, raw(sex=code)).patient_sex == name


def test_phrase_match_is_by_words_and_case_insensitive(spark):
    df = reports(
        spark,
        raw("1", drugs=["METFORMIN HCL 500"]),
        raw("2", drugs=["metforminol"]),
        raw("3", drugs=["other", "Metformin-Sitagliptin"]),
        raw("4", drugs=["foo", "bar"]),
        raw("5", patient=False),
    )
    found = df.filter(flatten.mentions_drug(F.col("patient.drug"), "metformin"))
    assert {r.safetyreportid for r in found.collect()} == {"1", "3"}
    # a phrase does not reach across two products
    assert df.filter(flatten.mentions_drug(F.col("patient.drug"), "foo bar")).count() == 0


def test_scan_range_is_inclusive_and_per_drug(spark):
    df = reports(
        spark,
        raw("1", drugs=["metformin", "ibuprofen"], received="20220101"),
        raw("2", drugs=["ibuprofen"], received="20241231"),
        raw("3", drugs=["ibuprofen"], received="20250101"),
    )
    got = {(r.safetyreportid, r.drug) for r in flatten.scan_reports(df).collect()}
    assert got == {("1", "metformin"), ("1", "ibuprofen"), ("2", "ibuprofen")}


def test_first_named_equals_scan_then_dedup(spark):
    drugs = ["metformin", "lisinopril", "ibuprofen"]
    df = reports(
        spark,
        raw("1", drugs=["ibuprofen", "lisinopril"], received="20220101"),
        raw("1", drugs=["metformin"], received="20220102"),
        raw("2", drugs=["ibuprofen"], received="20220101"),
        raw("3", drugs=["nothing"], received="20220101"),
    )
    scanned = ranking.dedup_reports(flatten.scan_reports(df, drugs), drugs)
    first = ranking.dedup_reports(flatten.scan_first_named(df, drugs), drugs)
    pick = lambda d: sorted((r.safetyreportid, r.drug) for r in d.collect())
    assert pick(scanned) == pick(first) == [("1", "metformin"), ("2", "ibuprofen")]


@pytest.mark.parametrize(
    "value,expected",
    [
        (" Hospitalization ", "severe"),
        ("NON-SERIOUS", "mild"),
        ("non-serious/other", "mild"),
        ("unknown", "moderate"),
        ("Severe", "severe"),
        ("odd", "odd"),
        (None, None),
    ],
)
def test_severity_lookup(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(severity.severity_by_lookup(F.col("v"))).first()[0] == expected


@pytest.mark.parametrize(
    "value,expected",
    [
        ("Hospitalization and death", "fatal"),
        ("Life threatening", "life-threatening"),
        ("disabling", "severe"),
        ("non-serious/other and hospitalization", "severe"),
        ("non-serious/other", "mild"),
        ("serious", "moderate"),
        ("mild", "mild"),
        ("x", "moderate"),
        ("nonfatal", "fatal"),
        (None, "moderate"),
    ],
)
def test_severity_ladder(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(severity.severity_by_ladder(F.col("v"))).first()[0] == expected


@pytest.mark.parametrize(
    "value,expected",
    [
        ("""['skin', "crohn's"]""", ["skin", "crohn's"]),
        ('["a", "b"]', ["a", "b"]),
        ("skin", ["skin"]),
        ("[bad", ["[bad"]),
        ("[]", []),
    ],
)
def test_list_text(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(text.parse_list_text(F.col("v"))).first()[0] == expected


@pytest.mark.parametrize("value,expected", [(0.125, 0.12), (2.345, 2.35), (2.675, 2.68), (-0.001, 0.0)])
def test_rounding(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(numbers.round_half_even(F.col("v"))).first()[0] == expected


def test_percent_rounds_ties_to_even(spark):
    df = spark.createDataFrame([(0.5625,), (67 / 96,), (16 / 22,)], "v double")
    assert [r[0] for r in df.select(numbers.percent(F.col("v"))).collect()] == ["56.2%", "69.8%", "72.7%"]


def test_known_entity_ids(spark):
    df = spark.createDataFrame(
        [("hydrochlorothiazide", "2022-03-07"), ("sertraline", "2022-12-13"), ("amoxicillin", "2022-11-22")],
        "drug string, date string",
    )
    stamped = ids.entity_id(F.col("drug"), ids.timestamp_text(F.col("date")))
    plain = ids.entity_id(F.col("drug"), F.col("date"))
    got = [tuple(r) for r in df.select(stamped, plain).collect()]
    assert got[0][0] == "2da334dbb183fb7d"
    assert got[1][1] == "6b40d1c0498974fc"
    assert got[2][1] == "9b9ffa35dbba1bd1"


def test_batch_id_is_the_digest_of_the_sorted_json_list(spark):
    import hashlib
    import json

    df = spark.createDataFrame([Row(ids=["20", "3", "100"])])
    expected = hashlib.sha256(json.dumps(sorted(["20", "3", "100"])).encode()).hexdigest()[:24]
    assert df.select(ids.batch_id(F.col("ids"))).first()[0] == expected


def test_request_signature_sorts_keys(spark):
    import hashlib
    import json

    params = {"search": "a b", "limit": "8", "count": "receivedate"}
    expected = hashlib.sha256(json.dumps(params, sort_keys=True).encode()).hexdigest()[:24]
    df = spark.createDataFrame([(params,)], "p map<string,string>")
    assert df.select(ids.request_signature(F.col("p"))).first()[0] == expected
