"""Golden rows for the scalar expressions (one per CASE arm and JSON shape)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docsentinel.functions import exprs as X
from docsentinel.plans.staging import stage_controlled, stage_created

# raw subtype -> (country, year) after lower/trim; one row per decode arm
COUNTRY_YEAR = [
    ("ADDRESS_PROOF_FRA", "fra", None),
    ("BANK_ACCOUNT_STATEMENT_DEU", "deu", None),
    ("VEHICLE_REGISTRATION_CERTIFICATE_FRA", "fra", None),
    ("DRIVING_LICENSE_FRA_CARD_2013", "fra", "2013"),
    ("DRIVING_LICENSE_XYZ_CARD_2013", "xyz", None),
    ("DRIVING_LICENSE_ITA_PAPER_1990", "ita", "1990"),
    ("DRIVING_LICENSE_ESP_2015", "esp", "2015"),
    ("DRIVING_LICENSE_XYZ", "xyz", None),
    ("DRIVING_LICENSE", None, "ense"),
    ("ID_CARD_FRA_2021", "fra", "2021"),
    ("ID_CARD_XYZ", "xyz", None),
    ("IDXCARD_FRA_2021", "fra", "2021"),
    ("PASSPORT_BEL_2017", "bel", "2017"),
    ("PASSPORT_XYZ_2019", "xyz", None),
    ("RESIDENCE_PERMIT_PRT_2020", "prt", "2020"),
    ("id_card_fra_2021", None, None),
    ("OPEN_BANKING", None, None),
    (None, None, None),
]

# controls JSON -> (status, subject, name)
CONTROLS = [
    ('[{"identifier":"Document.AddressConsistency","status":"OK"}]', "OK", "document", "address_consistency"),
    ('[{"identifier":" Applicant.AlternateFamilyNameConsistency ","status":"KO"}]', "KO", "applicant",
     "alternate_family_name_consistency"),
    ('[{"identifier":"DocumentApplicant.DateValidation","status":"NA"}]', "NA", "document", "date_validation"),
    ('[{"identifier":"Other.Unknown","status":null}]', None, None, None),
    ('[{"status":"OK"}, {"identifier":"Document.DateValidation","status":"KO"}]', "OK", None, None),
    ("[]", None, None, None),
    (None, None, None, None),
    ('{"identifier":"Document.DateValidation","status":"OK"}', None, None, None),
    ("not json", None, None, None),
]


def _raw_created(spark, subtypes):
    ts = dt.datetime(2001, 1, 1)
    rows = [(f"c{i}", "d", "client 1", " Scan ", s, " ID_Card ", ts, ts) for i, s in enumerate(subtypes)]
    return spark.createDataFrame(rows, "id string, data_id_id string, data_acquisitionid_organizationid string, "
                                       "data_acquisitionid_type string, data_documentclass_documentsubtype string, "
                                       "data_documentclass_documenttype string, data_eventdate timestamp_ntz, "
                                       "time timestamp_ntz")


def _raw_controlled(spark, controls):
    ts = dt.datetime(2001, 1, 1)
    rows = [(f"e{i}", "d", c, '[{"id":"f1","type":"recto","domain":"kyc","organizationId":"client 2"}]', "APPLIED",
             ts, "standard", ts) for i, c in enumerate(controls)]
    return spark.createDataFrame(rows, "id string, doc_id string, "
                                       "data_documentcontrolsdata_documentcontrols_anonymized string, "
                                       "data_documentcontrolsdata_documentfaceids string, "
                                       "data_documentcontrolsdata_status string, data_eventdate timestamp_ntz, "
                                       "data_score string, time timestamp_ntz")


def test_country_and_year_decode(spark):
    out = stage_created(_raw_created(spark, [s for s, _, _ in COUNTRY_YEAR])).orderBy("event_id").collect()
    by_id = {r["event_id"]: r for r in out}
    for i, (sub, country, year) in enumerate(COUNTRY_YEAR):
        r = by_id[f"c{i}"]
        assert (r["document_issuing_country"], r["document_issue_year"]) == (country, year), sub
        assert r["document_category"] == "id_card"
        assert r["acquisition_type"] == "scan"


def test_json_first_element_and_control_decode(spark):
    out = stage_controlled(_raw_controlled(spark, [c for c, *_ in CONTROLS])).collect()
    by_id = {r["event_id"]: r for r in out}
    for i, (js, status, subject, name) in enumerate(CONTROLS):
        r = by_id[f"e{i}"]
        assert (r["control_status"], r["control_subject"], r["control_name"]) == (status, subject, name), js
        assert r["channel_acquisition_id"] == "client 2"
        assert r["document_face_id"] == "f1"


def test_element_0_of_any_array(spark):
    """Later elements of any type, blanks before the bracket; anything that is no array has no element 0."""
    item = '{"identifier":"Document.DateValidation","status":"KO"}'
    texts = [f"[{item}, 5]", f'[{item},"x",null]', f"\n\t [{item}]", "[]", item, "[5]", "[null]", f"[[{item}]]", "null",
             f"[{item}", ""]
    out = {r["event_id"]: r["control_status"] for r in stage_controlled(_raw_controlled(spark, texts)).collect()}
    assert [out[f"e{i}"] for i in range(len(texts))] == ["KO"] * 3 + [None] * 8


def test_nested_json_value_is_compact_text(spark):
    out = stage_controlled(_raw_controlled(spark, ['[{"identifier":"x","status":"OK","scores":["a", "b"]}]'])).first()
    assert out["control_scores"] == '["a","b"]'


@pytest.mark.parametrize("n,d,expected", [
    (1, 3, Decimal("33.33")), (2, 3, Decimal("66.67")), (1, 8, Decimal("12.50")), (1, 200, Decimal("0.50")),
    (1, 400, Decimal("0.25")), (1, 800, Decimal("0.13")), (-1, 800, Decimal("-0.13")), (5, 0, Decimal("500.00")),
    (0, 0, Decimal("0.00")), (10, 40, Decimal("25.00")), (7, None, Decimal("700.00")), (None, 5, None),
    (123456789012, 987654321098, Decimal("12.50")),
])
def test_pct_exact_half_away_from_zero(spark, n, d, expected):
    df = spark.createDataFrame([(n, d)], "n long, d long")
    a, b = df.select(X.pct("n", "d"), X.pct(F.col("n"), F.col("d"))).first()
    assert a == expected and b == expected


def test_pct_matches_exact_rational_rounding(spark):
    from fractions import Fraction

    rows = [(n, d) for d in range(1, 120) for n in range(0, d + 1, 3)]
    df = spark.createDataFrame(rows, "n long, d long")
    for n, d, p in df.select("n", "d", X.pct("n", "d").alias("p")).collect():
        exact = Fraction(100 * n, d)
        cents = (exact * 100 * 2 + 1) // 2  # half up on non-negative values
        assert p == Decimal(int(cents)) / 100, (n, d)


def test_surrogate_key_null_handling(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    with_empty, propagating = df.select(X.surrogate_key("a", "b"), X.surrogate_key("a", "b", null_as_empty=False)).first()
    import hashlib

    assert with_empty == hashlib.md5(b"a|").hexdigest()
    assert propagating is None


def test_status_rank(spark):
    df = spark.createDataFrame([("OK",), ("KO",), ("NA",), (None,), ("XX",)], "s string")
    assert [r[0] for r in df.select(X.status_rank("s")).collect()] == [1, 2, 3, 4, 5]


def test_lookback_is_inclusive_and_unbounded_above(spark):
    as_of = dt.date(2001, 8, 1)
    ts = [dt.datetime(1999, 8, 1, 23, 59), dt.datetime(1999, 8, 2), dt.datetime(2005, 1, 1)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    kept = [r[0] for r in df.filter(X.lookback("t", as_of, 730)).collect()]
    assert kept == ts[1:]
