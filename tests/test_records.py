"""Record rules on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from custodia.functions.parsing import coerce_timestamp, message_timestamp, parse_json, parse_or_quarantine
from custodia.functions.records import EMAIL, hostile_identifier, scoring_rules
from custodia.functions.rules import split_valid, validate
from custodia.operators import quality
from custodia.plans.jobs import validate_crm, validate_kyc
from custodia.sources.schemas import TRANSACTION_STREAM

CRM = "customer_id string, first_name string, last_name string, email string, phone string, address string, updated_at string"
KYC = "customer_id string, id_type string, id_number string, verification_status string, risk_level string, verified_at string"
NOW = "2025-06-01 10:00:00"
GOOD_CRM = {
    "customer_id": "CUST12345", "first_name": "Jean", "last_name": "Dupont", "email": "jean.dupont@example.com",
    "phone": "+33612345678", "address": "123 Rue de Paris", "updated_at": NOW,
}
GOOD_KYC = {
    "customer_id": "CUST12345", "id_type": "passport", "id_number": "PAS123456",
    "verification_status": "verified", "risk_level": "low", "verified_at": NOW,
}


def crm_frame(spark, *changes):
    return spark.createDataFrame([{**GOOD_CRM, **c} for c in changes], CRM)


def kyc_frame(spark, *changes):
    return spark.createDataFrame([{**GOOD_KYC, **c} for c in changes], KYC)


def fields(row):
    return [(e["field"], e["rule"]) for e in row["errors"]]


def test_valid_records(spark):
    crm = validate_crm(crm_frame(spark, {})).first()
    assert crm["is_valid"] and crm["errors"] == []
    assert crm["data"]["updated_at"] == dt.datetime(2025, 6, 1, 10)
    assert validate_kyc(kyc_frame(spark, {})).first()["is_valid"]


@pytest.mark.parametrize(
    ("field", "value", "rule"),
    [
        ("email", "not_an_email", "email"),
        ("phone", "123", "format"),
        ("customer_id", "12", "format"),
        ("customer_id", None, "required"),
        ("customer_id", "CUST001", "format"),
        ("updated_at", "not_a_date", "datetime"),
        ("updated_at", "2025-06-01", "datetime"),
        ("updated_at", None, "required"),
    ],
)
def test_bad_crm_field_is_named(spark, field, value, rule):
    row = validate_crm(crm_frame(spark, {field: value})).first()
    assert not row["is_valid"] and fields(row) == [(field, rule)] and row["data"] is None


@pytest.mark.parametrize(
    ("field", "value"), [("verification_status", "unknown"), ("risk_level", "extreme"), ("verified_at", "not_a_date")]
)
def test_bad_kyc_field_is_named(spark, field, value):
    row = validate_kyc(kyc_frame(spark, {field: value})).first()
    assert not row["is_valid"] and [f for f, _ in fields(row)] == [field]


def test_all_errors_are_listed(spark):
    row = validate_crm(crm_frame(spark, {"email": "x", "phone": "1", "updated_at": "soon"})).first()
    assert [f for f, _ in fields(row)] == ["email", "phone", "updated_at"]


def test_optional_fields_and_blanks(spark):
    rows = validate_crm(
        crm_frame(
            spark,
            {"first_name": None, "last_name": None, "email": None, "phone": None, "address": None},
            {"phone": ""},
            {"first_name": "  Jean ", "email": " jean@example.com "},
        )
    ).collect()
    assert all(r["is_valid"] for r in rows)
    assert rows[2]["data"]["first_name"] == "Jean" and rows[2]["data"]["email"] == "jean@example.com"


def test_kyc_domains_ignore_case(spark):
    row = validate_kyc(kyc_frame(spark, {"verification_status": "VERIFIED", "risk_level": "Low"})).first()
    assert row["data"]["verification_status"] == "verified" and row["data"]["risk_level"] == "low"


def test_batch_summary(spark):
    mixed = crm_frame(spark, {}, {}, {}, {"email": "x"}, {"phone": "1"})
    checked = validate_crm(mixed)
    assert quality.validation_summary(checked, "crm").first()[1:] == (5, 3, 2)
    assert quality.invalid_records(checked, ["customer_id"]).count() == 2
    empty = validate_crm(mixed.limit(0))
    assert quality.validation_summary(empty, "crm").first()[1:] == (0, 0, 0)
    good, bad = split_valid(checked)
    assert (good.count(), bad.count()) == (3, 2)


@pytest.mark.parametrize(
    ("mail", "ok"),
    [
        ("a@b.co", True), ("a.b+c@sub.example.com", True), ("é@exemple.fr", True), ("a@b", False), ("a..b@c.de", False),
        (".a@c.de", False), ("a@-c.de", False), ("a@c.123", False), ("a b@c.de", False), ("x" * 65 + "@c.de", False),
    ],
)
def test_email_grammar(spark, mail, ok):
    assert spark.createDataFrame([(mail,)], "m string").select(F.col("m").rlike(EMAIL)).first()[0] is ok


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-11-01T10:30:00Z", dt.datetime(2024, 11, 1, 10, 30)),
        ("2024-11-01T10:30:00+0100", dt.datetime(2024, 11, 1, 9, 30)),
        ("2024-11-01 10:30", dt.datetime(2024, 11, 1, 10, 30)),
        ("1730419200", dt.datetime(2024, 11, 1)),
        ("1730419200000", dt.datetime(2024, 11, 1)),
        ("2024-11-01", None),
        ("2024-13-01 00:00:00", None),
        ("soon", None),
    ],
)
def test_coerce_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(coerce_timestamp(F.col("t")).cast("timestamp_ntz")).first()[0] == expected


def test_message_timestamp_reads_milliseconds(spark):
    df = spark.createDataFrame([("1730419200000",), ("2024-11-01T00:00:00Z",), ("x",)], "t string")
    got = [r[0] for r in df.select(message_timestamp(F.col("t")).cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2024, 11, 1), dt.datetime(2024, 11, 1), None]


def test_malformed_messages(spark):
    df = spark.createDataFrame([('{"transaction_id":"T","amount":1.5}',), ("not json",), (None,), ('{"transaction_id":"U","amount":"x"}',)], "value string")
    rows = parse_json(df, TRANSACTION_STREAM).select("transaction_id", "amount").collect()
    assert [tuple(r) for r in rows] == [("T", 1.5), (None, None), (None, None), ("U", None)]
    corrupt = [r[0] for r in parse_or_quarantine(df, TRANSACTION_STREAM).select("_corrupt_record").collect()]
    assert corrupt[0] is None and corrupt[1] == "not json" and corrupt[2] == "" and corrupt[3].startswith("{")


def test_hostile_identifiers(spark):
    ids = ["'; DROP TABLE customers; --", "<script>alert('xss')</script>", "CUST-00_1", "", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert [r[0] for r in df.select(hostile_identifier("id")).collect()] == [True, True, False, True, True]


def test_scoring_contract(spark):
    df = spark.createDataFrame(
        [("C1", 300, "LOW", 1.0, "t"), ("C2", 851, "LOW", 1.0, "t"), ("C3", 700, "NONE", 0.0, None)],
        "customer_id string, credit_score int, risk_level string, approved_amount double, timestamp string",
    )
    rows = validate(df, scoring_rules()).orderBy("customer_id").collect()
    assert [r["is_valid"] for r in rows] == [True, False, False]
    assert fields(rows[2]) == [("timestamp", "required"), ("risk_level", "domain"), ("approved_amount", "positive")]


def test_filter_on_flag_does_not_repeat_the_rules(spark):
    checked = validate_crm(crm_frame(spark, {}, {"phone": "1"}))
    plan = checked.filter(~F.col("is_valid"))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("{10,15}" in line for line in filters)
