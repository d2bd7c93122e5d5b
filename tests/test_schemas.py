"""Compiled JSON Schema and Avro documents."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from custodia.contracts import builtin, builtin_names, load_catalogue, load_document
from custodia.functions.json_schema import non_empty_object
from custodia.functions.schema_dispatch import rules_for, validate_by_path, validate_messages
from custodia.functions.json_schema import Fields

INLINE = {
    "type": "object",
    "properties": {"customer_id": {"type": "string"}, "email": {"type": "string"}, "age": {"type": "integer"}},
    "required": ["customer_id", "email"],
}
INLINE_AVRO = {
    "type": "record", "name": "Transaction",
    "fields": [{"name": "transaction_id", "type": "string"}, {"name": "amount", "type": "float"}, {"name": "status", "type": "string"}],
}


def check(spark, schema, messages, path="s.json", **options):
    texts = [m if m is None or isinstance(m, str) else json.dumps(m) for m in messages]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    rows = validate_messages(df, path, schema, **options).orderBy("i").collect()
    return [(r["is_valid"], [f"{e['field']}:{e['rule']}" for e in r["errors"]]) for r in rows]


def test_inline_json_schema(spark):
    got = check(spark, INLINE, [
        {"customer_id": "C123", "email": "test@example.com", "age": 30}, {"customer_id": "C123"}, {}, {"customer_id": None, "email": "e"},
        {"customer_id": "C", "email": "e", "age": 5.0}, {"customer_id": "C", "email": "e", "age": 5.5}, {"customer_id": "C", "email": "e", "age": True},
        [], "not json", None,
    ])
    assert [ok for ok, _ in got] == [True, False, False, False, True, False, False, False, False, False]
    assert got[1][1] == ["email:required"]
    assert got[3][1] == ["customer_id:type"]
    assert got[7][1] == ["$:type"] and got[8][1] == ["$:undecodable"] and got[9][1] == ["$:null_message"]


def test_kyc_samples_are_both_invalid(spark):
    samples = [
        {"customer_id": "123", "kyc_status": "approved", "document_type": "passport", "issued_at": "2025-10-23T10:00:00Z"},
        {"customer_id": "456", "kyc_status": "pending", "document_type": "id_card"},
        {"customer_id": "456", "kyc_status": "pending", "verification_date": "2025-10-23T10:00:00Z", "notes": None},
    ]
    got = check(spark, builtin("kyc_response.schema.json"), samples)
    assert got[0][1] == ["verification_date:required", "$:additionalProperties", "kyc_status:enum"]
    assert got[1][1] == ["verification_date:required"]
    assert got[2] == (True, [])


TXN = {
    "transaction_id": "T-1", "customer_id": "C", "account_id": "A", "amount": 0, "currency": "MAD",
    "transaction_type": "refund", "status": "success", "timestamp": "2024-11-01T10:30:00Z",
}


@pytest.mark.parametrize(
    ("change", "errors"),
    [
        ({}, []),
        ({"amount": -0.01}, ["amount:minimum"]),
        ({"amount": True}, ["amount:type"]),
        ({"amount": "1"}, ["amount:type"]),
        ({"amount": 1e300}, []),
        ({"currency": "mad"}, ["currency:pattern"]),
        ({"currency": None}, ["currency:type"]),
        ({"channel": "FAX"}, ["channel:enum"]),
        ({"location": None}, []),
        ({"location": "here"}, ["location:type"]),
        ({"location": {"latitude": 90, "longitude": -180, "extra": 1}}, []),
        ({"location": {"latitude": 90.5}}, ["location.longitude:required", "location.latitude:maximum"]),
        ({"metadata": {"ip_address": 5}}, ["metadata.ip_address:type"]),
        ({"metadata": {"ip_address": "999.1.1.1"}}, []),
        ({"x.y": 1}, ["$:additionalProperties"]),
        ({"transaction_id": "has blank"}, ["transaction_id:pattern"]),
        ({"transaction_id": "ends\n"}, []),
    ],
)
def test_transaction_schema(spark, change, errors):
    assert check(spark, builtin("transaction.schema.json"), [{**TXN, **change}]) == [(not errors, errors)]


def test_formats_are_annotations_unless_enforced(spark):
    schema = builtin("transaction.schema.json")
    messages = [{**TXN, "timestamp": "t"}, {**TXN, "metadata": {"ip_address": "10.0.0.256"}}, {**TXN, "metadata": {"ip_address": "10.0.0.25"}}]
    assert [ok for ok, _ in check(spark, schema, messages)] == [True, True, True]
    enforced = check(spark, schema, messages, enforce_formats=True)
    assert [e for _, e in enforced] == [["timestamp:format"], ["metadata.ip_address:format"], []]


def test_lengths_count_characters(spark):
    base = {"customer_id": "C", "last_name": "L", "email": "e", "account_status": "active", "created_at": "t"}
    names = ["", "é" * 100, "é" * 101]
    got = check(spark, builtin("crm_customer.schema.json"), [{**base, "first_name": n} for n in names])
    assert [e for _, e in got] == [["first_name:minLength"], [], ["first_name:maxLength"]]


def test_phone_pattern_knows_unicode_blanks(spark):
    base = {"customer_id": "C", "first_name": "F", "last_name": "L", "email": "e", "account_status": "active", "created_at": "t"}
    got = check(spark, builtin("crm_customer.schema.json"), [{**base, "phone_number": "+212 600-000"}, {**base, "phone_number": None}])
    assert [ok for ok, _ in got] == [True, True]


def test_duplicate_key_keeps_last_value(spark):
    text = json.dumps(TXN)[:-1] + ', "amount": -1}'
    assert check(spark, builtin("transaction.schema.json"), [text]) == [(False, ["amount:minimum"])]


def test_inline_avro(spark):
    got = check(spark, INLINE_AVRO, [
        {"transaction_id": "TX1001", "amount": 250.0, "status": "OK"}, {"transaction_id": 1234, "amount": "invalid", "status": 50},
        {"transaction_id": "T", "amount": 1}, {"transaction_id": "T", "amount": 1, "status": "s", "more": 1}, {},
    ], "t.avsc")
    assert [ok for ok, _ in got] == [True, False, False, False, False]
    assert got[1][1] == ["transaction_id:type", "amount:type", "status:type"]


@pytest.mark.parametrize(
    ("change", "ok"),
    [
        ({}, True), ({"amount": 1234567890123.45}, True), ({"amount": 12345678901234.5}, False), ({"amount": 1.005}, False),
        ({"amount": "7.25"}, True), ({"amount": "x"}, False), ({"status": None}, True), ({"status": 1}, False), ({"timestamp": 1.5}, False),
    ],
)
def test_transaction_avro(spark, change, ok):
    base = {"transaction_id": "T", "customer_id": "C", "account_id": "A", "transaction_type": "x", "amount": 1, "currency": "MAD", "timestamp": 1}
    assert check(spark, builtin("transaction.avsc"), [{**base, **change}], "t.avsc")[0][0] is ok


def test_avro_enum_int_and_boolean(spark):
    base = {
        "customer_id": "C", "scoring_request_id": "R", "credit_score": 700, "risk_level": "LOW", "approved_amount": 1,
        "interest_rate": 1.5, "scoring_timestamp": 1, "model_version": "v1",
    }
    got = check(spark, builtin("registry_scoring_result.avsc"), [base, {**base, "credit_score": 2**31}, {**base, "risk_level": "low"}], "s.avsc")
    assert [ok for ok, _ in got] == [True, False, False]


def test_every_builtin_compiles():
    for name in builtin_names():
        fields = Fields()
        try:
            assert rules_for(name, builtin(name), fields)
        except (AssertionError, AttributeError) as error:  # a session is needed for columns
            pytest.skip(f"no session: {error}")


def test_unknown_keyword_stops_the_job(spark):
    with pytest.raises(ValueError, match="oneOf"):
        check(spark, {"oneOf": []}, [{}])


def test_dispatch_and_catalogue(spark, tmp_path):
    file = tmp_path / "crm.json"
    file.write_text(json.dumps(INLINE))
    (tmp_path / "broken.json").write_text("{")
    found = load_catalogue({"a/crm.json": file, "lost.json": tmp_path / "none.json", "broken.json": tmp_path / "broken.json"})
    assert list(found) == ["a/crm.json"]
    with pytest.raises(FileNotFoundError):
        load_document(tmp_path / "none.json")
    good = json.dumps({"customer_id": "C", "email": "e"})
    paths = ["a/crm.json", "lost.json", "broken.json", "x.txt", "", None]
    df = spark.createDataFrame([(i, good, p) for i, p in enumerate(paths)], "i int, value string, schema_path string")
    assert [r["is_valid"] for r in validate_by_path(df, found).orderBy("i").collect()] == [True] + [False] * 5


def test_non_empty_object(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{}",), ("[1]",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(non_empty_object(F.col("v"))).collect()] == [True, False, False, False, False]


values = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.floats(-5, 5), st.text(max_size=4), st.lists(st.integers(), max_size=1))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["customer_id", "email", "age"]), values), min_size=20, max_size=20))
def test_inline_schema_against_plain_python(spark, records):
    def valid(r):
        if "customer_id" not in r or "email" not in r:
            return False
        if not all(isinstance(r[k], str) for k in ("customer_id", "email")):
            return False
        age = r.get("age", 0)
        return "age" not in r or (not isinstance(age, bool) and isinstance(age, (int, float)) and float(age).is_integer())

    assert [ok for ok, _ in check(spark, INLINE, records)] == [valid(r) for r in records]
