"""Joins, quality, compliance, matching, drift and dead letters on small rows."""

import datetime as dt
import json
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from custodia.functions.statistics import exact_quantiles, running_totals
from custodia.operators import compliance, customers, deadletter, drift, matching, quality
from custodia.sources import schemas
from custodia.streaming import mirror
from custodia.streaming.dead_letters import retry_message, triage_letters

AS_OF = dt.datetime(2024, 1, 31)


def as_of():
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


# --- statistics ---------------------------------------------------------------------------------


def test_exclusive_quantiles_equal_the_standard_library(spark):
    rng = random.Random(1)
    groups = {n: [rng.choice([1.0, 2.0, 3.5, rng.random() * 10]) for _ in range(n)] for n in (1, 2, 19, 20, 21, 99, 100, 101, 700)}
    df = spark.createDataFrame([(n, v) for n, vs in groups.items() for v in vs], "n int, v double")
    rows = exact_quantiles(df, "v", {"p95": (19, 20), "p99": (99, 100)}, ["n"]).collect()
    assert len(rows) == len(groups)
    for row in rows:
        vs = groups[row["n"]]
        p95 = statistics.quantiles(vs, n=20)[18] if len(vs) >= 20 else max(vs)
        p99 = statistics.quantiles(vs, n=100)[98] if len(vs) >= 100 else max(vs)
        assert math.isclose(row["p95"], p95) and math.isclose(row["p99"], p99)


def test_quantiles_of_one_hot_value_and_null_group(spark):
    df = spark.createDataFrame([(None, 7.0)] * 500 + [(None, 1.0), ("a", None), ("b", 2.0)], "g string, v double")
    rows = {r["g"]: r["q"] for r in exact_quantiles(df, "v", {"q": (1, 2)}, ["g"], "inclusive").collect()}
    assert rows == {None: 7.0, "b": 2.0}


def test_quantiles_without_rows(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantiles(empty, "v", {"q": (1, 2)}).collect()[0]["q"] is None


def test_running_totals_cross_partitions(spark):
    rows = [("a", float(i), 1) for i in range(200)] + [("b", float(i), 2) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, v double, n int").repartition(5)
    got = running_totals(df, ["g"], "v", {"cum": "n"}).collect()
    assert all(r["cum"] == (r["v"] + 1) * (1 if r["g"] == "a" else 2) for r in got) and len(got) == 250


# --- customers ----------------------------------------------------------------------------------

CUSTOMERS = [
    ("CUST001", "Ahmed", "ACTIVE"), ("CUST002", "Fatima", "ACTIVE"), ("CUST004", "Amina", "INACTIVE"), ("CUST007", "Karim", "SUSPENDED"),
]


def test_integration_keeps_multiplicity_and_drops_null_keys(spark):
    crm = spark.createDataFrame(
        [("A", "a", "t1"), ("A", "b", "t2"), (None, "n", "t1"), ("C", "c", "t1")], "customer_id string, first_name string, updated_at string"
    ).selectExpr("customer_id", "first_name", "'l' last_name", "'e' email", "'p' phone", "'addr' address", "updated_at")
    kyc = spark.createDataFrame([("A", "1", "v1"), ("A", "2", "v2"), (None, "3", "v1")], "customer_id string, id_number string, verified_at string").selectExpr(
        "customer_id", "'passport' id_type", "id_number", "'verified' verification_status", "'low' risk_level", "verified_at"
    )
    joined = customers.integrate(crm, kyc)
    assert joined.columns == customers.INTEGRATED_COLUMNS and joined.count() == 4
    latest = customers.integrate(crm, kyc, latest_only=True).collect()
    assert [(r["first_name"], r["id_number"]) for r in latest] == [("b", "2")]


def test_lookup_failures_drop_the_row(spark):
    def open_lookup():
        def lookup(key):
            if key == "bad":
                raise TimeoutError
            return None if key == "none" else json.dumps({"id": key})

        return lookup

    df = spark.createDataFrame([("a", 1), ("a", 2), ("bad", 3), ("none", 4)], "id string, n int")
    got = customers.enrich_by_lookup(df, "id", open_lookup, clock=as_of()).orderBy("n").collect()
    assert [(r["n"], r["kyc_response_json"]) for r in got] == [(1, '{"id": "a"}'), (2, '{"id": "a"}')]


def test_fold_is_idempotent_and_tombstones_delete(spark):
    log = spark.createDataFrame([("k", 1, "x", False), ("k", 3, None, True), ("m", 2, "y", False), ("m", 1, "z", False)], "id string, o int, s string, d boolean")
    once = customers.fold_changes(log, ["id"], [F.col("o")], F.col("d"))
    twice = customers.fold_changes(once, ["id"], [F.col("o")], F.col("d"))
    assert once.collect() == twice.collect() and [(r["id"], r["s"]) for r in once.collect()] == [("m", "y")]


def test_upsert_adds_columns_and_refuses_changed_types(spark):
    target = spark.createDataFrame([("k", 1, "old"), ("q", 1, "keep")], "id string, o int, s string")
    changes = spark.createDataFrame([("k", 2, "new", 5, False), ("q", 2, None, None, True)], "id string, o int, s string, extra int, is_delete boolean")
    assert [tuple(r) for r in mirror.upsert(target, changes, ["id"], "o").collect()] == [("k", 2, "new", 5)]
    with pytest.raises(ValueError, match="change type"):
        mirror.upsert(target, changes.withColumn("s", F.lit(1)), ["id"], "o")


def test_conform_defaults_and_money(spark):
    df = spark.createDataFrame([("1", "+1", None, 12.345)], "id string, phone_number string, currency string, amount double")
    row = schemas.to_money(schemas.with_defaults(schemas.conform(df), schemas.TRANSACTION_DEFAULTS)).first()
    assert row["customer_id"] == "1" and row["phone"] == "+1" and row["currency"] == "MAD" and str(row["amount"]) == "12.35"


# --- quality and compliance ---------------------------------------------------------------------


def test_constraints(spark):
    parent = spark.createDataFrame(CUSTOMERS, "customer_id string, first_name string, status string")
    child = spark.createDataFrame([("T1", "CUST001"), ("T2", "CUST999"), ("T3", None)], "transaction_id string, customer_id string")
    assert [r[0] for r in quality.orphans(child, parent, "customer_id", "customer_id").select("transaction_id").collect()] == ["T2"]
    assert quality.duplicate_keys(parent.unionByName(parent.limit(1)), ["customer_id"]).count() == 1
    assert quality.length_violations(parent, "customer_id", {"first_name": 5, "status": 8}).count() == 2
    amounts = spark.createDataFrame([(1.25,), (1.005,), (1e14,), (None,)], "a double")
    assert sorted(r[0] for r in quality.decimal_violations(amounts, "a").collect()) == [1.005, 1e14]


def test_completeness_counts_repeats(spark):
    sent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    got = spark.createDataFrame([(1,), (1,), (4,)], "id int")
    assert quality.completeness(sent, got, "id").first().asDict() == {"produced": 3, "consumed": 3, "missing": 2, "unexpected": 1, "complete": True}
    assert quality.completeness(sent, sent.limit(0), "id").first()["complete"] is False


def test_freshness_of_empty_table(spark):
    df = spark.createDataFrame([], "ts timestamp")
    assert quality.freshness(df, "ts", F.lit(AS_OF)).first()["is_fresh"] is False


def test_profile_of_all_null_feature(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "x double, y string")
    rows = {r["feature"]: r for r in quality.profile(df, ["x"], ["y"]).collect()}
    assert rows["x"]["q50"] == 2.0 and rows["y"]["missing"] == 2 and rows["y"]["distinct_values"] == 0
    quick = {r["feature"]: r for r in quality.profile(df, ["x"], ["y"], exact=False).collect()}
    assert quick["x"]["distinct_values"] == 2


def test_protection_and_logs(spark):
    df = spark.createDataFrame([("C1", "4111"), ("C2", None)], "id string, card string")
    assert compliance.in_clear(df, ["card"]).count() == 1
    assert compliance.in_clear(compliance.protect(df, ["card"]), ["card"]).count() == 0
    log = spark.createDataFrame(
        [(1, AS_OF, "read", "sensitive"), (None, AS_OF, "read", "sensitive"), (2, None, "read", "sensitive"), (None, AS_OF, "r", "public"), (None, dt.datetime(2024, 1, 1), "r", "sensitive")],
        "user_id int, access_ts timestamp_ntz, action string, data_type string",
    )
    gaps = compliance.access_log_gaps(log, as_of()).collect()
    assert sorted(g["errors"][0]["field"] for g in gaps) == ["timestamp", "user_id"]
    assert compliance.extra_columns(["customer_id", "age", "religion"], ["customer_id", "age", "income"]) == ["religion"]


# --- matching -----------------------------------------------------------------------------------


def test_match_within_against_brute_force(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    point = lambda: (rng.choice("ab"), start + dt.timedelta(seconds=rng.randrange(400), microseconds=rng.choice([0, 1, 999999])))
    asked = [(i, *point()) for i in range(80)] + [(100, "a", start + dt.timedelta(seconds=500)), (101, "a", start + dt.timedelta(seconds=500))]
    answered = [point() for _ in range(15)] + [("a", start + dt.timedelta(seconds=530))] * 2
    requests = spark.createDataFrame(asked, "request_id int, k string, ts timestamp")
    results = spark.createDataFrame(answered, "k string, ts timestamp")
    got = {r["request_id"]: r["result_ts"] for r in matching.match_within(requests, results, "k").collect()}
    assert len(got) == len(asked)
    for i, k, ts in asked:
        hits = [t for kk, t in answered if kk == k and ts <= t <= ts + dt.timedelta(seconds=30)]
        assert got[i] == (min(hits) if hits else None)


def test_reconcile_classes(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, s int")
    right = spark.createDataFrame([("a", 1), ("b", 3), ("d", 4), ("c", None)], "k string, s int")
    got = {r["k"]: r["mismatch"] for r in matching.reconcile(left, right, "k", ["s"]).collect()}
    assert got == {"b": "diff", "d": "missing_stored"}


def test_metric_regression(spark):
    current = spark.createDataFrame([("p95", 111.0), ("p99", 109.0), ("new", 1.0)], "metric string, value double")
    base = spark.createDataFrame([("p95", 100.0), ("p99", 100.0)], "metric string, value double")
    got = {r["metric"]: r["regressed"] for r in matching.metric_regression(current, base).collect()}
    assert got == {"p95": True, "p99": False, "new": False}


# --- drift --------------------------------------------------------------------------------------


def test_same_data_has_no_drift_and_disjoint_data_has(spark):
    ref = spark.range(1000).selectExpr("double(id) amount", "string(id % 3) currency")
    far = spark.range(1000).selectExpr("double(id + 5000) amount", "string(id % 3 + 7) currency")
    same = {r["measure"]: r["value"] for r in drift.drift_report(ref, ref, ["amount"], ["currency"]).collect()}
    assert same["ks"] == 0 and abs(same["psi"]) < 1e-9 and abs(same["js"]) < 1e-9
    report = drift.drift_report(ref, far, ["amount"], ["currency"])
    values = {r["measure"]: r["value"] for r in report.collect()}
    assert values["ks"] == 1 and values["psi"] > 1 and math.isclose(values["js"], 1)
    assert drift.dataset_verdict(report).first()["dataset_drift"]


# --- dead letters -------------------------------------------------------------------------------

SCHEMA = {"type": "object", "properties": {"customer_id": {"type": "string"}}, "required": ["customer_id"]}


def test_triage_routes_partition_the_letters(spark):
    good = {"payload": {"customer_id": "C"}, "schema_path": "c.json"}
    letters = [
        {**good, "retry_count": 0}, {**good, "retry_count": 2}, {**good, "retry_count": 3}, {**good, "retry_count": 5}, good,
        {"payload": {}, "schema_path": "c.json"}, {"schema_path": "c.json"}, {**good, "schema_path": "c.txt"}, {"payload": {"customer_id": "C"}},
        {**good, "payload": json.dumps({"customer_id": "C"})}, [1],
    ]
    texts = [json.dumps(x) for x in letters] + ["not json", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    routed = triage_letters(df, {"c.json": SCHEMA}, clock=as_of())
    got = [(r["route"], r["reason"], r["retry_count"]) for r in routed.collect()]
    invalid, undecodable = ("archive", "validation_failed", 0), ("archive", "undecodable", 0)
    assert got == [
        ("retry", None, 1), ("retry", None, 3), ("archive", "max_retry", 3), ("archive", "max_retry", 5), ("retry", None, 1),
        invalid, invalid, invalid, invalid, invalid, undecodable, undecodable, undecodable,
    ]
    again = json.loads(retry_message(routed).first()["value"])
    assert again == {"payload": {"customer_id": "C"}, "schema_path": "c.json", "retry_count": 1, "last_retry_at": "2024-01-31T00:00:00.000000"}
    archived = deadletter.to_archive(routed, clock=as_of())
    assert archived.count() + retry_message(routed).count() == len(texts)


def test_retry_then_archive_terminates(spark):
    text = json.dumps({"payload": {"customer_id": "C"}, "schema_path": "c.json"})
    df = spark.createDataFrame([(text,)], "value string")
    rounds = 0
    while True:
        routed = triage_letters(df, {"c.json": SCHEMA}, clock=as_of())
        if routed.first()["route"] == "archive":
            break
        text, rounds = retry_message(routed).first()["value"], rounds + 1
        df = spark.createDataFrame([(text,)], "value string")
    assert rounds == 3


@pytest.mark.parametrize(("count", "limit", "route", "wait"), [(0, 3, "retry", 1), (2, 3, "retry", 4), (5, 3, "dlq", None), (3, 2, "dlq", None), (None, 3, "retry", 1)])
def test_backoff_policy(spark, count, limit, route, wait):
    df = spark.createDataFrame([("C", count, AS_OF)], "customer_id string, retry_count int, ts timestamp_ntz")
    row = deadletter.schedule_retry(df, max_retries=limit).first()
    assert row["route"] == route and (row["reason"] == "MaxRetryExceeded") is (route == "dlq")
    assert row["next_retry_at"] == (AS_OF + dt.timedelta(seconds=wait) if wait else None)


def test_dead_letter_message(spark):
    df = spark.createDataFrame([('{"customer_id":"C001"}', 'Schema"Error')], "m string, r string")
    got = df.select(deadletter.dead_letter_message(F.col("m"), F.col("r"))).first()[0]
    assert json.loads(got) == {"original_message": {"customer_id": "C001"}, "reason": 'Schema"Error'}


def test_processability(spark):
    texts = ['{"transaction_id":"T1"}', '{"transaction_id":"xfailx"}', '{"transaction_id":null}', '{"transaction_id":5}', "{}", '{"transaction_id":""}', "x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = deadletter.attempt(df).orderBy("i").collect()
    assert [r["outcome"] for r in got] == ["processed", "dlq", "dlq", "dlq", "dlq", "processed", "dlq", "dlq"]
    assert [r["attempts"] for r in got] == [1, 3, 3, 3, 3, 1, 3, 3]


def test_depth_alert(spark):
    df = spark.createDataFrame([("a",), ("a",), ("c",)], "topic string")
    row = deadletter.alert(deadletter.depth(df, ["b", "a"])).first()
    assert row["alert"] and row["body"] == "2 messages en erreur dans le topic a"
    assert deadletter.alert(deadletter.depth(df, ["b"])).first().asDict() == {"alert": False, "body": "Aucun message en DLQ"}
