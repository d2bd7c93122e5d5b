"""Streams over landed files: restart, replay, poison messages, late markers."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from custodia.operators import customers
from custodia.plans import jobs
from custodia.sources import readers, writers
from custodia.sources.schemas import TRANSACTION_STREAM
from custodia.streaming import dead_letters, ingest, mirror

TS = dt.datetime(2024, 1, 1)


def land(spark, path, texts, first=0, topic="transactions"):
    rows = [(bytearray(t.encode()) if t is not None else None, topic, 0, first + i, TS) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "value binary, topic string, partition int, offset bigint, timestamp timestamp")
    df.select(F.lit(None).cast("binary").alias("key"), "*").write.mode("append").parquet(path)


def txn(i):
    return json.dumps({"transaction_id": f"T{i}", "customer_id": "C", "amount": i, "currency": "MAD", "timestamp": "2024-01-01T00:00:00Z"})


def test_restart_adds_nothing_and_new_files_are_read_once(spark, tmp_path):
    source, out, dead, ckpt = (str(tmp_path / n) for n in ("in", "out", "dead", "ckpt"))
    land(spark, source, [txn(1), "not json", None, txn(2)])
    run = lambda: jobs.topic_to_lake(readers.stream_landed(spark, source), TRANSACTION_STREAM, out, ckpt, dead).awaitTermination()
    run()
    run()
    assert spark.read.parquet(out).count() == 2
    assert sorted(r["offset"] for r in spark.read.parquet(dead).collect()) == [1, 2]
    land(spark, source, [txn(3)], first=4)
    run()
    assert sorted(r["transaction_id"] for r in spark.read.parquet(out).collect()) == ["T1", "T2", "T3"]


def test_null_row_mode(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    land(spark, source, [txn(1), "not json"])
    ingest.ingest(readers.stream_landed(spark, source), TRANSACTION_STREAM, out, ckpt, "null_row").awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 2 and rows.filter("transaction_id IS NULL").count() == 1 and "ingestion_time" in rows.columns
    with pytest.raises(ValueError, match="on_malformed"):
        ingest.ingest(readers.stream_landed(spark, source), TRANSACTION_STREAM, out, ckpt, "ignore")


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(5)
    for _ in range(2):
        ingest.write_batch(rows, path, 0)
    ingest.write_batch(rows, path, 1)
    assert spark.read.parquet(path).count() == 10


def test_poison_message_does_not_stop_processing(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    land(spark, source, [txn(1), "{", None, '{"transaction_id":"fail1"}'])
    dead_letters.process_stream(readers.stream_landed(spark, source), out, ckpt).awaitTermination()
    got = {r["offset"]: (r["outcome"], r["attempts"]) for r in spark.read.parquet(out).collect()}
    assert got == {0: ("processed", 1), 1: ("dlq", 3), 2: ("dlq", 3), 3: ("dlq", 3)}


def test_mirror_over_two_runs(spark, tmp_path):
    source, out, objects, ckpt = (str(tmp_path / n) for n in ("in", "out", "objects", "ckpt"))

    def send(rows, first):
        df = spark.createDataFrame([(bytearray(k.encode()), bytearray(v.encode()) if v else None, "crm", 0, first + i, TS) for i, (k, v) in enumerate(rows)], readers.ENVELOPE)
        df.write.mode("append").parquet(source)
        for q in jobs.mirror_changes(readers.stream_landed(spark, source), customer_schema(), out, objects, ckpt, ["key"]):
            q.awaitTermination()

    send([("a", '{"name":"x"}'), ("b", '{"before":null,"after":{"name":"y"}}'), ("a", '{"name":"z"}')], 0)
    send([("b", None), ("c", '{"name":"w"}')], 3)
    state = mirror.read_mirror(spark, out, ["key"], "offset")
    assert sorted((bytes(r["key"]).decode(), r["name"]) for r in state.collect()) == [("a", "z"), ("c", "w")]
    mirror.fold_mirror(spark, out, str(tmp_path / "folded"), ["key"], "offset")
    folded = mirror.read_mirror(spark, str(tmp_path / "folded"), ["key"], "offset")
    assert sorted(map(str, folded.collect())) == sorted(map(str, state.collect()))
    assert spark.read.parquet(objects).count() == 5


def test_mirror_goes_on_after_a_fold_and_refuses_what_it_cannot_apply(spark, tmp_path):
    source, out, folded, bad = (str(tmp_path / n) for n in ("in", "out", "folded", "bad"))

    def send(rows, first, target, ckpt):
        df = spark.createDataFrame([(bytearray(k.encode()) if k else None, bytearray(v.encode()) if v else None, "crm", 0, first + i, TS) for i, (k, v) in enumerate(rows)], readers.ENVELOPE)
        df.write.mode("append").parquet(source)
        for q in jobs.mirror_changes(readers.stream_landed(spark, source), customer_schema(), target, str(tmp_path / f"objects_{ckpt}"), str(tmp_path / ckpt), ["key"], bad):
            q.awaitTermination()

    send([("a", '{"name":"x"}'), ("b", '{"name":"y"}'), ("a", '{"name":'), (None, '{"name":"q"}')], 0, out, "c1")
    state = mirror.read_mirror(spark, out, ["key"], "offset")
    assert sorted((bytes(r["key"]).decode(), r["name"]) for r in state.collect()) == [("a", "x"), ("b", "y")]
    assert sorted((r["offset"], r["rule"]) for r in spark.read.parquet(bad).collect()) == [(2, "undecodable"), (3, "no_key")]
    mirror.fold_mirror(spark, out, folded, ["key"], "offset")
    send([("c", '{"name":"z"}')], 4, folded, "c2")
    state = mirror.read_mirror(spark, folded, ["key"], "offset")
    assert sorted((bytes(r["key"]).decode(), r["name"]) for r in state.collect()) == [("a", "x"), ("b", "y"), ("c", "z")]


def customer_schema():
    from pyspark.sql import types as T

    return T.StructType([T.StructField("name", T.StringType())])


def test_dedup_within_the_watermark(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    land(spark, source, [txn(1), txn(2)])
    land(spark, source, [txn(1), txn(2)])
    unique = ingest.deduplicated(readers.stream_landed(spark, source), ["offset"], "timestamp")
    ingest.append_stream(unique, out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_correlation_edges(spark, tmp_path):
    def write(name, rows):
        path = str(tmp_path / name)
        df = spark.createDataFrame([(i, k, TS + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(rows)], "id int, k string, ts timestamp")
        df.write.parquet(path)
        return spark.readStream.schema(df.schema).parquet(path)

    far = ("end", 10**9)
    asked = write("q", [("a", 0), ("a", 29.5), ("a", 31), ("b", 10), ("b", 45), far])
    answered = write("r", [("a", 30), ("a", 59.5), ("b", 9), ("b", 75.000001), far])
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    ingest.append_stream(ingest.correlated(asked, answered, "k"), out, ckpt).awaitTermination()
    got = {r["id"]: r["status"] for r in spark.read.parquet(out).collect()}
    assert got == {0: "answered", 1: "answered", 2: "answered", 3: "timeout", 4: "timeout"}


def test_await_all_raises_the_first_failure(spark, tmp_path):
    source = str(tmp_path / "in")
    land(spark, source, [txn(1)])
    stream = readers.stream_landed(spark, source)

    def boom(batch, number):
        raise RuntimeError("sink is down")

    good = ingest.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "c1"))
    bad = ingest.each_batch(stream, boom, str(tmp_path / "c2"))
    with pytest.raises(Exception, match="sink is down"):
        ingest.await_all([good, bad])


def test_polled_responses_and_console(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"customer_id":"C1"}\n{"customer_id":"C2"}\n')
    stream = readers.stream_responses(spark, str(tmp_path / "in"))
    assert stream.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    ingest.append_stream(stream.select(F.col("value").cast("string").alias("v"), "topic"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert {r["topic"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"kyc_responses"}
    ingest.console_stream(stream).awaitTermination()


# --- sources and sinks --------------------------------------------------------------------------

KYC = [
    {"customer_id": "CUST001", "kyc_status": "VERIFIED", "risk_score": 0.15, "documents_verified": True, "verification_date": 1730419200000},
    {"customer_id": "CUST004", "kyc_status": "PENDING", "risk_score": 0.45, "documents_verified": False, "verification_date": 1730678400000},
]


def test_json_array_documents(spark, tmp_path):
    (tmp_path / "kyc.json").write_text(json.dumps(KYC, indent=2))
    rows = readers.read_kyc_documents(spark, str(tmp_path / "kyc.json")).orderBy("customer_id").collect()
    assert rows[0]["verification_date"] == dt.datetime(2024, 11, 1) and rows[1]["documents_verified"] is False
    requests = [{"customer_id": "CUST001", "features": {"age": 35, "debt_ratio": 0.25}}]
    (tmp_path / "req.json").write_text(json.dumps(requests))
    row = readers.read_scoring_requests(spark, str(tmp_path / "req.json")).first()
    assert row["features"] == {"age": 35.0, "debt_ratio": 0.25} and row["model_version"] is None


def test_warehouse_null_level_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "w")
    df = spark.createDataFrame([("a", "low"), ("b", None)], "customer_id string, risk_level string")
    for _ in range(2):
        writers.overwrite_warehouse(df, path)
    assert spark.read.parquet(path).count() == 2
    assert (tmp_path / "w" / "risk_level=__HIVE_DEFAULT_PARTITION__").is_dir()


def test_a_failed_write_leaves_the_old_warehouse(spark, tmp_path):
    path = str(tmp_path / "w")
    writers.overwrite_warehouse(spark.createDataFrame([("a", "low")], "customer_id string, risk_level string"), path)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("bad row"))).otherwise(F.lit("x")).cast("string").alias("customer_id"), F.lit("low").alias("risk_level"))
    with pytest.raises(Exception, match="bad row"):
        writers.overwrite_warehouse(broken, path)
    assert [r["customer_id"] for r in spark.read.parquet(path).collect()] == ["a"]


def test_counts_of_empty_feeds_are_zero(spark, tmp_path):
    crm = spark.createDataFrame([], "customer_id string, first_name string, last_name string, email string, phone string, address string, updated_at string")
    kyc = spark.createDataFrame([], "customer_id string, id_type string, id_number string, verification_status string, risk_level string, verified_at string")
    counts = jobs.integrate_to_warehouse(crm, kyc, str(tmp_path / "w"))
    assert counts == {"crm": 0, "kyc": 0, "integrated": 0}
    with pytest.raises(ValueError, match="0 of 0"):
        jobs.gated_integration(crm, kyc, str(tmp_path / "w"), str(tmp_path / "n"), min_valid_share=0.1)


def test_audit_row_of_each_write(spark, tmp_path):
    path, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    assert writers.append_audited(spark.range(5), path, audit, "t", 1) == 5
    assert writers.append_audited(spark.range(5).filter("false"), path, audit, "t", 2) == 0
    assert sorted((r["batch_id"], r["table_name"], r["row_count"]) for r in spark.read.parquet(audit).collect()) == [(1, "t", 5), (2, "t", 0)]


def test_blank_lines_are_dead_letters(spark, tmp_path):
    source, out, dead = (str(tmp_path / n) for n in ("in", "out", "dead"))
    land(spark, source, [txn(1), "", " \t"])
    ingest.ingest(readers.stream_landed(spark, source), TRANSACTION_STREAM, out, str(tmp_path / "c"), dead_letters=dead).awaitTermination()
    assert spark.read.parquet(out).count() == 1
    assert sorted(r["offset"] for r in spark.read.parquet(dead).filter("error.rule = 'undecodable'").collect()) == [1, 2]


def test_report_file_and_merge_text(spark, tmp_path):
    writers.write_report(spark.createDataFrame([(1, "x")], "a int, b string"), str(tmp_path / "r"))
    assert [json.loads(p.read_text()) for p in (tmp_path / "r").glob("part-*")] == [{"a": 1, "b": "x"}]
    text = writers.merge_statement("dw.customers", "staged", ["id"], ["id", "name"], "is_delete")
    assert text == (
        "MERGE INTO dw.customers t USING staged s ON t.id = s.id WHEN MATCHED AND s.is_delete THEN DELETE"
        " WHEN MATCHED THEN UPDATE SET name = s.name WHEN NOT MATCHED AND NOT s.is_delete THEN INSERT (id, name) VALUES (s.id, s.name)"
    )


def test_connector_options(spark):
    assert readers.kafka_options("b:9092", ["x", "y"]) == {"kafka.bootstrap.servers": "b:9092", "subscribe": "x,y", "startingOffsets": "earliest"}
    options = readers.jdbc_options("jdbc:x", "crm.customers", "id", 0, 9, 4, user="u")
    assert options["numPartitions"] == "4" and options["user"] == "u"


def test_first_messages_takes_at_least_one(spark, tmp_path):
    land(spark, str(tmp_path / "in"), [txn(1), txn(2), txn(3)])
    rows = readers.read_landed(spark, str(tmp_path / "in"))
    assert readers.first_messages(rows, 0).count() == 1 and readers.first_messages(rows, 10).count() == 3


def test_http_lookup_is_built_without_a_call():
    assert callable(customers.http_lookup("http://localhost:1/check")())
