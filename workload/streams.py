"""Streaming queries: messages land as files, a query drains them, its sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.contracts import builtin
from custodia.plans import jobs
from custodia.session import state_partitions
from custodia.sources import readers
from custodia.sources.schemas import TRANSACTION_STREAM
from custodia.streaming import dead_letters, ingest, mirror
from workload.records import PARSED, TXN_ERRORS, TXN_SCHEMA
from workload.registry import query
from workload.service import LETTERS, catalogue
from workload.sinks import envelope
from workload.tables import as_of


def landed(d, messages):
    """Land messages as files in envelope shape and open them as a stream."""
    path = d.scratch()
    messages.write.parquet(path)
    return readers.stream_landed(d.spark, path)


def drain(*queries):
    for running in queries:
        running.awaitTermination()


@query("stream_ingest_null_rows", f"WITH {PARSED} SELECT transaction_id, customer_id, amount, currency, ts FROM p", "txn_msg")
def stream_ingest_null_rows(d):
    path, checkpoint = d.scratch(), d.scratch()
    stream = landed(d, envelope(d))
    drain(ingest.ingest(stream, TRANSACTION_STREAM, path, checkpoint, "null_row", clock=as_of()))
    rows = d.spark.read.parquet(path)
    return rows.select("transaction_id", "customer_id", "amount", "currency", F.col("timestamp").cast("timestamp_ntz").alias("ts"))


@query(
    "stream_ingest_roundtrip",
    f"""WITH {PARSED}
    SELECT 'lake' AS sink, NULL::DOUBLE AS "offset", transaction_id, amount, NULL AS rule FROM p WHERE j IS NOT NULL AND NOT coalesce(bad_field, false)
    UNION ALL SELECT 'dead', msg_offset::DOUBLE, NULL, NULL, CASE WHEN value IS NULL THEN 'null_message' ELSE 'undecodable' END
    FROM p WHERE j IS NULL OR bad_field""",
    "txn_msg",
)
def stream_ingest_roundtrip(d):
    path, dead, checkpoint = d.scratch(), d.scratch(), d.scratch()
    drain(jobs.topic_to_lake(landed(d, envelope(d)), TRANSACTION_STREAM, path, checkpoint, dead, clock=as_of()))
    good = d.spark.read.parquet(path).select(
        F.lit("lake").alias("sink"), F.lit(None).cast("double").alias("offset"), "transaction_id", "amount", F.lit(None).cast("string").alias("rule")
    )
    bad = d.spark.read.parquet(dead).select(
        F.lit("dead").alias("sink"), F.col("offset").cast("double").alias("offset"), F.lit(None).cast("string").alias("transaction_id"),
        F.lit(None).cast("double").alias("amount"), F.col("error.rule").alias("rule"),
    )
    return good.unionByName(bad)


@query(
    "stream_validation_flags",
    f"WITH {TXN_ERRORS} SELECT msg_offset AS \"offset\", msg_offset NOT IN (SELECT msg_offset FROM found) AS is_valid FROM txn_msg",
    "txn_msg",
)
def stream_validation_flags(d):
    path, checkpoint = d.scratch(), d.scratch()
    flagged = dead_letters.flagged(landed(d, envelope(d)), TXN_SCHEMA, builtin("transaction.schema.json"))
    drain(ingest.append_stream(flagged.select("offset", "is_valid"), path, checkpoint))
    return d.spark.read.parquet(path)


@query(
    "stream_process_with_retry",
    """WITH d AS (SELECT msg_offset, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM txn_msg),
    p AS (SELECT coalesce(json_type(j, '$.transaction_id') = 'VARCHAR' AND NOT contains(json_extract_string(j, '$.transaction_id'), 'fail'), false) AS ok FROM d)
    SELECT CASE WHEN ok THEN 'processed' ELSE 'dlq' END AS outcome, CASE WHEN ok THEN 1 ELSE 3 END AS attempts, count(*) AS messages FROM p GROUP BY ALL""",
    "txn_msg",
)
def stream_process_with_retry(d):
    path, checkpoint = d.scratch(), d.scratch()
    drain(dead_letters.process_stream(landed(d, envelope(d)), path, checkpoint))
    return d.spark.read.parquet(path).groupBy("outcome", "attempts").agg(F.count("*").alias("messages"))


@query(
    "stream_dlq_roundtrip",
    f"""WITH {LETTERS}
    SELECT 'retry' AS sink, concat('retry_count ', n + 1) AS item, count(*) AS messages FROM l WHERE decodable AND ok AND n < 3 GROUP BY n
    UNION ALL SELECT 'archive', CASE WHEN NOT decodable THEN 'undecodable' WHEN NOT ok THEN 'Validation échouée' ELSE 'Max retry atteint' END, count(*)
    FROM l WHERE NOT (decodable AND ok AND n < 3) GROUP BY ALL""",
    "txn_msg",
)
def stream_dlq_roundtrip(d):
    retry, archive, checkpoint = d.scratch(), d.scratch(), d.scratch()
    letters = d.view("letters")
    shaped = readers.landed_envelope(letters, "dlq.transactions", F.col("value"), F.col("msg_offset"), as_of())
    stream = landed(d, shaped).select("value")
    drain(jobs.triage(stream, catalogue(), retry, archive, checkpoint, clock=as_of()))
    again = d.spark.read.parquet(retry).select(
        F.lit("retry").alias("sink"), F.concat(F.lit("retry_count "), F.get_json_object("value", "$.retry_count")).alias("item")
    )
    kept = d.spark.read.parquet(archive).select(F.lit("archive").alias("sink"), F.col("error_reason").alias("item"))
    return again.unionByName(kept).groupBy("sink", "item").agg(F.count("*").alias("messages"))


@query(
    "stream_replay_dedup",
    "SELECT msg_offset AS \"offset\", sent_at FROM txn_msg",
    "txn_msg",
)
def stream_replay_dedup(d):
    path, checkpoint = d.scratch(), d.scratch()
    messages = envelope(d)
    stream = landed(d, messages.unionByName(messages))
    # An offset is unique only within its topic and partition.
    key = ["topic", "partition", "offset"]
    unique = ingest.deduplicated(stream.select(*key, "timestamp"), key, "timestamp")
    with state_partitions(d.spark):
        drain(ingest.append_stream(unique, path, checkpoint))
    return d.spark.read.parquet(path).select("offset", F.col("timestamp").cast("timestamp_ntz").alias("sent_at"))


def changes(d):
    """Change messages with their keys; a tombstone has no body, so the key names the row."""
    m = d.view("cdc_msg")
    shaped = readers.landed_envelope(m, "crm_customers", F.col("value"), F.col("msg_offset"), as_of())
    keyed = shaped.drop("key").join(m.select(F.col("msg_offset").alias("offset"), F.col("msg_key").cast("binary").alias("key")), "offset")
    return keyed.select("key", "value", "topic", "partition", "offset", "timestamp")


def mirrored(d, messages, path, **options):
    drain(*jobs.mirror_changes(landed(d, messages), "status string", path, d.scratch(), d.scratch(), ["key"], **options))


def state(d, path):
    return mirror.read_mirror(d.spark, path, ["key"], "offset").select(F.col("key").cast("string").alias("id"), "status")


def state_sql(where: str = "true") -> str:
    return f"""SELECT id, after_status AS status FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY msg_offset DESC) AS n
      FROM (SELECT msg_offset, id, CASE WHEN after_status = 'view' THEN NULL ELSE after_status END AS after_status FROM cdc WHERE {where}))
    WHERE n = 1 AND after_status IS NOT NULL"""


@query("stream_change_mirror", state_sql(), "cdc")
def stream_change_mirror(d):
    path = d.scratch()
    mirrored(d, changes(d), path)
    return state(d, path)


@query("mirror_fold_resume", state_sql(), "cdc")
def mirror_fold_resume(d):
    """Half of the changes are mirrored and folded; the folded mirror goes on with the other half."""
    first, folded = d.scratch(), d.scratch()
    messages = changes(d)
    mirrored(d, messages.filter(F.col("offset") % 2 == 0), first)
    mirror.fold_mirror(d.spark, first, folded, ["key"], "offset")
    mirrored(d, messages.filter(F.col("offset") % 2 == 1), folded)
    return state(d, folded)


@query(
    "stream_change_rejects",
    f"""{state_sql("msg_offset % 37 <> 0 AND msg_offset % 41 <> 0")}
    UNION ALL SELECT 'undecodable', count(*)::VARCHAR FROM cdc WHERE msg_offset % 37 = 0
    UNION ALL SELECT 'no_key', count(*)::VARCHAR FROM cdc WHERE msg_offset % 37 <> 0 AND msg_offset % 41 = 0""",
    "cdc",
)
def stream_change_rejects(d):
    """Cut messages and messages without a key go to dead letters and leave the mirror as it is."""
    path, dead = d.scratch(), d.scratch()
    cut = F.when(F.col("offset") % 37 == 0, F.lit('{"id":"K').cast("binary")).otherwise(F.col("value"))
    key = F.when(F.col("offset") % 41 != 0, F.col("key"))
    mirrored(d, changes(d).withColumns({"value": cut, "key": key}), path, dead_letters_path=dead)
    rejected = d.spark.read.parquet(dead).groupBy(F.col("rule").alias("id")).agg(F.count("*").cast("string").alias("status"))
    return state(d, path).unionByName(rejected)


@query(
    "stream_polled_responses",
    f"""WITH {PARSED} SELECT 'lake' AS sink, count(*) AS messages FROM p WHERE j IS NOT NULL AND NOT coalesce(bad_field, false)
    UNION ALL SELECT 'undecodable', count(*) FROM p WHERE j IS NULL OR bad_field""",
    "txn_msg",
)
def stream_polled_responses(d):
    """Responses that land as lines, read on an interval; the query is stopped after its data."""
    source, path, dead = d.scratch(), d.scratch(), d.scratch()
    d.view("txn_msg").select(F.coalesce("value", F.lit(""))).write.text(source)
    responses = readers.stream_responses(d.spark, source)
    running = ingest.ingest(responses, TRANSACTION_STREAM, path, d.scratch(), dead_letters=dead, interval="1 second", clock=as_of())
    running.processAllAvailable()
    running.stop()
    good = d.spark.read.parquet(path).select(F.lit("lake").alias("sink"))
    bad = d.spark.read.parquet(dead).select(F.col("error.rule").alias("sink"))
    return good.unionByName(bad).groupBy("sink").agg(F.count("*").alias("messages"))


@query(
    "stream_shared_dead_letters",
    f"""WITH {PARSED} SELECT topic, count(*) AS messages FROM p, (VALUES ('crm_a'), ('crm_b')) s(topic) WHERE j IS NULL OR bad_field GROUP BY topic""",
    "txn_msg",
)
def stream_shared_dead_letters(d):
    """Two feeds with checkpoints of their own and one dead-letter table."""
    dead = d.scratch()
    for topic in ("crm_a", "crm_b"):
        messages = landed(d, envelope(d).withColumn("topic", F.lit(topic)))
        drain(ingest.ingest(messages, TRANSACTION_STREAM, d.scratch(), d.scratch(), dead_letters=dead))
    return d.spark.read.parquet(dead).groupBy("topic").agg(F.count("*").alias("messages"))


@query(
    "stream_request_result_match",
    """SELECT q.request_id, CASE WHEN count(r.ts) > 0 THEN 'answered' ELSE 'timeout' END AS status
    FROM requests q LEFT JOIN results r ON q.customer_id = r.customer_id AND r.ts BETWEEN q.ts AND q.ts + INTERVAL 30 SECOND
    GROUP BY q.request_id""",
    "requests results",
)
def stream_request_result_match(d):
    def as_stream(name: str):
        rows = d.view(name).withColumn("ts", F.col("ts").cast("timestamp"))
        # A late end marker moves the watermark past every real row; it is not emitted itself.
        end = rows.limit(1).select(
            F.lit(-1).cast("bigint").alias("request_id"), F.lit("END").alias("customer_id"), F.timestamp_seconds(F.lit(4102444800)).alias("ts")
        )
        path = d.scratch()
        rows.unionByName(end).write.parquet(path)
        return d.spark.readStream.schema(rows.schema).parquet(path)

    path, checkpoint = d.scratch(), d.scratch()
    matched = ingest.correlated(as_stream("requests"), as_stream("results"), "customer_id")
    with state_partitions(d.spark):
        drain(ingest.append_stream(matched, path, checkpoint))
    return d.spark.read.parquet(path).select("request_id", "status")


@query(
    "stream_fan_out",
    "SELECT sink, count(*) AS messages FROM txn_msg, (VALUES ('raw'), ('audit')) s(sink) GROUP BY sink",
    "txn_msg",
)
def stream_fan_out(d):
    raw, audit, checkpoint = d.scratch(), d.scratch(), d.scratch()
    sinks = {
        "raw": lambda batch, i: ingest.write_batch(batch, raw, i),
        "audit": lambda batch, i: ingest.write_batch(batch.select("topic", "offset"), audit, i),
    }
    drain(ingest.fan_out(landed(d, envelope(d)), sinks, checkpoint))
    frames = [d.spark.read.parquet(p).select(F.lit(n).alias("sink")) for n, p in (("raw", raw), ("audit", audit))]
    return frames[0].unionByName(frames[1]).groupBy("sink").agg(F.count("*").alias("messages"))


@query(
    "ingest_validate_retry_chain",
    f"""WITH {TXN_ERRORS}
    SELECT 'valid' AS step, count(*) AS messages FROM txn_msg WHERE msg_offset NOT IN (SELECT msg_offset FROM found)
    UNION ALL SELECT 'dead', count(DISTINCT msg_offset) FROM found UNION ALL SELECT 'archived', count(DISTINCT msg_offset) FROM found""",
    "txn_msg",
)
def ingest_validate_retry_chain(d):
    """The messages land in two parts and the chain runs after each."""
    folder, source = d.scratch(), d.scratch()
    for part in (0, 1):
        envelope(d).filter(F.col("offset") % 2 == part).write.mode("append").parquet(source)
        stream = readers.stream_landed(d.spark, source)
        jobs.ingest_validate_retry(stream, TXN_SCHEMA, builtin("transaction.schema.json"), folder, catalogue(), clock=as_of())
    validated = d.spark.read.parquet(f"{folder}/validated").select(F.col("outcome").alias("step"))
    archived = d.spark.read.parquet(f"{folder}/archive").select(F.lit("archived").alias("step"))
    return validated.unionByName(archived).groupBy("step").agg(F.count("*").alias("messages"))
