"""Files, tables and messages: what is written is read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.contracts import builtin
from custodia.functions.schema_dispatch import validate_messages
from custodia.operators import customers
from custodia.plans import jobs
from custodia.sources import compaction, readers, writers
from workload.records import PARSED, TXN_ERRORS, TXN_SCHEMA, ntz
from workload.registry import query
from workload.tables import as_of


def envelope(d):
    """Transaction messages in the shape of topic messages."""
    m = d.view("txn_msg")
    return readers.landed_envelope(m, "transactions", F.col("value"), F.col("msg_offset"), F.col("sent_at"))


@query(
    "crm_csv_scan",
    # An empty value in a CSV file loads as null.
    "SELECT customer_id, first_name, email, nullif(phone, '') AS phone, TRY_CAST(updated_at AS TIMESTAMP) AS updated_at FROM crm",
    "crm",
)
def crm_csv_scan(d):
    path = d.scratch()
    rows = d.view("crm").drop("c_custkey")
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_crm(d.spark, path).select("customer_id", "first_name", "email", "phone", ntz("updated_at"))


@query(
    "kyc_csv_scan",
    "SELECT customer_id, id_type, id_number, verification_status, risk_level, CAST(verified_at AS TIMESTAMP) AS verified_at FROM kyc",
    "kyc",
)
def kyc_csv_scan(d):
    path = d.scratch()
    d.view("kyc").drop("c_custkey", "rep").write.option("header", True).csv(path)
    return readers.read_kyc(d.spark, path).withColumn("verified_at", F.col("verified_at").cast("timestamp_ntz"))


@query(
    "first_messages",
    "SELECT msg_offset AS \"offset\", value FROM txn_msg ORDER BY msg_offset LIMIT 10",
    "txn_msg",
)
def first_messages(d):
    return readers.first_messages(envelope(d), 10).select("offset", F.col("value").cast("string").alias("value"))


@query(
    "warehouse_roundtrip",
    """SELECT c.customer_id, c.email, k.id_number, k.risk_level FROM crm c JOIN kyc k ON c.customer_id = k.customer_id""",
    "crm kyc",
)
def warehouse_roundtrip(d):
    path = d.scratch()
    writers.overwrite_warehouse(customers.integrate(d.view("crm"), d.view("kyc")), path)
    return readers.read_table(d.spark, path).select("customer_id", "email", "id_number", "risk_level")


@query(
    "warehouse_stage_counts",
    """SELECT 'crm' AS stage, count(*) AS row_count FROM crm UNION ALL SELECT 'kyc', count(*) FROM kyc
    UNION ALL SELECT 'integrated', count(*) FROM crm c JOIN kyc k ON c.customer_id = k.customer_id""",
    "crm kyc",
)
def warehouse_stage_counts(d):
    counts = jobs.integrate_to_warehouse(d.view("crm"), d.view("kyc"), d.scratch())
    return d.spark.createDataFrame(list(counts.items()), "stage string, row_count bigint")


@query(
    "lake_append",
    """SELECT c.customer_id, 1 AS batch FROM crm c JOIN kyc k ON c.customer_id = k.customer_id
    UNION ALL SELECT c.customer_id, 2 FROM crm c JOIN kyc k ON c.customer_id = k.customer_id""",
    "crm kyc",
)
def lake_append(d):
    path = d.scratch()
    joined = customers.integrate(d.view("crm"), d.view("kyc")).select("customer_id")
    for batch in (1, 2):
        writers.append_table(joined.withColumn("batch", F.lit(batch)), path)
    return readers.read_table(d.spark, path)


@query(
    "evolved_table",
    """SELECT transaction_id, amount, NULL::VARCHAR AS currency FROM txn UNION ALL SELECT transaction_id, amount, currency FROM txn""",
    "txn",
)
def evolved_table(d):
    path = d.scratch()
    rows = d.view("txn")
    writers.append_table(rows.select("transaction_id", "amount"), path)
    writers.append_table(rows.select("transaction_id", "amount", "currency"), path)
    return readers.read_table(d.spark, path, merge_schema=True).select("transaction_id", "amount", "currency")


@query(
    "object_store_files",
    "SELECT 'transactions' AS topic, count(*) AS messages, 0 AS files_over_limit FROM txn_msg",
    "txn_msg",
)
def object_store_files(d):
    path = d.scratch()
    writers.write_objects(envelope(d), path)
    per_file = d.spark.read.parquet(path).groupBy("topic", F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return per_file.groupBy("topic").agg(
        F.sum("n").alias("messages"), F.count_if(F.col("n") > writers.ROWS_PER_FILE).alias("files_over_limit")
    )


@query(
    "compacted_table",
    "SELECT o_orderkey, o_orderstatus FROM orders",
)
def compacted_table(d):
    source, target = d.scratch(), d.scratch()
    d.table("orders").select("o_orderkey", "o_orderstatus").repartition(16).write.partitionBy("o_orderstatus").parquet(source)
    writers.compact_table(d.spark, source, target)
    return d.spark.read.parquet(target)


@query(
    "compaction_plan",
    """SELECT o_orderstatus, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(0 AS BIGINT) AS files_to_pack,
      true AS fewer_files FROM orders GROUP BY 1""",
)
def compaction_plan(d):
    """A table of many small files, compacted in its place until no two files of a folder go together."""
    path = d.scratch()
    d.table("orders").select("o_orderkey", "o_orderstatus").repartition(24).write.partitionBy("o_orderstatus").parquet(path)
    before = compaction.data_files(d.spark, path).count()
    while compaction.compact_small_files(d.spark, path):
        pass
    files = compaction.data_files(d.spark, path)
    left = compaction.compaction_plan(files).agg(F.count("*").alias("files_to_pack"))
    counts = files.agg((F.count("*") < before).alias("fewer_files"))
    rows = d.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("keys"))
    return rows.crossJoin(F.broadcast(left)).crossJoin(F.broadcast(counts))  # one row each


@query(
    "published_messages",
    """SELECT customer_id AS key, concat('{"customer_id":"', customer_id, '","verification_status":"', verification_status, '"}') AS value,
      'kyc_responses' AS topic FROM kyc""",
    "kyc",
)
def published_messages(d):
    rows = d.view("kyc").select("customer_id", "verification_status")
    return writers.as_messages(rows, "kyc_responses", "customer_id")


@query(
    "landed_messages",
    "SELECT topic, payload AS value FROM dlq",
    "dlq",
)
def landed_messages(d):
    path = d.scratch()
    writers.land_messages(d.view("dlq").select("topic", F.col("payload").alias("value")), path)
    return d.spark.read.json(path).select("topic", "value")


@query(
    "quarantined_messages",
    f"""WITH {PARSED}
    SELECT 'transactions' AS topic, msg_offset AS "offset", value, 'parse' AS stage,
      CASE WHEN value IS NULL THEN 'null_message' ELSE 'undecodable' END AS rule FROM p WHERE j IS NULL""",
    "txn_msg",
)
def quarantined_messages(d):
    messages = envelope(d)
    text = F.col("value").cast("string")
    bad = messages.filter(F.try_parse_json(text).isNull())
    rule = F.when(F.col("value").isNull(), "null_message").otherwise("undecodable")
    rows = writers.quarantine(bad, "parse", rule, F.lit("not JSON"))
    return rows.select("topic", "offset", "value", "error.stage", "error.rule")


@query(
    "audit_log",
    """SELECT 7 AS batch_id, 'transactions' AS table_name, count(*) AS row_count, TIMESTAMP '2024-01-31 00:00:00' AS written_at FROM txn
    UNION ALL SELECT 8, 'enriched_customers', count(*), TIMESTAMP '2024-01-31 00:00:00' FROM crm c JOIN kyc k ON c.customer_id = k.customer_id""",
    "txn crm kyc",
)
def audit_log(d):
    """What the writes themselves left in the log."""
    audit = d.scratch()
    writers.append_audited(d.view("txn"), d.scratch(), audit, "transactions", 7, as_of())
    reply = F.concat(F.lit('{"kyc_status":"'), "verification_status", F.lit('"}')).alias("kyc_response_json")
    jobs.enrich_to_lake(d.view("crm"), d.view("kyc").select("customer_id", reply), d.scratch(), as_of(), audit=audit, batch_id=8)
    return readers.read_table(d.spark, audit)


@query(
    "kyc_document_scan",
    """SELECT customer_id, kyc_status, risk_score, documents_verified, make_timestamp(verification_date * 1000) AS verification_date
    FROM kyc_document""",
    "kyc_document",
)
def kyc_document_scan(d):
    """Documents of up to 500 customers each, every one a JSON array."""
    path = d.scratch()
    rows = d.view("kyc_document")
    record = F.struct(*[c for c in rows.columns if c != "c_custkey"])
    arrays = rows.groupBy(F.floor(F.col("c_custkey") / 500).alias("part")).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.write.partitionBy("part").text(path)
    found = readers.read_kyc_documents(d.spark, path).drop("part")
    return found.withColumn("verification_date", F.col("verification_date").cast("timestamp_ntz"))


@query(
    "validated_table",
    f"""WITH {TXN_ERRORS}
    SELECT CASE WHEN f.msg_offset IS NULL THEN 'valid' ELSE 'dead' END AS outcome, t.msg_offset, t.value
    FROM txn_msg t LEFT JOIN (SELECT DISTINCT msg_offset FROM found) f ON t.msg_offset = f.msg_offset""",
    "txn_msg",
)
def validated_table(d):
    path = d.scratch()
    jobs.validate_table(d.view("txn_msg").select("msg_offset", "value"), TXN_SCHEMA, builtin("transaction.schema.json"), path)
    return readers.read_table(d.spark, path).select("outcome", "msg_offset", "value")


@query(
    "dead_letter_table",
    f"WITH {TXN_ERRORS} SELECT DISTINCT t.msg_offset, t.value FROM txn_msg t JOIN found f ON t.msg_offset = f.msg_offset",
    "txn_msg",
)
def dead_letter_table(d):
    path = d.scratch()
    checked = validate_messages(d.view("txn_msg"), TXN_SCHEMA, builtin("transaction.schema.json"))
    writers.append_invalid(checked.select("msg_offset", "value", "is_valid"), path)
    return readers.read_table(d.spark, path).select("msg_offset", "value")


@query(
    "gated_integration",
    r"""WITH c AS (SELECT * FROM crm WHERE regexp_matches(customer_id, '^[A-Za-z0-9]{8,}$')
        AND (email IS NULL OR email LIKE '%@%') AND (phone IS NULL OR phone = '' OR regexp_matches(phone, '^\+?[0-9]{10,15}$'))
        AND TRY_CAST(updated_at AS TIMESTAMP) IS NOT NULL),
    k AS (SELECT * FROM kyc WHERE lower(verification_status) IN ('pending', 'verified', 'rejected', 'expired') AND lower(risk_level) IN ('low', 'medium', 'high')),
    j AS (SELECT c.customer_id, lower(k.risk_level) AS risk_level FROM c JOIN k ON c.customer_id = k.customer_id)
    SELECT risk_level AS item, count(*) AS row_count FROM j GROUP BY risk_level
    UNION ALL SELECT 'notified', count(DISTINCT customer_id) FROM j""",
    "crm kyc",
)
def gated_integration(d):
    path, notify = d.scratch(), d.scratch()
    jobs.gated_integration(d.view("crm"), d.view("kyc"), path, notify, 0.25, as_of())
    levels = d.spark.read.parquet(path).groupBy(F.col("risk_level").alias("item")).agg(F.count("*").alias("row_count"))
    notices = d.spark.read.json(notify).agg(F.count("*").alias("row_count")).select(F.lit("notified").alias("item"), "row_count")
    return levels.unionByName(notices)


@query(
    "enriched_lake",
    """SELECT c.customer_id, concat('{"kyc_status":"', k.verification_status, '"}') AS kyc_response_json
    FROM crm c JOIN kyc k ON c.customer_id = k.customer_id""",
    "crm kyc",
)
def enriched_lake(d):
    path = d.scratch()
    reply = F.concat(F.lit('{"kyc_status":"'), "verification_status", F.lit('"}')).alias("kyc_response_json")
    responses = d.view("kyc").select("customer_id", reply)
    jobs.enrich_to_lake(d.view("crm"), responses, path, as_of())
    return readers.read_table(d.spark, path).select("customer_id", "kyc_response_json")
