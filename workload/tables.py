"""Joins, latest rows, constraints, compliance, profile and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.functions.rules import error_codes
from custodia.operators import compliance, customers, drift, matching, quality
from custodia.plans import jobs
from custodia.sources.schemas import with_defaults
from custodia.streaming import mirror
from workload.records import ntz
from workload.registry import query

AS_OF = "2024-01-31 00:00:00"


def as_of(text: str = AS_OF):
    return F.lit(text).cast("timestamp_ntz")


# --- customer views -----------------------------------------------------------------------------


@query(
    "integrated_customers",
    """SELECT c.customer_id, c.first_name, c.last_name, c.email, c.phone, k.id_type, k.id_number,
      k.verification_status, k.risk_level, k.verified_at, c.updated_at
    FROM crm c JOIN kyc k ON c.customer_id = k.customer_id""",
    "crm kyc",
)
def integrated_customers(d):
    return customers.integrate(d.view("crm"), d.view("kyc"))


@query(
    "integrated_by_risk",
    """SELECT k.risk_level, count(*) AS customers, count(DISTINCT c.customer_id) AS distinct_customers,
      count(*) FILTER (lower(k.verification_status) = 'verified') AS verified
    FROM crm c JOIN kyc k ON c.customer_id = k.customer_id GROUP BY k.risk_level""",
    "crm kyc",
)
def integrated_by_risk(d):
    joined = customers.integrate(d.view("crm"), d.view("kyc"))
    # Two levels, so that the rows of one risk level are spread over customers before they meet.
    per_customer = joined.groupBy("risk_level", "customer_id").agg(
        F.count("*").alias("n"), F.count_if(F.lower("verification_status") == "verified").alias("v")
    )
    return per_customer.groupBy("risk_level").agg(
        F.sum("n").alias("customers"), F.count("*").alias("distinct_customers"), F.sum("v").alias("verified")
    )


@query(
    "integrated_latest",
    """WITH k AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY verified_at DESC, id_number DESC) AS n FROM kyc)
    SELECT c.customer_id, c.email, k.id_number, k.verified_at FROM crm c JOIN k ON c.customer_id = k.customer_id WHERE n = 1""",
    "crm kyc",
)
def integrated_latest(d):
    joined = customers.integrate(d.view("crm"), d.view("kyc"), latest_only=True)
    return joined.select("customer_id", "email", "id_number", "verified_at")


# A check of unknown status has no response; a customer checked twice has two.
KYC_RESPONSES = """SELECT customer_id,
    CASE WHEN verification_status <> 'unknown' THEN concat('{"kyc_status":"', verification_status, '"}') END AS kyc_response_json
  FROM kyc"""


@query(
    "kyc_enrichment",
    f"""WITH r AS ({KYC_RESPONSES})
    SELECT c.c_custkey, c.customer_id, r.kyc_response_json, TIMESTAMP '{AS_OF}' AS enrichment_time
    FROM crm c LEFT JOIN r ON c.customer_id = r.customer_id WHERE r.kyc_response_json IS NOT NULL""",
    "crm kyc",
)
def kyc_enrichment(d):
    reply = F.when(F.col("verification_status") != "unknown", F.concat(F.lit('{"kyc_status":"'), "verification_status", F.lit('"}')))
    responses = d.view("kyc").select("customer_id", reply.alias("kyc_response_json"))
    enriched = customers.enrich(d.view("crm"), responses, "customer_id", "kyc_response_json", as_of())
    return enriched.select("c_custkey", "customer_id", "kyc_response_json", "enrichment_time")


@query(
    "kyc_enrichment_lookup",
    """SELECT c_custkey, customer_id, concat('{"customer_id": "', customer_id, '"}') AS kyc_response_json
    FROM crm WHERE starts_with(customer_id, 'CUST')""",
    "crm",
)
def kyc_enrichment_lookup(d):
    def open_lookup():
        def lookup(customer_id):
            if not customer_id.startswith("CUST"):
                raise ConnectionError("service does not know the id")
            return '{"customer_id": "' + customer_id + '"}'

        return lookup

    enriched = customers.enrich_by_lookup(d.view("crm"), "customer_id", open_lookup, clock=as_of())
    return enriched.select("c_custkey", "customer_id", "kyc_response_json")


@query(
    "customer_notifications",
    f"""SELECT c.customer_id AS key, concat('{{"timestamp":"2024-01-31T00:00:00.000000","source":"crm_kyc_ingestion","validation_status":"success","data":{{"customer_id":"',
      c.customer_id, '","operation_type":"update"}}}}') AS value
    FROM crm c JOIN kyc k ON c.customer_id = k.customer_id""",
    "crm kyc",
)
def customer_notifications(d):
    joined = customers.integrate(d.view("crm"), d.view("kyc"))
    return customers.notifications(joined, clock=as_of())


@query(
    "latest_per_customer",
    """SELECT customer_id, event_id, credit_score, risk_level, created_at FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC, event_id DESC) AS n FROM scoring) WHERE n = 1""",
    "scoring",
)
def latest_per_customer(d):
    latest = customers.latest_per_key(d.view("scoring"), ["customer_id"], [F.col("created_at"), F.col("event_id")])
    return latest.select("customer_id", "event_id", "credit_score", "risk_level", "created_at")


@query(
    "latest_one_customer",
    """SELECT customer_id, credit_score, created_at FROM scoring WHERE customer_id = 'CUST00000007'
    ORDER BY created_at DESC, event_id DESC LIMIT 1""",
    "scoring",
)
def latest_one_customer(d):
    order = [F.col("created_at"), F.col("event_id")]
    return customers.latest_of(d.view("scoring"), "customer_id", "CUST00000007", order).select(
        "customer_id", "credit_score", "created_at"
    )


# --- change logs --------------------------------------------------------------------------------


@query(
    "cdc_unwrap",
    """WITH j AS (SELECT msg_offset, value, CAST(value AS JSON) AS j FROM cdc_msg),
    b AS (SELECT msg_offset, CASE WHEN list_contains(json_keys(j), 'after') THEN
        CASE WHEN json_type(j, '$.after') <> 'NULL' THEN json_extract(j, '$.after') END ELSE j END AS body FROM j)
    SELECT msg_offset, body IS NULL AS is_delete, json_extract_string(body, '$.id') AS id,
      json_extract_string(body, '$.status') AS status FROM b""",
    "cdc_msg",
)
def cdc_unwrap(d):
    return customers.unwrap_change(d.view("cdc_msg"), "id string, status string").drop("msg_key")


@query(
    "cdc_compact",
    """SELECT id, msg_offset, after_status, value FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY msg_offset DESC) AS n FROM cdc) WHERE n = 1 AND NOT is_delete""",
    "cdc",
)
def cdc_compact(d):
    folded = customers.fold_changes(d.view("cdc"), ["id"], [F.col("msg_offset")], F.col("is_delete"))
    return folded.select("id", "msg_offset", "after_status", "value")


@query(
    "upsert_merge",
    """WITH target AS (SELECT concat('K', CAST(c_custkey AS VARCHAR)) AS id, -1 AS msg_offset, c_mktsegment AS segment FROM customer),
    stacked AS (SELECT id, msg_offset, segment, NULL AS after_status, false AS is_delete FROM target
      UNION ALL SELECT id, msg_offset, NULL, after_status, is_delete FROM cdc)
    SELECT id, msg_offset, segment, after_status FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY msg_offset DESC) AS n FROM stacked) WHERE n = 1 AND NOT is_delete""",
    "cdc",
)
def upsert_merge(d):
    target = d.table("customer").select(
        F.concat(F.lit("K"), F.col("c_custkey").cast("string")).alias("id"),
        F.lit(-1).cast("bigint").alias("msg_offset"),
        F.col("c_mktsegment").alias("segment"),
    )
    changes = d.view("cdc").select("id", "msg_offset", "after_status", "is_delete")
    return mirror.upsert(target, changes, ["id"], "msg_offset")


# --- constraints --------------------------------------------------------------------------------


@query(
    "pk_duplicates",
    "SELECT customer_id, count(*) AS copies FROM kyc GROUP BY customer_id HAVING count(*) > 1",
    "kyc",
)
def pk_duplicates(d):
    return quality.duplicate_keys(d.view("kyc"), ["customer_id"])


@query(
    "fk_orphans",
    """SELECT t.transaction_id, t.customer_id FROM txn t
    WHERE NOT EXISTS (SELECT 1 FROM crm c WHERE c.customer_id = t.customer_id)""",
    "txn crm",
)
def fk_orphans(d):
    return quality.orphans(d.view("txn"), d.view("crm"), "customer_id", "customer_id").select("transaction_id", "customer_id")


@query(
    "length_violations",
    """SELECT customer_id, 'email' AS column_name, length(email) AS length, 20 AS max_length FROM crm WHERE length(email) > 20
    UNION ALL SELECT customer_id, 'phone', length(phone), 10 FROM crm WHERE length(phone) > 10
    UNION ALL SELECT customer_id, 'last_name', length(last_name), 100 FROM crm WHERE length(last_name) > 100""",
    "crm",
)
def length_violations(d):
    return quality.length_violations(d.view("crm"), "customer_id", {"email": 20, "phone": 10, "last_name": 100})


@query(
    "document_length_violations",
    "SELECT doc_id, 'text' AS column_name, length(text) AS length, 255 AS max_length FROM documents WHERE length(text) > 255",
)
def document_length_violations(d):
    return quality.length_violations(d.table("documents"), "doc_id", {"text": 255})


@query(
    "decimal_violations",
    """SELECT o_orderkey, share FROM (SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) / 8 AS share FROM orders)
    WHERE CAST(share AS DECIMAL(15, 2)) <> CAST(share AS DECIMAL(18, 6))""",
)
def decimal_violations(d):
    shares = d.table("orders").select("o_orderkey", (F.col("o_orderkey").cast("double") / 8).alias("share"))
    return quality.decimal_violations(shares, "share")


@query(
    "defaults_filled",
    "SELECT transaction_id, coalesce(currency, 'MAD') AS currency, 'ACTIVE' AS status FROM txn",
    "txn",
)
def defaults_filled(d):
    filled = with_defaults(d.view("txn"), {"currency": "MAD", "status": "ACTIVE"})
    return filled.select("transaction_id", "currency", "status")


@query(
    "ingest_completeness",
    """SELECT count(*) AS produced, count(arrived_ms) AS consumed, count(*) - count(arrived_ms) AS missing,
      0 AS unexpected, count(*) = count(arrived_ms) AS complete FROM ingest""",
    "ingest",
)
def ingest_completeness(d):
    sent = d.view("ingest")
    return quality.completeness(sent, sent.filter(F.col("arrived_ms").isNotNull()), "id")


@query("missing_messages", "SELECT id FROM ingest WHERE arrived_ms IS NULL", "ingest")
def missing_messages(d):
    sent = d.view("ingest")
    return quality.missing_messages(sent, sent.filter(F.col("arrived_ms").isNotNull()), "id")


@query(
    "freshness",
    f"""SELECT round(epoch_us(TIMESTAMP '{AS_OF}' - max(ts)) / 1000000.0, 6) AS age_seconds,
      epoch_us(TIMESTAMP '{AS_OF}' - max(ts)) <= 3600000000 AS is_fresh FROM events""".replace(
        f"epoch_us(TIMESTAMP '{AS_OF}' - max(ts))", f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts)))"
    ),
)
def freshness(d):
    age = quality.freshness(d.table("events"), "ts", as_of().cast("timestamp"))
    return age.withColumn("age_seconds", F.round("age_seconds", 6))


# --- compliance ---------------------------------------------------------------------------------


@query(
    "retention_expired",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '2003-01-01 00:00:00' - INTERVAL 2555 DAY",
)
def retention_expired(d):
    return compliance.expired(d.table("orders"), "o_orderdate", as_of("2003-01-01 00:00:00")).select("o_orderkey", "o_orderdate")


@query(
    "retained_rows",
    f"SELECT event_id FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR",
)
def retained_rows(d):
    hours = compliance.VACUUM_HOURS * 3_600_000
    return compliance.retained(d.table("events"), "ts", as_of(), hours).select("event_id")


@query(
    "topic_retention",
    f"""SELECT topic, count(*) AS messages FROM (SELECT CASE topic WHEN 'dlq.transactions' THEN 'transactions' WHEN 'dlq.kyc_responses'
        THEN 'kyc_responses' WHEN 'dlq.crm_customers' THEN 'crm_customers' ELSE 'other' END AS topic, ts FROM dlq)
    WHERE topic = 'other' OR (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 1000.0 <= CASE topic WHEN 'transactions' THEN 1209600000
      WHEN 'kyc_responses' THEN 259200000 ELSE 604800000 END GROUP BY topic""",
    "dlq",
)
def topic_retention(d):
    name = (
        F.when(F.col("topic") == "dlq.transactions", "transactions").when(F.col("topic") == "dlq.kyc_responses", "kyc_responses")
        .when(F.col("topic") == "dlq.crm_customers", "crm_customers").otherwise("other")
    )
    held = compliance.retained_by_topic(
        d.view("dlq").withColumn("topic", name), "ts", as_of(), compliance.TOPIC_RETENTION_MS
    )
    return held.groupBy("topic").agg(F.count("*").alias("messages"))


@query(
    "consent_missing",
    """SELECT DISTINCT customer_id FROM txn t
    WHERE NOT EXISTS (SELECT 1 FROM consents c WHERE c.customer_id = t.customer_id)""",
    "txn consents",
)
def consent_missing(d):
    return compliance.consent_missing(d.view("txn"), d.view("consents"))


@query(
    "extra_fields",
    """WITH k AS (SELECT unnest(json_keys(CASE WHEN json_valid(value) THEN CAST(value AS JSON) END)) AS field FROM txn_msg)
    SELECT field, count(*) AS messages FROM k WHERE field NOT IN ('transaction_id', 'customer_id', 'amount', 'timestamp') GROUP BY field""",
    "txn_msg",
)
def extra_fields(d):
    return compliance.extra_fields(d.view("txn_msg"), ["transaction_id", "customer_id", "amount", "timestamp"])


@query(
    "sensitive_in_clear",
    """SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 2 = 0 AND email IS NOT NULL THEN 'email' END,
      CASE WHEN phone IS NOT NULL THEN 'phone' END) AS exposed
    FROM crm WHERE (c_custkey % 2 = 0 AND email IS NOT NULL) OR phone IS NOT NULL""",
    "crm",
)
def sensitive_in_clear(d):
    crm = d.view("crm")
    digests = compliance.protect(crm.select("c_custkey", "email"), ["email"], "pepper").withColumnRenamed("email", "digest")
    mixed = crm.join(digests, "c_custkey").withColumn(
        "email", F.when(F.col("c_custkey") % 2 == 0, F.col("email")).otherwise(F.col("digest"))
    )
    found = compliance.in_clear(mixed, ["email", "phone"])
    return found.select("c_custkey", F.array_join("exposed", ",").alias("exposed"))


@query("protected_values", "SELECT c_custkey, sha256(concat('pepper', email)) AS email FROM crm WHERE email IS NOT NULL", "crm")
def protected_values(d):
    rows = d.view("crm").filter(F.col("email").isNotNull()).select("c_custkey", "email")
    return compliance.protect(rows, ["email"], "pepper")


@query(
    "access_log_gaps",
    """SELECT event_id, concat_ws('|', CASE WHEN user_id IS NULL THEN 'user_id:required' END,
      CASE WHEN action IS NULL THEN 'action:required' END) AS gaps
    FROM access_log WHERE data_type = 'sensitive' AND (user_id IS NULL OR action IS NULL)
      AND access_ts BETWEEN TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 240 HOUR AND TIMESTAMP '2024-01-15 00:00:00'""",
    "access_log",
)
def access_log_gaps(d):
    gaps = compliance.access_log_gaps(d.view("access_log"), as_of("2024-01-15 00:00:00"), hours=240)
    return gaps.select("event_id", error_codes().alias("gaps"))


@query(
    "audit_gaps",
    """SELECT event_id, concat_ws('|', CASE WHEN user_id IS NULL THEN 'user_id:required' END,
      CASE WHEN new_version IS NULL THEN 'new_version:required' END, CASE WHEN reason IS NULL THEN 'reason:required' END) AS gaps
    FROM audit_changes WHERE (user_id IS NULL OR new_version IS NULL OR reason IS NULL)
      AND change_ts BETWEEN TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 24 HOUR AND TIMESTAMP '2024-01-15 00:00:00'""",
    "audit_changes",
)
def audit_gaps(d):
    gaps = compliance.audit_gaps(d.view("audit_changes"), as_of("2024-01-15 00:00:00"))
    return gaps.select("event_id", error_codes().alias("gaps"))


# --- comparing tables ---------------------------------------------------------------------------

RECONCILE = """SELECT coalesce(s.{key}, r.{key}) AS {key}, s.credit_score::DOUBLE AS stored_credit_score, r.credit_score::DOUBLE AS returned_credit_score,
  CASE WHEN s.{key} IS NULL THEN 'missing_stored' WHEN r.{key} IS NULL THEN 'missing_returned' ELSE 'diff' END AS mismatch
FROM {stored} s FULL JOIN {returned} r ON s.{key} = r.{key}
WHERE s.{key} IS NULL OR r.{key} IS NULL OR s.credit_score IS DISTINCT FROM r.credit_score"""


def scores_as_double(mismatches):
    """Nullable whole numbers reach a comparison in pandas in several types, nullable doubles in one."""
    return mismatches.withColumns(
        {c: F.col(c).cast("double") for c in ("stored_credit_score", "returned_credit_score")}
    )


@query("reconcile_results", RECONCILE.format(key="event_id", stored="scoring_stored", returned="scoring"), "scoring_stored scoring")
def reconcile_results(d):
    return scores_as_double(matching.reconcile(d.view("scoring_stored"), d.view("scoring"), "event_id", ["credit_score"]))


@query("reconcile_by_digest", RECONCILE.format(key="event_id", stored="scoring_stored", returned="scoring"), "scoring_stored scoring")
def reconcile_by_digest(d):
    """Digests of both sides are stored and compared first; then only the differing ranges are read."""
    sides = [d.view("scoring_stored").select("event_id", "credit_score"), d.view("scoring").select("event_id", "credit_score")]
    kept = []
    for side in sides:
        kept.append(d.scratch())
        matching.range_digests(side, "event_id", ["credit_score"]).write.parquet(kept[-1])
    ranges = matching.differing_ranges(*[d.spark.read.parquet(path) for path in kept])
    return scores_as_double(matching.reconcile_by_digest(*sides, "event_id", ["credit_score"], ranges))


@query(
    "reconcile_latest",
    """WITH s AS (SELECT customer_id, credit_score, row_number() OVER (PARTITION BY customer_id ORDER BY event_id DESC) AS n FROM scoring_stored),
    r AS (SELECT customer_id, credit_score, row_number() OVER (PARTITION BY customer_id ORDER BY event_id DESC) AS n FROM scoring),
    s1 AS (SELECT * FROM s WHERE n = 1), r1 AS (SELECT * FROM r WHERE n = 1) """
    + RECONCILE.format(key="customer_id", stored="s1", returned="r1"),
    "scoring_stored scoring",
)
def reconcile_latest(d):
    columns = ["customer_id", "event_id", "credit_score"]
    stored, returned = d.view("scoring_stored").select(*columns), d.view("scoring").select(*columns)
    return scores_as_double(matching.reconcile(stored, returned, "customer_id", ["credit_score"], F.col("event_id")))


@query(
    "request_result_match",
    """SELECT q.request_id, q.customer_id, min(r.ts) AS result_ts, CASE WHEN min(r.ts) IS NULL THEN 'timeout' ELSE 'answered' END AS status
    FROM requests q LEFT JOIN results r ON q.customer_id = r.customer_id AND r.ts BETWEEN q.ts AND q.ts + INTERVAL 30 SECOND
    GROUP BY q.request_id, q.customer_id""",
    "requests results",
)
def request_result_match(d):
    matched = matching.match_within(d.view("requests"), d.view("results"), "customer_id")
    return matched.select("request_id", "customer_id", ntz("result_ts"), "status")


# --- profile and drift --------------------------------------------------------------------------


def _quartiles(value: str, source: str) -> str:
    return ", ".join(
        f"(SELECT quantile_cont({value}, {q}) FROM {source} WHERE {value} IS NOT NULL) AS {name}"
        for name, q in [("q25", 0.25), ("q50", 0.5), ("q75", 0.75)]
    )


def _number_profile(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS feature, count(*) AS row_count, count(*) - count({column}) AS missing,
      min({column})::DOUBLE AS min_value, max({column})::DOUBLE AS max_value, round(avg({column}), 4) AS mean_value,
      round(stddev_samp({column}), 4) AS std_value, count(DISTINCT {column}) AS distinct_values,
      round(quantile_cont({column}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({column}::DOUBLE, 0.5), 6) AS q50,
      round(quantile_cont({column}::DOUBLE, 0.75), 6) AS q75,
      (SELECT max(c) FROM (SELECT count(*) AS c FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})) AS most_common_count
    FROM {source}"""


def _text_profile(column: str, source: str) -> str:
    return f"""SELECT '{column}', count(*), count(*) - count({column}), NULL, NULL, NULL, NULL, count(DISTINCT {column}),
      NULL, NULL, NULL, (SELECT max(c) FROM (SELECT count(*) AS c FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}))
    FROM {source}"""


def _rounded_profile(frame):
    columns = ["feature", "row_count", "missing", "min_value", "max_value"]
    rounded = [F.round(c, 4).alias(c) for c in ("mean_value", "std_value")]
    quartiles = [F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")]
    return frame.select(*columns, *rounded, "distinct_values", *quartiles, "most_common_count")


@query(
    "feature_profile",
    "\nUNION ALL ".join([_number_profile("amount", "txn"), _text_profile("currency", "txn"), _text_profile("customer_id", "txn")]),
    "txn",
)
def feature_profile(d):
    return _rounded_profile(quality.profile(d.view("txn"), ["amount"], ["currency", "customer_id"]))


@query(
    "lineitem_profile",
    "\nUNION ALL ".join(
        [_number_profile(c, "lineitem") for c in ("l_extendedprice", "l_quantity", "l_discount")]
        + [_text_profile(c, "lineitem") for c in ("l_returnflag", "l_linestatus")]
    ),
)
def lineitem_profile(d):
    return _rounded_profile(
        quality.profile(
            d.table("lineitem"), ["l_extendedprice", "l_quantity", "l_discount"], ["l_returnflag", "l_linestatus"]
        )
    )


@query(
    "most_common_values",
    """SELECT 'currency' AS feature, (SELECT currency FROM txn WHERE currency IS NOT NULL GROUP BY currency ORDER BY count(*) DESC, currency LIMIT 1) AS most_common
    UNION ALL SELECT 'customer_id', (SELECT customer_id FROM txn GROUP BY customer_id ORDER BY count(*) DESC, customer_id LIMIT 1)""",
    "txn",
)
def most_common_values(d):
    return quality.profile(d.view("txn"), [], ["currency", "customer_id"]).select("feature", "most_common")


@query(
    "distinct_customers",
    "SELECT count(DISTINCT customer_id) AS customer_id, count(DISTINCT currency) AS currency FROM txn",
    "txn",
)
def distinct_customers(d):
    return quality.distinct_counts(d.view("txn"), ["customer_id", "currency"])


CUT = "2000-01-01 00:00:00"


def halves(frame, ts: str):
    return frame.filter(F.col(ts) < as_of(CUT)), frame.filter(F.col(ts) >= as_of(CUT))


def _ks_oracle(feature: str, source: str, ts: str) -> str:
    return f"""SELECT '{feature}' AS feature, round(max(abs(cr / nr - cc / nc)), 9) AS ks, max(nr)::BIGINT AS n_reference, max(nc)::BIGINT AS n_current FROM (
      SELECT v, sum(sum(r)) OVER (ORDER BY v) AS cr, sum(sum(c)) OVER (ORDER BY v) AS cc, sum(sum(r)) OVER () AS nr, sum(sum(c)) OVER () AS nc
      FROM (SELECT {feature}::DOUBLE AS v, CASE WHEN {ts} < TIMESTAMP '{CUT}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS r,
        CASE WHEN {ts} >= TIMESTAMP '{CUT}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS c FROM {source} WHERE {feature} IS NOT NULL) GROUP BY v)"""


@query("drift_numeric_ks", _ks_oracle("amount", "txn", "ts"), "txn")
def drift_numeric_ks(d):
    ks = drift.ks_distance(*halves(d.view("txn"), "ts"), ["amount"])
    return ks.withColumn("ks", F.round("ks", 9))


@query(
    "lineitem_drift_ks",
    "\nUNION ALL ".join(_ks_oracle(c, "lineitem", "l_shipdate") for c in ("l_extendedprice", "l_quantity", "l_discount")),
)
def lineitem_drift_ks(d):
    ks = drift.ks_distance(*halves(d.table("lineitem"), "l_shipdate"), ["l_extendedprice", "l_quantity", "l_discount"])
    return ks.withColumn("ks", F.round("ks", 9))


def _psi_oracle(feature: str, source: str, ts: str) -> str:
    return f"""edges AS (SELECT quantile_cont({feature}::DOUBLE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM {source} WHERE {ts} < TIMESTAMP '{CUT}'),
    binned AS (SELECT len(list_filter(e, lambda x: {feature} > x)) AS bin, {ts} < TIMESTAMP '{CUT}' AS is_ref FROM {source}, edges WHERE {feature} IS NOT NULL),
    counts AS (SELECT b.bin, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
      FROM (SELECT unnest(range(10)) AS bin) b LEFT JOIN binned USING (bin) GROUP BY b.bin),
    shares AS (SELECT greatest(r / sum(r) OVER (), 0.0001) AS p, greatest(c / sum(c) OVER (), 0.0001) AS q FROM counts)
    SELECT '{feature}' AS feature, round(sum((q - p) * ln(q / p)), 9) AS psi FROM shares"""


@query("drift_psi", "WITH " + _psi_oracle("amount", "txn", "ts"), "txn")
def drift_psi(d):
    psi = drift.stability_index(*halves(d.view("txn"), "ts"), ["amount"])
    return psi.withColumn("psi", F.round("psi", 9))


def _category_oracle(feature: str, source: str, ts: str) -> str:
    return f"""SELECT '{feature}' AS feature, max(nr) AS n_reference, max(nc) AS n_current, count(*) AS categories,
      round(sqrt(greatest((sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END) + sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)), 9) AS js,
      round(sum(pow(r - (r + c) * nr / (nr + nc), 2) / ((r + c) * nr / (nr + nc)) + pow(c - (r + c) * nc / (nr + nc), 2) / ((r + c) * nc / (nr + nc))), 6) AS chi_square
    FROM (SELECT *, r / nr AS p, c / nc AS q FROM (
      SELECT r, c, (sum(r) OVER ())::BIGINT AS nr, (sum(c) OVER ())::BIGINT AS nc FROM (
        SELECT {feature}, count(*) FILTER ({ts} < TIMESTAMP '{CUT}') AS r, count(*) FILTER ({ts} >= TIMESTAMP '{CUT}') AS c
        FROM {source} WHERE {feature} IS NOT NULL GROUP BY {feature})))"""


@query(
    "drift_categorical_js",
    _category_oracle("currency", "txn", "ts") + "\nUNION ALL " + _category_oracle("customer_id", "txn", "ts"),
    "txn",
)
def drift_categorical_js(d):
    js = drift.category_drift(*halves(d.view("txn"), "ts"), ["currency", "customer_id"])
    return js.withColumns({"js": F.round("js", 9), "chi_square": F.round("chi_square", 6)})


DRIFT_SQL = f"""ks AS ({_ks_oracle("amount", "txn", "ts")}),
    js AS ({_category_oracle("currency", "txn", "ts")} UNION ALL {_category_oracle("customer_id", "txn", "ts")}),
    {_psi_oracle("amount", "txn", "ts").replace("SELECT 'amount' AS feature", ", psi AS (SELECT 'amount' AS feature") + ")"}"""


@query(
    "drift_report_job",
    f"""WITH {DRIFT_SQL},
    m AS (SELECT feature, 'ks' AS measure, ks AS value, ks > 0.1 AS drifted FROM ks
      UNION ALL SELECT feature, 'psi', psi, psi > 0.2 FROM psi UNION ALL SELECT feature, 'js', js, js > 0.1 FROM js),
    f AS (SELECT feature, max(drifted::INT) AS drifted FROM m GROUP BY feature),
    cur AS (SELECT * FROM txn WHERE ts >= TIMESTAMP '{CUT}')
    SELECT feature, measure, value FROM m
    UNION ALL SELECT feature, concat(measure, '_drifted'), drifted::INT::DOUBLE FROM m
    UNION ALL SELECT 'dataset', 'drift_share', round(avg(drifted), 9) FROM f
    UNION ALL SELECT 'amount', 'missing', (count(*) - count(amount))::DOUBLE FROM cur
    UNION ALL SELECT 'currency', 'missing', (count(*) - count(currency))::DOUBLE FROM cur
    UNION ALL SELECT 'customer_id', 'missing', (count(*) - count(customer_id))::DOUBLE FROM cur
    UNION ALL SELECT 'amount', 'distinct', count(DISTINCT amount)::DOUBLE FROM cur
    UNION ALL SELECT 'currency', 'distinct', count(DISTINCT currency)::DOUBLE FROM cur
    UNION ALL SELECT 'customer_id', 'distinct', count(DISTINCT customer_id)::DOUBLE FROM cur""",
    "txn",
)
def drift_report_job(d):
    report = jobs.monitor_transactions(*halves(d.view("txn"), "ts"))

    def rows(frame, measure, value):
        return frame.select("feature", measure.alias("measure"), value.cast("double").alias("value"))

    return (
        rows(report.drift, F.col("measure"), F.round("value", 9))
        .unionByName(rows(report.drift, F.concat("measure", F.lit("_drifted")), F.col("drifted").cast("int")))
        .unionByName(rows(report.dataset.withColumn("feature", F.lit("dataset")), F.lit("drift_share"), F.round("drift_share", 9)))
        .unionByName(rows(report.profile, F.lit("missing"), F.col("missing")))
        .unionByName(rows(report.profile, F.lit("distinct"), F.col("distinct_values")))
    )


@query(
    "drift_dataset_verdict",
    f"""WITH {DRIFT_SQL},
    f AS (SELECT feature, max(drifted) AS drifted FROM (SELECT feature, (ks > 0.1)::INT AS drifted FROM ks
      UNION ALL SELECT feature, (psi > 0.2)::INT FROM psi UNION ALL SELECT feature, (js > 0.1)::INT FROM js) GROUP BY feature)
    SELECT count(*) AS features, sum(drifted)::BIGINT AS drifted_features, avg(drifted) AS drift_share, avg(drifted) >= 0.5 AS dataset_drift FROM f""",
    "txn",
)
def drift_dataset_verdict(d):
    report = drift.drift_report(*halves(d.view("txn"), "ts"), ["amount"], ["currency", "customer_id"])
    return drift.dataset_verdict(report)


@query(
    "distinct_customers_rolling",
    """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
    SELECT CAST(day AS VARCHAR) AS day, count(DISTINCT user_id) AS distinct_keys FROM days JOIN events ON CAST(ts AS DATE) BETWEEN day - 6 AND day GROUP BY day""",
)
def distinct_customers_rolling(d):
    """Customers of every seven days, from daily bitmaps over a stored dictionary."""
    numbers, bitmaps = d.scratch(), d.scratch()
    quality.key_dictionary(d.table("events"), "user_id").write.parquet(numbers)
    quality.daily_bitmaps(d.table("events"), d.spark.read.parquet(numbers), "user_id", "ts").write.parquet(bitmaps)
    return quality.rolling_distinct(d.spark.read.parquet(bitmaps)).withColumn("day", F.col("day").cast("string"))


HEAVY = {"l_orderkey": "BIGINT", "l_suppkey": "BIGINT", "l_quantity": "DOUBLE", "l_returnflag": "VARCHAR", "l_linestatus": "VARCHAR"}


@query(
    "most_common_heavy",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS value_count FROM lineitem WHERE {c} IS NOT NULL
        GROUP BY {c} HAVING count(*) >= 0.005 * (SELECT count(*) FROM lineitem)"""
        for c in HEAVY
    ),
)
def most_common_heavy(d):
    """Values that make up half a percent of a column or more; order keys are nearly unique and have none."""
    return quality.heavy_values(d.table("lineitem"), list(HEAVY), 0.005)
