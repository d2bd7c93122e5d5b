"""Parsing and record validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.contracts import builtin
from custodia.functions.json_schema import non_empty_object
from custodia.functions.parsing import CORRUPT, fill_missing, flatten_kyc_event, message_timestamp, parse_json, parse_or_quarantine
from custodia.functions.records import hostile_identifier, scoring_rules
from custodia.functions.rules import error_codes, split_valid, validate
from custodia.functions.schema_dispatch import validate_by_path, validate_messages
from custodia.operators import compliance, deadletter, quality
from custodia.plans.jobs import validate_batch, validate_crm, validate_kyc
from custodia.sources.schemas import TRANSACTION_STREAM
from workload.registry import query

TXN_SCHEMA = "schemas/transaction_schema.json"
TXN_AVRO = "topics/transactions.avsc"


def ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name.split(".")[-1])


# --- CRM and KYC models -------------------------------------------------------------------------

CRM_RULES = r"""
checked AS (
  SELECT *, trim(email) AS mail,
    NOT regexp_matches(customer_id, '^[A-Za-z0-9]{8,}$') AS bad_id,
    email IS NOT NULL AND NOT regexp_matches(trim(email), '^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$') AS bad_email,
    phone IS NOT NULL AND phone <> '' AND NOT regexp_matches(phone, '^\+?[0-9]{10,15}$') AS bad_phone,
    TRY_CAST(updated_at AS TIMESTAMP) IS NULL AS bad_time
  FROM crm)
"""

KYC_RULES = """
checked AS (
  SELECT *,
    lower(verification_status) NOT IN ('pending', 'verified', 'rejected', 'expired') AS bad_status,
    lower(risk_level) NOT IN ('low', 'medium', 'high') AS bad_risk,
    TRY_CAST(verified_at AS TIMESTAMP) IS NULL AS bad_time
  FROM kyc)
"""


@query(
    "crm_validation",
    f"""WITH {CRM_RULES}
    SELECT c_custkey, NOT (bad_id OR bad_email OR bad_phone OR bad_time) AS is_valid,
      concat_ws('|', CASE WHEN bad_id THEN 'customer_id:format' END, CASE WHEN bad_email THEN 'email:email' END,
        CASE WHEN bad_phone THEN 'phone:format' END, CASE WHEN bad_time THEN 'updated_at:datetime' END) AS errors,
      CASE WHEN NOT (bad_id OR bad_email OR bad_phone OR bad_time) THEN trim(first_name) END AS first_name,
      CASE WHEN NOT (bad_id OR bad_email OR bad_phone OR bad_time) THEN mail END AS email,
      CASE WHEN NOT (bad_id OR bad_email OR bad_phone OR bad_time) THEN CAST(updated_at AS TIMESTAMP) END AS updated_at
    FROM checked""",
    "crm",
)
def crm_validation(d):
    checked = validate_crm(d.view("crm"))
    return checked.select(
        "c_custkey", "is_valid", error_codes().alias("errors"), "data.first_name", "data.email", ntz("data.updated_at")
    )


@query(
    "kyc_validation",
    f"""WITH {KYC_RULES}
    SELECT c_custkey, rep, NOT (bad_status OR bad_risk OR bad_time) AS is_valid,
      concat_ws('|', CASE WHEN bad_status THEN 'verification_status:domain' END,
        CASE WHEN bad_risk THEN 'risk_level:domain' END, CASE WHEN bad_time THEN 'verified_at:datetime' END) AS errors,
      CASE WHEN NOT (bad_status OR bad_risk OR bad_time) THEN lower(verification_status) END AS verification_status,
      CASE WHEN NOT (bad_status OR bad_risk OR bad_time) THEN lower(risk_level) END AS risk_level
    FROM checked""",
    "kyc",
)
def kyc_validation(d):
    checked = validate_kyc(d.view("kyc"))
    return checked.select(
        "c_custkey", "rep", "is_valid", error_codes().alias("errors"), "data.verification_status", "data.risk_level"
    )


@query(
    "validation_summary",
    f"""WITH {CRM_RULES},
    {KYC_RULES.replace("checked AS", "kyc_checked AS")}
    SELECT 'crm' AS data_type, count(*) AS total,
      count(*) FILTER (NOT (bad_id OR bad_email OR bad_phone OR bad_time)) AS valid,
      count(*) FILTER (bad_id OR bad_email OR bad_phone OR bad_time) AS invalid FROM checked
    UNION ALL
    SELECT 'kyc', count(*), count(*) FILTER (NOT (bad_status OR bad_risk OR bad_time)),
      count(*) FILTER (bad_status OR bad_risk OR bad_time) FROM kyc_checked
    UNION ALL
    SELECT 'partner', count(*), count(*) FILTER (NOT (bad_status OR bad_risk OR bad_time)),
      count(*) FILTER (bad_status OR bad_risk OR bad_time) FROM kyc_checked""",
    "crm kyc",
)
def validation_summary(d):
    """Batches by their type; a type without rules of its own is checked as KYC."""
    batches = {"crm": "crm", "kyc": "kyc", "partner": "kyc"}
    parts = [quality.validation_summary(validate_batch(d.view(view), kind), kind) for kind, view in batches.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "crm_length_errors",
    """WITH f AS (SELECT msg_offset, length(json_extract_string(value, '$.first_name')) AS a, length(json_extract_string(value, '$.last_name')) AS b FROM crm_msg)
    SELECT msg_offset, a BETWEEN 1 AND 100 AND b BETWEEN 1 AND 100 AS is_valid, concat_ws('|', CASE WHEN a < 1 THEN 'first_name:minLength' END,
      CASE WHEN a > 100 THEN 'first_name:maxLength' END, CASE WHEN b > 100 THEN 'last_name:maxLength' END) AS errors FROM f""",
    "crm_msg",
)
def crm_length_errors(d):
    checked = validate_messages(d.view("crm_msg"), "schemas/customer_schema.json", builtin("crm_customer.schema.json"))
    return checked.select("msg_offset", "is_valid", error_codes().alias("errors"))


@query(
    "crm_error_breakdown",
    f"""WITH {CRM_RULES}
    SELECT * FROM (
      SELECT 'customer_id' AS field, 'format' AS rule, count(*) FILTER (bad_id) AS records FROM checked
      UNION ALL SELECT 'email', 'email', count(*) FILTER (bad_email) FROM checked
      UNION ALL SELECT 'phone', 'format', count(*) FILTER (bad_phone) FROM checked
      UNION ALL SELECT 'updated_at', 'datetime', count(*) FILTER (bad_time) FROM checked) WHERE records > 0""",
    "crm",
)
def crm_error_breakdown(d):
    return quality.error_breakdown(validate_crm(d.view("crm")))


@query(
    "crm_invalid_records",
    f"""WITH {CRM_RULES}
    SELECT customer_id, phone, concat('[', concat_ws(',',
      CASE WHEN bad_id THEN '"customer_id:format"' END, CASE WHEN bad_email THEN '"email:email"' END,
      CASE WHEN bad_phone THEN '"phone:format"' END, CASE WHEN bad_time THEN '"updated_at:datetime"' END), ']') AS error
    FROM checked WHERE bad_id OR bad_email OR bad_phone OR bad_time""",
    "crm",
)
def crm_invalid_records(d):
    rejected = quality.invalid_records(validate_crm(d.view("crm")), ["customer_id", "phone"])
    errors = F.from_json("error", "array<struct<field: string, rule: string>>")
    codes = F.transform(errors, lambda e: F.concat(e["field"], F.lit(":"), e["rule"]))
    return rejected.select(
        F.get_json_object("data", "$.customer_id").alias("customer_id"),
        F.get_json_object("data", "$.phone").alias("phone"),
        F.to_json(codes).alias("error"),
    )


# --- JSON messages ------------------------------------------------------------------------------

PARSED = """
d AS (SELECT msg_offset, value, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM txn_msg),
p AS (SELECT msg_offset, value, j,
    json_extract_string(j, '$.transaction_id') AS transaction_id, json_extract_string(j, '$.customer_id') AS customer_id,
    CASE WHEN json_type(j, '$.amount') <> 'VARCHAR' THEN CAST(json_extract_string(j, '$.amount') AS DOUBLE) END AS amount,
    json_extract_string(j, '$.currency') AS currency,
    TRY_CAST(replace(json_extract_string(j, '$.timestamp'), 'Z', '') AS TIMESTAMP) AS ts,
    json_type(j, '$.amount') = 'VARCHAR' OR (json_extract_string(j, '$.timestamp') IS NOT NULL
      AND TRY_CAST(replace(json_extract_string(j, '$.timestamp'), 'Z', '') AS TIMESTAMP) IS NULL) AS bad_field
  FROM d)
"""


@query(
    "txn_json_parse",
    f"WITH {PARSED} SELECT transaction_id, customer_id, amount, currency, ts FROM p",
    "txn_msg",
)
def txn_json_parse(d):
    rows = parse_json(d.view("txn_msg"), TRANSACTION_STREAM)
    return rows.withColumn("ts", F.col("timestamp").cast("timestamp_ntz")).drop("timestamp")


@query(
    "txn_quarantine",
    f"""WITH {PARSED}
    SELECT msg_offset, transaction_id, amount, ts,
      CASE WHEN value IS NULL THEN '' WHEN j IS NULL OR bad_field THEN value END AS corrupt FROM p""",
    "txn_msg",
)
def txn_quarantine(d):
    rows = parse_or_quarantine(d.view("txn_msg"), TRANSACTION_STREAM, keep=("msg_offset",))
    return rows.select(
        "msg_offset", "transaction_id", "amount", F.col("timestamp").cast("timestamp_ntz").alias("ts"), F.col(CORRUPT).alias("corrupt")
    )


@query(
    "message_timestamps",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderdate
      WHEN 1 THEN make_timestamp((1730419200000 + o_orderkey) * 1000) END AS ts FROM orders""",
)
def message_timestamps(d):
    text = d.sql(
        """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')
          WHEN 1 THEN CAST(1730419200000 + o_orderkey AS STRING) ELSE 'soon' END AS text FROM orders"""
    )
    return text.select("o_orderkey", message_timestamp(F.col("text")).cast("timestamp_ntz").alias("ts"))


@query(
    "kyc_event_flat",
    """WITH j AS (SELECT c_custkey, CAST(value AS JSON) AS j FROM kyc_event)
    SELECT c_custkey, json_extract_string(j, '$.customer_id') AS customer_id,
      CAST(json_extract_string(j, '$.risk_score') AS DOUBLE) AS risk_score,
      CAST(json_extract_string(j, '$.documents_verified') AS BOOLEAN) AS documents_verified,
      make_timestamp(CAST(json_extract_string(j, '$.verification_date') AS BIGINT) * 1000) AS verification_date,
      json_extract_string(j, '$.personal_info.first_name') AS first_name,
      CAST(CAST(json_extract_string(j, '$.personal_info.date_of_birth') AS DATE) AS VARCHAR) AS date_of_birth,
      json_extract_string(j, '$.address.city') AS city,
      CAST(json_extract_string(j, '$.compliance_flags.sanctions_check') AS BOOLEAN) AS sanctions_check,
      make_timestamp(CAST(json_extract_string(j, '$.timestamp') AS BIGINT) * 1000) AS event_time FROM j""",
    "kyc_event",
)
def kyc_event_flat(d):
    flat = flatten_kyc_event(d.view("kyc_event"), keep=("c_custkey",))
    return flat.select(
        "c_custkey", "customer_id", "risk_score", "documents_verified", ntz("verification_date"), "first_name",
        F.col("date_of_birth").cast("string").alias("date_of_birth"), "city", "sanctions_check", ntz("event_time"),
    )


@query(
    "avro_defaults",
    """WITH j AS (SELECT msg_offset, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM txn_avro_msg)
    SELECT msg_offset, CASE WHEN json_type(j, '$.status') IS NULL THEN 'completed' ELSE json_extract_string(j, '$.status') END AS status
    FROM j""",
    "txn_avro_msg",
)
def avro_defaults(d):
    default = next(f["default"] for f in builtin("transaction.avsc")["fields"] if f["name"] == "status")
    parsed = d.view("txn_avro_msg").withColumn("doc", F.try_parse_json("value"))
    status = F.try_variant_get("doc", "$.status", "string")
    return parsed.select("msg_offset", fill_missing(F.col("doc"), "status", status, default).alias("status"))


# --- schema documents ---------------------------------------------------------------------------

REQUIRED = ["transaction_id", "customer_id", "account_id", "amount", "currency", "transaction_type", "status", "timestamp"]
TEXTS = ["transaction_id", "customer_id", "account_id", "currency", "transaction_type", "channel", "status", "timestamp"]
KNOWN = [*REQUIRED, "channel", "location", "metadata"]
ENUMS = {
    "transaction_type": "'deposit', 'withdrawal', 'payment', 'transfer', 'refund'",
    "channel": "'ATM', 'POS', 'WEB', 'MOBILE', 'BRANCH'",
    "status": "'success', 'failed', 'pending', 'reversed'",
}
NUMBER = "('DOUBLE', 'BIGINT', 'UBIGINT', 'HUGEINT')"


def _schema_oracle() -> str:
    """One row per message and broken rule, from json_type and json_extract_string."""
    obj = "json_type(j) = 'OBJECT'"
    parts = [
        "SELECT msg_offset, '$' AS field, 'null_message' AS rule FROM d WHERE value IS NULL",
        "SELECT msg_offset, '$', 'undecodable' FROM d WHERE value IS NOT NULL AND j IS NULL",
        f"SELECT msg_offset, '$', 'type' FROM d WHERE j IS NOT NULL AND NOT {obj}",
        f"SELECT msg_offset, '$', 'additionalProperties' FROM d WHERE {obj} AND len(list_filter(json_keys(j), lambda k: k NOT IN ({', '.join(repr(k) for k in KNOWN)}))) > 0",
    ]
    parts += [f"SELECT msg_offset, '{f}', 'required' FROM d WHERE {obj} AND json_type(j, '$.{f}') IS NULL" for f in REQUIRED]
    parts += [f"SELECT msg_offset, '{f}', 'type' FROM d WHERE json_type(j, '$.{f}') <> 'VARCHAR'" for f in TEXTS]
    parts += [
        f"SELECT msg_offset, '{f}', 'enum' FROM d WHERE json_type(j, '$.{f}') IS NOT NULL AND (json_type(j, '$.{f}') <> 'VARCHAR' OR json_extract_string(j, '$.{f}') NOT IN ({v}))"
        for f, v in ENUMS.items()
    ]
    parts += [
        f"SELECT msg_offset, '{f}', 'type' FROM d WHERE json_type(j, '$.{f}') NOT IN {NUMBER}"
        for f in ["amount", "location.latitude", "location.longitude"]
    ]
    parts += [
        f"SELECT msg_offset, '{f}', 'type' FROM d WHERE json_type(j, '$.{f}') NOT IN ('OBJECT', 'NULL')" for f in ["location", "metadata"]
    ]
    parts += [
        f"SELECT msg_offset, '{f}', 'required' FROM d WHERE json_type(j, '$.location') = 'OBJECT' AND json_type(j, '$.{f}') IS NULL"
        for f in ["location.latitude", "location.longitude"]
    ]
    parts += [
        f"SELECT msg_offset, '{f}', '{rule}' FROM d WHERE json_type(j, '$.{f}') IN {NUMBER} AND CAST(json_extract_string(j, '$.{f}') AS DOUBLE) {cond}"
        for f, rule, cond in [
            ("amount", "minimum", "< 0"), ("location.latitude", "minimum", "< -90"), ("location.latitude", "maximum", "> 90"),
            ("location.longitude", "minimum", "< -180"), ("location.longitude", "maximum", "> 180"),
        ]
    ]
    parts += [
        f"SELECT msg_offset, '{f}', 'pattern' FROM d WHERE json_type(j, '$.{f}') = 'VARCHAR' AND NOT regexp_matches(json_extract_string(j, '$.{f}'), '{p}')"
        for f, p in [("transaction_id", "^[A-Za-z0-9_-]+$"), ("currency", "^[A-Z]{3}$")]
    ]
    return "d AS (SELECT msg_offset, value, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM txn_msg),\nfound AS (" + "\nUNION ALL ".join(parts) + ")"


TXN_ERRORS = _schema_oracle()


def checked_transactions(d):
    return validate_messages(d.view("txn_msg"), TXN_SCHEMA, builtin("transaction.schema.json"))


@query(
    "txn_schema_validation",
    f"""WITH {TXN_ERRORS}
    SELECT t.msg_offset, count(f.msg_offset) = 0 AS is_valid, count(f.msg_offset) AS broken_rules
    FROM txn_msg t LEFT JOIN found f ON t.msg_offset = f.msg_offset GROUP BY t.msg_offset""",
    "txn_msg",
)
def txn_schema_validation(d):
    return checked_transactions(d).select("msg_offset", "is_valid", F.size("errors").cast("bigint").alias("broken_rules"))


@query(
    "txn_schema_errors",
    f"WITH {TXN_ERRORS} SELECT field, rule, count(*) AS records FROM found GROUP BY ALL",
    "txn_msg",
)
def txn_schema_errors(d):
    return quality.error_breakdown(checked_transactions(d))


@query(
    "txn_format_enforced",
    f"""WITH {TXN_ERRORS}, late AS (
      SELECT msg_offset FROM found UNION ALL
      SELECT msg_offset FROM d WHERE json_type(j, '$.timestamp') = 'VARCHAR'
        AND TRY_CAST(replace(json_extract_string(j, '$.timestamp'), 'Z', '') AS TIMESTAMP) IS NULL)
    SELECT t.msg_offset, t.msg_offset NOT IN (SELECT msg_offset FROM late) AS is_valid FROM txn_msg t""",
    "txn_msg",
)
def txn_format_enforced(d):
    checked = validate_messages(d.view("txn_msg"), TXN_SCHEMA, builtin("transaction.schema.json"), enforce_formats=True)
    return checked.select("msg_offset", "is_valid")


@query(
    "txn_avro_validation",
    """WITH d AS (SELECT msg_offset, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM txn_avro_msg)
    SELECT msg_offset, coalesce(json_type(j) = 'OBJECT'
      AND json_type(j, '$.transaction_id') = 'VARCHAR' AND json_type(j, '$.customer_id') = 'VARCHAR'
      AND json_type(j, '$.account_id') = 'VARCHAR' AND json_type(j, '$.transaction_type') = 'VARCHAR'
      AND json_type(j, '$.currency') = 'VARCHAR' AND json_type(j, '$.timestamp') IN ('UBIGINT', 'BIGINT')
      AND coalesce(json_type(j, '$.status'), 'NULL') IN ('VARCHAR', 'NULL')
      AND coalesce(json_type(j, '$.description'), 'NULL') IN ('VARCHAR', 'NULL')
      AND TRY_CAST(json_extract_string(j, '$.amount') AS DECIMAL(38, 6)) = TRY_CAST(json_extract_string(j, '$.amount') AS DECIMAL(15, 2))
      AND len(list_filter(json_keys(j), lambda k: k NOT IN ('transaction_id', 'customer_id', 'account_id', 'transaction_type',
        'amount', 'currency', 'timestamp', 'status', 'description'))) = 0, false) AS is_valid FROM d""",
    "txn_avro_msg",
)
def txn_avro_validation(d):
    return validate_messages(d.view("txn_avro_msg"), TXN_AVRO, builtin("transaction.avsc")).select("msg_offset", "is_valid")


@query(
    "schema_dispatch",
    f"""WITH {TXN_ERRORS}, m AS (SELECT *, CASE msg_offset % 4 WHEN 0 THEN '{TXN_SCHEMA}' WHEN 1 THEN 'schemas/lost.json'
        WHEN 2 THEN 'notes.txt' ELSE '' END AS schema_path FROM txn_msg)
    SELECT msg_offset, schema_path = '{TXN_SCHEMA}' AND msg_offset NOT IN (SELECT msg_offset FROM found) AS is_valid FROM m""",
    "txn_msg",
)
def schema_dispatch(d):
    path = (
        F.when(F.col("msg_offset") % 4 == 0, TXN_SCHEMA).when(F.col("msg_offset") % 4 == 1, "schemas/lost.json")
        .when(F.col("msg_offset") % 4 == 2, "notes.txt").otherwise("")
    )
    catalogue = {TXN_SCHEMA: builtin("transaction.schema.json"), TXN_AVRO: builtin("transaction.avsc")}
    checked = validate_by_path(d.view("txn_msg").withColumn("schema_path", path), catalogue)
    return checked.select("msg_offset", "is_valid")


@query(
    "payload_nonempty",
    "SELECT msg_offset, json_valid(payload) AND payload <> '{}' AS non_empty FROM dlq",
    "dlq",
)
def payload_nonempty(d):
    return d.view("dlq").select("msg_offset", non_empty_object(F.col("payload")).alias("non_empty"))


@query(
    "valid_invalid_counts",
    f"""WITH {TXN_ERRORS}, bad AS (SELECT DISTINCT msg_offset FROM found)
    SELECT (SELECT count(*) FROM txn_msg) - count(*) AS valid, count(*) AS invalid FROM bad""",
    "txn_msg",
)
def valid_invalid_counts(d):
    return quality.valid_counts(checked_transactions(d))


@query(
    "invalid_messages",
    f"WITH {TXN_ERRORS} SELECT DISTINCT t.msg_offset, t.value FROM txn_msg t JOIN found f ON t.msg_offset = f.msg_offset",
    "txn_msg",
)
def invalid_messages(d):
    return split_valid(checked_transactions(d))[1].select("msg_offset", "value")


@query(
    "txn_processable",
    """WITH d AS (SELECT msg_offset, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM txn_msg),
    p AS (SELECT msg_offset, coalesce(json_type(j, '$.transaction_id') = 'VARCHAR'
      AND NOT contains(json_extract_string(j, '$.transaction_id'), 'fail'), false) AS ok FROM d)
    SELECT msg_offset, CASE WHEN ok THEN 'processed' ELSE 'dlq' END AS outcome, CASE WHEN ok THEN 1 ELSE 3 END AS attempts FROM p""",
    "txn_msg",
)
def txn_processable(d):
    return deadletter.attempt(d.view("txn_msg")).select("msg_offset", "outcome", "attempts")


# --- scoring results ----------------------------------------------------------------------------


@query(
    "scoring_contract",
    """SELECT event_id, credit_score BETWEEN 300 AND 850 AND risk_level IN ('LOW', 'MEDIUM', 'HIGH', 'VERY_HIGH')
      AND approved_amount > 0 AS is_valid,
      concat_ws('|', CASE WHEN credit_score NOT BETWEEN 300 AND 850 THEN 'credit_score:range' END,
        CASE WHEN risk_level NOT IN ('LOW', 'MEDIUM', 'HIGH', 'VERY_HIGH') THEN 'risk_level:domain' END,
        CASE WHEN approved_amount <= 0 THEN 'approved_amount:positive' END) AS errors
    FROM scoring""",
    "scoring",
)
def scoring_contract(d):
    checked = validate(d.view("scoring"), scoring_rules("created_at"))
    return checked.select("event_id", "is_valid", error_codes().alias("errors"))


@query(
    "hostile_identifiers",
    """SELECT doc_id, NOT regexp_full_match(text, '[A-Za-z0-9_-]+') AS hostile FROM documents
    UNION ALL SELECT c_custkey, NOT regexp_full_match(customer_id, '[A-Za-z0-9_-]+') FROM crm""",
    "crm",
)
def hostile_identifiers(d):
    texts = d.table("documents").select("doc_id", hostile_identifier("text").alias("hostile"))
    ids = d.view("crm").select(F.col("c_custkey").alias("doc_id"), hostile_identifier("customer_id").alias("hostile"))
    return texts.union(ids)


@query(
    "required_elements",
    """WITH k AS (SELECT msg_offset, json_keys(CASE WHEN json_valid(value) THEN CAST(value AS JSON) END) AS keys FROM txn_msg)
    SELECT msg_offset, len(list_filter(['transaction_id', 'amount', 'status'], lambda x: NOT list_contains(keys, x))) AS missing
    FROM k WHERE keys IS NOT NULL""",
    "txn_msg",
)
def required_elements(d):
    keys = F.json_object_keys("value")
    lacking = compliance.missing_elements(["transaction_id", "amount", "status"], keys)
    return d.view("txn_msg").filter(keys.isNotNull()).select("msg_offset", F.size(lacking).cast("bigint").alias("missing"))
