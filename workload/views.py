"""Views derived from the given tables, in SQL that Spark and DuckDB read alike.

Every view covers its whole table. Defects are planted into values by arithmetic on the key; rows
are left out only where their absence is what a query looks for (consents, stored scores, results).
"""

VIEWS: dict[str, str] = {}

VIEWS["crm"] = """
SELECT c_custkey,
  CASE WHEN c_custkey % 17 = 0 THEN concat('CU-', CAST(c_custkey AS STRING))
       ELSE concat('CUST', lpad(CAST(c_custkey AS STRING), 8, '0')) END AS customer_id,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE concat('  First', CAST(c_custkey AS STRING), ' ') END AS first_name,
  c_name AS last_name,
  CASE WHEN c_custkey % 11 = 0 THEN 'not_an_email' WHEN c_custkey % 10 = 3 THEN NULL
       ELSE concat('user', CAST(c_custkey AS STRING), '@example.com') END AS email,
  CASE WHEN c_custkey % 13 = 0 THEN '123' WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 5 = 0 THEN NULL
       ELSE concat('+2126', lpad(CAST(c_custkey AS STRING), 8, '0')) END AS phone,
  c_mktsegment AS address,
  CASE WHEN c_custkey % 19 = 0 THEN 'not_a_date'
       ELSE concat('2025-01-', lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0'), ' 10:00:00') END AS updated_at
FROM customer
"""

# Every customer has an identity check; those with a high balance were checked twice.
VIEWS["kyc"] = """
SELECT c_custkey, concat('CUST', lpad(CAST(c_custkey AS STRING), 8, '0')) AS customer_id,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'passport' END AS id_type,
  concat('PAS', CAST(c_custkey AS STRING)) AS id_number,
  CASE c_custkey % 6 WHEN 0 THEN 'verified' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'Rejected' WHEN 3 THEN 'expired'
       WHEN 4 THEN 'verified' ELSE 'unknown' END AS verification_status,
  CASE c_custkey % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'high' ELSE 'extreme' END AS risk_level,
  concat('2025-02-', lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0'), ' 12:00:00') AS verified_at, 1 AS rep
FROM customer
UNION ALL
SELECT c_custkey, concat('CUST', lpad(CAST(c_custkey AS STRING), 8, '0')) AS customer_id,
  'id_card' AS id_type, concat('IDC', CAST(c_custkey AS STRING)) AS id_number,
  'verified' AS verification_status, 'low' AS risk_level, '2025-03-01 12:00:00' AS verified_at, 2 AS rep
FROM customer WHERE c_acctbal > 9000
"""

VIEWS["txn"] = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 23 = 0 THEN concat('TXNfail', CAST(o_orderkey AS STRING))
       ELSE concat('TXN', CAST(o_orderkey AS STRING)) END AS transaction_id,
  concat('CUST', lpad(CAST(CASE WHEN o_orderkey % 101 = 0 THEN 99000000 + o_custkey ELSE o_custkey END AS STRING), 8, '0')) AS customer_id,
  o_totalprice AS amount,
  CASE o_orderkey % 4 WHEN 0 THEN 'MAD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' ELSE NULL END AS currency,
  CASE o_orderstatus WHEN 'F' THEN 'payment' WHEN 'O' THEN 'deposit' ELSE 'transfer' END AS transaction_type,
  o_orderdate AS ts
FROM orders
"""

VIEWS["txn_msg"] = """
SELECT o_orderkey AS msg_offset, o_orderdate AS sent_at, CASE
  WHEN o_orderkey % 29 = 0 THEN '{"transaction_id":"TXN'
  WHEN o_orderkey % 31 = 0 THEN concat('{"customer_id":"C', CAST(o_custkey AS STRING), '","amount":1}')
  WHEN o_orderkey % 37 = 0 THEN NULL
  WHEN o_orderkey % 41 = 0 THEN concat('{"transaction_id":"TXN', CAST(o_orderkey AS STRING), '","customer_id":null,"account_id":"A","amount":"x","currency":"eur","transaction_type":"gift","status":"success","timestamp":"2024-11-01T10:30:00Z"}')
  WHEN o_orderkey % 43 = 0 THEN concat('{"transaction_id":"TXN', CAST(o_orderkey AS STRING), '","customer_id":"C","account_id":"A","amount":-5,"currency":"EUR","transaction_type":"payment","status":"success","timestamp":"t","extra":1}')
  WHEN o_orderkey % 47 = 0 THEN concat('{"transaction_id":"TXN', CAST(o_orderkey AS STRING), '","customer_id":"C","account_id":"A","amount":7,"currency":"EUR","transaction_type":"refund","status":"success","timestamp":"2024-11-01T10:30:00Z","location":{"latitude":91.5,"country":"MA"},"metadata":null}')
  WHEN o_orderkey % 53 = 0 THEN concat('{"transaction_id":"TXNfail', CAST(o_orderkey AS STRING), '","customer_id":"C","account_id":"A","amount":7.25,"currency":"EUR","transaction_type":"payment","channel":"WEB","status":"success","timestamp":"2024-11-01T10:30:00Z","location":{"latitude":33.5,"longitude":-7.5,"zone":1}}')
  ELSE concat('{"transaction_id":"TXN', CAST(o_orderkey AS STRING), '","customer_id":"C', CAST(o_custkey AS STRING),
       '","account_id":"A', CAST(o_custkey % 10 AS STRING), '","amount":', CAST(o_orderkey % 1000 AS STRING),
       ',"currency":"EUR","transaction_type":"payment","status":"success","timestamp":"2024-11-01T10:30:00Z"}') END AS value
FROM orders
"""

VIEWS["txn_avro_msg"] = """
SELECT o_orderkey AS msg_offset, CASE
  WHEN o_orderkey % 29 = 0 THEN 'no json'
  WHEN o_orderkey % 31 = 0 THEN concat('{"transaction_id":', CAST(o_orderkey AS STRING), ',"customer_id":"C","account_id":"A","transaction_type":"payment","amount":1,"currency":"EUR","timestamp":1730419200000}')
  WHEN o_orderkey % 37 = 0 THEN concat('{"transaction_id":"T","customer_id":"C","account_id":"A","transaction_type":"payment","amount":1.005,"currency":"EUR","timestamp":1730419200000,"status":"pending"}')
  WHEN o_orderkey % 41 = 0 THEN concat('{"transaction_id":"T","customer_id":"C","account_id":"A","transaction_type":"payment","amount":1,"currency":"EUR","timestamp":1730419200000,"colour":"red"}')
  WHEN o_orderkey % 43 = 0 THEN concat('{"transaction_id":"T","customer_id":"C","transaction_type":"payment","amount":1,"currency":"EUR","timestamp":1730419200000}')
  WHEN o_orderkey % 47 = 0 THEN concat('{"transaction_id":"T","customer_id":"C","account_id":"A","transaction_type":"payment","amount":1,"currency":"EUR","timestamp":1730419200000,"status":null,"description":"d"}')
  ELSE concat('{"transaction_id":"T', CAST(o_orderkey AS STRING), '","customer_id":"C","account_id":"A","transaction_type":"payment","amount":', CAST(o_orderkey % 1000 AS STRING), '.25,"currency":"EUR","timestamp":1730419200000}') END AS value
FROM orders
"""

VIEWS["kyc_event"] = """
SELECT c_custkey, concat('{"customer_id":"CUST', CAST(c_custkey AS STRING), '","kyc_status":"VERIFIED","risk_score":0.', CAST(c_custkey % 9 + 1 AS STRING),
  ',"documents_verified":', CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END,
  ',"verification_date":', CAST(1730419200000 + c_custkey * 1000 AS STRING),
  ',"personal_info":{"first_name":"F', CAST(c_custkey AS STRING), '","last_name":"L","date_of_birth":"1990-01-', lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0'), '","nationality":"FR"}',
  ',"address":{"street":"S","city":"', c_mktsegment, '","postal_code":"10000","country":"FR"}',
  ',"compliance_flags":{"pep_check":false,"sanctions_check":', CASE WHEN c_custkey % 5 = 0 THEN 'true' ELSE 'false' END, ',"aml_risk":"LOW"}',
  ',"timestamp":', CAST(1730505600000 + c_custkey AS STRING), '}') AS value
FROM customer
"""

VIEWS["dlq"] = """
SELECT event_id AS msg_offset, ts,
  CASE event_type WHEN 'error' THEN 'dlq.transactions' WHEN 'click' THEN 'dlq.kyc_responses' WHEN 'view' THEN 'dlq.crm_customers' ELSE 'dlq.crm_customers_s3' END AS topic,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 5 AS INT) END AS retry_count,
  CASE WHEN event_id % 11 = 0 THEN '{}' WHEN event_id % 13 = 0 THEN 'not json' ELSE props END AS payload,
  CASE event_id % 3 WHEN 0 THEN 'schemas/transaction_schema.json' WHEN 1 THEN 'topics/transactions.avsc' ELSE '' END AS schema_path
FROM events
"""

# Dead letters as raw messages: the envelope around a transaction message.
VIEWS["letters"] = f"""
SELECT msg_offset,
  CASE WHEN msg_offset % 59 = 0 THEN 'broken {{' ELSE concat('{{"payload":',
    CASE WHEN value IS NULL THEN 'null' WHEN value = '{{"transaction_id":"TXN' THEN '"cut"' ELSE value END,
    CASE msg_offset % 7 WHEN 0 THEN ',"schema_path":"schemas/other.json"' WHEN 1 THEN ',"schema_path":"notes.txt"' WHEN 2 THEN ''
         ELSE ',"schema_path":"schemas/transaction_schema.json"' END,
    CASE msg_offset % 6 WHEN 0 THEN '' ELSE concat(',"retry_count":', CAST(msg_offset % 6 - 1 AS STRING)) END, '}}') END AS value
FROM ({VIEWS["txn_msg"]}) m
"""

VIEWS["reqlog"] = """
SELECT event_id AS seq, ts, value / 100 AS duration_s,
  CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 3 = 0 THEN 503 ELSE 500 END ELSE 200 END AS status_code,
  CASE WHEN event_type = 'error' THEN concat('HTTP ', CASE WHEN event_id % 3 = 0 THEN '503' ELSE '500' END, ': node ', CAST(user_id % 4 AS STRING)) END AS error,
  CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 'baseline' WHEN ts < TIMESTAMP '2024-01-21 00:00:00' THEN 'chaos' ELSE 'recovery' END AS phase
FROM events
"""

VIEWS["scoring"] = """
SELECT event_id, concat('CUST', lpad(CAST(user_id AS STRING), 8, '0')) AS customer_id,
  CAST(290 + event_id % 570 AS INT) AS credit_score,
  CASE event_id % 5 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'VERY_HIGH' ELSE 'NONE' END AS risk_level,
  value - 1 AS approved_amount, ts AS created_at
FROM events
"""

VIEWS["scoring_stored"] = """
SELECT event_id, concat('CUST', lpad(CAST(user_id AS STRING), 8, '0')) AS customer_id,
  CAST(CASE WHEN event_id % 97 = 0 THEN 291 ELSE 290 END + event_id % 570 AS INT) AS credit_score
FROM events WHERE value >= 1
"""

VIEWS["cdc"] = """
SELECT event_id AS msg_offset, concat('K', CAST(user_id AS STRING)) AS id,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS after_status, event_type = 'error' AS is_delete, value
FROM events
"""

# Change messages: tombstone, flat new state, or an envelope with its after image.
VIEWS["cdc_msg"] = """
SELECT event_id AS msg_offset, concat('K', CAST(user_id AS STRING)) AS msg_key,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_type = 'click' THEN concat('{"id":"K', CAST(user_id AS STRING), '","status":"', event_type, '"}')
       WHEN event_type = 'view' THEN '{"before":{"id":"K"},"after":null}'
       ELSE concat('{"before":null,"after":{"id":"K', CAST(user_id AS STRING), '","status":"', event_type, '"}}') END AS value
FROM events
"""

VIEWS["requests"] = """
SELECT event_id AS request_id, concat('CUST', lpad(CAST(user_id AS STRING), 8, '0')) AS customer_id, ts
FROM events
"""

VIEWS["results"] = """
SELECT event_id AS request_id, concat('CUST', lpad(CAST(user_id AS STRING), 8, '0')) AS customer_id,
  ts + (event_id % 60) * INTERVAL '1' SECOND AS ts
FROM events WHERE value >= 5
"""

VIEWS["ingest"] = """
SELECT event_id AS id, event_id * 1000 AS created_ms,
  CASE WHEN value < 0.5 THEN NULL ELSE event_id * 1000 + event_id % 7000 END AS arrived_ms
FROM events
"""

VIEWS["consents"] = """
SELECT c_custkey, concat('CUST', lpad(CAST(c_custkey AS STRING), 8, '0')) AS customer_id
FROM customer WHERE c_mktsegment <> 'MACHINERY'
"""

VIEWS["access_log"] = """
SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS user_id, ts AS access_ts,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS action,
  CASE WHEN event_id % 3 = 0 THEN 'sensitive' ELSE 'public' END AS data_type
FROM events
"""

VIEWS["audit_changes"] = """
SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS user_id, ts AS change_ts,
  concat('v', CAST(event_id % 9 AS STRING)) AS old_version,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE concat('v', CAST(event_id % 9 + 1 AS STRING)) END AS new_version,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_type END AS reason
FROM events
"""

# Customer messages with names that are too short, too long and just short enough.
VIEWS["crm_msg"] = """
SELECT c_custkey AS msg_offset, concat('{"customer_id":"CUST', CAST(c_custkey AS STRING), '","first_name":"',
  CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN repeat('a', 101) ELSE concat('F', CAST(c_custkey AS STRING)) END,
  '","last_name":"', CASE WHEN c_custkey % 13 = 0 THEN repeat('x', 101) WHEN c_custkey % 17 = 0 THEN repeat('é', 100) ELSE c_name END,
  '","email":"u@example.com","account_status":"active","created_at":"2024-01-01T00:00:00Z"}') AS value
FROM customer
"""

# Fields of identity-check documents.
VIEWS["kyc_document"] = """
SELECT c_custkey, concat('CUST', lpad(CAST(c_custkey AS STRING), 8, '0')) AS customer_id,
  CASE c_custkey % 3 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN 'PENDING' ELSE NULL END AS kyc_status,
  CAST(c_custkey % 9 AS DOUBLE) / 8 AS risk_score, c_custkey % 2 = 0 AS documents_verified,
  1730419200000 + c_custkey * 1000 AS verification_date
FROM customer
"""

# Scan reports: one per customer, with an array of findings.
VIEWS["scan_report"] = """
SELECT c_custkey AS report_id, concat('{"results":{"findings":[',
  CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '{"severity":"HIGH"}' WHEN 2 THEN '{"severity":"LOW"},{"severity":"HIGH"}'
       ELSE '{"severity":"LOW"},{"severity":"MEDIUM"},{"severity":"CRITICAL"}' END, ']}}') AS report
FROM customer
"""
