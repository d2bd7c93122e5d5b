"""Dead letters and service analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.contracts import builtin
from custodia.functions.json_schema import non_empty_object
from custodia.operators import deadletter, matching, quality, service
from custodia.plans import jobs
from custodia.sources.writers import load_report
from custodia.streaming.dead_letters import retry_message, triage_letters
from workload.records import TXN_ERRORS, TXN_SCHEMA
from workload.registry import query
from workload.tables import AS_OF, as_of

ISO_AS_OF = "2024-01-31T00:00:00.000000"

# --- dead letters -------------------------------------------------------------------------------

ROUTED = """r AS (SELECT msg_offset, payload, coalesce(retry_count, 0) AS n, json_valid(payload) AND payload <> '{}' AS ok FROM dlq)"""


@query(
    "dlq_route",
    f"""WITH {ROUTED}
    SELECT msg_offset, CASE WHEN ok AND n < 3 THEN 'retry' ELSE 'archive' END AS route,
      CASE WHEN NOT ok THEN 'validation_failed' WHEN n >= 3 THEN 'max_retry' END AS reason,
      CASE WHEN ok AND n < 3 THEN n + 1 ELSE n END AS retry_count,
      CASE WHEN ok AND n < 3 THEN '{ISO_AS_OF}' END AS last_retry_at FROM r""",
    "dlq",
)
def dlq_route(d):
    routed = deadletter.route(d.view("dlq"), non_empty_object(F.col("payload")), clock=as_of())
    return routed.select("msg_offset", "route", "reason", "retry_count", "last_retry_at")


@query(
    "dlq_archive",
    f"""WITH {ROUTED}
    SELECT payload AS message, CASE WHEN NOT ok THEN 'Validation échouée' ELSE 'Nombre max de retry atteint' END AS error_reason,
      '{ISO_AS_OF}' AS archived_at FROM r WHERE NOT ok OR n >= 3""",
    "dlq",
)
def dlq_archive(d):
    routed = deadletter.route(d.view("dlq"), non_empty_object(F.col("payload")), clock=as_of())
    return deadletter.to_archive(routed, "payload", deadletter.RETRY_MANAGER_REASONS, as_of())


def catalogue() -> dict[str, dict]:
    return {TXN_SCHEMA: builtin("transaction.schema.json"), "topics/transactions.avsc": builtin("transaction.avsc")}


LETTERS = f"""{TXN_ERRORS}, l AS (
  SELECT m.msg_offset, m.msg_offset % 59 <> 0 AS decodable, CASE WHEN m.msg_offset % 6 = 0 THEN 0 ELSE m.msg_offset % 6 - 1 END AS n,
    m.msg_offset % 7 NOT IN (0, 1, 2) AND m.msg_offset NOT IN (SELECT msg_offset FROM found) AS ok FROM txn_msg m)"""


@query(
    "dlq_triage_by_schema",
    f"""WITH {LETTERS}
    SELECT msg_offset, CASE WHEN decodable AND ok AND n < 3 THEN 'retry' ELSE 'archive' END AS route,
      CASE WHEN NOT decodable THEN 'undecodable' WHEN NOT ok THEN 'validation_failed' WHEN n >= 3 THEN 'max_retry' END AS reason,
      CASE WHEN NOT decodable THEN 0 WHEN ok AND n < 3 THEN n + 1 ELSE n END::INT AS retry_count FROM l""",
    "txn_msg",
)
def dlq_triage_by_schema(d):
    routed = triage_letters(d.view("letters"), catalogue(), clock=as_of())
    return routed.select("msg_offset", "route", "reason", "retry_count")


@query(
    "dlq_retry_messages",
    f"""WITH {LETTERS}
    SELECT (n + 1)::INT AS retry_count, json_extract_string(m.value, '$.transaction_id') AS transaction_id, '{ISO_AS_OF}' AS last_retry_at
    FROM l JOIN txn_msg m ON m.msg_offset = l.msg_offset WHERE decodable AND ok AND n < 3""",
    "txn_msg",
)
def dlq_retry_messages(d):
    again = retry_message(triage_letters(d.view("letters"), catalogue(), clock=as_of()))
    return again.select(
        F.get_json_object("value", "$.retry_count").cast("int").alias("retry_count"),
        F.get_json_object("value", "$.payload.transaction_id").alias("transaction_id"),
        F.get_json_object("value", "$.last_retry_at").alias("last_retry_at"),
    )


@query(
    "retry_backoff_due",
    """WITH s AS (SELECT msg_offset, coalesce(retry_count, 0) AS retry_count, ts + to_seconds(CAST(pow(2, coalesce(retry_count, 0)) AS BIGINT)) AS next_retry_at FROM dlq)
    SELECT msg_offset, retry_count, next_retry_at FROM s
    WHERE retry_count < 3 AND next_retry_at <= TIMESTAMP '2024-01-15 00:00:00'""",
    "dlq",
)
def retry_backoff_due(d):
    scheduled = deadletter.schedule_retry(d.view("dlq"))
    return deadletter.due(scheduled, as_of("2024-01-15 00:00:00")).select("msg_offset", "retry_count", "next_retry_at")


@query(
    "retry_exceeded",
    """SELECT concat('{"original_message":', payload, ',"reason":"MaxRetryExceeded"}') AS value, concat('dlq.', replace(topic, 'dlq.', '')) AS topic
    FROM dlq WHERE retry_count >= 3""",
    "dlq",
)
def retry_exceeded(d):
    over = deadletter.schedule_retry(d.view("dlq")).filter(F.col("route") == deadletter.DLQ)
    return over.select(deadletter.dead_letter_message(F.col("payload"), F.col("reason")).alias("value"), "topic")


DLQ_TOPICS = ["dlq.crm_customers", "dlq.crm_customers_s3", "dlq.kyc_responses", "dlq.transactions", "dlq.scoring"]


@query(
    "dlq_depth",
    f"""SELECT t.topic, count(d.msg_offset) AS messages FROM (SELECT unnest({DLQ_TOPICS}) AS topic) t
    LEFT JOIN dlq d ON d.topic = t.topic GROUP BY t.topic""",
    "dlq",
)
def dlq_depth(d):
    return deadletter.depth(d.view("dlq"), DLQ_TOPICS)


@query(
    "dlq_depth_alert",
    """SELECT true AS alert, string_agg(concat(n, ' messages en erreur dans le topic ', topic), chr(10) ORDER BY topic) AS body
    FROM (SELECT topic, count(*) AS n FROM dlq GROUP BY topic)""",
    "dlq",
)
def dlq_depth_alert(d):
    return deadletter.alert(deadletter.depth(d.view("dlq"), DLQ_TOPICS))


# --- load, phases, service levels ---------------------------------------------------------------

OK = "status_code = 200 AND coalesce(error, '') = ''"


def summary_sql(by: str = "") -> str:
    group, head = (f" GROUP BY {by}", f"{by}, ") if by else ("", "")
    return f"""SELECT {head}count(*) AS total, count(*) FILTER ({OK}) AS ok, count(*) FILTER (NOT ({OK})) AS failed,
      coalesce(count(*) FILTER ({OK}) / nullif(count(*), 0), 0) AS success_rate, coalesce(avg(duration_s) FILTER ({OK}), 0) AS mean_s,
      min(duration_s) FILTER ({OK}) AS min_s, max(duration_s) FILTER ({OK}) AS max_s,
      count(*) / CASE WHEN max(ts) > min(ts) THEN (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 ELSE 1.0 END AS throughput
    FROM reqlog{group}"""


def exclusive_sql(source: str, parts: dict[str, tuple[int, int]], by: str = "") -> str:
    """Exclusive quantiles spelled out by rank."""
    over = f"PARTITION BY {by} " if by else ""
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    picks = []
    for name, (i, k) in parts.items():
        j = f"greatest(1, least(n - 1, ({i} * (n + 1)) // {k}))"
        low, high = f"max(CASE WHEN rn = {j} THEN v END)", f"max(CASE WHEN rn = {j} + 1 THEN v END)"
        delta = f"max({i} * (n + 1) - {j} * {k})"
        picks.append(f"round(coalesce(CASE WHEN max(n) < {k} THEN max(v) ELSE ({low} * ({k} - {delta}) + {high} * {delta}) / {k}.0 END, 0), 9) AS {name}")
    return f"""SELECT {head}{', '.join(picks)} FROM (
      SELECT {head}duration_s AS v, row_number() OVER ({over}ORDER BY duration_s) AS rn, count(*) OVER ({over}) AS n
      FROM {source} WHERE {OK}){tail}"""


TAIL_PARTS = {"p95_s": (19, 20), "p99_s": (99, 100)}
ROUNDED = ["success_rate", "mean_s", "throughput"]


def rounded(frame, names, digits: int = 9):
    return frame.withColumns({n: F.round(n, digits) for n in names})


def rounded_sql(sql: str, names=tuple(ROUNDED), digits: int = 9) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({n}, {digits}) AS {n}' for n in names)}) FROM ({sql})"


@query("load_summary", rounded_sql(summary_sql()), "reqlog")
def load_summary(d):
    return rounded(service.load_summary(d.view("reqlog")), ROUNDED)


@query("load_summary_by_phase", rounded_sql(summary_sql("phase")), "reqlog")
def load_summary_by_phase(d):
    return rounded(service.load_summary(d.view("reqlog"), ["phase"]), ROUNDED)


@query("load_quantiles", exclusive_sql("reqlog", TAIL_PARTS), "reqlog")
def load_quantiles(d):
    return rounded(service.load_quantiles(d.view("reqlog")), TAIL_PARTS)


@query("load_quantiles_by_phase", exclusive_sql("reqlog", TAIL_PARTS, "phase"), "reqlog")
def load_quantiles_by_phase(d):
    return rounded(service.load_quantiles(d.view("reqlog"), ["phase"]), TAIL_PARTS)


SKETCH_ERROR = 0.01  # share of the rows by which the rank of a merged tail may be off


@query("load_quantiles_sketch")
def load_quantiles_sketch(d):
    return service.load_quantiles_approx(d.view("reqlog"), ["phase"])


@query(
    "load_quantiles_sketch_error",
    f"""SELECT phase, quantile, true AS within_error FROM (SELECT DISTINCT phase FROM reqlog WHERE {OK}), (VALUES ('p95_s'), ('p99_s')) v(quantile)""",
    "reqlog",
)
def load_quantiles_sketch_error(d):
    """Whether the exact rank of each estimate is within the promised share of the rows."""
    log, accuracy = d.view("reqlog"), 10_000
    estimates = service.load_quantiles_approx(log, ["phase"], accuracy)
    times = log.filter(service.succeeded()).select("phase", "duration_s").join(estimates, "phase")
    counts = [F.count("*").alias("n")]
    for name in service.TAILS:
        counts += [F.count_if(F.col("duration_s") < F.col(name)).alias(f"{name}_below"), F.count_if(F.col("duration_s") <= F.col(name)).alias(f"{name}_upto")]
    checks = []
    for name, (i, k) in service.TAILS.items():
        rank, error = F.col("n") * (i / k), F.col("n") / accuracy + 1
        within = (F.col(f"{name}_below") <= rank + error) & (F.col(f"{name}_upto") >= rank - error)
        checks.append(F.struct(F.lit(name).alias("quantile"), within.alias("within_error")))
    return times.groupBy("phase").agg(*counts).select("phase", F.inline(F.array(*checks)))


@query(
    "top_errors",
    """SELECT error[1:100] AS error, count(*) AS occurrences FROM (
      SELECT error FROM reqlog WHERE coalesce(error, '') <> '' ORDER BY seq LIMIT 20) GROUP BY error""",
    "reqlog",
)
def top_errors(d):
    return service.top_errors(d.view("reqlog"))


@query(
    "top_errors_by_phase",
    """SELECT phase, error[1:60] AS error, count(*) AS occurrences FROM (
      SELECT phase, error, row_number() OVER (PARTITION BY phase ORDER BY seq) AS n FROM reqlog WHERE coalesce(error, '') <> '')
    WHERE n <= 10 GROUP BY ALL""",
    "reqlog",
)
def top_errors_by_phase(d):
    return service.top_errors(d.view("reqlog"), 10, 60, ["phase"])


@query(
    "phase_report",
    f"""SELECT phase, count(*) AS requests, round(count(*) FILTER ({OK}) * 100 / count(*), 9) AS success_pct,
      round(avg(duration_s) FILTER ({OK}), 9) AS mean_s, max(duration_s) FILTER ({OK}) AS max_s,
      count(*) FILTER (NOT ({OK})) AS errors, count(*) FILTER ({OK}) > 0 AS has_success FROM reqlog GROUP BY phase""",
    "reqlog",
)
def phase_report(d):
    return rounded(service.phase_report(d.view("reqlog")), ["success_pct", "mean_s"])


@query(
    "phase_degradation",
    f"""WITH w AS (SELECT avg(duration_s) FILTER ({OK} AND phase = 'baseline') AS b, avg(duration_s) FILTER ({OK} AND phase = 'chaos') AS c,
      count(*) FILTER (NOT ({OK}) AND phase = 'baseline') AS be, count(*) FILTER (NOT ({OK}) AND phase = 'chaos') AS ce,
      count(*) FILTER (NOT ({OK}) AND phase = 'recovery') AS re FROM reqlog), x AS (SELECT *, (c - b) / b * 100 AS g FROM w)
    SELECT round(b, 9) AS baseline_mean_s, round(c, 9) AS chaos_mean_s, be AS baseline_errors, ce AS chaos_errors, re AS recovery_errors,
      round(g, 6) AS degradation_pct, CASE WHEN abs(g) < 50 THEN 'GOOD' WHEN abs(g) < 200 THEN 'MODERATE' ELSE 'POOR' END AS resilience,
      ce > be * 2 AS improve_error_handling, g > 100 AS add_queuing, re > ce AS improve_recovery FROM x""",
    "reqlog",
)
def phase_degradation(d):
    impact = service.phase_impact(d.view("reqlog"))
    return rounded(rounded(impact, ["baseline_mean_s", "chaos_mean_s"]), ["degradation_pct"], 6)


SLO_SQL = f"""s AS ({summary_sql()}), q AS ({exclusive_sql("reqlog", TAIL_PARTS)}),
m AS (SELECT 'availability' AS slo, success_rate AS current FROM s
  UNION ALL SELECT 'latency_p95', p95_s * 1000 FROM q UNION ALL SELECT 'throughput', throughput FROM s
  UNION ALL SELECT 'error_rate', failed / total FROM s
  UNION ALL SELECT 'data_freshness', (SELECT (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts))) / 1000000.0 FROM reqlog)),
d (slo, target, warning, critical, higher) AS (VALUES ('availability', 0.999, 0.99, 0.95, true), ('latency_p95', 500.0, 750.0, 1000.0, false),
  ('throughput', 1000.0, 750.0, 500.0, true), ('error_rate', 0.001, 0.005, 0.01, false), ('data_freshness', 3600.0, 7200.0, 14400.0, false)),
r AS (SELECT d.slo, d.target::DOUBLE AS target, m.current, CASE WHEN higher THEN current >= target ELSE current <= target END AS compliant,
  abs(current - target) / target AS deviation,
  CASE WHEN CASE WHEN higher THEN current >= target ELSE current <= target END THEN 'ok'
    WHEN CASE WHEN higher THEN current >= warning ELSE current <= warning END THEN 'warning'
    WHEN CASE WHEN higher THEN current >= critical ELSE current <= critical END THEN 'degraded' ELSE 'critical' END AS status
  FROM d JOIN m ON d.slo = m.slo)"""


def slos(d):
    log = d.view("reqlog")
    measured = service.service_metrics(
        service.load_summary(log), service.load_quantiles(log), quality.freshness(log, "ts", as_of().cast("timestamp"))
    )
    return service.slo_report(measured, service.slo_definitions(log))


@query(
    "slo_report",
    f"WITH {SLO_SQL} SELECT slo, target, round(current, 6) AS current, compliant, round(deviation, 6) AS deviation, status FROM r",
    "reqlog",
)
def slo_report(d):
    return rounded(slos(d), ["current", "deviation"], 6)


@query(
    "slo_overall",
    f"""WITH {SLO_SQL}, o AS (SELECT avg(compliant::INT) AS c FROM r)
    SELECT c AS overall_compliance, CASE WHEN c >= 0.95 THEN 'excellent' WHEN c >= 0.9 THEN 'good' WHEN c >= 0.8 THEN 'acceptable' ELSE 'poor' END AS grade,
      c >= 0.9 AS passed FROM o""",
    "reqlog",
)
def slo_overall(d):
    return service.slo_overall(slos(d))


@query(
    "load_verdict",
    f"""WITH s AS ({summary_sql()}), q AS ({exclusive_sql("reqlog", TAIL_PARTS)})
    SELECT CASE WHEN success_rate >= 0.95 THEN 'EXCELLENT' WHEN success_rate >= 0.9 THEN 'GOOD' ELSE 'POOR' END AS overall,
      success_rate >= 0.999 AS availability_met, p95_s <= 0.5 AS latency_met, throughput >= 100 AS throughput_met,
      mean_s > 1 AS optimise_queries, p95_s > 2 AS add_queuing, success_rate < 0.99 AS investigate_errors, throughput < 50 AS scale_out FROM s, q""",
    "reqlog",
)
def load_verdict(d):
    log = d.view("reqlog")
    return service.load_verdict(service.load_summary(log), service.load_quantiles(log))


@query(
    "service_report_job",
    f"""WITH {SLO_SQL}, o AS (SELECT avg(compliant::INT) AS c FROM r),
    w AS (SELECT avg(duration_s) FILTER ({OK} AND phase = 'baseline') AS b, avg(duration_s) FILTER ({OK} AND phase = 'chaos') AS c FROM reqlog)
    SELECT 'slo' AS part, slo AS item, status AS value FROM r
    UNION ALL SELECT 'overall', 'grade', CASE WHEN c >= 0.95 THEN 'excellent' WHEN c >= 0.9 THEN 'good' WHEN c >= 0.8 THEN 'acceptable' ELSE 'poor' END FROM o
    UNION ALL SELECT 'verdict', 'overall', CASE WHEN success_rate >= 0.95 THEN 'EXCELLENT' WHEN success_rate >= 0.9 THEN 'GOOD' ELSE 'POOR' END FROM s
    UNION ALL SELECT 'summary', 'failed', failed::VARCHAR FROM s
    UNION ALL SELECT 'phase', phase, count(*)::VARCHAR FROM reqlog GROUP BY phase
    UNION ALL SELECT 'impact', 'resilience', CASE WHEN abs((c - b) / b) < 0.5 THEN 'GOOD' WHEN abs((c - b) / b) < 2 THEN 'MODERATE' ELSE 'POOR' END FROM w""",
    "reqlog",
)
def service_report_job(d):
    report = jobs.report_service(d.view("reqlog"), as_of().cast("timestamp"))

    def rows(frame, part, item, value):
        return frame.select(F.lit(part).alias("part"), item.alias("item"), F.col(value).cast("string").alias("value"))

    return (
        rows(report.slos, "slo", F.col("slo"), "status")
        .unionByName(rows(report.overall, "overall", F.lit("grade"), "grade"))
        .unionByName(rows(report.verdict, "verdict", F.lit("overall"), "overall"))
        .unionByName(rows(report.summary, "summary", F.lit("failed"), "failed"))
        .unionByName(rows(report.phases, "phase", F.col("phase"), "requests"))
        .unionByName(rows(report.impact, "impact", F.lit("resilience"), "resilience"))
    )


@query(
    "batch_gates",
    f"""WITH s AS ({summary_sql("phase")})
    SELECT phase, success_rate >= 0.95 AS success_gate, mean_s < 2 AS mean_gate, max_s < 10 AS max_gate,
      success_rate >= 0.95 AND mean_s < 2 AND max_s < 10 AS passed, success_rate > 0.8 AS cascade_passed FROM s""",
    "reqlog",
)
def batch_gates(d):
    gates = service.batch_gate(service.load_summary(d.view("reqlog"), ["phase"]))
    return gates.select("phase", "success_gate", "mean_gate", "max_gate", "passed", "cascade_passed")


@query(
    "daily_trend",
    f"""WITH dated AS (SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM reqlog),
    t AS (SELECT day, count(*) AS requests, round(avg(duration_s) FILTER ({OK}), 9) AS mean_s, round(count(*) / 86400, 9) AS throughput,
      round(count(*) FILTER (NOT ({OK})) / count(*), 9) AS error_rate, count(*) FILTER (NOT ({OK})) / count(*) <= 0.001 AS slo_met FROM dated GROUP BY day),
    q AS ({exclusive_sql("dated", {"p95_s": (19, 20)}, "day")})
    SELECT t.*, q.p95_s FROM t LEFT JOIN q ON t.day = q.day""",
    "reqlog",
)
def daily_trend(d):
    trend = service.daily_trend(d.view("reqlog")).withColumn("day", F.col("day").cast("string"))
    return rounded(trend, ["mean_s", "throughput", "error_rate", "p95_s"])


@query(
    "slo_rolling_24h",
    f"""WITH ends AS (SELECT unnest(generate_series(
        (SELECT date_trunc('hour', min(ts)) + INTERVAL 1 HOUR FROM reqlog), (SELECT date_trunc('hour', max(ts)) + INTERVAL 24 HOUR FROM reqlog), INTERVAL 1 HOUR)) AS window_end)
    SELECT window_end, count(*) AS requests, count(*) FILTER (NOT ({OK})) AS errors,
      round(1 - count(*) FILTER (NOT ({OK})) / count(*), 13) AS availability, round(avg(duration_s) FILTER ({OK}), 13) AS mean_s
    FROM ends JOIN reqlog ON ts >= window_end - INTERVAL 24 HOUR AND ts < window_end GROUP BY window_end""",
    "reqlog",
)
def slo_rolling_24h(d):
    levels = service.rolling_levels(d.view("reqlog"))
    return rounded(levels.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")), ["availability", "mean_s"], 13)


@query(
    "severity_counts",
    """WITH f AS (SELECT unnest(json_extract_string(report, '$.results.findings[*].severity')) AS severity FROM scan_report)
    SELECT severity, count(*) AS findings FROM f GROUP BY severity""",
    "scan_report",
)
def severity_counts(d):
    shape = "results struct<findings: array<struct<severity: string>>>"
    parsed = d.view("scan_report").select(F.from_json("report", shape).alias("r")).select("r.results.findings")
    return service.severity_counts(parsed)


@query(
    "findings_per_report",
    "SELECT report_id, json_array_length(report, '$.results.findings')::INT AS findings FROM scan_report",
    "scan_report",
)
def findings_per_report(d):
    return service.findings_per_report(d.view("scan_report"), "report_id", "report", "$.results.findings")


PHASE_METRICS = """SELECT 'mean_s' AS metric, avg(duration_s) FILTER ({ok} AND phase = '{phase}') AS value FROM reqlog
  UNION ALL SELECT 'max_s', max(duration_s) FILTER ({ok} AND phase = '{phase}') FROM reqlog
  UNION ALL SELECT 'failed', count(*) FILTER (NOT ({ok}) AND phase = '{phase}') FROM reqlog"""


@query(
    "perf_regression",
    f"""WITH b AS ({PHASE_METRICS.format(ok=OK, phase="baseline")}), c AS ({PHASE_METRICS.format(ok=OK, phase="chaos")})
    SELECT c.metric, round(c.value, 9) AS current_value, round(b.value, 9) AS baseline_value,
      round((c.value - b.value) / b.value * 100, 6) AS change_pct, (c.value - b.value) / b.value * 100 > 10 AS regressed
    FROM c JOIN b ON b.metric = c.metric""",
    "reqlog",
)
def perf_regression(d):
    by_phase = service.load_summary(d.view("reqlog"), ["phase"])

    def metrics(phase: str):
        pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in ("mean_s", "max_s", "failed")]
        return by_phase.filter(F.col("phase") == phase).select(F.inline(F.array(*pairs)))

    compared = matching.metric_regression(metrics("chaos"), metrics("baseline"))
    return rounded(rounded(compared, ["current_value", "baseline_value"]), ["change_pct"], 6)


@query(
    "ingest_latency",
    """SELECT count(arrived_ms) AS messages, round(avg(arrived_ms - created_ms), 6) AS mean_ms, avg(arrived_ms - created_ms) < 5000 AS within_limit FROM ingest""",
    "ingest",
)
def ingest_latency(d):
    return rounded(service.ingestion_latency(d.view("ingest"), "created_ms", F.col("arrived_ms")), ["mean_ms"], 6)


@query(
    "load_report",
    f"""WITH s AS ({summary_sql()}), e AS (SELECT error FROM reqlog WHERE coalesce(error, '') <> '' ORDER BY seq LIMIT 100)
    SELECT '50' AS concurrent_users, total, failed, (SELECT string_agg(error, '|') FROM e) AS errors FROM s""".replace(
        "(SELECT string_agg(error, '|') FROM e)", "(SELECT string_agg(error, '|' ORDER BY seq) FROM e)"
    ).replace("SELECT error FROM reqlog WHERE", "SELECT seq, error FROM reqlog WHERE"),
    "reqlog",
)
def load_report_query(d):
    log = d.view("reqlog")
    report = load_report(service.load_summary(log), log, {"concurrent_users": "50", "duration_seconds": "300"})
    return report.select(
        F.col("test_config")["concurrent_users"].alias("concurrent_users"), "summary.total", "summary.failed",
        F.array_join("errors", "|").alias("errors"),
    )


@query(
    "slo_rolling_tails",
    f"""WITH ok AS (SELECT ts FROM reqlog WHERE {OK} AND duration_s IS NOT NULL),
    ends AS (SELECT unnest(range(date_trunc('hour', min(ts)) + INTERVAL 1 HOUR, date_trunc('hour', max(ts)) + INTERVAL 25 HOUR, INTERVAL 1 HOUR)) AS window_end FROM ok)
    SELECT window_end, quantile, count(*) AS served, true AS within_error FROM ends JOIN ok ON ts >= window_end - INTERVAL 24 HOUR AND ts < window_end,
      (VALUES ('p95_s'), ('p99_s')) v(quantile) GROUP BY ALL""",
    "reqlog",
)
def slo_rolling_tails(d):
    """Tails of every 24 hours from stored hourly sketches, and whether the exact rank of each is within the promised error."""
    stored = d.scratch()
    log = d.view("reqlog")
    service.hourly_tails(log).write.parquet(stored)
    tails = service.rolling_tails(d.spark.read.parquet(stored))
    times = log.filter(service.succeeded()).select(F.col("ts").cast("timestamp").alias("ts"), "duration_s")
    # The check alone reads requests; each lies in 24 windows.
    hours = times.withColumn("window_end", F.explode(F.sequence(F.expr("date_trunc('hour', ts) + INTERVAL 1 HOUR"), F.expr("date_trunc('hour', ts) + INTERVAL 24 HOUR"), F.expr("INTERVAL 1 HOUR"))))
    joined = hours.join(tails, "window_end")
    checks = []
    for name, (i, k) in service.TAILS.items():
        below, upto = F.count_if(F.col("duration_s") < F.col(name)), F.count_if(F.col("duration_s") <= F.col(name))
        error = F.greatest(F.lit(1.0), F.count("*") * F.lit(SKETCH_ERROR))
        checks.append(F.struct(F.lit(name).alias("quantile"), ((below <= F.count("*") * (i / k) + error) & (upto >= F.count("*") * (i / k) - error)).alias("within_error")))
    found = joined.groupBy("window_end", "served").agg(F.array(*checks).alias("checks"))
    return found.select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "served", F.inline("checks"))
