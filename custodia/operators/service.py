"""Service analytics on request logs: load, phases, service levels, trends.

A request log has one row per request: ``seq`` (arrival order), ``ts``, ``duration_s``,
``status_code``, ``error`` (null when none) and, where phases are compared, ``phase``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custodia.functions.statistics import Fraction, exact_quantiles

TAILS: dict[str, Fraction] = {"p95_s": (19, 20), "p99_s": (99, 100)}
PHASES = ["baseline", "chaos", "recovery"]

# Service levels with target, warning and critical limits and the better direction.
SLO_ROWS = [
    ("availability", 0.999, 0.99, 0.95, "higher"),
    ("latency_p95", 500.0, 750.0, 1000.0, "lower"),
    ("throughput", 1000.0, 750.0, 500.0, "higher"),
    ("error_rate", 0.001, 0.005, 0.01, "lower"),
    ("data_freshness", 3600.0, 7200.0, 14400.0, "lower"),
]
SLO_SCHEMA = "slo string, target double, warning double, critical double, direction string"
COMPLIANCE_GATE = 0.9


def succeeded() -> Column:
    """Status 200 and no error text; never null."""
    no_error = F.coalesce(F.col("error"), F.lit("")) == ""
    return F.coalesce((F.col("status_code") == 200) & no_error, F.lit(False))


def load_summary(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals, success rate, response times of successful requests and throughput."""
    ok = succeeded()
    taken = F.when(ok, F.col("duration_s"))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = (F.max(micros) - F.min(micros)) / 1_000_000
    total = F.count("*")
    return log.groupBy(*(by or [])).agg(
        total.alias("total"),
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.try_divide(F.count_if(ok), total), F.lit(0.0)).alias("success_rate"),
        F.coalesce(F.avg(taken), F.lit(0.0)).alias("mean_s"),
        F.min(taken).alias("min_s"),
        F.max(taken).alias("max_s"),
        # A log without a span (empty, or one instant) counts as one second long.
        (total / F.when(span > 0, span).otherwise(F.lit(1.0))).alias("throughput"),
    )


def load_quantiles(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Exact p95 and p99 of successful response times, by the exclusive definition; zero without any."""
    by = by or []
    found = exact_quantiles(log.filter(succeeded()), "duration_s", TAILS, by, "exclusive")
    return found.select(*by, *[F.coalesce(name, F.lit(0.0)).alias(name) for name in TAILS])


def load_quantiles_approx(log: DataFrame, by: list[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """One-pass p95 and p99 from a sketch, for dashboards."""
    taken = F.when(succeeded(), F.col("duration_s"))
    return log.groupBy(*(by or [])).agg(
        *[F.percentile_approx(taken, i / k, accuracy).alias(name) for name, (i, k) in TAILS.items()]
    )


def top_errors(log: DataFrame, first: int = 20, width: int = 100, by: list[str] | None = None) -> DataFrame:
    """Counts of error texts among the first errors by arrival, most frequent first.

    The cut after ``first`` errors is part of the report. Each task keeps at most that many rows
    per group before anything is shuffled.
    """
    by = by or []
    errors = log.filter(F.coalesce(F.col("error"), F.lit("")) != "").select(*by, "seq", "error")
    if by:
        arrival = F.row_number().over(Window.partitionBy(*by).orderBy("seq"))
        early = errors.withColumn("_n", arrival).filter(F.col("_n") <= first)
    else:
        early = errors.orderBy("seq").limit(first)
    return (
        early.groupBy(*by, "error")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(*by, F.desc("occurrences"), "error")
        .select(*by, F.substring("error", 1, width).alias("error"), "occurrences")
    )


def phase_report(log: DataFrame) -> DataFrame:
    """Requests, success share, mean and maximum time and errors per phase."""
    report = load_summary(log, ["phase"])
    return report.select(
        "phase",
        F.col("total").alias("requests"),
        (F.col("success_rate") * 100).alias("success_pct"),
        F.when(F.col("ok") > 0, F.col("mean_s")).alias("mean_s"),
        "max_s",
        F.col("failed").alias("errors"),
        (F.col("ok") > 0).alias("has_success"),
    )


def phase_impact(log: DataFrame) -> DataFrame:
    """Degradation of the chaos phase against the baseline, its class and the advice that follows.

    A phase without successful requests gives null degradation and null class.
    """
    ok = succeeded()

    def mean_of(phase: str) -> Column:
        return F.avg(F.when(ok & (F.col("phase") == phase), F.col("duration_s")))

    def errors_of(phase: str) -> Column:
        return F.count_if(~ok & (F.col("phase") == phase))

    wide = log.agg(
        mean_of("baseline").alias("baseline_mean_s"),
        mean_of("chaos").alias("chaos_mean_s"),
        *[errors_of(p).alias(f"{p}_errors") for p in PHASES],
    )
    change = F.try_divide(F.col("chaos_mean_s") - F.col("baseline_mean_s"), F.col("baseline_mean_s")) * 100
    size = F.abs(F.col("degradation_pct"))
    return wide.withColumn("degradation_pct", change).withColumns(
        {
            "resilience": F.when(size < 50, "GOOD").when(size < 200, "MODERATE").when(size >= 200, "POOR"),
            "improve_error_handling": F.col("chaos_errors") > F.col("baseline_errors") * 2,
            "add_queuing": F.coalesce(F.col("degradation_pct") > 100, F.lit(False)),
            "improve_recovery": F.col("recovery_errors") > F.col("chaos_errors"),
        }
    )


def slo_definitions(df: DataFrame, rows: list[tuple] = SLO_ROWS) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, SLO_SCHEMA)


def service_metrics(summary: DataFrame, quantiles: DataFrame, age: DataFrame) -> DataFrame:
    """Measured values as rows ``(slo, current)`` from one-row summaries."""
    one = summary.select("success_rate", "throughput", "failed", "total").withColumns(
        {
            "p95_s": quantiles.select("p95_s").scalar(),
            "age_seconds": age.select("age_seconds").scalar(),
        }
    )
    pairs = {
        "availability": F.col("success_rate"),
        "latency_p95": F.col("p95_s") * 1000,
        "throughput": F.col("throughput"),
        "error_rate": F.try_divide(F.col("failed"), F.col("total")),
        "data_freshness": F.col("age_seconds"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("slo"), v.cast("double").alias("current")) for k, v in pairs.items()])
    return one.select(F.inline(rows))


def slo_report(measured: DataFrame, definitions: DataFrame) -> DataFrame:
    """Each service level against its target: compliance, deviation and three-tier status.

    A level without a measurement counts as zero; one with an unknown direction does not comply.
    The definitions are a handful of rows, so the join is a broadcast.
    """
    current, target = F.col("current"), F.col("target")
    higher, lower = F.col("direction") == "higher", F.col("direction") == "lower"
    compliant = F.when(higher, current >= target).when(lower, current <= target).otherwise(False)

    def within(limit: str) -> Column:
        return (higher & (current >= F.col(limit))) | (lower & (current <= F.col(limit)))

    status = (
        F.when(within("target"), "ok").when(within("warning"), "warning").when(within("critical"), "degraded").otherwise("critical")
    )
    deviation = F.when(target != 0, F.abs(current - target) / target).otherwise(0.0)
    return (
        definitions.join(measured, "slo", "left")
        .withColumn("current", F.coalesce("current", F.lit(0.0)))
        .select("slo", "target", "current", compliant.alias("compliant"), deviation.alias("deviation"), status.alias("status"))
    )


def slo_overall(report: DataFrame) -> DataFrame:
    """Share of service levels met, its grade and whether the gate is passed."""
    share = F.coalesce(F.avg(F.col("compliant").cast("int")), F.lit(0.0))
    score = F.col("overall_compliance")
    return report.agg(share.alias("overall_compliance")).select(
        score,
        F.when(score >= 0.95, "excellent").when(score >= 0.9, "good").when(score >= 0.8, "acceptable").otherwise("poor").alias("grade"),
        (score >= COMPLIANCE_GATE).alias("passed"),
    )


def load_verdict(summary: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Overall grade of a load run, the three load targets and the advice flags."""
    one = summary.withColumn("p95_s", quantiles.select("p95_s").scalar())
    rate, p95 = F.col("success_rate"), F.col("p95_s")
    return one.select(
        F.when(rate >= 0.95, "EXCELLENT").when(rate >= 0.90, "GOOD").otherwise("POOR").alias("overall"),
        (rate >= 0.999).alias("availability_met"),
        (p95 <= 0.5).alias("latency_met"),
        (F.col("throughput") >= 100).alias("throughput_met"),
        (F.col("mean_s") > 1.0).alias("optimise_queries"),
        (p95 > 2.0).alias("add_queuing"),
        (rate < 0.99).alias("investigate_errors"),
        (F.col("throughput") < 50).alias("scale_out"),
    )


def batch_gate(
    summary: DataFrame, min_success: float = 0.95, max_mean_s: float = 2.0, max_s: float = 10.0, cascade: float = 0.8
) -> DataFrame:
    """Gates of a concurrent batch and of a cascade run on a load summary."""
    success = F.col("success_rate") >= min_success
    mean, worst = F.col("mean_s") < max_mean_s, F.coalesce(F.col("max_s") < max_s, F.lit(False))
    return summary.withColumns(
        {
            "success_gate": success,
            "mean_gate": mean,
            "max_gate": worst,
            "passed": success & mean & worst,
            "cascade_passed": F.col("success_rate") > cascade,
        }
    )


def daily_trend(log: DataFrame) -> DataFrame:
    """Per date: mean, p95, throughput over the day, error rate and whether availability was met."""
    dated = log.withColumn("day", F.to_date("ts"))
    ok = succeeded()
    totals = dated.groupBy("day").agg(
        F.count("*").alias("requests"),
        F.avg(F.when(ok, F.col("duration_s"))).alias("mean_s"),
        (F.count("*") / 86_400).alias("throughput"),
        (F.count_if(~ok) / F.count("*")).alias("error_rate"),
    )
    tails = exact_quantiles(dated.filter(ok), "duration_s", {"p95_s": (19, 20)}, ["day"], "exclusive")
    return (
        totals.join(tails, "day", "left")
        .withColumn("slo_met", F.col("error_rate") <= 0.001)
        .orderBy("day")
    )


def rolling_levels(log: DataFrame, window_hours: int = 24, step_hours: int = 1) -> DataFrame:
    """Sliding window of the service levels, reported every step.

    Rows are first reduced to one per step and only those are spread over the windows that hold
    them, instead of copying every request once per window.
    """
    ok = succeeded()
    step = F.window(F.col("ts").cast("timestamp"), f"{step_hours} hours")
    hourly = log.groupBy(step.alias("w")).agg(
        F.count("*").alias("requests"),
        F.count_if(~ok).alias("errors"),
        F.sum(F.when(ok, F.col("duration_s"))).alias("ok_seconds"),
    ).select(F.col("w.start").alias("step_start"), "requests", "errors", "ok_seconds")
    span = F.window("step_start", f"{window_hours} hours", f"{step_hours} hours")
    served = F.sum("requests") - F.sum("errors")
    return hourly.groupBy(span.alias("w")).agg(
        F.sum("requests").alias("requests"),
        F.sum("errors").alias("errors"),
        F.try_divide(F.sum("ok_seconds"), served).alias("mean_s"),
    ).select(
        F.col("w.end").alias("window_end"),
        "requests",
        "errors",
        (F.lit(1.0) - F.col("errors") / F.col("requests")).alias("availability"),
        "mean_s",
    )


def severity_counts(reports: DataFrame, findings: str = "findings", severity: str = "severity") -> DataFrame:
    """Scan findings per severity from reports that hold them as an array of structs."""
    return (
        reports.select(F.explode(findings).alias("f"))
        .groupBy(F.col(f"f.{severity}").alias("severity"))
        .agg(F.count("*").alias("findings"))
    )


def findings_per_report(reports: DataFrame, key: str, report: str, path: str) -> DataFrame:
    """Length of a nested array of each JSON report."""
    return reports.select(key, F.json_array_length(F.get_json_object(report, path)).alias("findings"))


def ingestion_latency(messages: DataFrame, created_ms: str, arrived_ms: Column, limit_ms: int = 5000) -> DataFrame:
    """Mean time from creation to arrival and whether it is below the limit."""
    return messages.agg(
        F.count(arrived_ms).alias("messages"), F.avg(arrived_ms - F.col(created_ms)).alias("mean_ms")
    ).withColumn("within_limit", F.coalesce(F.col("mean_ms") < limit_ms, F.lit(False)))


SKETCH_K = 800  # rank error of a sketch: about 0.4 %


def hourly_tails(log: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row per hour: successful requests and a quantile sketch of their times.

    The rows are what is stored; they are small, and sketches of any hours can be merged later.
    """
    taken = log.filter(succeeded() & F.col("duration_s").isNotNull())
    return taken.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")).agg(
        F.count("*").alias("served"), F.expr(f"kll_sketch_agg_double(duration_s, {k})").alias("sketch")
    )


def rolling_tails(hourly: DataFrame, window_hours: int = 24, step_hours: int = 1) -> DataFrame:
    """p95 and p99 of a sliding window, from the hours' sketches alone."""
    span = F.window("hour", f"{window_hours} hours", f"{step_hours} hours")
    merged = hourly.groupBy(span.alias("w")).agg(F.sum("served").alias("served"), F.expr("kll_merge_agg_double(sketch)").alias("sketch"))
    tails = [F.expr(f"kll_sketch_get_quantile_double(sketch, {i / k}D)").alias(name) for name, (i, k) in TAILS.items()]
    return merged.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "served", *tails)
