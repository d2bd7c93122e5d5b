"""Service analytics on hand-checked rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from custodia.operators import service

START = dt.datetime(2024, 1, 1)
LOG = "seq int, ts timestamp, duration_s double, status_code int, error string, phase string"


def log(spark, rows):
    return spark.createDataFrame([(i, START + dt.timedelta(seconds=i), *r) for i, r in enumerate(rows)], LOG)


def test_summary(spark):
    rows = [(1.0, 200, None, "baseline"), (3.0, 200, "", "baseline"), (9.0, 500, "HTTP 500", "chaos"), (9.0, 200, "reset", "chaos"), (9.0, 503, None, "chaos")]
    got = service.load_summary(log(spark, rows)).first()
    assert (got["total"], got["ok"], got["failed"]) == (5, 2, 3)
    assert (got["success_rate"], got["mean_s"], got["min_s"], got["max_s"], got["throughput"]) == (0.4, 2.0, 1.0, 3.0, 1.25)


def test_empty_log(spark):
    got = service.load_summary(log(spark, [])).first()
    assert (got["total"], got["success_rate"], got["mean_s"], got["throughput"]) == (0, 0.0, 0.0, 0.0)
    assert service.load_quantiles(log(spark, [])).first().asDict() == {"p95_s": 0.0, "p99_s": 0.0}


def test_short_log_gives_the_maximum(spark):
    got = service.load_quantiles(log(spark, [(float(i), 200, None, "x") for i in range(1, 20)])).first()
    assert (got["p95_s"], got["p99_s"]) == (19.0, 19.0)
    twenty = service.load_quantiles(log(spark, [(float(i), 200, None, "x") for i in range(1, 21)])).first()
    assert (twenty["p95_s"], twenty["p99_s"]) == (19.95, 20.0)


def test_top_errors_only_count_the_first(spark):
    rows = [(1.0, 500, "late" if i >= 20 else f"e{i % 3}" + "x" * 200, "p") for i in range(30)]
    got = service.top_errors(log(spark, rows)).collect()
    assert [(r["error"][:2], r["occurrences"]) for r in got] == [("e0", 7), ("e1", 7), ("e2", 6)]
    assert all(len(r["error"]) == 100 for r in got)


def test_grouped_top_errors_are_cut_before_the_shuffle(spark):
    plan = service.top_errors(log(spark, [(1.0, 500, "e", "p")]), 10, 60, ["phase"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize(
    ("base", "chaos", "klass", "queuing"),
    [(1.0, 1.4, "GOOD", False), (1.0, 2.5, "MODERATE", True), (1.0, 3.0, "POOR", True), (1.0, 0.4, "MODERATE", False)],
)
def test_impact_classes(spark, base, chaos, klass, queuing):
    got = service.phase_impact(log(spark, [(base, 200, None, "baseline"), (chaos, 200, None, "chaos")])).first()
    assert got["resilience"] == klass and got["add_queuing"] is queuing


def test_impact_without_chaos_success(spark):
    got = service.phase_impact(log(spark, [(1.0, 200, None, "baseline"), (1.0, 500, "e", "chaos")])).first()
    assert got["degradation_pct"] is None and got["resilience"] is None and got["improve_error_handling"]
    report = {r["phase"]: r for r in service.phase_report(log(spark, [(1.0, 500, "e", "chaos")])).collect()}
    assert report["chaos"]["has_success"] is False and report["chaos"]["mean_s"] is None


def test_four_of_five_levels_are_acceptable_and_not_enough(spark):
    measured = spark.createDataFrame(
        [("availability", 0.997), ("latency_p95", 320.0), ("throughput", 1250.0), ("error_rate", 0.0008), ("data_freshness", 1800.0)],
        "slo string, current double",
    )
    report = service.slo_report(measured, service.slo_definitions(measured))
    rows = {r["slo"]: r for r in report.collect()}
    assert [rows[s]["compliant"] for s in ("availability", "latency_p95", "throughput", "error_rate", "data_freshness")] == [False, True, True, True, True]
    assert rows["availability"]["status"] == "warning" and rows["throughput"]["deviation"] == 0.25
    assert service.slo_overall(report).first().asDict() == {"overall_compliance": 0.8, "grade": "acceptable", "passed": False}


def test_missing_measure_counts_as_zero(spark):
    nothing = spark.createDataFrame([], "slo string, current double")
    rows = {r["slo"]: r for r in service.slo_report(nothing, service.slo_definitions(nothing)).collect()}
    assert rows["availability"]["status"] == "critical" and rows["error_rate"]["compliant"]
    assert service.slo_overall(service.slo_report(nothing, service.slo_definitions(nothing)).limit(0)).first()["overall_compliance"] == 0


def test_rolling_window_counts_each_request_in_every_window(spark):
    got = service.rolling_levels(log(spark, [(1.0, 200, None, "p"), (3.0, 500, "e", "p")])).collect()
    assert len(got) == 24 and all((r["requests"], r["errors"], r["availability"], r["mean_s"]) == (2, 1, 0.5, 1.0) for r in got)


def test_gates_and_verdict(spark):
    rows = [(0.1, 200, None, "p")] * 19 + [(0.1, 500, "e", "p")]
    summary = service.load_summary(log(spark, rows))
    gate = service.batch_gate(summary).first()
    assert gate["passed"] and gate["cascade_passed"]
    verdict = service.load_verdict(summary, service.load_quantiles(log(spark, rows))).first()
    assert verdict["overall"] == "EXCELLENT" and not verdict["availability_met"] and verdict["latency_met"] and verdict["scale_out"]


def test_ingestion_latency(spark):
    df = spark.createDataFrame([(1, 0, 4000), (2, 0, 8000), (3, 0, None)], "id int, created_ms bigint, arrived_ms bigint")
    got = service.ingestion_latency(df, "created_ms", F.col("arrived_ms")).first()
    assert (got["messages"], got["mean_ms"], got["within_limit"]) == (2, 6000.0, False)
