"""Radix selection, merged sketches and bitmaps, digests, heavy values."""

import datetime as dt
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from custodia.functions.statistics import exact_quantiles, value_of_key, with_ordered_key
from custodia.operators import matching, quality, service

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
         math.inf, -math.inf, 1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 2.0, math.nextafter(2.0, 0), 4.0, 1e-300, 3.0]


def odd_doubles(n):
    rng = random.Random(9)
    made = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(n)]
    return EDGES + [x for x in made if not math.isnan(x)] + [2.0**e for e in range(-1074, 1024, 7)] + [math.nextafter(2.0**e, 0) for e in range(-1020, 1024, 11)]


def test_keys_order_doubles_and_give_them_back(spark):
    values = odd_doubles(3000)
    df = with_ordered_key(spark.createDataFrame([(v,) for v in [*values, math.nan, None]], "v double"), "v", "k")
    rows = df.withColumn("back", F.expr(value_of_key("k"))).collect()
    bits = lambda x: struct.unpack("<q", struct.pack("<d", abs(x)))[0] * (-1 if x < 0 else 1)
    for r in rows:
        if r["v"] is None:
            assert r["k"] is None
        elif math.isnan(r["v"]):
            assert r["k"] == 2**63 - 1 and math.isnan(r["back"])
        else:
            assert r["k"] == bits(r["v"]) and r["back"] == r["v"]


def test_selection_of_odd_doubles(spark):
    values = [v for v in odd_doubles(2000) if abs(v) < 1e150]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    fractions = {f"q{i}": (i, 8) for i in range(1, 8)}
    ordered, n = sorted(values), len(values)
    row = exact_quantiles(df, "v", fractions, method="inclusive").first()
    for name, (i, k) in fractions.items():
        low, weight = divmod(i * (n - 1), k)
        x, y = ordered[low], ordered[min(low + 1, n - 1)]
        assert row[name] == (x if weight == 0 else x + (y - x) * (weight / k))


def test_histograms_do_not_grow_with_a_group(spark):
    """A group of twice the rows has counts of the same size behind every pass: they depend on the bits alone."""
    sizes = []
    for n in (20_000, 40_000):
        df = spark.range(n).selectExpr("'a' AS g", "(id % 20000) / 7.0D AS v")
        keys = with_ordered_key(df, "v", "k")
        sizes.append([keys.groupBy("g", F.shiftright("k", shift)).count().count() for shift in (48, 32)])
        assert exact_quantiles(df, "v", {"q": (1, 2)}, ["g"], "inclusive").first()["q"] == 19999 / 14
    assert sizes[0] == sizes[1]


def test_heavy_values_are_exact_and_unique_columns_have_none(spark):
    rows = [(i, "a" if i % 3 == 0 else "b" if i % 50 == 1 else f"x{i}", None if i % 2 else 7) for i in range(30_000)]
    df = spark.createDataFrame(rows, "u long, s string, n int").repartition(6)
    got = {(r["feature"], r["value"]): r["value_count"] for r in quality.heavy_values(df, ["u", "s", "n"], 0.01).collect()}
    assert got == {("s", "a"): 10_000, ("s", "b"): sum(1 for i in range(30_000) if i % 3 and i % 50 == 1), ("n", "7"): 15_000}
    with pytest.raises(ValueError, match="too few"):
        quality.heavy_values(df, ["u"], 0.0001)


def test_digests_find_the_ranges_that_differ_and_no_others(spark):
    left = spark.range(5000).selectExpr("id AS k", "id % 9 AS v", "CAST(NULL AS STRING) AS w")
    right = left.where("k <> 17").withColumn("v", F.when(F.col("k") == 99, 100).otherwise(F.col("v"))).unionByName(spark.range(9000, 9001).selectExpr("id AS k", "1L AS v", "CAST(NULL AS STRING) AS w"))
    digests = [matching.range_digests(side, "k", ["v", "w"]) for side in (left, right)]
    ranges = matching.differing_ranges(*digests)
    expected = {r["r"] for r in spark.createDataFrame([(17,), (99,), (9000,)], "k long").select(matching.range_of("k").alias("r")).collect()}
    assert {r["range"] for r in ranges.collect()} == expected
    got = matching.reconcile_by_digest(left, right, "k", ["v", "w"], ranges)
    assert {(r["k"], r["mismatch"]) for r in got.collect()} == {(17, "missing_returned"), (99, "diff"), (9000, "missing_stored")}
    assert sorted(map(str, got.collect())) == sorted(map(str, matching.reconcile(left, right, "k", ["v", "w"]).collect()))
    assert matching.differing_ranges(digests[0], digests[0]).isEmpty()
    none = matching.range_digests(left.where("false"), "k", ["v", "w"])
    assert matching.differing_ranges(digests[0], none).count() == digests[0].count()


def test_distinct_keys_of_rolling_days(spark):
    rng = random.Random(2)
    rows = [(f"c{rng.randint(0, 400)}", dt.datetime(2024, 1, d, 5)) for d in (1, 2, 3, 9, 10, 20) for _ in range(150)] + [(None, dt.datetime(2024, 1, 3)), ("c1", None)]
    df = spark.createDataFrame(rows, "c string, ts timestamp").repartition(5)
    numbers = quality.key_dictionary(df, "c").checkpoint()
    got = {r["day"].day: r["distinct_keys"] for r in quality.rolling_distinct(quality.daily_bitmaps(df, numbers, "c", "ts").where("day IS NOT NULL")).collect()}
    assert got == {d: len({c for c, t in rows if c and t and d - 7 < t.day <= d}) for d in (1, 2, 3, 9, 10, 20)}


def test_merged_hours_have_the_tails_of_their_window(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), (i * 7919) % 3000 / 1000, 200 if i % 10 else 500, None if i % 10 else "HTTP 500") for i in range(3000)]
    log = spark.createDataFrame(rows, "ts timestamp, duration_s double, status_code int, error string")
    tails = {r["window_end"]: r for r in service.rolling_tails(service.hourly_tails(log)).collect()}
    end = dt.datetime(2024, 1, 2, 6)
    inside = sorted(d for t, d, s, _ in rows if s == 200 and end - dt.timedelta(hours=24) <= t < end)
    assert tails[end]["served"] == len(inside)
    rank = sum(d <= tails[end]["p95_s"] for d in inside) / len(inside)
    assert abs(rank - 0.95) < 0.01
