"""Comparing two tables: reconciliation, request-to-result correlation, metric regression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custodia.operators.customers import latest_per_key


LEVELS = (4, 4, 6)  # bits of each level of a hash tree: 16,384 leaves


def reconcile(
    stored: DataFrame, returned: DataFrame, key: str, columns: list[str], order: Column | None = None
) -> DataFrame:
    """Keys whose stored and returned values differ, with the kind of mismatch.

    Keys must be unique on both sides; with ``order`` the newest row of a key is taken first, so
    that the full outer join always meets unique keys.
    """
    if order is not None:
        stored = latest_per_key(stored, [key], [order])
        returned = latest_per_key(returned, [key], [order])
    left = stored.select(F.col(key).alias("_l"), *[F.col(c).alias(f"stored_{c}") for c in columns])
    right = returned.select(F.col(key).alias("_r"), *[F.col(c).alias(f"returned_{c}") for c in columns])
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(f"stored_{c}").eqNullSafe(F.col(f"returned_{c}"))
    mismatch = (
        F.when(F.col("_l").isNull(), "missing_stored").when(F.col("_r").isNull(), "missing_returned").when(differs, "diff")
    )
    values = [f"{side}_{c}" for c in columns for side in ("stored", "returned")]
    return (
        left.join(right, F.col("_l") == F.col("_r"), "full_outer")
        .select(F.coalesce("_l", "_r").alias(key), *values, mismatch.alias("mismatch"))
        .filter(F.col("mismatch").isNotNull())
    )


def range_digests(df: DataFrame, key: str, columns: list[str], levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(range, row_count, digest): the leaves of a hash tree over ranges of hashed keys; what each side keeps or sends.

    The leaf of a key is the top bits of its hash. A leaf's digest is the sum of its rows' hashes, so it does not depend
    on their order, and the digest of any wider range is the sum of its leaves'.
    """
    row = F.xxhash64(key, *columns).cast("decimal(38,0)")
    return df.groupBy(range_of(key, levels).alias("range")).agg(F.count("*").alias("row_count"), F.sum(row).alias("digest"))


def range_of(key: str, levels: tuple[int, ...] = LEVELS) -> Column:
    return F.pmod(F.xxhash64(F.lit("range"), key), F.lit(1 << sum(levels))).cast("int")


def differing_ranges(left: DataFrame, right: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(range) of the leaves that differ. Levels are compared from the top: only the children of ranges that
    differ are compared further, so equal parts of the tree are left after one look."""
    depth = sum(levels)
    open_ranges = None
    for at in range(1, len(levels) + 1):
        shift = depth - sum(levels[:at])

        def level(side: DataFrame, shift=shift, above=open_ranges, bits=levels[at - 1]) -> DataFrame:
            rows = side
            if above is not None:
                rows = side.join(above.withColumnRenamed("range", "_above"), F.shiftright("range", shift + bits) == F.col("_above"), "left_semi")
            return rows.groupBy(F.shiftright("range", shift).alias("range")).agg(F.sum("row_count").alias("row_count"), F.sum("digest").alias("digest"))

        a, b = level(left), level(right).withColumnsRenamed({"range": "_range", "row_count": "_rows", "digest": "_digest"})
        same = F.col("row_count").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))
        open_ranges = a.join(b, F.col("range") == F.col("_range"), "full_outer").where(~same).select(F.coalesce("range", "_range").alias("range"))
    return open_ranges


def reconcile_by_digest(
    stored: DataFrame, returned: DataFrame, key: str, columns: list[str], ranges: DataFrame, levels: tuple[int, ...] = LEVELS
) -> DataFrame:
    """The result of ``reconcile`` from the rows of the differing ``ranges`` alone.

    There are at most ``2 ** sum(levels)`` ranges, so they are broadcast to filter both sides where they
    are read; what is shuffled and joined grows with the differences and not with the tables.
    """

    def inside(side: DataFrame) -> DataFrame:
        rows = side.select(key, *columns).withColumn("_leaf", range_of(key, levels))
        return rows.join(F.broadcast(ranges.withColumnRenamed("range", "_leaf")), "_leaf", "left_semi").drop("_leaf")

    return reconcile(inside(stored), inside(returned), key, columns)


def match_within(
    requests: DataFrame, results: DataFrame, key: str, ts: str = "ts", seconds: int = 30
) -> DataFrame:
    """Requests with the time of the first result of the same key within the limit, or null.

    Requests and results are laid on one time line per key and time bucket and read once, backwards, with a
    running minimum, so no pairs are formed and a bucket costs in proportion to its rows. A bucket is as long as the limit; a result is placed in its own
    and the bucket before, where any request it can answer lies. Equal (key, time) points are
    merged first, so that a busy key is spread over its buckets and a bucket holds distinct times only.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    width = seconds * 1_000_000
    bucket = F.floor(F.col("_t") / width).cast("bigint")

    asked = requests.select(F.col(key), micros.alias("_t")).distinct().withColumn("_b", bucket)
    answered = results.select(F.col(key), micros.alias("_t")).distinct().withColumn("_b0", bucket)
    answered = answered.withColumn("_b", F.explode(F.array(F.col("_b0"), F.col("_b0") - 1))).drop("_b0")
    points = asked.select(key, "_b", "_t", F.lit(None).cast("bigint").alias("_answer")).unionByName(
        answered.select(key, "_b", "_t", F.col("_t").alias("_answer"))
    )
    following = Window.partitionBy(key, "_b").orderBy(F.col("_t").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    first = points.withColumn("_first", F.min("_answer").over(following)).filter(F.col("_answer").isNull())
    answers = first.filter(F.col("_first") <= F.col("_t") + width).select(
        F.col(key).alias("_k"), F.col("_t").alias("_at"), "_first"
    )
    timed = requests.withColumn("_t", micros)
    return (
        timed.join(answers, (F.col(key) == F.col("_k")) & (F.col("_t") == F.col("_at")), "left")
        .withColumn("result_ts", F.timestamp_micros("_first"))
        .withColumn("status", F.when(F.col("_first").isNull(), "timeout").otherwise("answered"))
        .drop("_t", "_k", "_at", "_first")
    )


def metric_regression(
    current: DataFrame, baseline: DataFrame, threshold_pct: float = 10.0, key: str = "metric", value: str = "value"
) -> DataFrame:
    """Change of each metric against the baseline in percent, and whether it is beyond the threshold."""
    base = baseline.select(key, F.col(value).alias("baseline_value"))
    change = F.try_divide(F.col("current_value") - F.col("baseline_value"), F.col("baseline_value")) * 100
    return (
        current.select(key, F.col(value).alias("current_value"))
        .join(base, key, "left")
        .withColumn("change_pct", change)
        .withColumn("regressed", F.coalesce(F.col("change_pct") > threshold_pct, F.lit(False)))
    )
