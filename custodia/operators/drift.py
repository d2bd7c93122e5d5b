"""Data drift of current rows against a reference snapshot.

Definitions are the published ones: Kolmogorov-Smirnov distance, population stability index over
reference deciles, Jensen-Shannon distance and the chi-square statistic over categories. The
thresholds are parameters of this package, not taken from elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions.statistics import exact_quantiles, running_totals

KS_THRESHOLD = 0.1
PSI_THRESHOLD = 0.2
JS_THRESHOLD = 0.1
DRIFT_SHARE = 0.5
EMPTY_BIN_SHARE = 1e-4


def _stack(reference: DataFrame, current: DataFrame, features: list[str], cast: str) -> DataFrame:
    """Rows ``(feature, v, r, c)`` of both sides, with r and c marking the side; nulls are left out."""

    def side(df: DataFrame, r: int, c: int) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast(cast).alias("v")) for f in features])
        return df.select(F.inline(pairs)).select("feature", "v", F.lit(r).alias("r"), F.lit(c).alias("c"))

    return side(reference, 1, 0).unionByName(side(current, 0, 1)).filter(F.col("v").isNotNull())


def _tally(stacked: DataFrame) -> DataFrame:
    return stacked.groupBy("feature", "v").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


def ks_distance(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Largest gap between the two empirical distribution functions, per numeric feature.

    Running totals over distinct values are exact and spread over range partitions.
    """
    tallied = _tally(_stack(reference, current, features, "double"))
    running = running_totals(tallied, ["feature"], "v", {"cum_r": "r", "cum_c": "c"}, len(features))
    sizes = running.groupBy("feature").agg(F.max("cum_r").alias("n_reference"), F.max("cum_c").alias("n_current"))
    gap = F.abs(F.try_divide(F.col("cum_r"), F.col("n_reference")) - F.try_divide(F.col("cum_c"), F.col("n_current")))
    # Tables with one row per feature are bounded by the argument list.
    return running.join(F.broadcast(sizes), "feature").groupBy("feature", "n_reference", "n_current").agg(F.max(gap).alias("ks"))


def stability_index(reference: DataFrame, current: DataFrame, features: list[str], bins: int = 10) -> DataFrame:
    """Population stability index over the reference's quantile bins, per numeric feature.

    A value on an edge belongs to the bin below it. An empty bin counts as a small share.
    """
    stacked = _stack(reference, current, features, "double")
    cuts = {f"e{i}": (i, bins) for i in range(1, bins)}
    edges = exact_quantiles(stacked.filter(F.col("r") == 1), "v", cuts, ["feature"], "inclusive", groups=len(features))
    binned = stacked.join(F.broadcast(edges), "feature")
    number = F.expr(" + ".join(f"int(v > {name})" for name in cuts)).alias("bin")
    counts = binned.select("feature", number, "r", "c").groupBy("feature", "bin").agg(
        F.sum("r").alias("r"), F.sum("c").alias("c")
    )
    sizes = counts.groupBy("feature").agg(F.sum("r").alias("n_reference"), F.sum("c").alias("n_current"))
    # A bin that is empty on both sides adds nothing, so it need not have a row.
    floor = F.lit(EMPTY_BIN_SHARE)
    shares = counts.join(F.broadcast(sizes), "feature").select(
        "feature",
        F.greatest(F.try_divide("r", "n_reference"), floor).alias("p"),
        F.greatest(F.try_divide("c", "n_current"), floor).alias("q"),
    )
    return shares.groupBy("feature").agg(F.expr("sum((q - p) * ln(q / p))").alias("psi"))


def category_drift(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Jensen-Shannon distance (base 2) and chi-square statistic over category shares, per feature."""
    tallied = _tally(_stack(reference, current, features, "string"))
    sizes = tallied.groupBy("feature").agg(
        F.sum("r").alias("n_reference"), F.sum("c").alias("n_current"), F.count("*").alias("categories")
    )
    p, q = F.col("r") / F.col("n_reference"), F.col("c") / F.col("n_current")
    m = (p + q) / 2

    def half(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    both = F.col("n_reference") + F.col("n_current")
    expected_r = (F.col("r") + F.col("c")) * F.col("n_reference") / both
    expected_c = (F.col("r") + F.col("c")) * F.col("n_current") / both
    chi = F.pow(F.col("r") - expected_r, 2) / expected_r + F.pow(F.col("c") - expected_c, 2) / expected_c
    comparable = sizes.filter((F.col("n_reference") > 0) & (F.col("n_current") > 0))
    return (
        tallied.join(F.broadcast(comparable), "feature")
        .groupBy("feature", "n_reference", "n_current", "categories")
        .agg(
            F.sqrt(F.greatest((F.sum(half(p)) + F.sum(half(q))) / 2, F.lit(0.0))).alias("js"),
            F.sum(chi).alias("chi_square"),
        )
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric: list[str],
    categorical: list[str],
    ks_threshold: float = KS_THRESHOLD,
    psi_threshold: float = PSI_THRESHOLD,
    js_threshold: float = JS_THRESHOLD,
) -> DataFrame:
    """One row per feature and measure with its value, threshold and verdict."""
    parts = []
    if numeric:
        parts.append(ks_distance(reference, current, numeric).select("feature", F.lit("ks").alias("measure"), F.col("ks").alias("value"), F.lit(ks_threshold).alias("threshold")))
        parts.append(stability_index(reference, current, numeric).select("feature", F.lit("psi").alias("measure"), F.col("psi").alias("value"), F.lit(psi_threshold).alias("threshold")))
    if categorical:
        parts.append(category_drift(reference, current, categorical).select("feature", F.lit("js").alias("measure"), F.col("js").alias("value"), F.lit(js_threshold).alias("threshold")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.withColumn("drifted", F.col("value") > F.col("threshold"))


def dataset_verdict(report: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """Share of drifted features (any measure) and the verdict on the dataset."""
    per_feature = report.groupBy("feature").agg(F.max(F.col("drifted").cast("int")).alias("drifted"))
    return per_feature.agg(
        F.count("*").alias("features"), F.sum("drifted").alias("drifted_features"), F.avg("drifted").alias("drift_share")
    ).withColumn("dataset_drift", F.col("drift_share") >= share)
