"""Data quality of tables: validation counts, declared constraints, completeness, freshness, profile."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions.statistics import Fraction, exact_quantiles


def valid_counts(df: DataFrame, flag: str = "is_valid") -> DataFrame:
    """Valid and invalid rows in one pass."""
    return df.agg(F.count_if(F.col(flag)).alias("valid"), F.count_if(~F.col(flag)).alias("invalid"))


def validation_summary(validated: DataFrame, data_type: str) -> DataFrame:
    """Total, valid and invalid records of a batch; zeros for an empty one."""
    return validated.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("is_valid")).alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
    ).select(F.lit(data_type).alias("data_type"), "total", "valid", "invalid")


def invalid_records(validated: DataFrame, columns: list[str]) -> DataFrame:
    """Every invalid record as JSON with its errors; a table, so that its length has no bound."""
    return validated.filter(~F.col("is_valid")).select(
        F.to_json(F.struct(*columns)).alias("data"), F.to_json("errors").alias("error")
    )


def error_breakdown(validated: DataFrame) -> DataFrame:
    """Broken rules by field and code."""
    return (
        validated.filter(~F.col("is_valid"))
        .select(F.explode("errors").alias("e"))
        .groupBy(F.col("e.field").alias("field"), F.col("e.rule").alias("rule"))
        .agg(F.count("*").alias("records"))
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def length_violations(df: DataFrame, key: str, limits: dict[str, int]) -> DataFrame:
    """One row per value that is longer than its column allows."""
    checks = F.array(
        *[
            F.when(
                F.char_length(name) > limit,
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.char_length(name).alias("length"),
                    F.lit(limit).alias("max_length"),
                ),
            )
            for name, limit in limits.items()
        ]
    )
    too_long = reduce(lambda a, b: a | b, [F.char_length(n) > m for n, m in limits.items()])
    return (
        df.filter(too_long)
        .select(key, F.explode(F.array_compact(checks)).alias("v"))
        .select(key, "v.column_name", "v.length", "v.max_length")
    )


def decimal_violations(df: DataFrame, column: str, precision: int = 15, scale: int = 2) -> DataFrame:
    """Rows whose number does not fit ``decimal(precision, scale)`` without loss."""
    text = F.col(column).cast("string")
    exact = text.try_cast("decimal(38,18)")
    fitted = exact.try_cast(f"decimal({precision},{scale})")
    return df.filter(F.col(column).isNotNull() & ~F.coalesce(exact == fitted, F.lit(False)))


def completeness(produced: DataFrame, consumed: DataFrame, key: str) -> DataFrame:
    """Messages sent and received, and ids seen on one side only.

    Both sides are stacked and counted per id, which combines on the map side and needs no join.
    """
    return _presence(produced, consumed, key).agg(
        F.coalesce(F.sum("sent"), F.lit(0)).alias("produced"),
        F.coalesce(F.sum("got"), F.lit(0)).alias("consumed"),
        F.count_if(F.col("got") == 0).alias("missing"),
        F.count_if(F.col("sent") == 0).alias("unexpected"),
    ).withColumn("complete", F.col("produced") == F.col("consumed"))


def missing_messages(produced: DataFrame, consumed: DataFrame, key: str) -> DataFrame:
    """Ids that were sent and not received."""
    return _presence(produced, consumed, key).filter(F.col("got") == 0).select(key)


def _presence(produced: DataFrame, consumed: DataFrame, key: str) -> DataFrame:
    sent = produced.select(key, F.lit(1).alias("sent"), F.lit(0).alias("got"))
    got = consumed.select(key, F.lit(0).alias("sent"), F.lit(1).alias("got"))
    return sent.unionByName(got).groupBy(key).agg(F.sum("sent").alias("sent"), F.sum("got").alias("got"))


def freshness(df: DataFrame, ts: str, as_of: Column, limit_seconds: int = 3600) -> DataFrame:
    """Age of the newest record and whether it is within the limit; no record is not fresh."""
    age = (F.unix_micros(as_of) - F.unix_micros(F.max(F.col(ts).cast("timestamp")))) / 1_000_000
    return df.agg(age.alias("age_seconds")).withColumn(
        "is_fresh", F.coalesce(F.col("age_seconds") <= limit_seconds, F.lit(False))
    )


def _unpivot(df: DataFrame, columns: list[str], cast: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast(cast).alias("v")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.feature", "p.v")


def _common_values(df: DataFrame, columns: list[str], cast: str) -> DataFrame:
    """Distinct values and the most common one per column; the smallest among equally common ones."""
    tallied = _unpivot(df, columns, cast).filter(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count("*").alias("c"))
    top = F.min(F.struct((-F.col("c")).alias("neg"), F.col("v").alias("v")))
    return tallied.groupBy("feature").agg(F.count("*").alias("distinct_values"), top.alias("t")).select(
        "feature",
        "distinct_values",
        F.col("t.v").cast("string").alias("most_common"),
        (-F.col("t.neg")).alias("most_common_count"),
    )


PROFILE_QUANTILES: dict[str, Fraction] = {"q25": (1, 4), "q50": (1, 2), "q75": (3, 4)}


def profile(
    df: DataFrame, numeric: list[str], categorical: list[str], exact: bool = True, accuracy: int = 10_000
) -> DataFrame:
    """Quality profile, one row per feature.

    Counts, missing values, distinct values, most common value (ties: the smallest) and, for numbers,
    min, max, mean, standard deviation and quartiles. With ``exact`` the distinct values
    and most common value come from one count per (feature, value), which combines on the map side;
    otherwise distinct values and quartiles come from sketches and the most common value is left out.
    """
    features = [*numeric, *categorical]
    base = []
    for name in features:
        column = F.col(name)
        is_number = name in numeric
        base.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.count("*").alias("row_count"),
                (F.count("*") - F.count(column)).alias("missing"),
                (F.min(column).cast("double") if is_number else F.lit(None).cast("double")).alias("min_value"),
                (F.max(column).cast("double") if is_number else F.lit(None).cast("double")).alias("max_value"),
                (F.avg(column) if is_number else F.lit(None).cast("double")).alias("mean_value"),
                (F.stddev_samp(column) if is_number else F.lit(None).cast("double")).alias("std_value"),
                (F.lit(None).cast("bigint") if exact else F.approx_count_distinct(column)).alias("approx_distinct"),
                (
                    F.percentile_approx(column.cast("double"), [i / k for i, k in PROFILE_QUANTILES.values()], accuracy)
                    if is_number and not exact
                    else F.lit(None).cast("array<double>")
                ).alias("approx_quartiles"),
            )
        )
    one_pass = df.agg(F.array(*base).alias("features")).select(F.inline("features"))
    if not exact:
        quartiles = [F.col("approx_quartiles")[i].alias(q) for i, q in enumerate(PROFILE_QUANTILES)]
        return one_pass.select("*", *quartiles).drop("approx_quartiles").withColumnRenamed("approx_distinct", "distinct_values")
    one_pass = one_pass.drop("approx_distinct", "approx_quartiles")

    # Doubles are counted as they are; text of them is made once per feature, not once per row.
    plain = {"double", "float", "int", "smallint", "tinyint"}
    as_number = [c for c in numeric if df.schema[c].dataType.simpleString() in plain]
    as_text = [c for c in features if c not in as_number]
    parts = [_common_values(df, names, kind) for names, kind in ((as_number, "double"), (as_text, "string")) if names]
    common = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    joined = one_pass.join(common, "feature", "left").withColumn(
        "distinct_values", F.coalesce("distinct_values", F.lit(0))
    )
    if not numeric:
        return joined
    quartiles = exact_quantiles(
        _unpivot(df, numeric, "double"), "v", PROFILE_QUANTILES, ["feature"], "inclusive", len(numeric)
    )
    return joined.join(quartiles, "feature", "left")


def key_dictionary(df: DataFrame, key: str) -> DataFrame:
    """(key, number) of every key: numbers are dense within a task's stretch. To be written once and read from there."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().withColumn("number", F.monotonically_increasing_id())


def daily_bitmaps(df: DataFrame, dictionary: DataFrame, key: str, ts: str) -> DataFrame:
    """(day, block, bits): the keys of each day as bitmaps of 32,768 numbers; what is stored."""
    numbered = df.select(F.to_date(ts).alias("day"), key).join(dictionary, key)
    return numbered.groupBy("day", F.expr("number div 32768").alias("block")).agg(F.expr("bitmap_construct_agg(number % 32768)").alias("bits"))


def rolling_distinct(bitmaps: DataFrame, days: int = 7) -> DataFrame:
    """(day, distinct_keys): exact number of keys in the days up to each day that has any, from the bitmaps alone.

    A window's bitmaps are joined block by block, so a day costs its blocks and not its rows.
    """
    spread = bitmaps.withColumn("until", F.explode(F.sequence("day", F.date_add("day", days - 1))))
    joined = spread.groupBy("until", "block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    counted = joined.groupBy(F.col("until").alias("day")).agg(F.sum(F.expr("bitmap_count(bits)")).alias("distinct_keys"))
    return counted.join(bitmaps.select("day").distinct(), "day", "left_semi")


def heavy_values(df: DataFrame, columns: list[str], share: float, tracked: int = 4096) -> DataFrame:
    """(feature, value, value_count) of the values that make up at least ``share`` of a column's rows, counted exactly.

    A frequent-items sketch per column (Misra-Gries counters, merged over the tasks) keeps every value whose
    share is above its error, so at most ``tracked`` candidates a column are counted again; a column of unique
    values shuffles none of them. ``share`` must be above the error of ``tracked`` counters.
    """
    if share * tracked < 4:
        raise ValueError(f"{tracked} counters are too few for a share of {share}")
    wanted = min(tracked, 4 * ceil(1 / share))
    sketches = df.agg(*[F.expr(f"approx_top_k(CAST({c} AS STRING), {wanted}, {tracked})").alias(c) for c in columns])
    candidates = sketches.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("top")) for c in columns])).alias("s"))
    candidates = candidates.select("s.feature", F.explode("s.top").alias("t")).select("feature", F.col("t.item").alias("v")).where("v IS NOT NULL")
    # As many rows as columns times counters, by the arguments alone.
    pairs = _unpivot(df, columns, "string").join(F.broadcast(candidates), ["feature", "v"])
    rows = df.agg(F.count("*").alias("n"))
    counted = pairs.groupBy("feature", F.col("v").alias("value")).agg(F.count("*").alias("value_count"))
    return counted.crossJoin(rows).where(F.col("value_count") >= F.col("n") * share).drop("n")


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column in one row."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(c) for c in columns])


