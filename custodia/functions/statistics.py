"""Exact order statistics and running totals that never gather a group in one task.

``percentile`` keeps every distinct value of a group in one buffer and a window without partitions
sorts everything in one task. Both fail on a large or lopsided group, so ranks are found here by
radix passes over histograms and running totals by range partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custodia.session import ensure_checkpointing

Fraction = tuple[int, int]
RADIX = 16  # bits of a key that one pass fixes
FRACTION = 1 << 52  # steps of a double between two powers of two
LAST_KEY = (1 << 63) - 1
LEAST, LEAST_NORMAL = "4.9E-324", "2.2250738585072014E-308"


def attach(df: DataFrame, per_group: DataFrame, by: list[str], few: bool = False) -> DataFrame:
    """Add the columns of a one-row-per-group frame; with no group columns, of a one-row frame.

    Groups are matched null-safe. The one-row case is a scalar subquery, not a join. ``few`` says
    that the caller's arguments bound the number of groups: the groups are then broadcast and ``df``,
    where one group may hold most rows, is not shuffled. Otherwise adaptive execution chooses by the
    measured size and splits a group that holds most rows.
    """
    extra = [c for c in per_group.columns if c not in by]
    if not by:
        row = per_group.select(F.struct(*extra)).scalar()
        return df.withColumn("_row", row).select("*", *[F.col(f"_row.{c}").alias(c) for c in extra]).drop("_row")
    renamed = per_group.select(*[F.col(c).alias(f"_k_{c}") for c in by], *extra)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by])
    return df.join(F.broadcast(renamed) if few else renamed, same).drop(*[f"_k_{c}" for c in by])


def _rank_and_weight(fraction: Fraction, method: str) -> tuple[str, str]:
    """SQL for the 1-based lower rank among ``_n`` values and the numerator of the interpolation weight."""
    i, k = fraction
    if method == "exclusive":
        rank = f"greatest(1, least(_n - 1, ({i} * (_n + 1)) div {k}))"
        return f"if(_n < {k}, _n, {rank})", f"if(_n < {k}, 0, {i} * (_n + 1) - {rank} * {k})"
    return f"({i} * (_n - 1)) div {k} + 1", f"({i} * (_n - 1)) % {k}"


def with_ordered_key(df: DataFrame, value: str, key: str) -> DataFrame:
    """Add a 64-bit number that orders doubles as they are ordered: their bits, negated below zero.

    Exponent and fraction come from exact steps: scaling by a power of two loses nothing, and a logarithm
    that is off by one is put right. Both zeros are 0, NaN comes last, null stays null.
    """
    scaled = F.expr("_size / pow(2D, _guess)")
    bits = (
        f"CASE WHEN isnan({value}) THEN {LAST_KEY} WHEN _size = 0 THEN 0L ELSE if({value} < 0, -1L, 1L) * CASE"
        f" WHEN _size = double('Infinity') THEN 2047L * {FRACTION}"
        f" WHEN _size < {LEAST_NORMAL}D THEN CAST(_size / {LEAST}D AS BIGINT)"
        f" ELSE (_exponent + 1023L) * {FRACTION} + CAST((_size / pow(2D, _exponent) - 1) * {FRACTION} AS BIGINT) END END"
    )
    return (
        df.withColumn("_size", F.abs(value))
        .withColumn("_guess", F.expr("if(_size > 0 AND _size < double('Infinity'), least(1023, greatest(-1022, CAST(floor(log2(_size)) AS INT))), 0)"))
        .withColumn("_exponent", F.when(scaled >= 2, F.col("_guess") + 1).when((scaled < 1) & (F.col("_guess") > -1022), F.col("_guess") - 1).otherwise(F.col("_guess")))
        .withColumn(key, F.expr(bits))
        .drop("_size", "_guess", "_exponent")
    )


def value_of_key(key: str) -> str:
    """SQL for the double that an ordered key stands for."""
    size = f"abs({key})"
    return (
        f"CASE WHEN {key} = {LAST_KEY} THEN double('NaN') ELSE if({key} < 0, -1D, 1D) * CASE"
        f" WHEN {size} >= 2047L * {FRACTION} THEN double('Infinity') WHEN {size} < {FRACTION} THEN {size} * {LEAST}D"
        f" ELSE (1D + ({size} % {FRACTION}) / {FRACTION}D) * pow(2D, ({size} div {FRACTION}) - 1023D) END END"
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    fractions: dict[str, Fraction],
    by: list[str] | None = None,
    method: str = "exclusive",
    groups: int | None = None,
) -> DataFrame:
    """Interpolated quantiles of ``value`` per group: one row with a column per fraction.

    ``fractions`` maps a column name to ``(i, k)`` for the i-th of k parts. ``exclusive`` places the
    quantile at rank ``i * (n + 1) / k`` and returns the maximum for fewer than k values;
    ``inclusive`` places it at ``1 + i * (n - 1) / k``. Nulls are ignored; a group without values has
    no row, and without groups there is always one row.

    Four passes over the input narrow all ranks at once, 16 bits of the values' ordered keys a pass. Each is a count
    by those bits, combined in the tasks before it is shuffled, so a group's histogram has at most 65,536
    rows for each rank still open, however many values the group has and however they are spread. No values are ordered.

    ``groups`` is an upper bound of the number of groups where the caller's arguments give one.
    """
    if not by:  # one group, whose row is broadcast; without values its row is empty
        found = exact_quantiles(df.withColumn("_all", F.lit(0)), value, fractions, ["_all"], method, 1)
        return found.agg(*[F.max(name).alias(name) for name in fractions])
    few = groups is not None
    keys = df.select(*by, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    keys = with_ordered_key(keys, "_v", "_k").select(*by, "_k")
    ranks = [f"{r}{p}" for p in range(len(fractions)) for r in ("_r", "_u")]

    def narrowed(counted: DataFrame, shift: int) -> DataFrame:
        """For each rank the bits it lies in and the values of its group below them."""
        parent = F.shiftright("_b", RADIX) if shift < 64 - RADIX else F.lit(0)
        order = Window.partitionBy(*by, parent).orderBy("_b")
        cumulated = counted.withColumn("_cum", F.sum("_c").over(order))
        if shift == 64 - RADIX:
            whole = Window.partitionBy(*by)
            wanted, weights = [], []
            cumulated = cumulated.withColumn("_n", F.sum("_c").over(whole))
            for p, fraction in enumerate(fractions.values()):
                rank, weight = _rank_and_weight(fraction, method)
                cumulated = cumulated.withColumn(f"_r{p}", F.expr(rank)).withColumn(f"_w{p}", F.expr(weight))
                wanted += [f"_r{p}", f"if(_w{p} > 0, _r{p} + 1, _r{p})"]
                weights.append(f"_w{p}")
            found = [f"min(if(_cum >= {w}, named_struct('b', _b, 'below', _cum - _c, 'rank', {w}), NULL))" for w in wanted]
            return cumulated.groupBy(*by).agg(
                F.expr(f"array({', '.join(found)})").alias("_t"), F.expr(f"array({', '.join(f'max({w})' for w in weights)})").alias("_w")
            )
        found = [
            f"min(if(shiftright(_b, {RADIX}) = _t[{i}].b AND _t[{i}].below + _cum >= _t[{i}].rank,"
            f" named_struct('b', _b, 'below', _t[{i}].below + _cum - _c, 'rank', _t[{i}].rank), NULL))"
            for i in range(len(ranks))
        ]
        return cumulated.groupBy(*by, "_t", "_w").agg(F.expr(f"array({', '.join(found)})").alias("_next")).select(*by, F.col("_next").alias("_t"), "_w")

    bits = lambda shift: F.shiftright("_k", shift).alias("_b")
    state = narrowed(keys.select(*by, bits(64 - RADIX)).groupBy(*by, "_b").agg(F.count("*").alias("_c")), 64 - RADIX)
    for shift in range(64 - 2 * RADIX, -1, -RADIX):
        inside = " OR ".join(f"shiftright(_k, {shift + RADIX}) = _t[{i}].b" for i in range(len(ranks)))
        held = attach(keys, state, by, few).where(inside)
        state = narrowed(held.select(*by, "_t", "_w", bits(shift)).groupBy(*by, "_t", "_w", "_b").agg(F.count("*").alias("_c")), shift)
    columns = []
    for p, (name, (_, k)) in enumerate(fractions.items()):
        x, y, w = value_of_key(f"_t[{2 * p}].b"), value_of_key(f"_t[{2 * p + 1}].b"), f"_w[{p}]"
        mixed = f"(_x * ({k} - {w}) + _y * {w}) / {k}" if method == "exclusive" else f"_x + (_y - _x) * ({w} / {k})"
        columns.append(F.expr(f"if({w} = 0, {x}, {mixed.replace('_x', f'({x})').replace('_y', f'({y})')})").alias(name))
    return state.select(*by, *columns)


def running_totals(
    df: DataFrame, by: list[str], order: str, totals: dict[str, str], groups: int | None = None
) -> DataFrame:
    """Running sums per group in ``order``, for one row per group and order value.

    ``totals`` maps output to input column. Rows are range-partitioned, the partition number is made
    permanent by a checkpoint, each partition is summed on its own and shifted by the totals of the
    partitions before it. The table of partition totals has one row per group and partition.
    """
    ensure_checkpointing(df.sparkSession)
    placed = (
        df.repartitionByRange(*by, order).withColumn("_part", F.spark_partition_id()).checkpoint()
    )
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_s_{name}") for name, c in totals.items()])
    offsets = offsets.select(
        *by, "_part", *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in totals]
    )
    within = Window.partitionBy(*by, "_part").orderBy(order)
    summed = placed.select(
        "*", *[F.sum(c).over(within).alias(f"_w_{name}") for name, c in totals.items()]
    )
    joined = attach(summed, offsets, [*by, "_part"], groups is not None)
    return joined.select(*df.columns, *[(F.col(f"_w_{n}") + F.col(f"_o_{n}")).alias(n) for n in totals])
