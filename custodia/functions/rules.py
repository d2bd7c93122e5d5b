"""Record rules as column expressions.

A rule is a boolean column that is true when a record breaks it, plus the field and a code. A list
of rules compiles to ``is_valid`` and ``errors`` without any Python function, so validation stays
inside whole-stage codegen and works alike on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_FIELDS = ("field", "rule", "message")
ERROR_TYPE = f"array<struct<{', '.join(f'{name}: string' for name in ERROR_FIELDS)}>>"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


@dataclass(frozen=True)
class Rule:
    field: str
    code: str
    broken: Column
    message: str

    @property
    def fails(self) -> Column:
        """True or false, never null."""
        return F.coalesce(self.broken, F.lit(False))

    def named(self) -> Column:
        """The rule as an entry of ``errors``."""
        texts = (self.field, self.code, self.message)
        pairs = ", ".join(f"'{name}', '{_quoted(text)}'" for name, text in zip(ERROR_FIELDS, texts, strict=True))
        return F.expr(f"named_struct({pairs})")


def all_hold(rules: Iterable[Rule]) -> Column:
    """True when no rule is broken."""
    return _none_set([rule.fails for rule in rules])


def _none_set(flags: list[Column]) -> Column:
    # One flat expression: the optimizer reorders chains of AND at a cost that grows steeply with length.
    return ~F.array_contains(F.array(*flags), True) if flags else F.lit(True)


def evaluated_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters read but do not evaluate again.

    A filter on an ordinary computed column is pushed below the projection with the whole
    expression copied into it. The output of a generator stays where it is, while filters on the
    other columns still reach the scan.
    """
    if not columns:
        return df
    return df.select("*", F.stack(F.lit(1), *columns.values()).alias(*columns))


def validate(
    df: DataFrame, rules: list[Rule], normalised: list[Column] | None = None, once: bool = True
) -> DataFrame:
    """Add ``is_valid`` and ``errors`` (all broken rules, in rule order; worked out for invalid records only).

    With ``normalised`` also add ``data``, a struct that is null for invalid records. ``once`` keeps
    later filters on ``is_valid`` from repeating the rules; leave it out where the rules only read
    columns that are behind such a barrier already.
    """
    ok = {"is_valid": all_hold(rules)}
    df = evaluated_once(df, ok) if once else df.withColumns(ok)
    broken = F.array_compact(F.array(*[F.when(rule.broken, rule.named()) for rule in rules]))
    added = {"errors": F.when(F.col("is_valid"), F.array().cast(ERROR_TYPE)).otherwise(broken)}
    if normalised is not None:
        added["data"] = F.when(F.col("is_valid"), F.struct(*normalised))
    return df.withColumns(added)


def error_codes(errors: str = "errors") -> Column:
    """``field:rule`` of every error, joined by ``|``, for reports."""
    return F.concat_ws(
        "|", F.transform(errors, lambda e: F.concat(e["field"], F.lit(":"), e["rule"]))
    )


def split_valid(df: DataFrame, flag: str = "is_valid") -> tuple[DataFrame, DataFrame]:
    """Valid rows and invalid rows; a row with a null flag is in neither."""
    return df.filter(F.col(flag)), df.filter(~F.col(flag))
