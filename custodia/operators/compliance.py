"""Compliance checks: minimisation, retention, consent, protection, access and change logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions.rules import Rule, all_hold, validate

# Audit retention in days, topic retention in milliseconds, table vacuum in hours.
AUDIT_RETENTION_DAYS = 2555
TOPIC_RETENTION_MS = {
    "crm_customers": 604_800_000,
    "crm_customers_dw": 2_592_000_000,
    "dlq.crm_customers": 604_800_000,
    "dlq.crm_customers_s3": 604_800_000,
    "kyc_responses": 259_200_000,
    "dlq.kyc_responses": 604_800_000,
    "transactions": 1_209_600_000,
    "dlq.transactions": 604_800_000,
}
VACUUM_HOURS = 168

# Text that is already protected: a SHA-256 digest in hex.
PROTECTED = r"^[0-9a-f]{64}$"


def extra_columns(collected: list[str], allowed: list[str]) -> list[str]:
    """Columns that are collected and not needed."""
    return sorted(set(collected) - set(allowed))


def missing_elements(required: list[str], present: Column) -> Column:
    """Required elements that an array column lacks."""
    return F.array_except(F.array(*[F.lit(r) for r in required]), present)


def extra_fields(messages: DataFrame, allowed: list[str], value: str = "value") -> DataFrame:
    """Keys found in messages beyond the allowed ones, with the number of messages that carry them."""
    extra = F.array_except(F.json_object_keys(value), F.array(*[F.lit(a) for a in allowed]))
    return (
        messages.select(extra.alias("extra"))
        .filter(F.size("extra") > 0)
        .select(F.explode("extra").alias("field"))
        .groupBy("field")
        .agg(F.count("*").alias("messages"))
    )


def expired(df: DataFrame, ts: str, as_of: Column, days: int = AUDIT_RETENTION_DAYS) -> DataFrame:
    """Rows older than the retention period."""
    return df.filter(F.col(ts) < as_of - F.expr(f"INTERVAL '{days}' DAY"))


def retained(df: DataFrame, ts: str, as_of: Column, milliseconds: int) -> DataFrame:
    """Rows a topic or table with this retention still holds."""
    return df.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL '{milliseconds / 1000:.3f}' SECOND"))


def retained_by_topic(df: DataFrame, ts: str, as_of: Column, retention_ms: dict[str, int]) -> DataFrame:
    """Rows of a mixed stream that their topic's retention still holds; unknown topics keep all."""
    limit = F.lit(None).cast("bigint")
    for topic, ms in retention_ms.items():
        limit = F.when(F.col("topic") == topic, F.lit(ms).cast("bigint")).otherwise(limit)
    age_ms = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))) / 1000
    return df.filter(limit.isNull() | (age_ms <= limit))


def consent_missing(processed: DataFrame, consents: DataFrame, key: str = "customer_id") -> DataFrame:
    """Processed customers without consent."""
    return processed.select(key).distinct().join(consents.select(key), key, "left_anti")


def in_clear(df: DataFrame, columns: list[str], pattern: str = PROTECTED) -> DataFrame:
    """Rows that hold a sensitive value in clear, with the names of the columns."""
    exposed = F.array_compact(
        F.array(*[F.when(F.col(c).isNotNull() & ~F.col(c).rlike(pattern), F.lit(c)) for c in columns])
    )
    return df.withColumn("exposed", exposed).filter(F.size("exposed") > 0)


def protect(df: DataFrame, columns: list[str], salt: str = "") -> DataFrame:
    """Replace sensitive values by salted SHA-256 digests."""
    return df.withColumns({c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256) for c in columns})


def _present(names: dict[str, str]) -> list[Rule]:
    return [Rule(n, "required", F.col(c).isNull(), "value is missing") for n, c in names.items()]


def access_log_gaps(log: DataFrame, as_of: Column, ts: str = "access_ts", hours: int = 1) -> DataFrame:
    """Accesses to sensitive data in the last hours that lack who, when or what."""
    rules = _present({"user_id": "user_id", "timestamp": ts, "action": "action"})
    # An access without a time cannot be placed outside the window, so it is a gap.
    window = F.col(ts).isNull() | F.col(ts).between(as_of - F.expr(f"INTERVAL '{hours}' HOUR"), as_of)
    recent = log.filter((F.col("data_type") == "sensitive") & window)
    return validate(recent.filter(~all_hold(rules)), rules).drop("is_valid")


def audit_gaps(changes: DataFrame, as_of: Column, ts: str = "change_ts", hours: int = 24) -> DataFrame:
    """Changes in the last hours that lack who, when, from, to or why."""
    names = {"user_id": "user_id", "timestamp": ts}
    rules = _present({**names, "old_version": "old_version", "new_version": "new_version", "reason": "reason"})
    window = F.col(ts).isNull() | F.col(ts).between(as_of - F.expr(f"INTERVAL '{hours}' HOUR"), as_of)
    return validate(changes.filter(window & ~all_hold(rules)), rules).drop("is_valid")
