"""Rule lists for the CRM, KYC and scoring records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from custodia.functions.parsing import coerce_timestamp
from custodia.functions.rules import Rule

# Identifier, phone and domain rules of the records.
CUSTOMER_ID = r"(?d)^[A-Za-z0-9]{8,}$"
PHONE = r"(?d)^\+?[0-9]{10,15}$"
VERIFICATION_STATUSES = ["pending", "verified", "rejected", "expired"]
RISK_LEVELS = ["low", "medium", "high"]
SCORING_RISK_LEVELS = ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]
CREDIT_SCORE_RANGE = (300, 850)

# Mailbox grammar: dot-separated local part up to 64 characters, a domain of at least two labels.
_ATOM = r"[\p{L}\p{N}!#$%&'*+/=?^_`{|}~-]+"
_LABEL = r"[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?"
EMAIL = rf"^(?=[^@]{{1,64}}@)(?=.{{3,254}}$){_ATOM}(?:\.{_ATOM})*@(?:{_LABEL}\.)+(?!\d+$){_LABEL}$"


def _absent(column: Column) -> Column:
    return column.isNull()


def _timestamp_rules(name: str, column: Column) -> list[Rule]:
    text = column.cast("string")
    return [
        Rule(name, "required", _absent(column), "value is missing"),
        Rule(name, "datetime", column.isNotNull() & coerce_timestamp(text).isNull(), "not a date and time"),
    ]


def trimmed(name: str, trim: bool = True) -> Column:
    return F.trim(name) if trim else F.col(name)


def crm_rules(trim: bool = True) -> list[Rule]:
    """Customer record: id, phone, e-mail and update time."""
    email = trimmed("email", trim)
    return [
        Rule("customer_id", "required", _absent(F.col("customer_id")), "value is missing"),
        Rule("customer_id", "format", ~F.col("customer_id").rlike(CUSTOMER_ID), "at least 8 letters or digits"),
        Rule("email", "email", ~email.rlike(EMAIL), "not an e-mail address"),
        Rule("phone", "format", (F.col("phone") != "") & ~F.col("phone").rlike(PHONE), "10 to 15 digits"),
        *_timestamp_rules("updated_at", F.col("updated_at")),
    ]


def crm_normalised(trim: bool = True) -> list[Column]:
    return [
        F.col("customer_id"),
        trimmed("first_name", trim).alias("first_name"),
        trimmed("last_name", trim).alias("last_name"),
        trimmed("email", trim).alias("email"),
        F.col("phone"),
        F.col("address"),
        coerce_timestamp(F.col("updated_at").cast("string")).alias("updated_at"),
    ]


def kyc_rules() -> list[Rule]:
    """Identity-check record: status, risk level and check time."""
    status, risk = F.col("verification_status"), F.col("risk_level")
    return [
        Rule("customer_id", "required", _absent(F.col("customer_id")), "value is missing"),
        Rule("verification_status", "required", _absent(status), "value is missing"),
        Rule("verification_status", "domain", ~F.lower(status).isin(VERIFICATION_STATUSES), "unknown status"),
        Rule("risk_level", "required", _absent(risk), "value is missing"),
        Rule("risk_level", "domain", ~F.lower(risk).isin(RISK_LEVELS), "unknown risk level"),
        *_timestamp_rules("verified_at", F.col("verified_at")),
    ]


def kyc_normalised() -> list[Column]:
    return [
        F.col("customer_id"),
        F.col("id_type"),
        F.col("id_number"),
        F.lower("verification_status").alias("verification_status"),
        F.lower("risk_level").alias("risk_level"),
        coerce_timestamp(F.col("verified_at").cast("string")).alias("verified_at"),
    ]


def scoring_rules(timestamp: str = "timestamp") -> list[Rule]:
    """Scoring result: five required fields, score range, risk domain, positive amount."""
    names = ["customer_id", "credit_score", "risk_level", "approved_amount", timestamp]
    low, high = CREDIT_SCORE_RANGE
    return [
        *[Rule(n, "required", _absent(F.col(n)), "value is missing") for n in names],
        Rule("credit_score", "range", ~F.col("credit_score").between(low, high), "outside 300 to 850"),
        Rule("risk_level", "domain", ~F.col("risk_level").isin(SCORING_RISK_LEVELS), "unknown risk level"),
        Rule("approved_amount", "positive", F.col("approved_amount") <= 0, "not positive"),
    ]


def hostile_identifier(column: str | Column) -> Column:
    """True when an identifier holds anything but letters, digits, ``_`` and ``-``.

    The allow-list turns away SQL fragments, markup and blanks alike.
    """
    column = F.col(column) if isinstance(column, str) else column
    return column.isNull() | ~column.rlike(r"(?d)^[A-Za-z0-9_-]+$")
