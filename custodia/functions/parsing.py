"""Message bytes to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# A date and a time are both needed; a bare date is not a point in time.
ISO_DATETIME = (
    r"^\s*\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}"
    r"(:\d{1,2}(\.\d{1,12})?)?(Z|[+-]\d{2}(:?\d{2})?)?\s*$"
)
EPOCH_NUMBER = r"^\s*[+-]?\d+(\.\d+)?\s*$"
# Numbers beyond this are taken as milliseconds (it is the year 2603 in seconds).
EPOCH_MILLIS_FROM = 2e10


# Field names and types of the nested KYC event.
KYC_EVENT = """
    customer_id string, kyc_status string, risk_score double, documents_verified boolean,
    verification_date bigint,
    personal_info struct<first_name: string, last_name: string, date_of_birth: string, nationality: string>,
    address struct<street: string, city: string, postal_code: string, country: string>,
    compliance_flags struct<pep_check: boolean, sanctions_check: boolean, aml_risk: string>,
    timestamp bigint
"""


def decode_value(column: str | Column = "value") -> Column:
    """UTF-8 bytes of a message as text."""
    return F.col(column).cast("string") if isinstance(column, str) else column.cast("string")


def parse_json(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Flatten JSON messages into the declared columns; an unreadable message is a row of nulls."""
    parsed = F.from_json(decode_value(value), schema, {"mode": "PERMISSIVE"})
    return messages.select(parsed.alias("data")).select("data.*")


def parse_or_quarantine(
    messages: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Flatten like :func:`parse_json` and say in ``_corrupt_record`` which text could not be read.

    Rows with a non-null ``_corrupt_record`` belong in a dead-letter table. A null or blank message is
    corrupt as well; its text is the empty string.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = decode_value(value)
    parsed = F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = [F.col(f"data.`{f.name}`") for f in schema.fields]
    blank = F.btrim(F.coalesce("_text", F.lit("")), F.lit(" \t\r\n")) == ""
    return messages.select(*keep, text.alias("_text"), parsed.alias("data")).select(
        *keep,
        *fields,
        F.when(blank, F.lit("")).otherwise(F.col(f"data.{CORRUPT}")).alias(CORRUPT),
    )


def stamp(df: DataFrame, name: str = "ingestion_time", clock: Column | None = None) -> DataFrame:
    """Add the time of the batch; pass ``clock`` to fix it."""
    return df.withColumn(name, F.current_timestamp() if clock is None else clock)


def coerce_timestamp(text: Column) -> Column:
    """ISO date-time text, epoch seconds or epoch milliseconds as a timestamp; else null."""
    number = text.try_cast("double")
    seconds = F.when(F.abs(number) > EPOCH_MILLIS_FROM, number / 1000).otherwise(number)
    return F.when(text.rlike(ISO_DATETIME), F.try_to_timestamp(F.trim(text))).when(
        text.rlike(EPOCH_NUMBER), F.timestamp_micros((seconds * 1_000_000).try_cast("bigint"))
    )


def message_timestamp(text: Column) -> Column:
    """Timestamp of a message field that producers send as ISO text or as epoch milliseconds."""
    return F.coalesce(F.try_to_timestamp(text), F.timestamp_millis(text.try_cast("bigint")))


def fill_missing(document: Column, key: str, value: Column, default: object) -> Column:
    """Default of a field that is absent from the document; a present null stays null."""
    absent = F.try_variant_get(document, f"$['{key}']", "variant").isNull()
    return F.when(absent, F.lit(default)).otherwise(value)


def flatten_kyc_event(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested KYC event to flat columns, epoch milliseconds to timestamps."""
    event = F.from_json(decode_value(value), KYC_EVENT)
    return messages.select(*keep, event.alias("e")).select(
        *keep,
        F.col("e.customer_id"),
        F.col("e.kyc_status"),
        F.col("e.risk_score"),
        F.col("e.documents_verified"),
        F.timestamp_millis("e.verification_date").alias("verification_date"),
        F.col("e.personal_info.first_name"),
        F.col("e.personal_info.last_name"),
        F.col("e.personal_info.date_of_birth").try_cast("date").alias("date_of_birth"),
        F.col("e.personal_info.nationality"),
        F.col("e.address.street"),
        F.col("e.address.city"),
        F.col("e.address.postal_code"),
        F.col("e.address.country"),
        F.col("e.compliance_flags.pep_check"),
        F.col("e.compliance_flags.sanctions_check"),
        F.col("e.compliance_flags.aml_risk"),
        F.timestamp_millis("e.timestamp").alias("event_time"),
    )
