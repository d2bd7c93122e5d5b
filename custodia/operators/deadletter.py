"""Dead-letter handling: what to retry, what to archive, what to report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RETRIES = 3
RETRY_DELAY_SECONDS = 5

RETRY, ARCHIVE, DLQ = "retry", "archive", "dlq"
MAX_RETRY, VALIDATION_FAILED, UNDECODABLE = "max_retry", "validation_failed", "undecodable"

# Texts that archives carry for each reason code.
ARCHIVE_REASONS = {MAX_RETRY: "Max retry atteint", VALIDATION_FAILED: "Validation échouée"}
RETRY_MANAGER_REASONS = {MAX_RETRY: "Nombre max de retry atteint", VALIDATION_FAILED: "Validation échouée"}
MAX_RETRY_EXCEEDED = "MaxRetryExceeded"


def dlq_name(topic: str) -> str:
    """Dead-letter topic of a topic."""
    return f"dlq.{topic}"


def parse_envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """Envelope fields of dead letters; ``decodable`` is false for text that is not a JSON object.

    The payload stays JSON text, whatever its type, so nothing of it is lost. A missing payload is
    an empty object and a missing schema path is empty.
    """
    kept = [c for c in messages.columns if c != value]
    envelope, text = F.col("_e"), F.col("message")
    # The text of an object is cut out as it stands; only other payloads are written anew, so that
    # a payload which is a string keeps its quotes.
    is_object = F.try_variant_get(envelope, "$.payload", "struct<any: variant>").isNotNull()
    other = F.to_json(F.try_variant_get(envelope, "$.payload", "variant"))
    payload = F.when(is_object, F.get_json_object(text, "$.payload")).otherwise(F.coalesce(other, F.lit("{}")))
    opened = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
    return (
        messages.withColumn("message", F.col(value).cast("string"))
        .withColumn("_e", F.try_parse_json("message"))
        .select(
            *kept,
            "message",
            (envelope.isNotNull() & opened).alias("decodable"),
            payload.alias("payload"),
            F.coalesce(F.try_variant_get(envelope, "$.schema_path", "string"), F.lit("")).alias("schema_path"),
            F.try_variant_get(envelope, "$.retry_count", "int").alias("retry_count"),
            F.try_variant_get(envelope, "$.last_retry_at", "string").alias("last_retry_at"),
        )
    )


def iso_text(clock: Column) -> Column:
    return F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def route(
    letters: DataFrame,
    is_valid: Column,
    max_retries: int = MAX_RETRIES,
    clock: Column | None = None,
    decodable: Column | None = None,
) -> DataFrame:
    """Where each dead letter goes.

    Valid letters below the limit go to ``retry`` with their count raised by one; all others go to
    ``archive`` with a reason. A missing count is zero. Text that cannot be decoded is archived, so
    that one bad message never stops the job.
    """
    now = F.current_timestamp() if clock is None else clock
    count = F.coalesce("retry_count", F.lit(0))
    ok = F.coalesce(is_valid, F.lit(False))
    readable = F.lit(True) if decodable is None else F.coalesce(decodable, F.lit(False))
    again = readable & ok & (count < max_retries)
    reason = (
        F.when(~readable, UNDECODABLE).when(~ok, VALIDATION_FAILED).when(count >= max_retries, MAX_RETRY)
    )
    last = F.col("last_retry_at") if "last_retry_at" in letters.columns else F.lit(None).cast("string")
    return letters.withColumns(
        {
            "route": F.when(again, RETRY).otherwise(ARCHIVE),
            "reason": reason,
            "retry_count": F.when(again, count + 1).otherwise(count),
            "last_retry_at": F.when(again, iso_text(now)).otherwise(last),
        }
    )


def schedule_retry(
    messages: DataFrame, ts: str = "ts", max_retries: int = MAX_RETRIES, missing_as: int = 0
) -> DataFrame:
    """Retry policy with back-off: below the limit a message is due ``2 ** retry_count`` seconds later.

    Above it the message goes to the dead-letter topic with the reason ``MaxRetryExceeded``.
    """
    count = F.coalesce("retry_count", F.lit(missing_as))
    over = count >= max_retries
    wait = F.make_dt_interval(secs=F.pow(F.lit(2.0), count).cast("decimal(18,6)"))
    return messages.withColumns(
        {
            "retry_count": count,
            "route": F.when(over, DLQ).otherwise(RETRY),
            "reason": F.when(over, MAX_RETRY_EXCEEDED),
            "next_retry_at": F.when(~over, F.col(ts) + wait),
        }
    )


def due(scheduled: DataFrame, as_of: Column) -> DataFrame:
    """Messages whose back-off is over; replaces waiting inside a task."""
    return scheduled.filter((F.col("route") == RETRY) & (F.col("next_retry_at") <= as_of))


def dead_letter_message(original: Column, reason: Column) -> Column:
    """``{original_message, reason}`` with the original kept as nested JSON."""
    return F.concat(
        F.lit('{"original_message":'), original, F.lit(',"reason":'), F.to_json(F.array(reason)).substr(F.lit(2), F.length(F.to_json(F.array(reason))) - 2), F.lit("}")
    )


def to_archive(
    routed: DataFrame, message: str = "message", labels: dict[str, str] | None = None, clock: Column | None = None
) -> DataFrame:
    """Archive rows ``(message, error_reason, archived_at)`` of all letters routed to the archive."""
    now = F.current_timestamp() if clock is None else clock
    text = F.col("reason")
    for code, label in (ARCHIVE_REASONS if labels is None else labels).items():
        text = F.when(F.col("reason") == code, F.lit(label)).otherwise(text)
    return routed.filter(F.col("route") == ARCHIVE).select(
        F.col(message).alias("message"), text.alias("error_reason"), iso_text(now).alias("archived_at")
    )


def processable(value: str = "value") -> Column:
    """False when ``transaction_id`` is absent, null, not text or contains ``fail``; never null."""
    document = F.try_parse_json(value)
    is_text = F.schema_of_variant(F.try_variant_get(document, "$.transaction_id", "variant")) == "STRING"
    text = F.try_variant_get(document, "$.transaction_id", "string")
    return F.coalesce(is_text & ~text.contains("fail"), F.lit(False))


def attempt(messages: DataFrame, value: str = "value", max_retries: int = MAX_RETRIES) -> DataFrame:
    """Outcome of processing with bounded retries.

    The check is deterministic, so one evaluation stands for all attempts and nothing waits:
    ``attempts`` is 1 for processed messages and the limit for those sent to the dead-letter topic.
    """
    ok = processable(value)
    return messages.withColumn("_ok", ok).select(
        "*",
        F.when(F.col("_ok"), "processed").otherwise(DLQ).alias("outcome"),
        F.when(F.col("_ok"), 1).otherwise(max_retries).alias("attempts"),
    ).drop("_ok")


def depth(letters: DataFrame, topics: list[str]) -> DataFrame:
    """Messages per dead-letter topic, zero for empty ones."""
    known = letters.sparkSession.createDataFrame([(t,) for t in topics], "topic string")
    counted = letters.filter(F.col("topic").isin(topics)).groupBy("topic").agg(F.count("*").alias("messages"))
    return known.join(counted, "topic", "left").select("topic", F.coalesce("messages", F.lit(0)).alias("messages"))


def alert(depths: DataFrame) -> DataFrame:
    """One row: a line per topic that holds messages, or a note that none does.

    There is one line per monitored topic, so the text is bounded by the topic list.
    """
    line = F.concat(F.col("messages").cast("string"), F.lit(" messages en erreur dans le topic "), F.col("topic"))
    lines = F.array_sort(F.collect_list(F.when(F.col("messages") > 0, F.struct("topic", line.alias("line")))))
    return depths.agg(lines.alias("found")).select(
        (F.size("found") > 0).alias("alert"),
        F.when(F.size("found") > 0, F.array_join(F.col("found.line"), "\n")).otherwise("Aucun message en DLQ").alias("body"),
    )
