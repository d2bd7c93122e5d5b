"""Streams that end in retry, dead-letter and archive tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from custodia.functions.schema_dispatch import validate_by_path, validate_messages
from custodia.operators.deadletter import ARCHIVE, RETRY, attempt, parse_envelope, route, to_archive
from custodia.streaming.batches import each_batch, write_batch, writer_name
from custodia.streaming.commits import write_all


def flagged(messages: DataFrame, schema_path: str, schema: dict, value: str = "value") -> DataFrame:
    """Raw JSON text of a stream with ``is_valid``; stateless."""
    text = messages.withColumn(value, F.col(value).cast("string"))
    return validate_messages(text, schema_path, schema, value).drop("errors")


def triage_letters(
    letters: DataFrame, catalogue: dict[str, dict], max_retries: int = 3, clock: Column | None = None
) -> DataFrame:
    """Dead letters (raw envelope text in ``value``) with their route, reason and new count."""
    envelopes = parse_envelope(letters)
    validated = validate_by_path(envelopes, catalogue, "payload", "schema_path")
    return route(validated, F.col("is_valid"), max_retries, clock, F.col("decodable"))


def retry_message(routed: DataFrame) -> DataFrame:
    """Envelope text to send again, with the raised count.

    The payload is JSON already and is put back as it was, not as a quoted string.
    """
    shell = F.to_json(F.struct("schema_path", "retry_count", "last_retry_at"))
    text = F.concat(F.lit('{"payload":'), F.col("payload"), F.lit(","), F.substring(shell, 2, 2_000_000_000))
    return routed.filter(F.col("route") == RETRY).select(text.alias("value"))


def triage_stream(
    letters: DataFrame,
    catalogue: dict[str, dict],
    retry_path: str,
    archive_path: str,
    checkpoint: str,
    max_retries: int = 3,
    clock: Column | None = None,
    interval: str | None = None,
    commits: str | None = None,
) -> StreamingQuery:
    """Route dead letters: valid ones below the limit to the retry table, the rest to the archive.

    Each table gets one set-based write per micro-batch, never one per message. With a log of ``commits`` a batch
    counts in both tables or in none.
    """
    routed = triage_letters(letters, catalogue, max_retries, clock)
    writer = writer_name(letters.sparkSession, checkpoint)

    def split(batch: DataFrame) -> dict[str, DataFrame]:
        return {retry_path: retry_message(batch), archive_path: to_archive(batch.filter(F.col("route") == ARCHIVE), clock=clock)}

    return each_batch(routed, lambda batch, number: write_all(batch, split, number, writer, commits), checkpoint, interval)


def process_stream(
    messages: DataFrame, path: str, checkpoint: str, max_retries: int = 3, interval: str | None = None
) -> StreamingQuery:
    """Process messages with bounded retries, then dead-letter.

    One write, partitioned by outcome, holds processed and dead messages; the checkpoint is the
    commit, and a replayed batch replaces itself.
    """
    text = messages.withColumn("value", F.col("value").cast("string"))
    outcome = attempt(text, max_retries=max_retries)
    writer = writer_name(messages.sparkSession, checkpoint)
    return each_batch(outcome, lambda b, i: write_batch(b, path, i, partition=["outcome"], writer=writer), checkpoint, interval)
