"""Topics to lake tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from custodia.functions.parsing import CORRUPT, parse_json, parse_or_quarantine, stamp
from custodia.streaming.batches import each_batch, triggered, write_batch, writer_name
from custodia.streaming.commits import write_all

TRIGGER = "10 seconds"


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", interval: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Append a stream to a lake table; each query has its own checkpoint folder."""
    writer = rows.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, interval).start()


def console_stream(rows: DataFrame, interval: str | None = None) -> StreamingQuery:
    """Show a stream on the console, untruncated."""
    return triggered(rows.writeStream.format("console").outputMode("append").option("truncate", False), interval).start()


def ingest(
    messages: DataFrame,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    on_malformed: str = "dlq",
    dead_letters: str | None = None,
    fmt: str = "parquet",
    interval: str | None = None,
    clock: Column | None = None,
    commits: str | None = None,
) -> StreamingQuery:
    """Parse JSON messages and append them to a lake table.

    ``on_malformed="null_row"`` appends a row of nulls for an unreadable message; ``"dlq"`` appends
    the message with its origin to ``dead_letters`` and the readable rows to ``path``. With a log of ``commits`` a
    batch counts in both tables or in none, for readers that go by the log.
    """
    if on_malformed == "null_row":
        return append_stream(stamp(parse_json(messages, schema), clock=clock), path, checkpoint, fmt, interval)
    if on_malformed != "dlq" or dead_letters is None:
        raise ValueError("on_malformed is 'null_row' or 'dlq'; 'dlq' needs dead_letters")
    origin = ("topic", "partition", "offset", "timestamp", "value")
    renamed = [f"_{c}" for c in origin]
    parsed = parse_or_quarantine(
        messages.withColumnsRenamed(dict(zip(origin, renamed, strict=True))), schema, "_value", tuple(renamed)
    )
    good = [f.name for f in schema.fields]
    writer = writer_name(messages.sparkSession, checkpoint)

    def split(batch: DataFrame) -> dict[str, DataFrame]:
        rows = batch.filter(F.col(CORRUPT).isNull()).select(*good)
        bad = batch.filter(F.col(CORRUPT).isNotNull()).select(
            F.col("_topic").alias("topic"),
            F.col("_partition").alias("partition"),
            F.col("_offset").alias("offset"),
            F.col("_timestamp").alias("timestamp"),
            F.col("_value").cast("string").alias("value"),
            F.struct(
                F.lit("parse").alias("stage"),
                F.when(F.col("_value").isNull(), "null_message").otherwise("undecodable").alias("rule"),
                F.lit("not readable with the declared schema").alias("message"),
            ).alias("error"),
        )
        return {path: stamp(rows, clock=clock), dead_letters: bad}

    return each_batch(parsed, lambda batch, number: write_all(batch, split, number, writer, commits, fmt), checkpoint, interval)


def fan_out(
    rows: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Hand each micro-batch to several sinks while reading the source once."""

    def to_all(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks.values():
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return each_batch(rows, to_all, checkpoint, interval)


def deduplicated(rows: DataFrame, keys: list[str], event_time: str, delay: str = "1 hour") -> DataFrame:
    """Drop replays of a key that arrive within the delay; the state is bounded by the watermark."""
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def correlated(
    requests: DataFrame, results: DataFrame, key: str, seconds: int = 30, delay: str = "1 minute"
) -> DataFrame:
    """Requests marked ``answered`` when a result of the same key follows within the limit, else ``timeout``.

    Both sides need a ``ts`` timestamp. Time is cut into slots as long as the limit. An answer lies
    in the slot of its request or the next one, so per key and slot it is enough to know the last
    result in the slot and the first in the one after. Every request then meets at most one row,
    and a busy key is spread over its slots. The watermarks bound the state.
    """
    slot = F.floor(F.unix_micros("ts") / (seconds * 1_000_000))
    limit = F.expr(f"INTERVAL {seconds} SECONDS")
    asked = requests.withWatermark("ts", delay).withColumn("_slot", slot)

    late = F.col("ts") >= F.col("_w.start") + limit
    answers = (
        results.select(key, "ts")
        .withWatermark("ts", delay)
        .withColumn("_w", F.window("ts", f"{2 * seconds} seconds", f"{seconds} seconds"))
        .groupBy(key, "_w")
        .agg(F.max(F.when(~late, F.col("ts"))).alias("_last_own"), F.min(F.when(late, F.col("ts"))).alias("_first_next"))
        .select(
            F.col(key).alias("_k"),
            F.window_time("_w").alias("_t"),
            F.floor(F.unix_micros("_w.start") / (seconds * 1_000_000)).alias("_s"),
            "_last_own",
            "_first_next",
        )
    )
    same = (F.col(key) == F.col("_k")) & (F.col("_slot") == F.col("_s"))
    bounded = F.col("_t").between(F.col("ts"), F.col("ts") + limit + limit)
    found = (F.col("_last_own") >= F.col("ts")) | (F.col("_first_next") <= F.col("ts") + limit)
    status = F.when(F.col("_k").isNull(), "timeout").otherwise("answered")
    return (
        asked.join(answers, same & bounded & found, "leftOuter")
        .withColumn("status", status)
        .select(*requests.columns, "status")
    )


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait for all queries; the first failure of any is raised at once and stops the others."""
    running = list(queries)
    try:
        while running:
            running[0].awaitTermination(1)
            for query in list(running):
                if query.exception():
                    raise query.exception()
                if not query.isActive:
                    running.remove(query)
    finally:
        for query in running:
            query.stop()
