"""Queries over change logs, commits across tables and waiting retries."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.operators import customers, snapshot
from custodia.plans import jobs
from custodia.sources import readers
from custodia.sources.schemas import TRANSACTION_STREAM
from custodia.streaming import backoff, bucketed_mirror, commits, ingest
from workload.records import PARSED
from workload.registry import query
from workload.sinks import envelope
from workload.streams import drain, landed
from workload.tables import as_of

CHUNKS = 8

# The table is read in eight chunks, one after another, while the log goes on. Chunk c is read at a place of its
# fence; the log that is at hand begins with the first fence. Keys are K<user>, their chunk is the user's.
FENCES = f"""fences AS (SELECT c AS chunk, first + c * step AS low, first + c * step + step // 16 AS read_at, first + c * step + step // 8 AS high
  FROM (SELECT max(msg_offset) // 4 AS first, max(msg_offset) // 20 AS step FROM cdc) p, (VALUES {", ".join(f"({c})" for c in range(CHUNKS))}) v(c))"""

READS = f"""{FENCES},
  numbered AS (SELECT *, CAST(substr(id, 2) AS BIGINT) % {CHUNKS} AS chunk FROM cdc),
  seen AS (SELECT n.*, low, high, row_number() OVER (PARTITION BY n.id ORDER BY msg_offset DESC) AS newest
    FROM numbered n JOIN fences f ON n.chunk = f.chunk WHERE msg_offset <= read_at),
  chunk_rows AS (SELECT id, chunk, low, high, after_status FROM seen WHERE newest = 1 AND NOT is_delete)"""

STATE = """SELECT id, after_status AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY msg_offset DESC) AS n FROM cdc) WHERE n = 1 AND NOT is_delete"""


def snapshot_of(d):
    """(chunk rows, fences, log since the first fence) of the change log."""
    log = d.view("cdc").select("id", F.col("msg_offset").alias("position"), F.col("after_status").alias("status"), "is_delete")
    top = log.agg(F.max("position").alias("top"))
    fences = top.select(F.explode(F.sequence(F.lit(0), F.lit(CHUNKS - 1))).alias("chunk"), F.expr("top div 4").alias("first"), F.expr("top div 20").alias("step"))
    fences = fences.selectExpr("chunk", "first + chunk * step AS low", "first + chunk * step + step div 16 AS read_at", "first + chunk * step + step div 8 AS high")
    chunk = (F.substring("id", 2, 20).cast("bigint") % CHUNKS).cast("int")
    before = log.withColumn("chunk", chunk).join(fences, "chunk").where("position <= read_at")
    rows = customers.fold_changes(before, ["id"], [F.col("position")], F.col("is_delete")).select("id", "status", "chunk")
    since = log.join(fences.agg(F.min("low").alias("begin")), F.col("position") > F.col("begin")).drop("begin")
    return rows, fences, since


@query("cdc_snapshot_interleave", STATE, "cdc")
def cdc_snapshot_interleave(d):
    return snapshot.state_after(*snapshot_of(d), ["id"], "position").select("id", "status")


@query(
    "cdc_snapshot_reads",
    f"""WITH {READS}
    SELECT id, high AS position, after_status AS status FROM chunk_rows r
    WHERE NOT EXISTS (SELECT 1 FROM cdc c WHERE c.id = r.id AND c.msg_offset > r.low AND c.msg_offset <= r.high)""",
    "cdc",
)
def cdc_snapshot_reads(d):
    return snapshot.surviving_reads(*snapshot_of(d), ["id"], "position").select("id", "position", "status")


def change_stream(d, rows):
    path = d.scratch()
    rows.write.parquet(path)
    return d.spark.readStream.schema(rows.schema).parquet(path)


@query("mirror_from_snapshot", STATE, "cdc")
def mirror_from_snapshot(d):
    """A mirror that begins with the chunks and goes on with the log as a stream."""
    path = d.scratch()
    rows, fences, since = snapshot_of(d)
    drain(jobs.mirror_from_snapshot(rows, fences, since, change_stream(d, since), path, d.scratch(), ["id"], "position"))
    return bucketed_mirror.read_state(d.spark, path, ["id"], "position").select("id", "status")


@query("mirror_incremental_fold", STATE, "cdc")
def mirror_incremental_fold(d):
    """The log comes in four parts; the mirror is folded after each of the first three and read with the last still unfolded."""
    path = d.scratch()
    log = d.view("cdc").select("id", F.col("msg_offset").alias("position"), F.col("after_status").alias("status"), "is_delete")
    for part in range(4):
        stream = change_stream(d, log.where(F.col("position") % 4 == part))
        drain(bucketed_mirror.bucketed_mirror_stream(stream, path, d.scratch(), ["id"], "position", buckets=16))
        if part < 3:
            bucketed_mirror.fold(d.spark, path, ["id"], "position", buckets=16)
    return bucketed_mirror.read_state(d.spark, path, ["id"], "position").select("id", "status")


@query(
    "stream_atomic_fan_out",
    """SELECT run, sink, CAST(sum(CASE run WHEN 'second' THEN 1 ELSE 0 END) AS BIGINT) AS messages
    FROM txn_msg, (VALUES ('raw'), ('audit')) s(sink), (VALUES ('first'), ('second')) r(run) GROUP BY ALL""",
    "txn_msg",
)
def stream_atomic_fan_out(d):
    """The first run dies between two tables: its batch counts in neither. The second run writes it to both."""
    raw, audit, log, checkpoint = (d.scratch() for _ in range(4))
    stream = landed(d, envelope(d))

    def broken(batch):
        dead = F.raise_error(F.lit("the second table is down")).cast("bigint")
        return {raw: batch, audit: batch.select("topic", F.coalesce(dead, F.col("offset")).alias("offset"))}

    def whole(batch):
        return {raw: batch, audit: batch.select("topic", "offset")}

    counts = []
    for run, split in (("first", broken), ("second", whole)):
        running = commits.atomic_fan_out(stream, split, log, checkpoint)
        try:
            running.awaitTermination()
        except Exception as error:  # noqa: BLE001 - the first run is meant to die
            if run != "first" or "table is down" not in str(error):
                raise
        for sink, path in (("raw", raw), ("audit", audit)):
            rows = commits.read_committed(d.spark, path, log) if run == "second" or sink == "raw" else d.spark.range(0)
            counts.append(rows.agg(F.count("*").alias("messages")).select(F.lit(run).alias("run"), F.lit(sink).alias("sink"), "messages"))
            if run == "first":
                counts[-1] = d.spark.createDataFrame(counts[-1].collect(), counts[-1].schema)  # as it was before the second run
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


@query(
    "stream_committed_ingest",
    f"""WITH {PARSED} SELECT 'lake' AS sink, count(*) AS messages FROM p WHERE j IS NOT NULL AND NOT coalesce(bad_field, false)
    UNION ALL SELECT 'dead', count(*) FROM p WHERE j IS NULL OR bad_field""",
    "txn_msg",
)
def stream_committed_ingest(d):
    """Readable and unreadable messages of a batch appear together."""
    path, dead, log = d.scratch(), d.scratch(), d.scratch()
    drain(ingest.ingest(landed(d, envelope(d)), TRANSACTION_STREAM, path, d.scratch(), dead_letters=dead, clock=as_of(), commits=log))
    good = commits.read_committed(d.spark, path, log).select(F.lit("lake").alias("sink"))
    return good.unionByName(commits.read_committed(d.spark, dead, log).select(F.lit("dead").alias("sink"))).groupBy("sink").agg(F.count("*").alias("messages"))


def failing():
    """A message fails as often as its number says, modulo six."""
    return lambda body, attempt: body is None or attempt >= int(body) % 6


@query(
    "stream_retry_backoff",
    """SELECT event_id AS message, k AS attempt, epoch_us(ts) // 1000 + CAST(1000 * (2 ** k - 1) AS BIGINT) AS at_ms,
      CASE WHEN k >= event_id % 6 THEN 'processed' WHEN k >= 3 THEN 'dlq' ELSE 'retry' END AS outcome
    FROM events, (VALUES (0), (1), (2), (3)) a(k) WHERE k <= event_id % 6""",
)
def stream_retry_backoff(d):
    """Every event is tried when it comes and again when its back-off is over, by the time of the stream."""
    events = d.table("events").select(
        F.concat(F.lit("K"), F.col("user_id").cast("string")).alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").cast("string").alias("body")
    )
    # A late marker moves the watermark past every due time; nothing is tried for it.
    end = d.spark.range(1).select(F.lit("END").alias("key"), F.timestamp_seconds(F.lit(4102444800)).alias("ts"), F.lit(None).cast("string").alias("body"))
    source, path = d.scratch(), d.scratch()
    last = F.to_timestamp(F.lit("2024-01-16"))
    for part in (events.where(F.col("ts") < last), events.where(F.coalesce(F.col("ts") >= last, F.lit(True))), end):
        part.write.mode("append").parquet(source)
    stream = readers.stream_landed_as(d.spark, source, events.schema, max_files=1_000)
    with backoff.keyed_state(d.spark):
        drain(ingest.append_stream(backoff.retried(stream, failing()), path, d.scratch()))
    rows = d.spark.read.parquet(path).where("key <> 'END'")
    return rows.select(F.col("body").cast("bigint").alias("message"), "attempt", "at_ms", "outcome")
