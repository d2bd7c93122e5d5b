"""Jobs: the pipelines a user runs, composed from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from custodia.functions.records import crm_normalised, crm_rules, kyc_normalised, kyc_rules
from custodia.functions.rules import validate
from custodia.functions.schema_dispatch import validate_messages
from custodia.operators import customers, deadletter, drift, quality, service, snapshot
from custodia.session import ensure_checkpointing
from custodia.sources import writers
from custodia.streaming import bucketed_mirror, dead_letters, ingest, mirror


def topic_to_lake(
    messages: DataFrame, schema: T.StructType, path: str, checkpoint: str, dead: str, **options
) -> StreamingQuery:
    """Topic messages parsed and appended to a lake table; unreadable ones to a dead-letter table."""
    return ingest.ingest(messages, schema, path, checkpoint, "dlq", dead, **options)


def validate_crm(crm: DataFrame, trim: bool = True) -> DataFrame:
    return validate(crm, crm_rules(trim), crm_normalised(trim))


def validate_kyc(kyc: DataFrame) -> DataFrame:
    return validate(kyc, kyc_rules(), kyc_normalised())


def validate_batch(records: DataFrame, data_type: str) -> DataFrame:
    """Validate a batch by its type: ``crm`` by the CRM rules, every other type by the KYC rules."""
    return validate_crm(records) if data_type == "crm" else validate_kyc(records)


def integrate_to_warehouse(crm: DataFrame, kyc: DataFrame, path: str, latest_only: bool = False) -> dict[str, int]:
    """Join CRM and KYC records into the warehouse; returns the rows of each stage.

    The counts are observed while the one write runs, so nothing is read twice.
    """
    seen = {name: Observation(name) for name in ("crm", "kyc", "integrated")}
    rows = F.count(F.lit(1)).alias("row_count")
    joined = customers.integrate(crm.observe(seen["crm"], rows), kyc.observe(seen["kyc"], rows), latest_only)
    writers.overwrite_warehouse(joined.observe(seen["integrated"], rows), path)
    return {name: writers.observed(observation, "row_count") for name, observation in seen.items()}


def enrich_to_lake(
    crm: DataFrame, responses: DataFrame, path: str, clock: Column | None = None, fmt: str = "parquet",
    audit: str | None = None, batch_id: int = 0,
) -> None:
    """Append customers with their KYC response to the lake, and a row of the write to the audit log where one is named."""
    enriched = customers.enrich(crm, responses, "customer_id", "kyc_response_json", clock)
    if audit is None:
        writers.append_table(enriched, path, fmt)
    else:
        writers.append_audited(enriched, path, audit, "enriched_customers", batch_id, clock, fmt)


def validate_table(messages: DataFrame, schema_path: str, schema: dict, path: str, value: str = "value") -> dict[str, int]:
    """Validate raw messages into one table, partitioned into ``outcome=valid`` and ``outcome=dead``.

    One pass: the counts are observed while the single write runs, and nothing is cached. Dead rows
    keep their errors.
    """
    counts = Observation("validated")
    checked = validate_messages(messages, schema_path, schema, value).observe(
        counts, F.count_if(F.col("is_valid")).alias("valid"), F.count_if(~F.col("is_valid")).alias("invalid")
    )
    outcome = F.when(F.col("is_valid"), "valid").otherwise("dead")
    checked.withColumn("outcome", outcome).drop("is_valid").write.mode("append").partitionBy("outcome").parquet(path)
    return {name: writers.observed(counts, name) for name in ("valid", "invalid")}


def triage(letters: DataFrame, catalogue: dict[str, dict], retry: str, archive: str, checkpoint: str, **options) -> StreamingQuery:
    """Replay or archive dead letters."""
    return dead_letters.triage_stream(letters, catalogue, retry, archive, checkpoint, **options)


def monitor_dead_letters(letters: DataFrame, topics: list[str]) -> DataFrame:
    """Alert row over the depth of the dead-letter topics."""
    return deadletter.alert(deadletter.depth(letters, topics))


@dataclass
class DriftReport:
    profile: DataFrame
    drift: DataFrame
    dataset: DataFrame


def monitor_transactions(
    reference: DataFrame, current: DataFrame, numeric: tuple[str, ...] = ("amount",),
    categorical: tuple[str, ...] = ("currency", "customer_id"),
) -> DriftReport:
    """Quality profile of the current transactions and their drift from the reference snapshot."""
    features = [*numeric, *categorical]
    reference, current = reference.select(*features), current.select(*features)
    report = drift.drift_report(reference, current, list(numeric), list(categorical))
    return DriftReport(
        quality.profile(current, list(numeric), list(categorical)), report, drift.dataset_verdict(report)
    )


def gated_integration(
    crm: DataFrame, kyc: DataFrame, path: str, notify: str, min_valid_share: float = 0.0, clock: Column | None = None, run: str | None = None
) -> dict[str, int]:
    """Validate both feeds, integrate the valid records, notify once per integrated customer.

    The job stops before anything is written when the share of valid records is below the gate; an
    empty feed fails any gate above 0. With the identity of a ``run`` its notifications stand in a folder of their own, so
    a run that is repeated replaces them instead of notifying again.
    """
    checked_crm, checked_kyc = validate_crm(crm), validate_kyc(kyc)
    summary = quality.validation_summary(checked_crm, "crm").unionByName(
        quality.validation_summary(checked_kyc, "kyc")
    )
    for row in summary.collect():  # two rows
        if min_valid_share > 0 and (not row["total"] or row["valid"] / row["total"] < min_valid_share):
            raise ValueError(f"{row['data_type']}: {row['valid']} of {row['total']} records are valid")
    counts = integrate_to_warehouse(
        checked_crm.filter("is_valid").select("data.*"), checked_kyc.filter("is_valid").select("data.*"), path
    )
    written = crm.sparkSession.read.parquet(path)
    writers.land_messages(
        customers.notifications(written.select("customer_id").distinct(), clock=clock).withColumn("topic", F.lit("crm_kyc_notifications")),
        notify,
        run,
    )
    return counts


def ingest_validate_retry(
    messages: DataFrame, schema_path: str, schema: dict, folder: str, catalogue: dict[str, dict],
    max_retries: int = 3, clock: Column | None = None,
) -> dict[str, int]:
    """One bounded run of the CRM chain: land the stream, validate what landed, triage what failed.

    Every step ends on its own, so the next can start. The later steps read what landed as a stream with
    a checkpoint of its own, so a further run handles new messages only; its counts are of that run.
    """
    spark: SparkSession = messages.sparkSession
    raw = messages.select(F.col("value").cast("string").alias("value"), "topic", "offset")
    ingest.append_stream(raw, f"{folder}/raw", f"{folder}/ckpt/raw").awaitTermination()
    checkpoint = f"{folder}/ckpt/validated"
    writer = ingest.writer_name(spark, checkpoint)
    counts = {"valid": 0, "invalid": 0}

    def step(batch: DataFrame, batch_id: int) -> None:
        checked = validate_messages(batch, schema_path, schema)
        outcome = F.when(F.col("is_valid"), "valid").otherwise("dead")
        stored = f"{folder}/validated/batch_id={writer}-{batch_id}"
        ingest.write_batch(
            checked.withColumn("outcome", outcome).drop("is_valid"), f"{folder}/validated", batch_id, partition=["outcome"], writer=writer
        )
        done = batch.sparkSession.read.parquet(stored)
        for row in done.groupBy("outcome").count().collect():  # two rows
            counts["valid" if row["outcome"] == "valid" else "invalid"] += row["count"]
        # An unreadable payload is kept as JSON text, so that the envelope itself stays readable.
        payload = F.when(F.try_parse_json("value").isNotNull(), F.col("value")).otherwise(F.to_json(F.struct(F.col("value").alias("raw"))))
        shell = F.to_json(F.struct(F.lit(schema_path).alias("schema_path"), F.lit(0).alias("retry_count")))
        envelope = F.concat(F.lit('{"payload":'), payload, F.lit(","), F.substring(shell, 2, 2_000_000_000))
        dead = done.filter(F.col("outcome") == "dead").select(envelope.alias("value"))
        routed = dead_letters.triage_letters(dead, catalogue, max_retries, clock)
        ingest.write_batch(deadletter.to_archive(routed, clock=clock), f"{folder}/archive", batch_id, writer=writer)

    landed = spark.readStream.schema(raw.schema).parquet(f"{folder}/raw")
    ingest.each_batch(landed, step, checkpoint).awaitTermination()
    return counts


@dataclass
class ServiceReport:
    summary: DataFrame
    verdict: DataFrame
    phases: DataFrame
    impact: DataFrame
    slos: DataFrame
    overall: DataFrame


def report_service(log: DataFrame, as_of: Column) -> ServiceReport:
    """Load, phase and service-level reports of one request log.

    The summary and the tails, a row each, are stored first; the reports that read them do not scan the log again.
    """
    ensure_checkpointing(log.sparkSession)
    summary, tails = service.load_summary(log).checkpoint(), service.load_quantiles(log).checkpoint()
    measured = service.service_metrics(summary, tails, quality.freshness(log, "ts", as_of))
    slos = service.slo_report(measured, service.slo_definitions(log))
    return ServiceReport(
        summary, service.load_verdict(summary, tails), service.phase_report(log), service.phase_impact(log),
        slos, service.slo_overall(slos),
    )


def mirror_changes(
    messages: DataFrame, schema: T.StructType, path: str, objects: str, checkpoint: str, keys: list[str], dead_letters_path: str | None = None
) -> list[StreamingQuery]:
    """Change stream to the mirrored table and to object storage; changes that cannot be applied go to a
    dead-letter table where one is named, and never to the mirror."""
    changes = customers.unwrap_change(messages, schema)
    state = mirror.mirror_stream(changes, path, f"{checkpoint}/mirror", keys, "offset")
    writer = ingest.writer_name(messages.sparkSession, f"{checkpoint}/objects")
    files = ingest.each_batch(
        messages, lambda batch, number: writers.write_objects(batch, f"{objects}/batch_id={writer}-{number}"), f"{checkpoint}/objects"
    )
    if dead_letters_path is None:
        return [state, files]
    rejected = customers.rejected_changes(messages, keys)
    return [state, files, ingest.append_stream(rejected, dead_letters_path, f"{checkpoint}/rejected")]


def mirror_from_snapshot(
    rows: DataFrame, fences: DataFrame, landed: DataFrame, changes: DataFrame, path: str, checkpoint: str, keys: list[str], position: str,
    deleted: str = "is_delete",
) -> StreamingQuery:
    """A mirror that begins with a snapshot and goes on with the change stream.

    ``landed`` holds the changes that the log has up to the last fence, ``changes`` is the stream of all of
    them. Reads are put in first; what the stream adds finds its place by position.
    """
    reads = snapshot.surviving_reads(rows, fences, landed, keys, position).withColumn(deleted, F.lit(False))
    bucketed_mirror.seed(reads, path, keys)
    return bucketed_mirror.bucketed_mirror_stream(changes, path, checkpoint, keys, position)
