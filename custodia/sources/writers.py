"""Writers: lake tables, warehouse, topics, archives, reports."""

from __future__ import annotations

import uuid
from math import ceil

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMPACT_TO_MB = 128
ROWS_PER_FILE = 1000
ROTATE = "10 minutes"
JDBC_BATCH = 500
REPORT_ERRORS = 100


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


def overwrite_warehouse(df: DataFrame, path: str, partition: str = "risk_level") -> None:
    """Replace the warehouse table, partitioned by risk level (null goes to the default partition).

    There is no shuffle by level before the write: a level with most of the rows is written by all tasks.
    The new table is written beside the old one and put in its place once complete, so a write that
    fails leaves the old table as it was.
    """
    path = path.rstrip("/")
    staged, old = (f"{path}.{kind}-{uuid.uuid4().hex}" for kind in ("staged", "old"))
    df.write.partitionBy(partition).parquet(staged)
    jvm = df.sparkSession.sparkContext._jvm
    here, new, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, staged, old))
    fs = here.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    replaced = fs.exists(here)
    if replaced and not fs.rename(here, aside):
        raise OSError(f"cannot move {path}")
    if not fs.rename(new, here):
        raise OSError(f"cannot move {staged} to {path}")
    if replaced:
        fs.delete(aside, True)


def append_invalid(validated: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append the rows that failed validation to a dead-letter table."""
    append_table(validated.filter(~F.col("is_valid")), path, fmt)


def quarantine(messages: DataFrame, stage: str, rule: Column, message: Column) -> DataFrame:
    """Dead-letter rows with their origin (topic, partition, offset, time) and the error."""
    return messages.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("value").cast("string").alias("value"),
        F.struct(F.lit(stage).alias("stage"), rule.alias("rule"), message.alias("message")).alias("error"),
    )


def as_messages(df: DataFrame, topic: str | Column, key: str | None = None) -> DataFrame:
    """Rows as JSON messages; the topic is a column, so one write serves several topics."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    columns = [F.to_json(F.struct("*")).alias("value"), name.alias("topic")]
    if key is not None:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*columns)


def publish(messages: DataFrame, bootstrap_servers: str) -> None:
    """Send message rows (value, topic, optionally key) to their topics."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save()


def land_messages(messages: DataFrame, path: str, run: str | None = None) -> None:
    """Message rows as files per topic, where no broker is at hand.

    Those of a named ``run`` replace what the same run landed before.
    """
    if run is None:
        messages.write.mode("append").partitionBy("topic").json(path)
    else:
        messages.write.mode("overwrite").partitionBy("topic").json(f"{path.rstrip('/')}/run={run}")


def write_objects(messages: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Messages as Parquet objects of at most so many rows, by topic and partition.

    The folder is replaced: a stream gives each micro-batch its own, so a replay stores nothing twice.
    """
    messages.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("topic", "partition").parquet(path)


def write_relational(df: DataFrame, mode: str = "append", **options: str) -> None:
    """Relational write in batches; connection options and secrets are passed in."""
    df.write.format("jdbc").options(batchsize=str(JDBC_BATCH), **options).mode(mode).save()


def merge_statement(target: str, source: str, keys: list[str], columns: list[str], deleted: str | None = None) -> str:
    """``MERGE`` text that upserts a staged batch by key, for a Delta table or a relational target."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"{c} = s.{c}" for c in columns if c not in keys)
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    drop = f" WHEN MATCHED AND s.{deleted} THEN DELETE" if deleted else ""
    keep = f" AND NOT s.{deleted}" if deleted else ""
    return (
        f"MERGE INTO {target} t USING {source} s ON {on}{drop}"
        f" WHEN MATCHED THEN UPDATE SET {sets}"
        f" WHEN NOT MATCHED{keep} THEN INSERT ({names}) VALUES ({values})"
    )


def write_report(report: DataFrame, path: str) -> None:
    """One JSON file with a one-row report."""
    report.coalesce(1).write.mode("overwrite").json(path)


def load_report(summary: DataFrame, log: DataFrame, config: dict[str, str], max_errors: int = REPORT_ERRORS) -> DataFrame:
    """One-row report: run settings, summary and the first error texts by arrival.

    The report shows a fixed number of errors; the log keeps all of them.
    """
    early = (
        log.filter(F.coalesce(F.col("error"), F.lit("")) != "").select("seq", "error").orderBy("seq").limit(max_errors)
    )
    texts = early.agg(F.array_sort(F.collect_list(F.struct("seq", "error"))).alias("e")).select(F.col("e.error")).scalar()
    settings = F.create_map(*[F.lit(x) for pair in sorted(config.items()) for x in pair])
    return summary.select(settings.alias("test_config"), F.struct(*summary.columns).alias("summary"), texts.alias("errors"))


def table_bytes(spark: SparkSession, path: str) -> int:
    """Size of a table's files."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(folder).getLength()


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that the folders of a table stand for, outermost first, found by walking down one branch."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    layout: list[str] = []
    while True:
        below = fs.listStatusIterator(folder)
        while below.hasNext():
            status = below.next()
            name = status.getPath().getName()
            if status.isDirectory() and "=" in name:
                layout.append(name.partition("=")[0])
                folder = status.getPath()
                break
        else:
            return layout


def compact_table(spark: SparkSession, source: str, target: str, file_mb: int = COMPACT_TO_MB) -> int:
    """Rewrite a Parquet table into files of about the given size; returns the number of files to expect.

    The copy has the partition folders of the source. The new copy goes to another folder, so readers of the old one are not disturbed.
    """
    rows = spark.read.parquet(source)
    layout = partition_columns(spark, source)
    files = max(1, ceil(table_bytes(spark, source) / (file_mb * 1024 * 1024)))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, f"{file_mb}m")
    try:
        out = rows.hint("rebalance", *layout).write.mode("overwrite")
        (out.partitionBy(*layout) if layout else out).parquet(target)
    finally:
        spark.conf.set(size, before)
    return files


def audit_row(df: DataFrame, table: str, batch_id: int, clock: Column | None = None) -> DataFrame:
    """Audit row of one write: batch, table, number of rows, time."""
    return _audit(df.agg(F.count("*").alias("row_count")), table, batch_id, clock)


def _audit(counted: DataFrame, table: str, batch_id: int, clock: Column | None) -> DataFrame:
    return counted.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(table).alias("table_name"),
        "row_count",
        (F.current_timestamp() if clock is None else clock).alias("written_at"),
    )


def observed(observation: Observation, name: str) -> int:
    """A count seen during a write; zero when the rows were known to be empty and their plan did not run."""
    try:
        return observation.get[name]
    except Py4JJavaError as error:  # Spark asserts that there is a row
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return 0


def append_audited(
    df: DataFrame, path: str, audit: str, table: str, batch_id: int, clock: Column | None = None, fmt: str = "parquet"
) -> int:
    """Append to a table and then one audit row of that write to the audit log; returns the rows written.

    Rows are counted while they are written. A write without an audit row did not reach its end.
    """
    seen = Observation()
    append_table(df.observe(seen, F.count(F.lit(1)).alias("row_count")), path, fmt)
    rows = observed(seen, "row_count")
    counted = df.sparkSession.range(1).select(F.lit(rows).cast("bigint").alias("row_count"))
    append_table(_audit(counted, table, batch_id, clock), audit, fmt)
    return rows
