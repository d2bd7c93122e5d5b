"""Readers. Connectors that need a broker or database are option builders over Spark's own sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.sources.schemas import CRM_CSV, KYC_CSV, KYC_DOCUMENT, SCORING_REQUEST

# Columns of every message frame, whatever carries the messages.
ENVELOPE = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
MAX_FILES_PER_TRIGGER = 1000


def kafka_options(bootstrap_servers: str, topics: list[str], **more: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        **more,
    }


def stream_topics(spark: SparkSession, bootstrap_servers: str, topics: list[str], **more: str) -> DataFrame:
    """Unbounded read of topics from their first offset."""
    return spark.readStream.format("kafka").options(**kafka_options(bootstrap_servers, topics, **more)).load()


def read_topics(spark: SparkSession, bootstrap_servers: str, topics: list[str], **more: str) -> DataFrame:
    """Bounded read of topics from their first to their last offset."""
    return spark.read.format("kafka").options(**kafka_options(bootstrap_servers, topics, **more)).load()


def landed_envelope(messages: DataFrame, topic: str | Column, value: Column, offset: Column, ts: Column) -> DataFrame:
    """Rows of any frame in the shape of topic messages."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        name.alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
        ts.cast("timestamp").alias("timestamp"),
    )


def stream_landed(spark: SparkSession, path: str, max_files: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Messages that land as Parquet files in the envelope shape, as a stream."""
    return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", max_files).parquet(path)


def stream_landed_as(spark: SparkSession, path: str, schema: T.StructType, max_files: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Rows of any shape that land as Parquet files, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(path)


def stream_responses(spark: SparkSession, path: str, topic: str = "kyc_responses") -> DataFrame:
    """Polled service responses that land as JSON lines, one message per line, as a stream."""
    lines = spark.readStream.text(path)
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def first_messages(messages: DataFrame, count: int = 10) -> DataFrame:
    """The first messages in offset order, at least one if there is any."""
    return messages.orderBy("partition", "offset").limit(max(count, 1))


def read_crm(spark: SparkSession, path: str) -> DataFrame:
    """CRM records from CSV files with a header."""
    return spark.read.schema(CRM_CSV).option("header", True).csv(path)


def read_kyc(spark: SparkSession, path: str) -> DataFrame:
    """KYC records from CSV files with a header."""
    return spark.read.schema(KYC_CSV).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """A lake table; the format is ``delta`` where it is deployed."""
    return spark.read.format(fmt).option("mergeSchema", merge_schema).load(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Documents whose top level is an array: one row per element.

    A whole file is one split, so this is for document files; message traffic belongs in JSON lines.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_kyc_documents(spark: SparkSession, path: str) -> DataFrame:
    rows = read_json_array(spark, path, KYC_DOCUMENT)
    return rows.withColumn("verification_date", F.timestamp_millis("verification_date"))


def read_scoring_requests(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, SCORING_REQUEST)


def jdbc_options(url: str, table: str, column: str, lower: object, upper: object, partitions: int, **more: str) -> dict:
    """Options of a partitioned relational scan. Secrets come in through ``more``, never from here."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        **more,
    }


def read_relational(spark: SparkSession, schema: T.StructType | None = None, **options: str) -> DataFrame:
    """Relational table read in parallel ranges, with declared types where given."""
    reader = spark.read.format("jdbc").options(**options)
    if schema is not None:
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        reader = reader.option("customSchema", ddl)
    return reader.load()
