"""From raw documents to packed training sequences, one written stage after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.llm import packing, pii, quality, repeats, similarity
from custodia.llm.common import ship, stored, table

ORACLE_SQL = None  # hashing, a trained model and tokenizers: tested against a brute-force version instead


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number of their own, and the number's column, whose name no other column has.

    A stage's documents are a written table, cut into the same tasks and read in the same order each time, so
    every reading numbers them alike and no copy has to be written.
    """
    serial = "row_serial"
    while serial in docs.columns:
        serial += "_"
    return docs.withColumn(serial, F.monotonically_increasing_id()), serial


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity under trusted text is too high for their language.

    Rows are judged one by one, so a row of null or repeated id goes or stays by its own text; null and empty
    texts stay, an empty table stays empty.
    """
    rows, serial = numbered(docs)
    verdict = quality.classify(rows, table(ship(spark), sf_dir, "labels"), carry=(serial,))
    return rows.join(verdict.where("NOT kept").select(serial), serial, "left_anti").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: that of the smallest id, null last, and of those the first.

    Rows that repeat id and text are copies of each other. Null and empty texts are nobody's copies and stay.
    """
    ship(spark)
    rows, serial = numbered(docs)
    groups = similarity.join(rows, id_col=serial).where("n_links > 0").select(serial, "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", serial)
    best = rows.select("doc_id", serial).join(groups, serial).groupBy("component_id").agg(F.min(order)[serial].alias(serial))
    copies = groups.select(serial).join(best, serial, "left_anti")
    return rows.join(copies, serial, "left_anti").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages out of texts that stand in the remaining texts more than once; no row goes.

    Null texts stay null; rows of null or repeated id are texts of their own; other columns may have any names.
    """
    ship(spark)
    plain = docs.toDF(*[f"column_{i}" for i in range(len(docs.columns))])
    at = dict(zip(docs.columns, plain.columns))
    others = tuple(at[c] for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    done = repeats.remove_repeats(plain, at["doc_id"], at["text"], keep_text=True, carry=others)
    lengths = {"n_chars": F.char_length("kept_text").cast("long")}
    return done.select(*(F.col("kept_text").alias(c) if c == "text" else lengths[c].alias(c) if c in lengths else F.col(at[c]).alias(c) for c in docs.columns))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind of each personal datum in its place; null texts stay null."""
    ship(spark)
    masked = docs.withColumn("text", pii.masked_text(F.col("text")))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece of a document; a null or empty text is its end id."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", reject_poor),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("PII", mask_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its rows, which the next one reads."""
    docs = table(ship(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
