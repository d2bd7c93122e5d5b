"""Compaction planned file by file: small files of a partition are packed into files of the wanted size.

A file of half the wanted size or more is left alone and not read. First-fit leaves at most one group a folder and
block that is half empty, and a group of one file is not rewritten, so compaction comes to rest. Groups are journalled
before files are replaced: ``finish`` brings a run that broke off to its end.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.sources.writers import COMPACT_TO_MB, partition_columns

BLOCK = 10_000  # files that one task packs; a folder of more is cut by a hash of the names
JOURNAL = "_compaction"  # below the table; readers skip names that begin like this
PLAN = "folder string, path string, bytes long, bin string, bin_files long, bin_bytes long"


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(folder, path, bytes) of a table's files, from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("folder"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("bytes"),
    )


def first_fit(sizes: np.ndarray, room: int) -> np.ndarray:
    """The group of each size: the first with room for it, sizes taken from the largest down; one above ``room`` is alone."""
    order = np.argsort(-sizes, kind="stable")
    groups, left, count = np.empty(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64), 0
    for i in order:
        fits = left[:count] >= sizes[i]
        group = int(np.argmax(fits)) if fits.any() else count
        if group == count:
            left[count] = room
            count += 1
        left[group] -= sizes[i]
        groups[i] = group
    return groups


def compaction_plan(files: DataFrame, target_bytes: int = COMPACT_TO_MB << 20, block: int = BLOCK) -> DataFrame:
    """The files of (folder, path, bytes) that are to be rewritten, with their group, its files and its bytes.

    Files of half the target or more and groups of a single file are not in the plan. Equal sizes go by path, so
    the plan does not depend on the order of the rows.
    """
    small = files.where(F.col("bytes") < target_bytes / 2)
    blocks = small.groupBy("folder").agg(F.ceil(F.count("*") / block).alias("blocks"))
    cut = small.join(blocks, "folder").withColumn("block", F.pmod(F.xxhash64("path"), "blocks"))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("path", ignore_index=True)
        group = first_fit(rows["bytes"].to_numpy(), target_bytes)
        sums = rows.groupby(group)["bytes"]
        out = rows[["folder", "path", "bytes"]].copy()
        out["bin"] = [f"{key[1]}-{g}" for g in group]
        out["bin_files"], out["bin_bytes"] = sums.transform("size"), sums.transform("sum")
        return out[out["bin_files"] > 1]

    return cut.groupBy("folder", "block").applyInPandas(pack, PLAN)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a name as users write it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def compact_small_files(spark: SparkSession, path: str, target_bytes: int = COMPACT_TO_MB << 20, block: int = BLOCK) -> int:
    """Compact a Parquet table in its place; returns the number of files that were replaced.

    Only small files are opened. The rows of a group go to one task, which holds at most ``target_bytes`` of files.
    While files are being replaced a reader may see rows missing, never twice; another writer may only add files.
    """
    path = path.rstrip("/")
    finish(spark, path)
    run = f"{path}/{JOURNAL}/{uuid.uuid4().hex}"
    compaction_plan(data_files(spark, path), target_bytes, block).write.parquet(f"{run}/plan")
    plan = spark.read.schema(PLAN).parquet(f"{run}/plan")
    replaced = plan.count()
    if replaced:
        layout = partition_columns(spark, path)
        source: Column = F.col("_metadata.file_path")
        rows = spark.read.parquet(path)
        columns = rows.columns
        small = rows.where(F.col("_metadata.file_size") < target_bytes / 2).select("*", source.alias("__path"))
        bins = plan.select(F.col("path").alias("__path"), F.concat_ws("-", F.xxhash64("folder"), "bin").alias("__bin"))
        moved = small.join(bins, "__path").select(*columns, "__bin").repartition("__bin")
        moved.sortWithinPartitions(*layout, "__bin").write.partitionBy(*layout, "__bin").parquet(f"{run}/data")
    fs, ready = _hadoop(spark, f"{run}/ready")
    fs.create(ready).close()
    finish(spark, path)
    return replaced


def finish(spark: SparkSession, path: str) -> None:
    """End all journalled runs: a run whose groups are written has its files replaced, any other is dropped.

    Each step can be taken again, so a run may break off here as well. One file is handled after another; only names
    pass through the driver, one at a time.
    """
    fs, journal = _hadoop(spark, f"{path.rstrip('/')}/{JOURNAL}")
    if not fs.exists(journal):
        return
    jvm = spark.sparkContext._jvm
    runs = fs.listStatusIterator(journal)
    while runs.hasNext():
        run = runs.next().getPath().toString()
        ready, data = (_hadoop(spark, f"{run}/{name}")[1] for name in ("ready", "data"))
        if fs.exists(ready):
            for row in spark.read.schema(PLAN).parquet(f"{run}/plan").select("path").toLocalIterator():
                fs.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["path"])), False)
            if fs.exists(data):
                made = fs.listFiles(data, True)
                prefix = data.toString() + "/"
                while made.hasNext():
                    file = made.next().getPath()
                    if not file.getName().endswith(".parquet"):
                        continue
                    folders = [f for f in file.toString().removeprefix(prefix).split("/")[:-1] if not f.startswith("__bin=")]
                    bin_ = next(f for f in file.toString().split("/") if f.startswith("__bin="))[len("__bin=") :]
                    folder = "/".join([path.rstrip("/"), *folders])
                    where = jvm.org.apache.hadoop.fs.Path(folder, f"compacted-{bin_}-{file.getName()}")
                    fs.mkdirs(where.getParent())
                    fs.rename(file, where)
        fs.delete(jvm.org.apache.hadoop.fs.Path(run), True)
