"""A mirror of a change stream whose upkeep follows the changes and not the history.

Changes and base are laid out by a hash bucket of the key. A fold reads the buckets that have new changes, writes
their new base and a manifest that says, for every bucket, where its base is and which change batches are in it.
The newest whole manifest is the pointer to the current base; the older base stays for those
who still read it until ``forget`` removes it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from custodia.operators.customers import latest_per_key
from custodia.streaming.batches import each_batch, write_batch, writer_name

BUCKETS = 64
MANIFEST = "bucket int, generation long"
FOLDED = "batch string"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What stands behind ``prefix`` in the names of a folder's sub-folders; one listing, no data."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(name.removeprefix(prefix) for name in found if name.startswith(prefix))


def _exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    name = context._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(context._jsc.hadoopConfiguration()).exists(name)


def bucketed_mirror_stream(
    changes: DataFrame, path: str, checkpoint: str, keys: list[str], order: str, buckets: int = BUCKETS, interval: str | None = None
) -> StreamingQuery:
    """Store the newest change per key of every micro-batch by bucket; keyless changes are left out.

    The number of buckets is fixed for the life of a mirror.
    """
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    writer = writer_name(changes.sparkSession, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        newest = latest_per_key(batch.filter(keyed), keys, [F.col(order)])
        write_batch(newest.withColumn("bucket", bucket_of(keys, buckets)), f"{path}/changes", number, partition=["bucket"], writer=writer)

    return each_batch(changes, write, checkpoint, interval)


def seed(reads: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Put rows of a snapshot, at their positions in the log, into a mirror; doing so again replaces them."""
    write_batch(reads.withColumn("bucket", bucket_of(keys, buckets)), f"{path}/changes", 0, partition=["bucket"], writer="snapshot")


def generation(spark: SparkSession, path: str) -> int:
    """The newest manifest that was written whole; 0 before the first fold."""
    done = [int(n) for n in _names(spark, f"{path}/manifests", "generation=") if _exists(spark, f"{path}/manifests/generation={n}/folded/_SUCCESS")]
    return max(done, default=0)


def _manifest(spark: SparkSession, path: str, current: int) -> tuple[dict[int, int], set[str]]:
    """(generation of each bucket's base, batches in the bases): as many rows as buckets, and as batches kept."""
    if not current:
        return {}, set()
    folder = f"{path}/manifests/generation={current}"
    bases = spark.read.schema(MANIFEST).parquet(f"{folder}/bases").collect()
    return {r["bucket"]: r["generation"] for r in bases}, {r["batch"] for r in spark.read.schema(FOLDED).parquet(f"{folder}/folded").collect()}


def pending(spark: SparkSession, path: str, folded: set[str]) -> tuple[list[str], set[int]]:
    """(folders of changes that no base holds, their buckets), from folder names alone."""
    batches = [b for b in _names(spark, f"{path}/changes", "batch_id=") if b not in folded and _exists(spark, f"{path}/changes/batch_id={b}/_SUCCESS")]
    folders, buckets = [], set()
    for batch in batches:
        for bucket in _names(spark, f"{path}/changes/batch_id={batch}", "bucket="):
            folders.append(f"{path}/changes/batch_id={batch}/bucket={bucket}")
            buckets.add(int(bucket))
    return folders, buckets


def _folded(spark: SparkSession, path: str, bases: dict[int, int], folders: list[str], buckets: set[int], keys: list[str], order: str) -> DataFrame:
    """The newest change per key of some buckets, from their bases and their new changes alone."""
    files = folders + [f"{path}/base/generation={bases[b]}/bucket={b}" for b in sorted(buckets) if b in bases]
    return latest_per_key(spark.read.option("mergeSchema", True).parquet(*files), keys, [F.col(order)])


def fold(spark: SparkSession, path: str, keys: list[str], order: str, buckets: int = BUCKETS) -> int:
    """Fold new changes into the base; returns the number of buckets rewritten.

    Marked deletes stay, so that a change which arrives late cannot bring a deleted key back. A fold that
    dies leaves the mirror as it was; the next one takes the same number and replaces what is left of it.
    """
    current = generation(spark, path)
    bases, folded = _manifest(spark, path, current)
    folders, touched = pending(spark, path, folded)
    if not folders:
        return 0
    target = f"{path}/base/generation={current + 1}"
    newest = _folded(spark, path, bases, folders, touched, keys, order)
    newest.withColumn("bucket", bucket_of(keys, buckets)).write.mode("overwrite").partitionBy("bucket").parquet(target)
    bases.update(dict.fromkeys(touched, current + 1))
    batches = {f.rpartition("/bucket=")[0].rpartition("batch_id=")[2] for f in folders}
    manifest = f"{path}/manifests/generation={current + 1}"
    spark.createDataFrame(sorted(bases.items()), MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{manifest}/bases")
    spark.createDataFrame([(b,) for b in sorted(folded | batches)], FOLDED).coalesce(1).write.mode("overwrite").parquet(f"{manifest}/folded")
    return len(touched)


def read_state(spark: SparkSession, path: str, keys: list[str], order: str, deleted: str = "is_delete") -> DataFrame:
    """Current rows: buckets without new changes as they stand, the others folded on the way."""
    bases, folded = _manifest(spark, path, generation(spark, path))
    folders, touched = pending(spark, path, folded)
    still = [f"{path}/base/generation={g}/bucket={b}" for b, g in sorted(bases.items()) if b not in touched]
    parts = [spark.read.option("mergeSchema", True).parquet(*still)] if still else []
    if folders:
        parts.append(_folded(spark, path, bases, folders, touched, keys, order))
    if not parts:
        raise FileNotFoundError(f"{path} holds neither changes nor a base")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted, "bucket")


def forget(spark: SparkSession, path: str) -> int:
    """Remove folded change batches and bases that no bucket of the current manifest uses; returns how many folders went.

    For a time when nobody reads an older generation.
    """
    current = generation(spark, path)
    bases, folded = _manifest(spark, path, current)
    gone = [f"{path}/changes/batch_id={b}" for b in _names(spark, f"{path}/changes", "batch_id=") if b in folded]
    for old in _names(spark, f"{path}/base", "generation="):
        for bucket in _names(spark, f"{path}/base/generation={old}", "bucket="):
            if bases.get(int(bucket)) != int(old) and int(old) <= current:
                gone.append(f"{path}/base/generation={old}/bucket={bucket}")
    context = spark.sparkContext
    for folder in gone:
        name = context._jvm.org.apache.hadoop.fs.Path(folder)
        name.getFileSystem(context._jsc.hadoopConfiguration()).delete(name, True)
    return len(gone)
