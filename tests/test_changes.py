"""Snapshots fenced into a log, commits over several tables, folds by bucket, waiting retries."""

import datetime as dt
import json
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from custodia.operators import snapshot
from custodia.plans import jobs
from custodia.sources import readers, writers
from custodia.sources.schemas import TRANSACTION_STREAM
from custodia.streaming import backoff, bucketed_mirror, commits, dead_letters, ingest

TS = dt.datetime(2024, 1, 1)
LOG = "id string, position long, status string, is_delete boolean"


def stream_of(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return readers.stream_landed_as(spark, path, spark.createDataFrame([], schema).schema)


# --- snapshot and log -----------------------------------------------------------------------------


def test_a_change_inside_the_fence_wins_over_the_read(spark):
    rows = spark.createDataFrame([(k, "read", 0) for k in ("before", "inside", "at_low", "at_high", "after", "quiet")] + [("other", "read", 1), ("lost", "read", 2), (None, "read", 0)], "id string, status string, chunk int")
    fences = spark.createDataFrame([(0, 10, 20), (1, 20, 30)], "chunk int, low long, high long")
    log = [("before", 5), ("inside", 15), ("at_low", 10), ("at_high", 20), ("after", 21), ("other", 15), ("lost", 1), ("new", 12), (None, 15)]
    changes = spark.createDataFrame([(k, p, "change", False) for k, p in log] + [("gone", 3, None, True), ("inside", 16, None, True)], LOG)
    reads = snapshot.surviving_reads(rows, fences, changes, ["id"], "position")
    got = {r["id"]: r["position"] for r in reads.collect()}
    assert got == {"before": 20, "at_low": 20, "after": 20, "quiet": 20, "other": 30, None: 20}
    log = snapshot.interleave(rows, fences, changes, ["id"], "position")
    assert log.where("op = 'read'").count() == 6 and log.where("op = 'change'").count() == 11
    state = {r["id"]: r["status"] for r in snapshot.state_after(rows, fences, changes, ["id"], "position").where("id IS NOT NULL").collect()}
    assert state == {"before": "read", "at_low": "read", "at_high": "change", "after": "change", "quiet": "read", "other": "read", "lost": "change", "new": "change"}


def test_chunks_hold_each_key_once(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k")).withColumn("chunk", snapshot.chunk_of(["k"], 7))
    assert rows.select("chunk").distinct().count() == 7 and rows.where("chunk < 0 OR chunk > 6").isEmpty()


def test_mirror_from_snapshot_and_again(spark, tmp_path):
    path, source = str(tmp_path / "m"), str(tmp_path / "in")
    rows = spark.createDataFrame([("a", "read", 0), ("b", "read", 0)], "id string, status string, chunk int")
    fences = spark.createDataFrame([(0, 10, 20)], "chunk int, low long, high long")
    log = [("a", 15, "changed", False), ("c", 18, "new", False), ("b", 25, None, True)]
    for _ in range(2):  # a second start puts the same reads in again
        landed = spark.createDataFrame(log[:2], LOG)
        jobs.mirror_from_snapshot(rows, fences, landed, stream_of(spark, source, log if _ == 0 else [], LOG), path, str(tmp_path / "c"), ["id"], "position").awaitTermination()
    state = bucketed_mirror.read_state(spark, path, ["id"], "position")
    assert sorted((r["id"], r["status"]) for r in state.collect()) == [("a", "changed"), ("c", "new")]


# --- commits --------------------------------------------------------------------------------------


def numbers(spark, path, first, last):
    return stream_of(spark, path, [(i,) for i in range(first, last)], "n long")


def test_a_batch_is_seen_in_all_tables_or_in_none(spark, tmp_path):
    left, right, log, ckpt, source = (str(tmp_path / n) for n in ("left", "right", "log", "ckpt", "in"))
    seen = {}

    def split(batch, dies=False):
        gone = F.when(F.col("n") == 4, F.raise_error(F.lit("killed between two writes")).cast("long")).otherwise(F.col("n")) if dies else F.col("n")
        return {left: batch, right: batch.select(gone.alias("n"))}

    def count(path):
        return sorted(r["n"] for r in commits.read_committed(spark, path, log).collect())

    commits.atomic_fan_out(numbers(spark, source, 0, 3), split, log, ckpt).awaitTermination()
    seen["first"] = (count(left), count(right))
    running = commits.atomic_fan_out(numbers(spark, source, 3, 6), lambda b: split(b, True), log, ckpt)
    with pytest.raises(Exception, match="killed between two writes"):
        running.awaitTermination()
    assert spark.read.parquet(left).count() == 6  # the first table has been written
    seen["killed"] = (count(left), count(right))
    commits.atomic_fan_out(numbers(spark, source, 6, 7), split, log, ckpt).awaitTermination()
    seen["restarted"] = (count(left), count(right))
    assert seen == {"first": ([0, 1, 2],) * 2, "killed": ([0, 1, 2],) * 2, "restarted": (list(range(7)),) * 2}


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    table, log = str(tmp_path / "t"), str(tmp_path / "log")
    commits.write_all(spark.range(5), lambda b: {table: b}, 0, "w", log)
    commits.write_all(spark.range(9), lambda b: {table: b}, 0, "w", log)  # handed over again after its commit
    assert commits.read_committed(spark, table, log).count() == 5
    commits.write_all(spark.range(2), lambda b: {table: b}, 1, "w", log)
    commits.write_all(spark.range(3), lambda b: {table: b}, 0, "other", log)
    assert commits.read_committed(spark, table, log).count() == 10
    assert sorted(r["batch_id"] for r in commits.committed(spark, log).collect()) == ["other-0", "w-0", "w-1"]


def test_no_log_counts_nothing(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t/batch_id=w-0"))
    assert commits.read_committed(spark, str(tmp_path / "t"), str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        commits.read_committed(spark, str(tmp_path / "nowhere"), str(tmp_path / "none"))


def land(spark, path, texts, first=0, key=None):
    rows = [(key, bytearray(t.encode()) if t is not None else None, "transactions", 0, first + i, TS) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, readers.ENVELOPE).write.mode("append").parquet(path)
    return readers.stream_landed(spark, path)


def test_ingest_and_triage_commit_both_tables(spark, tmp_path):
    lake, dead, log = (str(tmp_path / n) for n in ("lake", "dead", "log"))
    good = json.dumps({"transaction_id": "T", "customer_id": "C", "amount": 1, "currency": "MAD", "timestamp": "2024-01-01T00:00:00Z"})
    stream = land(spark, str(tmp_path / "in"), [good, "no json"])
    ingest.ingest(stream, TRANSACTION_STREAM, lake, str(tmp_path / "c1"), dead_letters=dead, commits=log).awaitTermination()
    assert [commits.read_committed(spark, p, log).count() for p in (lake, dead)] == [1, 1]
    retry, archive, second = (str(tmp_path / n) for n in ("retry", "archive", "second"))
    letters = land(spark, str(tmp_path / "in2"), ["broken {", '{"payload":{},"schema_path":""}']).select("value")
    dead_letters.triage_stream(letters, {}, retry, archive, str(tmp_path / "c2"), commits=second).awaitTermination()
    assert commits.read_committed(spark, archive, second).count() + commits.read_committed(spark, retry, second).count() == 2
    assert commits.committed(spark, second).count() == 1


# --- folds ----------------------------------------------------------------------------------------


def test_a_fold_reads_what_changed_and_not_the_history(spark, tmp_path):
    path = str(tmp_path / "m")

    def send(rows, name):
        bucketed_mirror.bucketed_mirror_stream(stream_of(spark, str(tmp_path / f"in_{name}"), rows, LOG), path, str(tmp_path / f"c_{name}"), ["id"], "position", buckets=16).awaitTermination()

    def state():
        return {r["id"]: r["status"] for r in bucketed_mirror.read_state(spark, path, ["id"], "position").collect()}

    def read_by_fold():
        bases, folded = bucketed_mirror._manifest(spark, path, bucketed_mirror.generation(spark, path))
        folders, touched = bucketed_mirror.pending(spark, path, folded)
        return len(bucketed_mirror._folded(spark, path, bases, folders, touched, ["id"], "position").inputFiles())

    send([(f"k{i}", i, "one", False) for i in range(200)], "a")
    assert bucketed_mirror.fold(spark, path, ["id"], "position", 16) == 16
    sizes = []
    for turn in range(4):  # the history grows, the changes do not
        send([("k1", 1000 + turn, f"t{turn}", False), (None, 1, "keyless", False)], f"b{turn}")
        sizes.append(read_by_fold())
        assert state()["k1"] == f"t{turn}" and len(state()) == 200
        assert bucketed_mirror.fold(spark, path, ["id"], "position", 16) == 1
    assert sizes == [2, 2, 2, 2]  # one file of the bucket's base and one of its change
    assert bucketed_mirror.fold(spark, path, ["id"], "position", 16) == 0
    before = state()
    assert bucketed_mirror.forget(spark, path) > 0 and state() == before
    send([("k2", 5000, None, True), ("k3", 2, "late", False)], "c")  # a delete, and a change older than the base
    want = {**before}
    del want["k2"]
    assert state() == want
    bucketed_mirror.fold(spark, path, ["id"], "position", 16)
    send([("k2", 4000, "back?", False)], "d")
    assert state() == want  # a marked delete stays in the base


def test_a_fold_that_dies_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = stream_of(spark, str(tmp_path / "in"), [("a", 1, "x", False), ("b", 2, "y", False)], LOG)
    bucketed_mirror.bucketed_mirror_stream(rows, path, str(tmp_path / "c"), ["id"], "position", buckets=4).awaitTermination()
    # What a dead fold leaves: a base without a manifest.
    spark.createDataFrame([("a", 9, "wrong", False, 0)], LOG + ", bucket int").write.partitionBy("bucket").parquet(f"{path}/base/generation=1")
    got = bucketed_mirror.read_state(spark, path, ["id"], "position")
    assert sorted(r["status"] for r in got.collect()) == ["x", "y"] and bucketed_mirror.generation(spark, path) == 0
    bucketed_mirror.fold(spark, path, ["id"], "position", 4)
    got = bucketed_mirror.read_state(spark, path, ["id"], "position")
    assert sorted(r["status"] for r in got.collect()) == ["x", "y"] and bucketed_mirror.generation(spark, path) == 1


# --- retries that wait ----------------------------------------------------------------------------

MESSAGE = "key string, ts timestamp, body string"


def failing():
    """A message fails as often as its body says; a function of its own, so that workers need not import this module."""
    return lambda body, attempt: body is None or attempt >= int(body)


def test_a_message_comes_back_when_it_is_due_also_after_a_restart(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    at = lambda s: TS + dt.timedelta(seconds=s)

    def send(rows):
        stream = stream_of(spark, source, rows, MESSAGE)
        with backoff.keyed_state(spark, 2):
            ingest.append_stream(backoff.retried(stream, failing()), out, ckpt).awaitTermination()
        base = int(TS.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        return sorted((r["key"], r["body"], r["attempt"], (r["at_ms"] - base) / 1000, r["outcome"]) for r in spark.read.parquet(out).collect())

    # The watermark reaches 0.5 s: nobody is due yet, all wait in the state.
    first = send([("a", at(0), "0"), ("a", at(0), "1"), ("a", at(0), "2"), ("b", at(0.5), "9"), ("b", None, "1")])
    assert first == [("a", "0", 0, 0.0, "processed"), ("a", "1", 0, 0.0, "retry"), ("a", "2", 0, 0.0, "retry"), ("b", "9", 0, 0.5, "retry")]
    # Another run of the same checkpoint: the watermark passes 2 s, then everything.
    second = send([("c", at(2), "0")])
    assert [r for r in second if r not in first] == [("a", "1", 1, 1.0, "processed"), ("a", "2", 1, 1.0, "retry"), ("b", "9", 1, 1.5, "retry"), ("c", "0", 0, 2.0, "processed")]
    third = send([("z", at(1000), "0")])
    assert [r for r in third if r not in second] == [("a", "2", 2, 3.0, "processed"), ("b", "9", 2, 3.5, "retry"), ("b", "9", 3, 7.5, "dlq"), ("z", "0", 0, 1000.0, "processed")]


def test_back_off_by_the_clock_with_a_time_to_live(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = stream_of(spark, source, [("a", dt.datetime.now(), "1")], MESSAGE)
    with backoff.keyed_state(spark, 1):
        running = ingest.append_stream(backoff.retried(stream, failing(), live_ms=60_000), out, str(tmp_path / "c"), interval="500 milliseconds")
    until = time.time() + 60
    try:
        while time.time() < until and running.exception() is None:
            time.sleep(1)
            if list((tmp_path / "out").glob("*.parquet")) and spark.read.parquet(out).where("outcome = 'processed'").count():
                break
    finally:
        running.stop()
    assert [(r["attempt"], r["outcome"]) for r in spark.read.parquet(out).orderBy("attempt").collect()] == [(0, "retry"), (1, "processed")]


# --- jobs that run twice --------------------------------------------------------------------------


def test_objects_of_a_second_checkpoint_stand_beside_the_first(spark, tmp_path):
    out, objects = str(tmp_path / "m"), str(tmp_path / "o")
    for run in ("one", "two"):
        stream = land(spark, str(tmp_path / f"in_{run}"), ['{"status":"x"}'], key=bytearray(run.encode()))
        for q in jobs.mirror_changes(stream, "status string", out, objects, str(tmp_path / run), ["key"]):
            q.awaitTermination()
    assert spark.read.parquet(objects).count() == 2


def test_a_run_that_is_repeated_notifies_once(spark, tmp_path):
    messages = spark.createDataFrame([("k", "v", "t")], "key string, value string, topic string")
    for run in ("r1", "r1", "r2"):
        writers.land_messages(messages, str(tmp_path / "n"), run)
    assert spark.read.json(str(tmp_path / "n")).count() == 2


def test_compaction_finds_the_layout_without_a_list_of_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20).selectExpr("id", "id % 2 AS a", "id % 3 AS b").write.partitionBy("a", "b").parquet(path)
    assert writers.partition_columns(spark, path) == ["a", "b"]
    writers.compact_table(spark, path, str(tmp_path / "c"))
    assert writers.partition_columns(spark, str(tmp_path / "c")) == ["a", "b"] and spark.read.parquet(str(tmp_path / "c")).count() == 20


def test_a_schema_path_with_quotes_stays_readable(spark, tmp_path):
    stream = land(spark, str(tmp_path / "in"), ["no json"])
    odd = 'schemas/"odd".json'
    jobs.ingest_validate_retry(stream, odd, {"type": "object", "properties": {}}, str(tmp_path / "f"), {})
    archived = spark.read.parquet(str(tmp_path / "f/archive")).first()
    assert json.loads(archived["message"])["schema_path"] == odd


class _Store:
    """Keyed state and timers of one key that count their calls."""

    def __init__(self):
        self.rows, self.timers, self.calls = {}, [], 0

    def getMapState(self, *_):  # noqa: N802 - Spark's names
        return self

    def getValue(self, key):  # noqa: N802
        self.calls += 1
        return self.rows.get(key)

    def containsKey(self, key):  # noqa: N802
        self.calls += 1
        return key in self.rows

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1
        self.rows[key] = value

    def removeKey(self, key):  # noqa: N802
        self.calls += 1
        del self.rows[key]

    def registerTimer(self, due):  # noqa: N802
        self.calls += 1
        self.timers.append(due)


def test_calls_of_the_state_store_grow_with_blocks_not_with_messages():
    class Times:
        def __init__(self, now):
            self.getCurrentWatermarkInMs = lambda: now

    class Timer:
        def __init__(self, due):
            self.getExpiryTimeInMs = lambda: due

    store, got = _Store(), []
    processor = backoff.BackOff(failing(), 3, None)
    processor.init(store)
    rows = [{"at_ms": 10 * i, "body": str(i % 6)} for i in range(2_000)] + [{"at_ms": 50, "body": str(i % 6)} for i in range(500)]
    got += processor.handleInputRows(("k",), iter(rows), Times(0))
    for now in (5_000, 12_000, 100_000):
        while due := [t for t in store.timers if t <= now]:
            store.timers.remove(min(due))
            got += processor.handleExpiredTimer(("k",), Times(now), Timer(min(due)))
    want = Counter(
        (int(r["body"]), k, r["at_ms"] + 1000 * (2**k - 1), "processed" if k >= int(r["body"]) else "dlq" if k >= 3 else "retry")
        for r in rows for k in range(min(int(r["body"]), 3) + 1)
    )
    assert Counter((int(r.body), r.attempt, r.at_ms, r.outcome) for r in got) == want
    assert not store.rows and store.calls < 400
