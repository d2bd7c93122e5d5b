"""Compaction by file: packing, files left alone, a second run, runs that broke off."""

import random
from collections import Counter
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from custodia.sources import compaction


def write(spark, path, files=12, rows=400):
    frame = spark.range(0, rows, 1, files).withColumns({"text": F.sha2(F.col("id").cast("string"), 256), "kind": F.concat(F.lit("k "), F.col("id") % 3)})
    frame.write.partitionBy("kind").parquet(path)
    return sorted(map(tuple, frame.select("id", "text", "kind").collect()))


def read(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("id", "text", "kind").collect()))


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if compaction.JOURNAL not in p.parts}


def test_first_fit_leaves_no_two_groups_that_go_together():
    rng = random.Random(2)
    for _ in range(200):
        sizes = np.array([rng.randint(0, 60) for _ in range(rng.randint(1, 40))] + [rng.choice([1, 150])])
        groups = compaction.first_fit(sizes, 100)
        sums = Counter()
        for group, size in zip(groups.tolist(), sizes.tolist()):
            sums[group] += size
        assert all(s <= 100 or (groups == g).sum() == 1 for g, s in sums.items())
        low = sorted(sums.values())[:2]
        assert len(low) < 2 or sum(low) > 100


def test_plan_is_by_folder_and_leaves_full_files(spark):
    rows = [("a", f"a/{i}", 30) for i in range(5)] + [("b", "b/0", 10), ("b", "b/1", 50), ("c", "c/0", 200)]
    frame = spark.createDataFrame(rows, "folder string, path string, bytes long")
    for block in (10_000, 2):
        plan = compaction.compaction_plan(frame, 100, block).collect()
        assert {r["folder"] for r in plan} <= {"a"} and all(r["bin_bytes"] <= 100 and r["bin_files"] > 1 for r in plan)
    assert compaction.compaction_plan(frame, 100).count() == 5
    assert compaction.compaction_plan(frame.where("false"), 100).count() == 0


def test_compaction_keeps_rows_and_comes_to_rest(spark, tmp_path):
    path = str(tmp_path / "table")
    want = write(spark, path)
    before = files(path)
    biggest = max(p.stat().st_size for p in before)
    assert compaction.compact_small_files(spark, path, biggest * 4) == len(before)
    after = files(path)
    assert read(spark, path) == want and len(after) < len(before) / 2 and not set(after) & set(before)
    for _ in range(4):
        if not compaction.compact_small_files(spark, path, biggest * 4):
            break
    rest = files(path)
    assert compaction.compact_small_files(spark, path, biggest * 4) == 0
    assert files(path) == rest and read(spark, path) == want
    # New small files are packed; full ones are left as they are.
    spark.range(1000, 1040, 1, 4).withColumns({"text": F.lit("x"), "kind": F.lit("k 1")}).write.mode("append").partitionBy("kind").parquet(path)
    compaction.compact_small_files(spark, path, biggest * 4)
    now = files(path)
    others = {p for p in rest if p.parent.name != "kind=k 1"}
    assert others and others <= set(now) and all(now[p] == rest[p] for p in others)
    assert len(read(spark, path)) == len(want) + 40


@pytest.mark.parametrize("at", ["before data", "after deletes"])
def test_a_broken_run_is_ended_by_the_next(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "table")
    want = write(spark, path)
    size = max(p.stat().st_size for p in files(path)) * 4
    if at == "before data":
        spark.createDataFrame([], compaction.PLAN).write.parquet(f"{path}/{compaction.JOURNAL}/lost/plan")
    else:
        real = compaction.finish
        calls = []
        monkeypatch.setattr(compaction, "finish", lambda *a: calls.append(a) or (real(*a) if len(calls) == 1 else None))
        compaction.compact_small_files(spark, path, size)
        monkeypatch.undo()
        plan = next(Path(path).glob(f"{compaction.JOURNAL}/*/plan"))
        gone = spark.read.parquet(str(plan)).limit(5).collect()
        for row in gone:
            Path(unquote(urlparse(row["path"]).path)).unlink()
    compaction.finish(spark, path)
    assert read(spark, path) == want and not list(Path(path).glob(f"{compaction.JOURNAL}/*"))
