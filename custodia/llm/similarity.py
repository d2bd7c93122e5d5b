"""Similarity join of texts by the Jaccard measure of their word shingles, by chosen paths."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import by_group, components, fixed_bytes, forest, mix, shingles, stored, text_chunks, tidy, whole_groups, words

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.995  # of pairs exactly at the threshold
DEPTH = 3
BUCKET = 256  # sets compared with each other without further splitting
BINS = 64  # of the sketch that screens pairs of a bucket
SLACK = 0.2  # four standard deviations of the sketch's estimate
LEAF = 1024  # sets of a block of a bucket that stays larger at full depth
BLOCK = 256  # sets of a block of verification


def runs_for(recall: float, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs that reach the recall even for pairs at the threshold whose paths are split to full depth.

    A set follows 1/threshold paths on average from each node, so a pair at the threshold shares
    2 / (1 + threshold) of them (common tokens by the size of the larger set); a run misses it if its
    branching process dies out.
    """
    mean = 2 * threshold / (1 + threshold) / threshold
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(-mean * (1 - lost))
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def _limits(counts: np.ndarray, threshold: float) -> np.ndarray:
    """Hash values below this make a token chosen: 1/threshold tokens of a set on average."""
    share = np.minimum(1.0, 1.0 / (threshold * np.maximum(counts, 1)))
    return np.where(share >= 1.0, np.uint64(2**64 - 1), (share * 2.0**63).astype(np.uint64) * np.uint64(2))


def _first_paths(value, row, limit, runs):
    """(row, path) of the first level of all runs."""
    rows, paths = [], []
    for run in range(runs):
        seed = (0x9E3779B97F4A7C15 * (run + 1)) & (2**64 - 1)
        pick = mix(value, seed) <= limit[row]
        rows.append(row[pick])
        paths.append(mix(value[pick] ^ np.uint64(0xA5A5A5A5), seed ^ 0x1234567))
    return np.concatenate(rows), np.concatenate(paths)


def _next_paths(value, starts, counts, limit, rows, paths):
    """(row, parent, path): each path of a set goes on with tokens of the set chosen by the path's own hash."""
    n = counts[rows]
    total = int(n.sum())
    which = np.repeat(np.arange(len(rows)), n)
    at = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[rows], n)
    token = value[at]
    parent = paths[which]
    pick = mix(token, parent) <= limit[rows[which]]
    token, parent, which = token[pick], parent[pick], which[pick]
    return rows[which], parent, mix(token ^ np.uint64(0xA5A5A5A5), mix(parent, 99))


def _sketch(value, row, n_rows) -> np.ndarray:
    """One byte of the one-permutation minimum of each bin of hash values, 0 for an empty bin."""
    out = np.zeros((n_rows, BINS), dtype=np.uint8)
    bin_ = (value >> np.uint64(58)).astype(np.int64)
    new = np.ones(len(value), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (bin_[1:] != bin_[:-1])  # sorted by row and value
    out[row[new], bin_[new]] = (mix(value[new], 5) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    return out


def _lists(rows: np.ndarray, values: np.ndarray, n_rows: int) -> pa.Array:
    order = np.argsort(rows, kind="stable")
    offsets = np.zeros(n_rows + 1, dtype=np.int32)
    np.cumsum(np.bincount(rows, minlength=n_rows), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[order].view(np.int64)))


def _keys(value, starts, counts) -> list[bytes]:
    """16 bytes that name a set: two hashes of its sorted shingles; 16 zero bytes for the empty set."""
    place = np.arange(len(value), dtype=np.uint64) - np.repeat(starts, counts).astype(np.uint64)
    out = np.zeros((len(starts), 2), dtype=np.uint64)
    full = np.flatnonzero(counts)
    for k, seed in enumerate((0x6A09E667F3BCC909, 0xBB67AE8584CAA73B)):
        if len(full):
            out[full, k] = mix(np.add.reduceat(mix(value + place * np.uint64(0x9E3779B97F4A7C15), seed), starts[full]) + counts[full].astype(np.uint64), seed)
    return [r.tobytes() for r in out]


def _sets(data, offsets, size):
    h, row, n = words(data, offsets)
    value, row = shingles(h, row, n, size)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    return value, row, np.cumsum(counts) - counts, counts


def profiles(docs: DataFrame, id_col: str, text_col: str, runs: int, threshold: float, size: int) -> DataFrame:
    """Per row: serial, id, text hash, name and size of its shingle set, sketch, and its paths to full depth."""

    def run(batches):
        serial = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1)):
                n_rows = end - first
                value, row, starts, counts = _sets(data, offsets, size)
                limit = _limits(counts, threshold)
                rows, paths = _first_paths(value, row, limit, runs)
                arrays = [_lists(rows, paths, n_rows)]
                for _ in range(DEPTH - 1):
                    rows, parents, paths = _next_paths(value, starts, counts, limit, rows, paths)
                    arrays += [_lists(rows, parents, n_rows), _lists(rows, paths, n_rows)]
                part = batch.slice(first, n_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(serial, serial + n_rows)), part.column(0), part.column(2), pa.array(_keys(value, starts, counts), pa.binary()),
                     pa.array(counts, pa.int64()), pa.array([s.tobytes() for s in _sketch(value, row, n_rows)], pa.binary()), *arrays],
                    names=["serial", "id", "text_hash", "key", "size", "sketch", *names],
                )
                serial += n_rows

    names = ["path1"] + [f"{x}{d}" for d in range(2, DEPTH + 1) for x in ("parent", "path")]
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    schema = f"serial long, id {kind}, text_hash long, key binary, size long, sketch binary, " + ", ".join(f"{n} array<long>" for n in names)
    return rows.select("id", "text", "text_hash").mapInArrow(tidy(run), schema)


def _close(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the buckets of a table sorted by bucket whose sketches look similar."""
    bucket = table["bucket"].to_numpy()
    node = table["serial"].to_numpy()
    sketch = fixed_bytes(table["sketch"], BINS, "u1")
    left, right = [], []
    at = np.arange(len(bucket))
    step = 1
    while True:
        at = at[at + step < len(bucket)]
        at = at[bucket[at] == bucket[at + step]]
        if not len(at):
            break
        for i in range(0, len(at), 20_000):
            a = at[i : i + 20_000]
            x, y = sketch[a], sketch[a + step]
            both = ((x == y) & (x != 0)).sum(axis=1)
            any_ = ((x != 0) | (y != 0)).sum(axis=1)
            close = both >= (threshold - SLACK) * any_
            left.append(node[a[close]])
            right.append(node[a[close] + step])
        step += 1
    return np.concatenate(left or [node[:0]]), np.concatenate(right or [node[:0]])


def _screen(buckets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that connect the sets of each bucket which look similar; a bucket is bounded by BUCKET or two LEAFs."""

    def run(batches):
        for table in whole_groups(batches, "bucket"):
            a, b = _close(table, threshold)
            if len(a):
                node, root = forest(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["a", "b"])

    return buckets.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(run), "a long, b long")


def candidates(reps: DataFrame, threshold: float) -> DataFrame:
    """Links between sets that meet in a bucket of some run and look similar there."""
    found = []
    level = reps.select("serial", F.explode("path1").alias("bucket"))
    for depth in range(1, DEPTH + 1):
        sizes = stored(level.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
        found.append(level.join(sizes.where(F.col("n") <= BUCKET).hint("merge"), "bucket").select("serial", "bucket"))
        large = sizes.where(F.col("n") > BUCKET)
        if depth == DEPTH:
            # Buckets that full depth leaves large: all pairs of blocks of them, an exact way for the rest.
            blocks = F.ceil(F.col("n") / LEAF).cast("long")
            split = level.join(large, "bucket").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("serial"), "blocks"))
            pairs = split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            found.append(pairs.select("serial", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket")))
            break
        zipped = reps.select("serial", F.explode(F.arrays_zip(f"parent{depth + 1}", f"path{depth + 1}")).alias("z"))
        deeper = zipped.select("serial", F.col(f"z.parent{depth + 1}").alias("parent"), F.col(f"z.path{depth + 1}").alias("bucket"))
        level = stored(deeper.join(large.select(F.col("bucket").alias("parent")), "parent", "left_semi").select("serial", "bucket"))
    buckets = found[0]
    for more in found[1:]:
        buckets = buckets.union(more)
    # One join brings the sketches to the buckets of all levels, by the same plan at every size.
    return _screen(buckets.join(reps.select("serial", "sketch").hint("merge"), "serial"), threshold)


def _verify(group: pd.DataFrame, threshold: float) -> pd.DataFrame | None:
    """Links of the sets of a block, or between two blocks, with their exact similarity."""
    group = group.drop_duplicates("serial")
    node, weight, side = group["serial"].to_numpy(), group["weight"].to_numpy(), group["block"].to_numpy()
    sets = [np.frombuffer(s, dtype="<u8") for s in group["shingles"]]
    m = len(sets)
    if m < 2:
        return None
    sizes = np.array([len(s) for s in sets], dtype=np.float32)
    common = np.zeros((m, m), dtype=np.float32)
    if m <= 4:
        for i in range(m):
            for j in range(i):
                common[i, j] = common[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        token, row = np.concatenate(sets), np.repeat(np.arange(m), sizes.astype(np.int64))
        order = np.argsort(token, kind="stable")
        token, row = token[order], row[order]
        new = np.ones(len(token), dtype=bool)
        new[1:] = token[1:] != token[:-1]
        index = np.cumsum(new) - 1
        shared = np.bincount(index)[index] > 1
        index, row = index[shared], row[shared]
        if len(index):
            _, index = np.unique(index, return_inverse=True)
            width = 4096
            for start in range(0, int(index[-1]) + 1, width):  # in order of token
                a, b = np.searchsorted(index, [start, start + width])
                has = np.zeros((m, width), dtype=np.float32)
                has[row[a:b], index[a:b] - start] = 1
                common += has @ has.T
    similar = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-6
    np.fill_diagonal(similar, False)
    if group["cross"].iloc[0]:
        similar &= side[:, None] != side[None, :]
    a, b = np.nonzero(similar)
    if not len(a):
        return None
    root = pd.Series(node.copy(), index=node)
    moved, to = forest(node[a], node[b])
    root[moved] = to
    links = (similar * weight[None, :]).sum(axis=1)
    linked = links > 0
    return pd.DataFrame({"node": node[linked], "links": links[linked].astype(np.int64), "root": root.to_numpy()[linked]})


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    recall: float = RECALL, size: int = SHINGLE,
) -> DataFrame:
    """One row per document: id, n_shingles, n_links, component_id, kept.

    Texts are sets of shingles of ``size`` words (lower case A-Z, split at ASCII white space; a shorter
    text is one shingle). ``n_links`` counts other documents of similarity ``threshold`` or more, equal
    sets included; ``component_id`` is the smallest id reachable by links, and the document of that id is
    ``kept``. Equal sets are joined as one. A text without words, or null, links with nothing and is kept.
    Rows with a null id count as documents; a component without any id has a null ``component_id`` and keeps
    its rows. Rows that repeat an id are documents of their own with the same ``kept``.
    """
    profile = stored(profiles(docs, id_col, text_col, runs_for(recall, threshold), threshold, size))
    full = profile.where("size > 0")
    classes = stored(full.groupBy("key").agg(F.min("serial").alias("rep"), F.count("*").alias("weight")))
    # Written once, as every level reads other columns of it; joined by the same plan at every size.
    reps = stored(full.join(classes.select(F.col("rep").alias("serial")).hint("merge"), "serial", "left_semi"))
    looks = components(stored(candidates(reps, threshold)))
    # Sets that look connected are verified together, in blocks, with their exact shingles.
    group = stored(looks.union(looks.select("component", "component").distinct()))
    sizes = group.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    members = group.join(sizes, "component").join(
        reps.select(F.col("serial").alias("node"), "key", "text_hash"), "node"
    )
    members = stored(members.join(classes.select("key", "weight"), "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")))

    def shingle_sets(batches):
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                value, _, starts, counts = _sets(data, offsets, size)
                parts = [value[s : s + c].astype("<u8").tobytes() for s, c in zip(starts, counts)]
                yield pa.RecordBatch.from_arrays([pa.array(_keys(value, starts, counts), pa.binary()), pa.array(parts, pa.binary())], names=["key", "shingles"])

    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    # The same plan at every size: a side that is small today grows with the copies.
    texts = texts.join(members.select("text_hash").distinct().hint("merge"), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    sets = texts.select("text").mapInArrow(tidy(shingle_sets), "key binary, shingles binary")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = members.hint("merge").join(sets, "key").withColumn("other", other)
    pairs = pairs.select(
        F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")).alias("pair"),
        F.col("node").alias("serial"), "weight", "block", (F.col("block") != F.col("other")).alias("cross"), "shingles",
    )
    # In a group of two blocks both have rows with the other as partner, in a group of one only itself.
    verified = stored(by_group(pairs, ["pair"], lambda g: _verify(g, threshold), "node long, links long, root long"))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.join(links, F.col("rep") == F.col("node"), "left").drop("node")
        .join(reached, F.col("rep") == F.col("node"), "left")
        .select("key", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component"))
    )
    rows = profile.select("id", "size", F.when(F.col("size") > 0, F.col("key")).alias("key")).join(per_class, "key", "left")
    rows = stored(rows.select("id", "size", "weight", "links", "component"))
    lowest = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("lowest"))
    out = rows.join(lowest, "component", "left")
    component_id = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("lowest"))
    return out.select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
        F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).alias("n_links"), component_id.alias("component_id"),
        F.coalesce(F.col("id") == component_id, F.lit(True) & component_id.isNull()).alias("kept"),
    )
