"""Helpers shared by the text operators: stored tables, batches, hashing and components.

All operators read only the columns they name, so extra columns of the input never clash with theirs.
"""

from __future__ import annotations

import ctypes
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import custodia
from custodia.session import prepare, shared_dir

# Texts are long: batches for Python workers are bounded by bytes, not by rows alone.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
CHUNK_BYTES = 1 << 20  # text handled at once inside a task
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, wherever they run; once per application."""
    context = prepare(spark).sparkContext
    spark.conf.set(*BATCH_BYTES)
    if not getattr(context, "_custodia_shipped", False):
        blob = io.BytesIO()
        with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as archive:
            root = Path(custodia.__file__).parent
            for file in sorted(root.rglob("*")):
                if file.is_file() and file.suffix != ".pyc":
                    archive.write(file, f"custodia/{file.relative_to(root)}")
        target = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}/custodia.zip")
        stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
        stream.write(blob.getvalue())
        stream.close()
        context.addPyFile(target.toString())
        context._custodia_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(frame: DataFrame, path: str | None = None) -> DataFrame:
    """The frame written as Parquet in the shared folder and read again: cuts lineage, survives executors."""
    spark = frame.sparkSession
    path = path or _new_path(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"


@contextmanager
def passing(frame: DataFrame) -> Iterator[DataFrame]:
    """The frame as ``stored`` keeps it, removed when all that is read of it has been."""
    context, path = frame.sparkSession.sparkContext, _new_path(frame.sparkSession)
    yield stored(frame, path)
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def tidy(run: Callable) -> Callable:
    """A function over batches that gives freed memory back at the end of its task.

    Python workers live on for later tasks; what they keep would count against those.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def text_chunks(array: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about ``limit`` bytes; null is empty."""
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    rows = len(array)
    if not rows:
        return
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + rows + 1]
    whole = array.buffers()[2]
    data = np.frombuffer(whole, dtype=np.uint8) if whole is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


class _Powers:
    """Powers of the hash base and of its inverse, modulo 2**64, as far as needed."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 2 * CHUNK_BYTES)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up, cls.down


def mix(x: np.ndarray, seed: int | np.ndarray = 0) -> np.ndarray:
    """A 64-bit finaliser: near inputs give unrelated outputs."""
    x = x ^ np.uint64(seed) if isinstance(seed, int) else x ^ seed
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(C, D): the hash of data[a:b] is (C[b] - C[a]) * D[a]."""
    up, down = _Powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, number of rows' words) of all words; a word is a run of bytes other than ASCII white space."""
    data = _LOWER[data] if fold else data
    inside = ~_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends[last] = inside[last]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums, down = prefix_hashes(data)
    hashes = mix((sums[b] - sums[a]) * down[a], 0x5851F42D4C957F2D)
    rows = np.searchsorted(offsets, a, side="right") - 1
    return hashes, rows, np.bincount(rows, minlength=len(offsets) - 1)


def shingles(hashes: np.ndarray, rows: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words, sorted by (row, hash); a shorter text is one shingle of all its words."""
    n = len(hashes)
    if not n:
        return hashes, rows
    ends = np.cumsum(counts)
    starts = ends - counts
    place = np.arange(n) - starts[rows]
    value = np.zeros(n, dtype=np.uint64)
    room = counts[rows] - place
    for k in range(size):
        term = np.zeros(n, dtype=np.uint64)
        term[: n - k] = hashes[k:]
        term[room <= k] = 0
        value = value * np.uint64(_BASE) + term
    keep = (room >= size) | ((place == 0) & (counts[rows] < size))
    value, rows = mix(value[keep], 0x2545F4914F6CDD1D), rows[keep]
    order = np.lexsort((value, rows))
    value, rows = value[order], rows[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    return value[new], rows[new]


def sorted_groups(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of a stream of frames in which rows of a key are next to each other."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        codes = batch[key].ne(batch[key].shift()).any(axis=1).to_numpy()
        cuts = np.flatnonzero(codes)
        if held and tuple(held[-1][key].iloc[-1]) == tuple(batch[key].iloc[0]):
            cuts = cuts[1:]
        elif held:
            yield pd.concat(held) if len(held) > 1 else held[0]
            held, cuts = [], cuts[1:]
        else:
            cuts = cuts[1:]
        at = 0
        for cut in cuts:
            part = batch.iloc[at:cut]
            if held:
                yield pd.concat([*held, part])
                held = []
            else:
                yield part
            at = cut
        held.append(batch.iloc[at:])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def by_group(frame: DataFrame, key: list[str], build: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """``build`` over each group of ``key``; the groups are bounded by whoever made the key.

    One Python call handles many groups, where ``applyInPandas`` starts anew for each.
    """

    def run(batches):
        for group in sorted_groups(batches, key):
            made = build(group)
            if made is not None and len(made):
                yield made

    return frame.repartition(*key).sortWithinPartitions(*key).mapInPandas(tidy(run), schema)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) for the nodes of the links, without the nodes that are it themselves."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of the nodes of the links ``a``, ``b`` (long); the component is its smallest node.

    Alternates large-star and small-star steps; each is an aggregate and a join, so a hub of many
    links is reduced before the shuffle and split by the skew join.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        step = small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))
        )
        edges = stored(step.where("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups, about ``rows`` rows each, of a stream in which rows of a key are next to each other."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        values = table[key].chunk(0)
        same = pc.equal(values, values[-1]).to_numpy(zero_copy_only=False)
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
        held, size = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def fixed_bytes(column: pa.ChunkedArray, width: int, dtype: str) -> np.ndarray:
    """A binary column whose values all have ``width`` bytes, as a matrix."""
    array = column.combine_chunks().cast(pa.large_binary())
    if isinstance(array, pa.ChunkedArray):
        array = array.chunk(0) if array.num_chunks else pa.array([], pa.large_binary())
    if not len(array):
        return np.zeros((0, width // np.dtype(dtype).itemsize), dtype=dtype)
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(array.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].view(dtype).reshape(len(array), -1)


def pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers of several arrays, compressed; of each the bytes that its largest has, first bytes first."""
    head, planes = [len(arrays)], []
    for x in arrays:
        wide = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        head += [len(x), wide]
        planes.append(np.ascontiguousarray(x, dtype="<u8").view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array(head, dtype="<u4").tobytes() + b"".join(planes))


def unpack(blob: bytes) -> list[np.ndarray]:
    """The arrays that ``pack`` packed, each of the smallest unsigned type that holds it."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    many = int(np.frombuffer(data, "<u4", 1)[0])
    at, arrays = 4 + 8 * many, []
    for n, wide in np.frombuffer(data, "<u4", 2 * many, 4).reshape(-1, 2).tolist():
        x = np.zeros((n, next(k for k in (1, 2, 4, 8) if k >= wide)), dtype=np.uint8)
        x[:, :wide] = np.frombuffer(data, np.uint8, n * wide, at).reshape(wide, n).T
        arrays.append(x.view(f"<u{x.shape[1]}").ravel())
        at += n * wide
    return arrays


def steps(keys: np.ndarray) -> np.ndarray:
    """Ascending numbers as what each is above the one before; ``np.cumsum`` of them gives the numbers."""
    return np.diff(keys, prepend=keys.dtype.type(0))
