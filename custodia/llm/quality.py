"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions.statistics import exact_quantiles
from custodia.llm.common import by_group, mix, pack, passing, steps, stored, text_chunks, tidy, unpack, whole_groups, words

# Every trusted text is counted whole, and every n-gram of it is part of the model.
SMALL_BYTES = 8 << 20  # trusted text whose model every task holds; the n-grams of more are kept in shards and looked up there
SHARD_BYTES = 4 << 20  # trusted text whose n-grams make a shard
SLICE_BYTES = 16 << 20  # text that looks its n-grams up together, if that makes no more than SLICES
SLICES = 8  # parts of all texts that do so one after another, so that shuffle files of one are gone before the next
MERGES = 4  # parts of all shards that are made one after another
BLOB_KEYS = 1 << 17  # n-grams of one row of a shard
BUCKET_BYTES = 8 << 20  # text whose n-grams are counted together
STRETCH = 500_000  # tokens whose different trigrams a task sends together
FIT_IDS = 4_000_000  # ids of training documents that are sent to all tasks; more are joined
UPPER = 0.995  # quantile of trusted documents of a language above which perplexity is too high
SPREAD = 2.0  # times the largest perplexity of a group too small to show its quantile
FEW = 10_000  # languages whose thresholds are sent to all tasks; those of more are joined
_BEGIN = np.uint64(0x243F6A8885A308D3)
_END = np.uint64(0x13198A2E03707344)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SIX = np.uint64((1 << 48) - 1)  # words are known by six bytes


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token of all rows, each followed by one end: word, last, the one before, row."""
    h, _, counts = words(data, offsets, fold=False)
    return _laid(h, counts)


def _laid(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``_tokens``, of the words of all rows and their number in each."""
    rows = len(counts)
    # Layout of a row: begin begin w1 .. wn end.
    width = counts + 3
    stops = np.cumsum(width)
    seq = np.zeros(int(stops[-1]), dtype=np.uint64)
    starts = stops - width
    seq[starts] = seq[starts + 1] = _BEGIN
    seq[stops - 1] = _END
    body = np.ones(len(seq), dtype=bool)
    body[starts] = body[starts + 1] = body[stops - 1] = False
    seq[body] = h
    seq &= _SIX
    token = np.ones(len(seq), dtype=bool)
    token[starts] = token[starts + 1] = False
    at = np.flatnonzero(token)
    return seq[at], seq[at - 1], seq[at - 2], np.repeat(np.arange(rows), counts + 1)


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * _STEP + w, 2)


def _triple(uv: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(uv * _STEP + w, 3)


def _ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per token of all rows, each followed by one end: word, (last, word), (two last, word), the two contexts, row."""
    w, v, u, row = _tokens(data, offsets)
    uv = _pair(u, v)
    return w, _pair(v, w), _triple(uv, w), v, uv, row


def _packed(grams: np.ndarray, n: np.ndarray) -> bytes:
    """Trigrams (rows of three words) and their counts, compressed: each word once, then its places."""
    known, at = np.unique(grams, return_inverse=True)
    return pack(steps(known), *at.reshape(grams.shape), n)


def _unpacked(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(rows of three words, counts) of all blobs."""
    grams, counts = [], []
    for blob in blobs:
        steps, *at, n = unpack(blob)
        known = np.cumsum(steps, dtype=np.uint64)
        grams.append(np.stack([known[x] for x in at]))
        counts.append(n.astype(np.int64))
    return np.concatenate(grams, axis=1), np.concatenate(counts)


class Lookup:
    """64-bit keys to floats: open addressing, so that a batch of keys is found in a few vectorised steps."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(4 * max(1, len(keys))).bit_length() - 1)
        self.mask = np.uint64(size - 1)
        self.keys, self.values = np.zeros(size, dtype=np.uint64), np.full(size, np.nan, dtype=np.float32)
        used = np.zeros(size, dtype=bool)
        left, step = np.arange(len(keys)), 0
        while len(left):
            slot = ((keys[left] + np.uint64(step)) & self.mask).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            first = first[~used[slot[first]]]
            self.keys[slot[first]], self.values[slot[first]] = keys[left[first]], values[left[first]]
            used[slot[first]] = True
            keep = np.ones(len(left), dtype=bool)
            keep[first] = False
            left, step = left[keep], step + 1
        self.steps = step

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, NaN where absent."""
        slot = (keys & self.mask).astype(np.int64)
        out = np.where(self.keys[slot] == keys, self.values[slot], np.float32(np.nan))
        left = np.flatnonzero((self.keys[slot] != keys) & ~np.isnan(self.values[slot]))
        for step in range(1, self.steps):
            if not len(left):
                break
            slot = ((keys[left] + np.uint64(step)) & self.mask).astype(np.int64)
            hit = self.keys[slot] == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            left = left[~hit & ~np.isnan(self.values[slot])]
        return out


_NOTHING = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.float32))


@dataclass
class Model:
    """log10 probabilities of known n-grams, log10 weights of known contexts, log10 probability of an unknown word."""

    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    weights: dict[int, tuple[np.ndarray, np.ndarray]]
    unknown: float

    def scorer(self):
        p = {n: Lookup(*t) for n, t in self.grams.items()}
        g = {n: Lookup(*t) for n, t in self.weights.items()}

        def score(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """(tokens with the end, log10 probability) per row."""
            w, vw, uvw, v, uv, row = _ngrams(data, offsets)
            out = p[3].get(uvw)
            miss = np.flatnonzero(np.isnan(out))
            two = p[2].get(vw[miss])
            rest = np.isnan(two)
            one = p[1].get(w[miss[rest]])
            one[np.isnan(one)] = self.unknown
            two[rest] = one + np.nan_to_num(g[2].get(v[miss[rest]]))
            out[miss] = two + np.nan_to_num(g[3].get(uv[miss]))
            rows = len(offsets) - 1
            return np.bincount(row, minlength=rows), np.bincount(row, weights=out.astype(np.float64), minlength=rows)

        return score


def _lang(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _trigrams(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, grams): the different trigrams of each stretch of text, packed by the bucket of their last two words."""

    def emit(held):
        grams = np.concatenate(held, axis=1)
        v, w, u = grams
        _, first, n = np.unique(_triple(_pair(u, v), w), return_index=True, return_counts=True)
        grams = grams[:, first]
        v, w, u = grams
        bucket = (_pair(v, w) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((w, v, bucket))
        grams, n, bucket = grams[:, order], n[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        blobs = [_packed(grams[:, i:j], n[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]]), pa.array(blobs, pa.binary())], names=["bucket", "grams"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                w, v, u, _ = _tokens(data, offsets)
                held.append(np.stack([v, w, u]))
                size += len(w)
                if size >= STRETCH:
                    yield emit(held)
                    held, size = [], 0
        if size:
            yield emit(held)

    return texts.select("text").mapInArrow(tidy(run), "bucket long, grams binary")


@dataclass
class _Bucket:
    """The different trigrams of a bucket in order of their last two words, and its different bigrams."""

    g3: np.ndarray  # of each trigram: itself, its context, its last two words, occurrences
    uv: np.ndarray
    g2: np.ndarray
    n: np.ndarray
    two: np.ndarray  # of each bigram: its first trigram, words, different words before it, occurrences
    v2: np.ndarray
    w2: np.ndarray
    before: np.ndarray
    often: np.ndarray

    @classmethod
    def of(cls, blobs: list[bytes]) -> _Bucket:
        (v, w, u), n = _unpacked(blobs)
        uv = _pair(u, v)
        g2, g3 = _pair(v, w), _triple(uv, w)
        order = np.lexsort((g3, g2))
        g2, g3 = g2[order], g3[order]
        at = np.flatnonzero((g3 != np.roll(g3, 1)) | (np.arange(len(g3)) == 0))  # different trigrams
        n, g2, g3, order = np.add.reduceat(n[order], at), g2[at], g3[at], order[at]
        two = np.flatnonzero((g2 != np.roll(g2, 1)) | (np.arange(len(g2)) == 0))  # different bigrams
        before, often = np.diff(two, append=len(g2)), np.add.reduceat(n, two)
        return cls(g3, uv[order], g2, n, two, v[order[two]], w[order[two]], before, often)


def counts(texts: DataFrame, buckets: int, least: int) -> DataFrame:
    """Counts of all n-grams of the column ``text``: rows (kind, a, b, c, n, m), one table by ``kind``.

    3: trigram a of context b and bigram c, occurrences n. 2: bigram a of the words b, c, different words before it n,
    occurrences m. Both only from ``least`` occurrences on. 1: word a, different words before it n and different pairs
    around it m, to be summed. 0: n n-grams of order a have the count b, for b up to 4, to be summed.
    Tasks send the different trigrams of a stretch of text, packed by the bucket of their last two words, so a
    bucket has everything about its bigrams and a frequent text weighs once a stretch. What a kind has no use for is 0.
    """

    def build(group: pd.DataFrame) -> pd.DataFrame:
        b = _Bucket.of(group["grams"].tolist())
        words, at = np.unique(np.concatenate([b.v2, b.w2]), return_inverse=True)
        some, many = b.n >= least, b.often >= least
        ends = np.bincount(at[len(b.v2) :], minlength=len(words))
        around = np.bincount(at[: len(b.v2)], weights=b.before, minlength=len(words)).astype(np.int64)
        sizes = [(order, k, int((x == k).sum())) for order, x in ((3, b.n), (2, b.before)) for k in (1, 2, 3, 4)]
        o, k, size = (np.array(x, dtype=np.int64) for x in zip(*sizes))
        parts = [
            (3, b.g3[some], b.uv[some], b.g2[some], b.n[some], np.zeros_like(b.n[some])),
            (2, b.g2[b.two][many], b.v2[many], b.w2[many], b.before[many], b.often[many]),
            (1, words, np.zeros_like(words), np.zeros_like(words), ends, around),
            (0, o, k, k, size, size),
        ]
        kind = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]).astype(np.int32)
        columns = [np.concatenate([p[i].astype(np.int64, copy=False).view(np.int64) for p in parts]) for i in range(1, 6)]
        return pd.DataFrame(dict(zip(("kind", "a", "b", "c", "n", "m"), (kind, *columns))))

    return by_group(_trigrams(texts, buckets), ["bucket"], build, "kind int, a long, b long, c long, n long, m long")


def _most(table: DataFrame, most: int) -> Column:
    """Whether a row's ``n`` is among the highest, so many that no more than ``most`` rows have it."""
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.02))).cast("int")
    least = None
    reached = 0
    for r in sorted(table.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect(), key=lambda r: -r["step"]):
        reached += r["rows"]
        if reached > most:
            break
        least = r["step"]
    return F.lit(False) if least is None else step >= least


def _discounts(sizes: dict[int, int]) -> list[float]:
    y = sizes.get(1, 0) / (sizes.get(1, 0) + 2 * sizes.get(2, 0)) if sizes.get(1) else 0.0
    return [0.0] + [min(k, max(0.0, k - (k + 1) * y * sizes.get(k + 1, 0) / sizes[k])) if sizes.get(k) else 0.5 * k for k in (1, 2, 3)]


def fit(texts: DataFrame, most: int | None = None) -> Model | Shards:
    """Modified Kneser-Ney of order 3 from every text of the column ``text``; all counts are sharded by their n-gram.

    Discounts come from the counts of counts of each order; lower orders count the different words
    before an n-gram. Every n-gram is kept: those of up to ``SMALL_BYTES`` of text in a model that tasks hold, those of
    more in shards. Only a caller that gives ``most`` gets a pruned model: of each order the ``most`` frequent n-grams and all that
    longer ones need; a context leaves to the order below what its kept n-grams do not take. No text gives a model in which every word is unknown.
    """
    size = texts.agg(F.count("*").alias("texts"), F.sum(F.octet_length("text")).alias("bytes")).first()
    buckets = -(-(size["bytes"] or 0) // BUCKET_BYTES) or 1
    if most is None and (size["bytes"] or 0) > SMALL_BYTES:
        return sharded(texts, buckets, -(-size["bytes"] // SHARD_BYTES))
    # A token takes some bytes: n-grams that are seen once in large texts would never be among the most.
    least = 1 if most is None or (size["bytes"] or 0) <= 8 * most else 2
    counted = stored(counts(texts, buckets, least))
    three = counted.where("kind = 3").selectExpr("a AS g", "b AS c", "c AS low", "n")
    two = counted.where("kind = 2").selectExpr("a AS g", "b AS c", "c AS low", "n", "m")
    one = stored(counted.where("kind = 1").groupBy(F.col("a").alias("g")).agg(F.sum("n").alias("n"), F.sum("m").alias("m")))
    sizes: dict[int, dict[int, int]] = {1: {}, 2: {}, 3: {}}
    for r in counted.where("kind = 0").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        sizes[r["a"]][r["b"]] = r["n"]
    for r in one.where("n BETWEEN 1 AND 4").groupBy("n").agg(F.count("*").alias("words")).collect():
        sizes[1][r["n"]] = r["words"]
    whole = one.agg(F.count_if(F.col("n") > 0).alias("words"), F.sum("n").alias("n")).first()
    words, pairs = whole["words"], whole["n"] or 0
    if not words:
        return Model({k: _NOTHING for k in (1, 2, 3)}, {k: _NOTHING for k in (2, 3)}, -np.log10(1.0))

    def needed(table: DataFrame, above: DataFrame) -> DataFrame:
        if most is None:
            return stored(table)
        marked = table.join(above.select(F.col("low").alias("g")).distinct().withColumn("asked", F.lit(True)), "g", "left")
        return stored(marked.where(F.coalesce("asked", F.lit(False)) | _most(table, most)).drop("asked"))

    kept = {3: stored(three if most is None else three.where(_most(three, most)))}
    kept[2] = needed(two, kept[3])
    kept[1] = needed(one.where("n > 0"), kept[2])
    begins = np.array([_BEGIN & _SIX])
    begin = texts.sparkSession.range(1).select(F.lit(int(_pair(begins, begins).view(np.int64)[0])).alias("c"), F.lit(size["texts"]).cast("long").alias("total"))
    totals = {
        3: two.select(F.col("g").alias("c"), F.col("m").alias("total")).unionByName(begin),
        2: one.select(F.col("g").alias("c"), F.col("m").alias("total")),
    }
    grams, weights = {}, {}
    below = None  # (low, p_low) of the order below
    for order in (1, 2, 3):
        d = _discounts(sizes[order])
        own = F.col("n") - F.when(F.col("n") == 1, d[1]).when(F.col("n") == 2, d[2]).otherwise(d[3])
        if order == 1:
            spare = 1.0 - (kept[1].agg(F.sum(own).alias("own")).first()["own"] or 0.0) / pairs
            unknown = float(np.log10(max(spare, 1e-300) / (words + 1)))
            joined, p = kept[1], own / pairs + spare / (words + 1)
        else:
            taken = kept[order].groupBy("c").agg(F.sum(own).alias("taken"))
            context = stored(taken.join(totals[order], "c").select("c", "total", (1 - F.col("taken") / F.col("total")).alias("spare")))
            joined, p = kept[order].join(context, "c").join(below, "low"), own / F.col("total") + F.col("spare") * F.col("p_low")
            got = context.select("c", F.log10(F.greatest("spare", F.lit(1e-30))).cast("float").alias("w")).toArrow()
            weights[order] = (got["c"].to_numpy().view(np.uint64), got["w"].to_numpy())
        made = stored(joined.select("g", p.alias("p")))
        below = made.select(F.col("g").alias("low"), F.col("p").alias("p_low"))
        got = made.select("g", F.log10("p").cast("float").alias("p")).toArrow()
        grams[order] = (got["g"].to_numpy().view(np.uint64), got["p"].to_numpy())
    return Model(grams, weights, unknown)


@contextmanager
def _released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside go when their query ends and not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _short_key(x: np.ndarray) -> np.ndarray:
    """An n-gram of any order in 56 bits: as often mistaken as words of 48 bits at 256 times as many n-grams."""
    return x >> np.uint64(8)


def _word_key(w: np.ndarray) -> np.ndarray:
    return _short_key(mix(w, 1))


def _shard_cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where ascending keys are cut into those of each shard: equal ranges of hashes."""
    bounds = np.array([-(-(i << 56) // shards) for i in range(1, shards)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


def _summed(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ascending different keys, and the sums of each column over the rows of a key."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    if not len(first):
        return keys, columns
    return keys[first], [np.add.reduceat(c[order], first, dtype=np.int64) for c in columns]


@dataclass
class Shards:
    """A whole model by n-gram: per shard rows of n-grams with what was counted of them.

    An n-gram has its count (trigrams: occurrences; others: different words before it), and as a context the sum of
    the counts of what follows it, and how many of these counts are 1, 2, and 3 or more. From those of a token's
    n-grams follow all probabilities, so no table of probabilities is made.
    """

    table: DataFrame | None  # shard int, blob binary
    shards: int
    discounts: dict[int, np.ndarray]
    words: int
    pairs: int
    spare: float  # what single words leave to unknown ones

    def probability(self, order: int, count: np.ndarray, total: np.ndarray, ones: np.ndarray, twos: np.ndarray, more: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Of an n-gram of the count, in a context of the others."""
        d = self.discounts[order]
        known = np.maximum(total, 1)
        left = np.where(total > 0, np.maximum((d[1] * ones + d[2] * twos + d[3] * more) / known, 1e-30), 1.0)
        return (count - d[np.minimum(count, 3)]) / known + left * below


def sharded(texts: DataFrame, buckets: int, shards: int) -> Shards:
    """The model of all texts by n-gram; every n-gram of every text is counted and kept."""
    spark = texts.sparkSession

    def rows(shard: list, words: list, blob: list, sizes: list) -> pd.DataFrame:
        return pd.DataFrame({"shard": pd.Series(shard, dtype="int32"), "words": pd.Series(words, dtype=bool), "blob": blob, "sizes": sizes})

    def build(group: pd.DataFrame) -> pd.DataFrame:
        b = _Bucket.of(group["grams"].tolist())
        classes = lambda x: [(x == 1).view(np.int8), (x == 2).view(np.int8), (x > 2).view(np.int8)]
        none = lambda x: [np.broadcast_to(np.int8(0), len(x))] * 4
        shard, of_words, blob = [], [], []

        def add(keys, columns, word):
            cuts = _shard_cuts(keys, shards)
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                i, j = cuts[k], cuts[k + 1]
                shard.append(k)
                of_words.append(word)
                blob.append(pack(steps(keys[i:j]), *(c[i:j] for c in columns)))

        order = np.argsort(b.g3)
        add(_short_key(b.g3[order]), [b.n[order], *none(order)], False)
        add(_short_key(b.g2[b.two]), [b.before, *none(b.two)], False)
        add(*_summed(_short_key(b.uv), [np.broadcast_to(np.int8(0), len(b.n)), b.n, *classes(b.n)]), False)
        nothing = np.zeros(len(b.w2), dtype=np.int8)
        columns = [np.concatenate(x) for x in ((nothing + 1, nothing), *((nothing, x) for x in (b.before, *classes(b.before))))]
        add(*_summed(np.concatenate([_word_key(b.w2), _word_key(b.v2)]), columns), True)
        sizes = [int((x == k).sum()) for x in (b.n, b.before) for k in (1, 2, 3, 4)]
        return rows([*shard, -1], [*of_words, False], [*blob, b""], [*[None] * len(shard), sizes])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        tables, sizes = [], [0] * 6
        for word in (False, True):
            held = [unpack(x) for x in group["blob"][group["words"] == word]]
            if not held:
                continue
            keys = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in held])
            columns = [np.concatenate([x[i] for x in held]) for i in range(1, 6)]
            del held
            keys, columns = _summed(keys, columns)
            if word:
                sizes = [*(int((columns[0] == k).sum()) for k in (1, 2, 3, 4)), int((columns[0] > 0).sum()), int(columns[0].sum())]
            tables.append((keys, columns))
        keys, columns = _summed(np.concatenate([t[0] for t in tables]), [np.concatenate([t[1][i] for t in tables]) for i in range(5)])
        at = range(0, len(keys), BLOB_KEYS)
        blobs = [pack(steps(keys[i : i + BLOB_KEYS]), *(c[i : i + BLOB_KEYS] for c in columns)) for i in at]
        shard = int(group["shard"].iloc[0])
        return rows([shard] * len(blobs) + [-1], [False] * (len(blobs) + 1), [*blobs, b""], [*[None] * len(blobs), sizes])

    def total(frame: DataFrame, n: int) -> list[int]:
        row = frame.where("shard < 0").agg(*(F.sum(F.col("sizes")[i]).alias(f"s{i}") for i in range(n))).first()
        return [x or 0 for x in row]

    schema = "shard int, words boolean, blob binary, sizes array<long>"
    with _released(spark):
        with passing(by_group(_trigrams(texts, buckets), ["bucket"], build, schema)) as parts:
            # Some shards after others, so that not all parts stand beside their shuffle files and the shards.
            table = reduce(DataFrame.unionAll, [stored(by_group(parts.where(f"shard >= 0 AND shard % {MERGES} = {i}"), ["shard"], merge, schema)) for i in range(min(MERGES, shards))])
            long, one = total(parts, 8), total(table, 6)
    sizes = {3: long[:4], 2: long[4:], 1: one[:4]}
    d = {order: np.array(_discounts(dict(zip((1, 2, 3, 4), x)))) for order, x in sizes.items()}
    words, pairs = one[4:]
    taken = d[1][1] * one[0] + d[1][2] * one[1] + d[1][3] * (words - one[0] - one[1])
    return Shards(table.where("shard >= 0").select("shard", "blob"), shards, d, words, pairs, taken / pairs)


def _asked(w: np.ndarray, v: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Ascending keys of all n-grams and contexts of the tokens."""
    begin = np.array([_BEGIN & _SIX])
    keys = [_word_key(np.append(w, begin)), _short_key(_pair(np.append(v, begin), np.append(w, begin))), _short_key(_triple(_pair(u, v), w))]
    keys = np.sort(np.concatenate(keys))  # several times as fast as np.unique, which hashes
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])]


def _looked_up(docs: DataFrame, model: Shards, names: list[str], schema: str) -> DataFrame:
    """The rows that ``schema`` describes, of the columns ``text`` and ``names`` of ``docs``.

    Tasks send the different n-grams of a stretch of texts to the shards of the model, and the stretch's words with them; a
    shard answers with its counts, and all answers to a stretch meet again with its words. Nothing grows
    with a frequent n-gram, which a stretch asks for once, nor with the model, of which a task holds one shard.
    """
    table, model = model.table, replace(model, table=None)  # tasks get the rest of it
    shards = model.shards
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    line = f"stretch long, turn int, shard int, blob binary, docs array<struct<{','.join(f'{c}:{kinds[c]}' for c in names)}>>"
    columns = ["stretch", "turn", "shard", "blob", "docs"]

    def batch_of(stretch, turn, shard, blob, rows, many):
        """Rows of a stretch; the first has the ``many`` documents."""
        offsets = pa.array([0, *[many] * len(blob)], pa.int32())
        arrays = [pa.array([stretch] * len(blob), pa.int64()), pa.array(turn, pa.int32()), pa.array(shard, pa.int32()), pa.array(blob, pa.binary()), pa.ListArray.from_arrays(offsets, rows)]
        return pa.RecordBatch.from_arrays(arrays, names=columns)

    def ask(batches):
        task, stretch, held, size = TaskContext.get().partitionId(), 0, [], 0

        def emit():
            h, per = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            w, v, u, _ = _laid(h, per)
            keys = _asked(w, v, u)
            known, at = np.unique(h, return_inverse=True)
            fields = [pa.concat_arrays([x[2].column(i + 1) for x in held]) for i in range(len(names))]
            number = (task << 32) + stretch
            cuts = _shard_cuts(keys, shards)
            to = np.flatnonzero(np.diff(cuts)).tolist()
            blobs = [pack(steps(known), at.ravel(), per), *(pack(steps(keys[cuts[k] : cuts[k + 1]])) for k in to)]
            rows = pa.StructArray.from_arrays(fields, names=names)
            return batch_of(number, [0] + [1] * len(to), [number % shards, *to], blobs, rows, len(rows))

        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(0)):
                h, _, per = words(data, offsets, fold=False)
                held.append((h & _SIX, per, batch.slice(first, end - first)))
                size += len(h) + len(per)
                if size >= STRETCH:
                    yield emit()
                    stretch, held, size = stretch + 1, [], 0
        if held:
            yield emit()

    def answer(batches):
        shard, parts, keys, values = -1, [], None, []
        for batch in batches:
            made = []
            for stretch, turn, at, blob in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if at != shard:
                    shard, parts, keys = at, [], None
                if stretch < 0:
                    parts.append(unpack(blob))
                elif turn:
                    if keys is None:
                        parts.sort(key=lambda p: int(p[0][0]))  # the first step is the first key
                        keys = np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(p[0], dtype=np.uint64) for p in parts)])
                        values = [np.concatenate([*(p[i] for p in parts), np.zeros(1, np.uint8)]) for i in range(1, 6)]
                        parts = []
                    wanted = np.cumsum(unpack(blob)[0], dtype=np.uint64)
                    place = np.searchsorted(keys, wanted)
                    place[np.append(keys, np.uint64(0))[place] != wanted] = len(keys)
                    blob = pack(*(x[place] for x in values))
                made.append(blob)
            asked = pa.array(made, pa.binary())
            out = pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), asked, batch.column(4)], names=columns)
            yield out.filter(pc.greater_equal(batch.column(0), 0))

    def judge(row: list, answers: list[bytes]):
        known, at, per = unpack(row[3])
        h = np.cumsum(known, dtype=np.uint64)[at]
        per = per.astype(np.int64)
        w, v, u, of = _laid(h, per)
        keys = _asked(w, v, u)
        got = [unpack(x) for x in answers]
        count, total, *classes = (np.concatenate([x[i] for x in got]).astype(np.int64) for i in range(5))
        first = np.cumsum(per + 1) - (per + 1)
        begin = np.array([_BEGIN & _SIX])

        def place_of(own):
            order = np.argsort(own)  # places in order are found faster
            place = np.empty(len(own), dtype=np.int64)
            place[order] = np.searchsorted(keys, own[order])
            return place

        def places(own, before):
            """Of the n-grams that end at each token, and those that end at the one before."""
            here = place_of(own)
            there = np.roll(here, 1)
            there[first] = np.searchsorted(keys, before)
            return here, there

        one, context = places(_word_key(w), _word_key(begin))
        two, contexts = places(_short_key(_pair(v, w)), _short_key(_pair(begin, begin)))
        d, n = model.discounts[1], count[one]
        p = (n - d[np.minimum(n, 3)]) / model.pairs + model.spare / (model.words + 1)
        p = model.probability(2, count[two], *(x[context] for x in (total, *classes)), p)
        n = count[place_of(_short_key(_triple(_pair(u, v), w)))]
        p = model.probability(3, n, *(x[contexts] for x in (total, *classes)), p)
        return per + 1, np.bincount(of, weights=np.log10(p), minlength=len(per))

    def finish(batches):
        for group in whole_groups(batches, "stretch", 1):
            head, answers = None, []
            lines = zip(*(group[c].to_pylist() for c in columns[:4]), range(group.num_rows))
            texts = group["docs"].combine_chunks() if group["docs"].num_chunks != 1 else group["docs"].chunk(0)

            def made():
                n, log = judge(head, answers)
                fields = dict(zip(names, texts[head[4]].values.flatten()))
                results = [pa.array(n, pa.int64()), pa.array(log, pa.float64()), pa.array(10 ** np.minimum(-log / n, 300.0))]
                return pa.RecordBatch.from_arrays([fields["doc_id"], fields["lang"], *results, *(fields[c] for c in names[2:])], names=["doc_id", "lang", "n_tokens", "log10_prob", "perplexity", *names[2:]])

            for row in lines:
                if row[1] == 0:
                    if head:
                        yield made()
                    head, answers = row, []
                else:
                    answers.append(row[3])
            if head:
                yield made()

    asked = docs.select("text", *names).mapInArrow(tidy(ask), line)
    held = table.select(F.lit(-1).cast("long").alias("stretch"), F.lit(0).alias("turn"), "shard", "blob", F.lit(None).cast(asked.schema["docs"].dataType).alias("docs"))
    answered = asked.unionByName(held).repartition("shard").sortWithinPartitions("shard", "stretch").mapInArrow(tidy(answer), line)
    return answered.repartition("stretch").sortWithinPartitions("stretch", "turn", "shard").mapInArrow(tidy(finish), schema)


def perplexities(
    docs: DataFrame, model: Model | Shards, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, lang, n_tokens, log10_prob, perplexity) of each whole text, and the columns in ``carry``; an empty or null text is one end."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), _lang(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"), *carry)
    carried = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, lang string, n_tokens long, log10_prob double, perplexity double{carried}"
    if isinstance(model, Shards):
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        slices = min(SLICES, -(-size // SLICE_BYTES) or 1)
        of = F.pmod(F.xxhash64("text"), F.lit(slices))  # of a row's own content, however often and in which order rows are read
        with _released(spark):
            found = [stored(_looked_up(rows.where(of == i), model, ["doc_id", "lang", *carry], schema)) for i in range(slices)]
        return reduce(DataFrame.unionAll, found)
    shared = spark.sparkContext.broadcast(model)  # bounded by SMALL_BYTES, or by who asked for a pruned one

    def run(batches):
        score = shared.value.scorer()
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(2)):
                n, total = score(data, offsets)
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(total, pa.float64()), pa.array(10 ** np.minimum(-total / n, 300.0)), *part.columns[3:]],
                    names=["doc_id", "lang", "n_tokens", "log10_prob", "perplexity", *carry],
                )

    return rows.mapInArrow(tidy(run), schema)


def limits(held: DataFrame, upper: float, by: list[str]) -> DataFrame:
    """The perplexity of each group above which a document is rejected: its exact ``upper`` quantile.

    A group of fewer than ``1 / (1 - upper)`` documents cannot show that quantile, which lies beyond its
    largest; there the limit is ``SPREAD`` times the largest, as clean short texts spread widely.
    """
    parts = {"high": (round(upper * 1000), 1000), "largest": (1, 1)}
    counts = held.groupBy(*by).agg(F.count("perplexity").alias("n"))
    found = exact_quantiles(held, "perplexity", parts, by, "inclusive").join(counts, by)
    return found.select(*by, F.when(F.col("n") * F.lit(1 - upper) >= 1, F.col("high")).otherwise(F.col("largest") * SPREAD).alias("limit"))


def classify(docs: DataFrame, labels: DataFrame, upper: float = UPPER, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, lang, n_tokens, log10_prob, perplexity, threshold, kept, and the columns in ``carry``.

    Trusted rows have the label quality 1 and not toxic 1. All of them are used whole: the model counts three quarters
    of them, by a hash of the id, and the other quarter, which it has not seen, sets the limits. A document is rejected if its
    perplexity is above the limit of its language, an exact quantile (see ``limits``) of that quarter; a language without any takes the quantile of all, and without trusted
    rows nothing is rejected. A document at the threshold is kept, and so is one without any word. Null languages
    are one language. Ids may be of any type that equals those of the labels; null ids are scored and kept
    or rejected like others; repeated rows stay rows of their own.
    """
    trust = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    trust = stored(trust.withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0))
    learn = trust.where("NOT held").select("doc_id")
    learn = F.broadcast(learn) if learn.limit(FIT_IDS + 1).count() <= FIT_IDS else learn
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("octet_length(text) > 0").join(learn, "doc_id", "left_semi")
    scored = stored(perplexities(docs, fit(texts), carry=carry))
    held = scored.join(trust.where("held"), "doc_id", "left_semi")
    held = stored(held.select("lang", "perplexity"))
    by_lang = stored(limits(held, upper, ["lang"]).withColumnRenamed("limit", "own"))
    overall = limits(held.withColumn("one", F.lit(1)), upper, ["one"]).agg(F.max("limit").alias("any"))
    # One row per language; rows are not shuffled by language, of which one may hold most of them.
    few = by_lang.limit(FEW + 1).count() <= FEW
    threshold = F.coalesce("own", "any")
    return (
        scored.join(F.broadcast(by_lang) if few else by_lang, "lang", "left")
        .join(F.broadcast(overall))  # one row
        .select(
            "doc_id", "lang", "n_tokens", "log10_prob", "perplexity", threshold.alias("threshold"),
            (F.col("perplexity").isNull() | (F.col("n_tokens") <= 1) | F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).alias("kept"),
            *carry,
        )
    )
