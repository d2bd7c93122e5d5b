"""Phrase collocations by Toivonen's sampling: frequent phrases of a sample and their negative border, counted exactly."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import mix, prefix_hashes, stored, tidy

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words of a phrase
TOP = 2000
COVERED = 80  # percent of a phrase's occurrences inside a longer one that make it part of that
SHARE = 10  # one in so many documents is sampled
SAMPLE_LEAST = 3  # occurrences in the sample; LEAST / SHARE
CHUNK = 3 << 20  # bytes of text counted at once inside a task
SLICE = 100_000  # rows passed on at once
FILTER_BITS = (20, 28)  # powers of two: least and greatest size of a filter (32 MB)
PROBES = 4

_SPACES = re.compile(rb"[ \t]+")
_LONG_SPLIT = re.compile(rb"[.,;:!?\n-\r]")
_BREAK = np.zeros(256, dtype=bool)
_BREAK[np.frombuffer(b".,;:!?\n\x0b\x0c\r", dtype=np.uint8)] = True
_GAP = _BREAK.copy()
_GAP[[32]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _salt(lang: str) -> np.uint64:
    sums, down = prefix_hashes(np.frombuffer(lang.encode() or b"\0", dtype=np.uint8))
    return mix(sums[-1:] * down[:1], 0x632BE59BD9B4E019)[0]


class Words:
    """Words of a text in lower case with single spaces: where they lie, their hashes and their pieces."""

    def __init__(self, data: bytes, lang: str):
        self.data = np.frombuffer(data, dtype=np.uint8)
        inside = ~_GAP[self.data]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        self.begin, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums, down = prefix_hashes(self.data)
        self.hash = mix(((sums[self.end] - sums[self.begin]) * down[self.begin]) ^ _salt(lang), 0x5851F42D4C957F2D)
        self.piece = np.cumsum(_BREAK[self.data])[self.begin] if len(self.begin) else np.zeros(0, np.int64)

    def runs(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each place."""
        value = np.zeros(len(at), dtype=np.uint64)
        for k in range(size):
            value = value * _STEP + self.hash[at + k]
        return mix(value, size)

    def texts(self, at: np.ndarray, size: int) -> pa.Array:
        a, b = self.begin[at], self.end[at + size - 1]
        n = b - a
        ends = np.cumsum(n)
        gathered = self.data[np.arange(int(n.sum())) + np.repeat(a - (ends - n), n)]
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(gathered)))


class Filter:
    """A set of phrases as bits: a phrase in it is always found, another one rarely.

    A hash sets up to four bits of one 64-bit word, so a look-up touches one place in memory.
    """

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, dtype="<u8")

    @staticmethod
    def _split(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        return (hashes & np.uint64(words - 1)).astype(np.int64), mix(hashes, 0x2545F4914F6CDD1D)

    @classmethod
    def places(cls, hashes: np.ndarray, size: int) -> np.ndarray:
        word, more = cls._split(hashes, size // 64)
        bit = np.stack([(more >> np.uint64(6 * k)) & np.uint64(63) for k in range(PROBES)], axis=1)
        return word[:, None] * 64 + bit.astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        word, more = self._split(hashes, len(self.bits))
        held, found = self.bits[word], np.ones(len(hashes), dtype=bool)
        for k in range(PROBES):
            found &= (held >> ((more >> np.uint64(6 * k)) & np.uint64(63))) & np.uint64(1) == 1
        return found


def build_filter(phrases: DataFrame) -> Broadcast:
    """Filter of the (lang, phrase) rows; its size follows their number up to 32 MB, beyond which it lets more through."""
    spark = phrases.sparkSession
    low, high = FILTER_BITS
    power = min(high, max(low, (12 * phrases.count()).bit_length()))

    def run(batches):
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            for number, name in enumerate(lang.dictionary.to_pylist()):
                own = batch.column(1).filter(pc.equal(lang.indices, number)).to_pylist()
                words = Words("\n".join(own).encode(), name)  # a piece for each phrase
                first = np.flatnonzero(np.diff(words.piece, prepend=-1))
                size = np.diff(np.append(first, len(words.hash)))
                for k in range(1, LONGEST + 1):
                    places = Filter.places(words.runs(first[size == k], k), 1 << power)
                    yield pa.RecordBatch.from_arrays([pa.array(places.ravel().astype(np.int64))], names=["place"])

    places = phrases.select("lang", "phrase").mapInArrow(tidy(run), "place long")
    blocks = places.groupBy(F.expr("place div 32768").alias("block")).agg(F.expr("bitmap_construct_agg(place % 32768)").alias("bits"))
    bits = bytearray(1 << (power - 3))
    for row in blocks.toLocalIterator():  # at most 8192 rows of 4 KB
        bits[row["block"] * 4096 : row["block"] * 4096 + 4096] = row["bits"]
    return spark.sparkContext.broadcast(bytes(bits))


def _texts_by_lang(batches) -> Iterator[tuple[str, bytes]]:
    """Texts of a language in lower case, joined by line ends, about ``CHUNK`` bytes at a time.

    A longer text is cut where a piece ends, so no phrase is cut.
    """
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            text = _SPACES.sub(b" ", text.as_py().lower())
            parts = [text]
            if len(text) > 2 * CHUNK:
                cuts, at = [0], CHUNK
                while at < len(text) and (found := _LONG_SPLIT.search(text, at)):
                    cuts.append(found.end())
                    at = found.end() + CHUNK
                parts = [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]
            for part in parts:
                held.setdefault(lang, []).append(part)
                size += len(part)
                if size >= CHUNK:
                    for name, texts in held.items():
                        yield name, b"\n".join(texts)
                    held, size = {}, 0
    for name, texts in held.items():
        yield name, b"\n".join(texts)


class Step:
    """What one pass counts: phrases whose parts without the last and without the first word are both known.

    That is the known set and its negative border. A pass after the first knows more by some ``fresh``
    phrases only, so one of the parts must be fresh.
    """

    def __init__(self, known: bytes, fresh: bytes | None, sizes: frozenset[int]):
        self.known, self.fresh = Filter(known), Filter(fresh) if fresh is not None else None
        self.sizes = sizes  # of the fresh phrases

    def _inside(self, words: Words, at: np.ndarray, size: int) -> np.ndarray:
        """Whether the phrases and all their parts are known, which is what the first pass goes by, level by level."""
        ok = self.known.has(words.runs(at, size))
        return ok if size == 1 else ok & self._inside(words, at, size - 1) & self._inside(words, at + 1, size - 1)

    def admits(self, words: Words, at: np.ndarray, size: int) -> np.ndarray:
        """Whether this pass counts the phrases with parts of ``size`` words, unless an earlier one has."""
        if self.fresh is None:
            return self._inside(words, at, size) & self._inside(words, at + 1, size)
        head, tail = words.runs(at, size), words.runs(at + 1, size)
        return self.known.has(head) & self.known.has(tail) & (self.fresh.has(head) | self.fresh.has(tail))


def admitted(words: Words, steps: list[Step]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, places) of the phrases that the last step counts and no earlier one has counted; words come with the first."""
    every = np.arange(len(words.hash))
    now, before = steps[-1], steps[:-1]
    if not before:
        yield 1, every
    held = None
    for size in range(1, LONGEST):
        if now.fresh is not None and size not in now.sizes:
            continue
        fits = every[: max(0, len(every) - size)]
        together = words.piece[fits] == words.piece[fits + size]  # ``size`` + 1 words in one piece
        if now.fresh is None:
            if held is None:
                held = now.known.has(words.runs(every, 1))
            at = fits[together & held[fits] & held[fits + 1]]
            held = np.zeros(len(every), dtype=bool)
            if size + 1 < LONGEST:
                held[at] = now.known.has(words.runs(at, size + 1))
        else:
            whole = every[: max(0, len(every) - size + 1)]
            hit = np.zeros(len(every) + 1, dtype=bool)
            hit[whole] = now.fresh.has(words.runs(whole, size))
            at = fits[together & (hit[fits] | hit[fits + 1])]
            take = now.admits(words, at, size)
            for old in before:
                take &= ~old.admits(words, at, size)
            at = at[take]
        yield size + 1, at


def count(rows: DataFrame, steps: list[tuple[Broadcast, Broadcast | None, frozenset[int]]]) -> DataFrame:
    """(key, n) of the phrases of the last step, the key being language and phrase; with the words come all words of a language, under no phrase.

    Occurrences are summed in the tasks, chunk by chunk. Most phrases of a border are rare, so summing them once
    more before the shuffle would cost more than it saves.
    """

    def run(batches):
        made = [Step(known.value, fresh.value if fresh is not None else None, sizes) for known, fresh, sizes in steps]
        for lang, data in _texts_by_lang(batches):
            words = Words(data, lang)
            if len(made) == 1:
                yield _batch(lang, pa.array([""], pa.string()), np.array([len(words.hash)]))
            for size, at in admitted(words, made):
                if not len(at):
                    continue
                _, first, n = np.unique(words.runs(at, size), return_index=True, return_counts=True)
                for a in range(0, len(first), SLICE):
                    yield _batch(lang, words.texts(at[first[a : a + SLICE]], size), n[a : a + SLICE])

    made = rows.mapInArrow(tidy(run), "key string, n long")
    return made.repartition("key").groupBy("key").agg(F.sum("n").alias("n"))


def _batch(lang: str, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    keys = pc.binary_join_element_wise(pa.scalar(lang), phrases, pa.scalar("\n"))  # no phrase holds a line end
    return pa.RecordBatch.from_arrays([keys, pa.array(n.astype(np.int64))], names=["key", "n"])


def opened(counted: DataFrame) -> DataFrame:
    """(lang, phrase, size, n) of counted keys."""
    phrase = F.substring_index("key", "\n", -1)
    lang = F.expr("substring(key, 1, char_length(key) - char_length(phrase) - 1)")
    words = F.expr("if(phrase = '', 0, size(split(phrase, ' ')))")
    return counted.withColumn("phrase", phrase).select(lang.alias("lang"), "phrase", words.alias("size"), "n")


@dataclass
class Mined:
    """Phrases of one word or more that occur often enough, with exact counts, and the words of each language."""

    phrases: DataFrame
    totals: DataFrame
    passes: int


def mine(rows: DataFrame, least: int, proposed: DataFrame | None = None) -> Mined:
    """All phrases of up to ``LONGEST`` words with at least ``least`` occurrences in (lang, text) rows.

    A pass counts what is proposed and its negative border. A phrase of the border that is frequent after all
    joins the set, whose new border is counted by the next pass, until no pass finds one. Every part of a
    frequent phrase is as frequent, so whatever is left uncounted then is not frequent.
    """
    spark, found, totals = rows.sparkSession, None, None
    nothing = bytes(1 << (FILTER_BITS[0] - 3))
    steps = [(build_filter(proposed) if proposed is not None else spark.sparkContext.broadcast(nothing), None, frozenset())]
    while True:
        counted = stored(opened(count(rows, steps).where((F.col("n") >= least) | F.col("key").endswith("\n"))))
        if totals is None:
            totals = counted.where("size = 0").select("lang", F.col("n").alias("words"))
        new = counted.where("size > 0")
        found = new if found is None else found.unionAll(new)
        if proposed is not None and len(steps) == 1:
            new = stored(new.join(proposed.select("lang", "phrase").hint("merge"), ["lang", "phrase"], "left_anti"))
        fresh = new.where(F.col("size") < LONGEST)  # a phrase of the greatest length has no border beyond it
        sizes = frozenset(r["size"] for r in fresh.select("size").distinct().collect())  # three at most
        if not sizes:
            return Mined(found, totals, len(steps))
        steps = [*steps, (build_filter(found), build_filter(fresh), sizes)]


def sampled(rows: DataFrame, share: int = SHARE) -> DataFrame:
    """One in ``share`` documents, chosen by a hash of the text, so a task that runs again takes the same."""
    return rows.where(F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(share)) == 0)


def collocations(
    docs: DataFrame, top: int = TOP, least: int = LEAST, share: int = SHARE, sample_least: int = SAMPLE_LEAST,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to four words of each language.

    Null language counts as ``und``, null text as empty; repeated rows count again; equal scores go by
    occurrences and then by phrase. A table without words gives no rows. Counts are whole numbers of all
    rows; scores are worked out in decimals of 38 digits.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    proposed = mine(sampled(rows, share), sample_least).phrases
    mined = mine(rows, least, proposed)
    counts = mined.phrases.select("lang", "phrase", "size", F.col("n").alias("a"))
    candidates = counts.where("size > 1")
    part = counts.select("lang", "phrase", "a")
    cut = (
        candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("tail", F.expr("substring_index(phrase, ' ', k - size)"))
        .join(part.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")).hint("merge"), ["lang", "head"])
        .join(part.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")).hint("merge"), ["lang", "tail"])
        .withColumn("score", F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    )
    scored = cut.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = [F.expr(f"transform(sequence(0, size - {n}), i -> array_join(slice(words, i + 1, {n}), ' '))") for n in range(2, LONGEST)]
    held = (
        candidates.where("size > 2").withColumn("words", F.split("phrase", " "))
        .select("lang", "a", F.explode(F.array_distinct(reduce(F.array_union, [F.when(F.col("size") > n, x).otherwise(F.array().cast("array<string>")) for n, x in enumerate(inner, 2)]))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    kept = scored.join(held.hint("merge"), ["lang", "phrase"], "left").where(
        "longer IS NULL OR CAST(100 AS DECIMAL(3,0)) * CAST(longer AS DECIMAL(20,0)) < CAST(80 AS DECIMAL(3,0)) * CAST(a AS DECIMAL(20,0))".replace("80", str(COVERED))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(mined.totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("words").alias("n"), F.col("cut.score").alias("score")
    )
