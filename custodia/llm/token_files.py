"""Token ids in files of directly addressable codes."""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from custodia.llm.common import tidy
from custodia.session import shared_dir

END_ID = 2
FILE_IDS = 1 << 22  # ids of one file; a document is never cut
CHUNK_BITS = 8
SUPER = 512  # bits of a bitmap that one entry of its rank directory stands for
CACHE = 400_000  # stretches whose ids a worker remembers
BATCH_CHARS = 1 << 20  # characters whose words are looked up together
ASKED = 1_000_000  # positions that one task looks up in one file

_MAGIC = b"DACIDS01"
_HEAD = struct.Struct("<8sqqqqq")  # magic, part, number in the part, documents, ids, levels

# --- the file format ------------------------------------------------------------------------------


def _padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def write_codes(values: np.ndarray) -> list[bytes]:
    """Sections of the codes: for each level its size, chunks, continuation bitmap and rank directory.

    A level holds the next 8 bits of every value that still has some; a set bit says that the value goes on
    in the next level. The directory has the number of set bits before each 512.
    """
    out, level = [], values.astype("<u4")
    while len(level) or not out:
        more = level > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (SUPER // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, SUPER // 8).sum(axis=1, dtype=np.int64)
        out.append(struct.pack("<q", len(level)) + _padded(level.astype(np.uint8).tobytes()) + bits.tobytes() + (np.cumsum(ones) - ones).astype("<i8").tobytes())
        level = level[more] >> np.uint32(CHUNK_BITS)
    return out


def write_file(part: int, number: int, docs: list, lengths: list[int], values: np.ndarray) -> bytes:
    """One file: head, document ids, whether they are null, end of each document, codes of all ids."""
    levels = write_codes(values)
    head = _HEAD.pack(_MAGIC, part, number, len(docs), len(values), len(levels))
    names = np.array([0 if d is None else d for d in docs], dtype="<i8").tobytes()
    null = _padded(np.array([d is None for d in docs], dtype=np.uint8).tobytes())
    return b"".join([head, names, null, np.cumsum(lengths, dtype="<i8").tobytes(), *levels])


def read_head(content: bytes) -> tuple[int, int, int, int, int]:
    """(part, number in the part, documents, ids, levels) of a file."""
    magic, *rest = _HEAD.unpack_from(content)
    if magic != _MAGIC:
        raise ValueError("not a file of directly addressable codes")
    return tuple(rest)


class CodeFile:
    """Read access to one file; nothing is decoded before it is asked for."""

    def __init__(self, content: bytes):
        self.part, self.number, n_docs, self.n, levels = read_head(content)
        at = _HEAD.size

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            made = np.frombuffer(content, dtype=kind, count=count, offset=at)
            at += made.nbytes + -made.nbytes % 8
            return made

        names, null = take(n_docs, "<i8").tolist(), take(n_docs, "u1")
        self.docs = [None if z else d for d, z in zip(names, null)]
        self.ends = take(n_docs, "<i8")
        self.levels = []
        for _ in range(levels):
            size = int(take(1, "<i8")[0])
            chunks = take(size, "u1")
            blocks = -(-size // SUPER)
            self.levels.append((chunks, take(blocks * SUPER // 8, "u1"), take(blocks, "<i8")))

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory, the bytes since its entry, the bits since the byte."""
        _, bits, ones = self.levels[level]
        block, byte = at // SUPER, at // 8
        between = bits[(block * (SUPER // 8))[:, None] + np.arange(SUPER // 8)]
        whole = np.arange(SUPER // 8)[None, :] < (byte - block * (SUPER // 8))[:, None]
        rest = bits[byte] & ((1 << (at % 8)) - 1).astype(np.uint8)
        return ones[block] + (np.bitwise_count(between) * whole).sum(axis=1, dtype=np.int64) + np.bitwise_count(rest)

    def tokens(self, at: np.ndarray) -> np.ndarray:
        """The ids at any places of the file; each costs one step a level, whatever lies around it."""
        at = np.asarray(at, dtype=np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("place outside the file")
        out = np.zeros(len(at), dtype=np.uint32)
        which, shift = np.arange(len(at)), 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[which] |= chunks[at].astype(np.uint32) << np.uint32(shift)
            on = (bits[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1
            if not on.any():
                break
            at, which, shift = self._rank(level, at[on]), which[on], shift + CHUNK_BITS
        return out

    def run(self, first: int, end: int) -> np.ndarray:
        """The ids of a stretch, decoded level by level."""
        parts = []
        for level, (chunks, bits, _) in enumerate(self.levels):
            on = np.unpackbits(bits[first // 8 : -(-end // 8)], bitorder="little")[first % 8 : first % 8 + end - first].astype(bool)
            parts.append((chunks[first:end], on))
            if not on.any():
                break
            first = int(self._rank(level, np.array([first + int(np.argmax(on))]))[0])
            end = first + int(on.sum())
        out = np.zeros(0, dtype=np.uint32)
        for chunk, on in reversed(parts):
            whole = chunk.astype(np.uint32)
            if len(out):
                whole[on] |= out << np.uint32(CHUNK_BITS)
            out = whole
        return out.astype("<u4")


# --- ids of texts ---------------------------------------------------------------------------------


class WordIds:
    """Ids of whole texts for a word-level BPE file.

    Texts in Latin letters are normalised and cut here and merged by a byte-pair encoder over the same
    merges, in which a zero byte is the end of a word. All other texts, and those that hold a zero byte, a
    special token or a letter whose lower case depends on the library, go to the library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        model, mark = spec["model"], spec["model"]["end_of_word_suffix"]
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        extra = iter(range(256, 512))
        symbols = {chr(b if b in plain else next(extra)): b for b in range(256)}

        def raw(label: str) -> bytes:
            ends = label.endswith(mark) and label != mark
            return bytes(symbols[c] for c in (label[: -len(mark)] if ends else label)) + (b"\0" if ends else b"")

        # Order of merging: ends of words first, then the merges as listed.
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        order = [bytes([b]) for b in range(256)] + [bytes([b, 0]) for b in range(1, 256)] + [raw(a) + raw(b) for a, b in merges]
        ranks = {token: i for i, token in enumerate(dict.fromkeys(order))}
        by_token = {raw(label): i for label, i in model["vocab"].items() if label not in {t["content"] for t in spec["added_tokens"]}}
        self.ids = np.full(len(ranks), -1, dtype=np.int64)
        for token, i in ranks.items():
            self.ids[i] = by_token.get(token, -1)
        self.pairs = tiktoken.Encoding("words", pat_str="[^\\x00]+\\x00", mergeable_ranks=ranks, special_tokens={})
        self.closes = np.array([token.endswith(b"\0") for token in ranks])
        self.known: dict[str, bytes] = {}
        self.special = [t["content"] for t in spec["added_tokens"]]
        # Letters and numbers up to the end of the Latin blocks, as classes of the pattern of the file.
        kinds = {k: "".join(re.escape(chr(c)) for c in range(1, 0x250) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        space = "\t-\r \x85\xa0"
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[^{space}{kinds['L']}{kinds['N']}]+").findall
        self.control = re.compile("[\0\x1c-\x1f]").search  # the last four are white space to split() alone
        self.odd = re.compile("[^\x01-įĲ-ɏ]").search  # without İ and ı

    def _cut(self, text: str) -> list[str] | None:
        """Stretches of a text without white space, or nothing where the library has to see the whole of it."""
        low = text.lower()
        if self.control(text) or not text.isascii() and (self.odd(text) or self.odd(low)) or any(s in text for s in self.special):
            return None
        return low.split()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of stretches that are not remembered, by one call; every word of them ends with a token that ends words."""
        if len(self.known) + len(words) > CACHE:
            self.known.clear()
        found = [[word] if word.isalpha() else self.words(word) for word in words]
        made = self.pairs.encode_to_numpy("\0".join(["\0".join(f) for f in found]) + "\0", disallowed_special=())
        last = np.cumsum([len(f) for f in found]) - 1
        ids, ends = self.ids[made].astype("<u4").tobytes(), ((np.flatnonzero(self.closes[made])[last] + 1) * 4).tolist()
        fresh = {word: ids[a:b] for word, a, b in zip(words, [0, *ends], ends)}
        self.known.update(fresh)
        return fresh

    def many(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; a run of texts is cut first, so that what is new in them is merged together."""
        at = 0
        while at < len(texts):
            size, cut, new = 0, [], set()
            while at < len(texts) and size < BATCH_CHARS:
                words = self._cut(texts[at])
                got = list(map(self.known.get, words)) if words else []
                if None in got:
                    new.update([w for w, g in zip(words, got) if g is None])
                cut.append((texts[at], words, got))
                size, at = size + len(texts[at]), at + 1
            fresh = self._learn(list(new)) if new else {}
            for text, words, got in cut:
                if words is None:
                    yield np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
                else:
                    yield np.frombuffer(b"".join([fresh[w] if g is None else g for w, g in zip(words, got)] if None in got else got), dtype="<u4")

    def one(self, text: str) -> np.ndarray:
        return next(self.many([text]))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


# --- Spark ----------------------------------------------------------------------------------------


def write(docs: DataFrame, path: str, target: str, end_id: int = END_ID, file_ids: int = FILE_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all documents, each followed by ``end_id``, to files under ``target`` in ascending order of id.

    The rows are range-partitioned by id and sorted in their partitions; each task cuts its stretch into
    files of about ``file_ids`` ids. Null ids come first. Repeated ids follow each other in order of their
    text's hash and their place in the input, which also deals a very frequent id out to many tasks. Null text
    counts as empty and is its end id alone.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(text_col).cast("string")).alias("same"), F.monotonically_increasing_id().alias("place"),
    )
    order = [F.asc_nulls_first("id"), F.asc("same"), F.asc("place")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def run(batches):
        enc, part = word_ids(path), TaskContext.get().partitionId()
        number, held, names, lengths, ids = 0, 0, [], [], []
        end = np.array([end_id], dtype="<u4")

        def made():
            nonlocal number, held
            content = write_file(part, number, names, lengths, np.concatenate(ids))
            number, held = number + 1, 0
            names.clear(), lengths.clear(), ids.clear()
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])

        for batch in batches:
            for doc, own in zip(batch.column(0).to_pylist(), enc.many([t or "" for t in batch.column(1).to_pylist()])):
                names.append(doc)
                lengths.append(len(own) + 1)
                ids += [own, end]
                held += len(own) + 1
                if held >= file_ids:
                    yield made()
        if names:
            yield made()

    # The text writer stores the bytes as they are, and a line end, which readers of the format pass over.
    files = ordered.mapInArrow(tidy(run), "content binary")
    files.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(target)


def _files(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(target).where("length > 0").select("path", "content")


def directory(spark: SparkSession, target: str) -> DataFrame:
    """(path, part, number, place, id, first, n_tokens, ids_crc32) of every document, read from the files.

    ``place`` counts the documents of a file and ``first`` the ids before one there.
    """

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                file = CodeFile(content.as_py())
                ids = file.run(0, file.n)
                first = np.concatenate([[0], file.ends[:-1]]).astype(np.int64)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(first.tolist(), file.ends.tolist())]
                n = len(file.docs)
                same = lambda value, n=n: pa.array([value] * n)
                yield pa.RecordBatch.from_arrays(
                    [same(path.as_py()), same(file.part), same(file.number), pa.array(range(n), pa.int64()), pa.array(file.docs, pa.int64()), pa.array(first), pa.array(file.ends - first), pa.array(crc, pa.int64())],
                    names=["path", "part", "number", "place", "id", "first", "n_tokens", "ids_crc32"],
                )

    return _files(spark, target).mapInArrow(tidy(run), "path string, part long, number long, place long, id long, first long, n_tokens long, ids_crc32 long")


def digests(spark: SparkSession, target: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document; ``start`` is the number of ids before it in all files.

    Heads alone give the ids of each file. Files are summed within their part, and parts, of which there are
    as many as tasks that wrote, one after another.
    """

    def heads(batches):
        for batch in batches:
            found = [read_head(c.as_py()) for c in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1, 3)], names=["p", "f", "n"])

    files = _files(spark, target).select(F.substring("content", 1, _HEAD.size).alias("content")).mapInArrow(heads, "p long, f long, n long")
    within = Window.partitionBy("p").orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("p").agg(F.sum("n").alias("n"))
    before = parts.select("p", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    base = files.withColumn("own", F.coalesce(F.sum("n").over(within), F.lit(0))).join(before, "p").select("p", "f", (F.col("own") + F.col("earlier")).alias("base"))
    docs = directory(spark, target)
    return docs.join(base, (docs["part"] == base["p"]) & (docs["number"] == base["f"])).select(
        F.col("id").alias(id_col), (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokens_at(spark: SparkSession, target: str, wanted: DataFrame, id_col: str = "doc_id", at_col: str = "at") -> DataFrame:
    """(id, at, token) for places in documents, read straight from the codes; no other id is decoded.

    Places outside their document, and documents that are not there or null, give no row. A repeated
    document answers once for each of its copies. A file that very many places ask for is sent to several tasks.
    """
    docs = directory(spark, target).select("path", "id", "first", "n_tokens")
    asked = wanted.select(F.col(id_col).cast("long").alias("id"), F.col(at_col).cast("long").alias("at"))
    found = asked.join(docs, "id").where("at >= 0 AND at < n_tokens").select("path", "id", "at", (F.col("first") + F.col("at")).alias("spot"))
    shares = found.groupBy("path").agg(F.ceil(F.count("*") / F.lit(ASKED)).alias("shares"))
    nothing = F.lit(None).cast("long")
    sides = found.join(shares, "path").select(
        "path", F.pmod(F.xxhash64("id", "at"), "shares").alias("share"), F.lit(1).alias("kind"), "id", "at", "spot", F.lit(None).cast("binary").alias("content")
    ).unionByName(
        _files(spark, target).join(shares, "path")
        .withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
        .select("path", "share", F.lit(0).alias("kind"), nothing.alias("id"), nothing.alias("at"), nothing.alias("spot"), "content")
    )

    def run(batches):
        file = None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            cuts = [*np.flatnonzero(kinds == 0).tolist(), len(kinds)]
            for a, b in _stretches(cuts):
                if kinds[a] == 0:
                    file = CodeFile(batch.column("content")[a].as_py())
                    a += 1
                if a < b:
                    part = batch.slice(a, b - a)
                    token = file.tokens(part.column("spot").to_numpy())
                    yield pa.RecordBatch.from_arrays([part.column("id"), part.column("at"), pa.array(token.astype(np.int64))], names=[id_col, at_col, "token"])

    placed = sides.repartition("path", "share").sortWithinPartitions("path", "share", "kind").drop("path", "share")
    return placed.mapInArrow(tidy(run), f"{id_col} long, {at_col} long, token long")


def _stretches(cuts: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches of rows that belong to one file: from one content row to before the next."""
    if cuts[0] > 0:
        yield 0, cuts[0]
    yield from zip(cuts, cuts[1:])


def scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
