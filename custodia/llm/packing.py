"""Vector bin packing of token sequences by the dot-product heuristic."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from custodia.llm.common import tidy

CAPACITY = 2048
SEGMENTS = 256  # segments of a sequence
POOL = 512  # pieces a task chooses from
LONG_PIECE = 2000  # characters without a break that the plain encoder handles


class Packer:
    """Places pieces of documents into sequences under limits on tokens, segments and loss-bearing tokens.

    The open sequence has a vector of what is left of each limit. Of the waiting pieces that fit, the one
    with the largest dot product of its demand and that vector, both in shares of the limits, goes in.
    If none fits although there is room, the piece with the largest product is cut to fill it.
    """

    def __init__(self, limits: tuple[int, int, int] = (CAPACITY, SEGMENTS, CAPACITY), pool: int = POOL):
        self.limits = np.array(limits, dtype=np.float64)
        self.pool = pool
        self.need = np.zeros((0, 3))
        self.items: list[tuple] = []  # (document, start, length, loss-bearing tokens)

    def add(self, items: list[tuple]) -> None:
        self.items += items
        self.need = np.concatenate([self.need, np.array([(i[2], 1, i[3]) for i in items], dtype=np.float64).reshape(-1, 3)])

    def sequences(self, final: bool = False) -> Iterator[list[tuple]]:
        """Full sequences, as long as enough pieces wait; ``final`` empties the pool."""
        while self.items and (final or (len(self.items) >= self.pool and self.need[:, 0].sum() >= 4 * self.limits[0])):
            if final and self.need[:, 0].sum() < self.limits[0]:
                size = 1 << (int(self.need[:, 0].sum()).bit_length() - 1)  # a power of two needs no padding
                yield self._fill(np.array([size, self.limits[1], self.limits[2]]))
            else:
                yield self._fill(self.limits.copy())

    def _fill(self, left: np.ndarray) -> list[tuple]:
        placed, taken = [], np.zeros(len(self.items), dtype=bool)
        cut: list[tuple] = []
        while left[0] >= 1 and left[1] >= 1 and not taken.all():
            score = (self.need / self.limits) @ (left / self.limits)
            fits = ~taken & (self.need <= left).all(axis=1)
            if fits.any():
                best = int(np.argmax(np.where(fits, score, -1.0)))
                placed.append(self.items[best])
                left = left - self.need[best]
                taken[best] = True
                continue
            best = int(np.argmax(np.where(taken, -1.0, score)))
            doc, start, length, loss = self.items[best]
            # Loss-bearing tokens come last in an example, so a cut takes those without loss first.
            size = int(min(length, left[0]))
            if loss - (length - size) > 0:
                size = int(min(size, length - loss + left[2]))
            if size < 1:
                break
            taken[best] = True
            used = max(0, size - (length - loss))
            placed.append((doc, start, size, used))
            left = left - np.array([size, 1, used])
            if size < length:
                cut.append((doc, start + size, length - size, loss - used))
        back = self._shorten(placed) if not taken.all() else []
        self.items = [x for x, t in zip(self.items, taken) if not t]
        self.need = self.need[~taken]
        self.add(cut + back)
        return placed

    @staticmethod
    def _shorten(placed: list[tuple]) -> list[tuple]:
        """Cut a sequence that another limit has closed early down to a power of two, which needs no padding; returns what is cut off."""
        over = (total := sum(p[2] for p in placed)) - (1 << total.bit_length() - 1)
        back = []
        while over and placed:
            doc, start, length, loss = placed.pop()
            kept = max(0, length - over)
            over -= length - kept
            later = min(loss, length - kept)  # loss-bearing tokens come last
            back.append((doc, start + kept, length - kept, later))
            if kept:
                placed.append((doc, start, kept, loss - later))
        return back


class ByteEncoder:
    """Ids of a byte-level BPE file, special tokens in the text recognised, none added."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.reference = Tokenizer.from_file(path)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = [b for b in range(256) if b in range(33, 127) or b in range(161, 173) or b in range(174, 256)]
        symbols = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        ranks = {bytes(symbols[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        # The fast encoder takes quadratic time for very long unbroken pieces; such texts go to the other.
        if len(text) > LONG_PIECE and max(map(len, text.split()), default=0) > LONG_PIECE:
            return np.array(self.reference.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, segments: int = SEGMENTS, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text", loss_col: str | None = None, loss_limit: int | None = None,
) -> DataFrame:
    """One row per piece of a document placed in a sequence; all ids of all documents are placed.

    A document is its ids and then ``end_id``; null text counts as empty and is that one id. ``loss_col`` says how
    many of a document's last ids bear loss (null or without the column: all; never more than there are), and a
    sequence holds at most ``loss_limit`` of them (without it: its capacity); rows then carry ``loss`` as well. A
    sequence that the limits on segments or loss close early is cut to a power of two. Each task packs what it reads, holds at most ``POOL`` pieces and leaves no more than a
    dozen sequences short of ``capacity``, each of a power of two. The sequence id is the task's number
    and a counter, so a task that runs again gives the same rows. Null ids and repeated rows are packed
    as documents of their own.
    """
    limit = loss_limit or capacity
    limits = (capacity, segments, limit)
    extra = ["loss"] if loss_col else []

    def run(batches):
        enc = byte_encoder(path)
        packer = Packer(limits)
        task = TaskContext.get().partitionId() << 33
        number = 0
        names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *extra]

        def emit(sequences):
            nonlocal number
            out = []
            for pieces in sequences:
                offset = 0
                for (doc, base, ids, total), start, length, loss in pieces:
                    crc = zlib.crc32(ids[start - base : start - base + length].tobytes())
                    out.append((doc, start, length, crc, total, task + number, offset, loss)[: len(names)])
                    offset += length
                number += 1
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names
                )

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            bearing = batch.column(2).to_pylist() if loss_col else [None] * batch.num_rows
            for doc, text, loss in zip(batch.column(0).to_pylist(), batch.column(1), bearing):
                ids = np.append(enc.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                total = len(ids)
                first = 0 if loss is None else total - min(max(loss, 0), total)  # the first id that bears loss
                for s in range(0, total, capacity):
                    size = min(capacity, total - s)
                    own = max(0, s + size - max(first, s))
                    # Pieces as long as a sequence are one by themselves; of a long text only the rest waits.
                    if size == capacity and own <= limit:
                        yield from emit([[((doc, 0, ids, total), s, size, own)]])
                    else:
                        packer.add([((doc, s, ids[s : s + size].copy(), total), s, size, own)])
                if len(packer.items) >= 2 * POOL:
                    yield from emit(packer.sequences())
        yield from emit(packer.sequences(final=True))

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"), *([F.col(loss_col).cast("long").alias("loss")] if loss_col else []))
    columns = f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(tidy(run), columns + ", loss long" * bool(loss_col))
