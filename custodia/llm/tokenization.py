"""BPE encoding and decoding by a tokenization automaton."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import tidy

CACHE = 200_000  # encoded chunks a worker remembers as new, and as many as old
PREFIX = 5  # characters by which the longest label is known
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else counted up from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b if b in plain else next(extra)) for b in range(256)]


class Automaton:
    """Deterministic automaton over tokens that accepts exactly the tokenizations that the merges make.

    It starts with one state and an arc for every single symbol. The gadget of a merge ``u v -> uv``,
    in order of rank: each state that has an arc ``u`` gets an arc ``uv`` to where ``v`` led after
    ``u``; the state behind ``u`` loses its arc ``v``. As every arc of a label leads to one state, the
    automaton is one row of allowed arcs per state. A label starts with the state of its right part, and
    states and arcs that were never told apart share a row or column until a merge separates them.
    """

    def __init__(self, symbols: list[str], merges: list[tuple[str, str]], ids: dict[str, int]):
        labels = {s: i for i, s in enumerate(dict.fromkeys(symbols))}
        state, arc = [0] * len(labels), [0] * len(labels)
        state_users, arc_users = [len(labels) + 1], [len(labels)]  # the start is one more user of state 0
        allowed = np.ones((1024, 1024), dtype=bool)
        for left, right in merges:
            u, v = labels[left], labels[right]
            if not allowed[state[u], arc[v]]:
                continue
            if left + right in labels:
                raise ValueError(f"two merges make {left + right!r}")
            if max(len(state_users), len(arc_users)) + 3 > len(allowed):
                grown = np.zeros((2 * len(allowed),) * 2, dtype=bool)
                grown[: len(allowed), : len(allowed)] = allowed
                allowed = grown
            m = labels[left + right] = len(labels)
            # Arc uv is allowed where u is; state of uv is the state of v.
            arc.append(arc[u])
            arc_users[arc[u]] += 1
            state.append(state[v])
            state_users[state[v]] += 1
            # Separate the state behind u, then arc v, and forbid the one after the other.
            if state_users[state[u]] > 1:
                state_users[state[u]] -= 1
                allowed[len(state_users)] = allowed[state[u]]
                state[u] = len(state_users)
                state_users.append(1)
            # If u = v, a run of u pairs from the left: uu keeps the state that u had, but not after u.
            for label in (v, m) if u == v else (v,):
                if arc_users[arc[label]] > 1:
                    arc_users[arc[label]] -= 1
                    allowed[:, len(arc_users)] = allowed[:, arc[label]]
                    arc[label] = len(arc_users)
                    arc_users.append(1)
                allowed[state[u], arc[label]] = False
        self.allowed = np.ascontiguousarray(allowed[: len(state_users), : len(arc_users)])
        self.rows = [row.tobytes() for row in self.allowed]
        self.text = list(labels)
        # label -> (state behind it, column of its arc, id)
        self.arcs = {s: (state[i], arc[i], ids[s]) for s, i in labels.items() if s in ids}
        self.reach: dict[str, int] = {}  # longest label by its first PREFIX characters, of those that have as many
        for s in self.arcs:
            if len(s) >= PREFIX:
                self.reach[s[:PREFIX]] = max(len(s), self.reach.get(s[:PREFIX], 0))

    def encode(self, text: str, size: int) -> list[int]:
        """Ids along the only path that spells ``text``: ``size`` symbols, the last with the end mark.

        The longest allowed arc is tried first; a dead end goes back to a shorter one. As just one path
        spells the whole text, the first that arrives is it.
        """
        arcs, rows, reach = self.arcs, self.rows, self.reach
        whole, last = len(text), size - 1
        at, row, tried = 0, rows[0], []
        stop = whole
        while at < whole:
            far = at + reach.get(text[at : at + PREFIX], PREFIX - 1)
            if stop == whole and far < whole:
                stop = min(last, far)
            while stop > at:
                found = arcs.get(text[at:stop])
                if found is not None and row[found[1]]:
                    break
                stop = last if stop == whole else stop - 1
                if stop > far:
                    stop = far
            else:
                at, stop, row, _ = tried.pop()  # dead end: a shorter arc at the place before
                stop = last if stop == whole else stop - 1
                continue
            tried.append((at, stop, row, found[2]))
            at, row, stop = stop, rows[found[0]], whole
        return [t[3] for t in tried]


class Encoder:
    """Whole texts to ids and back for a word-level BPE file: normalise, split, walk the automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.symbols = byte_symbols()
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        singles = [*self.symbols, *(s + self.end for s in self.symbols)]
        self.automaton = Automaton(singles, merges, model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.label = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern).findall
        self.printable = dict(enumerate(self.symbols))
        self.cache: dict[str, tuple[bytes, bytes]] = {}  # by chunk; when it is full it becomes the old one
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def _chunk(self, chunk: str) -> tuple[bytes, bytes]:
        """(ids, labels) of text without white space."""
        made = self.old.get(chunk)
        if made is None:
            if chunk.isalpha():
                made = self._pieces([chunk])
            elif chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":
                word, mark = (self.cache.get(x) or self._chunk(x) if x.isalpha() else self._pieces([x]) for x in (chunk[:-1], chunk[-1]))
                made = word[0] + mark[0], word[1] + b" " + mark[1]
            else:
                made = self._pieces(self.pieces(chunk))
        if len(chunk) <= 64:
            if len(self.cache) >= CACHE:
                self.old, self.cache = self.cache, {}
            self.cache[chunk] = made
        return made

    def _pieces(self, pieces: list[str]) -> tuple[bytes, bytes]:
        ids: list[int] = []
        for piece in pieces:
            word = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.printable)
            ids += self.automaton.encode(word + self.end, len(word))
        return np.array(ids, dtype="<u4").tobytes(), self.decode(ids).encode()

    @staticmethod
    def lower(text: str) -> str:
        low = text.lower()
        return "".join(c.lower() for c in text) if "Σ" in text else low

    def parts(self, text: str) -> Iterator[tuple[bytes, bytes]]:
        """(ids, decoded) of the non-empty parts of a text; the decoded parts are joined by one space."""
        for segment in self.split_special.split(text) if self.split_special else [text]:
            if segment in self.special:
                yield np.array([self.special[segment]], dtype="<u4").tobytes(), segment.encode()
                continue
            clean = self.lower(unicodedata.normalize("NFC", segment))
            if _ODD_SPACE.search(clean):  # separators that str.split takes for white space and the pattern does not
                chunks = regex.split(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+", clean)
            else:
                chunks = clean.split()
            for chunk in chunks:
                made = self.cache.get(chunk) or self._chunk(chunk)
                if made[0]:
                    yield made

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(ids for ids, _ in self.parts(text)), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined by one space."""
        return " ".join([self.label[i] for i in ids])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids as little-endian 32-bit integers, n_tokens, decoded text in UTF-8) of each row.

    Null text counts as empty and gives no tokens; a null id is kept; repeated rows give repeated rows.
    The file is read and compiled once per worker.
    """

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, decoded = [], []
                for text in part.column(1).to_pylist():
                    made = list(enc.parts(text or ""))
                    ids.append(b"".join([m[0] for m in made]))
                    decoded.append(b" ".join([m[1] for m in made]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(decoded, pa.binary())],
                    names=["id", "ids", "n_tokens", "decoded"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), f"id {kind}, ids binary, n_tokens long, decoded binary")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of ids and decoded text of each row, worked out where the rows are encoded."""

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            n, ids, decoded = [], [], []
            for text in batch.column(1):
                h, d = hashlib.sha256(), hashlib.sha256()
                made = list(enc.parts(text.as_py() or ""))
                joined = b"".join([m[0] for m in made])
                h.update(joined)
                d.update(b" ".join([m[1] for m in made]))
                n.append(len(joined) // 4)
                ids.append(h.hexdigest())
                decoded.append(d.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
