"""Ranked lexical search over a length-stratified index."""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import pack, steps, stored, tidy, unpack

K = 50
SEGMENT_POSTINGS = 1 << 17  # postings of one segment of the index; a document is never cut
BLOCK_PAIRS = 50_000  # (item, term) pairs that are searched for together
FIRST_VISIT = 256  # documents of the first strata visited; each further visit takes twice as many

# A term is a run of ASCII letters and digits and of bytes beyond ASCII; only ASCII letters are folded.
_FOLD = bytes(b if chr(b).isascii() and chr(b).isalnum() or b > 127 else 32 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def normaliser(lengths: np.ndarray, docs: int, words: int) -> np.ndarray:
    """m of each length; worked out in whole numbers of any size, once per length."""
    each, back = np.unique(lengths, return_inverse=True)
    return np.array([100 - 50 + 50 * int(n) * docs // words for n in each], dtype=np.int64)[back]


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


@dataclass
class Index:
    """Segments of documents, each whole in itself, and the totals that all of them share.

    A segment holds its documents in order of m, the strata (m and first document of each), and for each
    term its runs: the documents of one stratum in which the term occurs equally often, in order of
    stratum and occurrences. All but the ids is packed, as rows pass through the JVM several times, which
    holds a file's rows at once.
    """

    segments: DataFrame
    docs: int
    words: int


def _totals(docs: DataFrame) -> tuple[int, int]:
    def run(batches):
        n = words = 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                found = len(terms(text.as_py() or b""))
                n, words = n + (found > 0), words + found
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([words])], names=["n", "words"])

    row = docs.select("text").mapInArrow(tidy(run), "n long, words long").agg(F.sum("n"), F.sum("words")).first()
    return row[0] or 0, row[1] or 0


class _Builder:
    def __init__(self, docs: int, words: int, id_type: pa.DataType):
        self.totals, self.id_type = (docs, words), id_type
        self.clear()

    def clear(self) -> None:
        self.ids, self.lengths, self.sizes = [], [], []
        self.vocabulary: dict[bytes, int] = {}
        self.term, self.tf = array("i"), array("q")

    def add(self, doc, found: list[bytes]) -> None:
        counts = Counter(found)
        number = self.vocabulary.setdefault
        self.term.extend([number(t, len(self.vocabulary)) for t in counts])
        self.tf.extend(counts.values())
        self.ids.append(doc)
        self.lengths.append(len(found))
        self.sizes.append(len(counts))

    def segment(self) -> pa.RecordBatch:
        m = normaliser(np.array(self.lengths), *self.totals)
        by_m = np.argsort(m, kind="stable")
        strata, first = np.unique(m[by_m], return_index=True)
        place = np.empty(len(m), dtype=np.int64)
        place[by_m] = np.arange(len(m))
        doc = np.repeat(place, self.sizes)
        stratum = np.searchsorted(strata, m)[np.repeat(np.arange(len(m)), self.sizes)]
        term, tf = np.array(self.term, dtype=np.int64), np.array(self.tf, dtype=np.int64)
        order = np.lexsort((doc, tf, term * len(strata) + stratum))
        doc, stratum, term, tf = doc[order], stratum[order], term[order], tf[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1]) | (tf[1:] != tf[:-1])
        begin = np.flatnonzero(new)
        size = len(self.vocabulary)
        runs_of = np.searchsorted(term[begin], np.arange(size + 1))
        run_begin = np.append(begin, len(doc))
        columns = [
            pa.array([zstandard.ZstdCompressor(level=1).compress(b" ".join(self.vocabulary))], pa.binary()),  # no term has a space
            pa.array([pack(np.bincount(term, minlength=size))], pa.binary()),
            pa.array([[self.ids[i] for i in by_m]], pa.list_(self.id_type)),
            pa.array([pack(strata, *(steps(x) for x in (np.append(first, len(m)), runs_of, run_begin)), stratum[begin], tf[begin], doc)], pa.binary()),
        ]
        self.clear()
        return pa.RecordBatch.from_arrays(columns, names=_COLUMNS)


def _terms_of(segment: pa.Scalar) -> pa.Array:
    return pa.array(zstandard.ZstdDecompressor().decompress(segment.as_py()).split(b" "), pa.binary())


_COLUMNS = ["terms", "df", "docs", "runs"]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index of all documents with at least one term.

    One pass counts documents and terms, which fix every document's m; the second writes the segments.
    Each task makes segments of what it reads, so nothing is shuffled and no term, however common, gathers
    anywhere. Null and empty texts have no terms; repeated rows are documents of their own; a null id is
    kept. Memory is bounded by a segment and the longest text.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    n, words = _totals(rows)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        made = None
        for batch in batches:
            made = made or _Builder(n, words, batch.schema.field(0).type)
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                found = terms(text.as_py() or b"")
                if found:
                    made.add(doc, found)
                    if len(made.term) >= SEGMENT_POSTINGS:
                        yield made.segment()
        if made and made.ids:
            yield made.segment()

    schema = f"terms binary, df binary, docs array<{kind}>, runs binary"
    return Index(stored(rows.mapInArrow(tidy(run), schema)), n, words)


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    size = end - begin
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)


class Searcher:
    """The best documents of each item over the segments of one task.

    For a segment, impacts are worked out once for each run of a wanted term. The bound of a stratum is the
    sum over the item's terms of the largest impact there. Strata are visited in order of their bounds,
    ever more at a time, and no more once the bound is below the item's k-th score so far.
    """

    def __init__(self, items: list, words: list[str], weights: list[int], pairs: tuple[np.ndarray, np.ndarray], k: int):
        self.items, self.k = items, k
        self.words, self.weights = pa.array(words, pa.string()).cast(pa.binary()), np.array(weights, dtype=np.int64)
        order = np.argsort(pairs[0], kind="stable")
        self.of_item = np.split(pairs[1][order], np.searchsorted(pairs[0][order], np.arange(1, len(items))))
        self.best: list[list[tuple]] = [[] for _ in items]

    def visit(self, row: dict) -> None:
        local = pc.index_in(self.words, value_set=_terms_of(row["terms"]))
        at = pc.fill_null(local, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        here = at >= 0
        if not here.any():
            return
        m, first, runs_of, begin, stratum, tf, posts = unpack(row["runs"].as_py())
        m, first, runs_of, begin = m.astype(np.int64), *(np.cumsum(x, dtype=np.int64) for x in (first, runs_of, begin))
        low, high = np.where(here, runs_of[at], 0), np.where(here, runs_of[at + 1], 0)
        # Runs of all wanted terms, and where those of each term lie among them.
        runs = _ranges(low, high)
        to = np.cumsum(high - low)
        since = to - (high - low)
        stratum, tf = stratum[runs].astype(np.int64), tf[runs].astype(np.int64)
        begin, end = begin[runs], begin[runs + 1]
        score = impact(tf, m[stratum]) * np.repeat(self.weights, high - low)
        # The last run of a term in a stratum has most occurrences, so the largest impact.
        last = np.ones(len(runs), dtype=bool)
        last[:-1] = stratum[1:] != stratum[:-1]
        last[to[here] - 1] = True
        sizes = np.diff(first)
        docs = row["docs"].values
        for item, wanted in enumerate(self.of_item):
            wanted = wanted[here[wanted]]
            if not len(wanted):
                continue
            own = _ranges(since[wanted], to[wanted])
            top = own[last[own]]
            bound = np.bincount(stratum[top], weights=score[top], minlength=len(m)).astype(np.int64)
            order = np.argsort(-bound, kind="stable")
            order = order[: np.count_nonzero(bound)]
            seen = np.cumsum(sizes[order])
            done, step = 0, max(FIRST_VISIT, 2 * self.k)
            turn = np.full(len(m), -1)
            while done < len(order):
                least = self.best[item][-1][0] if len(self.best[item]) == self.k else 1
                if bound[order[done]] < least:
                    break
                upto = max(done + 1, int(np.searchsorted(seen, (seen[done - 1] if done else 0) + step)))
                turn[order[done:upto]] = done
                now = own[turn[stratum[own]] == done]
                who = posts[_ranges(begin[now], end[now])]
                got = np.bincount(who, weights=np.repeat(score[now], end[now] - begin[now]), minlength=len(docs)).astype(np.int64)
                self._offer(item, docs, got, least)
                done, step = upto, 2 * step

    def _offer(self, item: int, docs: pa.Array, got: np.ndarray, least: int) -> None:
        good = np.flatnonzero(got >= max(least, 1))
        if len(good) > self.k:  # none below the k-th of these can be among the best
            good = good[got[good] >= np.partition(got[good], -self.k)[-self.k]]
        if len(good):
            found = list(zip(got[good].tolist(), docs.take(pa.array(good)).to_pylist()))
            self.best[item] = sorted(self.best[item] + found, key=lambda x: (-x[0], x[1] is None, x[1]))[: self.k]

    def rows(self) -> Iterator[tuple]:
        for item, best in zip(self.items, self.best):
            for score, doc in best:
                yield item, doc, score


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, term) of the queries."""

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                found = sorted(set(terms(batch.column(1)[at].as_py() or b"")))
                items = pa.array([0] * len(found), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[at]], batch.schema.field(0).type).take(items), pa.array([t.decode() for t in found], pa.string())], names=["item", "term"])

    kind = queries.schema[id_col].dataType.simpleString()
    rows = queries.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(tidy(run), f"item {kind}, term string").distinct()


def search(index: Index, queries: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """(item, rank, document, score) of the k highest-scoring documents of each item, those with a score above 0.

    Equal scores go by ascending document id, null last. Rows of one item id are one item with the terms of
    all of them; an item without terms, or whose terms no document holds, has no rows. Items are searched for in blocks of
    about ``BLOCK_PAIRS`` terms, each sent to all tasks; every task returns its own k best per item.
    """
    spark = queries.sparkSession
    pairs = stored(query_terms(queries, id_col, text_col))
    blocks = max(1, -(-pairs.count() // BLOCK_PAIRS))
    fields = {f.name: f.dataType.simpleString() for f in pairs.schema.fields}
    kind = index.segments.schema["docs"].dataType.elementType.simpleString()
    results = []
    for block in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        if not mine.num_rows:
            continue
        named = mine["item"].combine_chunks().dictionary_encode(null_encoding="encode")
        coded = mine["term"].combine_chunks().dictionary_encode()
        words = coded.dictionary.to_pylist()
        sent = spark.sparkContext.broadcast(words)

        def count(batches, sent=sent):
            wanted = pa.array(sent.value, pa.string()).cast(pa.binary())
            total = np.zeros(len(wanted), dtype=np.int64)
            for batch in batches:
                for at in range(batch.num_rows):
                    found = pc.index_in(wanted, value_set=_terms_of(batch.column(0)[at]))
                    place = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)
                    df = unpack(batch.column(1)[at].as_py())[0]
                    total += np.where(place >= 0, df[place], 0).astype(np.int64)
            held = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

        # As many rows as the block has terms.
        counted = index.segments.select("terms", "df").mapInArrow(tidy(count), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        df = {r["term"]: r["df"] for r in counted.collect()}
        weights = [weight(index.docs, df.get(i, 0)) for i in range(len(words))]
        state = spark.sparkContext.broadcast((named.dictionary.to_pylist(), weights, named.indices.to_numpy(), coded.indices.to_numpy()))

        def find(batches, sent=sent, state=state):
            names, weights, owner, term = state.value
            searcher, kinds = Searcher(names, sent.value, weights, (owner, term), k), None
            for batch in batches:
                kinds = batch.schema.field("docs").type.value_type
                for at in range(batch.num_rows):
                    searcher.visit({c: batch.column(c)[at] for c in batch.schema.names})
            out = list(searcher.rows())
            if out:
                got = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1], kinds), pa.array(got[2], pa.int64())], names=["item", "doc", "score"])

        results.append(index.segments.mapInArrow(tidy(find), f"item {fields['item']}, doc {kind}, score long"))
    found = spark.createDataFrame([], f"item {fields['item']}, doc {kind}, score long")
    for more in results:
        found = found.unionAll(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("item").alias(id_col), "rank", F.col("doc").alias(doc_col), "score"
    )
