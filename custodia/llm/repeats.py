"""Repeated passages: breadth-first backward extension on a Burrows-Wheeler transform, bounded by a threshold."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import CHUNK_BYTES, mix, prefix_hashes, stored, text_chunks, tidy, whole_groups

LENGTH = 200  # bytes of a passage
ANCHOR = 100  # bytes of the string that names a passage's group
SEED = 16  # length of the strings that the search starts from
BATCH = 1 << 20  # most bytes of one transform of contexts, whose length is 300 at most, unless an anchor has more
HOT = 8192  # different contexts of an anchor beyond which its windows are counted one by one
FILTER_BITS = 1 << 28  # at most, of the texts that the search of contexts asks for
_END = 0xFF  # never a byte of UTF-8, and last in order
_POSITION = np.uint64(34)  # bits of a position in a text


def transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, seed rank) by prefix doubling, in order of the first 256 bytes; ends compare last."""
    n = len(text)
    padded = np.full(n + 8, _END, dtype=np.uint64)
    padded[:n] = text
    key = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : n + i]
    seed = np.zeros(0, np.int64)
    span = 8
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.ones(n, dtype=bool)
        new[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new) - 1
        if span == SEED:
            seed = rank
        if span >= 256 or new.all():
            return order, seed if len(seed) else rank
        after = np.full(n, n, dtype=np.int64)
        after[: max(0, n - span)] = rank[span:]
        key = (rank * (n + 1) + after).view(np.uint64)
        span *= 2


def repeated_starts(text: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Marks the positions of ``text`` at which a string of ``length`` bytes without an end begins that also
    begins elsewhere.

    The intervals of the transform that hold the strings of SEED bytes are extended to the left, one byte
    at a time. A string's interval that ends where no common prefix is known yet fixes the common prefix
    there: one byte less than the string. Only such intervals go on. So the common prefixes come up by
    increasing value, and when they have reached ``length`` the search stops: places still unknown have longer ones.
    """
    n = len(text)
    marks = np.zeros(n, dtype=bool)
    if n < 2:
        return marks
    order, seed = transform(text)
    before = text[order - 1]  # the transform; the first text has an end before it, as the last byte is one
    known = np.zeros(n + 1, dtype=bool)  # whether the common prefix of places i - 1 and i is below length
    ranks = seed[order]
    known[1:n] = ranks[1:] != ranks[:-1]
    known[0] = known[n] = True
    # Place of the suffix one byte longer.
    step = np.empty(n, dtype=np.int64)
    step[np.argsort(before, kind="stable")] = np.arange(n)
    begins = np.flatnonzero(known[:n])
    ends = np.append(begins[1:], n)
    for _ in range(SEED, length):
        size = ends - begins
        total = int(size.sum())
        if not total:
            break
        owner = np.repeat(np.arange(len(begins)), size)
        at = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begins, size)
        byte = before[at]
        # First and last place of each byte in each interval.
        by = np.argsort(owner * 256 + byte, kind="stable")
        owner, byte, at = owner[by], byte[by], at[by]
        first = np.ones(total, dtype=bool)
        first[1:] = (owner[1:] != owner[:-1]) | (byte[1:] != byte[:-1])
        last = np.append(first[1:], True)
        use = byte[first] != _END
        low, high = step[at[first]][use], step[at[last]][use] + 1
        fresh = ~known[high]
        low, high = low[fresh], high[fresh]
        high, index = np.unique(high, return_index=True)
        begins, ends = low[index], high
        known[ends] = True
    long = ~known
    long[1:n] &= True
    inside = np.flatnonzero(long[:n])
    marks[order[inside]] = True
    marks[order[inside - 1]] = True
    # Only strings that end within their text count.
    stops = np.flatnonzero(text == _END)
    room = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n) if len(stops) else np.zeros(n)
    return marks & (room >= length)


def _anchors(data: np.ndarray, offsets: np.ndarray):
    """Runs of windows with the same anchor: (row, first start, length of the run, anchor name, context name).

    The anchor of a window is its string of ANCHOR bytes with the least hash, the leftmost of equals; it
    depends on the window's bytes alone, so equal windows have equal anchors at equal places.
    """
    n, wide = len(data), LENGTH - ANCHOR + 1
    sums, down = prefix_hashes(data)
    if n < LENGTH:
        return None
    grams = n - ANCHOR + 1
    name = mix((sums[ANCHOR:] - sums[:grams]) * down[:grams], 0x1F83D9ABFB41BD6B)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = (np.arange(n) - offsets[:-1][row]).astype(np.uint64)
    value = ((name >> _POSITION) << _POSITION) | place[:grams]
    value[row[:grams] != row[ANCHOR - 1 :]] = np.uint64(2**64 - 1)
    # Least value of each window from the least ones before and after the borders of blocks.
    size = -(-grams // wide) * wide + wide
    padded = np.full(size, 2**64 - 1, dtype=np.uint64)
    padded[:grams] = value
    blocks = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - LENGTH + 1
    least = np.minimum(back[:windows], ahead[wide - 1 : wide - 1 + windows])
    valid = row[:windows] == row[LENGTH - 1 :]
    at = np.flatnonzero(valid)
    if not len(at):
        return None
    least = least[at] & np.uint64((1 << 34) - 1)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (row[at[1:]] != row[at[:-1]])
    begin = np.flatnonzero(new)
    a, b = at[begin], at[np.append(begin[1:], len(at)) - 1]
    anchor = name[offsets[:-1][row[a]] + least[begin].astype(np.int64)]
    context = mix((sums[b + LENGTH] - sums[a]) * down[a], 0x5BE0CD19137E2179) ^ (b - a).astype(np.uint64)
    return row[a], place[a].astype(np.int64), b - a, anchor, context


_PLACE = np.dtype([("serial", "<i8"), ("start", "<i4"), ("run", "<i4")])


def _opened(batch: pa.RecordBatch):
    """(serials, bytes, offsets) of consecutive compressed texts with about ``text_chunks``' bytes in all."""
    open_ = zstandard.ZstdDecompressor()
    serials, packed = batch.column(0).to_numpy(), batch.column(1)
    first, held, size = 0, [], 0
    for i in range(len(packed)):
        held.append(open_.decompress(packed[i].as_py()))
        size += len(held[-1])
        if size >= CHUNK_BYTES or i + 1 == len(packed):
            for a, b, data, offsets in text_chunks(pa.array(held, pa.large_binary())):
                yield serials[first + a : first + b], data, offsets
            first, held, size = i + 1, [], 0


def _occurrences(texts: DataFrame) -> DataFrame:
    """(anchor, context, places) of the texts (serial, packed): places of one anchor and context within a chunk are
    one row. Texts are opened by the worker that reads them, chunk by chunk."""

    def run(batches):
        for batch in batches:
            for serials, data, offsets in _opened(batch):
                found = _anchors(data, offsets)
                if found is None:
                    continue
                row, start, length, anchor, context = found
                serial = serials[row]
                order = np.lexsort((context, anchor))
                places = np.empty(len(order), dtype=_PLACE)
                places["serial"], places["start"], places["run"] = serial[order], start[order], length[order]
                anchor, context = anchor[order], context[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])
                cuts = np.append(np.flatnonzero(new), len(order)) * _PLACE.itemsize
                blobs = pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(places.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), pa.array(context[new].view(np.int64)), blobs], names=["anchor", "context", "places"])

    return texts.mapInArrow(tidy(run), "anchor long, context long, places binary")


def _decide(occurrences: DataFrame) -> DataFrame:
    """Two kinds of rows. ``places`` set: all windows there are repeated. Else one place of each context of an
    anchor with several contexts, ``alone`` if it is the context's only one.

    Reads each anchor's rows in order of the context and holds one row at a time, so no group is gathered.
    """

    def run(batches):
        held = None  # (anchor, context, places) of the last row; whether its context came before, and its anchor
        again = other = False

        def close(anchor, context, places, again, more_contexts, whole, single):
            """The end of a context's rows."""
            count = len(places) // _PLACE.itemsize
            if again or count > 1:
                whole.append((anchor, places))
            if more_contexts:
                place = np.frombuffer(places[: _PLACE.itemsize], dtype=_PLACE)[0]
                single.append((anchor, int(place["serial"]), int(place["start"]), int(place["run"]), not again and count == 1))

        def emit(whole, single):
            columns = [
                pa.array([w[0] for w in whole] + [s[0] for s in single], pa.int64()),
                pa.array([w[1] for w in whole] + [None] * len(single), pa.binary()),
                *(pa.array([None] * len(whole) + [s[k] for s in single], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.int64()), (4, pa.bool_()))),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["anchor", "places", "serial", "start", "run", "alone"])

        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, context = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            count = pc.binary_length(batch.column(2)).to_numpy() // _PLACE.itemsize
            # Rows whose anchor stands neither before nor after them, with one place, are of no interest.
            same_before = np.empty(len(anchor), dtype=bool)
            same_before[1:] = anchor[1:] == anchor[:-1]
            same_before[0] = held is not None and held[0] == anchor[0]
            same_after = np.append(same_before[1:], True)
            keep = np.flatnonzero(same_before | same_after | (count > 1))
            places = batch.column(2)
            whole, single = [], []
            for i in keep:
                row = (int(anchor[i]), int(context[i]), places[int(i)].as_py())
                if held is not None:
                    if held[:2] == row[:2]:
                        whole.append((held[0], held[2]))  # another row of the context follows
                        again, held = True, row
                        continue
                    same = held[0] == row[0]
                    close(*held, again, other or same, whole, single)
                    other = same
                else:
                    other = False
                held, again = row, False
            if whole or single:
                yield emit(whole, single)
        if held is not None:
            whole, single = [], []
            close(*held, again, other, whole, single)
            if whole or single:
                yield emit(whole, single)

    ordered = occurrences.repartition("anchor").sortWithinPartitions("anchor", "context")
    return ordered.mapInArrow(tidy(run), "anchor long, places binary, serial long, start long, run long, alone boolean")


_RANGES = "serial long, start long, run long"


def _ranges(serial, start, run) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, dtype=np.int64)) for x in (serial, start, run)], names=["serial", "start", "run"])


def _whole(decided: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            places = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=_PLACE)
            yield _ranges(places["serial"], places["start"], places["run"])

    return decided.where("places IS NOT NULL").select("places").mapInArrow(tidy(run), _RANGES)


def _search(contexts: DataFrame) -> DataFrame:
    """Ranges of repeated starts of the contexts (anchor, serial, start, run, alone, bytes)."""

    def solve(table: pa.Table):
        blobs = table["bytes"].to_pylist()
        text = np.frombuffer(b"\xff".join(blobs) + b"\xff", dtype=np.uint8)
        marks = repeated_starts(text)
        sizes = np.array([len(b) for b in blobs]) + 1
        begin = np.cumsum(sizes) - sizes
        alone = np.repeat(table["alone"].to_numpy(), sizes)
        at = np.flatnonzero(marks & alone)
        if not len(at):
            return None
        row = np.searchsorted(begin, at, side="right") - 1
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        r = row[first]
        return _ranges(table["serial"].to_numpy()[r], table["start"].to_numpy()[r] + at[first] - begin[r], at[last] - at[first])

    def run(batches):
        for table in whole_groups(batches, "anchor", rows=BATCH // 512):
            made = solve(table)
            if made is not None:
                yield made

    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(tidy(run), _RANGES)


def _count_windows(contexts: DataFrame) -> DataFrame:
    """The exact way for anchors of very many contexts: names of their windows are counted in the shuffle."""

    def run(batches):
        for batch in batches:
            for serial, start, alone, blob in zip(*(batch.column(k).to_pylist() for k in range(4))):
                n = len(blob) - LENGTH + 1
                names = [hashlib.blake2b(blob[i : i + LENGTH], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array([serial] * n, pa.int64()), pa.array(range(start, start + n), pa.int64()), pa.array([alone] * n, pa.bool_())],
                    names=["name", "serial", "start", "alone"],
                )

    windows = contexts.select("serial", "start", "alone", "bytes").mapInArrow(tidy(run), "name binary, serial long, start long, alone boolean")
    often = windows.groupBy("name").agg(F.count("*").alias("n")).where("n > 1")
    return windows.where("alone").join(often, "name", "left_semi").select("serial", "start", F.lit(0).cast("long").alias("run"))


def _asked(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """The texts whose serial is in ``asked``, and a few more, found without a shuffle of the texts.

    The tasks hold the hashes of the serials as bits, 8 or more a serial as long as FILTER_BITS are enough.
    """
    spark = texts.sparkSession
    number = asked.agg(F.approx_count_distinct("serial")).first()[0]
    size = min(FILTER_BITS, max(1 << 15, 1 << (12 * number).bit_length()))
    place = F.pmod(F.xxhash64("serial"), F.lit(size))
    blocks = asked.select(place.alias("place")).groupBy(F.expr("place div 32768").alias("block")).agg(F.expr("bitmap_construct_agg(place % 32768)").alias("bits"))
    bits = np.zeros(size >> 3, dtype=np.uint8)
    for row in blocks.toLocalIterator():
        bits[row["block"] * 4096 : row["block"] * 4096 + 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    shared = spark.sparkContext.broadcast(bits)  # bounded by FILTER_BITS

    @F.pandas_udf("boolean")
    def found(place: pd.Series) -> pd.Series:
        at = place.to_numpy()
        return pd.Series((shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0)

    return texts.where(found(place))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256; with ``keep_text`` also kept_text,
    and the columns named in ``carry``.

    Removes every byte covered by a string of LENGTH bytes of UTF-8 that also starts anywhere else in the
    texts, the same text included, judged on the input. Null text is empty (kept_text then null). Repeated
    rows are texts of their own, so each makes the other's passages repeated. Null ids stay rows. ``kept_text``
    drops what a cut leaves of a character at either side.

    Windows of LENGTH bytes are grouped by their anchor. Equal contexts settle most groups by name alone;
    contexts that differ go through the transform, many groups at a time.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def number(batches):
        serial = TaskContext.get().partitionId() << 33
        for batch in batches:
            pack = zstandard.ZstdCompressor(level=1)
            packed = [None if t is None else pack.compress(t.encode()) for t in batch.column(1).to_pylist()]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(serial, serial + n)), batch.column(0), pa.array(packed, pa.binary()), *batch.columns[2:]],
                names=["serial", "id", "packed", *held],
            )
            serial += n

    held = [f"carry_{i}" for i in range(len(carry))]
    carried = "".join(f", {h} {docs.schema[c].dataType.simpleString()}" for h, c in zip(held, carry))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(h) for h, c in zip(held, carry))
    )
    texts = stored(rows.mapInArrow(tidy(number), f"serial long, id {kind}, packed binary{carried}"))

    decided = stored(_decide(_occurrences(texts.where("packed IS NOT NULL").select("serial", "packed"))))
    singles = decided.where("places IS NULL")
    # All contexts of one text are cut from it at once.
    wanted = singles.groupBy("serial").agg(F.collect_list(F.struct("anchor", "start", "run", "alone")).alias("cuts"))

    def cut(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for serial, packed, cuts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = open_.decompress(packed.as_py())
                out += [(c["anchor"], serial, c["start"], c["run"], c["alone"], data[c["start"] : c["start"] + c["run"] + LENGTH]) for c in cuts]
                if len(out) > 20_000:
                    yield contexts_batch(out)
                    out = []
            if out:
                yield contexts_batch(out)

    def contexts_batch(out):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["anchor", "serial", "start", "run", "alone", "bytes"])

    contexts = _asked(texts.select("serial", "packed"), singles.select("serial")).join(wanted, "serial").mapInArrow(tidy(cut), "anchor long, serial long, start long, run long, alone boolean, bytes binary")
    hot = stored(singles.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("anchor"))
    ranges = _whole(decided)
    if hot.isEmpty():
        ranges = ranges.union(_search(contexts))
    else:
        ranges = ranges.union(_search(contexts.join(hot, "anchor", "left_anti"))).union(_count_windows(contexts.join(hot, "anchor", "left_semi")))
    marked = ranges.groupBy("serial").agg(F.collect_list(F.struct("start", "run")).alias("ranges"))

    def finish(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for packed, ranges in zip(batch.column(1), batch.column(2)):
                packed = packed.as_py()
                data = b"" if packed is None else open_.decompress(packed)
                kept, removed, spans = data, 0, 0
                if ranges.is_valid:
                    fields = ranges.values
                    start, run = fields.field("start").to_numpy(), fields.field("run").to_numpy()
                    change = np.zeros(len(data) + 1, dtype=np.int32)
                    np.add.at(change, start, 1)
                    np.add.at(change, np.minimum(start + run + LENGTH, len(data)), -1)
                    gone = np.cumsum(change[:-1]) > 0
                    kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                    removed = int(gone.sum())
                    spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
                for column, value in zip(columns, (len(data), removed, spans, hashlib.sha256(kept).hexdigest(), None if packed is None or not keep_text else kept.decode(errors="ignore"))):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)][: 5 if keep_text else 4]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, *batch.columns[3:]], names=["id", *names, *held])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"][: 5 if keep_text else 4]
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if keep_text else "")
    joined = texts.join(marked, "serial", "left").select("id", "packed", "ranges", *held)
    done = joined.mapInArrow(tidy(finish), schema + carried)
    return done.select(F.col("id").alias(id_col), *names, *(F.col(h).alias(c) for h, c in zip(held, carry)))
