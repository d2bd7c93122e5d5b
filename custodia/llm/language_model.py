"""Gated recurrent language model in numpy: trained by truncated backpropagation, scored over whole texts."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import by_group, stored, tidy

END = b"\n"  # the end token; no word contains white space
HEAD_WORDS = 1023  # words with outputs of their own, besides the end
CLASS_WORDS = 64
KNOWN_WORDS = 200_000  # words whose counts every task holds; the counts of all others are joined
HIDDEN = 16
WINDOW = 16  # steps of truncated backpropagation
LANES = 512  # texts that a task reads side by side
SCORE_LANES = 192
SCORE_WINDOW = 64  # steps whose outputs are worked out together
RATE = 0.01
COUNT_ENTRIES = 500_000  # distinct words a task holds before it passes their counts on
BUFFER_TOKENS = 4_000_000  # ids a task holds to fill its lanes evenly: however many, it goes on as long as its longest text
TAILS = 4  # classes of all other words: by a non-ASCII byte and by final punctuation
_PUNCTUATION = tuple(b".,;:!?")


def tokens(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 in lower case (A-Z only), split at ASCII white space, then the end."""
    made = (text or b"").lower().split()
    made.append(END)
    return made


def _softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials, their sums by row), in place; shifted by the maximum only where that is needed."""
    made = np.exp(logits)
    total = made @ np.ones(made.shape[1], dtype=np.float32)
    if not (np.isfinite(total).all() and total.min() > 1e-30):
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=made)
        total = made.sum(axis=1)
    return made, total


def tail_class(word: bytes) -> int:
    return (not word.isascii()) * 2 + (word[-1] in _PUNCTUATION)


@dataclass
class Vocabulary:
    """Counts of the training tokens: of frequent words here, of the others in the table they came from."""

    counts: dict[bytes, int]  # of KNOWN_WORDS words at most
    total: int
    distinct: int
    tail_total: np.ndarray  # by tail class: tokens and words outside the head
    tail_distinct: np.ndarray
    head: list[bytes]
    ids: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self):
        """Ids: head words, then the tail classes; words that are not known have none."""
        self.ids = {w: len(self.head) + tail_class(w) for w in self.counts} | {w: i for i, w in enumerate(self.head)}

    @property
    def size(self) -> int:
        return len(self.head)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the column ``text``; a task passes its counts on whenever it holds COUNT_ENTRIES words."""

    def run(batches):
        counts: Counter = Counter()

        def emit():
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                counts.update(tokens(text.as_py()))
                if len(counts) > COUNT_ENTRIES:
                    yield emit()
        yield emit()

    return docs.select("text").mapInArrow(tidy(run), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, head_words: int = HEAD_WORDS, known_words: int = KNOWN_WORDS) -> Vocabulary:
    """Totals of all words, and the counts of the most frequent, as many as share no count with one left out."""
    # The least count that at most ``known_words`` words reach, from their numbers by powers of 1.02.
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.02))).cast("int")
    steps = {r["step"]: r["v"] for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("v")).collect()}
    least, reached = max(steps, default=0) + 1, 0
    for k in sorted(steps, reverse=True):
        reached += steps[k]
        if reached > known_words:
            break
        least = k
    top = counts.where(step >= least).collect()
    known = {w: n for w, n in sorted(((bytes(r["word"]), r["n"]) for r in top), key=lambda x: (-x[1], x[0]))}
    head = [w for w in known if w != END][:head_words]
    head.insert(0, END)
    ascii_only = F.octet_length("word") == F.char_length(F.col("word").cast("string"))
    last = F.expr("substring(word, octet_length(word), 1)")
    tail = F.when(ascii_only, 0).otherwise(2) + last.isin([bytes([b]) for b in _PUNCTUATION]).cast("int")
    sums = {r["tail"]: r for r in counts.groupBy(tail.alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    n = np.array([sums[k]["n"] if k in sums else 0 for k in range(TAILS)], dtype=np.float64)
    v = np.array([sums[k]["v"] if k in sums else 0 for k in range(TAILS)], dtype=np.float64)
    total, distinct = int(n.sum()), int(v.sum())
    for w in head:
        if w in known:
            n[tail_class(w)] -= known[w]
            v[tail_class(w)] -= 1
    return Vocabulary(known, total, distinct, n, v, head)


class Network:
    """Gated recurrent units; the output is a class and then a word of the class.

    Inputs are head words and tail classes by id, and one begin. Classes: head words in order of
    frequency by CLASS_WORDS, then the tail classes, whose words follow their counts. Parameters live in
    one flat vector, so that workers' parameters can be averaged.
    """

    def __init__(self, vocab: Vocabulary, hidden: int = HIDDEN, seed: int = 7):
        self.hidden, self.heads = hidden, vocab.size
        self.inputs = self.heads + TAILS + 1
        self.head_classes = -(-self.heads // CLASS_WORDS)
        self.classes = self.head_classes + TAILS
        self.class_of = np.concatenate([np.arange(self.heads) // CLASS_WORDS, self.head_classes + np.arange(TAILS)])
        shapes = {
            "E": (self.inputs, 3 * hidden), "W": (hidden, 3 * hidden), "C": (hidden, self.classes), "c": (self.classes,),
            "U": (self.head_classes * CLASS_WORDS, hidden), "u": (self.head_classes * CLASS_WORDS,),
        }
        sizes = {k: int(np.prod(s)) for k, s in shapes.items()}
        self.flat = np.zeros(sum(sizes.values()), dtype=np.float32)
        self.slices, at = {}, 0
        for k, s in shapes.items():
            self.slices[k] = (at, at + sizes[k], s)
            at += sizes[k]
        rng = np.random.default_rng(seed)
        p = self.views(self.flat)
        p["E"][:] = rng.normal(0, 0.3, p["E"].shape)
        p["W"][:] = rng.normal(0, 1 / np.sqrt(hidden), p["W"].shape)
        p["C"][:] = rng.normal(0, 0.1, p["C"].shape)
        p["U"][:] = rng.normal(0, 0.1, p["U"].shape)
        # Biases start at the counts.
        head = np.array([vocab.counts.get(w, 0) + 1.0 for w in vocab.head])
        padded = np.zeros(self.head_classes * CLASS_WORDS)
        padded[: self.heads] = head
        by_class = np.concatenate([padded.reshape(-1, CLASS_WORDS).sum(1), vocab.tail_total + vocab.tail_distinct + 1])
        p["c"][:] = np.log(by_class / by_class.sum())
        with np.errstate(divide="ignore"):
            p["u"][:] = np.maximum(np.log(padded / padded.reshape(-1, CLASS_WORDS).sum(1).repeat(CLASS_WORDS)), -30)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        return {k: flat[a:b].reshape(s) for k, (a, b, s) in self.slices.items()}

    def forward(self, p: dict, h: np.ndarray, x: np.ndarray, first: np.ndarray, keep: bool) -> tuple[np.ndarray, tuple]:
        """Hidden states after each step of a window, from state ``h``; ``first`` marks begins of texts."""
        H, (T, L) = self.hidden, x.shape
        out = np.empty((T, L, H), dtype=np.float32)
        rows = T if keep else 1  # steps whose gates are kept for the way back
        before, gates, news, pushed = (np.empty((rows, L, k * H), dtype=np.float32) for k in (1, 2, 1, 3))
        a, W = p["E"][x], p["W"].copy()
        a[:, :, : 2 * H] *= np.float32(0.5)
        W[:, : 2 * H] *= np.float32(0.5)
        begins = first.any(axis=1)
        for t in range(T):
            if begins[t]:
                h = h * ~first[t][:, None]
            k = t if keep else 0
            g, gate, n, made = pushed[k], gates[k], news[k], out[t]
            if keep:
                before[k] = h
            np.matmul(h, W, out=g)
            np.add(a[t, :, : 2 * H], g[:, : 2 * H], out=gate)
            np.tanh(gate, out=gate)
            gate += np.float32(1)
            gate *= np.float32(0.5)
            np.multiply(gate[:, H:], g[:, 2 * H :], out=n)
            n += a[t, :, 2 * H :]
            np.tanh(n, out=n)
            np.subtract(h, n, out=made)
            made *= gate[:, :H]
            made += n
            h = made
        return out, (before, gates, news, pushed[:, :, 2 * H :], ~first)

    def output(self, p: dict, h: np.ndarray, y: np.ndarray, grad: dict | None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of the targets ``y`` (of tail words: of their class); gradients into ``grad``."""
        c = self.class_of[y]
        rows = np.arange(len(y))
        logits = h @ p["C"] + p["c"]
        made, total = _softmax(logits)  # may shift the logits
        score = logits[rows, c] - np.log(total)
        dh = None
        if grad is not None:
            logits = np.divide(made, total[:, None], out=made)
            logits[rows, c] -= 1
            grad["C"] += h.T @ logits
            grad["c"] += logits.sum(axis=0)
            dh = logits @ p["C"].T
        order = np.argsort(c, kind="stable")
        bounds = np.searchsorted(c[order], np.arange(self.head_classes + 1))
        for k in range(self.head_classes):
            at = order[bounds[k] : bounds[k + 1]]
            if not len(at):
                continue
            s = slice(k * CLASS_WORDS, (k + 1) * CLASS_WORDS)
            hk, target, own = h[at], y[at] - k * CLASS_WORDS, np.arange(len(at))
            inner = hk @ p["U"][s].T + p["u"][s]
            made, total = _softmax(inner)
            score[at] += inner[own, target] - np.log(total)
            if grad is not None:
                inner = np.divide(made, total[:, None], out=made)
                inner[own, target] -= 1
                grad["U"][s] += inner.T @ hk
                grad["u"][s] += inner.sum(axis=0)
                dh[at] += inner @ p["U"][s]
        return score, dh

    def backward(self, p: dict, steps: tuple, x: np.ndarray, dout: np.ndarray, grad: dict) -> None:
        """Truncated at the window: nothing flows into the state before it."""
        H, (T, L) = self.hidden, x.shape
        before, gates, n, g, live = steps
        z, r = gates[:, :, :H], gates[:, :, H:]
        new = (1 - z) * (1 - n * n)
        # What a step's state does to the gates' inputs, as factors of its gradient.
        factors = np.stack([(before - n) * z * (1 - z), new * g * r * (1 - r), new * r], axis=2)
        pushed, states = np.empty((T, L, 3, H), dtype=np.float32), np.empty((T, L, H), dtype=np.float32)
        back, keep = np.ascontiguousarray(p["W"].T), z * live[:, :, None]
        ends = ~live.all(axis=1)
        dh = np.zeros((L, H), dtype=np.float32)
        for t in range(T - 1, -1, -1):
            state = np.add(dh, dout[t], out=states[t])
            np.multiply(factors[t], state[:, None, :], out=pushed[t])
            dh = pushed[t].reshape(L, 3 * H) @ back
            if ends[t]:
                dh *= live[t][:, None]
            dh += state * keep[t]
        grad["W"] += before.reshape(-1, H).T @ pushed.reshape(-1, 3 * H)
        pushed[:, :, 2] = states * new
        ids = x.ravel()
        order = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.diff(ids[order], prepend=-1))
        grad["E"][ids[order[starts]]] += np.add.reduceat(pushed.reshape(-1, 3 * H)[order], starts, axis=0)


class Trainer:
    """Adam over windows; the state of each lane is carried from window to window.

    Windows of few lanes, such as the ends of long texts, are put together until ``enough`` tokens make a step.
    """

    def __init__(self, net: Network, rate: float = RATE):
        self.net, self.rate, self.steps = net, rate, 0
        self.enough, self.pending = 1, 0
        self.held: list[tuple] = []  # windows of the next step
        self.grad = np.zeros_like(net.flat)
        self.m, self.v = np.zeros_like(net.flat), np.zeros_like(net.flat)

    def window(self, h, x, y, first, valid) -> np.ndarray:
        out, kept = self.net.forward(self.net.views(self.net.flat), h, x, first, keep=True)
        self.held.append((*kept, x, y, valid, out))
        self.pending += int(valid.sum())
        if self.pending >= self.enough:
            self.step()
        return out[-1]

    def gradients(self) -> None:
        """Of all windows held, as lanes side by side: nothing flows from one into another."""
        net, p, g = self.net, self.net.views(self.net.flat), self.net.views(self.grad)
        *kept, x, y, valid, out = (np.concatenate(part, axis=1) if len(part) > 1 else part[0] for part in zip(*self.held))
        pick = np.flatnonzero(valid.ravel())
        _, dh = net.output(p, out.reshape(-1, net.hidden)[pick], y.ravel()[pick], g)
        dout = np.zeros((valid.size, net.hidden), dtype=np.float32)
        dout[pick] = dh
        net.backward(p, tuple(kept), x, dout.reshape(out.shape), g)
        self.held = []

    def step(self) -> None:
        if not self.pending:
            return
        self.gradients()
        self.steps += 1
        scale = 1.0 / self.pending
        self.m += 0.1 * (self.grad * scale - self.m)
        self.v += 0.01 * ((self.grad * scale) ** 2 - self.v)
        fix = np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        self.net.flat -= self.rate * fix * self.m / (np.sqrt(self.v) + 1e-8)
        self.grad[:], self.pending = 0, 0


def lanes(texts: list[np.ndarray], begin: int, width: int, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows (x, y, first, valid, text) of steps by lanes; lanes hold texts one after another, long ones first."""
    width = max(1, min(width, len(texts)))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    load, queue = [(0, k) for k in range(width)], [[] for _ in range(width)]
    for i in order:  # each into the shortest lane
        used, k = load[0]
        queue[k].append(i)
        heapq.heapreplace(load, (used + len(texts[i]), k))
    steps = -(-max(used for used, _ in load) // window) * window
    x = np.full((width, steps), begin, dtype=np.int32)
    y, owner = np.zeros((width, steps), dtype=np.int32), np.full((width, steps), -1, dtype=np.int32)
    first = np.zeros((width, steps), dtype=bool)
    for k in range(width):
        at = 0
        for i in queue[k]:
            n = len(texts[i])
            y[k, at : at + n], owner[k, at : at + n], first[k, at] = texts[i], i, True
            x[k, at + 1 : at + n] = texts[i][:-1]
            at += n
    busy = owner >= 0
    for t in range(0, steps, window):
        s = slice(t, t + window)
        live = np.flatnonzero(busy[:, t])  # lanes end one by one, and none starts again
        yield live, x[live, s].T, y[live, s].T, first[live, s].T, owner[live, s].T


def _run(net: Network, texts: list[np.ndarray], trainer: Trainer | None) -> np.ndarray:
    """Natural log probability of each text's ids; with a trainer, learns instead. States are carried over whole texts in both."""
    width, window = (LANES, WINDOW) if trainer is not None else (SCORE_LANES, SCORE_WINDOW)
    totals = np.zeros(len(texts))
    if not texts:
        return totals
    if trainer is not None:
        trainer.enough = max(1, min(width, len(texts)) * window // 2)
    p = net.views(net.flat)
    h = np.zeros((max(1, min(width, len(texts))), net.hidden), dtype=np.float32)
    for live, x, y, first, owner in lanes(texts, net.inputs - 1, width, window):
        valid = owner >= 0
        if trainer is not None:
            h[live] = trainer.window(h[live], x, y, first, valid)
            continue
        out, _ = net.forward(p, h[live], x, first, keep=False)
        h[live] = out[-1]
        pick = np.flatnonzero(valid.ravel())
        score, _ = net.output(p, out.reshape(-1, net.hidden)[pick], y.ravel()[pick], None)
        totals += np.bincount(owner.ravel()[pick], weights=score, minlength=len(texts))
    if trainer is not None:
        trainer.step()
    return totals


def _ids(words: list[bytes], vocab: Vocabulary) -> np.ndarray:
    ids = np.fromiter(map(vocab.ids.get, words, repeat(-1)), dtype=np.int32, count=len(words))
    for i in np.flatnonzero(ids < 0).tolist():
        ids[i] = vocab.size + tail_class(words[i])
    return ids


def train(docs: DataFrame, vocab: Vocabulary, rounds: int = 2, seed: int = 7) -> np.ndarray:
    """Parameters learned from every text of the column ``text``, each read once.

    In each round every task learns from its part of the texts, starting from the same parameters, and
    the parameters are averaged, weighted by tokens. The first round reads an eighth of the texts, so that
    the second starts in one basin. Averages are made in two steps, by slot and by part of the tasks.
    """
    spark = docs.sparkSession
    net = Network(vocab, seed=seed)
    part = F.pmod(F.xxhash64("text"), F.lit(8))
    for number in range(rounds):
        share = docs.where((part == 0) if number == 0 and rounds > 1 else (part != 0) if rounds > 1 else F.lit(True))
        shared = spark.sparkContext.broadcast((net, vocab))  # bounded by HEAD_WORDS and KNOWN_WORDS

        def run(batches, shared=shared):
            start, voc = shared.value
            own = Network(voc, start.hidden)
            own.flat[:] = start.flat
            trainer = Trainer(own)
            seen, held, size = 0, [], 0
            for batch in batches:
                for text in batch.column(0).cast(pa.binary()):
                    held.append(_ids(tokens(text.as_py()), voc))
                    size += len(held[-1])
                    if size >= BUFFER_TOKENS:
                        _run(own, held, trainer)
                        seen, held, size = seen + size, [], 0
            _run(own, held, trainer)
            seen += size
            if seen:
                slots = np.array_split(own.flat * np.float64(seen), 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(16), pa.int32()), pa.array([TaskContext.get().partitionId() % 256] * 16, pa.int32()),
                     pa.array([float(seen)] * 16, pa.float64()), pa.array([s.astype("<f8").tobytes() for s in slots], pa.binary())],
                    names=["slot", "part", "tokens", "sums"],
                )

        def add(group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(s, dtype="<f8") for s in group["sums"])
            return pd.DataFrame({"slot": [group["slot"].iloc[0]], "part": [group["part"].iloc[0]], "tokens": [group["tokens"].sum()], "sums": [total.tobytes()]})

        schema = "slot int, part int, tokens double, sums binary"
        learned = stored(share.select("text").mapInArrow(tidy(run), schema))
        sums = by_group(by_group(learned, ["slot", "part"], add, schema), ["slot"], add, schema).orderBy("slot").collect()
        if sums:
            net.flat[:] = np.concatenate([np.frombuffer(r["sums"], dtype="<f8") / r["tokens"] for r in sums])
    return net.flat


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null text is empty and is one end token. A null id is not held out. Repeated rows stay rows of their
    own. Without training rows all counts are 0. ``base_score`` is the smoothed unigram score, ``score``
    the network's log10 probability: a head word by its class and place in it, another word by its tail
    class and its smoothed count within that class.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).withColumn(
        "held_out", F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))
    )
    learn = rows.where("NOT held_out")
    counts = stored(word_counts(learn))
    vocab = vocabulary(counts)
    flat = train(learn, vocab)
    shared = spark.sparkContext.broadcast((flat, vocab))  # bounded by HEAD_WORDS and KNOWN_WORDS
    denominator = np.log10(vocab.total + vocab.distinct + 1.0)
    tail_log = np.log10(vocab.tail_total + vocab.tail_distinct + 1.0)

    def run(batches):
        params, voc = shared.value
        net = Network(voc)
        net.flat[:] = params
        # Each word is looked up once; the last place stands for the words that are not among the known.
        place = {w: k for k, w in enumerate(voc.counts)}.get
        known_ids = np.array([*map(voc.ids.get, voc.counts), 0], dtype=np.int32)
        known_logs = np.append(np.log10(np.array(list(voc.counts.values()), dtype=np.float64) + 1.0), 0.0)
        serial = TaskContext.get().partitionId() << 33
        held: list = []
        size = 0

        def counted(words):
            """(ids, number of known words, their smoothed logs, those of tail words within their classes, all others)"""
            at = np.fromiter(map(place, words, repeat(-1)), dtype=np.int64, count=len(words))
            ids, value = known_ids[at], known_logs[at]
            others = np.flatnonzero(at < 0)
            rare = [words[i] for i in others]
            ids[others] = _ids(rare, voc)
            tail = ids - voc.size
            inner = (value[tail >= 0] - tail_log[tail[tail >= 0]]).sum()
            return ids, len(words) - len(rare), float(value.sum() - len(words) * denominator), inner, Counter(rare)

        def emit():
            nonlocal held, size, serial
            logs = _run(net, [h[2] for h in held], None) / np.log(10.0)
            model = [float(log + h[5]) for h, log in zip(held, logs)]
            rare_words, rare_n, cuts = [], [], [0]
            for *_, rare in held:
                rare_words += rare.keys()
                rare_n += rare.values()
                cuts.append(len(rare_words))
            count = len(held)
            made = pa.RecordBatch.from_arrays(
                [pa.array(range(serial, serial + count), pa.int64()), pa.array([h[0] for h in held], id_type), pa.array([h[1] for h in held], pa.bool_()),
                 pa.array([len(h[2]) for h in held], pa.int64()), pa.array([h[3] for h in held], pa.int64()), pa.array([h[4] for h in held], pa.float64()),
                 pa.array(model, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), pa.array(rare_n, pa.int64())], names=["word", "n"]))],
                names=["serial", "id", "held_out", "n_tokens", "n_known", "base", "model", "rare"],
            )
            serial, held, size = serial + count, [], 0
            return made

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, text, out in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                held.append((doc, out, *counted(tokens(text.as_py()))))
                size += len(held[-1][2])
                if size >= BUFFER_TOKENS:
                    yield emit()
        if held:
            yield emit()

    kind = docs.schema[id_col].dataType.simpleString()
    partial = stored(
        rows.select(id_col, "text", "held_out").mapInArrow(tidy(run), f"serial long, id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<struct<word:binary,n:long>>"
        )
    )
    # Words beyond the broadcast ones: their counts are joined and summed per document.
    rare = partial.select("serial", F.inline("rare").alias("word", "n"))
    found = rare.join(counts.select("word", F.col("n").alias("c")), "word")
    extra = found.groupBy("serial").agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"))
    logs = F.coalesce("logs", F.lit(0.0))
    return partial.drop("rare").join(extra, "serial", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("model") + logs).alias("score"),
    )
