"""Exact near-duplicate vectors by cosine, with cover trees traversed in pairs."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import by_group, components, forest, stored, tidy

THRESHOLD = 0.95
PIVOTS = 256  # children of the root of the whole tree at most: some, and one for each block of vectors
SAMPLE = 4096
BLOCK = 8192  # vectors of one local tree
RADII = (0.5, 0.25, 0.125)  # nested levels on the unit sphere, halving; wider nodes prune nothing there
SLACK = 1e-6  # of bounds worked out in single precision
_SCHEMA = "node long, links long, root long"


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that huge components do not overflow."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _chord(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))


def net(points: np.ndarray, radius: float, chunk: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(indices of centers, center of each point): centers lie more than ``radius`` apart and cover all points."""
    n = len(points)
    owner = np.full(n, -1, dtype=np.int64)
    centers: list[int] = []
    left = np.arange(n)
    least = 1.0 - radius * radius / 2.0  # dot product at that chord
    while len(left):
        head = left[:chunk]
        dots = points[head] @ points[head].T
        own = np.full(len(head), -1)
        fresh = []
        for i in range(len(head)):
            if own[i] < 0:
                cover = (dots[i] >= least) & (own < 0)
                own[cover] = i
                own[i] = i
                fresh.append(i)
        base = len(centers)
        index = {i: base + k for k, i in enumerate(fresh)}
        owner[head] = [index[i] for i in own]
        centers += [int(head[i]) for i in fresh]
        left = left[chunk:]
        if len(left):
            dots = points[left] @ points[head[fresh]].T
            best = dots.argmax(axis=1)
            near = dots[np.arange(len(left)), best] >= least
            owner[left[near]] = base + best[near]
            left = left[~near]
    return np.array(centers, dtype=np.int64), owner


class Tree:
    """Nested levels: each node's points lie together, are covered by its center within its radius, and are
    split into the node's children at half the radius."""

    def __init__(self, points: np.ndarray):
        order = np.arange(len(points))
        spans = [(0, len(points))] if len(points) else []
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.children: list[list[tuple[int, int]]] = []
        single = points.astype(np.float32)
        for radius in RADII:
            begins, ends, centers, reach, kids = [], [], [], [], []
            for a, b in spans:
                first = len(begins)
                part = order[a:b].copy()
                if b - a == 1:
                    begins.append(a), ends.append(b), centers.append(int(part[0])), reach.append(0.0)
                else:
                    mids, owner = net(single[part], radius)
                    by = np.argsort(owner, kind="stable")
                    order[a:b] = part[by]
                    far = _chord((single[part] * single[part[mids[owner]]]).sum(axis=1))
                    cuts = np.searchsorted(owner[by], np.arange(len(mids) + 1))
                    worst = np.maximum.reduceat(far[by], cuts[:-1])
                    begins += (a + cuts[:-1]).tolist()
                    ends += (a + cuts[1:]).tolist()
                    centers += part[mids].tolist()
                    reach += np.where(np.diff(cuts) > 1, worst + 1e-3, 0.0).tolist()
                kids.append((first, len(begins)))
            self.levels.append((np.array(begins, int), np.array(ends, int), np.array(centers, int), np.array(reach, dtype=np.float32)))
            self.children.append(kids)
            spans = list(zip(begins, ends))
        self.order = order


def dual(x: np.ndarray, y: np.ndarray, threshold: float, same: bool, tx: Tree, ty: Tree):
    """Index pairs (i, j) of x and y with a dot product of ``threshold`` or more; for ``same`` those with i < j.

    Pairs of nodes whose centers are farther apart than both radii and the threshold's chord are pruned.
    """
    limit = np.float32(float(_chord(np.array(threshold))) + 1e-3)
    out_i, out_j = [], []
    sx, sy = x.astype(np.float32), y.astype(np.float32)
    # Top level: all centers of both trees, by blocks.
    bx, ex, cx, rx = tx.levels[0]
    by, ey, cy, ry = ty.levels[0]
    stack = []
    for i in range(0, len(cx), 1024):
        d = sx[cx[i : i + 1024]] @ sy[cy].T
        bound = limit + rx[i : i + 1024, None] + ry[None, :]
        a, b = np.nonzero((d >= np.float32(1) - np.square(np.minimum(bound, np.float32(2))) / np.float32(2) - np.float32(SLACK)))
        a = a + i
        if same:
            a, b = a[a <= b], b[a <= b]
        # Pairs of single points need no more bounds, only the exact test.
        lone = (ex[a] - bx[a] == 1) & (ey[b] - by[b] == 1)
        p, q = tx.order[bx[a[lone]]], ty.order[by[b[lone]]]
        out_i.append(p), out_j.append(q)
        stack += [(0, int(u), int(v)) for u, v in zip(a[~lone], b[~lone])]
    while stack:
        level, u, v = stack.pop()
        (bx, ex, _, _), (by, ey, _, _) = tx.levels[level], ty.levels[level]
        if level + 1 == len(RADII) or (ex[u] - bx[u]) * (ey[v] - by[v]) <= 1024:
            p, q = tx.order[bx[u] : ex[u]], ty.order[by[v] : ey[v]]
            for i in range(0, len(p), 1024):
                a, b = np.nonzero(sx[p[i : i + 1024]] @ sy[q].T >= threshold - 1e-4)
                out_i.append(p[a + i]), out_j.append(q[b])
            continue
        (u0, u1), (v0, v1) = tx.children[level + 1][u], ty.children[level + 1][v]
        _, _, cx, rx = tx.levels[level + 1]
        _, _, cy, ry = ty.levels[level + 1]
        d = sx[cx[u0:u1]] @ sy[cy[v0:v1]].T
        bound = limit + rx[u0:u1, None] + ry[None, v0:v1]
        a, b = np.nonzero(d >= np.float32(1) - np.square(np.minimum(bound, np.float32(2))) / np.float32(2) - np.float32(SLACK))
        a, b = a + u0, b + v0
        if same and u == v:
            a, b = a[a <= b], b[a <= b]
        stack += [(level + 1, int(s), int(t)) for s, t in zip(a, b)]
    i, j = (np.concatenate(o) if o else np.zeros(0, int) for o in (out_i, out_j))
    exact = np.empty(len(i), dtype=bool)
    for k in range(0, len(i), 100_000):
        exact[k : k + 100_000] = (x[i[k : k + 100_000]] * y[j[k : k + 100_000]]).sum(axis=1) >= threshold
    i, j = i[exact], j[exact]
    if same:
        # A node pair within one tree holds both orders of a pair of points when the nodes are one.
        low, high = np.minimum(i, j), np.maximum(i, j)
        pairs = np.unique(low[low != high] * len(x) + high[low != high])
        i, j = pairs // len(x), pairs % len(x)
    return i, j


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
    pivots: int = PIVOTS, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept, by cosine in double precision.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; neither do
    vectors of different length. Equal vectors are searched once, with their number. ``component_id`` is the
    smallest id reachable by links and is ``kept``. A null id counts as a vector; a component without any id
    has a null ``component_id`` and keeps its rows. Rows that repeat an id are vectors of their own.

    The whole tree: the root's children are pivots from a bounded sample; a cell of many vectors is split
    into blocks, each with a local tree of halving radii. Pairs of cells are pruned by their covering radii,
    pairs of blocks that stay are traversed in one task each. No pairs are written, only counts and a forest.
    """
    spark = vectors.sparkSession
    values = F.col(vector_col)
    good = (
        values.isNotNull() & (F.size(values) > 0) & F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(values, lambda v: v != 0)
    )
    doubles = values.cast("array<double>")
    # Zeros of both signs are one value.
    same_zero = F.transform(doubles, lambda v: v + F.lit(0.0))
    rows = stored(vectors.select(F.col(id_col).alias("id"), F.when(F.coalesce(good, F.lit(False)), same_zero).alias("v")).withColumn("serial", F.monotonically_increasing_id()))
    usable = rows.where("v IS NOT NULL")
    classes = stored(usable.groupBy("v").agg(F.min("serial").alias("node"), F.count("*").alias("weight")))
    # Pivots per length, farthest first from a bounded sample in a fixed order.
    chosen: dict[int, np.ndarray] = {}
    pivots = min(pivots, 4 + -(-classes.count() // block))
    picked = classes.orderBy(F.xxhash64("v")).limit(SAMPLE).select("v").collect()
    for dim in sorted({len(r["v"]) for r in picked}):
        sample = _unit(np.array([r["v"] for r in picked if len(r["v"]) == dim]))
        at, far = [0], _chord(sample @ sample[0])
        while len(at) < min(pivots, len(sample)) and far.max() > RADII[0]:
            at.append(int(far.argmax()))
            far = np.minimum(far, _chord(sample @ sample[at[-1]]))
        chosen[dim] = sample[at]
    shared = spark.sparkContext.broadcast(chosen)

    def assign(batches):
        for batch in batches:
            out = []
            for node, weight, v in zip(*(batch.column(k).to_pylist() for k in range(3))):
                u = _unit(np.array([v]))[0]
                cells = shared.value.get(len(v))
                dots = cells @ u if cells is not None else np.ones(1)
                cell = int(dots.argmax())
                out.append((len(v), cell, float(_chord(dots[cell])) if cells is not None else 2.0, node, weight, u.tobytes()))
            if out:
                kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["dim", "cell", "far", "node", "weight", "unit"])

    placed = stored(classes.select("node", "weight", "v").mapInArrow(tidy(assign), "dim int, cell int, far double, node long, weight long, unit binary"))
    cells = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()  # PIVOTS per length
    limit = float(_chord(np.array(threshold))) + 1e-6
    near: dict[tuple[int, int], list[tuple[int, int]]] = {}
    parts = {(c["dim"], c["cell"]): -(-c["n"] // block) for c in cells}
    for a in cells:
        for b in cells:
            centers = chosen.get(a["dim"])
            apart = 0.0 if centers is None or a["dim"] != b["dim"] else float(_chord(centers[a["cell"]] @ centers[b["cell"]]))
            if a["dim"] == b["dim"] and apart <= a["radius"] + b["radius"] + limit:
                near.setdefault((a["dim"], a["cell"]), []).append((b["cell"], parts[b["dim"], b["cell"]]))
    near_b = spark.sparkContext.broadcast((near, parts))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        """A block as one row per block that it meets: the pair's name, the block's vectors and their tree."""
        dim, cell, part = (int(group[k].iloc[0]) for k in ("dim", "cell", "part"))
        group = group.sort_values("node")
        me = (cell, part)
        rows = []
        units = np.frombuffer(b"".join(group["unit"]), dtype="<f8").reshape(-1, dim)
        blob = (group["node"].to_numpy().tobytes(), group["weight"].to_numpy().tobytes(), units.tobytes(), pickle.dumps(Tree(units)))
        for other, count in near_b.value[0][dim, cell]:
            for k in range(count):
                low, high = sorted((me, (other, k)))
                rows.append((f"{dim}:{low[0]}:{low[1]}:{high[0]}:{high[1]}", dim, *blob))
        return pd.DataFrame(rows, columns=["pair", "dim", "nodes", "weights", "units", "tree"])

    part = F.expr("pmod(xxhash64(node), parts)")
    count = F.create_map([F.lit(x) for k, v in parts.items() for x in (f"{k[0]}:{k[1]}", v)]) if parts else F.create_map(F.lit(""), F.lit(1))
    located = placed.withColumn("parts", F.element_at(count, F.concat_ws(":", "dim", "cell"))).withColumn("part", part).drop("parts", "far")
    blocks = by_group(located, ["dim", "cell", "part"], pack, "pair string, dim int, nodes binary, weights binary, units binary, tree binary")

    def meet(group: pd.DataFrame) -> pd.DataFrame | None:
        sides = []
        for r in group.itertuples():
            units = np.frombuffer(r.units, dtype="<f8").reshape(-1, r.dim)
            sides.append((np.frombuffer(r.nodes, "<i8"), np.frombuffer(r.weights, "<i8"), units, pickle.loads(r.tree)))
        (na, wa, xa, ta), (nb, wb, xb, tb) = sides[0], sides[-1]
        i, j = dual(xa, xb, threshold, len(sides) == 1, ta, tb)
        if not len(i):
            return None
        counts = pd.Series(np.concatenate([wb[j], wa[i]])).groupby(np.concatenate([na[i], nb[j]])).sum()
        moved, to = forest(na[i], nb[j])
        root = pd.Series(counts.index.to_numpy().copy(), index=counts.index)
        root[moved] = to
        return pd.DataFrame({"node": counts.index.to_numpy(), "links": counts.to_numpy(), "root": root.to_numpy()})

    found = stored(by_group(blocks, ["pair"], meet, _SCHEMA))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.join(links, "node", "left").join(reached, "node", "left")
        .select("v", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
    )
    joined = stored(rows.join(per_class, "v", "left").select("id", "weight", "links", "component"))
    lowest = joined.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("lowest"))
    out = joined.join(lowest, "component", "left")
    component_id = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("lowest"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).alias("n_links"),
        component_id.alias("component_id"), F.coalesce(F.col("id") == component_id, component_id.isNull()).alias("kept"),
    )
