"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import by_group, stored

K = 10
SEGMENT = 16  # bits
SHARD = 65_536  # codes of one index
QUERIES = 2048  # queries that a task answers together
PROBE_ROWS = 2_000_000  # candidates verified at once


@lru_cache(maxsize=1)
def _masks() -> list[np.ndarray]:
    """All 16-bit values by the number of their bits."""
    values = np.arange(1 << SEGMENT, dtype=np.uint16)
    bits = np.bitwise_count(values)
    return [values[bits == r] for r in range(SEGMENT + 1)]


class Index:
    """One table per segment: the codes in order of the segment's value, and where each value begins."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes  # rows of 16-bit segments
        self.orders, self.begins = [], []
        for s in range(codes.shape[1]):
            self.orders.append(np.argsort(codes[:, s], kind="stable"))
            counts = np.bincount(codes[:, s], minlength=1 << SEGMENT)
            self.begins.append(np.concatenate([[0], np.cumsum(counts)]))

    def search(self, queries: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(distances, ids) of the k nearest codes of each query, by distance and then by id.

        Round r probes all buckets at distance r in every segment. A code at distance m(r+1)-1 or less has a
        segment within r, so it has been seen; a query is done when its k-th distance is covered that way.
        A code is taken in the round of its nearest segment, from the first such segment, hence once.
        """
        m = queries.shape[1]
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, int), np.zeros(0, ids.dtype))] * len(queries)
        active = np.arange(len(queries))
        for radius in range(SEGMENT + 1):
            masks = _masks()[radius]
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for s in range(m):
                step = max(1, PROBE_ROWS // (4 * len(masks)))
                for i in range(0, len(active), step):
                    q = active[i : i + step]
                    buckets = (queries[q, s][:, None] ^ masks[None, :]).ravel()
                    a, b = self.begins[s][buckets], self.begins[s][buckets.astype(np.int64) + 1]
                    full = np.flatnonzero(b > a)
                    owner, a, n = np.repeat(q, len(masks))[full], a[full], (b - a)[full]
                    ends = np.cumsum(n)
                    cut = 0
                    while cut < len(n):  # verify in pieces of bounded size
                        stop = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + PROBE_ROWS)))
                        w, size = slice(cut, stop), n[cut:stop]
                        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a[w], size)
                        code, who = self.orders[s][at], np.repeat(owner[w], size)
                        apart = np.bitwise_count(self.codes[code] ^ queries[who])
                        fresh = apart.min(axis=1) == radius
                        if s:
                            fresh &= apart[:, :s].min(axis=1) > radius
                        found.append((who[fresh], apart[fresh].sum(axis=1).astype(np.int64), code[fresh]))
                        cut = stop
            if found:
                who, distance, code = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((ids[code], distance, who))
                who, distance, name = who[order], distance[order], ids[code[order]]
                cuts = np.searchsorted(who, active, side="left"), np.searchsorted(who, active, side="right")
                for q, a, b in zip(active, *cuts):
                    b = min(b, a + k)
                    d = np.concatenate([best[q][0], distance[a:b]])
                    i = np.concatenate([best[q][1], name[a:b]])
                    keep = np.lexsort((i, d))[:k]
                    best[q] = (d[keep], i[keep])
            covered = m * (radius + 1) - 1
            active = np.array([q for q in active if len(best[q][0]) < k or best[q][0][-1] > covered], dtype=int)
            if not len(active):
                break
        return best


def binary_codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, bits, code): the signs of a vector, 1 above zero, packed into 16-bit segments; code null for invalid ones."""
    v = F.col(vector_col)
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    segments = F.expr(
        f"transform(sequence(0, (size({vector_col}) - 1) div {SEGMENT}), s -> "
        f"aggregate(slice({vector_col}, s * {SEGMENT} + 1, {SEGMENT}), 0, (a, x) -> a * 2 + if(x > 0, 1, 0)))"
    )
    return vectors.select(
        F.col(id_col).cast("long").alias("id"), F.size(v).alias("bits"), F.when(F.coalesce(good, F.lit(False)), segments).alias("code")
    )


def search(
    vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD
) -> DataFrame:
    """(id, rank, neighbor_id, distance) of the k vectors nearest to each query by the Hamming distance of sign codes.

    Ties go to the smaller id; a vector is not its own neighbour, equal vectors with other ids are. Fewer
    rows than k come back if there are fewer other vectors. Vectors that are null, empty or hold null or
    non-finite components, and those without an id, are neither found nor searched for; codes of different
    length do not compare. Repeated rows of one id count once.

    Equal codes keep their k + 1 smallest ids, which is all that any result can hold. Shards of the index
    meet blocks of different query codes; their lists are merged per query code.
    """
    near = k + 1
    codes = binary_codes(vectors, id_col, vector_col).where("code IS NOT NULL AND id IS NOT NULL").distinct()
    rank = F.expr("row_number() OVER (PARTITION BY bits, code ORDER BY id)")
    index = stored(codes.withColumn("place", rank).where(F.col("place") <= near).drop("place"))
    asked = stored(binary_codes(queries, id_col, vector_col).where("code IS NOT NULL AND id IS NOT NULL").distinct())
    wanted = stored(asked.select("bits", "code").distinct())
    sizes = {r["bits"]: (-(-r["n"] // shard), 1) for r in index.groupBy("bits").agg(F.count("*").alias("n")).collect()}
    for r in wanted.groupBy("bits").agg(F.count("*").alias("n")).collect():
        sizes[r["bits"]] = (sizes.get(r["bits"], (1, 1))[0], -(-r["n"] // QUERIES))
    # Numbers of shards and query blocks by code length; as many entries as lengths.
    pairs = [F.lit(x) for b, n in sizes.items() for x in (b, F.array(F.lit(n[0]), F.lit(n[1])))]
    numbers = F.element_at(F.create_map(*pairs), F.col("bits")) if pairs else F.array(F.lit(1), F.lit(1))
    side = lambda frame, own, salt: frame.withColumn("numbers", numbers).withColumn(
        "part", F.pmod(F.xxhash64("code", F.lit(salt)), F.element_at("numbers", own))
    )

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        code = np.array(group["code"].tolist(), dtype=np.uint16)
        ids = group["id"].to_numpy(dtype=np.int64) if "id" in group else np.zeros(0, np.int64)
        first = group.iloc[0]
        return pd.DataFrame({"bits": [first["bits"]], "part": [first["part"]], "others": [first["others"]], "codes": [code.tobytes()], "ids": [ids.tobytes()]})

    packed = "bits int, part long, others long, codes binary, ids binary"
    shards = by_group(side(index, 1, 1).withColumn("others", F.element_at("numbers", 2).cast("long")).select("bits", "part", "others", "code", "id"), ["bits", "part"], pack, packed)
    blocks = by_group(side(wanted, 2, 2).withColumn("others", F.element_at("numbers", 1).cast("long")).select("bits", "part", "others", "code"), ["bits", "part"], pack, packed)
    across = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))
    met = (
        shards.withColumn("block", across).select("bits", F.col("part").alias("shard"), "block", F.lit(0).alias("query"), "codes", "ids")
        .union(blocks.withColumn("shard", across).select("bits", "shard", F.col("part").alias("block"), F.lit(1).alias("query"), "codes", "ids"))
    )

    def answer(group: pd.DataFrame) -> pd.DataFrame | None:
        if len(group) < 2:
            return None
        group = group.sort_values("query")
        m = -(-int(group["bits"].iloc[0]) // SEGMENT)
        code, asks = (np.frombuffer(c, dtype=np.uint16).reshape(-1, m) for c in group["codes"])
        ids = np.frombuffer(group["ids"].iloc[0], dtype=np.int64)
        result = Index(code).search(asks, ids, near)
        n = [len(d) for d, _ in result]
        return pd.DataFrame({
            "bits": int(group["bits"].iloc[0]), "code": np.repeat(np.array([a.astype("<u2").tobytes() for a in asks], dtype=object), n),
            "distance": np.concatenate([d for d, _ in result]), "neighbor_id": np.concatenate([i for _, i in result]),
        })

    hits = by_group(met, ["bits", "shard", "block"], answer, "bits int, code binary, distance long, neighbor_id long")
    order = F.expr("row_number() OVER (PARTITION BY bits, code ORDER BY distance, neighbor_id)")
    lists = (
        hits.withColumn("place", order).where(F.col("place") <= near).groupBy("bits", "code")
        .agg(F.array_sort(F.collect_list(F.struct("distance", "neighbor_id"))).alias("near"))
    )
    raw = F.expr("unhex(array_join(transform(code, s -> lpad(hex(s % 256), 2, '0') || lpad(hex(s div 256), 2, '0')), ''))")
    joined = asked.select("id", "bits", raw.alias("code")).join(lists, ["bits", "code"])
    others = F.slice(F.filter("near", lambda x: x["neighbor_id"] != F.col("id")), 1, k)
    return joined.select("id", F.posexplode(others).alias("rank", "hit")).select(
        F.col("id").alias(id_col), (F.col("rank") + 1).alias("rank"), F.col("hit.neighbor_id").alias("neighbor_id"), F.col("hit.distance").alias("distance")
    )
