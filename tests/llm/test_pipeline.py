"""The pipeline stage by stage against brute force, each on what the stage before it kept."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from custodia.llm import common, pii

WORDS = [f"word{i}" for i in range(60)]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(11)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(60, 120))) for _ in range(80)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    for i in range(10):  # exact and near copies
        near = texts[i].split()
        near[20] = "other"
        rows += [(200 + i, texts[i], "en"), (300 + i, " ".join(near), "en")]
    passage = " ".join(rng.choices(WORDS, k=70))
    rows += [(400 + i, f"{' '.join(rng.choices(WORDS, k=90))} {passage} {' '.join(rng.choices(WORDS, k=90))}", "en") for i in range(4)]
    rows += [(500 + i, " ".join(f"Q{rng.random()}" for _ in range(60)), "en") for i in range(5)]  # junk
    rows += [(600, f"{' '.join(rng.choices(WORDS, k=100))} word3 a.b@c.example.org word4 {' '.join(rng.choices(WORDS, k=20))}", "en"), (601, "", "en"), (602, None, "en"), (603, "word1 word2", None)]
    folder = str(tmp_path_factory.mktemp("sf"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame.select("*", F.lit("s").alias("source"), F.char_length("text").cast("long").alias("n_chars")).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(80)] + [(500, 0, 0), (501, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def deduplicated(rows):
    """Documents that are the smallest id of their group of near copies."""
    sets = {i: shingles(t) for i, t in rows.items()}
    root = {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in rows:
        for b in rows:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: t for i, t in rows.items() if find(i) == i}


def without_repeats(rows):
    data = {i: (t or "").encode() for i, t in rows.items()}
    seen = Counter(t[i : i + 200] for t in data.values() for i in range(len(t) - 199))
    out = {}
    for doc, t in data.items():
        gone = [False] * len(t)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        out[doc] = bytes(b for b, g in zip(t, gone) if not g).decode()
    return out


def test_stages(spark, sf_dir):
    docs = common.table(common.ship(spark), sf_dir, "documents")
    columns = docs.columns
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, sf_dir))
        got[name] = docs
        if name != "packing":
            assert docs.columns == columns
    texts = {n: {r["doc_id"]: r["text"] for r in f.collect()} for n, f in got.items() if n != "packing"}
    whole = {r["doc_id"]: r["text"] for r in common.table(spark, sf_dir, "documents").collect()}
    first, joined, cut, masked = (texts[n] for n, _ in corpus_pipeline.STAGES[:4])
    assert first == {i: t for i, t in whole.items() if not 500 <= i < 505}
    assert joined == deduplicated(first)
    assert {i: t or "" for i, t in cut.items()} == without_repeats(joined)
    assert any(len(cut[i]) < len(joined[i]) for i in range(400, 404))
    assert masked == {i: None if t is None else pii.mask(t, pii.find(t)) for i, t in cut.items()}
    assert "[EMAIL]" in masked[600] and "a.b@c" not in masked[600]

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, filled = {}, {}
    for p in got["packing"].collect():
        pieces.setdefault(p["doc_id"], []).append(p)
        filled.setdefault(p["sequence_id"], []).append(p)
    assert pieces.keys() == masked.keys()
    for doc, held in pieces.items():
        ids = np.array([*tokenizer.encode(masked[doc] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for p in sorted(held, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for held in filled.values():
        spans = sorted((p["offset"], p["length"]) for p in held)
        assert [o for o, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]]
        assert sum(n for _, n in spans) <= 2048


def test_run_equals_its_stages_in_documents_and_tokens(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, sf_dir))
    tokens = lambda f: {(r["doc_id"], r["n"]) for r in f.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert tokens(rows) == tokens(docs)


def odd_rows(spark):
    """Null and repeated ids, empty and very long texts, columns named like those that stages make."""
    rng = random.Random(12)
    a, b, c = (" ".join(rng.choices(WORDS, k=70)) for _ in range(3))
    passage = " ".join(rng.choices(WORDS, k=60))
    rows = [(1, a), (None, a), (2, b), (2, b), (3, c), (4, None), (4, ""), (None, None), (5, f"x1 {passage} y1"), (6, " ".join(rng.choices(WORDS, k=30_000)) + f" {passage}")]
    names = ["kept_text", "row_serial", "kept", "component_id", "id", "serial", "packed", "lang"]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.select("*", *(F.lit("x").alias(n) for n in names), F.char_length("text").cast("long").alias("n_chars"))


def test_stages_judge_rows_and_not_ids(spark, sf_dir):
    common.ship(spark)
    docs = odd_rows(spark)
    kept = corpus_pipeline.reject_poor(spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    # Junk under a null id and under the id of a clean document goes; clean rows of the same ids stay.
    clean = common.table(spark, sf_dir, "documents").where("doc_id < 500")
    noise = [(doc, " ".join(f"Q{i}" for i in range(60)), "en", "s", 0) for doc in (None, 300)] + [(None, WORDS[1] + " " + " ".join(WORDS), "en", "s", 0)]
    judged = corpus_pipeline.reject_poor(spark, clean.unionByName(spark.createDataFrame(noise, clean.schema)), sf_dir)
    assert judged.where("text LIKE 'Q%'").isEmpty() and judged.count() == clean.count() + 1
    single = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert single.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in single.where("length(text) BETWEEN 100 AND 2000 AND doc_id < 5").collect()) == ["1", "2", "3"]
    assert single.where("text IS NULL OR text = ''").count() == 3 and single.count() == 8
    cut = corpus_pipeline.cut_repeats(spark, single, sf_dir)
    assert cut.columns == docs.columns and cut.count() == 8 and cut.where("kept_text = 'x' AND row_serial = 'x'").count() == 8
    before, after = ({r["doc_id"]: r["text"] for r in f.where("doc_id IN (5, 6)").collect()} for f in (single, cut))
    assert len(after[5]) < len(before[5]) - 199 and len(after[6]) < len(before[6]) - 199
    masked = corpus_pipeline.mask_personal_data(spark, cut, sf_dir)
    assert masked.columns == docs.columns and corpus_pipeline.pack(spark, masked, sf_dir).select("doc_id").distinct().count() >= 6


def test_stages_of_nothing(spark, sf_dir):
    docs = common.table(common.ship(spark), sf_dir, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
        docs = common.stored(docs)


def test_the_quality_stage_counts_every_n_gram_of_much_text(spark, tmp_path, monkeypatch):
    """Over 8 MB of trusted text no n-gram is left out of the stage's model, and every row is judged once."""
    rng = random.Random(13)
    vocabulary = [f"w{i}" + "x" * 230 for i in range(500)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=100)), "en") for i in range(600)]
    rows += [(None, rows[7][1], None), (3, "", "en"), (3, None, "en"), (9_000, " ".join(f"Q{rng.random()}" for _ in range(99)), "en")]
    folder = str(tmp_path)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").select("*", F.lit("s").alias("source"), F.char_length("text").cast("long").alias("n_chars"))
    spark.createDataFrame([(i, 1, 0) for i in range(600)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    models, fit = [], corpus_pipeline.quality.fit
    monkeypatch.setattr(corpus_pipeline.quality, "fit", lambda texts: models.append(fit(texts)) or models[0])
    kept = corpus_pipeline.reject_poor(spark, docs, folder).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(i for i, *_ in rows if i != 9_000)
    counted = {r.doc_id for r in docs.where("doc_id < 600 AND pmod(xxhash64(doc_id), 4) <> 0 AND text <> ''").collect()}
    words = [["<b>", *t.split(), "<e>"] for i, t, _ in rows if i in counted and t]
    assert models[0].pairs == len({p for w in words for p in zip(w, w[1:])})
