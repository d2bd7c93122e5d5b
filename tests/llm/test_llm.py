"""The text operators against brute force, on small tables with nulls, empty texts, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from custodia.llm import common, embeddings, extraction, hamming, language_model, packing, pii, quality, repeats, similarity, tokenization

WORDS = [f"w{i}" for i in range(300)]


@pytest.fixture(scope="module")
def shipped(spark):
    return common.ship(spark)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [" ".join(rng.choices(WORDS, k=rng.randint(40, 120))) for _ in range(12)]
    out = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base[:6]):
        w = t.split()
        w[len(w) // 2] = "changed"
        out += [(100 + i, " ".join(w)), (200 + i, t)]
    passage = " ".join(rng.choices(WORDS, k=60))
    out += [(300 + i, f"{rng.choice(WORDS)} {i} {passage} {i} {rng.choice(WORDS)}") for i in range(5)]
    out += [(400, ""), (401, None), (402, "   \n "), (403, "one two"), (404, "One  two"), (405, "a" * 3000), (406, "é ñ 😀 " * 400), (None, base[7]), (407, "x\x00y")]
    return out + [(3, base[3]), (500, "mail a.b@c.example.org or +1 (312) 555-3490, 10.0.0.1, card 4111 1111 1111 1111")]


@pytest.fixture(scope="module")
def docs(shipped, rows):
    # Extra columns with names that the operators use inside.
    frame = shipped.createDataFrame(rows, "doc_id long, text string")
    extra = ["serial", "key", "size", "id", "text_hash", "weight", "component", "links", "node", "word", "n", "lang", "source"]
    return frame.select("*", *(F.lit("x").alias(c) for c in extra))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def collect(frame):
    return [r.asDict() for r in frame.collect()]


def links(n, linked):
    """n_links and smallest reachable index by brute force."""
    near = {i: {j for j in range(n) if i != j and linked(i, j)} for i in range(n)}
    root = {}
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        root[i] = seen
    return [len(near[i]) for i in range(n)], root


@pytest.mark.parametrize("bucket", [256, 2])
def test_similarity_join(docs, rows, empty, bucket, monkeypatch):
    monkeypatch.setattr(similarity, "BUCKET", bucket)
    monkeypatch.setattr(similarity, "LEAF", max(2, bucket))
    sets = []
    for _, text in rows:
        w = (text or "").lower().encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n, root = links(len(rows), lambda i, j: bool(sets[i]) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    want = Counter()
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in root[i] if rows[j][0] is not None]
        low = min(ids) if len(root[i]) > 1 else doc
        want[(doc, len(sets[i]), n[i], low, doc == low if doc is not None else low is None)] += 1
    got = Counter((r["doc_id"], r["n_shingles"], r["n_links"], r["component_id"], r["kept"]) for r in collect(similarity.join(docs)))
    assert got == want
    assert collect(similarity.join(empty)) == []


def test_cover_tree(shipped):
    rng = np.random.default_rng(3)
    vectors = [v.tolist() for v in rng.normal(size=(60, 8))]
    vectors += [(np.array(vectors[i % 20]) + rng.normal(size=8) * 0.1).tolist() for i in range(60)]
    vectors += [vectors[0], [2 * x for x in vectors[1]], None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] + [1.0] * 7, [float("inf")] * 8, [1.0, 2.0], [2.0, 4.0]]
    ids = [*range(len(vectors) - 1), None]
    frame = shipped.createDataFrame(list(zip(ids, vectors, ids)), "vec_id long, embedding array<double>, node long")

    def good(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.linalg.norm(v) if good(v) else None for v in vectors]
    n, root = links(len(vectors), lambda i, j: unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95)
    want = {}
    for i, name in enumerate(ids):
        low = min((ids[j] for j in root[i] if ids[j] is not None), default=None)
        want[name] = (n[i], low, name == low)
    for block in (8192, 16):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in collect(embeddings.near_duplicates(frame, block=block))}
        assert got == want
    assert collect(embeddings.near_duplicates(frame.where("false"))) == []


@pytest.mark.parametrize("hot", [8192, 2])
def test_repeats(docs, rows, empty, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    want = Counter()
    for (doc, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 200, dtype=bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        gone = gone[: len(t)]
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        want[(doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    got = Counter(tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in collect(repeats.remove_repeats(docs)))
    assert got == want
    assert collect(repeats.remove_repeats(empty, keep_text=True)) == []


def test_repeated_starts_by_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        parts = [bytes(rng.choices(b"ab", k=60)) for _ in range(3)]
        text = b"\xff".join(b"".join(rng.choice([rng.choice(parts), bytes(rng.choices(b"abc", k=9))]) for _ in range(5)) for _ in range(4)) + b"\xff"
        size = rng.choice([20, 33, 100])
        seen = Counter(text[i : i + size] for i in range(len(text) - size + 1))
        want = [i + size <= len(text) and 255 not in text[i : i + size] and seen[text[i : i + size]] > 1 for i in range(len(text))]
        assert repeats.repeated_starts(np.frombuffer(text, np.uint8), size).tolist() == want


def test_extraction(shipped):
    nav = "<nav><ul><li><a href='/'>Home</a></ul></nav><div class='ad'>Buy</div>"
    page = f"<html><head><title>T</title><script>var a='</p>';</script></head><body>{nav}<!-- x --><article><h1>Top &amp; more</h1><p>One<br>two  <b>three<p>Four</article><footer>f</footer>"
    plain = [f"<body><div class='x'><p>Same words</p></div><div class='y'><p>Own text {i}</p></div>" for i in range(20)]
    rows = [(0, "http://a.example/1", page), (1, "http://a.example/2", None), (2, None, ""), (None, "http://a.example/1", page)]
    rows += [(10 + i, f"https://b.example/{i}", p) for i, p in enumerate(plain)]
    frame = shipped.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h")).withColumn("low", F.lit(1))
    got = Counter((r["page_id"], r["text"], r["n_chars"]) for r in collect(extraction.extract(frame)))
    main = "Top & more\n\nOne two three\n\nFour"
    want = Counter({(0, main, len(main)): 1, (None, main, len(main)): 1, (1, "", 0): 1, (2, "", 0): 1})
    want.update((10 + i, f"Own text {i}", len(f"Own text {i}")) for i in range(20))
    assert got == want
    assert collect(extraction.extract(frame.where("false"))) == []


def test_extraction_reads_whole_attributes_and_names():
    for attrs in ('style="overflow:hidden"', 'aria-hidden="false"', 'title="hidden gems"', 'data-grid="menu"', "data-class='menu'"):
        assert extraction.main_text(f"<body {attrs}><div {attrs}><p>Text</p></div>") == "Text", attrs
    for attrs in ("hidden", "class=menu", 'id="top-nav"', "role='search'", 'data-x="a"hidden'):
        assert extraction.main_text(f"<body><div {attrs}><p>Text</p></div>") == "", attrs
    inside = "<div class='article-header'>Title</div><div id='related-work'>Work</div><div class='social-policy'>Policy</div><div class='x comments'>No</div>"
    assert extraction.main_text(f"<body><article>{inside}</article>") == "Title\n\nWork\n\nPolicy"


def test_extraction_judges_branches_inside_articles(shipped):
    page = "<body><article><p>Own text {0}</p><div class='box'><p>Same on every page</p></div><p>More {0}</p></article>"
    rows = [(i, f"http://c.example/{i}", page.format(i)) for i in range(12)]
    rows += [(100 + i, f"http://copies.example/{i}", page.format(0)) for i in range(12)]
    frame = shipped.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in collect(extraction.extract(frame))}
    assert all(got[i] == f"Own text {i}\n\nMore {i}" for i in range(12))
    assert all(got[100 + i] == "Own text 0\n\nSame on every page\n\nMore 0" for i in range(12))


def test_style_tree_against_recount(shipped):
    """Importance and verdict of every node, counted anew from the words that the pages were made of."""
    rng = random.Random(8)
    often, vocabulary = ["alpha", "beta", "gamma"], [f"w{i}" for i in range(400)]
    paths = {"x p": ["body", "div.x", "p"], "y p": ["body", "div.y", "p"], "y li": ["body", "div.y", "ul", "li"]}
    pages, made = [], []
    for i in range(30):
        texts = {"x p": rng.sample(often, 2), "y p": rng.choices(vocabulary, k=40)}
        if i % 3:
            texts["y li"] = rng.choices(vocabulary, k=5) + ["More"]
        listed = f"<ul><li>{' '.join(texts['y li'])}<a href='/next'>\u00a0</a></li></ul>" if i % 3 else ""
        pages.append(f"<body><div class='x'><p>{' '.join(texts['x p'])}</p></div><div class='y'><p>{' '.join(texts['y p'])}</p>{listed}</div></body>")
        made.append({name: {w.lower() for w in words} | ({"href=/next"} if name == "y li" else set()) for name, words in texts.items()})
    entropy, weight = {}, {}
    for name in paths:
        have = [m[name] for m in made if name in m]
        counts = Counter(w for words in have for w in words)
        entropy[name] = sum(math.log(n) for n in counts.values()) / len(counts) / math.log(len(have))
        weight[name] = sum(counts.values())
    styles = {("body",): ["div.x div.y"] * 30, ("body", "div.x"): ["p"] * 30, ("body", "div.y"): ["p ul" if i % 3 else "p" for i in range(30)]}
    frame = shipped.createDataFrame([(i, "https://Site.example/a", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    host = frame.select(extraction.host_of("url")).first()[0]
    got = {r["node"]: r for r in collect(extraction.style_tree(frame))}
    want = {}
    for name, path in paths.items():
        for depth in range(1, len(path) + 1):
            at = tuple(path[:depth])
            inside = [n for n, other in paths.items() if tuple(other[:depth]) == at]
            content = 1 - sum(weight[n] * entropy[n] for n in inside) / sum(weight[n] for n in inside)
            kinds = Counter(styles.get(at, [""]))
            total = sum(kinds.values())
            shown = -sum(c / total * math.log(c / total) for c in kinds.values()) / math.log(total) if total > 1 else 0.0
            share = 0.9 ** (len(kinds) - 1)
            node = host
            for label in at:
                node = extraction._hash(f"{node}>{label}")
            want[node] = ((1 - share) * shown + share * content, at)
    assert set(want) == set(got) - {host}
    main = entropy["y p"]
    for node, (importance, at) in want.items():
        assert abs(got[node]["importance"] - importance) < 1e-6, at
        holds_main = tuple(paths["y p"][: len(at)]) == at
        assert got[node]["low"] == (not holds_main and 1 - importance >= max(2 * main, 0.1)), at
    text = {r["page_id"]: r["text"] for r in collect(extraction.extract(frame))}
    assert not any(set(often) & set(t.split()) for t in text.values()) and all(text.values())
    known = extraction.BROADCAST_NODES
    try:
        extraction.BROADCAST_NODES = -1  # the way of more nodes than tasks may hold
        assert {r["page_id"]: r["text"] for r in collect(extraction.extract(frame))} == text
    finally:
        extraction.BROADCAST_NODES = known


def test_extraction_keeps_copies_and_reads_hard_pages(shipped):
    rows = [(i, f"http://copies.example/{i}", "<body><div><p>One text</p></div><p>Tail</p></body>") for i in range(12)]
    frame = shipped.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in collect(extraction.extract(frame))} == {"One text\n\nTail"}
    began = time.perf_counter()
    assert extraction.main_text("<head>" * 100_000 + "x") == "x"
    assert extraction.main_text("<head " * 100_000).count("<head") == 100_000
    deep = "<div>" * 5_000 + "deep" + "</div>" * 5_000 + "<p>after"
    assert extraction.main_text(deep) == "deep\n\nafter"
    assert max(len(e.nodes) for e in extraction.parse(deep)[1]) == extraction.DEPTH
    assert time.perf_counter() - began < 20


def test_hamming_search(shipped):
    rng = np.random.default_rng(4)
    vectors = [v.tolist() for v in rng.normal(size=(150, 40))]
    vectors += [vectors[0]] * 15 + [None, [], [float("nan")] * 40, [1.0, -1.0], [1.0, 1.0]]
    frame = shipped.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)] + [(None, vectors[3], 1), (5, vectors[5], 1)], "vec_id long, embedding array<double>, bits int")
    got: dict[int, list] = {}
    for r in collect(hamming.search(frame, frame.where("vec_id % 20 = 0 OR vec_id IS NULL"), k=7, shard=40)):
        got.setdefault(r["vec_id"], []).append((r["rank"], r["distance"], r["neighbor_id"]))
    valid = {i: np.array(v) > 0 for i, v in enumerate(vectors) if v and np.isfinite(v).all()}
    for q in range(0, len(vectors), 20):
        if q not in valid:
            assert q not in got
            continue
        near = sorted((int((valid[q] != b).sum()), i) for i, b in valid.items() if i != q and len(b) == len(valid[q]))[:7]
        assert sorted(got[q]) == [(k + 1, *x) for k, x in enumerate(near)]
    assert collect(hamming.search(frame.where("false"), frame.where("false"))) == []


def test_packing(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = collect(packing.pack_documents(docs, path))
    sequences: dict[int, list] = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
    for held in sequences.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at == 2048 or at & (at - 1) == 0
    texts = Counter()
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        texts[(doc, len(ids), zlib.crc32(ids.tobytes()))] += 1
    whole = Counter((p["doc_id"], p["doc_tokens"], p["ids_crc32"]) for p in pieces if p["length"] == p["doc_tokens"])
    assert not whole - texts
    assert sum(p["length"] for p in pieces) == sum(k[1] * v for k, v in texts.items())
    assert collect(packing.pack_documents(empty, path)) == []


def test_packer_keeps_all_limits():
    rng = random.Random(2)
    packer = packing.Packer((100, 4, 60), pool=20)
    items = [(i, 0, n, rng.randint(0, n)) for i, n in enumerate(rng.choices(range(1, 100), k=200))]
    packer.add(items)
    out = list(packer.sequences(final=True))
    got = Counter()
    for s in out:
        assert sum(p[2] for p in s) <= 100 and len(s) <= 4 and sum(p[3] for p in s) <= 60
        for doc, _, n, loss in s:
            got[doc, "n"] += n
            got[doc, "loss"] += loss
    assert all(got[i, "n"] == n and got[i, "loss"] == loss for i, _, n, loss in items)


def test_quality(shipped, empty):
    rng = random.Random(8)
    good = [(i, " ".join(rng.choices(WORDS[:50], k=60)), rng.choice(["a", "b", None])) for i in range(200)]
    bad = [(1000 + i, " ".join(f"Z{rng.random()}" for _ in range(60)), "a") for i in range(20)]
    other = [(2000, None, "a"), (2001, "", None), (None, good[0][1], "b"), (2002, good[1][1], "new language")]
    frame = shipped.createDataFrame(good + bad + other + good[:1], "doc_id long, text string, lang string").withColumn("perplexity", F.lit(1))
    labels = shipped.createDataFrame([(i, 1, 0) for i in range(0, 200, 2)] + [(1000, 0, 0), (None, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    got = collect(quality.classify(frame, labels))
    assert len(got) == 225
    assert {r["doc_id"] for r in got if not r["kept"]} == {i for i, _, _ in bad}
    assert all(r["kept"] for r in collect(quality.classify(frame, labels.where("false"))))
    assert collect(quality.classify(empty, labels)) == []


def test_kneser_ney_sums_to_one(shipped):
    texts = shipped.createDataFrame([("a b a c",), ("a b b",), ("c a b d",)], "text string")
    model = quality.fit(texts)
    score = model.scorer()
    for context in ("a", "a b", "zz", ""):
        total = 0.0
        for word in ("a", "b", "c", "d", "unseen"):
            a, b = f"{context} {word}".encode(), context.encode()
            ends = [score(np.frombuffer(x, np.uint8), np.array([0, len(x)])) for x in (a, b)]
            end_a, end_b = (_last(model, x) for x in (a, b))
            total += 10 ** (ends[0][1][0] - end_a - (ends[1][1][0] - end_b))
        total += 10 ** _last(model, context.encode())
        assert total == pytest.approx(1.0, abs=1e-4)


def _last(model, text):
    """log10 probability of the end after the text."""
    score = model.scorer()
    w, vw, uvw, v, uv, _ = quality._ngrams(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    full = score(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[1][0]
    p = {n: dict(zip(k.tolist(), x.tolist())) for n, (k, x) in model.grams.items()}
    g = {n: dict(zip(k.tolist(), x.tolist())) for n, (k, x) in model.weights.items()}

    def one(i):
        if int(uvw[i]) in p[3]:
            return p[3][int(uvw[i])]
        back = g[3].get(int(uv[i]), 0.0)
        if int(vw[i]) in p[2]:
            return back + p[2][int(vw[i])]
        return back + g[2].get(int(v[i]), 0.0) + p[1].get(int(w[i]), model.unknown)

    assert full == pytest.approx(sum(one(i) for i in range(len(w))), abs=1e-4)
    return one(len(w) - 1)


def test_tokenization(docs, rows, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    encoder = tokenization.encoder(path)
    rng = random.Random(1)
    parts = ["a", "aa", "rr", "l", "ñ", "'s", " ", ".", "..", "1", "the", "É", "\x01", "!", "Σ", "́", "😀", "한", "<|endoftext|>", "\x1c", "\x85"]
    texts = [t or "" for _, t in rows] + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(500)]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids
        assert encoder.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)
    want = Counter()
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want[(doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += 1
    got = Counter(tuple(r.values()) for r in collect(tokenization.digests(docs, path)))
    assert got == want
    assert collect(tokenization.digests(empty, path)) == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m.group())
            fine = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


def test_pii(docs, rows, empty):
    rng = random.Random(3)
    parts = ["1", "2", "255", ".", "+", " ", "-", "(", ")", "@", "a", "b.c", "4111111111111111", "9", "5 ", "é"]
    for text in ["".join(rng.choices(parts, k=rng.randint(1, 24))) for _ in range(20_000)]:
        assert [s for s in pii.find(text) if s[2] in pii.BASE] == base_spans(text), text
    want = Counter()
    for doc, text in rows:
        base = base_spans(text or "")
        want[(doc, *(sum(s[2] == k for s in base) for k in PATTERNS), hashlib.sha256(pii.join(base).encode()).hexdigest())] += 1
    got = collect(pii.find_in_documents(docs, masked=True))
    assert Counter(tuple(r[c] for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")) for r in got) == want
    assert [r["masked_text"] for r in got if r["doc_id"] == 500] == ["mail [EMAIL] or [PHONE], [IP], card [CARD]"]
    assert [r["masked_text"] for r in got if r["doc_id"] == 401] == [None]
    assert collect(pii.find_in_documents(empty)) == []
    found = pii.find("see https://a.example/x, IBAN DE89 3704 0044 0532 0130 00 at 12 Long Street")
    assert [k for _, _, k in found if k not in pii.BASE] == ["url", "account", "address"]


def test_language_model(docs, rows, empty):
    got = collect(language_model.score(docs))
    held = [r is not None and zlib.crc32(str(r).encode()) % 7 == 2 for r, _ in rows]
    table = [language_model.tokens((t or "").encode()) for _, t in rows]
    counts = Counter(w for t, h in zip(table, held) if not h for w in t)
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for (doc, _), t, h in zip(rows, table, held):
        base = sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in t)
        want[(doc, h, len(t), sum(w in counts for w in t), total, round(base, 6))] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert collect(language_model.score(empty)) == []


def test_language_model_carries_states_over_long_texts(monkeypatch):
    words = [f"w{i}".encode() for i in range(1023)]
    counts = {language_model.END: 3000, **{w: 2000 - i for i, w in enumerate(words)}}
    vocab = language_model.Vocabulary(counts, sum(counts.values()), len(counts), np.zeros(4), np.zeros(4), [language_model.END, *words][: language_model.HEAD_WORDS + 1])
    net = language_model.Network(vocab)
    assert net.heads == 1024 and net.hidden >= 16  # words far down have outputs of their own
    texts = [np.arange(n, dtype=np.int32) % 1000 for n in (2000, 700, 3)]
    begins, learned = [], []
    learn = language_model.Trainer.window

    def window(self, h, x, y, first, valid):
        begins.append(first.sum())
        learned.append(valid.sum())
        return learn(self, h, x, y, first, valid)

    monkeypatch.setattr(language_model.Trainer, "window", window)
    language_model._run(net, texts, language_model.Trainer(net))
    assert sum(begins) == 3 and sum(learned) == 2703  # one begin a text, every token learned from


def test_language_model_beats_counts_on_held_out_texts(shipped):
    rng = random.Random(6)
    begins = [rng.randrange(24) for _ in range(140)]
    frame = shipped.createDataFrame([(i, " ".join(WORDS[k % 24] for k in range(a, a + 1200))) for i, a in enumerate(begins)], "doc_id long, text string")
    held = [r for r in collect(language_model.score(frame)) if r["held_out"]]
    assert len(held) > 5
    assert all(r["score"] > 0.5 * r["base_score"] for r in held)


def test_network_gradient():
    vocab = language_model.Vocabulary({b"\n": 5, b"a": 4, b"b": 3}, 12, 3, np.zeros(4), np.zeros(4), [b"\n", b"a", b"b"])
    net = language_model.Network(vocab, hidden=3)
    net.flat = net.flat.astype(np.float64)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, net.inputs, (5, 2)), rng.integers(0, net.heads + 4, (5, 2))
    first = np.zeros((5, 2), dtype=bool)
    first[0], first[3, 1] = True, True
    h = np.zeros((2, 3))

    def loss(flat):
        p = net.views(flat)
        out, _ = net.forward(p, h, x, first, keep=False)
        return -net.output(p, out.reshape(-1, 3).astype(np.float64), y.ravel(), None)[0].sum()

    grad = np.zeros_like(net.flat)
    p = net.views(net.flat)
    out, steps = net.forward(p, h, x, first, keep=True)
    _, dh = net.output(p, out.reshape(-1, 3).astype(np.float64), y.ravel(), net.views(grad))
    net.backward(p, steps, x, dh.reshape(out.shape), net.views(grad))
    for i in rng.choice(len(grad), 40, replace=False):
        step = np.zeros_like(net.flat)
        step[i] = 1e-2
        assert (loss(net.flat + step) - loss(net.flat - step)) / 2e-2 == pytest.approx(grad[i], abs=2e-3)


@pytest.mark.parametrize("words", [3, 5, 9])
def test_packing_of_short_documents_needs_no_padding(shipped, words):
    docs = shipped.createDataFrame([(i, "a " * words) for i in range(5000)], "doc_id long, text string").repartition(2)
    used = Counter()
    for p in collect(packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))):
        used[p["sequence_id"]] += p["length"]
    padded = sum(n if n & (n - 1) == 0 else 2048 for n in used.values())
    assert sum(used.values()) / padded > 0.99


def test_packing_limits_loss_bearing_tokens(shipped):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        prompt, answer = rng.randint(1, 300), rng.randint(0, 120)
        rows.append((i, " ".join(["prompt"] * prompt + ["answer"] * answer), answer + 1))
    rows += [(1000, "long " * 5000, 4500), (1001, None, None), (1002, "none", 0), (1003, "all", 99)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, bearing long").repartition(2)
    pieces = collect(packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), loss_col="bearing", loss_limit=512))
    tokens, loss, per_doc, whole = Counter(), Counter(), Counter(), Counter()
    for p in pieces:
        tokens[p["sequence_id"]] += p["length"]
        loss[p["sequence_id"]] += p["loss"]
        per_doc[p["doc_id"]] += p["loss"]
        whole[p["doc_id"]] += p["length"]
        assert p["loss"] == max(0, p["start"] + p["length"] - max(p["start"], p["doc_tokens"] - {1001: 1, 1003: 2}.get(p["doc_id"], rows[p["doc_id"]][2] if p["doc_id"] < 400 else {1000: 4500, 1002: 0}.get(p["doc_id"], 0))))
    assert max(tokens.values()) <= 2048 and max(loss.values()) <= 512 and max(loss.values()) > 400
    assert all(whole[p["doc_id"]] == p["doc_tokens"] for p in pieces)
    assert per_doc[1000] == 4500 and per_doc[1002] == 0
    padded = sum(n if n & (n - 1) == 0 else 2048 for n in tokens.values())
    assert sum(tokens.values()) / padded > 0.97


def test_every_trusted_text_is_counted(shipped, monkeypatch):
    """Words that only a long text, or only the last of many texts, holds are known; nothing depends on a sample."""
    rng = random.Random(3)
    texts = [(i, " ".join([f"only{i}", *rng.choices(WORDS[:30], k=5)])) for i in range(3_500)] + [(9_999, "long " * 4_000 + "deepdeep")]
    frame = shipped.createDataFrame(texts, "doc_id long, text string")
    fitted = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows: fitted.append(fit(rows)) or fitted[0])
    verdict = quality.classify(frame.withColumn("lang", F.lit("a")), frame.selectExpr("doc_id", "1 AS quality", "0 AS toxic"))
    assert verdict.count() == len(texts)
    known = set(fitted[0].grams[1][0].tolist())
    held = {r.doc_id for r in frame.where("pmod(xxhash64(doc_id), 4) = 0").collect()}
    for i, text in texts:
        word = (text.split()[-1] if i == 9_999 else text.split()[0]).encode()
        w, *_ = quality._ngrams(np.frombuffer(word, np.uint8), np.array([0, len(word)]))
        assert (int(w[0]) in known) == (i not in held)


def test_a_pruned_model_sums_to_one(shipped):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = shipped.createDataFrame([(" ".join(rng.choices(vocabulary, weights=range(1, 41), k=30)),) for _ in range(200)], "text string")
    whole, model = quality.fit(texts), quality.fit(texts, most=300)
    assert len(model.grams[3][0]) <= 300 < len(whole.grams[3][0])
    assert set(model.grams[3][0].tolist()) < set(whole.grams[3][0].tolist())
    for context in ("w39 w38", "w39", "w1 w2", ""):
        ends = 10 ** _last(model, context.encode())
        total = ends
        for word in (*vocabulary, "unseen"):
            a, b = f"{context} {word}".strip().encode(), context.encode()
            score = model.scorer()
            logs = [score(np.frombuffer(x, np.uint8), np.array([0, len(x)]))[1][0] for x in (a, b)]
            total += 10 ** (logs[0] - _last(model, a) - (logs[1] - _last(model, b)))
        assert total == pytest.approx(1.0, abs=1e-3)


def test_a_word_with_a_final_mark_is_taken_from_the_remembered_word(monkeypatch):
    enc = tokenization.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    list(enc.parts("remembering"))
    tried, encode = [], enc.automaton.encode
    monkeypatch.setattr(enc.automaton, "encode", lambda text, size: tried.append(text) or encode(text, size))
    both = [b"".join(m[0] for m in enc.parts(t)) for t in ("remembering,", "remembering ,")]
    assert both[0] == both[1] and len(tried) <= 2 and not any(t.startswith("rem") for t in tried)


def test_windows_of_few_lanes_share_their_way_back(monkeypatch):
    vocab = language_model.Vocabulary({b"a": 5, b"b": 3}, 8, 2, np.ones(4), np.ones(4), [language_model.END, b"a", b"b"])
    net = language_model.Network(vocab)
    texts = [np.array([1, 2, 0], dtype=np.int32)] * 40 + [np.tile(np.array([1, 2], dtype=np.int32), 400)]
    trainer, calls, back = language_model.Trainer(net), [], language_model.Network.backward
    monkeypatch.setattr(language_model.Network, "backward", lambda *args: calls.append(1) or back(*args))
    language_model._run(net, texts, trainer)
    assert 1 < len(calls) == trainer.steps < 800 // language_model.WINDOW
    assert not trainer.held and np.isfinite(net.flat).all()


def test_trigrams_travel_in_fewer_bytes_than_their_words():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 2**48, 3_000, dtype=np.uint64)
    grams, n = words[rng.integers(0, 3_000, (3, 20_000))], rng.integers(1, 400, 20_000)
    blobs = [quality._packed(grams[:, :15_000], n[:15_000]), quality._packed(grams[:, 15_000:], n[15_000:])]
    assert sum(map(len, blobs)) < 11 * 20_000
    back, often = quality._unpacked(blobs)
    assert (back == grams).all() and (often == n).all()
    one, single = quality._unpacked([quality._packed(grams[:, :1], np.array([70_000]))])
    assert one.tolist() == grams[:, :1].tolist() and single.tolist() == [70_000]


def test_a_stretch_of_texts_is_sent_together(shipped, monkeypatch):
    """Trigrams of many small texts weigh once a stretch, and short stretches give the same counts."""
    texts = shipped.createDataFrame([("a b c d a b c",)] * 50 + [("x y z",)], "text string").coalesce(1)
    whole = sorted(map(tuple, quality.counts(texts, 3, 1).where("kind > 1").collect()))
    assert all(r[5] == 0 for r in whole if r[0] == 3) and all(r[2] == r[3] == 0 for r in quality.counts(texts, 3, 1).where("kind = 1").collect())
    monkeypatch.setattr(quality, "STRETCH", 1)
    monkeypatch.setattr(quality, "text_chunks", lambda array: common.text_chunks(array, 10))
    assert sorted(map(tuple, quality.counts(texts, 3, 1).where("kind > 1").collect())) == whole


def test_only_texts_with_contexts_to_search_are_shuffled(shipped):
    texts = shipped.range(5_000).selectExpr("id * 7919 AS serial", "binary('x') AS packed")
    asked = texts.where("serial % 50 = 0").select("serial")
    got = {r.serial for r in repeats._asked(texts, asked.union(asked)).collect()}
    want = {r.serial for r in asked.collect()}
    assert want <= got and len(got) < 1_500
    assert repeats._asked(texts, asked.where("false")).count() == 0


def test_scoring_holds_ids_and_looks_a_word_up_once(shipped, monkeypatch):
    """A flush a text and one flush for all give the same rows; lanes are filled from millions of ids at a time."""
    assert language_model.BUFFER_TOKENS >= 4_000_000
    rows = [(i, " ".join(["common"] * (i % 5) + [f"rare{i}", "Common."])) for i in range(40)] + [(40, None), (41, ""), (None, "never \u00e9t\u00e9")]
    frame = shipped.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    counts = language_model.stored(language_model.word_counts(frame.where("doc_id < 20")))
    vocab = language_model.vocabulary(counts, known_words=3)
    assert language_model._ids([b"common", b"unseen", b"unseen.", b"\xc3\xa9"], vocab).tolist() == [vocab.ids[b"common"], vocab.size, vocab.size + 1, vocab.size + 2]
    monkeypatch.setattr(language_model, "train", lambda docs, voc: language_model.Network(voc).flat)
    whole = collect(language_model.score(frame))
    monkeypatch.setattr(language_model, "BUFFER_TOKENS", 1)
    by_text = collect(language_model.score(frame))
    key = lambda r: (r["doc_id"] is None, r["doc_id"])
    for a, b in zip(sorted(whole, key=key), sorted(by_text, key=key)):
        assert [a[c] for c in ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score")] == [b[c] for c in ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score")]
        assert a["score"] == pytest.approx(b["score"], rel=1e-5)


def recounted(texts):
    """Probability of a word after two others, by a plain recount of all n-grams."""
    c3 = Counter(g for t in texts for w in [["<b>", "<b>", *t.split(), "<e>"]] for g in zip(w, w[1:], w[2:]))
    c2 = Counter((v, w) for _, v, w in c3)
    c1 = Counter(w for _, w in c2)

    def discounts(counts):
        n = [sum(x == k for x in counts.values()) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
        return [0.0] + [min(k, max(0.0, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.5 * k for k in (1, 2, 3)]

    d1, d2, d3 = (discounts(c) for c in (c1, c2, c3))
    total, left = Counter(), Counter()
    for counts, d in ((c3, d3), (c2, d2)):
        for gram, n in counts.items():
            total[gram[:-1]] += n
            left[gram[:-1]] += d[min(n, 3)]
    spare = sum(d1[min(n, 3)] for n in c1.values()) / len(c2)

    def p(u, v, w):
        found = (c1[w] - d1[min(c1[w], 3)]) / len(c2) + spare / (len(c1) + 1)
        for counts, d, context in ((c2, d2, (v,)), (c3, d3, (u, v))):
            if total[context]:
                n = counts[(*context, w)]
                found = (n - d[min(n, 3)] + left[context] * found) / total[context]
        return found

    return p


def test_every_n_gram_of_much_text_counts(shipped, monkeypatch):
    """Over 8 MB of trusted text, texts are scored as a recount of all n-grams says, of those seen once as well."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" + "x" * 230 for i in range(2_000)]
    texts = [" ".join(rng.choices(vocabulary, weights=range(1, 2_001), k=100)) for _ in range(400)]
    monkeypatch.setattr(quality, "STRETCH", 3_000)
    model = quality.fit(shipped.createDataFrame([(t,) for t in texts], "text string"))
    asked = [*enumerate(texts[:20]), (0, texts[30]), (None, texts[31]), (50, " ".join(rng.choices(vocabulary, k=60))), (51, "unseen " * 5), (52, ""), (53, None), (54, " \n")]
    frame = shipped.createDataFrame([(i, t, k) for k, (i, t) in enumerate(asked)], "doc_id long, text string, k long")
    got = {r["k"]: r for r in collect(quality.perplexities(frame.withColumn("lang", F.lit(None)), model, carry=("k",)))}
    p = recounted(texts)
    assert len(got) == len(asked)
    for k, (i, text) in enumerate(asked):
        w = ["<b>", "<b>", *(text or "").split(), "<e>"]
        assert (got[k]["doc_id"], got[k]["lang"], got[k]["n_tokens"]) == (i, "", len(w) - 2)
        assert got[k]["log10_prob"] == pytest.approx(sum(math.log10(p(*g)) for g in zip(w, w[1:], w[2:])), rel=1e-6)


def test_shards_score_as_the_model_that_tasks_hold(shipped, rows, monkeypatch):
    docs = shipped.createDataFrame([(i, t, "a" if (i or 0) % 2 else None) for i, t in rows], "doc_id long, text string, lang string").withColumn("blob", F.lit(1))
    texts = docs.where("doc_id < 300 AND text <> ''")
    held = collect(quality.perplexities(docs, quality.fit(texts)))
    for name, value in {"SMALL_BYTES": 0, "SHARD_BYTES": 1_500, "BUCKET_BYTES": 3_000, "STRETCH": 400, "SLICE_BYTES": 5_000, "BLOB_KEYS": 100}.items():
        monkeypatch.setattr(quality, name, value)
    model = quality.fit(texts)
    assert isinstance(model, quality.Shards) and model.shards > 1
    order = lambda r: (str(r["doc_id"]), r["n_tokens"], r["lang"], r["perplexity"])
    for a, b in zip(sorted(held, key=order), sorted(collect(quality.perplexities(docs, model)), key=order), strict=True):
        assert all(a[c] == (b[c] if c not in ("log10_prob", "perplexity") else pytest.approx(b[c], rel=1e-5)) for c in a)


def test_a_passing_table_is_removed(shipped):
    with common.passing(shipped.range(5)) as table:
        files = table.inputFiles()
        assert table.count() == 5
    with pytest.raises(Exception, match="(?i)path|file"):
        shipped.read.parquet(files[0].rpartition("/")[0]).count()
