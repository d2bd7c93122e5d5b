"""Phrase mining, token files and ranked search against brute force and the tokenizers library."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from custodia.llm import common, lexical, phrases, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "  \n ", "İstanbul ǅ Σίγμα 漢字 😀", "x\x00y <|endoftext|> z", "it's WE'LL ²½ ẞ ĳ\x85\xa0\x1cq", "naïve é ...!!"]


@pytest.fixture(scope="module")
def shipped(spark):
    return common.ship(spark)


def frame(spark, rows, schema):
    """Rows with extra columns whose names the operators use inside."""
    extra = ["id", "term", "item", "score", "n", "path", "part", "size", "phrase", "words", "place"]
    return spark.createDataFrame(rows, schema).select("*", *(F.lit("x").alias(c) for c in extra))


# --- phrases --------------------------------------------------------------------------------------


def brute_phrases(rows, least, top):
    count, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            words[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    count[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        often = {p: a for p, a in f.items() if a >= least}
        longer = Counter()
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        found = []
        for p, a in often.items():
            if len(p) < 2 or (p in longer and 100 * longer[p] >= 80 * a):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "über", "ÀB"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(len(vocabulary))], k=rng.randint(0, 60)))
        if i % 7 == 0:
            text += " New  York\tCity, the of new york city hall; New York."
        rows.append((["en", "fr", None, "und"][i % 4], text.replace(" w3 ", "! ")))
    return rows + [("en", None), ("de", ""), (None, None), ("en", "a a a a a a a"), rows[0], rows[0]]


@pytest.mark.parametrize(("share", "sample_least"), [(10, 2), (1000, 1)])
def test_phrases_are_exact_whatever_the_sample(shipped, share, sample_least):
    rows = phrase_rows()
    docs = frame(shipped, [(i, lang, text) for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string")
    got = phrases.collocations(docs, top=40, least=5, share=share, sample_least=sample_least)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 5, 40)


def test_expansion_goes_on_until_closed(shipped):
    """A sample that holds nothing proposes nothing, so every phrase is found by expansions of the border."""
    rows = phrase_rows()
    docs = shipped.createDataFrame([(lang or "und", text or "") for lang, text in rows], "lang string, text string")
    blind = phrases.mine(docs, 5, shipped.createDataFrame([], "lang string, phrase string, size int, n long"))
    direct = phrases.mine(docs, 5)
    assert blind.passes == direct.passes == 4
    assert sorted(map(tuple, blind.phrases.collect())) == sorted(map(tuple, direct.phrases.collect()))


def test_filter_never_misses():
    words = phrases.Words(b"\n".join(f"a{i} b{i % 7}".encode() for i in range(5000)), "en")
    hashes = words.runs(np.arange(0, 10000, 2), 2)
    bits = np.zeros(1 << 17, dtype=np.uint8)
    at = phrases.Filter.places(hashes, 1 << 20).ravel()
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    held = phrases.Filter(bits.tobytes())
    assert held.has(hashes).all() and held.has(words.runs(np.arange(1, 9999, 2), 2)).mean() < 0.05


def test_long_texts_are_cut_between_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(phrases, "CHUNK", 50)
    text = " ".join(f"w{i}{'.' if i % 9 == 8 else ''}" for i in range(400))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], names=["lang", "text"])
    parts = [d for _, d in phrases._texts_by_lang([batch])]
    assert len(parts) > 5 and b"".join(parts).decode() == text and all(p.rstrip().endswith(b".") for p in parts[:-1])


def test_no_phrases_of_no_documents(shipped):
    assert phrases.collocations(shipped.createDataFrame([], "lang string, text string")).collect() == []


# --- token files ----------------------------------------------------------------------------------


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 2**32 - 1], list(range(0, 70000, 7)), [2] * 1000, [300] * 1025])
def test_codes_give_back_every_value(values):
    values = np.array(values, dtype="<u4")
    file = token_files.CodeFile(token_files.write_file(3, 4, [7, None], [0, len(values)], values))
    assert (file.part, file.number, file.n, file.docs, file.ends.tolist()) == (3, 4, len(values), [7, None], [0, len(values)])
    assert file.tokens(np.arange(len(values))).tolist() == values.tolist()
    rng = random.Random(1)
    for _ in range(20):
        a = rng.randint(0, len(values))
        b = rng.randint(a, len(values))
        assert file.run(a, b).tolist() == values[a:b].tolist()
    with pytest.raises(IndexError):
        file.tokens(np.array([len(values)]))


def test_ids_equal_the_library():
    enc, library = token_files.word_ids(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(2)
    latin = [chr(c) for c in range(1, 0x250)]
    texts = [t for t in ODD if t] + ["".join(rng.choices(latin, k=rng.randint(1, 12))) for _ in range(4000)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz'éß .,0123", k=rng.randint(1, 80))) for _ in range(4000)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert enc.one(text).tolist() == want.ids, text


def test_files_and_their_digests(shipped):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "déjà", "Vu"], k=rng.randint(0, 50))) for _ in range(120)]
    rows = [(i * 37 % 121, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (5, texts[0]), (5, texts[0]), (7, "long " * 30000)]
    docs = frame(shipped, rows, "doc_id long, text string").repartition(5)
    target = token_files.scratch(shipped)
    token_files.write(docs, PATH, target, file_ids=500)
    library = Tokenizer.from_file(PATH)
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    got = [tuple(r) for r in token_files.digests(shipped, target).collect()]
    crc = lambda x: zlib.crc32(np.array(x, dtype="<u4").tobytes())
    assert Counter((i, n, c) for i, _, n, c in got) == Counter((i, len(x), crc(x)) for i, all_ in ids.items() for x in all_)
    # In ascending order of id each document begins where the one before ended.
    ordered = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in ordered] == np.cumsum([0] + [r[2] for r in ordered])[:-1].tolist()
    assert [r[0] is not None and r[0] for r in ordered] == sorted((r[0] is not None and r[0] for r in ordered))
    assert token_files._files(shipped, target).count() > 5

    asked = [(i, a) for i, all_ in ids.items() if len(all_) == 1 for a in range(0, len(all_[0]), 97)]
    wanted = shipped.createDataFrame([*asked, (0, -1), (0, 10**9), (99999, 0), (None, 0), asked[1]], "doc_id long, at long")
    found = token_files.tokens_at(shipped, target, wanted).collect()
    assert sorted(map(tuple, found)) == sorted((i, a, ids[i][0][a]) for i, a in [*asked, asked[1]] if i is not None)


def test_many_places_of_one_file_go_to_several_tasks(shipped, monkeypatch):
    monkeypatch.setattr(token_files, "ASKED", 10)
    target = token_files.scratch(shipped)
    token_files.write(shipped.createDataFrame([(1, "a b c d e f g h i j k l m n o p q r s t u v w")], "doc_id long, text string"), PATH, target)
    wanted = shipped.createDataFrame([(1, a) for a in range(24)], "doc_id long, at long")
    assert len(token_files.tokens_at(shipped, target, wanted).collect()) == 24


def test_no_files_of_no_documents(shipped):
    target = token_files.scratch(shipped)
    token_files.write(shipped.createDataFrame([], "doc_id long, text string"), PATH, target)
    assert token_files.digests(shipped, target).collect() == []


# --- search ---------------------------------------------------------------------------------------


def brute_search(rows, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, split(t)) for i, t in rows]
    held = [(i, Counter(w), len(w)) for i, w in held if w]
    n, words = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(split(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c, size in held:
            m = 50 + 50 * size * n // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("segment", [1 << 20, 300])
def test_search(shipped, monkeypatch, segment):
    rng = random.Random(6)
    vocabulary = [f"t{i}" for i in range(80)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(80)], k=rng.choice([1, 5, 20, 20, 200])))) for i in range(400)]
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:30])] + [(2000 + i, t) for i, t in enumerate(ODD)] + [(3, rows[3][1]), (None, rows[4][1]), (5000, "t70 " * 20000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12))).upper()) for i in range(25)]
    items += [(100, ""), (101, None), (102, "nowhere"), (103, "漢字 naïve"), (3, "t79 t78"), (None, "t5 t60")]
    docs, asked = frame(shipped, rows, "doc_id long, text string").repartition(4), frame(shipped, items, "item_id long, text string")
    monkeypatch.setattr(lexical, "BLOCK_PAIRS", 100)
    index = lexical.build_index(docs)
    got = [tuple(r) for r in lexical.search(index, asked, k=7).collect()]
    assert sorted(got, key=str) == sorted(brute_search(rows, items, 7), key=str)
    if segment == 300:  # strata of many small segments, visited few at a time
        searched = small_segments(rows, items, 7, segment)
        assert searched == {(i, d, s) for i, _, d, s in brute_search(rows, items, 7)}


def small_segments(rows, items, k, size):
    """The parts of the operator without Spark: many segments, strata visited in turn."""
    import pyarrow as pa

    held = [(i, lexical.terms((t or "").encode())) for i, t in rows]
    held = [(i, w) for i, w in held if w]
    totals = len(held), sum(len(w) for _, w in held)
    builder, segments = lexical._Builder(*totals, pa.int64()), []
    for i, w in held:
        builder.add(i, w)
        if len(builder.term) >= size:
            segments.append(builder.segment())
    segments.append(builder.segment())
    df = Counter(t for _, w in held for t in set(w))
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(lexical.terms((text or "").encode()))
    words = sorted({t for w in asked.values() for t in w})
    names = list(asked)
    pairs = [(a, words.index(t)) for a, item in enumerate(names) for t in asked[item]]
    owner, term = (np.array(x) for x in zip(*pairs))
    search = lexical.Searcher(names, [t.decode() for t in words], [lexical.weight(totals[0], df[t]) for t in words], (owner, term), k)
    for segment in segments:
        search.visit({c: segment.column(c)[0] for c in segment.schema.names})
    return {(i, d, s) for i, d, s in search.rows()}


def test_search_of_nothing(shipped):
    docs = shipped.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    asked = shipped.createDataFrame([(1, "a")], "item_id long, text string")
    none = asked.where("false")
    assert lexical.search(lexical.build_index(docs), none).collect() == []
    assert lexical.search(lexical.build_index(docs.where("false")), asked).collect() == []
    assert [r["doc_id"] for r in lexical.search(lexical.build_index(docs), asked).collect()] == [1]


def test_a_segment_is_a_small_row():
    """The JVM holds several rows of the index at once, so that a segment of megabytes ends executors on large inputs."""
    import pyarrow as pa

    rng = random.Random(14)
    vocabulary = [f"term{i}" for i in range(20_000)]
    docs = [" ".join(rng.choices(vocabulary, k=80)).encode() for _ in range(lexical.SEGMENT_POSTINGS // 80)]
    builder = lexical._Builder(len(docs), 80 * len(docs), pa.int64())
    for i, text in enumerate(docs):
        builder.add(i, lexical.terms(text))
    postings = len(builder.term)
    segment = builder.segment()
    assert segment.nbytes < min(8 * postings, 2 << 20)
    search = lexical.Searcher([7], ["term5"], [1_000], (np.array([0]), np.array([0])), 10**6)
    search.visit({c: segment.column(c)[0] for c in segment.schema.names})
    assert {d for _, d, _ in search.rows()} == {i for i, t in enumerate(docs) if b"term5" in t.split()}


def test_numbers_come_back_packed():
    arrays = [np.array(x, dtype=np.int64) for x in ([], [0, 0], [255, 256], [3, 70_000], [2**56, 1], [2**63 - 1])]
    assert [x.tolist() for x in common.unpack(common.pack(*arrays))] == [x.tolist() for x in arrays]
    rising = np.array([4, 4, 2**55], dtype=np.uint64)
    assert np.cumsum(common.unpack(common.pack(common.steps(rising)))[0], dtype=np.uint64).tolist() == rising.tolist()
