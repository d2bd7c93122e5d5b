"""Registered queries of the text operators and the SQL that some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from custodia.llm import embeddings, extraction, hamming, language_model, lexical, packing, phrases, pii, quality, repeats, similarity, token_files, tokenization
from custodia.llm.common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, sf_dir: build(ship(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query(
    "op1_cover_tree_near_duplicates",
    """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    n AS (SELECT a, count(*) AS n FROM links GROUP BY a), low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(low.b, v.vec_id)) AS component_id,
      v.vec_id = least(v.vec_id, coalesce(low.b, v.vec_id)) AS kept
    FROM v LEFT JOIN n ON v.vec_id = n.a LEFT JOIN low ON v.vec_id = low.a""",
)
def op1(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query(
    "op2_chosen_path_jaccard_join",
    r"""WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
        lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s FROM w),
    t AS (SELECT doc_id, unnest(s) AS t FROM s),
    both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM both_have JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE c >= 0.8 * (len(x.s) + len(y.s) - c) - 1e-9),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    n AS (SELECT a, count(*) AS n FROM links GROUP BY a), low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(n.n, 0) AS n_links, least(s.doc_id, coalesce(low.b, s.doc_id)) AS component_id,
      s.doc_id = least(s.doc_id, coalesce(low.b, s.doc_id)) AS kept
    FROM s LEFT JOIN n ON s.doc_id = n.a LEFT JOIN low ON s.doc_id = low.a""",
)
def op2(spark, sf_dir):
    return similarity.join(table(spark, sf_dir, "documents"))


@query("op3_repeated_passages")
def op3(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query("op4_site_style_tree")
def op4(spark, sf_dir):
    return extraction.extract(table(spark, sf_dir, "pages"))


@query(
    "op5_multi_index_hashing",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings),
    d AS (SELECT q.vec_id, o.vec_id AS neighbor_id,
        list_sum(list_transform(list_zip(q.bits, o.bits), lambda p: CASE WHEN p[1] <> p[2] THEN 1 ELSE 0 END)) AS distance
      FROM v q JOIN v o ON q.vec_id <> o.vec_id WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank FROM d)
    SELECT vec_id, CAST(rank AS INTEGER) AS rank, neighbor_id, CAST(distance AS BIGINT) AS distance FROM r WHERE rank <= 10""",
)
def op5(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return hamming.search(vectors, vectors.where("vec_id % 20 = 0"))


@query("op6_vector_bin_packing")
def op6(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_kneser_ney_quality")
def op7(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_tokenization_automaton")
def op8(spark, sf_dir):
    return tokenization.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_anchor_expansion")
def op9(spark, sf_dir):
    return pii.find_in_documents(table(spark, sf_dir, "documents"))


@query("op10_recurrent_language_model")
def op10(spark, sf_dir):
    return language_model.score(table(spark, sf_dir, "documents"))


@query(
    "op13_length_stratified_search",
    r"""WITH lowered AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    split AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM lowered),
    lengths AS (SELECT doc_id, len(w) AS n FROM split WHERE len(w) > 0),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
    normal AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // words) AS m FROM lengths, totals),
    held AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM split) GROUP BY doc_id, term),
    asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, totals GROUP BY term),
    scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN normal USING (doc_id) GROUP BY item_id, doc_id),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50""",
)
def op13(spark, sf_dir):
    return lexical.search(lexical.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


@query("op12_directly_addressable_codes")
def op12(spark, sf_dir):
    target = token_files.scratch(spark)
    token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), target)
    return token_files.digests(spark, target)


@query(
    "op11_toivonen_collocations",
    r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece FROM documents),
    words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
    grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
      FROM words, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k),
    counts AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
    cuts AS (SELECT lang, k, phrase, a, unnest(range(1, k)) AS c, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
    scored AS (SELECT cuts.lang, cuts.k, cuts.phrase, cuts.a, c, x.a AS l, y.a AS r, CAST((CAST(2000000 AS HUGEINT) * cuts.a) // (x.a + y.a) AS BIGINT) AS score
      FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = array_to_string(list_slice(w, 1, c), ' ')
      JOIN counts y ON y.lang = cuts.lang AND y.phrase = array_to_string(list_slice(w, c + 1, cuts.k), ' ')),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o FROM scored) WHERE o = 1),
    covers AS (SELECT lang, phrase, max(a) AS longer FROM (
      SELECT lang, a, unnest(list_transform(range(1, k - s.j + 2), lambda i: array_to_string(list_slice(string_split(phrase, ' '), i, i + s.j - 1), ' '))) AS phrase
      FROM counts, (VALUES (2), (3)) s(j) WHERE s.j < k) GROUP BY lang, phrase),
    kept AS (SELECT best.* FROM best LEFT JOIN covers ON covers.lang = best.lang AND covers.phrase = best.phrase WHERE coalesce(100 * longer < 80 * a, true)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
)
def op11(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))
