"""The registered queries of the corpus operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalframe.llm import decontaminate, divergence, langid, mainblock, negatives, oddsketch, packing, prefix_trie, quality, recipes, surrogates, token_counts, toxicity
from signalframe.llm.common import read


#: Key of the surrogates; in production a secret of the caller's.
KEY = "registered query"
#: A published vocabulary file on the driver.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op1_cumulative_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.severities(docs, toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))


def op2_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.scored(read(spark, sf_dir, "documents", "doc_id", "text"))
    score = F.col(quality.SCORE)
    return scored.select("doc_id", score.alias("quality_score"), (score >= 0.5).alias("kept"))


def op3_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainblock.page_texts(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(read(spark, sf_dir, "documents", "doc_id", "text"), KEY)


def op5_trie_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents", "doc_id", "text"), token_counts.vocabulary(VOCABULARY),
                                     token_counts.has_bytes(VOCABULARY))


def op6_random_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_word_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predictions(docs, model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_variable_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.packed(docs.select("doc_id", packing.token_count(F.col("text")).alias("n_tokens")))


def op7_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.exact_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op10_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), words=3, per_cent=85)


def op11_subset_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.prepared(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")))


def op12_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = divergence.quality_rules(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return found.drop("class_distance", "word_distance")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_cumulative_links, op2_weak_quality, op3_line_blocks, op4_surrogates, op5_trie_unigram, op6_random_walks, op7_chunk_recipes,
        op8_word_backoff, op9_variable_bins, op10_odd_sketches, op11_subset_tables, op12_burst_trie,
        op13_divergence,
    )
}

def _judged(of: str) -> str:
    """DuckDB: the rows of ``base`` judged by the references of the rows ``of`` a table, as in ``divergence``."""
    d = divergence
    part = "CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END"
    classes = " + ".join(part.format(p=f"(b.c[{i}] / greatest(list_sum(b.c), 1))", q=f"(s.c[{i}] / greatest(list_sum(s.c), 1))") for i in range(1, d.N_CLASSES + 1))
    sums = ", ".join(f"sum(c[{i}])" for i in range(1, d.N_CLASSES + 1))
    return rf"""
s AS (SELECT lang, sum(pn) AS pn, [{sums}] AS c FROM {of} WHERE lang IS NOT NULL GROUP BY lang HAVING sum(pn) >= {d.REFERENCE_WORDS}),
k AS (SELECT lang, word, n FROM (SELECT lang, word, sum(h.n) AS n, row_number() OVER (PARTITION BY lang ORDER BY sum(h.n) DESC, word) AS i
  FROM {of} JOIN h USING (r) WHERE length(word) <= {d.LONGEST_COMMON} GROUP BY lang, word) WHERE i <= {d.COMMON}),
q AS (SELECT k.lang, k.word, k.n / s.pn AS q FROM k JOIN s USING (lang)),
o AS (SELECT s.lang, coalesce(sum(q), 0) AS q FROM s LEFT JOIN q USING (lang) GROUP BY s.lang),
spoken AS (SELECT DISTINCT r FROM h JOIN q USING (word)),
f AS (SELECT b.r, q.lang, sum(coalesce(h.n, 0) / greatest(b.pn, 1)) AS p,
  sum({part.format(p="(coalesce(h.n, 0) / greatest(b.pn, 1))", q="q.q")}) AS d
  FROM base b CROSS JOIN q LEFT JOIN h ON h.r = b.r AND h.word = q.word GROUP BY b.r, q.lang),
x AS (SELECT b.r, min(sqrt(greatest(({classes}) / 2, 0))) AS cd,
  min(CASE WHEN f.lang IS NULL THEN 0 ELSE sqrt(greatest((f.d + {part.format(p="(1 - f.p)", q="greatest(0, 1 - o.q)")}) / 2, 0)) END) AS wd
  FROM base b CROSS JOIN s JOIN o ON o.lang = s.lang LEFT JOIN f ON f.r = b.r AND f.lang = s.lang GROUP BY b.r),
judged AS (SELECT b.*, NOT base_failed AND NOT (
    (b.lang IS NULL OR b.lang IN (SELECT lang FROM s)) AND (
      coalesce(word_chars >= {d.LEAST_CHARS} AND cd > {d.CLASS_LIMIT}, false)
      OR coalesce(pn >= {d.LEAST_WORDS} AND b.r IN (SELECT r FROM spoken) AND wd > {d.WORD_LIMIT} + {d.WORD_NOISE} / sqrt(greatest(pn, 1)), false))) AS kept
  FROM base b LEFT JOIN x USING (r))"""


LLM_ORACLES = {
    "op11_subset_tables": """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1] * z[2], 0)))::BIGINT AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) AS i FROM s WHERE same) WHERE i <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.i ORDER BY s.score DESC, s.id, s.br) AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""",
    "op12_burst_trie": """
WITH o AS (SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, t, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda s, i: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295) % 9 AS h FROM o),
r AS (SELECT h.c, coalesce(p.t[1:h.h], []) || h.t[h.h + 1:] AS t FROM h LEFT JOIN o p ON p.c = h.c - h.c % 5),
m AS (SELECT c, t[1:d] AS p, d, len(t) AS n, t FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM r)),
v AS (SELECT p, d, min(c) AS c, count(*) AS n, (count(*) - 1) * strlen(coalesce(p[d].text, '')) AS w,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS e FROM m GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS k FROM v WHERE d > 0 GROUP BY ALL),
u AS (SELECT v.*, coalesce(k.k, 0) AS k FROM v LEFT JOIN k USING (p)),
s AS (SELECT p[1:a] AS p, sum((k = 0)::INT) AS leaves, sum(w) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM u) GROUP BY ALL)
SELECT u.c AS conv_id, u.d AS depth, q.c AS parent_conv_id, u.n AS n_convs, u.k AS n_children, s.leaves::BIGINT AS n_leaves,
  s.saved::BIGINT AS saved_tokens, u.e AS ends_sha256
FROM u JOIN s USING (p) LEFT JOIN v q ON u.d > 0 AND q.p = u.p[1:u.d - 1]
""",
    "op13_divergence": rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
u AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{M}}]+'), lambda x: x <> '') AS pw,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
  regexp_replace(t, '[\p{{L}}\p{{M}}\x20\x09-\x0D]+', '', 'g') AS odd,
  length(regexp_replace(t, '[^\p{{Lu}}\p{{Lt}}]+', '', 'g')) AS upper FROM t),
g AS (SELECT r, i, w[i:i + 4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM u)),
a AS (SELECT DISTINCT r, i + j AS at FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g), range(5) s(j) WHERE n > 1),
n AS (SELECT r, count(*) AS n FROM a GROUP BY r),
v AS (SELECT r, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  coalesce(n.n, 0)::BIGINT AS n_repeat_words, len(pw) AS pn, pw, upper, length(odd) AS odd,
  length(regexp_replace(odd, '[^\p{{N}}]+', '', 'g')) AS digit,
  length(regexp_replace(regexp_replace(odd, '[#%&*@/\\_]', '', 'g'), '[^\p{{P}}]+', '', 'g')) AS mark FROM u LEFT JOIN n USING (r)),
base AS (SELECT r, doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, pn,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  [upper, word_chars - upper - odd, digit, mark, odd - digit - mark] AS c FROM v),
h AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(pw) AS word FROM v) GROUP BY r, word),
first AS (WITH {_judged("base")} SELECT * FROM judged),
ok AS (SELECT lang FROM first WHERE kept GROUP BY lang HAVING lang IS NOT NULL AND sum(pn) >= {divergence.REFERENCE_WORDS}),
again AS (SELECT * FROM first WHERE kept AND lang IN (SELECT lang FROM ok) OR lang NOT IN (SELECT lang FROM ok)),
last AS (WITH {_judged("again")} SELECT * FROM judged)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM last
""",
    "op7_chunk_recipes": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM g
""",
    "op10_odd_sketches": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
""",
}
