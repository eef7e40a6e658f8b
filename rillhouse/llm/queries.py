"""One query per operator over the test tables, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.llm import (bpe, exact_search, hard_negatives, language_model, merkle, near_duplicates, packing, pii, quality, quality_classifier,
                           token_counts, toxicity, url_filter)
from rillhouse.llm.common import crc_mod5, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op2_url_filters(spark, d):
    return url_filter.judge_urls(table(spark, d, "pages"), url_filter.rule_table(spark, URL_RULES))


ORACLES["op2_url_filters"] = """
WITH r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fit AS (SELECT p.page_id, max(struct_pack(n := length(rhost || rpath), h := length(rhost), rule := rhost || rpath, v := verdict)) AS best
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY p.page_id)
SELECT p.page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM p LEFT JOIN fit USING (page_id)
"""


@query
def op7_bpe(spark, d):
    return bpe.encode_digests(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_quality_rules(spark, d):
    judged = quality.judge_quality(table(spark, d, "documents"), table(spark, d, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "rule")


@query
def op10_token_counts(spark, d):
    return token_counts.count_tokens(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_pii(spark, d):
    found = pii.find_personal_data(table(spark, d, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS],
                        F.sha2(pii.listed(F.col("base_found")).cast("binary"), 256).alias("base_sha256"),
                        pii.listed(F.col("found")).alias("spans"))


@query
def op1_toxicity(spark, d):
    docs = table(spark, d, "documents")
    model = toxicity.fit(toxicity.sample(docs, table(spark, d, "labels"), keep=crc_mod5(F.col("k")) != 0))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", (crc_mod5(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_ngram_jaccard(spark, d):
    return near_duplicates.link_near_duplicates(table(spark, d, "documents"), n=4, threshold=85)


ORACLES["op4_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3]) END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) m USING (doc_id)
"""


@query
def op5_exact_top_k(spark, d):
    return exact_search.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


ORACLES["op5_exact_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
p AS (SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v)::BIGINT AS score FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p
QUALIFY rank <= 20
"""


@query
def op6_language_model(spark, d):
    docs = table(spark, d, "documents")
    model = language_model.fit(docs.where(language_model.in_training(F.col("doc_id"))))
    scores = language_model.score_texts(docs, model)
    return scores.select("doc_id", (~language_model.in_training(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score", "perplexity")


@query
def op9_packing(spark, d):
    return packing.pack(table(spark, d, "documents"))


@query
def op11_merkle_manifest(spark, d):
    proved = merkle.manifest(table(spark, d, "documents"))
    return proved.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                         "folded_root", "verified")


def _leaf_sql(text: str) -> str:
    """The leaf digest in SQL, for a text expression."""
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


# crc32 by its polynomial, bit by bit: each byte of the id's text is followed by eight shifts, marked -1.
ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {_leaf_sql('text')} AS leaf, {_leaf_sql("replace(text, chr(10), '')")} AS changed,
    xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) AS crc FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM d),
nodes AS (SELECT tree, 0 AS level, pos, leaf AS h, n FROM r UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3),
tops AS (SELECT tree, h FROM nodes WHERE n = 1),
upper AS (SELECT 0 AS level, tree AS pos, h, (SELECT count(*) FROM tops) AS n FROM tops UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM upper WHERE n > 1 GROUP BY level, pos // 3),
every AS (SELECT tree, level, pos, h, n FROM nodes UNION ALL SELECT -1, level, pos, h, n FROM upper),
steps AS (SELECT r.tree, r.pos, 0 AS part, k AS level, r.tree AS inside, r.pos // (3 ** k)::BIGINT AS own FROM r, range(0, 40) t(k) WHERE 3 ** k < 3 * r.n
  UNION ALL SELECT r.tree, r.pos, 1, k, -1, r.tree // (3 ** k)::BIGINT FROM r, range(0, 40) t(k) WHERE 3 ** k < 3 * (SELECT count(*) FROM tops)),
sides AS (SELECT s.tree, s.pos, s.part, s.level, coalesce(string_agg(e.h, '' ORDER BY e.pos) FILTER (e.pos < s.own), '') AS l,
    coalesce(string_agg(e.h, '' ORDER BY e.pos) FILTER (e.pos > s.own), '') AS r
  FROM steps s JOIN every e ON e.tree = s.inside AND e.level = s.level AND e.pos // 3 = s.own // 3 WHERE e.n > 1 GROUP BY ALL),
proofs AS (SELECT tree, pos, string_agg(l || r, '' ORDER BY part, level) AS joined, list(l || ':' || r ORDER BY part, level) AS steps FROM sides GROUP BY tree, pos),
whole AS (SELECT r.doc_id, r.leaf, t.h AS subroot, u.h AS root, sha256(coalesce(joined, '')) AS proof_sha256,
    list_reduce(list_concat([CASE WHEN crc % 2 = 0 THEN changed ELSE leaf END], coalesce(p.steps, [])),
      lambda x, s: sha256(split_part(s, ':', 1) || x || split_part(s, ':', 2))) AS folded_root
  FROM r JOIN tops t USING (tree) JOIN upper u ON u.n = 1 LEFT JOIN proofs p ON p.tree = r.tree AND p.pos = r.pos)
SELECT *, folded_root = root AS verified FROM whole
"""


def _held_for_quality(doc_id):
    """crc32 of the id as text leaves 2, modulo 4; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


@query
def op12_quality_classifier(spark, d):
    docs = table(spark, d, "documents")
    model = quality_classifier.fit(quality_classifier.sample(docs, table(spark, d, "labels"), keep=~_held_for_quality(F.col("k"))))
    return quality_classifier.score_quality(docs, model).select(
        "doc_id", _held_for_quality(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality_classifier.LIMIT).cast("int").alias("predicted"))


@query
def op13_hard_negatives(spark, d):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0, label)


ORACLES["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, x.vec_id, x.label = a.label AS alike, list_dot_product(a.v, x.v)::BIGINT AS score
  FROM v a JOIN v x ON a.vec_id <> x.vec_id AND len(a.v) = len(x.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3
"""
