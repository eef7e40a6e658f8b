"""The pipeline's stages over a small table."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.test_operators import brute_groups

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    names, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, corpus_pipeline.written(stage(spark, kept, SMALL), f"test-{name}")
        assert kept.columns == names
        if name == "quality_rules":
            long = before.where(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) >= 50).join(labels, "doc_id")
            clean, bad = (long.where(F.col("quality") == q).select("doc_id") for q in (1, 0))
            assert clean.join(kept, "doc_id", "left_anti").count() == 0
            assert bad.join(kept, "doc_id").count() < bad.count()
        if name == "ngram_jaccard":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            want = sorted(i for i, _, c in brute_groups(rows, 5, 80) if i == c)
            assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert not kept.where(F.col("text").rlike(r"[a-z]@[a-z0-9]+\.")).count()
    packed = corpus_pipeline.pack_sequences(spark, kept, SMALL)
    words = kept.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert packed.agg(F.sum("n_tokens")).first()[0] == words


def test_one_row_of_each_group(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a, "x"), (None, a, "null"), (2, a + " end", "near"), (None, b, "x"), (None, b, "x"), (3, c, "x"), (3, c, "x"), (3, c + " end", "x"),
            (2, d, "own"), (4, None, "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"] or 0, (r["text"] or "-")[0]) for r in kept.collect()))
    assert got == [(0, "b"), (1, "a"), (2, "d"), (3, "c"), (4, "-")]


def test_columns_named_like_those_of_operators(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    names = {"quality_rules": ["n_words", "n_digits", "rule", "kept", "base_failed", "document"], "pii": ["base_found", "found", "document"]}
    for name, stage in corpus_pipeline.STAGES:
        if name in names:
            mine = docs.withColumns({c: F.concat(F.lit(f"{c} "), "doc_id") for c in names[name]})
            kept = stage(spark, mine, SMALL)
            assert kept.columns == mine.columns
            rows = kept.collect()
            assert rows and all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in names[name])
