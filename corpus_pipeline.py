"""Corpus pipeline: toxicity, quality rules, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept. All but the last return
the columns of ``docs``. A stage's decisions take effect: rejected documents go, personal data is replaced, and of each
group of near duplicates the document with the smallest id stays. Models are learned from the labels of ``sf_dir`` and
the documents at hand. Null texts and ids, repeated rows and empty tables are handled as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.llm import near_duplicates, packing, pii, quality, toxicity
from rillhouse.llm.common import table, written


def _carried(docs: DataFrame) -> DataFrame:
    """The id, the text and the whole row, whose columns may then be named like an operator's own."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("document"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = toxicity.fit(toxicity.sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, model)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    judged = quality.judge_quality(_carried(docs), table(spark, sf_dir, "labels"))
    return judged.where("kept").select("document.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity of 0.8): that with the smallest id.

    Rows are linked, kept and dropped one by one, whatever their ids: rows that repeat an id and rows without id are members
    of groups like others. An id comes before none; of rows alike in that, any one stays. Texts without words are in no group.
    """
    rows = written(docs.select(F.monotonically_increasing_id().alias("key"), F.struct(*docs.columns).alias("document")), "near-duplicate-rows")
    texts = rows.select("key", F.col("document.text").alias("text"))
    groups = near_duplicates.link_near_duplicates(texts, n=5, threshold=80, id_col="key")
    others = written(groups.where("key <> component_id").select("key", "component_id"), "near-duplicates")
    members = others.unionAll(others.select(F.col("component_id").alias("key"), "component_id").distinct())
    ids = rows.select("key", F.col("document.doc_id").alias("id")).join(members, "key")
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    gone = written(members.join(first.select(F.col("first.key").alias("key")), "key", "left_anti").select("key"), "near-duplicates-gone")
    return rows.join(gone, "key", "left_anti").select("document.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each span of personal data replaced by its kind in brackets."""
    found = pii.find_personal_data(_carried(docs))
    return found.select(*[pii.redacted(F.col("text"), F.col("found")).alias(c) if c == "text" else F.col("document")[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of all documents with bucket and batch."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality_rules", apply_quality_rules), ("ngram_jaccard", drop_near_duplicates),
          ("pii", redact_personal_data), ("packing", pack_sequences)]

#: Learned models and batch numbers are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
