"""The classifier: held-out labels of the given tables, its updates against plain ones, and odd inputs."""

import math
import random

import numpy as np
import pytest
from conftest import SMALL

from rillhouse.llm import quality_classifier as Q
from rillhouse.llm.queries import QUERIES

ODD = [None, "", " \n\t", "é😀  x", "w " * 60_000, "The The\nThe The", "x\x1cy", "a" * 300_000, "\ud83d alone"]


def judged(spark, folder):
    got = QUERIES["op12_quality_classifier"](spark, folder)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    return [(label[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and label.get(r["doc_id"]) is not None]


@pytest.mark.parametrize("folder, least_bad", [(SMALL, 1), ("/root/testdata/sf0.01", 10), ("/root/testdata/sf0.1", 100)])
def test_held_out_labels(spark, folder, least_bad):
    pairs = judged(spark, folder)
    bad, good = ([p for y, p in pairs if y == k] for k in (0, 1))
    assert len(bad) >= least_bad
    assert sum(bad) <= 0.05 * len(bad)
    assert sum(good) >= 0.98 * len(good)


def test_updates_are_those_of_the_method():
    """Against the update rule, one coordinate at a time."""
    leader, z, n = Q.Leader(), {}, {}
    dice = random.Random(8)

    def w(i):
        l1 = 0 if i == 1 << Q.BITS else Q.L1
        v = z.get(i, 0)
        return 0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((Q.BETA + math.sqrt(n.get(i, 0))) / Q.ALPHA + Q.L2)

    for _ in range(200):
        at, good, share = sorted(dice.sample(range(30), 6)), dice.random() < 0.5, dice.choice([1.0, 2.5])
        x = [dice.random() for _ in at]
        leader.learn(np.array(at), np.array(x), good, share)
        both = [*zip(at, x), (1 << Q.BITS, 1.0)]
        p = 1 / (1 + math.exp(-sum(w(i) * v for i, v in both)))
        for i, v, old in [(i, v, w(i)) for i, v in both]:
            g = share * (p - good) * v
            before = n.get(i, 0)
            n[i] = before + g * g
            z[i] = z.get(i, 0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / Q.ALPHA * old
    model = leader.model()
    assert model.bias == pytest.approx(w(1 << Q.BITS))
    assert model.weights[:30].tolist() == pytest.approx([w(i) for i in range(30)], rel=1e-6, abs=1e-7)


def test_scores_are_sparse_dot_products():
    """A score is the same from the text's vector, alone or among others."""
    dice = np.random.default_rng(1)
    model = Q.Model(dice.normal(size=1 << Q.BITS).astype(np.float32), 0.3)
    texts = [t for t in ODD if t is not None and "\ud83d" not in t] + ["THE CAT!! the&&& a | b a a"]
    scores = model.scores(texts)
    for t, s in zip(texts, scores):
        at, x = Q.vector(t.encode())
        z = float(model.weights[at].astype(float) @ x) + model.bias + Q.SHIFT
        assert s == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        assert model.scores([t]) == pytest.approx([s])
    assert x.sum() == pytest.approx(Q.KINDS)


def test_shapes():
    assert Q.shape(b"The CAT99 a&&&") == b"\x01\x03 \x01\x02 \x03&"
    assert Q.shape(b"") == b""


def test_odd_rows(spark):
    texts = [t for t in ODD if t is None or "\ud83d" not in t]
    rows = [(i, t, 1, 0.5, "v") for i, t in enumerate(texts)] + [(None, "no id", 1, 0.5, "v"), (0, "again", 1, 0.5, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int, score double, at string")
    labels = spark.createDataFrame([(3, 1, 9), (5, 0, 9), (0, 1, 9), (None, 1, 9), (4, None, 9), (6, 7, 9)], "doc_id long, quality int, y int")
    model = Q.fit(Q.sample(docs, labels))
    got = Q.score_quality(docs, model).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    score = {r["doc_id"]: r["score"] for r in got if r["doc_id"] != 0}
    assert score[3] > score[5] and score[1] == score[2]
    for empty in (Q.sample(docs.limit(0), labels), Q.sample(docs, labels.limit(0)), Q.sample(docs, labels.where("quality = 1"))):
        neutral = Q.fit(empty)
        assert [r["score"] for r in Q.score_quality(docs, neutral).collect()] == pytest.approx([Q.LIMIT] * len(rows))
    assert Q.score_quality(docs.limit(0), model).count() == 0


def test_the_sample_is_bounded(spark):
    docs = spark.range(100).selectExpr("id % 40 AS doc_id", "concat('word ', id) AS text")
    labels = spark.range(40).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    counts = {r["y"]: r["count"] for r in Q.sample(docs, labels, rows=7).groupBy("y").count().collect()}
    assert counts == {0: 7, 1: 7}
