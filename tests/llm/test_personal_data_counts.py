"""Models of personal data come from all candidates."""

import numpy as np
from pyspark.sql import functions as F

from rillhouse.llm import pii


def _counted(spark, docs) -> dict:
    """Candidates by label as they reach the trees."""
    seen, fit_trees = {}, pii.fit_trees

    def kept(x, labels, w, *more):
        for label, n in zip(labels, w):
            seen[label] = seen.get(label, 0) + n
        return fit_trees(x, labels, w, *more)

    pii.fit_trees = kept
    try:
        pii.fit(docs)
    finally:
        pii.fit_trees = fit_trees
    return seen


def test_all_candidates_are_learned_from(spark):
    """Many texts, and one with many spans; a copy counts once."""
    n = F.col("id")
    mails = spark.range(9000).select(F.concat(F.lit("write to a"), n, F.lit("@mail.example.com or +1 202 555 0"), 100 + n % 900).alias("text"))
    long = spark.createDataFrame([(" ".join(f"host 10.200.{100 + i // 250}.{i % 250} id 88{i:06d}77" for i in range(5000)),)] * 2, "text string")
    seen = _counted(spark, mails.unionByName(long).select(F.lit(1).alias("doc_id"), "text"))
    assert seen == {"email": 9000, "phone": 9000, "ip": 5000, None: 5000}


def test_numbers_weigh_as_so_many_rows():
    """A row that counts three candidates is as good as three rows."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (200, len(pii.FEATURES))).astype(float)
    labels = ["ip" if r[0] + r[1] > 6 else None for r in x]
    w, part = rng.integers(1, 4, 200), rng.integers(0, pii.PARTS, 200)
    often = np.repeat(np.arange(200), w)
    one, many = pii.fit_trees(x, labels, w.astype(float), part), pii.fit_trees(x[often], [labels[i] for i in often], np.ones(len(often)), part[often])
    assert one.keys() == many.keys() == {"ip"}
    assert np.allclose(pii.scored(one["ip"][0], x), pii.scored(many["ip"][0], x)) and np.isclose(one["ip"][1], many["ip"][1])
