"""The manifest against one built in plain Python, with odd inputs."""

import hashlib
import zlib

import pytest

from rillhouse.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    texts = [None if v is None else str(v) for v in row]
    return h(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def grown(digests):
    """All levels of a tree."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    """Siblings of the leaf ``i`` as (left, right), level by level."""
    for level in levels[:-1]:
        j = i - i % 3
        yield level[j:i], level[i + 1:j + 3]
        i //= 3


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    trees = {}
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = grown([leaf_of(r) for r in groups[s]])
    upper = grown([trees[s][-1][0] for s in order])
    root = upper[-1][0]
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            sides = [*path(trees[s], i), *path(upper, k)]
            proof = h(*[x for left, right in sides for x in (*left, *right)])
            node = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                node = leaf_of((*r[:4], r[4].replace("\n", "")))
            for left, right in sides:
                node = h(*left, node, *right)
            yield r[0], leaf_of(r), trees[s][-1][0], root, proof, node, node == root


ODD = [(1, None, None, None, None), (2, "", "", 0, ""), (None, "a", "en", 1, "x\ny"), (3, "a", "en", 1, "é\n😀" * 3000),
       (3, "a", "en", 1, "other"), (4, "é", None, -7, "\n"), (4, "é", None, -7, "\n"), (5, "z", "x", 3, "t\n"), (6, "z", "x", 3, "t\n")]
SETS = {
    "odd": ODD,
    "hot": [(i, "hot" if i % 3 else f"s{i % 11}", "en", i, f"text {i}\nline") for i in range(250)],
    "alike": [(7, "hot", "en", 1, "same\n")] * 40 + [(8, "b", None, None, None)],
    "one": [(10, "s", "en", 1, "a\nb")],
    "one group": [(i, None, "en", 1, "a\nb") for i in range(28)],
}


@pytest.mark.parametrize("name", SETS)
def test_manifest_equals_plain_trees(spark, name):
    rows = SETS[name]
    # More columns, named like the operator's own.
    df = spark.createDataFrame([(*r, 1, "r", 2, "x") for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, rank int, tree string, low int, digest string")
    got = merkle.manifest(df.repartition(5))
    got = got.withColumn("proof", merkle.proof_digest(got["proof"])).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.manifest(df).collect() == []


def test_ranks_do_not_gather_a_group(spark):
    """Rows of one group stay in many partitions, also rows that are alike."""
    df = spark.range(2000).selectExpr("'hot' AS g", "id % 2 AS i", "1 AS digest")
    placed = merkle.ranked(df, "g", "i", "digest")
    assert sorted(r["rank"] for r in placed.collect()) == list(range(2000))
    folder = placed.inputFiles()[0].rsplit("/", 1)[0]
    sizes = [r["n"] for r in spark.read.parquet(folder).groupBy("part").count().selectExpr("count AS n").collect()]
    assert len(sizes) == 4 and max(sizes) < 1000


def test_heights(spark):
    from pyspark.sql import functions as F
    counts = [1, 2, 3, 4, 9, 10, 27, 28, 3 ** 20, 3 ** 20 + 1, 3 ** 38 + 1]
    df = spark.createDataFrame([(n,) for n in counts], "n long")
    assert [r[0] for r in df.select(merkle.height(F.col("n"))).collect()] == [0, 1, 1, 2, 2, 3, 3, 4, 20, 21, 39]
