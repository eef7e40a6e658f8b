"""Plans of components and of the last step of near duplicates stay small."""

import random

from pyspark.sql import functions as F

from rillhouse.llm import components as module
from rillhouse.llm import near_duplicates


def _leaves(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def _least(edges) -> dict:
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_edges_of_many_tables_enter_one_plan_once(spark, monkeypatch, tmp_path):
    rng = random.Random(5)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7)]
    parts = []
    for k in range(3):
        spark.createDataFrame(edges[k::3], "a long, b long").write.parquet(f"{tmp_path}/{k}")
        parts.append(spark.read.parquet(f"{tmp_path}/{k}"))
    sizes, written = [], module.written

    def counted(df, name):
        sizes.append(_leaves(df))
        return written(df, name)

    monkeypatch.setattr(module, "written", counted)
    found = module.components(parts[0].unionAll(parts[1]).unionAll(parts[2]))
    want = {x: r for x, r in _least([e for e in edges if e[0] != e[1]]).items()}
    assert {r.node: r.root for r in found.collect()} == want
    assert max(sizes) <= 4, sizes  # 36 and more when a round was one plan


def test_no_further_components_without_further_links(spark, monkeypatch):
    runs, components = [], near_duplicates.components
    monkeypatch.setattr(near_duplicates, "components", lambda links: runs.append(1) or components(links))
    texts = [" ".join(f"{x}{i}" for i in range(60)) for x in "abc"]
    rows = [(i, t + end) for i, (t, end) in enumerate((t, e) for t in texts for e in ("", "", " end"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.link_near_duplicates(docs, n=5, threshold=80)
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(i, i // 3 * 3) for i in range(9)]
    assert len(runs) == 1, runs  # the first step found all links
    assert found.select(F.count_distinct("component_id")).first()[0] == 3
