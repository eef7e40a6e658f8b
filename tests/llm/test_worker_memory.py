"""Python workers live on after a task: what it freed goes back to the system, not to the stages after it."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from rillhouse.llm import toxicity

ROOT = Path(__file__).resolve().parents[2]
#: The training task as a worker runs it, with the memory that the process holds before and after; one round, tables as large as ever.
TASK = """
import random, re
import pyarrow as pa
import pyspark.worker
from rillhouse.llm import toxicity

def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

class Frame:
    sparkSession = None
    select = lambda self, *c: self
    coalesce = lambda self, n: self
    first = lambda self: None

    def mapInArrow(self, f, schema):
        self.task = f
        return self

toxicity.ship = lambda spark: spark
toxicity.MOST_ROUNDS = 1
rng = random.Random(3)
words = [f"w{rng.randrange(10 ** 9)}" for _ in range(200_000)]
texts = pa.record_batch([[" ".join(rng.choices(words, k=300)) for _ in range(1_200)], [i % 2 for i in range(1_200)]], ["t", "y"])
frame = Frame()
before = held()
toxicity.fit(frame)
rows = list(frame.task(iter([texts])))
print(held() - before, len(rows))
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="reads Linux' figures of memory")
def test_training_leaves_little_behind():
    done = subprocess.run([sys.executable, "-c", TASK], cwd=ROOT, env=os.environ | {"PYTHONPATH": str(ROOT)}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    left, rows = done.stdout.split()
    assert rows == "1" and float(left) < 40, done.stdout  # 134 MB when nothing was given back


def test_rows_kept_are_those_scored_below_the_limit(spark):
    texts = [(i, f"{'vile' if i % 3 == 0 else 'kind'} words number{i}") for i in range(3 * toxicity.TEXTS_AT_ONCE)] + [(-1, None), (-2, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    model = toxicity.fit_texts([(t, int(i % 3 == 0)) for i, t in texts[:120]])
    score = dict(zip([i for i, _ in texts], toxicity.Scorer(model).scores([t for _, t in texts])))
    kept = [r.doc_id for r in toxicity.keep_clean(docs, model).collect()]
    assert kept == [i for i, _ in texts if score[i] < 0.5] and 0 < len(kept) < len(texts)
