"""Mined negatives against brute force in Python's own numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillhouse.llm import hard_negatives as H


def brute(rows, anchor, scale=256):
    whole = [(i, l, [math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale for x in v]) for i, l, v in rows
             if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    fit = lambda s: max(min(s, 2 ** 63 - 1), -2 ** 63)
    for k, (i, label, v) in enumerate(whole):
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for n, (j, m, w) in enumerate(whole) if n != k and len(w) == len(v))
        for s, j, m in [x for x in scored if x[2] == label][:5]:
            found = [(t, o) for t, o, m2 in scored if m2 != label and -50 * s <= -100 * t <= -95 * s][:3]
            yield from ((i, j, r, o, fit(-s), fit(-t)) for r, (t, o) in enumerate(found, 1))


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "a") for r in rows], "vec_id long, label int, embedding array<double>, row int, r string")
    return sorted(map(tuple, H.hard_negatives(df.repartition(3), F.col("vec_id") % 10 == 0, F.col("label"), **more).collect()))


def vectors(n, d, size=1.0, seed=1):
    dice = random.Random(seed)
    return [[dice.gauss(0.6, 1) * size for _ in range(d)] for _ in range(n)]


ODD = [(900, 1, None), (901, 1, []), (902, None, [1.0] * 6), (None, 1, [1.0] * 6), (903, 2, [1.0, None] * 3), (904, 2, [float("nan")] * 6),
       (905, 3, [float("inf")] * 6), (910, 1, [1.0, 2.0]), (911, 1, [1.5, 2.0]), (912, 2, [1.25, 1.75]), (920, 1, [0.0] * 6), (921, 9, [0.0] * 6)]


@pytest.mark.parametrize("size", [1.0, 1e-3, 1e6, 1e12, 1e307])
def test_equals_brute_force_at_every_size(spark, size):
    rows = [(i, i % 3, v) for i, v in enumerate(vectors(90, 6, size))] + ODD
    assert mined(spark, rows) == sorted(brute(rows, lambda i: i % 10 == 0)) != []


def test_sizes_may_differ_within_a_table(spark):
    dice = random.Random(3)
    rows = [(i, i % 2, [x * 10.0 ** dice.choice([0, 4, 9, 40]) for x in v]) for i, v in enumerate(vectors(60, 4))]
    assert mined(spark, rows) == sorted(brute(rows, lambda i: i % 10 == 0))


def test_ties_and_copies(spark, monkeypatch):
    """A third of the rows hold one vector; small steps and cells give the same rows."""
    rows = [(i, i % 4, v) for i, v in enumerate(vectors(100, 5))] + [(100 + i, i % 2, [1.0] * 5) for i in range(50)]
    rows += [(200 + i, 2, [0.7] * 5) for i in range(9)]
    want = sorted(brute(rows, lambda i: i % 10 == 0))
    assert mined(spark, rows) == want
    for name, value in (("ANCHOR_STEP", 4), ("ROW_STEP", 7), ("ROW_BYTES", 40 * 11), ("ANCHOR_BYTES", 40 * 5)):
        monkeypatch.setattr(H, name, value)
    assert mined(spark, rows) == want


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, 1, [1.0, 1.0])] * 3 + [(1, 2, [0.9, 0.8]), (2, 2, [0.7, 0.6])]
    got = mined(spark, rows)
    assert [r[:3] for r in got] == [(0, 0, 1)] * 6 + [(0, 0, 2)] * 6 and {r[3] for r in got} == {1, 2}


def test_no_rows(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0])]) == [] and mined(spark, [(0, 1, [1.0])]) == []


def test_residues_are_exact():
    dice = np.random.default_rng(2)
    for top, d in ((300, 64), (1 << 22, 300), (1 << 40, 1500), (1 << 52, 3)):
        a, b = (dice.integers(-top, top, (n, d)).astype(float) for n in (7, 11))
        want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b] for r in a], object)
        assert (H.scores(H.Block(a), H.Block(b)) == want).all()
    for depth, largest in ((64, 10 ** 6), (1024, 10 ** 30), (1024, 10 ** 700)):
        depth, found = H.enough_primes(depth, largest)
        assert math.prod(found) > 2 * largest and all(depth * ((p - 1) // 2) ** 2 < 1 << 24 for p in found)


def test_sort_texts():
    numbers = sorted([0, 1, -1, 9, 10, -9, -10, 10 ** 25, -10 ** 25, 12345, -12345])
    assert sorted(numbers, key=H.sort_text) == numbers and [H.number(H.sort_text(n)) for n in numbers] == numbers
