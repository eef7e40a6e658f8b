"""Passages of texts: words side by side count together wherever they stand."""

import numpy as np

from rillhouse.llm import toxicity


def test_every_word_and_every_half_passage_is_whole_in_one():
    assert len(toxicity.passages(0)[0]) == 0
    for n in range(1, 100):
        start, end = toxicity.passages(n)
        assert max(end - start) <= toxicity.PASSAGE
        half = min(n, toxicity.PASSAGE // 2)
        assert all(any(s <= i and i + half <= e for s, e in zip(start, end)) for i in range(n - half + 1))


def test_one_more_word_in_front_changes_nothing():
    scorer = toxicity.Scorer(toxicity.Model(np.zeros(1 << toxicity.BITS, np.float32), -1.0))
    scorer.values.update({"vile": 5.0, "wretch": 5.0})  # together above 0.5, alone below
    for before in range(40):
        for after in (0, 3, 30):
            words = ["tame"] * before + ["vile", "wretch"] + ["calm"] * after
            assert scorer.scores([" ".join(words)])[0] > 0.5
            assert scorer.scores([" ".join(words).replace("wretch", "calm")])[0] < 0.5
