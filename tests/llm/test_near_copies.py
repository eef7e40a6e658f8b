"""Groups of texts that are alike, but not alike enough to link."""

import random

from rillhouse.llm import near_duplicates


def _group(words: int, edits: int, copies: int, seed: int = 3) -> list[tuple[int, str]]:
    """Copies of one text, each with its own words in some places."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    rows = []
    for i in range(copies):
        text = list(base)
        for at in rng.sample(range(5, words - 5, 5), edits):  # far enough apart to change four n-grams each
            text[at] = f"x{i}y{at}"
        rows.append((i, " ".join(text)))
    return rows


def test_few_texts_with_many_words_of_their_own_are_compared(spark, monkeypatch):
    compared, verified = [], near_duplicates._verified

    def counted(pairs, *more):
        compared.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(near_duplicates, "_verified", counted)
    docs = spark.createDataFrame(_group(400, 6, 40), "doc_id long, text string")
    found = near_duplicates.link_near_duplicates(docs, n=4, threshold=85).collect()
    assert all(r.component_id == r.doc_id for r in found) and len(found) == 40
    assert sum(compared) < 40, compared  # of 780 pairs; those left have words of their own in the same places


def test_near_copies_link_as_by_all_pairs(spark):
    rows = [(100 * k + i, t) for k, edits in enumerate((1, 2, 3)) for i, t in _group(120 + 40 * k, edits, 30, k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates.link_near_duplicates(docs, n=4, threshold=85).collect()}
    sets = {i: {tuple(t.split()[j:j + 4]) for j in range(len(t.split()) - 3)} for i, t in rows}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if least[b] < least[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    least[a], changed = least[b], True
    assert found == least and len(set(least.values())) not in (1, len(sets))
