"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its hashed parts: itself and its character n-grams, with marks at both
ends; so a misspelling that was never seen shares vectors with the word it comes from. The distinct words of a
passage are averaged and enter a softmax of two classes. Long texts are covered by overlapping passages of
``PASSAGE`` words, each starting at most half a passage after the one before, so that a phrase of half a passage is whole in one; their bags padded with zero vectors to that size, and a text's score is that of its worst passage: a few words then count as much
in a long text as in a short one. Training learns vectors and softmax together by stochastic gradients;
each round takes a toxic text's worst passage so far as the example, and a clean text's two worst passages and four
random ones; the first examples are picked by the likelihood ratio of words' document counts. Some words of the examples are misspelt
at random, and both classes weigh the same. Buckets that a single training text touches say nothing, as rare words would only be learnt by heart.
The bias is set by the scores of models that did not see the texts they score, each trained without a third of them.

The model is fitted in one task from at most ``SAMPLE_ROWS`` labelled texts per class, picked by a hash of
the id. It is about ``2 ** BITS * WIDTH`` numbers, folded into one number per bucket before it is sent to workers.

Inputs: a null or empty text has no passage and gets the score of an empty bag, the softmax's bias. Rows repeat as
given, null ids included. Null labels are left out; without both classes the bias alone gives 0. Only the id, text
and label columns named are read.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import give_back, map_rows, ship, written

#: Labelled texts of each class that training sees at most.
SAMPLE_ROWS = 1800
#: Parts of the labelled texts that calibration leaves out in turn, and what a flagged clean text costs it.
FOLDS, FALSE_COST, PRIOR_TEXTS = 3, 3, 20
PASSAGE = 8
BITS, WIDTH = 20, 8
NGRAMS = (3, 4, 5)
#: Training ends after a round, but the first few, whose mean loss is below ``LOW_LOSS``: few texts take more rounds.
ROUNDS, MOST_ROUNDS, LOW_LOSS = 8, 60, 0.03
BATCH, RATE = 96, 0.5
MISSPELT, DECAY = 0.15, 0.001
#: Training texts that must share a bucket for it to count.
MIN_TEXTS = 2
#: Words whose value a Python worker remembers.
CACHED_WORDS = 300_000
#: Texts whose words are held, and words whose parts are worked on at the same time.
TEXTS_AT_ONCE = 256
WORDS_AT_ONCE = 5_000
WORD = re.compile(r"[^\W_]+(?:[^\w\s]?[^\W_]+)*")
LONG_WORD = 60
POWER = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def parts_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its character n-grams, one word after the other, and how many each has."""
    marked = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(marked)) - first[word]
    power = np.full(size.max(), POWER, np.uint64)
    power[0] = 1
    whole = np.add.reduceat((marked + 1) * np.cumprod(power)[place], first)
    owner, value = [np.arange(len(words))], [whole]
    for n in NGRAMS:
        at = np.flatnonzero(place + n <= size[word])
        gram = np.full(len(at), n, np.uint64)
        for k in range(n):
            gram = gram * POWER + marked[at + k]
        owner.append(word[at])
        value.append(gram)
    owner, value = np.concatenate(owner), np.concatenate(value)
    value ^= value >> np.uint64(31)
    value *= np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(owner, kind="stable")
    return (value >> np.uint64(64 - BITS)).astype(np.int64)[order], np.bincount(owner, minlength=len(words))


def passages(n: int, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of passages of at most ``size`` words; each starts at most half a passage after the one before."""
    k = max(min(n, 1), 1 - (size - n) // (size // 2))
    start = np.arange(k) * max(n - size, 0) // max(k - 1, 1)
    return start, np.minimum(start + size, n)


def misspelt(word: str, rng: random.Random) -> str:
    i = rng.randrange(len(word))
    kind = rng.randrange(4)
    if kind == 0:
        return word[:i] + word[i + 1:] or word
    if kind == 1:
        return word[:i] + word[i] + word[i:]
    if kind == 2 and i:
        return word[:i - 1] + word[i] + word[i - 1] + word[i + 1:]
    return word[:i] + rng.choice("abcdefghijklmnopqrstuvwxyz01345") + word[i + 1:]


@dataclass
class Model:
    #: For each bucket the difference of both classes' logits, and that of the biases.
    weights: np.ndarray
    bias: float

    def values(self, words: list[str]) -> np.ndarray:
        """What each word adds to the difference of the logits."""
        out = [np.zeros(0)]
        for i in range(0, len(words), WORDS_AT_ONCE):
            flat, size = parts_of(words[i:i + WORDS_AT_ONCE])
            out.append(np.add.reduceat(self.weights[flat].astype(float), np.cumsum(size) - size) / size)
        return np.concatenate(out)


def calibrated(model: Model, scored: list[tuple[float, int]]) -> Model:
    """The model with its bias moved so that 0.5 stands where (score, label) pairs of unseen texts part at the least cost:
    the share of toxic texts missed and ``FALSE_COST`` times the share of clean ones flagged. With n texts of the
    smaller class it moves n / (n + ``PRIOR_TEXTS``) of the way, as few texts place it badly."""
    p = np.clip(np.array([x for x, _ in scored]), 1e-12, 1 - 1e-12)
    order = np.argsort(p, kind="stable")
    logit, y = np.log(p / (1 - p))[order], np.array([label for _, label in scored])[order]
    cost = np.cumsum(y)[:-1] / y.sum() + FALSE_COST * np.cumsum((1 - y)[::-1])[::-1][1:] / (1 - y).sum()
    gap = np.where(np.isclose(cost, cost.min()), np.diff(logit), -1)  # of equal costs, the widest gap
    best = int(gap.argmax())
    n = min(y.sum(), (1 - y).sum())
    return Model(model.weights, model.bias - float(logit[best] + logit[best + 1]) / 2 * float(n / (n + PRIOR_TEXTS)))


def fit(examples: DataFrame) -> Model:
    """The model of a sample. One task reads and trains on it; only weights reach the driver."""
    ship(examples.sparkSession)

    def learn(batches):
        texts = [(t, y) for batch in batches for t, y in zip(batch.column("t").to_pylist(), batch.column("y").to_pylist())]
        model = fit_texts(texts)
        del texts
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([float(model.bias)])], ["weights", "bias"])

    row = examples.select("t", "y").coalesce(1).mapInArrow(learn, "weights binary, bias double").first()  # 4 * 2 ** BITS bytes
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"]) if row else Model(np.zeros(1 << BITS, np.float32), 0.0)


def fit_texts(texts: list[tuple[str, int]]) -> Model:
    """Trained on all (text, label) pairs. For calibration, each of ``FOLDS`` parts is scored by a model that did not see it,
    however few texts there are."""
    if len({y for _, y in texts}) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    fold, seen = [], [0, 0]  # each class is dealt in turn
    for _, y in texts:
        fold.append(seen[y] % FOLDS)
        seen[y] += 1
    unseen = []
    for f in range(FOLDS):
        held = [t for t, k in zip(texts, fold) if k == f]
        give_back()
        scorer = Scorer(train([t for t, k in zip(texts, fold) if k != f]))
        for i in range(0, len(held), TEXTS_AT_ONCE):
            some = held[i:i + TEXTS_AT_ONCE]
            unseen += zip(scorer.scores([t for t, _ in some]), [y for _, y in some])
        del scorer
    give_back()
    return calibrated(train(texts), unseen)


def train(texts: list[tuple[str, int]], seed: int = 7) -> Model:
    """Vectors and softmax from (text, label) pairs."""
    rng, dice = np.random.default_rng(seed), random.Random(seed)
    empty = Model(np.zeros(1 << BITS, np.float32), 0.0)
    index: dict[str, int] = {}  # each word is held once, not at each of its places
    numbered = [(np.array([index.setdefault(w, len(index)) for w in words], np.int32), y) for t, y in texts if (words := words_of(t))]
    if len({y for _, y in numbered}) < 2:
        return empty
    ids, y = [i for i, _ in numbered], np.array([label for _, label in numbered])
    names = list(index)
    first = len(names)
    del numbered, index
    both = chain(names, (misspelt(w, dice) for w in names))  # row of a misspelling: first + the word's
    few = (parts_of(some) for some in iter(lambda: list(islice(both, WORDS_AT_ONCE)), []))
    parts, parts_n = map(np.concatenate, zip(*((p.astype(np.int32), k.astype(np.int32)) for p, k in few)))
    del names
    parts_at = np.cumsum(parts_n, dtype=np.int64) - parts_n
    bounds = [passages(len(i)) for i in ids]
    table = rng.normal(0, 0.05, (1 << BITS, WIDTH)).astype(np.float32)
    soft, bias = rng.normal(0, 0.1, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen = np.full(1 << BITS, 1e-3, np.float32)
    seen_soft, seen_bias = np.full_like(soft, 1e-3), np.full_like(bias, 1e-3)
    # The first passages are picked by the likelihood ratio of words' document counts in both classes: words of
    # one text say little, however few toxic texts there are.
    counts = [sum((np.bincount(np.unique(i), minlength=first) for i, c in zip(ids, y) if c == k), np.zeros(first)) for k in (0, 1)]
    both_n, share = counts[0] + counts[1], y.mean()
    part = np.clip(counts[1] / both_n, 1e-12, 1 - 1e-12)
    ratio = counts[1] * np.log(part / share) + counts[0] * np.log((1 - part) / (1 - share))
    value = np.where(part > share, ratio, 0) ** 2
    # A bucket that a single text touches would only learn that text by heart: its vector stays zero.
    texts_n = np.zeros(1 << BITS, np.int32)
    for i in ids:
        u = np.unique(i)
        n = parts_n[u]
        texts_n[np.unique(parts[np.repeat(parts_at[u] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())])] += 1
    common = texts_n >= MIN_TEXTS
    table[~common] = 0
    for turn in range(MOST_ROUNDS):
        if turn:
            told = table @ (soft[:, 1] - soft[:, 0])
            value = np.concatenate([np.add.reduceat(told[parts[parts_at[i]:parts_at[i] + parts_n[i:j].sum()]], parts_at[i:j] - parts_at[i]) / parts_n[i:j]
                                    for i in range(0, first, WORDS_AT_ONCE) for j in [min(first, i + WORDS_AT_ONCE)]])
        examples = []
        for d, (s, e) in enumerate(bounds):
            size = e - s
            total = np.concatenate([[0], np.cumsum(value[ids[d]], dtype=float)])
            score = (total[e] - total[s]) / np.maximum(size, PASSAGE)
            worst = np.argsort(-score, kind="stable")[:2].tolist()
            for k in worst[:1] if y[d] else sorted({*worst, *rng.integers(len(s), size=4).tolist()}):
                examples.append((d, np.unique(ids[d][s[k]:s[k] + size[k]])))
        dice.shuffle(examples)
        loss, n_of = 0.0, np.bincount([y[d] for d, _ in examples], minlength=2)
        heavy = len(examples) / (2 * n_of)  # both classes weigh the same
        for at in range(0, len(examples), BATCH):
            batch = examples[at:at + BATCH]
            rows = np.concatenate([w for _, w in batch])
            rows = np.where(rng.random(len(rows)) < MISSPELT, rows + first, rows)
            length = np.array([len(w) for _, w in batch])
            padded = np.maximum(length, PASSAGE)
            label = np.array([y[d] for d, _ in batch])
            n = parts_n[rows]
            lead = np.concatenate([[0], np.cumsum(n)[:-1]])
            flat = parts[np.repeat(parts_at[rows] - lead, n) + np.arange(n.sum())]
            word = np.add.reduceat(table[flat], lead) / n[:, None]
            begin = np.concatenate([[0], np.cumsum(length)[:-1]])
            bagged = np.add.reduceat(word, begin) / padded[:, None]
            logit = bagged @ soft + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            worth = heavy[label]
            loss -= float((worth * np.log(np.maximum(p[np.arange(len(batch)), label], 1e-12))).sum())
            p[np.arange(len(batch)), label] -= 1
            g = p * worth[:, None] / len(batch)
            g_soft, g_bias, g_bag = bagged.T @ g, g.sum(0), g @ soft.T
            g_part = np.repeat(np.repeat(g_bag / padded[:, None], length, axis=0) / n[:, None], n, axis=0)
            touched, back = np.unique(flat, return_inverse=True)
            g_table = np.stack([np.bincount(back, g, len(touched)) for g in g_part.T], axis=1).astype(np.float32)
            g_table *= common[touched, None]
            seen[touched] += (g_table ** 2).sum(1)
            table[touched] = table[touched] * (1 - DECAY) - RATE * g_table / np.sqrt(seen[touched])[:, None]
            seen_soft += g_soft ** 2
            seen_bias += g_bias ** 2
            soft -= RATE * g_soft / np.sqrt(seen_soft)
            bias -= RATE * g_bias / np.sqrt(seen_bias)
        if turn + 1 >= ROUNDS and loss / len(examples) < LOW_LOSS:
            break
    # Buckets that no training word, or only one text, touched say nothing.
    used = np.zeros(1 << BITS, bool)
    used[parts] = True
    weights = np.where(used & common, table @ (soft[:, 1] - soft[:, 0]), 0).astype(np.float32)
    return Model(weights, float(bias[1] - bias[0]))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.values = model, {}

    def scores(self, texts: list[str | None]) -> list[float]:
        """Probability of the toxic class of each text's worst passage."""
        words = [words_of(t or "") for t in texts]
        known = self.values
        fresh = list({w for ws in words for w in ws if w not in known})
        new = dict(zip(fresh, self.model.values(fresh).tolist()))
        out = []
        for ws in words:
            logit = self.model.bias
            if ws:
                start, end = (x.tolist() for x in passages(len(ws)))
                logit += max([sum([x if (x := known.get(w)) is not None else new[w] for w in set(ws[i:j])])
                              for i, j in zip(start, end)]) / PASSAGE
            out.append(float(1 / (1 + np.exp(-np.clip(logit, -700, 700)))))
        for w in fresh[:max(0, CACHED_WORDS - len(known))]:
            if len(w) <= LONG_WORD:
                known[w] = new[w]
        return out


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic", rows: int = SAMPLE_ROWS, keep=None) -> DataFrame:
    """(t, y): at most ``rows`` texts of each class with their labels, written; ``keep`` is a condition on column ``k``, the id."""
    known = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y"))
    known = known.where(F.col("k").isNotNull() & F.col("y").isin(0, 1))
    known = known if keep is None else known.where(keep)
    picked = None
    for y in (0, 1):
        one = known.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(rows)
        picked = one if picked is None else picked.unionAll(one)
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    found = texts.join(F.broadcast(picked), "k").orderBy(F.xxhash64("k"), "k", "t").limit(2 * rows)
    return written(found.select("t", "y").coalesce(1), "toxicity-sample")


def scores_of(model: Model, texts: list[str | None]) -> list[float]:
    if model not in _scorers:
        _scorers.clear()
        _scorers[model] = Scorer(model)
    scorer = _scorers[model]
    return [x for i in range(0, len(texts), TEXTS_AT_ONCE) for x in scorer.scores(texts[i:i + TEXTS_AT_ONCE])]


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: 4 * 2 ** BITS bytes

    def run(keys, texts):
        return {"k": keys, "score": scores_of(sent.value, texts)}

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, f"{id_col} long, score double")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows, all columns, whose score is below ``limit``."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: 4 * 2 ** BITS bytes
    place = docs.columns.index(text_col)

    def run(batches):
        scorer = Scorer(sent.value)  # a task's own, as what it remembers goes with it
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(i, TEXTS_AT_ONCE)
                yield some.filter(pa.array([x < limit for x in scorer.scores(some.column(place).to_pylist())]))
            give_back()
        del scorer
        give_back()

    return docs.mapInArrow(run, docs.schema)


#: The scorer that this Python worker uses.
_scorers: dict = {}
Model.__hash__ = lambda self: id(self)
