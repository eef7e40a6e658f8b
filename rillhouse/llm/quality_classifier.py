"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text's words, A-Z in lower case, give n-grams of one and two words. Each word also has a shape: runs of capitals, of other letters and
of digits count as one mark each, all else stands for itself. Shapes give n-grams of one to three words, and each n-gram of shapes also
tells which of its words equal the one before. So words that were never seen are still known by their shape and repetition.
Each kind of n-gram fills a share of one sparse vector: an n-gram weighs how large a part of its kind it makes up in the whole text, long
texts included. All n-grams are hashed to ``2 ** BITS`` places; a score is the logistic function of the sparse dot product and the bias.

Training streams a bounded sample through one task, ``ROUNDS`` times: at most ``SAMPLE_ROWS`` labelled rows of each class, by a hash
of the id. Only a text's vector reaches that task, one at a time, and only the weights, ``4 * 2 ** BITS`` bytes, reach the driver.
Both classes weigh the same, and a text as likely good as bad scores ``LIMIT``, so that a score of ``LIMIT`` parts the classes.

Inputs: a null or empty text, or one without words, has no n-gram and scores by the bias alone, which a balanced training leaves near
``LIMIT``. Null labels and others than 0 and 1 are left out, as are labels without id or without text; of several rows under one id, each
is an example. Without both classes every score is ``LIMIT``. Rows repeat as given, null ids included; an empty table gives no rows.
Only the id, text and label columns named are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import map_rows, ship, written
from rillhouse.llm.words import chunks, hashed_words, mixed, shingles

#: Labelled rows of each class that training sees at most.
SAMPLE_ROWS = 6000
BITS = 18
ROUNDS = 5
#: Score that parts good from bad.
LIMIT = 0.7
#: Learning rate, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 0.05, 1e-3, 1e-3
#: Sizes of n-grams of words and of shapes.
WORDS, SHAPES = (1, 2), (1, 2, 3)
KINDS = len(WORDS) + len(SHAPES)
SHIFT = math.log(LIMIT / (1 - LIMIT))

#: What each byte counts as in a shape: capitals, digits, other letters, or itself.
MARKS = np.arange(256, dtype=np.uint8)
MARKS[65:91] = 1
MARKS[48:58] = 2
MARKS[97:123] = MARKS[128:] = 3


def shape(text: bytes) -> bytes:
    """The text with runs of one mark cut to one; words stay apart."""
    marks = MARKS[np.frombuffer(text, np.uint8)]
    return marks[np.concatenate([[True], marks[1:] != marks[:-1]])].tobytes() if len(marks) else b""


def places(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram the places of all texts' n-grams, repeats included, and how many each text has."""
    words, counts = hashed_words(texts)
    marks, _ = hashed_words([shape(t) for t in texts])
    same = np.zeros(len(words), np.uint64)
    if len(words):
        first = (np.cumsum(counts) - counts)[counts > 0]
        same[1:] = words[1:] == words[:-1]
        same[first] = 0
        marks = mixed(marks + same)
    for kind, (hashes, n) in enumerate([*((words, n) for n in WORDS), *((marks, n) for n in SHAPES)]):
        grams, have = shingles(hashes, counts, n)
        yield (mixed(grams + np.uint64(kind + 1)) >> np.uint64(64 - BITS)).astype(np.int64), have


@dataclass(frozen=True, eq=False)
class Model:
    weights: np.ndarray
    bias: float

    def logits(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for first, part in chunks(texts):
            to = slice(first, first + len(part))
            for at, have in places(part):
                ends = np.concatenate([[0], np.cumsum(self.weights[at], dtype=float)])
                last = np.cumsum(have)
                out[to] += (ends[last] - ends[last - have]) / np.maximum(have, 1)
        return out

    def scores(self, texts: list[str | None]) -> list[float]:
        z = self.logits([(t or "").encode(errors="replace") for t in texts]) + SHIFT
        return (1 / (1 + np.exp(-np.clip(z, -700, 700)))).tolist()


def vector(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's places, each once, and their weights; those of one kind add up to one."""
    at, weight = [], []
    for p, have in places([text]):
        at.append(p)
        weight.append(np.full(len(p), 1 / max(int(have[0]), 1)))
    found, back = np.unique(np.concatenate(at), return_inverse=True)
    return found, np.bincount(back, np.concatenate(weight), len(found))


class Leader:
    """Weights that follow the regularised leader, coordinate by coordinate; the last coordinate is the bias."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == 1 << BITS, 0, L1)
        return np.where(np.abs(z) <= l1, 0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, good: bool, weight: float) -> None:
        at, x = np.append(at, 1 << BITS), np.append(x, 1.0)
        w = self.weights(at)
        p = 1 / (1 + math.exp(-max(min(float(w @ x), 700), -700)))
        g = weight * (p - good) * x
        more = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = more

    def model(self) -> Model:
        w = self.weights(np.arange((1 << BITS) + 1))
        return Model(w[:-1].astype(np.float32), float(w[-1]))


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
           rows: int = SAMPLE_ROWS, keep: Column | None = None) -> DataFrame:
    """(y, at, x): vectors of at most ``rows`` rows of each class, mixed and written; ``keep`` is a condition on column ``k``, the id."""
    known = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y")).where(F.col("k").isNotNull() & F.col("y").isin(0, 1))
    known = known if keep is None else known.where(keep)
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(rows) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    found = texts.join(F.broadcast(picked[0].unionAll(picked[1])), "k")  # at most 2 * rows ids

    def vectors(ys, ks, ts):
        got = [vector(t.encode(errors="replace")) for t in ts]
        return {"y": ys, "k": ks, "at": [a.astype(np.int32).tobytes() for a, _ in got], "x": [x.astype(np.float32).tobytes() for _, x in got]}

    rows_of = map_rows(found.select("y", F.xxhash64("k", "t"), "t"), vectors, "y int, k long, at binary, x binary")
    # Ids that repeat must not widen the sample; a class's first rows by hash are taken.
    whole = written(rows_of, "quality-vectors")
    cut = [whole.where(F.col("y") == y).orderBy("k").limit(rows) for y in (0, 1)]
    return written(cut[0].unionAll(cut[1]).repartition(1).sortWithinPartitions(F.xxhash64("k"), "k").drop("k"), "quality-sample")


def fit(examples: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of a sample, which one task streams round after round."""
    ship(examples.sparkSession)
    of = {r["y"]: r["n"] for r in examples.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(of) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    share = {y: sum(of.values()) / (2 * n) for y, n in of.items()}
    # One task reads the bounded sample again for each round; nothing is shuffled.
    turns = reduce(DataFrame.unionAll, [examples.select("y", "at", "x")] * rounds).coalesce(1)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = Leader()
        for batch in batches:
            for y, at, x in zip(batch.column("y").to_pylist(), batch.column("at"), batch.column("x")):
                leader.learn(np.frombuffer(at.as_buffer(), np.int32), np.frombuffer(x.as_buffer(), np.float32).astype(float), y == 1, share[y])
        model = leader.model()
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])

    row = turns.mapInArrow(learn, "weights binary, bias double").first()
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"])


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: 4 * 2 ** BITS bytes

    def run(keys, texts):
        return {"k": keys, "score": sent.value.scores(texts)}

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, f"{id_col} long, score double")
