"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted arrays, memory-mapped by workers.

Words are known by 64-bit hashes. The vocabulary is a sorted array of hashes with counts, cut into files by hash range; a
word's place in it is its id. Bigrams are sorted arrays of (context id, word id) with counts, cut by context, beside the
statistics of each context; continuation counts of words are one array by id. Tasks write these files to the shared
folder, each under a temporary name that is then replaced, so that a task that runs again leaves the same file.
Workers map them when scoring; that folder must be reachable as a path on all machines. Counts, and with them files and shuffles,
follow the distinct words and bigrams of the texts. There are as many files as the texts' size asks for: a worker holds one range of
about ``RANGE`` entries at a time while writing, adding up what it has read so far as it goes.

A text's tokens are its words (runs without white space, A-Z in lower case) and one end; the first word's context is a begin.
Inputs: a null text is an empty one: it has only the end. Rows repeat as given, null ids included. Without training
texts every token has probability 1 / (vocabulary + 1) = 1. Only id and text are read. At most 2 ** 32 - 2 distinct words.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import crc_mod5, shared_folder, ship, written
from rillhouse.llm.words import chunks, hashed_words

END = np.uint64(0x5851F42D4C957F2D)
#: Entries a task holds before it sorts and adds them up.
HELD = 1 << 21
#: Entries, not yet added up, that a file is meant for.
RANGE = 1 << 21
#: Bytes of text for one file of the vocabulary.
TEXT_RANGE = 1 << 24
W32 = np.uint64(32)
LOW32 = np.uint64(0xFFFFFFFF)
Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Model:
    folder: str
    bits: int                     # 2 ** bits files of the vocabulary
    offsets: tuple[int, ...]      # id of the first word of each vocabulary file; the last entry is V
    tokens: int                   # N
    pair_bits: int = 0            # 2 ** pair_bits files of bigrams and of continuations
    discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)
    word_discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)
    word_mass: float = 1.0        # what unseen continuations get
    continuations: int = 0        # distinct bigrams
    maps: dict = field(default_factory=dict, compare=False, repr=False)

    @property
    def size(self) -> int:
        return self.offsets[-1]

    def array(self, kind: str, part: int, name: str) -> np.ndarray:
        key = (kind, part, name)
        if key not in self.maps:
            path = _file(self.folder, kind, part, name)
            self.maps[key] = np.load(path, mmap_mode="r") if os.path.exists(path) else np.zeros(0, np.uint64)
        return self.maps[key]

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and training counts of hashed words; -1 and 0 for unknown ones."""
        ids, counts = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        for part, at, rows in _by_part(h, h >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(h), np.uint64)):
            keys = self.array("words", part, "keys")
            if len(keys):
                i = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
                hit = keys[i] == at
                ids[rows[hit]] = i[hit] + self.offsets[part]
                counts[rows[hit]] = self.array("words", part, "counts")[i[hit]]
        return ids, counts

    def context_part(self, u: np.ndarray) -> np.ndarray:
        return u * (1 << self.pair_bits) // (self.size + 1)

    def part_start(self, part: int) -> int:
        """First context id of a part; ids run to V, which stands for the begin."""
        return -(-part * (self.size + 1) >> self.pair_bits)


def _by_part(values: np.ndarray, part: np.ndarray):
    order = np.argsort(part, kind="stable")
    parts, start = np.unique(part[order], return_index=True)
    for p, rows in zip(parts, np.split(order, start[1:]) if len(parts) else []):
        yield int(p), values[rows], rows


def _file(folder: str, kind: str, part: int, name: str) -> str:
    return f"{folder}/{kind}-{part}-{name}.npy"


def _save(folder: str, kind: str, part: int, **arrays: np.ndarray) -> None:
    for name, a in arrays.items():
        path = _file(folder, kind, part, name)
        temporary = f"{path}.{uuid.uuid4().hex}.tmp.npy"
        np.save(temporary, a)
        os.replace(temporary, path)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, counts, len(keys)).astype(np.int64)


def _tokens(batch: pa.RecordBatch, column: int = 0):
    """Per go: hashes of all tokens, ends included, and each text's number of tokens."""
    for first, part in chunks(batch.column(column).to_pylist()):
        h, n = hashed_words(part)
        yield first, np.insert(h, np.cumsum(n), END), n + 1


def _binary(*arrays: np.ndarray) -> list[bytes]:
    return [a.tobytes() for a in arrays]


def _row(names: list[str], part: int, *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part]), *[pa.array([b], pa.binary()) for b in _binary(*arrays)]], names)


class _Sum:
    """Keys with counts, added up whenever as many are waiting as have been."""

    def __init__(self):
        self.keys, self.counts, self.waiting, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n += len(keys)
        if self.n > max(HELD, len(self.keys)):
            self.done()

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            keys, counts = zip((self.keys, self.counts), *self.waiting)
            self.waiting, self.n = [], 0
            self.keys, self.counts = _summed(np.concatenate([k.astype(np.uint64) for k in keys]), np.concatenate([c.astype(np.int64) for c in counts]))
        return self.keys, self.counts


def _ranges(batches: Batches, read) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each part's keys with their sums, one part after the other; rows come ordered by part. ``read`` gives a row's keys and counts."""
    part = held = None
    for batch in batches:
        for i, p in enumerate(batch.column(0).to_pylist()):
            if p != part:
                if held is not None:
                    yield part, *held.done()
                part, held = p, _Sum()
            held.add(*read([c[i].as_py() for c in batch.columns[1:]]))
    if held is not None:
        yield part, *held.done()


def _plain(row: list[bytes], kind) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row[0], kind), np.frombuffer(row[1], np.uint32)


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of one part in one task, part after part."""
    return rows.repartition(parts, "part").sortWithinPartitions("part")


def _fitting(counts: np.ndarray) -> np.ndarray:
    """In 32 bits where all counts have room there."""
    return counts.astype(np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64)


def _bits(ranges: int) -> int:
    return max(ranges - 1, 0).bit_length()


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of entries with counts 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 for k in (1, 2, 3)]
    return tuple(d if 0 < d <= k else 0.5 for k, d in zip((1, 2, 3), found))


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)]


def _of_counts(c: np.ndarray) -> list[int]:
    """Entries with counts 1, 2, 3 and 4, and all with at least 3."""
    return [*(int((c == k).sum()) for k in (1, 2, 3, 4)), int((c >= 3).sum())]


def fit(texts: DataFrame, text_col: str = "text") -> Model:
    """The model of all texts given."""
    spark = ship(texts.sparkSession)
    texts = texts.select(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    letters = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = _bits(-(-letters // TEXT_RANGE))
    parts = 1 << bits
    uri = urlparse(shared_folder(spark, "language-model"))
    if uri.scheme not in ("", "file"):
        raise ValueError("spark.checkpoint.dir must be mounted as a path on all machines to be memory-mapped")
    folder = uri.path
    os.makedirs(folder)

    def count_words(batches: Batches) -> Batches:
        held, size = [], 0

        def flush():
            keys, counts = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            for p, k, rows in _by_part(keys, keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)):
                yield _row(["part", "keys", "counts"], p, k, counts[rows].astype(np.uint32))

        for batch in batches:
            for _, h, _ in _tokens(batch):
                held.append(_summed(h, np.ones(len(h))))
                size += len(held[-1][0])
                if size > HELD:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def save_words(batches: Batches) -> Batches:
        for part, keys, counts in _ranges(batches, lambda row: _plain(row, np.uint64)):
            _save(folder, "words", part, keys=keys, counts=counts.astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([len(keys)]), pa.array([int(counts.sum())])], ["part", "size", "total"])

    words = _dealt(texts.mapInArrow(count_words, "part long, keys binary, counts binary"), parts)
    sizes = np.zeros(parts, np.int64)
    tokens = 0
    for r in written(words.mapInArrow(save_words, "part long, size long, total long"), "word-sizes").collect():
        sizes[r["part"]] = r["size"]
        tokens += r["total"]
    offsets = tuple(np.concatenate([[0], np.cumsum(sizes)]).tolist())
    # No bigram is counted more often than once for each token before it is added up.
    model = Model(folder, bits, offsets, tokens, _bits(-(-tokens // RANGE)))
    if not tokens:
        return model
    size, parts = model.size, 1 << model.pair_bits

    def count_pairs(batches: Batches) -> Batches:
        held, n_held = [], 0

        def flush():
            keys, counts = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            u = (keys >> W32).astype(np.int64)
            for p, k, rows in _by_part(keys, model.context_part(u)):
                ctx, run = np.unique(k >> W32, return_counts=True)
                yield _row(["part", "u", "n", "w", "c"], p, ctx.astype(np.uint32), run.astype(np.uint32),
                           (k & LOW32).astype(np.uint32), counts[rows].astype(np.uint32))

        for batch in batches:
            for _, h, n in _tokens(batch):
                distinct, back = np.unique(h, return_inverse=True)
                ids = model.lookup(distinct)[0][back]
                held.append(_summed(_pairs(ids, n, size), np.ones(len(ids))))
                n_held += len(held[-1][0])
                if n_held > HELD:
                    yield from flush()
                    held, n_held = [], 0
        if held:
            yield from flush()

    def save_pairs(batches: Batches) -> Batches:
        names = ["kind", "part", "a", "b"]
        for part, keys, counts in _ranges(batches, _run_lengths):
            first = model.part_start(part)
            u = (keys >> W32).astype(np.int64) - first
            width = model.part_start(part + 1) - first
            of = lambda mask, weight=None: np.bincount(u[mask], weight, width).astype(np.uint64)
            _save(folder, "pairs", part, keys=keys, counts=_fitting(counts), total=of(slice(None), counts),
                  n1=of(counts == 1), n2=of(counts == 2), n3=of(counts >= 3))
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([part]), pa.array([np.array(_of_counts(counts), np.int64).tobytes()], pa.binary()),
                                              pa.array([b""], pa.binary())], names)
            w, n = np.unique((keys & LOW32).astype(np.uint32), return_counts=True)
            for p, ids, at in _by_part(w, model.context_part(w.astype(np.int64))):
                yield pa.RecordBatch.from_arrays([pa.array([1]), pa.array([p]), pa.array([ids.tobytes()], pa.binary()),
                                                  pa.array([n[at].astype(np.uint32).tobytes()], pa.binary())], names)

    def save_words_after(batches: Batches) -> Batches:
        for part, w, n in _ranges(batches, lambda row: _plain(row, np.uint32)):
            first = model.part_start(part)
            after = np.bincount(w.astype(np.int64) - first, n, model.part_start(part + 1) - first).astype(np.uint64)
            _save(folder, "after", part, counts=after)
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.array(_of_counts(after), np.int64).tobytes()], pa.binary())], ["part", "n"])

    pairs = _dealt(texts.mapInArrow(count_pairs, "part long, u binary, n binary, w binary, c binary"), parts)
    saved = written(pairs.mapInArrow(save_pairs, "kind long, part long, a binary, b binary"), "pair-counts")
    of_pairs = sum((np.frombuffer(bytes(r["a"]), np.int64) for r in saved.where("kind = 0").select("a").collect()), np.zeros(5, np.int64))
    after = _dealt(saved.where("kind = 1").select("part", "a", "b"), parts)
    after = written(after.mapInArrow(save_words_after, "part long, n binary"), "word-continuations")
    of_words = sum((np.frombuffer(bytes(r["n"]), np.int64) for r in after.select("n").collect()), np.zeros(5, np.int64))
    distinct = int(of_pairs[0] + of_pairs[1] + of_pairs[4])
    d = _discounts(of_words[:4].tolist())
    mass = float(np.dot(d, of_words[[0, 1, 4]]) / distinct)
    return Model(folder, bits, offsets, tokens, model.pair_bits, _discounts(of_pairs[:4].tolist()), d, mass, distinct)


def _pairs(ids: np.ndarray, n: np.ndarray, begin: int) -> np.ndarray:
    """Context and word of each token, as one number."""
    before = np.concatenate([[begin], ids[:-1]])
    before[np.cumsum(n) - n] = begin
    return (before.astype(np.uint64) << W32) | ids.astype(np.uint64)


def _run_lengths(row: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams and counts of a row that lists each context once."""
    u, n, w, c = (np.frombuffer(x, np.uint32) for x in row)
    return (np.repeat(u, n).astype(np.uint64) << W32) | w, c


def token_scores(model: Model, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training count, base score and model score of each token."""
    distinct, back = np.unique(h, return_inverse=True)
    ids, counts = (x[back] for x in model.lookup(distinct))
    v = model.size
    base = np.log10((counts + 0.5) / (model.tokens + 0.5 * (v + 1)))
    if not model.tokens:
        return counts, base, np.zeros(len(h))
    begin = np.cumsum(n) - n
    before = np.concatenate([[v], ids[:-1]])
    before[begin] = v
    words, at = np.unique(ids, return_inverse=True)
    lower = np.full(len(words), model.word_mass / (v + 1))
    known = np.flatnonzero(words >= 0)
    for part, w, rows in _by_part(words[known], model.context_part(words[known])):
        c = model.array("after", part, "counts")
        c = c[w - model.part_start(part)].astype(float) if len(c) else np.zeros(len(w))
        lower[known[rows]] += np.maximum(c - _discount(c, model.word_discounts), 0) / model.continuations
    p = lower[at]
    seen = np.flatnonzero(before >= 0)
    keys = (before[seen].astype(np.uint64) << W32) | np.where(ids[seen] >= 0, ids[seen], int(LOW32)).astype(np.uint64)
    for part, k, rows in _by_part(keys, model.context_part(before[seen])):
        total = model.array("pairs", part, "total")
        if not len(total):
            continue
        rows = seen[rows]
        u = (k >> W32).astype(np.int64) - model.part_start(part)
        total = total[u].astype(float)
        gamma = sum(d * model.array("pairs", part, name)[u] for d, name in zip(model.discounts, ("n1", "n2", "n3")))
        stored = model.array("pairs", part, "keys")
        i = np.minimum(np.searchsorted(stored, k), len(stored) - 1)
        c = np.where(stored[i] == k, model.array("pairs", part, "counts")[i], 0).astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            own = (np.maximum(c - _discount(c, model.discounts), 0) + gamma * p[rows]) / total
        p[rows] = np.where(total > 0, own, p[rows])
    return counts, base, np.log10(p)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens, known tokens, training tokens, base score, model score and perplexity of each row."""
    ship(docs.sparkSession)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            columns = [[] for _ in range(4)]
            for _, h, n in _tokens(batch, 1):
                counts, base, score = token_scores(model, h, n)
                at = np.cumsum(n) - n
                for held, x in zip(columns, (n, np.add.reduceat((counts > 0).astype(np.int64), at), np.add.reduceat(base, at), np.add.reduceat(score, at))):
                    held.append(x)
            n, known, base, score = (np.concatenate(c) if c else np.zeros(0) for c in columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(np.full(len(n), model.tokens, np.int64)),
                 pa.array(base.astype(float)), pa.array(score.astype(float)), pa.array(10 ** (-score.astype(float) / np.maximum(n, 1)))],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def in_training(doc_id: Column) -> Column:
    return crc_mod5(doc_id) != 1
