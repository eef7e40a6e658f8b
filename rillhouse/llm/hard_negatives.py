"""Hard negatives: rows of another label that score nearly as high against an anchor as one of its positives.

Scores are inner products of whole-number vectors, computed in a residue number system. Each vector is reduced modulo several small
primes to residues around zero, so small that a float32 product of matrices adds up exactly: ``d * ((p - 1) / 2) ** 2 < 2 ** 24``
for each run of at most ``DEPTH`` components. The residues of a score are put together by Chinese remaindering, in mixed radix, to the exact
signed number; there are as many primes as twice the largest possible score (the product of both sides' largest norms)
asks for. Scores below ``NARROW`` in size fit 64-bit numbers; beyond, the same steps run on Python's own numbers, so no size is left out.

Anchors and rows meet in cells: a cell holds a bounded part of the anchors and one of the rows. A row is sent once for each group of
anchors, an anchor once for each part of the rows, and no pair of rows is ever written: a cell returns only what may still count.
1. Each cell gives each anchor's best rows of its label; a window over the cells' few rows keeps the positives.
2. Each cell gives, for each anchor and positive, the first rows of other labels whose score is within the positive's window; a window
   over these keeps the negatives.
Cells are filled by row number, so a label, an id or a vector that many rows share is spread like any other.

Inputs: rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part. Vectors of another length
than the anchor's do not meet it. Rows that repeat an id are rows of their own, also as each other's positives and as anchors; ties beyond
the id go by row. A score that a long cannot hold is compared by its exact value and returned as the long next to it. An empty table, or
one without anchors, gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import ship, written

#: Bytes of anchors' and of rows' vectors in one cell at most; the vectors of the largest length count.
ANCHOR_BYTES, ROW_BYTES = 1 << 23, 1 << 24
#: Fewest rows of a cell, unless there are fewer in all.
FEWEST = 512
#: Components summed in float32 before residues are taken again.
DEPTH = 1024
#: Anchors and rows scored at once.
ANCHOR_STEP, ROW_STEP = 1024, 1024
#: Numbers below this size are held in 64 bits.
NARROW = 1 << 61
LONG = (1 << 63) - 1


def primes(depth: int) -> Iterator[int]:
    """Odd primes in falling order whose residues around zero keep ``depth`` products exact in float32."""
    half = math.isqrt(((1 << 24) - 1) // depth)
    for p in range(2 * half + 1, 2, -2):
        if all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            yield p


def enough_primes(depth: int, largest: int) -> tuple[int, list[int]]:
    """As many primes as tell all whole numbers from ``-largest`` to ``largest`` apart, and how many products they allow to add up.

    Fewer products at once leave room for larger primes; with one, they are enough for any floats.
    """
    found, product = [], 1
    for p in primes(depth):
        found.append(p)
        product *= p
        if product > 2 * largest + 1:
            return depth, found
    return enough_primes(depth // 2, largest)


def residues(v: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers, as floats of any size or as Python's, modulo ``p`` around zero; exact, as a float's remainder is."""
    r = (v % p).astype(float) if v.dtype == object else np.fmod(v, p)
    half = (p - 1) // 2
    return (r - p * (r > half) + p * (r < -half)).astype(np.float32)


def product(a: np.ndarray, b: np.ndarray, p: int, depth: int) -> np.ndarray:
    """The matrix product of residues modulo ``p``, from 0 to ``p - 1``; ``depth`` products add up in float32."""
    total = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, a.shape[1], depth):
        total += (a[:, at:at + depth] @ b[:, at:at + depth].T).astype(np.int64)
    return total % p


def signed(parts: list[np.ndarray], moduli: list[int], wide: bool) -> np.ndarray:
    """The numbers around zero that leave the given residues: mixed-radix digits, then their sum."""
    digits = []
    for k, p in enumerate(moduli):
        digit = parts[k]
        for q, d in zip(moduli, digits):
            digit = (digit - d) * pow(q, -1, p) % p
        digits.append(digit)
    value = digits[-1].astype(object) if wide else digits[-1]
    for p, d in zip(moduli[-2::-1], digits[-2::-1]):
        value = value * p + d
    whole = math.prod(moduli)
    return np.where(value > whole // 2, value - whole, value)


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    """Components times the scale, rounded down; as Python's numbers where a float could not hold one."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    if np.isfinite(v).all():
        return v
    return np.array([math.floor(Fraction(c) * Fraction(scale)) for c in x.ravel().tolist()], object).reshape(x.shape)


class Block:
    """Vectors of one length, with their residues for each prime."""

    def __init__(self, v: np.ndarray):
        self.v, self.known = v, {}
        # A bound of the largest norm, in exact numbers where floats could round or overflow.
        top = int(np.abs(v).max())
        squares = v.shape[1] * top ** 2 if top > 1 << 20 else int((v ** 2).sum(1).max())
        self.norm = math.isqrt(squares) + 1

    def of(self, p: int) -> np.ndarray:
        if p not in self.known:
            self.known[p] = residues(self.v, p)
        return self.known[p]


def scores(a: Block, b: Block) -> np.ndarray:
    """Exact inner products of all rows of both blocks, as 64-bit numbers or, where these could overflow, as Python's."""
    largest = a.norm * b.norm
    depth, moduli = enough_primes(min(a.v.shape[1], DEPTH), largest)
    out = signed([product(a.of(p), b.of(p), p, depth) for p in moduli], moduli, math.prod(moduli) >= NARROW)
    return out.astype(np.int64) if largest < NARROW else out


def best(score: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of each row's ``k`` highest valid scores, ties to the left."""
    if score.dtype == object:
        found = [(i, j) for i in range(len(score)) for j in sorted(np.flatnonzero(valid[i]), key=lambda j: (-score[i, j], j))[:k]]  # noqa: B023
        return tuple(np.array(found, np.int64).reshape(-1, 2).T)
    held = np.where(valid, score, -LONG)
    if held.shape[1] > k:
        valid = valid & (held >= np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k, None])
    i, j = np.nonzero(valid)
    order = np.lexsort((j, -held[i, j], i))
    i, j = i[order], j[order]
    kept = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[kept], j[kept]


def sort_text(n: int) -> str:
    """A text that sorts as the number does, whatever its size."""
    digits = str(abs(n))
    text = f"{len(digits):04d}{digits}"
    return "1" + text if n >= 0 else "0" + "".join(chr(105 - ord(c)) for c in text)


def number(text: str) -> int:
    """The number of a ``sort_text``."""
    return int(text[5:]) if text[0] == "1" else -int("".join(chr(105 - ord(c)) for c in text[5:]))


def participants(rows: DataFrame, is_anchor: Column, label: Column, id_col: str, vec_col: str) -> DataFrame:
    """(row, id, label, anchor, v) of the rows that take part, written."""
    x = F.col(vec_col).cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    out = rows.where(F.col(id_col).isNotNull() & label.isNotNull() & (F.size(vec_col) > 0) & F.coalesce(good, F.lit(False)))
    return written(out.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                              label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), x.alias("v")), "hard-negative-rows")


def _by_length(cell: pa.Table, scale: float) -> dict[int, tuple[dict, np.ndarray]]:
    """For each vector length the cell's columns and scaled vectors, ordered by id and row."""
    cell = cell.sort_by([("id", "ascending"), ("row", "ascending")]).combine_chunks()
    v = cell.column("v").combine_chunks()
    lengths = v.value_lengths().to_numpy()
    out = {}
    for d in np.unique(lengths).tolist():
        picked = cell.take(pa.array(np.flatnonzero(lengths == d)))
        columns = {c: picked.column(c).to_pylist() if c == "positives" else picked.column(c).to_numpy() for c in picked.column_names if c != "v"}
        out[d] = columns, scaled(picked.column("v").combine_chunks().flatten().to_numpy().reshape(-1, d), scale)
    return out


#: What a cell returns: the anchor's row and id, the slot and what it stands for, and the row found with its score.
FOUND = "anchor long, anchor_id long, slot int, positive_score long, positive_id long, id long, row long, score long, key string"


def _best_of_cell(anchors: pa.Table, rows: pa.Table, scale: float, k: int, choose) -> Iterator[tuple]:
    """For each anchor and slot of a cell the ``k`` best rows; ``choose`` tells, slot by slot, which pairs count."""
    right = _by_length(rows, scale) if len(rows) else {}
    for d, (of_anchor, a) in (_by_length(anchors, scale) if right else {}).items():
        if d not in right:
            continue
        of_row, b = right[d]
        blocks = [(slice(at, at + ROW_STEP), Block(b[at:at + ROW_STEP])) for at in range(0, len(b), ROW_STEP)]
        for top in range(0, len(a), ANCHOR_STEP):
            some, names = Block(a[top:top + ANCHOR_STEP]), {c: x[top:top + ANCHOR_STEP] for c, x in of_anchor.items()}
            picks = []
            for at, block in blocks:
                s = scores(some, block)
                for slot, valid in choose(names, {c: x[at] for c, x in of_row.items()}, s):
                    i, j = best(s, valid, k)
                    picks += zip(i.tolist(), [slot] * len(i), (-s[i, j]).tolist(), (j + at.start).tolist())
            for (i, slot), group in groupby(sorted(picks), key=lambda p: p[:2]):
                own = names["positives"][i][slot] if "positives" in names else {"score": None, "id": None}
                for _, _, s, j in islice(group, k):
                    yield (int(names["row"][i]), int(names["id"][i]), slot, own["score"], own["id"], int(of_row["id"][j]), int(of_row["row"][j]),
                           max(min(-s, LONG), -LONG - 1), sort_text(-s))


def _cells(anchors: DataFrame, rows: DataFrame, grid: tuple[int, int], scale: float, k: int, choose) -> DataFrame:
    """What all cells return. Anchors and rows are dealt by row number, so that no key decides a cell's size."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(rows.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(FOUND))
    n_anchors, n_rows = grid

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    left = anchors.withColumn("a", dealt(n_anchors)).withColumn("r", every(n_rows))
    # Named anew, as cogrouping takes columns that both sides share for one.
    right = rows.withColumn("r", dealt(n_rows)).withColumn("a", every(n_anchors)).toDF(*[f"{c}_" for c in rows.columns], "r_", "a_")

    def meet(some: pa.Table, others: pa.Table) -> pa.Table:
        others = others.rename_columns([c[:-1] for c in others.column_names])
        found = list(_best_of_cell(some, others, scale, k, choose)) if len(some) else []
        return pa.Table.from_arrays([pa.array([f[c] for f in found], t) for c, t in enumerate(arrow.types)], schema=arrow)

    return left.groupBy("a", "r").cogroup(right.groupBy("a_", "r_")).applyInArrow(meet, FOUND)


def _first(found: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` best of what cells returned, with their rank; a window sees at most ``n`` rows of each cell."""
    w = Window.partitionBy(*keys).orderBy(F.desc("key"), "id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor and each of its ``positives`` best rows of its label: the ``negatives`` best rows of other labels whose score is
    between ``low`` and ``high`` percent of the positive's. ``is_anchor`` and ``label`` are computed on ``rows``.
    """
    every = participants(rows, is_anchor, label, id_col, vec_col)
    size = every.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("v")).alias("d")).first()
    n, d = size["n"], 8 * (size["d"] or 1)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # Enough parts to use all cores where there are rows for them, and never more bytes in a cell than it may hold.
    parts = max(min(2 * cores, -(-n // FEWEST)), -(-n * d // ROW_BYTES), 1)
    grid = max(1, -(-size["anchors"] * d // ANCHOR_BYTES)), parts

    def alike(of_anchor, of_row, s):
        yield 0, (of_anchor["label"][:, None] == of_row["label"][None, :]) & (of_anchor["row"][:, None] != of_row["row"][None, :])

    def within(of_anchor, of_row, s):
        other = of_anchor["label"][:, None] != of_row["label"][None, :]
        kind, bound = (object, None) if s.dtype == object else (np.int64, 2 * NARROW)
        for slot in range(positives):
            ends = [(1, 0)] * len(s)
            for i, own in enumerate(of_anchor["positives"]):
                if slot < len(own):
                    score = number(own[slot]["key"])
                    ends[i] = -((-low * score) // 100), high * score // 100
            if bound:  # 64-bit scores lie far within these bounds
                ends = [(max(min(a, bound), -bound), max(min(b, bound), -bound)) for a, b in ends]
            least, most = np.array(ends, kind).T
            yield slot, other & (s >= least[:, None]).astype(bool) & (s <= most[:, None]).astype(bool)

    anchors, items = every.where("anchor").drop("anchor"), every.drop("anchor")
    first = _first(_cells(anchors, items, grid, scale, positives, alike), positives, "anchor")
    found = first.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "key", "id", "score"))).alias("positives"))
    known = written(found.withColumnRenamed("anchor", "row"), "positives")
    second = _cells(anchors.join(known, "row"), items, grid, scale, negatives, within)
    return _first(second, negatives, "anchor", "slot").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
