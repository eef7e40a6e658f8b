"""Exact top-k search by inner product over norm-sorted blocks with rotated partial sums.

Vectors are turned into whole numbers and rotated by the singular vectors of all of them (from a sum of outer products),
so that their first coordinates hold most of their length. They are sorted by descending norm and packed into
blocks. A pair of query block and item block first sums the first coordinates; what the rest can add is bounded by
Cauchy-Schwarz, and only pairs whose bound reaches the query's k-th best score so far are scored, exactly, in whole numbers.
A first pass over the longest vectors gives each query a score to beat; the second pass skips whole blocks whose norms cannot
reach it. Bounds carry a slack for rounding, so the result is exact.

Every query block meets every item block at most once, block by block; no more than ``BLOCK`` vectors of each side are held.
Inputs: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without id; whole numbers
beyond ``LARGEST`` in size raise an error. Vectors of another length than the query's do not meet it. Rows that repeat an
id are separate candidates, and a query's own id is no candidate. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import ship, written

#: Vectors per block of items and of queries.
BLOCK, QUERY_BLOCK = 4096, 1024
#: Share of a vector's coordinates, after rotation, that is summed first.
HEAD = 0.25
#: Largest size of a component; sums of squares then stay exact.
LARGEST = 1 << 24
SLACK = 1e-6
Batches = Iterator[pa.RecordBatch]
BLOCKED = "block long, dim int, n int, norm double, ids binary, vectors binary"


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, dim, v): components times ``scale``, rounded down, for rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    good = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    out = rows.where(F.col(id_col).isNotNull() & (F.size(vec_col) > 0) & F.coalesce(good, F.lit(False)))
    return out.select(F.col(id_col).cast("long").alias("id"), F.size(vec_col).alias("dim"), v.alias("v"))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length each, by descending norm."""
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.withColumn("norm", norm).repartitionByRange(n, "dim", F.desc("norm"), "id").sortWithinPartitions("dim", F.desc("norm"), "id")
    sorted_rows = sorted_rows.coalesce(max(1, min(n, -(-rows.count() // size))))  # few rows make few blocks

    def pack(batches: Batches) -> Batches:
        ids, vectors, dim = [], [], None

        def block():
            v = np.array(vectors, np.int64)
            if np.abs(v).max() > LARGEST:
                raise ValueError(f"a component times the scale exceeds {LARGEST}")
            return pa.RecordBatch.from_arrays(
                [pa.array([0]), pa.array([dim], pa.int32()), pa.array([len(v)], pa.int32()), pa.array([math.sqrt((v ** 2).sum(1).max())]),
                 pa.array([np.array(ids, np.int64).tobytes()]), pa.array([v.astype(np.int32).tobytes()])], ["block", "dim", "n", "norm", "ids", "vectors"])

        for batch in batches:
            for i, d, v in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if ids and (d != dim or len(ids) == size):
                    yield block()
                    ids, vectors = [], []
                dim = d
                ids.append(i)
                vectors.append(v)
        if ids:
            yield block()

    blocks = sorted_rows.select("id", "dim", "v").mapInArrow(pack, BLOCKED)
    return written(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


def rotations(blocks: DataFrame) -> dict[int, np.ndarray]:
    """For each length the right singular vectors of all vectors of it; one matrix per length."""
    def outer(batches: Batches) -> Batches:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = np.frombuffer(data.as_buffer(), np.int32).reshape(-1, d).astype(float)
                total[d] = total.get(d, 0) + v.T @ v
        for d, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d), pa.array(range(d)), pa.array(m.tolist(), pa.list_(pa.float64()))], ["dim", "row", "m"])

    rows = blocks.select("dim", "vectors").mapInArrow(outer, "dim long, row long, m array<double>")
    cells = rows.select("dim", "row", F.posexplode("m")).groupBy("dim", "row", "pos").agg(F.sum("col").alias("x"))
    found: dict[int, np.ndarray] = {}
    for r in cells.collect():  # dim * dim numbers for each length
        found.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))[r["row"], r["pos"]] = r["x"]
    return {d: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for d, m in found.items()}


def _met(pairs: DataFrame, k: int, turn: dict[int, np.ndarray]) -> DataFrame:
    """The best ``k`` scores of each query within each pair of blocks, as far as they can be among its best."""
    spark = ship(pairs.sparkSession)
    sent = spark.sparkContext.broadcast(turn)

    def meet(batches: Batches) -> Batches:
        for batch in batches:
            for r in batch.to_pylist():
                d = r["dim"]
                qi, xi = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["x_ids"], np.int64)
                q, x = (np.frombuffer(r[c], np.int32).reshape(-1, d).astype(np.int64) for c in ("q_vectors", "x_vectors"))
                beat = np.frombuffer(r["beat"], np.int64) if r["beat"] else np.full(len(qi), -(1 << 62))
                rotation, head = sent.value[d], max(1, int(d * HEAD))
                rq, rx = q @ rotation, x @ rotation
                rest_q, rest_x = (np.sqrt((m[:, head:] ** 2).sum(1)) for m in (rq, rx))
                length_q, length_x = np.sqrt((rq ** 2).sum(1)), np.sqrt((rx ** 2).sum(1))
                out: list[tuple] = []
                best = [np.zeros((0, 2), np.int64)] * len(qi)
                for at in range(0, len(xi), 512):  # longest first
                    to = slice(at, at + 512)
                    live = np.flatnonzero(length_q * length_x[to].max() * (1 + SLACK) + SLACK >= beat)
                    if not len(live):
                        continue
                    bound = rq[live, :head] @ rx[to, :head].T + rest_q[live, None] * rest_x[None, to]
                    bound += SLACK * length_q[live, None] * length_x[None, to] + SLACK
                    a, b = np.nonzero((bound >= beat[live, None]) & (qi[live, None] != xi[None, to]))
                    score = np.einsum("ij,ij->i", q[live[a]], x[to][b])
                    for j, rows in zip(live, np.split(np.arange(len(a)), np.searchsorted(a, np.arange(1, len(live))))):
                        if len(rows):
                            all_of = np.concatenate([best[j], np.stack([score[rows], xi[to][b[rows]]], 1)])
                            best[j] = all_of[np.lexsort((all_of[:, 1], -all_of[:, 0]))[:k]]
                            if len(best[j]) == k:
                                beat = beat if beat.flags.writeable else beat.copy()
                                beat[j] = max(beat[j], best[j][-1, 0])
                for j, found in enumerate(best):
                    out += [(int(qi[j]), int(v), int(s), r["q_block"], j) for s, v in found]
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(5)],
                                                 ["query_id", "vec_id", "score", "q_block", "place"])

    return pairs.mapInArrow(meet, "query_id long, vec_id long, score long, q_block long, place long")


def top_k(rows: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` best candidates, ties to smaller ids.

    ``is_query`` is a condition on the rows.
    """
    spark = ship(rows.sparkSession)
    items = _packed(whole_vectors(rows, id_col, vec_col, scale), BLOCK)
    queries = _packed(whole_vectors(rows.where(is_query), id_col, vec_col, scale), QUERY_BLOCK)
    turn = rotations(items)
    q = queries.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("norm").alias("q_norm"))
    x = items.select("dim", F.col("block").alias("x_block"), F.col("ids").alias("x_ids"), F.col("vectors").alias("x_vectors"), F.col("norm").alias("x_norm"))
    longest = x.groupBy("dim").agg(F.max_by("x_block", F.struct("x_norm", -F.col("x_block"))).alias("x_block"))

    def deal(plan: DataFrame) -> DataFrame:
        """One row for each pair of blocks, spread over tasks."""
        return plan.repartition(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), "q_block", "x_block")

    nothing = F.lit(None).cast("binary").alias("beat")
    first = written(_met(deal(q.join(x.join(longest, ["dim", "x_block"]), "dim").select("*", nothing)), k, turn), "first-scores")
    # The score to beat by place in the query's block; queries with fewer than k scores so far beat any.
    kth = first.groupBy("q_block", "place").agg(F.count("*").alias("n"), F.min("score").alias("s"))
    kth = kth.where(F.col("n") >= k).groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("place", "s"))).alias("beaten"))

    def lay(batches: Batches) -> Batches:
        for batch in batches:
            beats = []
            for n, beaten in zip(batch.column("n").to_pylist(), batch.column("beaten").to_pylist()):
                b = np.full(n, -(1 << 62), np.int64)
                for r in beaten or []:
                    b[r["place"]] = r["s"]
                beats.append(b.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(beats, pa.binary()), pa.array([int(np.frombuffer(b, np.int64).min()) for b in beats], pa.int64())],
                                             ["q_block", "beat", "least"])

    beat = queries.select(F.col("block").alias("q_block"), "n").join(kth, "q_block", "left").mapInArrow(lay, "q_block long, beat binary, least long")
    beat = written(beat, "to-beat")
    plan = q.join(beat, "q_block").join(x.join(longest, ["dim", "x_block"], "left_anti"), "dim")
    plan = plan.where(F.col("q_norm") * F.col("x_norm") * (1 + SLACK) + SLACK >= F.col("least")).drop("least")
    both = first.unionByName(_met(deal(plan), k, turn))
    w = Window.partitionBy("q_block", "place").orderBy(F.desc("score"), "vec_id")
    return both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
