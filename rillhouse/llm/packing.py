"""Packing into optimal length buckets, with batches of a token budget inside each bucket.

Texts are cut into sequences of at most ``max_length`` words, whole texts into as many as they need. A histogram counts
the sequences of each length over all texts; dynamic programming over it chooses the bucket boundaries that minimise
padding. A batch holds as many sequences of one bucket as fit the token budget when padded to the bucket's length.

Batches are dealt without sorting a bucket: its sequences are spread over shares by a hash of the row, the share's place in
the bucket comes from counts per share, and a row's place within its share from a window over that share alone; the number of shares
follows the bucket's count. Only the last batch of a bucket may be smaller.

Inputs: a null or empty text, or one without words, has no sequence. A null id is an id like others; rows that repeat are packed
as often. Columns other than id and text are not carried over. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import SPACE, written

MAX_LENGTH, BUCKETS, BUDGET = 2048, 16, 16_384
#: Rows per share of a bucket, about.
SHARE_ROWS = 20_000


def sequences(docs: DataFrame, max_length: int = MAX_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, first_word, n_tokens) of each sequence; ``first_word`` counts from 0."""
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")
    rows = docs.select(F.col(id_col), words.alias("_words")).where("_words > 0")
    rows = rows.select(id_col, "_words", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_words - 1) div {max_length}"))).alias("piece"))
    return rows.select(id_col, "piece", (F.col("piece") * max_length).alias("first_word"),
                       F.least(F.lit(max_length), F.col("_words") - F.col("piece") * max_length).alias("n_tokens"))


def best_boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper boundaries of at most ``buckets`` buckets with the least padding; a boundary is a length that occurs."""
    lengths = np.array(sorted(histogram), np.int64)
    n = np.array([histogram[x] for x in lengths.tolist()], float)
    if not len(lengths):
        return []
    count = np.concatenate([[0], np.cumsum(n)])
    cost = np.concatenate([[0.0], np.full(len(lengths), np.inf)])  # tokens, padded, of the first i lengths
    back = []
    for _ in range(min(buckets, len(lengths))):
        new, choice = np.full(len(cost), np.inf), np.zeros(len(cost), np.int64)
        for j in range(1, len(cost)):
            total = cost[:j] + lengths[j - 1] * (count[j] - count[:j])
            choice[j] = total.argmin()
            new[j] = total[choice[j]]
        cost = new
        back.append(choice)
    found, j = [], len(lengths)
    for choice in reversed(back):
        found.append(int(lengths[j - 1]))
        j = int(choice[j])
        if j == 0:
            break
    return sorted(found)


def pack(docs: DataFrame, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = BUDGET, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Sequences with their bucket's length, their batch (numbered within the bucket) and their padding."""
    rows = written(sequences(docs, max_length, id_col, text_col), "sequences")
    counted = rows.groupBy("n_tokens").count().collect()  # at most max_length rows
    histogram = {r["n_tokens"]: r["count"] for r in counted}
    bounds = best_boundaries(histogram, buckets)
    if not bounds:
        bounds = [max_length]
    in_bucket = {b: sum(c for x, c in histogram.items() if low < x <= b) for low, b in zip([0, *bounds], bounds)}
    bucket, shares = F.lit(bounds[-1]), F.lit(1)
    for b in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(bucket)
        shares = F.when(F.col("n_tokens") <= b, F.lit(-(-in_bucket[b] // SHARE_ROWS) or 1)).otherwise(shares)
    rows = rows.withColumn("bucket", bucket).withColumn("share", F.pmod(F.xxhash64(id_col, "piece"), shares))
    # Sizes of shares: about one for each SHARE_ROWS sequences.
    sizes = rows.groupBy("bucket", "share").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("share").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("bucket", "share", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket", "share").orderBy(F.xxhash64(id_col, "piece"), id_col, "piece")) - 1
    rows = rows.withColumn("_place", place).join(sizes, ["bucket", "share"])
    fits = F.greatest(F.lit(1), F.expr(f"{budget} div bucket"))
    at = F.col("before") + F.col("_place")
    return rows.select(id_col, "piece", "first_word", "n_tokens", F.col("bucket").cast("long").alias("bucket"),
                       F.floor(at / fits).alias("batch"), F.pmod(at, fits).alias("slot"), (F.col("bucket") - F.col("n_tokens")).alias("padding"))
