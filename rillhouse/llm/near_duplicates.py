"""Near-duplicate texts by an n-gram Jaccard join with vertical partitioning.

A text's set holds the hashes of its distinct word n-grams. All n-grams stand in one global order, rare before
frequent: the leading byte is the frequency class (from a map of all texts' n-grams, of fixed size), the rest a hash.
Class 0 has n-grams that are surely in one set only; they count for the size and lead to no candidate, and only a set's others are kept.
1. Texts with equal sets form one class; all that follows works on classes.
2. Two sets that are similar enough share an n-gram among their first few in the global order (prefix filter), and so
   many of these that the rest cannot fall short (count filter). A set also has the number of its n-grams of class 0 and, of the others, a mark of
   ``MARK`` bits, one for each n-gram: sets differ in all n-grams of class 0 of both, and in at least as many others as their marks differ in bits
   (difference filter). All three leave out only pairs that cannot link.
3. A candidate pair's overlap is counted by vertical partitioning: the global order is cut into fragments, each class
   keeps one row of n-grams per fragment, the fragments' partial overlaps are counted apart and summed per pair.
4. To link groups of thousands of near copies without all their pairs, candidates come step by step: first each
   class with one partner, that which differs least among one class for each of its n-grams, first that with the fewest n-grams of class 0;
   this is done again with other such classes while it finds links, 1 + ROUNDS times at most. Then all
   candidates whose classes are still in different components. A pair that is left out lies within one component.
So components are those of all links, although not every link is checked.

Two sets link when 100 * intersection >= threshold * union. Inputs: a null or empty text, or one without words, has an
empty set and links with nothing. A null id is a text like others and never names a component; equal ids name the
same document, each row keeps its own set. Only id and text are read, and texts once for the map and once for their sets. An empty table
gives no rows. Hashes have 56 bits within a pair and 128 bits between
classes, so wrong matches are as good as impossible.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import give_back, release, ship, written
from rillhouse.llm.components import components
from rillhouse.llm.words import chunks, hashed_words, shingles

#: The map of n-grams has 2 ** MAP_BITS places, summed in BLOCKS parts; 2 ** GROUP_BITS neighbouring places share a frequency class.
MAP_BITS, GROUP_BITS, BLOCKS = 28, 5, 64
#: N-grams that a task holds before it sends their places, and rows it turns into sets at a time.
HELD, ROWS = 1 << 20, 512
#: Further rounds with one partner per class at most, before all candidates that are left are checked; they end with one that finds no link.
ROUNDS = 2
LOW = np.uint64((1 << 56) - 1)
#: Fragments of the global order are the frequency classes.
FRAGMENT_BITS = 56
#: Bits of a set's mark.
MARK = 1024
#: Ids of candidate classes up to this number are broadcast to pick their texts; beyond, both sides are shuffled.
BROADCAST_ROWS = 500_000


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``ROWS`` at a time; what is free beyond that goes back to the system after each batch."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)
        give_back()


def _sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    for _, part in chunks(texts):
        h, have = shingles(*hashed_words(part), n)
        for s in np.split(h, np.cumsum(have)[:-1]):
            yield np.unique(s)


def frequency_classes(texts: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the map a bit, whether n-grams of the sets hit it at least twice, and for each group of places
    1 + the binary logarithm of the most hits of one of them.

    Places are the leading bits of the hashes. Tasks send them sorted, as packed differences: about a byte for an n-gram.
    """
    width = (1 << MAP_BITS) // BLOCKS

    def packed(sets: list[np.ndarray]) -> pa.RecordBatch:
        at = np.sort((np.concatenate(sets) >> np.uint64(64 - MAP_BITS)).astype(np.uint32))
        blocks, data = [], []
        for b, part in enumerate(np.split(at, np.searchsorted(at, np.arange(1, BLOCKS) * width))):
            if len(part):
                steps = np.diff(part, prepend=np.uint32(b * width)).astype("<u4").view(np.uint8).reshape(-1, 4)
                blocks.append((b, len(part)))
                data.append(pa.compress(np.ascontiguousarray(steps.T).tobytes(), "zstd", asbytes=True))
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int64()), pa.array([k for _, k in blocks], pa.int64()),
                                           pa.array(data, pa.binary())], ["block", "n", "steps"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in _few(batches):
            for s in _sets(batch.column(0).to_pylist(), n):
                waiting.append(s)
                size += len(s)
                if size > HELD:
                    yield packed(waiting)
                    waiting, size = [], 0
        if size:
            yield packed(waiting)
        del waiting
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                steps = np.frombuffer(pa.decompress(data.as_buffer(), 4 * k, "zstd", asbytes=True), np.uint8).reshape(4, k)
                at = np.cumsum(np.ascontiguousarray(steps.T).view("<u4").reshape(-1), dtype=np.uint32)
                first = np.flatnonzero(np.diff(at, prepend=np.uint32(width)))  # no place is that high
                held = hits.setdefault(b, np.zeros(width, np.uint32))
                held[at[first]] += np.diff(first, append=k).astype(np.uint32)
        while hits:
            b, held = hits.popitem()
            most = held.reshape(-1, 1 << GROUP_BITS).max(axis=1)
            level = np.log2(np.maximum(most, 1)).astype(np.uint8) + np.uint8(1)
            yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([np.packbits(held > 1).tobytes()], pa.binary()),
                                              pa.array([level.tobytes()], pa.binary())], ["block", "twice", "levels"])
            del held
            give_back()

    parts = texts.mapInArrow(spread, "block long, n long, steps binary").repartition(BLOCKS, "block")
    twice, levels = np.zeros((BLOCKS, width // 8), np.uint8), np.ones((BLOCKS, width >> GROUP_BITS), np.uint8)
    counted = written(parts.mapInArrow(add, "block long, twice binary, levels binary"), "n-gram-map")
    for start in range(0, BLOCKS, 8):  # the map's fixed size, 40 MB, a few parts at a time
        for r in counted.where(F.col("block").between(start, start + 7)).collect():
            twice[r["block"]], levels[r["block"]] = np.frombuffer(r["twice"], np.uint8), np.frombuffer(r["levels"], np.uint8)
    return twice.reshape(-1), levels.reshape(-1)


def _mark(s: np.ndarray) -> list[int]:
    bits = np.zeros(MARK, bool)
    bits[(s & np.uint64(MARK - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64).tolist()


def _ordered(s: np.ndarray, classes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A set in the global order, as numbers that sort by it. Those below 2 ** 56 are in no other set."""
    twice, levels = classes
    at = (s >> np.uint64(64 - MAP_BITS)).astype(np.uint32)
    shared = (twice[at >> np.uint32(3)] >> (np.uint32(7) - (at & np.uint32(7))).astype(np.uint8)) & 1
    return np.sort(((levels[at >> np.uint32(GROUP_BITS)] * shared).astype(np.uint64) << np.uint64(56)) | (s & LOW))


def link_near_duplicates(docs: DataFrame, n: int = 5, threshold: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """(id, set size, component id) of each row; the component's id is the smallest id its links reach."""
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    levels = spark.sparkContext.broadcast(frequency_classes(rows.select("text"), n))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            size, rare, sign, prefix, mark, shared = [], [], [], [], [], []
            for s in _sets(batch.column(2).to_pylist(), n):
                s = _ordered(s, levels.value)
                size.append(len(s))
                sign.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                few, met = s[:len(s) + (threshold * len(s)) // -100 + 1 if len(s) else 0], s[s > LOW]
                rare.append(len(s) - len(met))
                prefix.append(few[few > LOW].astype(np.int64))
                mark.append(_mark(met))
                shared.append(met.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(rare, pa.int64()), pa.array(sign, pa.binary()), pa.array(prefix, pa.list_(pa.int64())),
                 pa.array(mark, pa.list_(pa.int64())), pa.array(shared, pa.binary())],
                ["row", "id", "size", "rare", "sign", "prefix", "mark", "shared"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    found = written(numbered.mapInArrow(classify, "row long, id long, size long, rare long, sign binary, prefix array<long>, mark array<long>, shared binary"), "sets")
    levels.destroy()  # all that needed it is written
    # A class is stood for by one of its rows.
    classes = found.where("size > 0").groupBy("sign").agg(F.min("id").alias("first_id"), F.min("row").alias("node"), F.first("size").alias("size"),
                                                          F.first("rare").alias("rare"), F.first("prefix").alias("prefix"), F.first("mark").alias("mark"))
    classes = written(classes, "classes")
    sets = found.select(F.col("row").alias("node"), "shared")

    # Dealt by n-gram once, for the counts and for the join with them.
    postings = classes.select("node", "size", "rare", F.explode("prefix").alias("gram")).repartition("gram")
    shared = postings.groupBy("gram").agg(F.min(F.struct("rare", "node", "size")).alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    postings = written(postings.join(shared, "gram"), "postings")
    grams = postings.drop("pivot")

    first = postings.where("node <> pivot.node").groupBy(F.col("node").alias("a"), F.col("pivot.node").alias("b")).agg(
        F.count("*").alias("common"), F.first(F.least("size", "pivot.size")).alias("low"), F.first(F.greatest("size", "pivot.size")).alias("high"))
    links = _verified(_nearest(_alike(first.where(_may_link(threshold)), classes, threshold)), sets, threshold)
    roots = written(components(links), "roots")

    placed = grams.join(_small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_grams = placed.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("gram")
    placed = written(placed.join(_small(written(open_grams, "open-grams")), "gram"), "placed")
    for turn in range(ROUNDS):
        pivots = placed.groupBy("gram").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "size", "root")).alias("p"))
        near = placed.join(pivots, "gram").where("root <> p.root").groupBy(F.col("node").alias("a"), F.col("p.node").alias("b")).agg(
            F.count("*").alias("common"), F.first(F.least("size", "p.size")).alias("low"), F.first(F.greatest("size", "p.size")).alias("high"))
        new = _verified(_nearest(_alike(near.where(_may_link(threshold)), classes, threshold)), sets, threshold)
        if new.limit(1).count() == 0:
            break
        links = links.unionAll(new)
        roots = written(components(links), "roots")
        placed = placed.drop("root").join(_small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
        placed = written(placed.select("gram", "node", "size", "rare", "root"), "placed")
    most = placed.groupBy("gram", "root").agg(F.count("*").alias("n")).groupBy("gram").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    placed = placed.join(most, "gram").join(classes.select("node", "mark"), "node")
    # Each pair has a side outside the n-gram's largest component; if both are, the smaller node comes first. Sets that surely differ too much
    # do not pair, so a group of texts that are alike, but not enough, gives no rows.
    outside = placed.where("root <> main").select("gram", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("size").alias("sa"),
                                                  F.col("rare").alias("na"), *_words("mark_a"))
    other = placed.select("gram", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("size").alias("sb"),
                          F.col("rare").alias("nb"), "main", *_words("mark_b"))
    low, high = F.least("sa", "sb"), F.greatest("sa", "sb")
    differ = sum((F.bit_count(F.col(f"mark_a{i}").bitwiseXOR(F.col(f"mark_b{i}"))) for i in range(MARK // 64)), F.col("na") + F.col("nb"))
    pairs = outside.join(other, "gram").where(
        (F.col("ra") != F.col("rb")) & ((F.col("rb") == F.col("main")) | (F.col("a") < F.col("b"))) & (100 * low >= threshold * high)
        & _near_enough(low + high, differ, threshold))
    pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.count("*").alias("common"), F.first(low).alias("low"), F.first(high).alias("high"))
    more = _verified(pairs.where(_may_link(threshold)).select("a", "b", (F.col("low") + F.col("high")).alias("total")), sets, threshold)
    if more.limit(1).count():  # else the roots are those of all links already
        roots = components(links.unionAll(more))

    named = classes.join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(names, "root").select("sign", "component_id")
    linked = found.where("size > 0").select("id", "size", "sign").join(named, "sign")
    alone = found.where("size = 0").select("id", "size", F.col("id").alias("component_id"))
    return linked.select("id", "size", "component_id").unionAll(alone).select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id")


def _may_link(threshold: int):
    """The count filter on columns common, low and high (sizes): with all n-grams beyond the first few, enough can overlap."""
    beyond = F.ceil(F.lit(threshold) * F.col("high") / 100) - 1
    need = F.ceil(F.lit(threshold) * (F.col("low") + F.col("high")) / (100 + threshold))
    return (F.col("common") + beyond >= need) & (100 * F.col("low") >= threshold * F.col("high"))


def _alike(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that do not surely differ in too many n-grams, with the number of those."""
    marks = classes.select("node", "mark", "rare", F.col("size").alias("s"))
    both = pairs.join(marks.toDF("a", "mark_a", "n_a", "s_a"), "a").join(marks.toDF("b", "mark_b", "n_b", "s_b"), "b")
    bits = F.aggregate(F.zip_with("mark_a", "mark_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    differ = F.col("n_a") + F.col("n_b") + bits
    return both.where(_near_enough(F.col("s_a") + F.col("s_b"), differ, threshold)).select(*pairs.columns, differ.alias("differ"))


def _nearest(pairs: DataFrame) -> DataFrame:
    """For each a the pair (a, b) that differs least, with the sum of both sizes."""
    best = F.min(F.struct("differ", (-F.col("common")).alias("common"), "b", (F.col("low") + F.col("high")).alias("total"))).alias("best")
    return pairs.groupBy("a").agg(best).select("a", "best.b", "best.total")


def _near_enough(total, differ, threshold: int):
    """The difference filter: sets with ``total`` n-grams together, of which at least ``differ`` are in one of them only."""
    return (100 + threshold) * (total - differ) >= 2 * threshold * total


def _words(name: str) -> list:
    """The mark as one column for each 64 bits."""
    return [F.col("mark")[i].alias(f"{name}{i}") for i in range(MARK // 64)]


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has at most ``BROADCAST_ROWS`` rows; changes the plan only."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of classes, given with the sum of their sizes, that are similar enough, by summed overlaps of fragments."""
    pairs = written(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            out = []
            for node, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = np.frombuffer(data.as_buffer(), np.uint64)
                part, at = np.unique(s >> np.uint64(FRAGMENT_BITS), return_index=True)
                out += [(node, int(p), x.astype(np.int64)) for p, x in zip(part, np.split(s, at[1:]))]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                                              pa.array([o[2] for o in out], pa.list_(pa.int64()))], ["node", "part", "grams"])

    parts = sets.join(_small(wanted), "node").select("node", "shared").mapInArrow(cut, "node long, part long, grams array<long>")
    parts = written(parts, "fragments")
    left, right = (parts.select(F.col("node").alias(c), "part", F.col("grams").alias(f"grams_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, ["b", "part"])
    partial = both.select("a", "b", "total", F.size(F.array_intersect("grams_a", "grams_b")).alias("n"))
    overlap = partial.groupBy("a", "b").agg(F.sum("n").alias("overlap"), F.first("total").alias("total"))
    fits = 100 * F.col("overlap") >= threshold * (F.col("total") - F.col("overlap"))
    links = written(overlap.where(fits).select("a", "b"), "links")
    release(links.sparkSession)
    return links
