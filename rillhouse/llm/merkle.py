"""Merkle manifest of a data set: digests of rows, trees by group, proofs, and their check after tampering.

Every row is a leaf, its digest covers the columns named. Within its group (a null group is one too) leaves ascend by id;
every ``FAN`` neighbours become one node, until one node is left, the group's subroot. Subroots in order of their
groups likewise become the root.

Nodes carry nested intervals: a node of level k covers the ranks ``[low, high)`` of its group's leaves. A tree of any number of
groups is built level by level; a level's nodes are grouped by the interval of the level above, so at most ``FAN`` rows meet.
From the top down each level's nodes then join the level above, bucketed by level and interval, and contained in one interval
of it: the parent. What the parent covers beside the node itself is the siblings; they go in front of the parent's own.
So a node meets one parent and a parent at most ``FAN`` nodes, however many leaves a group holds.

Ranks come from one range partitioning by (group, id, digest): a row's place in its partition, plus what the
partitions before it hold of its group. No group is sorted or numbered in one task.

Inputs: a null group comes before all others, a null id before all ids; rows that repeat an id are leaves of their own, by digest, and
rows alike in all these columns have the same digest and stand side by side. A null value counts as ``-``, an empty text as
``0:``. A row without id is never tampered with. A group of one row has its leaf as subroot and a single group its subroot as root;
the digest of no siblings is that of the empty text. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import written

FAN = 3
#: Columns a leaf covers, in order.
COVERED = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """sha256 of the parts' concatenation, as lowercase hex."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(columns: dict[str, Column]) -> Column:
    """A row's digest: of each value its length in bytes, a colon and itself, or ``-`` where it is null."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[part(c) for c in columns.values()])


def is_tampered(row_id: Column) -> Column:
    """Rows whose id, as text, has an even checksum."""
    return F.coalesce(F.pmod(F.crc32(row_id.cast("string").cast("binary")), F.lit(2)) == 0, F.lit(False))


def tampered(text: Column) -> Column:
    return F.translate(text, "\n", "")


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Rows with their ``rank`` within the group, from 0, and the group's size ``n``.

    Rows are range-partitioned once and written with their place; only partitions' counts by group are added up.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The last part of the order keeps rows alike in all else apart, or they would share one partition.
    keys = [group, *order, "spread"]
    placed = (rows.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()).drop("spread"))
    placed = written(placed, "merkle-places")
    counts = placed.groupBy(group, "part").agg(F.count("*").alias("held"), F.min("place").alias("first"))
    # Partitions are in the order of groups. The windows see one row for each partition that holds rows of the group.
    parts = Window.partitionBy(group)
    before = F.coalesce(F.sum("held").over(parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(group, "part", (before - F.col("first")).alias("shift"), F.sum("held").over(parts).alias("n"))
    # A key of this join has no more rows than a partition.
    out = placed.join(counts, [group, "part"]).withColumn("rank", F.col("place") + F.col("shift"))
    return out.drop("part", "place", "shift")


def height(n: Column) -> Column:
    """How many levels a tree of ``n`` leaves has above them; in whole numbers, as logarithms round."""
    top = int(math.log(2 ** 62, FAN))
    return F.coalesce(*[F.when(n > F.lit(FAN ** k), k + 1) for k in range(top, -1, -1)], F.lit(0))


def bucket(level: int) -> Column:
    """Which node of ``level`` covers the rank ``low``."""
    return F.expr(f"low div {FAN ** level}L").alias("bucket")


def trees(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels of all groups' trees, from the leaves up, and the groups' tops.

    ``leaves`` has (tree, n, rank, digest) and may have more, which the first level keeps. A level has (tree, low, high, height,
    digest), all but the first also the nodes right below; tops have (tree, digest).
    """
    more = [c for c in leaves.columns if c not in ("tree", "n", "rank", "digest")]
    now = leaves.select("tree", F.col("rank").alias("low"), (F.col("rank") + 1).alias("high"), height(F.col("n")).alias("height"), "digest", *more)
    levels = [written(now, "merkle-level")]
    top = levels[0].agg(F.max("height")).first()[0] or 0
    for k in range(1, top + 1):
        inside = levels[-1].where(F.col("height") >= k).groupBy("tree", bucket(k))
        # At most FAN rows meet.
        parents = inside.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.first("height").alias("height"),
                             F.sort_array(F.collect_list(F.struct("low", "high", "digest"))).alias("children"))
        parents = parents.select("tree", "low", "high", "height", digest(F.array_join("children.digest", "")).alias("digest"), "children")
        levels.append(written(parents, "merkle-level"))
    tops = [level.where(F.col("height") == k).select("tree", "digest") for k, level in enumerate(levels)]
    return levels, reduce(DataFrame.unionAll, tops)


#: Siblings of one level: what stands left and right of the node.
SIDES = "array<struct<left:string,right:string>>"


def proofs(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with (top, proof), the proof listing siblings from the leaf's level up.

    ``above`` has (tree, top, proof) of the trees' tops: their digest and the proof from there on. Each level joins the one above it.
    """
    found = None
    for k in range(len(levels) - 1, -1, -1):
        tops = levels[k].where(F.col("height") == k).join(above, "tree")
        if found is None:
            found = tops
            continue
        parents = found.select("tree", bucket(k + 1), F.col("low").alias("from"), F.col("high").alias("to"),
                               F.col("children").alias("covered"), "top", F.col("proof").alias("rest"))
        inner = levels[k].where(F.col("height") > k).withColumn("bucket", bucket(k + 1)).join(parents, ["tree", "bucket"])
        inner = inner.where((F.col("low") >= F.col("from")) & (F.col("high") <= F.col("to")))
        # The parent's interval less the node's own.
        left = F.filter("covered", lambda c: c["high"] <= F.col("low"))
        right = F.filter("covered", lambda c: c["low"] >= F.col("high"))
        sides = F.struct(F.array_join(left["digest"], "").alias("left"), F.array_join(right["digest"], "").alias("right"))
        inner = inner.withColumn("proof", F.concat(F.array(sides), "rest"))
        found = tops.unionByName(inner.select(*tops.columns))
    return found


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, start, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(rows: DataFrame, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text",
             covered: tuple[str, ...] = COVERED) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root, verified) of each row.

    ``proof`` lists the siblings of each level as (left, right), subroots' among them. ``folded_root`` starts from the row
    as tampered with, if it is, and uses the original siblings; ``verified`` tells if it is the root.
    """
    columns = {c: F.col(c) for c in covered}
    # An empty text for the null group: it comes first, and all others begin with a mark.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    changed = F.when(is_tampered(F.col(id_col)), leaf({**columns, text_col: tampered(F.col(text_col))}))
    leaves = rows.select(F.col(id_col).alias("id"), tree.alias("tree"), leaf(columns).alias("digest"), changed.alias("changed"))
    # Written first, as range partitioning reads its input twice.
    levels, tops = trees(ranked(written(leaves, "merkle-leaves"), "tree", "id", "digest"))

    # The groups' subroots are the leaves of one more tree.
    groups = ranked(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "tree", "name")
    upper, root = trees(groups)
    start = root.select("tree", F.col("digest").alias("top"), F.array().cast(SIDES).alias("proof"))
    above = written(proofs(upper, start).select(F.col("name").alias("tree"), F.col("digest").alias("top"), "proof"), "merkle-groups")
    root = root.first()
    root = F.lit(root["digest"] if root else None).cast("string")

    found = proofs(levels, above)
    out = found.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), F.col("top").alias("subroot"), root.alias("root"), "proof",
                       folded(F.coalesce("changed", "digest"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(proof: Column) -> Column:
    """sha256 of all siblings' digests, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""))
