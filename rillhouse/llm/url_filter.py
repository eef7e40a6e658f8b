"""URL rules by a sort-merge range join, in DataFrame operations only.

A rule names a host and a path prefix. A host's canonical key is its labels in reverse, each closed by a
dot; a rule's key is that plus ``#`` and its path, so all that the rule fits starts with the rule's
key: an interval of the key order, and two intervals are nested or apart. A url is probed once for each
number of labels that some rule's host has: its own key cut to that many labels. Rules' starts and ends
and the probes are sorted together; a sweep keeps the stack of rules whose interval is open, and the
top of it is the longest fitting rule.

The sweep runs per (key range, share): ranges are cut from the rules' keys, so that each sees few rules;
shares are dealt by a hash of the row, so that a host with very many pages spreads over tasks. Each
share of a range sees all rules that reach into it.

Inputs: a null url, or one without ``://``, has an empty host and path and fits no rule. Rows repeat as
given, null ids included; columns other than id and url are not carried over. Rules with null host are
skipped, a null path counts as ``/``; of equal rules with different verdicts ``block`` holds. Without rules
all gets the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import lower_ascii

#: Rules per key range, about.
RANGE_RULES = 1000
#: A byte above all bytes of UTF-8 text: closes an interval.
TOP = bytes([255])


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows as a DataFrame, made of literals."""
    cols = ("verdict", "host", "path")
    rows = [F.struct(*[F.lit(v).cast("string").alias(c) for c, v in zip(cols, r)]) for r in rules]
    empty = F.expr("cast(array() as array<struct<verdict:string,host:string,path:string>>)")
    return spark.range(1).select(F.inline(F.array(*rows) if rows else empty))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to a slash, question mark, hash or the end; A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit(".#"), path).cast("binary")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
               url_col: str = "url", shares: int | None = None) -> DataFrame:
    """Host, path, longest fitting rule (host and path joined; else null) and verdict of each row.

    Where rules of different hosts fit, the one longest as host and path together wins; among equally
    long ones that with the longest host. ``shares`` defaults to twice the shuffle partitions.
    """
    spark = pages.sparkSession
    n = shares or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    out = out.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                     F.pmod(F.xxhash64("page_id", "url"), F.lit(n)).alias("share"))
    rules = rules.where(F.col("host").isNotNull()).groupBy(
        lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("/")).alias("path")).agg(
        F.max("verdict").alias("verdict"))  # "block" is the greater word
    rules = rules.select(F.concat("host", "path").alias("rule"), F.length("host").alias("host_len"), "verdict",
                         F.size(_labels(F.col("host"))).alias("depth"), _key(_labels(F.col("host")), F.col("path")).alias("key"))
    out = out.withColumn("best", F.lit(None).cast("struct<len:int,host_len:int,rule:string,verdict:string>"))
    for depth, count in sorted((r[0], r[1]) for r in rules.groupBy("depth").count().collect()):
        out = _sweep(out, rules.where(F.col("depth") == depth), depth, count, n)
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                      F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def _sweep(rows: DataFrame, rules: DataFrame, depth: int, count: int, shares: int) -> DataFrame:
    """The best rule so far or, if longer, the longest fitting one among rules of ``depth`` labels."""
    cuts = []
    if count > RANGE_RULES:  # a bounded list: one key for each range
        ranked = rules.select("key", F.ntile(-(-count // RANGE_RULES)).over(Window.orderBy("key")).alias("t"))
        cuts = sorted(bytes(r[0]) for r in ranked.groupBy("t").agg(F.min("key").alias("k")).select("k").collect())[1:]

    def range_of(key: Column) -> Column:
        if not cuts:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= key))

    labels = _labels(F.col("host"))
    probes = rows.withColumn("key", _key(F.slice(labels, 1, depth), F.col("path")))
    probes = probes.withColumn("range", range_of(F.col("key"))).withColumn("kind", F.lit(1))
    best = F.struct(F.length("rule").alias("len"), "host_len", "rule", "verdict")
    edges = rules.select(best.alias("top"), F.col("key").alias("low"), F.concat("key", F.lit(TOP)).alias("high"))
    edges = edges.select("top", F.explode(F.array(F.struct(F.col("low").alias("key"), F.lit(0).alias("kind")),
                                                  F.struct(F.col("high").alias("key"), F.lit(2).alias("kind")))).alias("e"),
                         F.explode(F.sequence(range_of(F.col("low")), range_of(F.col("high")))).alias("range"))
    edges = edges.select("top", "e.*", "range")
    nested = edges.where("kind = 0").select("range", F.col("key"), F.lit(1).alias("d")).unionAll(
        edges.where("kind = 2").select("range", F.col("key"), F.lit(-1).alias("d")))
    levels = nested.select(F.sum("d").over(Window.partitionBy("range").orderBy("key", F.col("d").desc())).alias("n")).agg(
        F.max("n")).first()[0]
    edges = edges.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))

    sweep = Window.partitionBy("range", "share").orderBy("key", "kind", F.length("top.rule"))
    so_far = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = probes.unionByName(edges, allowMissingColumns=True)
    both = both.withColumn("level", F.sum(F.lit(1) - F.col("kind")).over(so_far))
    stack = [F.last(F.when((F.col("kind") == 0) & (F.col("level") == i), F.col("top")), ignorenulls=True).over(so_far)
             for i in range(1, levels + 1)]
    both = both.withColumn("stack", F.array(*stack)).where("kind = 1")
    top = F.when(F.col("level") > 0, F.element_at("stack", F.greatest("level", F.lit(1)).cast("int")))
    return both.select("page_id", "host", "path", "share", F.greatest("best", top).alias("best"))
