"""First visits, new-visitor repair, daily visitors and sessions, on static input.

No rule here sorts all rows of a visitor: first events are minima built before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse import settings as S
from rillhouse.functions.records import put_field
from rillhouse.functions.times import event_time, ms_to_date
from rillhouse.operators.skew import join_hot_split

ORDER = ("ts",)


def mid() -> Column:
    return F.col("common")["mid"]


def first_visits(logs: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """First visit date per device: its first event's date if flagged new, else the day before."""
    day = F.to_date(event_time(F.col("ts")))
    visit = F.when(F.col("common")["is_new"] == "1", day).otherwise(
        F.to_date(event_time(F.col("ts") - 86_400_000)))
    firsts = logs.where(mid().isNotNull()).groupBy(mid().alias("mid")).agg(
        F.min(F.struct(*order, visit.alias("visit"))).alias("first"))
    return firsts.select("mid", F.col("first.visit").alias("first_visit"))


def new_visitor_repair(logs: DataFrame, order: tuple[str, ...] = ORDER,
                       visits: DataFrame | None = None) -> DataFrame:
    """Clear the new-visitor flag on every later day than the device's first visit.

    Only rows that carry the flag need their device's first visit; the others pass through unshuffled.
    """
    visits = first_visits(logs, order) if visits is None else visits
    keyed = logs.withColumn("mid", mid())
    flagged = F.col("common")["is_new"].eqNullSafe("1") & F.col("mid").isNotNull()
    joined = join_hot_split(keyed.where(flagged), visits, "mid", "left")
    later = F.to_date(event_time(F.col("ts"))) != F.col("first_visit")
    flag = F.when(later, F.lit("0")).otherwise(F.lit("1"))
    repaired = joined.withColumn("common", put_field(joined, "common", "is_new", flag))
    return repaired.select(*logs.columns).unionByName(keyed.where(~flagged).select(*logs.columns))


def daily_first(logs: DataFrame, keys: dict[str, Column], keep: dict[str, Column],
                order: tuple[str, ...] = ORDER) -> DataFrame:
    """First event of each key and day, with the columns to keep of it."""
    named = [c.alias(n) for n, c in keys.items()]
    firsts = logs.groupBy(*named, ms_to_date(F.col("ts")).alias("day")).agg(
        F.min(F.struct(*order, *[c.alias(n) for n, c in keep.items() if n not in order])).alias("first"))
    kept = [F.col(f"first.{n}").alias(n) for n in dict.fromkeys((*order, *keep))]
    return firsts.select(*keys, "day", *kept)


def daily_visitors(logs: DataFrame, keep: dict[str, Column], order: tuple[str, ...] = ORDER) -> DataFrame:
    """The event that counts as the device's visit of the day."""
    return daily_first(logs.where(mid().isNotNull()), {"mid": mid()}, keep, order)


def session_starts(logs: DataFrame, keep: dict[str, Column], order: tuple[str, ...] = ORDER,
                   gap_ms: int = S.SESSION_GAP_MS) -> DataFrame:
    """Events that open a session: the first of a session id, or after a pause of ``gap_ms`` or more.

    Within one time bucket of width ``gap_ms`` no pause can be that long, so only a bucket's first
    event can open a session. The window below thus sees one row per session id and bucket.
    """
    sid = F.col("common")["sid"]
    buckets = (logs.where(sid.isNotNull())
               .groupBy(sid.alias("sid"), F.floor(F.col("ts") / gap_ms).alias("bucket"))
               .agg(F.min(F.struct(*order, *[c.alias(n) for n, c in keep.items() if n not in order])).alias("first"),
                    F.max("ts").alias("last_ts")))
    by_time = Window.partitionBy("sid").orderBy("bucket")
    opened = buckets.withColumn("prev_ts", F.lag("last_ts").over(by_time)).where(
        F.col("prev_ts").isNull() | (F.col("first.ts") - F.col("prev_ts") >= gap_ms))
    return opened.select("sid", *[F.col(f"first.{n}").alias(n) for n in dict.fromkeys((*order, *keep))])


def home_detail_visitors(logs: DataFrame) -> DataFrame:
    """First time of each device, page and day; plain minima of a number."""
    return logs.groupBy(mid().alias("mid"), F.col("page")["page_id"].alias("page_id"),
                        ms_to_date(F.col("ts")).alias("day")).agg(F.min("ts").alias("ts"))
