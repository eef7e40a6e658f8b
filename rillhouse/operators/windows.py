"""Page filters and event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse import settings as S
from rillhouse.functions.keywords import keyword_set
from rillhouse.functions.times import event_time

HOME, DETAIL = "home", "good_detail"
TRAFFIC_DIMS = ("vc", "ch", "ar", "is_new")


def search_pages(pages: DataFrame) -> DataFrame:
    """Search texts of page views that came from another page."""
    page = F.col("page")
    return pages.where(page["item"].isNotNull() & page["last_page_id"].isNotNull()
                       & (page["item_type"] == "keyword")).select(page["item"].alias("keywords"), "ts")


def split_keywords(searches: DataFrame) -> DataFrame:
    """One row per different word; a text without words gives one row without keyword."""
    return searches.withColumn("keyword", F.explode_outer(keyword_set(F.col("keywords")))).drop("keywords")


def home_detail_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page")["page_id"].isin(HOME, DETAIL) & F.col("common")["mid"].isNotNull())


def tumble(size: str, time: Column | str = "et") -> Column:
    return F.window(time, size)


def with_window_text(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace a window by its start, end and date texts, first in the row."""
    start, end = F.col(window)["start"], F.col(window)["end"]
    return df.select(
        F.date_format(start, S.DATETIME_FORMAT).alias("stt"),
        F.date_format(end, S.DATETIME_FORMAT).alias("edt"),
        F.date_format(start, S.PARTITION_DATE_FORMAT).alias("cur_date"),
        *[c for c in df.columns if c != window])


def keyword_counts(keywords: DataFrame, size: str = S.KEYWORD_WINDOW) -> DataFrame:
    return keywords.groupBy(tumble(size), "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))


def traffic_dims() -> dict[str, Column]:
    return {d: F.col("common")[d] for d in TRAFFIC_DIMS}


def traffic_sums(parts: DataFrame, size: str = S.TRAFFIC_WINDOW) -> DataFrame:
    return parts.groupBy(tumble(size), *TRAFFIC_DIMS).agg(
        *[F.sum(c).alias(c) for c in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")])


def traffic_part(df: DataFrame, uv: Column | int = 0, sv: Column | int = 0, pv: int = 0,
                 dur: Column | int = 0) -> DataFrame:
    """Rows in the common shape of the traffic measures."""
    def measure(value: Column | int, name: str) -> Column:
        column = F.lit(value) if isinstance(value, int) else value
        return F.coalesce(column, F.lit(0)).cast("bigint").alias(name)

    return df.select("et", *TRAFFIC_DIMS, measure(uv, "uv_ct"), measure(sv, "sv_ct"), measure(pv, "pv_ct"),
                     measure(dur, "dur_sum"))


def home_detail_counts(visits: DataFrame, size: str = S.HOME_DETAIL_WINDOW) -> DataFrame:
    return visits.groupBy(tumble(size)).agg(
        F.sum((F.col("page_id") == HOME).cast("bigint")).alias("home_uv_ct"),
        F.sum((F.col("page_id") == DETAIL).cast("bigint")).alias("good_detail_uv_ct"))


def add_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("et", event_time(F.col("ts")))
