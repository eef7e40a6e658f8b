"""Log split and traffic windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse import settings as S
from rillhouse.operators import visitors as V
from rillhouse.operators import windows as W
from rillhouse.operators.logs import split_log, with_device


def dwd_base_log(logs: DataFrame, order: tuple[str, ...] = V.ORDER) -> DataFrame:
    """Repaired logs, split by topic, as (topic, value)."""
    return split_log(V.new_visitor_repair(with_device(logs), order))


def dws_keyword(pages: DataFrame, size: str = S.KEYWORD_WINDOW) -> DataFrame:
    """How many searches of each window hold each word. Static or streaming."""
    words = W.split_keywords(W.search_pages(pages))
    timed = W.add_event_time(words).withWatermark("et", S.PAGE_DELAY)
    return W.with_window_text(W.keyword_counts(timed, size))


def dws_traffic(pages: DataFrame, size: str = S.TRAFFIC_WINDOW, order: tuple[str, ...] = V.ORDER) -> DataFrame:
    """Page views, daily visitors, sessions and time spent per window, version, channel, area and visitor kind.

    Visitors and sessions are first reduced to the events that count, so the three branches meet in
    one aggregation whose partial sums are built before its shuffle.
    """
    dims = W.traffic_dims()
    pages = pages.where(F.col("page").isNotNull())
    views = pages.select("ts", *[c.alias(n) for n, c in dims.items()],
                         F.col("page")["during_time"].cast("bigint").alias("during_time"))
    parts = [
        W.traffic_part(W.add_event_time(views), pv=1, dur=F.col("during_time")),
        W.traffic_part(W.add_event_time(V.daily_visitors(pages, dims, order)), uv=1),
        W.traffic_part(W.add_event_time(V.session_starts(pages, dims, order)), sv=1),
    ]
    summed = W.traffic_sums(parts[0].unionByName(parts[1]).unionByName(parts[2]), size)
    return W.with_window_text(summed)


def dws_home_detail(pages: DataFrame, size: str = S.HOME_DETAIL_WINDOW) -> DataFrame:
    """Daily visitors of the home page and of product pages per window."""
    visits = V.home_detail_visitors(W.home_detail_pages(pages))
    return W.with_window_text(W.home_detail_counts(W.add_event_time(visits), size))
