"""Traffic windows over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse import settings as S
from rillhouse.operators import windows as W
from rillhouse.operators.bands import timed
from rillhouse.streaming.visitors import SESSION, daily_row, first_events_stream, session_row


def traffic_stream(pages: DataFrame, size: str = S.TRAFFIC_WINDOW, delay: str = S.PAGE_DELAY,
                   gap_ms: int = S.SESSION_GAP_MS) -> DataFrame:
    """Page views, daily visitors and sessions in one window sum: all views, and the events that count."""
    dims = W.traffic_dims()
    pages = pages.where(F.col("page").isNotNull())
    views = timed(pages.select("ts", *[c.alias(n) for n, c in dims.items()],
                                F.col("page")["during_time"].cast("bigint").alias("during_time")), "et", delay)
    firsts = first_events_stream(pages, [daily_row("day", dims), session_row(dims, gap_ms)], dims, gap_ms, delay)
    is_session = F.col("kind") == SESSION
    counted = W.traffic_part(firsts, uv=F.when(is_session, 0).otherwise(1), sv=F.when(is_session, 1).otherwise(0))
    parts = W.traffic_part(views, pv=1, dur=F.col("during_time")).unionByName(counted)
    return W.with_window_text(W.traffic_sums(parts, size))


def home_detail_stream(pages: DataFrame, size: str = S.HOME_DETAIL_WINDOW, delay: str = S.PAGE_DELAY) -> DataFrame:
    candidates = [daily_row(F.col("page")["page_id"], {})]
    visits = first_events_stream(W.home_detail_pages(pages), candidates, {}, delay=delay).withColumnRenamed("kind", "page_id")
    return W.with_window_text(W.home_detail_counts(visits, size))
