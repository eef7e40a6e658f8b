"""Visitor state over micro-batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from rillhouse import settings as S
from rillhouse.functions.times import event_time
from rillhouse.operators import visitors as V
from rillhouse.streaming.tables import BatchTable

VISITS = T.StructType([T.StructField("mid", T.StringType()), T.StructField("first_visit", T.DateType())])
# A batch reads the first visits of only the buckets its devices are in.
VISIT_BUCKETS = 64
DAY_MS = 86_400_000
# Days of one device whose state is one value, a bit for each.
SPAN = 32
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
# Workers get what they run of this module by value, as they need not have the package. Files added to the session do not reach all of
# them: a stateful step is first set up by a worker on the driver that has none of these.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def visits_table(state: str, **sizes: int) -> BatchTable:
    return BatchTable(state, VISITS, ("mid",), **{"buckets": VISIT_BUCKETS, **sizes})


def repair_batch(logs: DataFrame, batch_id: int, state: str, order: tuple[str, ...] = V.ORDER, **sizes: int) -> DataFrame:
    """New-visitor repair of one micro-batch against the first visits of all earlier ones.

    First visits never change, so the state is a table to which each batch adds its new devices, dealt to
    buckets by device. The batch reads the buckets its devices are in; a key-wise lookup of the rest of the table is not needed.
    The rows meet it as in the static form, with hot devices split off.
    """
    spark, table = logs.sparkSession, visits_table(state, **sizes)
    devices = logs.where(V.mid().isNotNull())
    touched = [r[0] for r in devices.select(table.bucket(V.mid()).alias("b")).distinct().collect()]  # at most the number of buckets
    known = table.read(spark, batch_id - 1, touched)
    table.add(V.first_visits(logs, order).join(known, "mid", "left_anti"), batch_id)
    return V.new_visitor_repair(logs, order, table.read(spark, batch_id, touched))


SESSION = "session"


def visit_row(kind: Column | str, key: Column, bucket: Column, keep: dict[str, Column]) -> Column:
    """One candidate event: what it is first of, for which key, in which time bucket; null without key or time."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.when(key.isNotNull() & F.col("ts").isNotNull(), F.struct(
        kind.alias("kind"), key.alias("key"), bucket.cast("bigint").alias("bucket"), F.col("ts"),
        *[c.alias(n) for n, c in keep.items()]))


def daily_row(kind: Column | str, keep: dict[str, Column]) -> Column:
    """Candidate for the first event of a device and day."""
    return visit_row(kind, V.mid(), F.unix_date(F.to_date(event_time(F.col("ts")))), keep)


def session_row(keep: dict[str, Column], gap_ms: int = S.SESSION_GAP_MS) -> Column:
    """Candidate for the event that opens a session."""
    return visit_row(SESSION, F.col("common")["sid"], F.floor(F.col("ts") / gap_ms), keep)


class FirstEvents(StatefulProcessor):
    """One number for each key: the days seen, as bits, of a device and ``SPAN`` days, or a session's last time.

    A key's state goes when the watermark has passed what it is for: the span's end, or the gap after the session's last time. Rows that
    come later are late, or open a session anyway, so nothing is lost with it.
    """

    def __init__(self, names: list[str], gap_ms: int):
        self.names, self.gap_ms, self.named = names, gap_ms, Row(*names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "value bigint")

    def _ends(self, key: tuple, seen: int) -> int:
        return seen + self.gap_ms if key[0] == SESSION else (key[2] + 1) * SPAN * DAY_MS

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        # A key mostly has one row or two, so plain rows are far cheaper than a frame for each key; so is one call for the state.
        firsts: dict[int, tuple[Row, int]] = {}
        for row in rows:
            held = firsts.get(row.bucket)
            if held is None:
                firsts[row.bucket] = row, row.last_ts
            else:
                firsts[row.bucket] = row if row.ts < held[0].ts else held[0], max(row.last_ts, held[1])
        known = self.seen.get()
        last = seen = None if known is None else known[0]
        opened = []
        for bucket in sorted(firsts):
            row, last_ts = firsts[bucket]
            if key[0] == SESSION:
                if seen is None or row.ts - seen >= self.gap_ms:
                    opened.append(row)
                seen = last_ts if seen is None else max(seen, last_ts)
            else:
                bit = 1 << bucket % SPAN
                if not bit & (seen or 0):
                    opened.append(row)
                seen = (seen or 0) | bit
        if seen != last:
            self.seen.update((seen,))
        if known is None:
            self.handle.registerTimer(self._ends(key, seen))
        for row in opened:
            yield self.named(*[row[n] for n in self.names[:-1]], EPOCH + timedelta(milliseconds=row.ts))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        ends = self._ends(key, self.seen.get()[0])
        if ends > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(ends)  # the session went on
        else:
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_events_stream(pages: DataFrame, rows: list[Column], keep: dict[str, Column],
                        gap_ms: int = S.SESSION_GAP_MS, delay: str = S.PAGE_DELAY) -> DataFrame:
    """Events that count, with their time ``et``: the first of each device and day, and those that open a session.

    All kinds share one stateful step. Before rows are grouped by key, each task reduces them to the first event
    and the last time per key and time bucket, so a key with very many rows does not reach one task whole. A
    session bucket is no wider than the gap, so only its first event can open a session.

    The input must have no watermark yet: rows may come ``delay`` late, later ones are dropped. Of a batch the earliest row of a key and bucket
    stands for all of them; where it is late itself, the others go with it, as they would had it come alone before them. State goes behind the watermark,
    see ``FirstEvents``, so it is by event time alone when a session is forgotten: a query that was stopped for long, and one that runs over what
    is available, give the same events.
    """
    fields = "".join(f", {n} string" for n in keep)
    names = ["kind", "key", "ts", *keep, "et"]  # the time comes last

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield first_per_bucket(batch.assign(last_ts=batch["ts"]), ["kind", "key", "bucket"])

    chosen = pages.select(F.explode(F.array_compact(F.array(*rows))).alias("row")).select("row.*")
    reduced = chosen.mapInPandas(reduce_rows, f"kind string, key string, bucket bigint, ts bigint{fields}, last_ts bigint")
    # A session is one key, a device one for each span of days.
    span = F.when(F.col("kind") != SESSION, F.floor(F.col("bucket") / SPAN)).otherwise(0).cast("bigint")
    timed = reduced.withColumn("et", event_time(F.col("ts"))).withWatermark("et", delay).withColumn("span", span)
    return timed.groupBy("kind", "key", "span").transformWithState(
        FirstEvents(names, gap_ms), f"kind string, key string, ts bigint{fields}, et timestamp", "Append", "EventTime", eventTimeColumnName="et")


def first_per_bucket(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """First row of each group by time, with the group's last time."""
    rows = rows.sort_values("ts", kind="stable")
    rows = rows.assign(last_ts=rows.groupby(keys)["last_ts"].transform("max"))
    return rows.drop_duplicates(keys)
