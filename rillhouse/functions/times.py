"""Epoch milliseconds, date texts and source temporal values.

Millisecond-to-text functions follow ``spark.sql.session.timeZone``; text-to-millisecond
functions take an explicit zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillhouse import settings as S

MICROS_PER_DAY = 86_400_000_000


def event_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ms_to_date(ms: Column) -> Column:
    return F.date_format(event_time(ms), S.DATE_FORMAT)


def ms_to_datetime(ms: Column) -> Column:
    return F.date_format(event_time(ms), S.DATETIME_FORMAT)


def ms_to_partition_date(ms: Column) -> Column:
    return F.date_format(event_time(ms), S.PARTITION_DATE_FORMAT)


def datetime_to_ms(text: Column, zone: str = S.BUSINESS_ZONE) -> Column:
    """Milliseconds of a ``yyyy-MM-dd HH:mm:ss`` text; null if it is no such text."""
    zoned = F.concat_ws(" ", text, F.lit(zone))
    parsed = F.try_to_timestamp(zoned, F.lit(f"{S.DATETIME_FORMAT} XXX"))
    return F.when(text.isNotNull(), F.unix_millis(parsed))


def date_to_ms(text: Column, zone: str = S.BUSINESS_ZONE) -> Column:
    return F.when(text.isNotNull(), datetime_to_ms(F.concat(text, F.lit(" 00:00:00")), zone))


def epoch_day_text(days: Column) -> Column:
    """A source DATE, delivered as days since 1970-01-01."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")), S.DATE_FORMAT)


def time_text(micros: Column) -> Column:
    """A source TIME, delivered as microseconds of the day; fraction only where there is one."""
    seconds = micros.cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(18,0)")
    since_midnight = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    clock = F.substring((F.lit("1970-01-01").cast("timestamp_ntz") + since_midnight).cast("string"), 12, 15)
    return F.when((micros >= 0) & (micros < MICROS_PER_DAY), clock)


def datetime_text(value: Column) -> Column:
    """A source DATETIME (no zone) as ``yyyy-MM-dd HH:mm:ss``, with a fraction only where there is one."""
    return value.cast("timestamp_ntz").cast("string")


def timestamp_text(utc: Column, zone: Column | str | None = None) -> Column:
    """A source TIMESTAMP, stored in UTC, as local text."""
    target = F.current_timezone() if zone is None else F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), target, utc.cast("timestamp_ntz")).cast("string")
