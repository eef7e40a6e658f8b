"""Parsing, filtering and pruning of raw lines and change records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import schemas, settings as S
from rillhouse.functions.records import pick_columns
from rillhouse.functions.times import event_time

_CORRUPT = "_corrupt_record"
# Change records: those of all tables, or a function that reads those of one.
Changes = DataFrame | Callable[[str], DataFrame]


def _numbers_as_text(kind: T.DataType) -> T.DataType:
    """The type with whole numbers read as texts, inside structs too."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _numbers_as_text(f.dataType)) for f in kind.fields])
    return T.StringType() if isinstance(kind, T.LongType) else kind


def _numbers_back(value: Column, kind: T.DataType) -> Column:
    """The inverse of ``_numbers_as_text``; a text that is no whole number gives null."""
    if isinstance(kind, T.StructType):
        fields = [_numbers_back(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields)) if _holds_numbers(kind) else value
    return F.when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast("bigint")) if isinstance(kind, T.LongType) else value


def _holds_numbers(kind: T.DataType) -> bool:
    return isinstance(kind, T.LongType) or isinstance(kind, T.StructType) and any(_holds_numbers(f.dataType) for f in kind.fields)


def parsed_fields(schema: T.StructType) -> list[Column]:
    """The fields of ``row`` as the schema declares them."""
    return [_numbers_back(F.col("row")[f.name], f.dataType).alias(f.name) for f in schema.fields]


def parse_lines(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add ``row``, the parsed value, with its corrupt text where it is no JSON object.

    Whole numbers stand in ``row`` as texts, as lines may quote them; ``parsed_fields`` turns them back.

    The value passes through a one-row generator: filters on ``row`` would otherwise be pushed below
    the projection and parse every line again.
    """
    full = T.StructType([*_numbers_as_text(schema).fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return lines.select("*", F.explode(F.array(F.from_json(F.col(value), full, options))).alias("row"))


def clean_json(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Drop null and malformed lines and return the parsed fields, next to the other columns."""
    others = [c for c in lines.columns if c != value]
    kept = parse_lines(lines.where(F.col(value).isNotNull()), schema, value).where(
        F.col("row").isNotNull() & F.col(f"row.{_CORRUPT}").isNull())
    return kept.select(*others, *parsed_fields(schema))


def clean_cdc(lines: DataFrame, value: str = "value") -> DataFrame:
    """Well-formed change records other than deletes; a record without ``op`` stays."""
    return without_deletes(clean_json(lines, schemas.CHANGE, value))


def without_deletes(changes: DataFrame) -> DataFrame:
    return changes.where(~F.col("op").eqNullSafe(S.OP_DELETE))


def with_event_time(df: DataFrame, ms: str, delay: str | None) -> DataFrame:
    """Add ``et`` from epoch milliseconds and, unless ``delay`` is None, its watermark."""
    timed = df.withColumn("et", event_time(F.col(ms)))
    return timed if delay is None else timed.withWatermark("et", delay)


def cdc_table(changes: Changes, table: str, db: str = S.SOURCE_DB,
              ops: tuple[str, ...] = S.UPSERT_OPS) -> DataFrame:
    """The changes of one source table, of a feed of all or of one that is read table by table."""
    source = F.col("source")
    rows = changes(table) if callable(changes) else changes
    return rows.where((source["db"] == db) & (source["table"] == table) & F.col("op").isin(*ops))


def status_transition(changes: DataFrame, field: str, reached: str, must_differ: bool = False) -> DataFrame:
    """Updates after which ``field`` holds ``reached``.

    The value before must be known; with ``must_differ`` it must also be another one.
    """
    before, after = F.col("before")[field], F.col("after")[field]
    came_from = before != reached if must_differ else before.isNotNull()
    return changes.where((F.col("op") == S.OP_UPDATE) & came_from & (after == reached))


def effective_row(changes: DataFrame) -> DataFrame:
    """Add ``data``: what was deleted for a delete, else what is there now."""
    return changes.withColumn(
        "data", F.when(F.col("op") == S.OP_DELETE, F.col("before")).otherwise(F.col("after")))


def prune_columns(df: DataFrame, data: str = "data", columns: str = "sink_columns",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Reduce a row map to the columns its configuration lists."""
    return df.withColumn(data, pick_columns(F.col(data), F.col(columns), keep))


def change_order() -> Column:
    """Order of change records: event milliseconds, number of the source's log file, position in it, and
    row of the event there, as one event may change many rows. What a source does not tell is null, which comes first."""
    def number(name: str) -> Column:
        return F.col("source")[name].try_cast("bigint").alias(name)

    # Log files are numbered at their end; as texts the tenth would come before the ninth.
    file = F.regexp_extract(F.col("source")["file"], r"(\d+)$", 1).try_cast("bigint")
    return F.struct(F.col("ts_ms").alias("ts_ms"), file.alias("file"), number("pos"), number("row"))
