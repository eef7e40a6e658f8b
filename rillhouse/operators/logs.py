"""The split of application logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import schemas, settings as S
from rillhouse.functions.records import as_text_map, map_json, merge_maps, unquoted_numbers


def with_device(logs: DataFrame) -> DataFrame:
    """Logs that name a device; all later steps need it."""
    return logs.where(F.col("common")["mid"].isNotNull())


def log_start(logs: DataFrame) -> DataFrame:
    """Whole rows that report an application start."""
    return logs.where(F.col("start").isNotNull())


def log_display(logs: DataFrame) -> DataFrame:
    """One row per displayed item: its fields under those of ``common``, and the time."""
    return logs.select(F.explode("displays").alias("item"), as_text_map(logs, "common").alias("common"), "ts").select(
        merge_maps(F.col("item"), F.col("common")).alias("display"), "ts")


def log_action(logs: DataFrame) -> DataFrame:
    """One row per action: its fields under those of ``common``; the record's time is not added."""
    return logs.select(F.explode("actions").alias("item"), as_text_map(logs, "common").alias("common")).select(
        merge_maps(F.col("item"), F.col("common")).alias("action"))


def log_err(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("err").isNotNull()).drop("displays", "actions")


def log_page(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("page").isNotNull()).drop("displays", "actions", "err")


def _part_json(logs: DataFrame, name: str) -> Column:
    """One column as JSON text."""
    kind = logs.schema[name].dataType
    return F.to_json(name) if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)) else F.col(name).cast("string")


def split_log(logs: DataFrame, numbers: dict[str, tuple[str, ...]] = schemas.LOG_NUMBERS) -> DataFrame:
    """All five outputs in one pass, as (topic, value) with JSON values.

    ``numbers`` names the fields of each part that are written as numbers, where their texts are numbers; so what was a number
    in the raw line is one again. One query can write this to a broker, which takes the topic from the row, or to files
    partitioned by topic; the input is read once instead of once per output.
    """
    common = as_text_map(logs, "common")

    def row(*names: str) -> Column:
        present = [n for n in names if n in logs.columns]
        # Each part's own numbers: a name that is a number in one part may be a text in another.
        parts = [F.when(F.col(n).isNotNull(), F.concat(F.lit(f'"{n}":'), unquoted_numbers(_part_json(logs, n), numbers.get(n, ())))) for n in present]
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    def one(topic: str, present: str, value: Column) -> Column:
        entry = F.array(F.struct(F.lit(topic).alias("topic"), value.alias("value")))
        return F.when(F.col(present).isNotNull(), entry)

    def many(topic: str, items: str, **more: Column) -> Column:
        return F.transform(items, lambda item: F.struct(
            F.lit(topic).alias("topic"), unquoted_numbers(map_json(merge_maps(item, common), **more), numbers.get(items, ())).alias("value")))

    outputs = [
        one(S.TOPIC_START, "start", row("common", "page", "start", "displays", "actions", "err", "ts")),
        many(S.TOPIC_DISPLAY, "displays", ts=F.col("ts")),
        many(S.TOPIC_ACTION, "actions"),
        one(S.TOPIC_ERR, "err", row("common", "page", "start", "err", "ts")),
        one(S.TOPIC_PAGE, "page", row("common", "page", "start", "ts")),
    ]
    return logs.select(F.explode(F.flatten(F.array_compact(F.array(*outputs)))).alias("out")).select("out.*")
