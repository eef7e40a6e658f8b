"""Landing, dimensions and configured routes of the change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas, settings as S
from rillhouse.functions.records import map_json
from rillhouse.operators.clean import prune_columns, without_deletes
from rillhouse.operators.dims import dim_merge
from rillhouse.operators.joins import route_changes
from rillhouse.operators.upsert import latest_config
from rillhouse.sources.feeds import ods_records


def ods_ingest(lines: DataFrame) -> DataFrame:
    """The change feed as it is, ready to be landed by source table and day."""
    return ods_records(lines)


def dim_config(config_changes: DataFrame) -> DataFrame:
    return latest_config(config_changes, ["source_table"], schemas.DIM_CONFIG_FIELDS)


def dwd_config(config_changes: DataFrame) -> DataFrame:
    return latest_config(config_changes, ["source_table", "source_type"], schemas.DWD_CONFIG_FIELDS)


def dim_sync(changes: DataFrame, config_changes: DataFrame) -> DataFrame:
    """Current rows of every configured dimension, as (sink_table, row_key, data)."""
    return dim_merge(route_changes(changes, dim_config(config_changes)))


def dwd_base_db(changes: DataFrame, config_changes: DataFrame) -> DataFrame:
    """Rows of configured tables and operations, as (sink_table, value) with JSON values."""
    routed = route_changes(without_deletes(changes), dwd_config(config_changes), by_op=True)
    return routed_values(prune_columns(routed))


def routed_values(routed: DataFrame) -> DataFrame:
    data = F.map_filter("data", lambda k, v: v.isNotNull() & (k != "op"))
    return routed.select("sink_table", map_json(data).alias("value"))
