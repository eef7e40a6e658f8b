import random

from conftest import rows_of
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.operators import dims
from rillhouse.operators.joins import route_changes
from rillhouse.plans import routing

CONFIG = ("t", "dim_t", "id,a,b", "info", "id")


def config_feed(spark, *rows):
    def as_map(values):
        return None if values is None else dict(zip(schemas.DIM_CONFIG_FIELDS, values))
    data = [(as_map(b), as_map(a), {"table": "cfg", "pos": str(i)}, op, ts) for i, (op, ts, b, a) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.CHANGE)


def merged(spark, feed, *config):
    df = routing.dim_sync(feed, config_feed(spark, *(config or [("c", 0, None, CONFIG)])))
    return {k: d for k, d in df.select("row_key", "data").collect()}


def test_null_cells_keep_their_value(spark, changes):
    feed = changes(("t", "c", 1, None, {"id": "1", "a": "x", "b": "y", "hidden": "h"}),
                   ("t", "u", 2, {}, {"id": "1", "a": None, "b": "z"}))
    assert merged(spark, feed) == {"1": {"id": "1", "a": "x", "b": "z"}}


def test_delete_then_insert_starts_afresh(spark, changes):
    feed = changes(("t", "c", 1, None, {"id": "1", "a": "x"}), ("t", "d", 2, {"id": "1", "a": "x"}, None),
                   ("t", "c", 2, None, {"id": "1", "b": "y"}),
                   ("t", "c", 1, None, {"id": "2", "a": "x"}), ("t", "d", 2, {"id": "2"}, None))
    assert merged(spark, feed) == {"1": {"id": "1", "b": "y"}}


def test_config_update_drops_earlier_rows_and_delete_drops_all(spark, changes):
    feed = changes(("t", "c", 1, None, {"id": "1", "a": "x"}), ("t", "c", 9, None, {"id": "2", "a": "x"}))
    assert merged(spark, feed, ("c", 0, None, CONFIG), ("u", 5, CONFIG, CONFIG)) == {"2": {"id": "2", "a": "x"}}
    assert merged(spark, feed, ("c", 0, None, CONFIG), ("d", 5, CONFIG, None)) == {}
    again = merged(spark, feed, ("c", 0, None, CONFIG), ("d", 5, CONFIG, None), ("c", 6, None, CONFIG))
    assert again == {"2": {"id": "2", "a": "x"}}


def test_cells_can_be_merged_in_any_order(spark, changes):
    """Against a row-by-row table, over random changes cut into random parts."""
    rng = random.Random(5)
    rows, table = [], {}
    for ts in range(300):
        key = str(rng.randrange(8))
        if rng.random() < 0.15:
            rows.append(("t", "d", ts, {"id": key}, None))
            table.pop(key, None)
        else:
            row = {"id": key, **{c: rng.choice([None, str(rng.randrange(50))]) for c in "ab" if rng.random() < 0.8}}
            rows.append(("t", "u", ts, {}, row))
            table.setdefault(key, {}).update({c: v for c, v in row.items() if v is not None})
    routed = route_changes(changes(*rows), routing.dim_config(config_feed(spark, ("c", -1, None, CONFIG))))
    part = F.col("ts_ms") % 3
    parts = [dims.dim_cells(routed.where(part == i)) for i in (2, 0, 1)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[1])
    got = {k: d for k, d in dims.dim_rows(dims.merge_cells(union)).select("row_key", "data").collect()}
    assert got == table


def test_base_db_routes_by_table_and_operation(spark, changes):
    fields = schemas.DWD_CONFIG_FIELDS
    cfg = [("t", "c", "sink_c", "id,a"), ("t", "u", "sink_u", "id"), ("s", "c", "sink_s", "id")]
    data = [(None, dict(zip(fields, v)), {"pos": str(i)}, "r", i) for i, v in enumerate(cfg)]
    data.append((dict(zip(fields, cfg[2])), None, {"pos": "9"}, "d", 9))
    config = spark.createDataFrame(data, schemas.CHANGE)
    feed = changes(("t", "c", 1, None, {"id": "1", "a": None, "z": "q"}), ("t", "u", 1, {}, {"id": "2", "a": "x"}),
                   ("t", "d", 1, {"id": "3"}, None), ("s", "c", 1, None, {"id": "4"}), ("t", "r", 1, None, {"id": "5"}))
    assert rows_of(routing.dwd_base_db(feed, config)) == [("sink_c", '{"id":"1"}'), ("sink_u", '{"id":"2"}')]


def test_dictionary_from_dimension_rows(spark, changes):
    from rillhouse.sources.tables import dic_from_dim
    cfg = ("base_dic", "dim_base_dic", "dic_code,dic_name", "info", "dic_code")
    feed = changes(("base_dic", "r", 1, None, {"dic_code": "1", "dic_name": "one", "x": "y"}))
    dic = dic_from_dim(routing.dim_sync(feed, config_feed(spark, ("r", 0, None, cfg))))
    assert rows_of(dic, "dic_code", "info.dic_name") == [("1", "one")]
