"""Nested records that are either maps or structs, and their JSON text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text_map(df: DataFrame, name: str) -> Column:
    """Column ``name`` as map<string,string>, without null values."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.MapType):
        return F.map_filter(F.col(name), lambda k, v: v.isNotNull())
    pairs = [p for f in kind.fieldNames() for p in (F.lit(f), F.col(name)[f].cast("string"))]
    entries = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return F.when(F.col(name).isNotNull(), entries)


def put_field(df: DataFrame, name: str, field: str, value: Column) -> Column:
    """Column ``name`` with one field replaced."""
    if isinstance(df.schema[name].dataType, T.StructType):
        return F.col(name).withField(field, value)
    others = F.map_filter(F.col(name), lambda k, v: k != field)
    return F.map_concat(others, F.create_map(F.lit(field), value))


def merge_maps(base: Column, over: Column) -> Column:
    """All entries of both maps; on equal keys ``over`` wins."""
    kept = F.map_filter(base, lambda k, v: v.isNotNull() & ~F.map_contains_key(over, k))
    return F.map_concat(kept, over)


def map_json(entries: Column, **numbers: Column) -> Column:
    """JSON text of a non-empty text map, with further numeric fields at its end."""
    text = F.to_json(entries)
    if not numbers:
        return text
    tail = [part for name, value in numbers.items()
            for part in (F.lit(f',"{name}":'), F.coalesce(value.cast("string"), F.lit("null")))]
    # A text map's JSON ends in a quote and one brace, so trimming braces removes just that one.
    return F.concat(F.rtrim(text, F.lit("}")), *tail, F.lit("}"))


def unquoted_numbers(json: Column, names: tuple[str, ...]) -> Column:
    """JSON text in which the named fields, at any depth, are numbers where their texts are.

    A name counts only right after a brace or comma and outside of texts: within a text its quotes are escaped. Texts that are no number
    of JSON, as ``007`` or ``+1``, stay texts.
    """
    if not names:
        return json
    listed = "|".join(re.escape(n) for n in names)
    number = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
    return F.regexp_replace(json, rf'([{{,]"(?:{listed})":)"({number})"(?=[,}}])', "$1$2")


def pack_texts(*names: str) -> Column:
    """Text columns as one text, which takes far less room in a shuffle or sort than a column each."""
    return F.to_json(F.array(*names))


def unpack_texts(df: DataFrame, packed: str, names: tuple[str, ...]) -> DataFrame:
    """The inverse: column ``packed`` replaced by the text columns it was made of, parsed once for a row."""
    others = [c for c in df.columns if c != packed]
    parsed = df.select(*others, F.from_json(packed, T.ArrayType(T.StringType())).alias(packed))
    return parsed.select(*others, *[F.col(packed)[i].alias(n) for i, n in enumerate(names)])


def pick_columns(entries: Column, csv: Column, keep: tuple[str, ...] = ()) -> Column:
    """Only the entries whose keys a comma-separated list names."""
    wanted = F.split(csv, ",")
    if keep:
        wanted = F.array_union(wanted, F.array(*[F.lit(k) for k in keep]))
    return F.map_filter(entries, lambda k, v: F.array_contains(wanted, k))


def row_map(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Whole row as map<string,string>, nulls included, as change feeds carry it."""
    names = columns or df.columns
    pairs = [p for c in names for p in (F.lit(c), F.col(c).cast("string"))]
    return F.create_map(*pairs)
