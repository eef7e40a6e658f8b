"""Column names in snake_case and camelCase."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def to_camel(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)


def to_snake(name: str) -> str:
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[to_camel(c) for c in df.columns])


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[to_snake(c) for c in df.columns])
