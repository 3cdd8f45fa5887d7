"""Column naming, unpivot and schema conformance."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.constants import (
    GROUP_HYDROMETRIC,
    GROUP_PRESSURE,
    GROUP_TEMPERATURE,
    HOURLY_COLUMNS,
    NO_COMMENT,
    PAGE_COLUMNS,
)
from gaugeflow.schemas import HOURLY


def _names(group: str, width: int) -> Column:
    return F.array(*[F.lit(n) for n in PAGE_COLUMNS[(group, width)][1:]])


def canonical_columns(group, width) -> Column:
    """Data-column names (Time excluded) of a page, by group and width.

    Hydrometric: 3 -> Water Level, Sensor Depth; 2 -> Water Level.
    Pressure: 2 -> Pressure. Any other group: 3 -> Air Temperature, Water
    Temperature; 2 -> Water Temperature. Any other width is null (the page
    is rejected).
    """
    g = F.col(group) if isinstance(group, str) else group
    w = F.col(width) if isinstance(width, str) else width
    return (
        F.when((g == GROUP_HYDROMETRIC) & (w == 3), _names(GROUP_HYDROMETRIC, 3))
        .when((g == GROUP_HYDROMETRIC) & (w == 2), _names(GROUP_HYDROMETRIC, 2))
        .when(g == GROUP_HYDROMETRIC, F.lit(None))
        .when((g == GROUP_PRESSURE) & (w == 2), _names(GROUP_PRESSURE, 2))
        .when(g == GROUP_PRESSURE, F.lit(None))
        .when(w == 3, _names(GROUP_TEMPERATURE, 3))
        .when(w == 2, _names(GROUP_TEMPERATURE, 2))
    )


def expected_width(group, width) -> Column:
    """Number of names the group's naming rule produces for a page width."""
    g = F.col(group) if isinstance(group, str) else group
    w = F.col(width) if isinstance(width, str) else width
    return F.when(g == GROUP_PRESSURE, F.lit(2)).when(w == 3, F.lit(3)).otherwise(F.lit(2))


def to_long(df: DataFrame, ids: list[str], values: list[str],
            name: str = "Parameter", value: str = "Value") -> DataFrame:
    """Wide -> long: one row per id row and value column, nulls kept.

    Equals appending one frame per value column (UNION ALL); the column name
    becomes ``name`` and its content ``value``.
    """
    return df.unpivot(ids, values, name, value)


def with_comments(df: DataFrame) -> DataFrame:
    """Add the always-empty ``Comments`` column."""
    return df.withColumn("Comments", F.lit(NO_COMMENT))


def conform(df: DataFrame, schema: T.StructType = HOURLY) -> DataFrame:
    """Cast every column of ``schema`` to its type (bad values become null)."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def reorder(df: DataFrame, columns: list[str] = HOURLY_COLUMNS) -> DataFrame:
    """Fixed column order."""
    return df.select(*columns)


def snake_names(df: DataFrame) -> DataFrame:
    """Lower-case column names, whitespace -> underscore."""
    return df.toDF(*[re.sub(r"\s", "_", c.lower()) for c in df.columns])


__all__ = [
    "canonical_columns",
    "expected_width",
    "to_long",
    "with_comments",
    "conform",
    "reorder",
    "snake_names",
    "GROUP_TEMPERATURE",
]
