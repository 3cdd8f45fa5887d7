"""Station dimension helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def availability_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each URL column by whether it is present."""
    return df.select(*[F.col(c).isNotNull().alias(c) if c in columns else F.col(c) for c in df.columns])


def cast_coords(df: DataFrame, columns=("lat", "long")) -> DataFrame:
    """Coordinates to double (text that is no number becomes null)."""
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in columns else F.col(c) for c in df.columns])
