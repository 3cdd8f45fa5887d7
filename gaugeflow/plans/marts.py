"""Daily and recent marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from gaugeflow.constants import RECENT_DAYS
from gaugeflow.operators.aggregate import daily_two_level
from gaugeflow.operators.filters import recent


@dataclass
class Marts:
    daily: DataFrame
    hourly_recent: DataFrame


def build_marts(hourly: DataFrame, as_of, days: int = RECENT_DAYS) -> Marts:
    """The daily means and the last-366-days table from ``hourly``."""
    return Marts(daily=daily_two_level(hourly), hourly_recent=recent(hourly, as_of, days))


def touched_daily(stored: DataFrame, folders: list[tuple[str, int]]) -> DataFrame:
    """Daily rows of the given (month, station bucket) folders, recomputed
    from the stored hourly table (read with its partition columns).

    The folder ids become a partition filter, so only those folders are
    listed and scanned instead of the whole history. Every key of the daily
    table lives in exactly one hourly folder, so the result replaces those
    daily folders exactly.
    """
    from gaugeflow.sinks.tables import in_folders

    scoped = stored.where(in_folders(folders)).drop("month", "sbucket")
    return daily_two_level(scoped)
