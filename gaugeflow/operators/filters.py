"""Row filters: time windows, station selection, availability."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.constants import (
    LOOKBACK_DAYS,
    NAV_LABELS,
    RECENT_DAYS,
    SERVED_LABELS,
    VARIABLE_ERROR,
    VARIABLES,
)


def _as_date(as_of) -> dt.date:
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    if isinstance(as_of, dt.date):
        return as_of
    return dt.date.fromisoformat(str(as_of))


def window_start(as_of, days: int) -> dt.date:
    """First date kept by an ``as_of - days`` inclusive window."""
    return _as_date(as_of) - dt.timedelta(days=int(days))


def lookback(hourly: DataFrame, as_of, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Stored rows with ``Date >= as_of - days`` (the overlap check set).

    The bound is a literal date, so the predicate reaches the Parquet scan
    (row-group statistics) and, on the partitioned table, the month
    partitions (see ``sources.tables.read_hourly``).
    """
    return hourly.where(F.col("Date") >= F.lit(window_start(as_of, days)))


def recent(hourly: DataFrame, as_of, days: int = RECENT_DAYS) -> DataFrame:
    """The recent mart: ``Date >= as_of - 366`` days, inclusive."""
    return lookback(hourly, as_of, days)


def select_station(stations: DataFrame, pattern: str, regex: bool = False) -> DataFrame:
    """Stations whose id equals ``pattern``; with ``regex=True`` the id must
    match the regular expression at its start (Python ``str.match``)."""
    if regex:
        return stations.where(F.col("station_id").rlike("^(?:" + pattern + ")"))
    return stations.where(F.col("station_id") == F.lit(pattern))


def stations_with(stations: DataFrame, var: str) -> DataFrame:
    """Stations whose availability flag ``var`` is true."""
    if var not in VARIABLES:
        raise ValueError(VARIABLE_ERROR)
    return stations.where(F.coalesce(F.col(var), F.lit(False)))


def drop_unserved(wide: DataFrame, columns: list[str] = SERVED_LABELS) -> DataFrame:
    """Drop stations where every data URL column is null."""
    return wide.dropna(how="all", subset=columns)


def relevant_params(links: DataFrame, base_url: str, labels: list[str] = NAV_LABELS) -> DataFrame:
    """Keep sidebar links of the five known labels; make their URLs absolute."""
    return links.where(F.col("label").isin(labels)).withColumn("url", F.concat(F.lit(base_url), F.col("href")))
