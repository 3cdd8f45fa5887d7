"""Joins against the station dimension.

They carry no broadcast hint: Spark broadcasts a side only when its estimated
size (file statistics) or, with AQE, its measured shuffle size is under the
broadcast thresholds, and otherwise plans a sort-merge join whose skewed
partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.constants import GROUP_VARIABLES


def station_lookup(stations: DataFrame, key: str = "station_url_name", flags: dict[str, str] | None = None) -> DataFrame:
    """One (key, STATION_NAME, STATION_NUMBER) row per key, with a column per
    entry of ``flags`` (name: station flag) that says whether any row of the key
    has that flag.

    A key listed twice keeps the smallest station id (the original takes
    the first file row; a table has no row order, so the choice is made
    deterministic instead).
    """
    first = F.min(F.struct(F.col("station_id"), F.col("station_name"))).alias("s")
    return (
        stations.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(first, *[F.max(F.coalesce(F.col(flag), F.lit(False))).alias(name) for name, flag in (flags or {}).items()])
        .select(key, F.col("s.station_name").alias("STATION_NAME"), F.col("s.station_id").alias("STATION_NUMBER"),
                *(flags or {}))
    )


def attach_station(rows: DataFrame, stations: DataFrame, key: str = "station_url_name") -> DataFrame:
    """Left-join station name and number onto rows by ``key`` (a dimension
    join; see the module note on strategy).

    Rows whose key has no station get null name and number; callers treat
    that as a lookup error of the page.
    """
    return rows.join(station_lookup(stations, key), key, "left")


def wanted_pages(pages: DataFrame, stations: DataFrame) -> DataFrame:
    """Pages of wanted links (the station has the flag of the page's group) with
    station name and number, in one join of the pages with the dimension."""
    flags = {f"_serves_{g}": v for g, v in GROUP_VARIABLES.items()}
    served = F.coalesce(*[F.when(F.col("group") == g, F.col(f"_serves_{g}")) for g in GROUP_VARIABLES], F.lit(False))
    return pages.join(station_lookup(stations, flags=flags), "station_url_name").where(served).drop(*flags)


def attach_coords(stations: DataFrame, coords: DataFrame) -> DataFrame:
    """Left-join (lat, long) by station_id; unmatched stations get nulls."""
    return stations.join(coords, "station_id", "left")


def new_stations(fresh: DataFrame, current: DataFrame | None) -> DataFrame:
    """Station ids in ``fresh`` but not in ``current`` (set difference);
    with no current dimension every station is new."""
    ids = fresh.select("station_id")
    if current is None:
        return ids.distinct()
    return ids.subtract(current.select("station_id"))
