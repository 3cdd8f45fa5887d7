"""Station dimension refresh from landed sidebar and home pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.constants import ADMIN_TITLE, NAV_LABELS, SERVED_LABELS, STATION_COLUMNS
from gaugeflow.functions.dates import parse_site_date
from gaugeflow.functions.ids import coord_station_id, station_id, url_name
from gaugeflow.operators.aggregate import pivot_params
from gaugeflow.operators.filters import drop_unserved, relevant_params
from gaugeflow.operators.joins import attach_coords, new_stations
from gaugeflow.operators.reshape import reorder, snake_names
from gaugeflow.operators.stations import availability_flags, cast_coords
from gaugeflow.sources.html import LOCATIONS_MARK, js_locations, parse_locations, station_links


def station_urls(nav_pages: DataFrame, base_url: str, drop: bool = True) -> DataFrame:
    """One row per sidebar station with a URL column per known label
    (snake-case names). A label given twice keeps the later link. With
    ``drop`` stations lacking all three data URLs are removed."""
    links = station_links(nav_pages, keep=["page_id"])
    links = links.where(F.col("title").isNotNull() & (F.col("title") != ADMIN_TITLE))
    links = relevant_params(links, base_url)
    links = links.select(
        F.col("title").alias("station_name"), "label", "url", F.struct("page_id", "section_pos", "link_pos").alias("pos")
    )
    wide = pivot_params(links, key="station_name", labels=NAV_LABELS)
    if drop:
        wide = drop_unserved(wide, SERVED_LABELS)
    return snake_names(wide)


def coordinates(nav_pages: DataFrame) -> DataFrame:
    """(station_id, lat, long) from the pages' locations scripts; an id
    listed more than once keeps its last entry."""
    entries = nav_pages.where(F.instr("html", LOCATIONS_MARK) > 0).select(
        "page_id", F.posexplode(parse_locations(js_locations(F.col("html")))).alias("pos", "e")
    )
    coords = cast_coords(
        entries.select(
            coord_station_id(F.col("e.name")).alias("station_id"),
            F.col("e.lat").alias("lat"),
            F.col("e.long").alias("long"),
            F.struct("page_id", "pos").alias("order"),
        )
    )
    last = coords.groupBy("station_id").agg(F.max_by(F.struct("lat", "long"), "order").alias("c"))
    return last.select("station_id", F.col("c.lat").alias("lat"), F.col("c.long").alias("long"))


def station_table(wide: DataFrame, ranges: DataFrame, coords: DataFrame) -> DataFrame:
    """Dimension rows (STATION_COLUMNS) from the wide URL table."""
    st = wide.select(
        station_id(F.col("station_name")).alias("station_id"),
        "station_name",
        url_name(F.col("site_info")).alias("station_url_name"),
        "water_temperature",
        "staff_gauge",
        "voltage",
        "barometric_pressure",
        "site_info",
    )
    dates = ranges.select(
        "station_url_name",
        parse_site_date(F.col("start_text")).alias("start_date"),
        parse_site_date(F.col("end_text")).alias("end_date"),
    )
    st = st.join(dates, "station_url_name", "left")
    st = attach_coords(st, coords)
    st = availability_flags(st, ["water_temperature", "staff_gauge", "voltage", "barometric_pressure"])
    return reorder(st, STATION_COLUMNS)


@dataclass
class Refreshed:
    stations: DataFrame
    new_ids: DataFrame


def refresh_stations(nav_pages: DataFrame, series_ranges: DataFrame, current: DataFrame | None,
                     base_url: str) -> Refreshed:
    """Rebuild the station dimension and list the stations that are new
    relative to ``current`` (all of them when there is none)."""
    wide = station_urls(nav_pages, base_url, drop=True)
    stations = station_table(wide, series_ranges, coordinates(nav_pages))
    return Refreshed(stations=stations, new_ids=new_stations(stations, current))
