"""Station data links, fetch manifests and link status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.constants import (
    CONTENT_PATH,
    GROUP_VARIABLES,
    GROUPS,
    RESET_START,
    RESET_START_FORMAT,
    RESET_START_OVERRIDES,
    STATUS_SUCCESS,
    VARIABLE_PAGES,
)
from gaugeflow.functions.dates import picker_text
from gaugeflow.functions.status import link_status as link_status_expr
from gaugeflow.operators.filters import stations_with, window_start


def station_url(base_url: str, name, page: str):
    """``base + Content%20Pages/ + name + / + page + .aspx``."""
    name = F.col(name) if isinstance(name, str) else name
    return F.concat(F.lit(base_url + CONTENT_PATH), name, F.lit("/" + page + ".aspx"))


def urls_by_variable(stations: DataFrame, var: str, base_url: str) -> DataFrame:
    """(station_url_name, url) of every station with data of ``var``; one
    row per url name."""
    page = VARIABLE_PAGES.get(var)
    chosen = stations_with(stations, var)
    return (
        chosen.select("station_url_name", station_url(base_url, "station_url_name", page).alias("url"))
        .where(F.col("station_url_name").isNotNull())
        .dropDuplicates(["station_url_name"])
    )


def all_links(stations: DataFrame, base_url: str) -> DataFrame:
    """(group, station_url_name, url) of the three page groups.

    The three flags are unpivoted in one pass over the stations; the group
    and page name come from a literal mapping expression.
    """
    flags = [GROUP_VARIABLES[g] for g in GROUPS]
    long = stations.select("station_url_name", *flags).unpivot(["station_url_name"], flags, "var", "on")
    group = F.create_map(*[x for g in GROUPS for x in (F.lit(GROUP_VARIABLES[g]), F.lit(g))])[F.col("var")]
    page = F.create_map(*[x for v, p in VARIABLE_PAGES.items() for x in (F.lit(v), F.lit(p))])[F.col("var")]
    url = F.concat(F.lit(base_url + CONTENT_PATH), F.col("station_url_name"), F.lit("/"), page, F.lit(".aspx"))
    return (
        long.where(F.coalesce(F.col("on"), F.lit(False)) & F.col("station_url_name").isNotNull())
        .select(group.alias("group"), "station_url_name", url.alias("url"))
        .dropDuplicates(["group", "station_url_name"])
    )


def fetch_manifest(links: DataFrame, as_of, days: int) -> DataFrame:
    """Links with the picker start text of an N-day fetch."""
    return links.withColumn("start_text", picker_text(F.lit(window_start(as_of, days))))


def reset_start_text(station_url_name: str | None = None) -> str:
    """Picker text of a whole-archive fetch (one station has its own start)."""
    raw = RESET_START_OVERRIDES.get(station_url_name or "", RESET_START)
    return dt.datetime.strptime(raw, RESET_START_FORMAT).strftime("%b %d, %Y %H:%M")


def reset_manifest(links: DataFrame) -> DataFrame:
    """Links with the picker start text of a whole-archive fetch."""
    start = F.lit(reset_start_text())
    for name in RESET_START_OVERRIDES:
        start = F.when(F.col("station_url_name") == name, F.lit(reset_start_text(name))).otherwise(start)
    return links.withColumn("start_text", start)


def link_codes(pages: DataFrame) -> DataFrame:
    """(group, station_url_name, http_status) of landed pages."""
    return pages.select("group", "station_url_name", "http_status")


def link_status(codes: DataFrame) -> DataFrame:
    """Replace ``http_status`` by ``status``: 'success' for 200 else
    'Error: link invalid'. Other columns pass through."""
    keep = [c for c in codes.columns if c != "http_status"]
    return codes.select(*keep, link_status_expr("http_status").alias("status"))


def valid_links(links: DataFrame, status: DataFrame) -> DataFrame:
    """Links whose status is 'success'."""
    ok = status.where(F.col("status") == STATUS_SUCCESS).select("group", "station_url_name")
    return links.join(ok, ["group", "station_url_name"], "left_semi")


def all_valid(status: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """(group, all_valid) for the three groups; a group with no links is
    all-valid (``all`` of nothing is true)."""
    spark = spark or status.sparkSession
    groups = spark.createDataFrame([(g,) for g in GROUPS], "group string")
    per_group = status.where(F.col("group").isin(*GROUPS)).groupBy("group").agg(F.every(F.col("status") == STATUS_SUCCESS).alias("_ok"))
    # one row for each of the three groups, whatever texts the input holds
    return groups.join(F.broadcast(per_group), "group", "left").select(
        "group", F.coalesce(F.col("_ok"), F.lit(True)).alias("all_valid")
    )


def combine_status(*frames: tuple[str, DataFrame]) -> DataFrame:
    """Union per-group status frames, tagging each with its group."""
    out = None
    for group, frame in frames:
        tagged = frame.select(F.lit(group).alias("group"), "station_url_name", "status")
        out = tagged if out is None else out.unionByName(tagged)
    return out
