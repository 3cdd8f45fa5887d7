"""Incremental update: landed pages -> new hourly rows + link status."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.constants import LOOKBACK_DAYS, STATUS_LINK_INVALID, STATUS_SUCCESS
from gaugeflow.operators.dedup import new_rows as anti_new_rows
from gaugeflow.operators.filters import lookback
from gaugeflow.operators.links import all_links
from gaugeflow.plans.normalize import normalize_pages
from gaugeflow.schemas import CONSUMED
from gaugeflow.sources.tables import landed_month, month_key, page_digest


@dataclass
class UpdateResult:
    new_rows: DataFrame
    status: DataFrame
    page_status: DataFrame
    accepted: DataFrame | None = None


def mark_seen(pages: DataFrame, consumed: DataFrame) -> DataFrame:
    """Pages with their ``digest``, ``landed`` month and whether an earlier run consumed
    them (``seen``); ``consumed`` holds distinct digests."""
    pages = pages.withColumn("digest", page_digest()).withColumn("landed", landed_month())
    known = consumed.select("digest", F.lit(True).alias("_known"))
    return pages.join(known, "digest", "left").withColumn("seen", F.col("_known").isNotNull()).drop("_known")


def link_errors(page_status: DataFrame) -> DataFrame:
    """(group, station_url_name, error) per link with landed pages: the greatest
    error text, null when every page was accepted. Rows of several parts of the
    pages can be merged by the same maximum, in any order and repeatedly."""
    return page_status.groupBy("group", "station_url_name").agg(
        F.max(F.when(F.col("status") != STATUS_SUCCESS, F.col("status"))).alias("error"))


def outcome_of_errors(links: DataFrame, errors: DataFrame) -> DataFrame:
    """(group, station_url_name, status) per link from ``link_errors``; a link
    with no landed page is invalid."""
    joined = links.join(errors.withColumn("_seen", F.lit(True)), ["group", "station_url_name"], "left")
    status = (
        F.when(F.col("_seen").isNull(), F.lit(STATUS_LINK_INVALID))
        .when(F.col("error").isNotNull(), F.col("error"))
        .otherwise(F.lit(STATUS_SUCCESS))
    )
    return joined.select("group", "station_url_name", status.alias("status"))


def link_outcome(links: DataFrame, page_status: DataFrame) -> DataFrame:
    """(group, station_url_name, status) per link: 'success' when every
    landed page of the link was accepted, else the greatest error text; a
    link with no landed page is invalid."""
    return outcome_of_errors(links, link_errors(page_status))


def update_hourly(pages: DataFrame, stations: DataFrame, stored: DataFrame, as_of,
                  days: int | None = LOOKBACK_DAYS, base_url: str = "", how: str = "auto",
                  stage: Callable[[DataFrame], DataFrame] | None = None,
                  consumed: DataFrame | None = None) -> UpdateResult:
    """One update run.

    Only pages of wanted links (station has the group's data flag) are
    parsed; rows already stored within ``days`` before ``as_of`` are removed
    with the full-row null-safe anti-join. Rows older than the lookback are
    not compared, exactly like the original overlap check. With ``days`` None
    rows are compared with all stored rows of their months (``stored`` then
    has its ``month`` column), so replayed pages add nothing whatever their age.
    ``stage`` holds the parsed pages once for rows and status (jobs give it).
    ``consumed`` (digest) are pages that earlier runs have appended: they
    succeed and add nothing, also where their rows are older than the lookback;
    ``accepted`` of the result are then the pages to record (``CONSUMED``).
    """
    links = all_links(stations, base_url)
    if consumed is not None:
        pages = mark_seen(pages, consumed)
    norm = normalize_pages(pages, stations, wanted_only=True, stage=stage)
    if days is None:
        months = norm.rows.select(month_key().alias("month")).distinct()
        current = stored.join(months, "month", "left_semi")
    else:
        current = lookback(stored, as_of, days)
    fresh = anti_new_rows(norm.rows, current, how=how)
    return UpdateResult(
        new_rows=fresh,
        status=link_outcome(links, norm.status),
        page_status=norm.status,
        accepted=None if consumed is None else norm.parsed.where((F.col("status") == STATUS_SUCCESS) & ~F.col("seen"))
        .select(*CONSUMED.names).distinct(),
    )
