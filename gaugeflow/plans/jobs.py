"""Runnable jobs over a warehouse folder: update, reset, refresh, marts.

Each job reads its inputs, computes one plan and writes its outputs. Reads
of a table that the same job rewrites go through a staged copy in the
shared checkpoint folder (``spark.checkpoint.dir``). Every job first completes
the folder swaps that a failed one left.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.constants import HOURLY_COLUMNS, LOOKBACK_DAYS, RECENT_DAYS
from gaugeflow.operators.aggregate import distinct_parameters, has_new
from gaugeflow.operators.filters import select_station, window_start
from gaugeflow.operators.joins import new_stations
from gaugeflow.operators.links import all_links, fetch_manifest
from gaugeflow.plans.marts import build_marts, touched_daily
from gaugeflow.plans.reset import reset_stations
from gaugeflow.plans.stations import refresh_stations
from gaugeflow.plans.update import update_hourly
from gaugeflow.operators.replace import replace_rows
from gaugeflow.sinks.swap import commit_swap, file_system, finish_swaps, new_swap
from gaugeflow.sinks.tables import (
    Staging,
    append_recorded,
    clear_pending,
    drop_months_before,
    folder_ids,
    folders_holding,
    forget_pages,
    in_folders,
    index_entries,
    mark_pending,
    note_entries,
    overwrite_partitions,
    pending_folders,
    refresh_index,
    replace_partitioned,
    replace_table,
    reset_tables,
    table_buckets,
    with_partitions,
    write_report,
    write_station_csv,
)
from gaugeflow.sources.tables import Warehouse, read_consumed, read_hourly, read_station_metadata


def run_update(spark: SparkSession, wh: Warehouse, pages: DataFrame, as_of, days: int = LOOKBACK_DAYS,
               base_url: str = "", recent_days: int = RECENT_DAYS, mover: Callable | None = None) -> DataFrame:
    """C2 + K1 + K7, then the changed parts of the daily and recent marts.

    Accepted pages are recorded together with their rows, so a run that is
    repeated, after a failure at any point or without one, adds nothing.
    ``mover``: how files are moved (:func:`gaugeflow.sinks.swap.move`)."""
    finish_swaps(spark, *wh.tables)
    stations = read_station_metadata(spark, wh.station_metadata)
    stored = read_hourly(spark, wh.hourly, as_of, days)
    with Staging(spark) as stage:
        result = update_hourly(pages, stations, stored, as_of, days, base_url, stage=stage,
                               consumed=read_consumed(spark, wh.consumed, pages))
        # Cut the new rows' lineage: they are compared with the table they are appended to.
        new = result.new_rows.checkpoint()
        if has_new(new) or has_new(result.accepted):
            mark_pending(spark, wh, folder_ids(with_partitions(new, table_buckets(spark, wh.hourly))))
            append_recorded(new, result.accepted, wh, mover)
        write_report(result.status, wh.report, dt.datetime.now().isoformat(), "update")
    refresh_marts(spark, wh, as_of, recent_days)
    return new


def refresh_marts(spark: SparkSession, wh: Warehouse, as_of=None, recent_days: int = RECENT_DAYS) -> None:
    """Refresh the marts for all recorded folders, those of failed runs
    included. Without ``as_of`` the recent mart's folders stay recorded for the
    next run that names one."""
    finish_swaps(spark, *wh.tables)
    refresh_daily(spark, wh, pending_folders(spark, wh, "daily"))
    clear_pending(spark, wh, "daily")
    if as_of is not None:
        refresh_recent(spark, wh, as_of, pending_folders(spark, wh, "recent"), recent_days)
        clear_pending(spark, wh, "recent")


def refresh_daily(spark: SparkSession, wh: Warehouse, folders: list[tuple[str, int]]) -> None:
    """Recompute the daily mart for the given (month, bucket) folders."""
    if not folders:
        return
    hourly = read_hourly(spark, wh.hourly, keep_partitions=True)
    overwrite_partitions(touched_daily(hourly, folders), wh.daily, folders, table_buckets(spark, wh.hourly))


def run_marts(spark: SparkSession, wh: Warehouse, as_of, days: int = RECENT_DAYS) -> None:
    """C5 + K5: rebuild daily and hourly_recent from the whole hourly table
    (the from-scratch path; updates maintain both incrementally)."""
    finish_swaps(spark, *wh.tables)
    hourly = read_hourly(spark, wh.hourly)
    marts = build_marts(hourly, as_of, days)
    buckets = table_buckets(spark, wh.hourly)
    replace_partitioned(marts.daily, wh.daily, buckets)
    clear_pending(spark, wh, "daily")
    replace_partitioned(marts.hourly_recent, wh.hourly_recent, buckets)
    clear_pending(spark, wh, "recent")


def refresh_recent(spark: SparkSession, wh: Warehouse, as_of, folders: list[tuple[str, int]],
                   days: int = RECENT_DAYS) -> None:
    """Keep hourly_recent equal to ``Date >= as_of - days`` of hourly.

    Only folders that change are written: the given ones inside the
    window and the window's first month (whose older days fall out); months
    entirely before the window are dropped. Assumes the table was consistent
    after the previous run (``run_marts`` builds it from scratch).
    """
    start = window_start(as_of, days)
    first = start.strftime("%Y-%m")
    touched = [f for f in folders if f[0] >= first]
    buckets = table_buckets(spark, wh.hourly)
    boundary = [(first, b) for b in range(buckets)]
    folders = sorted(set(touched) | set(boundary))
    hourly = read_hourly(spark, wh.hourly, keep_partitions=True)
    rows = hourly.where(in_folders(folders) & (F.col("Date") >= F.lit(start))).drop("month", "sbucket")
    overwrite_partitions(rows, wh.hourly_recent, folders, buckets)
    drop_months_before(spark, wh.hourly_recent, first)


def run_reset(spark: SparkSession, wh: Warehouse, pages: DataFrame, base_url: str = "", as_of=None,
              station: str | None = None, regex: bool = False, recent_days: int = RECENT_DAYS,
              mover: Callable | None = None, marts: bool = True) -> DataFrame:
    """C3 + K4: replace station archives, rewriting only touched folders, and
    refresh their marts. ``station`` limits the job to one id (with ``regex``
    to ids that match at their start). Returns the replaced (station,
    parameter) pairs' rows as stored. ``mover``: how folders are moved
    (:func:`gaugeflow.sinks.swap.move`). ``marts`` False leaves the folders
    recorded for a caller that builds the marts itself."""
    finish_swaps(spark, *wh.tables)
    stations = read_station_metadata(spark, wh.station_metadata)
    if station is not None:
        stations = select_station(stations, station, regex)
        pages = pages.join(stations.select("station_url_name").distinct(), "station_url_name", "left_semi")
    current = read_hourly(spark, wh.hourly, keep_partitions=True)
    buckets = table_buckets(spark, wh.hourly)
    with Staging(spark) as stage:
        result = reset_stations(pages, stations, current.drop("month", "sbucket"), base_url, stage=stage)
        new = result.new_rows
        # one pass over the parsed rows: their (station, parameter, month), bounded by the folders they fill
        entries = stage(index_entries(with_partitions(new, buckets)))
        keys = distinct_parameters(entries).checkpoint()  # bounded by the dimension
        new_folders = folder_ids(entries)
        # with the folders that hold rows of a replaced (station, parameter)
        folders = sorted(set(new_folders) | set(folder_ids(folders_holding(spark, wh.hourly, keys))))
        scoped = current.where(in_folders(folders)).drop("month", "sbucket")
        mark_pending(spark, wh, folders)
        forget_pages(spark, wh, pages.select("station_url_name").distinct())
        note_entries(entries, wh.hourly)
        overwrite_partitions(replace_rows(scoped, new, keys), wh.hourly, folders, buckets, mover=mover)
        refresh_index(spark, wh.hourly, folders)
        write_report(result.status, wh.report, dt.datetime.now().isoformat(), "reset")
    if marts:
        refresh_marts(spark, wh, as_of, recent_days)
    return (read_hourly(spark, wh.hourly, keep_partitions=True).where(in_folders(folders))
            .join(keys, ["STATION_NUMBER", "Parameter"], "left_semi").select(*HOURLY_COLUMNS))


def run_refresh(spark: SparkSession, wh: Warehouse, nav_pages: DataFrame, series_ranges: DataFrame,
                base_url: str = "") -> DataFrame:
    """C4 + K2 + K6: rebuild the station dimension; returns the new ids."""
    finish_swaps(spark, *wh.tables)
    current = read_station_metadata(spark, wh.station_metadata)
    result = refresh_stations(nav_pages, series_ranges, current, base_url)
    stations = result.stations.checkpoint()
    # from the stored copy: the pages are parsed once
    new_ids = new_stations(stations, current).join(stations.select("station_id"), "station_id").checkpoint()
    replace_table(stations, wh.station_metadata)
    write_station_csv(stations, wh.station_csv)
    return new_ids


def refresh_and_backfill(spark: SparkSession, wh: Warehouse, nav_pages: DataFrame, series_ranges: DataFrame,
                         archive_pages: DataFrame, base_url: str = "") -> DataFrame:
    """Station refresh as run before every update: rebuild the dimension,
    then load the whole archive of the stations that are new (only their
    landed archive pages are parsed). Returns the new station ids."""
    new_ids = run_refresh(spark, wh, nav_pages, series_ranges, base_url)
    stations = read_station_metadata(spark, wh.station_metadata)
    new_names = stations.join(new_ids, "station_id", "left_semi").select("station_url_name")
    pages = archive_pages.join(new_names, "station_url_name", "left_semi")
    run_reset(spark, wh, pages, base_url)
    return new_ids


def run_chain(spark: SparkSession, wh: Warehouse, nav_pages: DataFrame, series_ranges: DataFrame,
              archive_pages: DataFrame, pages: DataFrame, as_of, days: int = LOOKBACK_DAYS, base_url: str = "") -> DataFrame:
    """The regular run: station refresh with backfill, update, marts (the
    backfill's folders are refreshed with the update's)."""
    refresh_and_backfill(spark, wh, nav_pages, series_ranges, archive_pages, base_url)
    return run_update(spark, wh, pages, as_of, days, base_url)


def run_manifest(spark: SparkSession, wh: Warehouse, path: str, as_of, days: int = LOOKBACK_DAYS, base_url: str = "") -> None:
    """Write the links and start texts an outside fetcher is to ask for."""
    links = all_links(read_station_metadata(spark, wh.station_metadata), base_url)
    fetch_manifest(links, as_of, days).write.mode("overwrite").json(path)


def full_reset(spark: SparkSession, wh: Warehouse, nav_pages: DataFrame, series_ranges: DataFrame,
               archive_pages: DataFrame, as_of, base_url: str = "", buckets: int | None = None,
               mover: Callable | None = None) -> None:
    """All tables built anew (with ``buckets`` station buckets, by default as
    many as before): stations, every archive, marts.

    They are built in a second root beside the live one, which stays as it is
    until all of them are whole; then one journalled swap replaces every table,
    the bucket markers and the report."""
    finish_swaps(spark, *wh.tables)
    swap = new_swap(wh.root)
    beside = Warehouse(f"{swap}/new")
    reset_tables(spark, beside, buckets or table_buckets(spark, wh.hourly))
    run_refresh(spark, beside, nav_pages, series_ranges, base_url)
    run_reset(spark, beside, archive_pages, base_url, marts=False)
    run_marts(spark, beside, as_of)
    fs, hadoop = file_system(spark, wh.root)

    def names(root: str) -> set[str]:
        if not fs.exists(hadoop(root)):
            return set()
        return {s.getPath().getName() for s in fs.listStatus(hadoop(root))}

    new = {n for n in names(beside.root) if not n.startswith(".")}  # no checksum files: they move with theirs
    tables = {wh.hourly, wh.daily, wh.hourly_recent}
    stale = {n for n in names(wh.root) if n in ("pending", "consumed") or any(n.startswith(f"{t.rsplit('/', 1)[1]}.buckets-") for t in tables)}
    commit_swap(spark, swap, wh.root, {n: False for n in stale - new} | {n: True for n in new}, mover)


__all__ = ["run_update", "run_marts", "run_reset", "run_refresh", "run_chain", "run_manifest", "refresh_and_backfill", "full_reset",
           "refresh_daily", "refresh_recent", "refresh_marts", "window_start"]
