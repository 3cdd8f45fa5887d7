"""Whole-archive replacement of stations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from gaugeflow.operators.links import all_links
from gaugeflow.operators.replace import replace_rows
from gaugeflow.plans.normalize import normalize_pages
from gaugeflow.plans.update import link_outcome


@dataclass
class ResetResult:
    hourly: DataFrame
    new_rows: DataFrame
    status: DataFrame


def reset_stations(pages: DataFrame, stations: DataFrame, current: DataFrame, base_url: str = "",
                   stage: Callable[[DataFrame], DataFrame] | None = None) -> ResetResult:
    """Replace the archives of every station that has landed archive
    pages, in one job.

    Accepted pages give the new rows; for each (station, parameter) they
    hold, the stored rows are dropped and the new ones appended. A rejected
    page deletes nothing. ``stage`` holds the parsed pages once for rows and
    status (jobs give it).
    """
    norm = normalize_pages(pages, stations, wanted_only=True, stage=stage)
    return ResetResult(
        hourly=replace_rows(current, norm.rows),
        new_rows=norm.rows,
        status=link_outcome(all_links(stations, base_url), norm.status),
    )
