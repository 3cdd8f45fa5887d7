"""Landed data pages -> long hourly rows, with page-level error capture.

Every step runs inside one projection over the page rows: the table is cut
into rows and cells with array functions, the estimated code, numbers and
times are parsed per cell, and the page's first error is found with
``exists``/``filter`` over its own arrays. A page is therefore accepted or
rejected as a whole without grouping rows back together (no shuffle); only
then are accepted pages exploded into rows. The station lookup is a join at
page level against the station dimension (broadcast by Spark when the
dimension's measured size is under the broadcast threshold).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.constants import (
    ERROR_PREFIX,
    HOURLY_COLUMNS,
    HTTP_OK,
    STATUS_LINK_INVALID,
    STATUS_SUCCESS,
)
from gaugeflow.functions.dates import parse_page_time
from gaugeflow.functions.text import estimated_code, numeric_value
from gaugeflow.operators.joins import attach_station, wanted_pages
from gaugeflow.operators.reshape import canonical_columns, expected_width, with_comments
from gaugeflow.sources.html import html_table_rows

PAGE_KEYS = ["group", "station_url_name", "url"]


def _parse_row(names: Column):
    def parse(row: Column) -> Column:
        time_text = F.get(row, 0)
        return F.struct(
            time_text.alias("time_text"),
            parse_page_time(time_text).alias("ts"),
            estimated_code(row).alias("code"),  # a tagged time is no time, its page is rejected
            F.transform(names, lambda _, i: numeric_value(F.get(row, i + 1))).alias("vals"),
        )

    return parse


def parse_pages(pages: DataFrame, stations: DataFrame, wanted_only: bool = False) -> DataFrame:
    """One row per landed page with its parsed rows and its first error
    (``wanted_only``: pages of wanted links only).

    Output: page columns (html dropped) + ``STATION_NAME, STATION_NUMBER,
    names, parsed, error, status``. ``status`` is 'success', 'Error: link
    invalid' (HTTP status other than 200) or 'Error: <first error>'. Pages with
    a true column ``seen``, if there is one, were accepted by an earlier run:
    they are not parsed again and count as a success without rows.
    """
    seen = F.col("seen") if "seen" in pages.columns else F.lit(False)
    keep = [c for c in pages.columns if c != "html"]
    p = wanted_pages(pages, stations) if wanted_only else attach_station(pages, stations)
    table = html_table_rows(F.when(~seen, F.col("html")))
    p = p.select(*keep, "STATION_NAME", "STATION_NUMBER", table.alias("_t"))
    names = canonical_columns(F.col("group"), F.col("_t.width"))
    p = p.select(
        *keep,
        "STATION_NAME",
        "STATION_NUMBER",
        F.col("_t.width").alias("width"),
        names.alias("names"),
        F.transform(F.col("_t.rows"), _parse_row(F.coalesce(names, F.array().cast("array<string>")))).alias("parsed"),
    )
    # Columns are converted one after the other, so the first bad cell is
    # searched column by column (all rows of column 1 before column 2).
    value_errors = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(F.coalesce(F.col("names"), F.array())), F.lit(1))),
            lambda j: F.filter(
                F.transform(F.col("parsed"), lambda r: F.try_element_at(r["vals"], j)["error"]),
                lambda e: e.isNotNull(),
            ),
        )
    )
    bad_time = F.filter(F.col("parsed"), lambda r: r["ts"].isNull())
    error = F.coalesce(
        F.when(F.col("width") == 0, F.lit("No tables found")),
        F.when(
            F.col("names").isNull(),
            F.concat(
                F.lit("Length mismatch: Expected axis has "),
                F.col("width").cast("string"),
                F.lit(" elements, new values have "),
                expected_width(F.col("group"), F.col("width")).cast("string"),
                F.lit(" elements"),
            ),
        ),
        F.try_element_at(value_errors, F.lit(1)),
        F.when(
            F.size(bad_time) > 0,
            F.concat(F.lit("Unknown datetime string format, unable to parse: "),
                     F.coalesce(F.try_element_at(bad_time, F.lit(1))["time_text"], F.lit("None"))),
        ),
        F.when(F.col("STATION_NUMBER").isNull(), F.lit("single positional indexer is out-of-bounds")),
    )
    fetched = F.coalesce(F.col("http_status") == HTTP_OK, F.lit(False))
    status = (
        F.when(seen, F.lit(STATUS_SUCCESS))
        .when(~fetched, F.lit(STATUS_LINK_INVALID))
        .when(F.col("error").isNotNull(), F.concat(F.lit(ERROR_PREFIX), F.col("error")))
        .otherwise(F.lit(STATUS_SUCCESS))
    )
    return p.withColumn("error", F.when(fetched & ~seen, error)).withColumn("status", status)


def page_rows(parsed: DataFrame) -> DataFrame:
    """Long hourly rows of the accepted pages of ``parse_pages`` output.

    Each table row gives one row per data column (Parameter = column name,
    Value = parsed number, null cells kept); the row's estimated code is
    shared by all its streams.
    """
    accepted = F.when(F.col("status") == STATUS_SUCCESS, F.col("parsed")).otherwise(F.array())
    rows = parsed.select("STATION_NUMBER", "STATION_NAME", "names", F.explode(accepted).alias("r"))
    streams = rows.select(
        "STATION_NUMBER",
        "STATION_NAME",
        F.col("r.ts").alias("ts"),
        F.col("r.code").alias("Code"),
        F.explode(F.arrays_zip(F.col("names").alias("p"), F.col("r.vals").alias("v"))).alias("s"),
    )
    values = streams.select(
        "STATION_NUMBER",
        "STATION_NAME",
        F.to_date("ts").alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("Time"),
        F.col("s.v.value").alias("Value"),
        F.col("s.p").alias("Parameter"),
        "Code",
    )
    return with_comments(values).select(*HOURLY_COLUMNS)


def page_status(parsed: DataFrame) -> DataFrame:
    """(group, station_url_name, url, status, n_rows) per landed page."""
    n = F.when(F.col("status") == STATUS_SUCCESS, F.aggregate(F.coalesce("parsed", F.array()), F.lit(0), lambda acc, r: acc + F.size(r["vals"]))).otherwise(F.lit(0))
    return parsed.select("group", "station_url_name", "url", "status", n.cast("long").alias("n_rows"))


@dataclass
class Normalized:
    parsed: DataFrame
    rows: DataFrame
    status: DataFrame


def normalize_pages(pages: DataFrame, stations: DataFrame, wanted_only: bool = False,
                    stage: Callable[[DataFrame], DataFrame] | None = None) -> Normalized:
    """Parse landed pages into hourly rows plus a per-page status frame.

    ``parsed`` is what both are derived from; a job that uses both gives
    ``stage`` (``sinks.tables.Staging``), so that pages are parsed once.
    """
    parsed = parse_pages(pages, stations, wanted_only)
    if stage is not None:
        parsed = stage(parsed)
    return Normalized(parsed=parsed, rows=page_rows(parsed), status=page_status(parsed))
