"""Aggregations: the daily mart, parameter sets, link validity, pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.constants import DAILY_COLUMNS, NAV_LABELS

DAILY_KEYS = ["STATION_NUMBER", "Date", "Parameter"]


def daily(hourly: DataFrame) -> DataFrame:
    """Daily mean per station, date and parameter.

    ``STATION_NAME`` is the greatest name of the group, ``Value`` the mean
    of the non-null values (NaN propagates), ``numObservations`` the count
    of non-null dates (so rows with a null value count but are not
    averaged). One aggregation; ``max`` of a string makes Spark sort.
    """
    return (
        hourly.groupBy(*DAILY_KEYS)
        .agg(
            F.max("STATION_NAME").alias("STATION_NAME"),
            F.avg("Value").alias("Value"),
            F.count("Date").alias("numObservations"),
        )
        .select(*DAILY_COLUMNS)
    )


def daily_two_level(hourly: DataFrame) -> DataFrame:
    """Same result as ``daily``, planned for large inputs.

    Level 1 groups by the keys plus the name with numeric buffers only
    (hash aggregation, partial aggregation before the shuffle); level 2
    folds the few names per key. Only level-1 output is shuffled twice.
    """
    level1 = hourly.groupBy(*DAILY_KEYS, "STATION_NAME").agg(
        F.sum("Value").alias("_s"),
        F.count("Value").alias("_nv"),
        F.count("Date").alias("_nd"),
    )
    return (
        level1.groupBy(*DAILY_KEYS)
        .agg(
            F.max("STATION_NAME").alias("STATION_NAME"),
            (F.sum("_s") / F.nullif(F.sum("_nv"), F.lit(0))).alias("Value"),
            F.sum("_nd").alias("numObservations"),
        )
        .select(*DAILY_COLUMNS)
    )


DAILY_SQL = """
SELECT STATION_NUMBER, max(STATION_NAME) AS STATION_NAME, `Date`, avg(`Value`) AS `Value`,
       count(`Date`) AS numObservations, Parameter
FROM {view}
GROUP BY STATION_NUMBER, `Date`, Parameter
"""


def daily_sql(hourly: DataFrame, view: str = "hourly_rows") -> DataFrame:
    """``daily`` written as the mart's SQL text over a temporary view of
    ``hourly`` (same logical plan as the DataFrame form)."""
    hourly.createOrReplaceTempView(view)
    return hourly.sparkSession.sql(DAILY_SQL.format(view=view))


def distinct_parameters(rows: DataFrame) -> DataFrame:
    """Distinct (STATION_NUMBER, Parameter) pairs of new archive rows."""
    return rows.select("STATION_NUMBER", "Parameter").distinct()


def pivot_params(links: DataFrame, key: str = "station_name", label: str = "label",
                 url: str = "url", order: str = "pos", labels: list[str] = NAV_LABELS) -> DataFrame:
    """One row per station, one URL column per label; a label given twice
    keeps the URL of the later link (greatest ``order``)."""
    return links.groupBy(key).pivot(label, labels).agg(F.max_by(url, order))


def has_new(df: DataFrame) -> bool:
    """True when ``df`` holds at least one row."""
    return not df.isEmpty()
