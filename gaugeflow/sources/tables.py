"""Readers of stored tables and landed inputs (explicit schemas only)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.constants import CSV_NULL, HOURLY_COLUMNS
from gaugeflow.operators.filters import window_start
from gaugeflow.schemas import CONSUMED, DAILY, HOURLY, NAV_PAGES, PAGES, SERIES_RANGES, STATIONS

# Partition columns of the stored hourly and daily tables.
PARTITION_COLUMNS = ["month", "sbucket"]
NO_MONTH = "none"  # the folder of rows without a date
HOURLY_STORED = T.StructType(
    HOURLY.fields + [T.StructField("month", T.StringType()), T.StructField("sbucket", T.IntegerType())]
)
DAILY_STORED = T.StructType(DAILY.fields + [T.StructField("month", T.StringType()), T.StructField("sbucket", T.IntegerType())])


def month_key(date: str = "Date") -> Column:
    """The ``month`` partition of a date, never null."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))


def index_path(path: str) -> str:
    """The folder index beside the hourly table at ``path``."""
    return f"{path.rstrip('/')}.index"


@dataclass(frozen=True)
class Warehouse:
    """Locations of the stored tables under one root folder."""

    root: str

    @property
    def hourly(self) -> str:
        return f"{self.root}/hourly"

    @property
    def daily(self) -> str:
        return f"{self.root}/daily"

    @property
    def hourly_recent(self) -> str:
        return f"{self.root}/hourly_recent"

    @property
    def station_metadata(self) -> str:
        return f"{self.root}/station_metadata"

    @property
    def station_csv(self) -> str:
        return f"{self.root}/station_csv"

    @property
    def tables(self) -> list[str]:
        """The tables whose folders are replaced by swaps, the root first."""
        return [self.root, self.hourly, self.daily, self.hourly_recent, self.station_metadata, self.consumed,
                index_path(self.hourly)]

    @property
    def consumed(self) -> str:
        return f"{self.root}/consumed"

    @property
    def pending(self) -> str:
        return f"{self.root}/pending"

    @property
    def report(self) -> str:
        return f"{self.root}/report"


def read_table(spark: SparkSession, schema: T.StructType, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A stored table; one not written yet is empty."""
    try:
        return spark.read.schema(schema).options(**options).format(fmt).load(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return spark.createDataFrame([], schema)
        raise


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station CSV (header, ``NA`` for nulls) with the fixed schema."""
    return read_table(spark, STATIONS, path, "csv", header="true", nullValue=CSV_NULL)


def read_station_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Stored station dimension."""
    return read_table(spark, STATIONS, path)


def read_hourly(spark: SparkSession, path: str, as_of=None, days: int | None = None,
                keep_partitions: bool = False) -> DataFrame:
    """Stored hourly rows; with ``as_of``/``days`` only ``Date >= as_of - days``.

    The bound prunes month partitions and is pushed to the Parquet scan.
    ``keep_partitions`` keeps the stored ``month``/``sbucket`` columns (for
    partition filters of jobs that rewrite folders).
    """
    df = read_table(spark, HOURLY_STORED, path)
    if as_of is not None and days is not None:
        start = window_start(as_of, days)
        df = df.where((F.col("month") >= F.lit(start.strftime("%Y-%m"))) & (F.col("Date") >= F.lit(start)))
    return df.select(*HOURLY_COLUMNS, *(PARTITION_COLUMNS if keep_partitions else []))


def read_daily(spark: SparkSession, path: str, keep_partitions: bool = False) -> DataFrame:
    """Stored daily mart (optionally with its partition columns)."""
    cols = [f.name for f in DAILY.fields] + (PARTITION_COLUMNS if keep_partitions else [])
    return read_table(spark, DAILY_STORED, path).select(*cols)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed data pages (a missing folder is an error, as for all landed inputs)."""
    return spark.read.schema(PAGES).parquet(path)


def page_digest() -> Column:
    """Digest of a landed page: its link, its fetch and its content."""
    link = F.to_json(F.struct("group", "station_url_name", "url", "http_status", "fetched_at", F.sha2("html", 256).alias("html")))
    return F.sha2(link, 256)


def landed_month() -> Column:
    """Month of a page's fetch, the partition of the record of consumed pages."""
    return month_key("fetched_at")


def read_consumed(spark: SparkSession, path: str, pages: DataFrame) -> DataFrame:
    """Digests of the consumed pages that were fetched in the same months as
    ``pages`` (the months, few, come to the driver; only their folders are read)."""
    months = [r[0] for r in pages.select(landed_month()).distinct().collect()]
    return read_table(spark, CONSUMED, path).where(F.col("landed").isin(months)).select("digest").distinct()


def read_nav_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed sidebar / home pages."""
    return spark.read.schema(NAV_PAGES).parquet(path)


def read_series_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Landed series date ranges (station_url_name, start_text, end_text)."""
    return spark.read.schema(SERIES_RANGES).parquet(path)
