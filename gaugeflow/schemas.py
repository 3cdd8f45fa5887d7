"""Spark schemas of the tables the library reads and writes."""

from pyspark.sql import types as T

HOURLY = T.StructType(
    [
        T.StructField("STATION_NUMBER", T.StringType()),
        T.StructField("STATION_NAME", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Time", T.StringType()),
        T.StructField("Value", T.DoubleType()),
        T.StructField("Parameter", T.StringType()),
        T.StructField("Code", T.StringType()),
        T.StructField("Comments", T.StringType()),
    ]
)

DAILY = T.StructType(
    [
        T.StructField("STATION_NUMBER", T.StringType()),
        T.StructField("STATION_NAME", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Value", T.DoubleType()),
        T.StructField("numObservations", T.LongType()),
        T.StructField("Parameter", T.StringType()),
    ]
)

STATIONS = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("station_url_name", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("water_temperature", T.BooleanType()),
        T.StructField("staff_gauge", T.BooleanType()),
        T.StructField("voltage", T.BooleanType()),
        T.StructField("barometric_pressure", T.BooleanType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("site_info", T.StringType()),
    ]
)

# Landed data pages: one row per fetched page.
PAGES = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("station_url_name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("html", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

# Landed navigation / home pages (sidebar and coordinates script).
NAV_PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# Date range reported by the site for each station's series.
SERIES_RANGES = T.StructType(
    [
        T.StructField("station_url_name", T.StringType()),
        T.StructField("start_text", T.StringType()),
        T.StructField("end_text", T.StringType()),
    ]
)

LINKS = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("station_url_name", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)

LINK_CODES = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("station_url_name", T.StringType()),
        T.StructField("http_status", T.IntegerType()),
    ]
)

STATUS = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("station_url_name", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

# Which folders of the hourly table hold rows of a station's parameter.
FOLDER_INDEX = T.StructType([T.StructField(c, T.StringType()) for c in ("STATION_NUMBER", "Parameter", "month")]
                            + [T.StructField("sbucket", T.IntegerType())])

# Pages whose rows an update has appended; ``landed`` is the month of the fetch.
CONSUMED = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("station_url_name", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("landed", T.StringType()),
    ]
)

# Greatest error per link of the pages that a stream has seen (null: none).
LINK_ERRORS = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("station_url_name", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
