"""Stand-in inputs built from the driver's test tables.

The test tables are not station data, so each builder here maps one of them
onto an input schema of the library (hourly rows, landed data pages, sidebar
pages, coordinate scripts, station dimension, series ranges). The builders
only lay rows out in the expected shape; none of them parses, deduplicates,
aggregates to an output or otherwise does the work of the job that consumes
them. The mapping rules below are ours (they are not values of the original
tool):

* events -> hourly readings: ``user_id`` is the station (``P_<user_id>``,
  name from ``customer``), ``event_type`` the parameter, ``value`` the
  reading.
* customer -> station dimension: url name is the name without ``#``; the
  market segment decides which data groups a station serves; stations with
  a negative balance answer their data links with HTTP 404.
* events -> landed data pages: one page per (group, station, hour), one table
  row per event; a 3-column group gets an empty cell for the stream the
  event is not. Readings whose ``props.k`` is below 10 carry the estimated
  tag; optionally ``k = 0`` readings are corrupted.
* orders -> sidebar pages: one page per order, whose station section holds
  one link; the order priority picks the link label.
* customer / supplier -> coordinate scripts: ``var locations = [...]``
  scripts of at most 16 entries each.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.constants import (
    CONTENT_PATH,
    GROUP_HYDROMETRIC,
    GROUP_PRESSURE,
    GROUP_TEMPERATURE,
    ESTIMATED_TAG,
    NAV_TITLE_CLASS,
    DATA_TABLE_CLASS,
    ADMIN_TITLE,
)
from gaugeflow.sinks.swap import move

BASE_URL = "http://stations.example/"

# Stand-in mapping of event types to parameters (ours).
EVENT_PARAMETER = {
    "click": "Water Level",
    "signup": "Sensor Depth",
    "view": "Pressure",
    "purchase": "Air Temperature",
    "error": "Water Temperature",
}
# Page group, page width and column position of each parameter.
PARAMETER_LAYOUT = {
    "Water Level": (GROUP_HYDROMETRIC, 3, 1),
    "Sensor Depth": (GROUP_HYDROMETRIC, 3, 2),
    "Pressure": (GROUP_PRESSURE, 2, 1),
    "Air Temperature": (GROUP_TEMPERATURE, 3, 1),
    "Water Temperature": (GROUP_TEMPERATURE, 3, 2),
}
GROUP_PAGE = {GROUP_HYDROMETRIC: "WaterLevel", GROUP_PRESSURE: "Pressure", GROUP_TEMPERATURE: "Temperature"}
# Order priority -> sidebar label (ours).
PRIORITY_LABEL = {
    "1-URGENT": "Staff Gauge",
    "2-HIGH": "Water Temperature",
    "3-MEDIUM": "Barometric Pressure",
    "4-NOT SPECIFIED": "Voltage",
    "5-LOW": "Site Info",
}
LABEL_PAGE = {
    "Staff Gauge": "WaterLevel",
    "Water Temperature": "Temperature",
    "Barometric Pressure": "Pressure",
    "Voltage": "Voltage",
    "Site Info": "SiteInfo",
}
PAGE_TIME_FORMAT = "MMM dd, yyyy HH:mm:ss"
FETCHED_AT = "2024-01-31 00:00:00"
LOCATIONS_PER_SCRIPT = 16


def _map(mapping: dict, col: Column) -> Column:
    return F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])[col]


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    """One driver table of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prop_k(props: str = "props") -> Column:
    """The integer ``k`` of the events' JSON ``props``."""
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def stations(customer: DataFrame, base_url: str = BASE_URL) -> DataFrame:
    """Station dimension (STATIONS schema) from customer."""
    seg = F.col("c_mktsegment")
    url_name = F.replace(F.col("c_name"), F.lit("#"), F.lit(""))
    return customer.select(
        F.concat(F.lit("P_"), F.col("c_custkey").cast("string")).alias("station_id"),
        F.col("c_name").alias("station_name"),
        url_name.alias("station_url_name"),
        F.lit(None).cast("string").alias("start_date"),
        F.lit(None).cast("string").alias("end_date"),
        (seg != "MACHINERY").alias("water_temperature"),
        (seg != "AUTOMOBILE").alias("staff_gauge"),
        (seg == "BUILDING").alias("voltage"),
        (seg != "HOUSEHOLD").alias("barometric_pressure"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("long"),
        F.concat(F.lit(base_url + CONTENT_PATH), url_name, F.lit("/SiteInfo.aspx")).alias("site_info"),
    )


def hourly(events: DataFrame, customer: DataFrame) -> DataFrame:
    """Hourly rows (HOURLY schema) from events: one row per event."""
    names = customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name"))
    e = events.join(names, "user_id", "left")
    return e.select(
        F.concat(F.lit("P_"), F.col("user_id").cast("string")).alias("STATION_NUMBER"),
        F.col("c_name").alias("STATION_NAME"),
        F.to_date("ts").alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("Time"),
        F.col("value").alias("Value"),
        _map(EVENT_PARAMETER, F.col("event_type")).alias("Parameter"),
        F.lit("").alias("Code"),
        F.lit("").alias("Comments"),
    )


UNDATED = 40  # readings whose event id this divides carry no date


def undated_hourly(events: DataFrame, customer: DataFrame) -> DataFrame:
    """``hourly`` with readings that carry no date and time."""
    known = events.where(F.coalesce(F.col("event_id") % UNDATED != 0, F.lit(True)))
    none = hourly(events.where(F.col("event_id") % UNDATED == 0), customer)
    return hourly(known, customer).unionByName(
        none.withColumn("Date", F.lit(None).cast("date")).withColumn("Time", F.lit(None).cast("string")))


class StopsAfter:
    """A folder mover that works ``moves`` times and then fails for good, as
    when the process or the file system goes away in the middle of a swap."""

    def __init__(self, moves: int):
        self.left, self.lock = moves, threading.Lock()

    def __call__(self, spark, source: str, target: str) -> None:
        with self.lock:
            self.left -= 1
            if self.left < 0:
                raise OSError(f"stopped before moving {source}")
        move(spark, source, target)


PAGE_ROWS, FAULTS = 500, 12


def data_pages(events: DataFrame, customer: DataFrame, base_url: str = BASE_URL,
               corrupt: bool = False) -> DataFrame:
    """Landed data pages (PAGES schema) from events.

    One page per (group, station, week) holding one table row per event of
    that station and week whose parameter belongs to the group, PAGE_ROWS at
    most; a week with more has more pages. Some pages have a row commented out, a
    table inside a cell or a header of two rows. With ``corrupt`` some cells hold no
    number, and the page's smallest event id modulo FAULTS chooses a fault of
    the page: 1 no table, 2 a column too many, 3 a row without a time, 4 an
    unknown station, 5 (but for Pressure) the layout of one stream.
    """
    cust = customer.select(
        F.col("c_custkey").alias("user_id"),
        F.replace(F.col("c_name"), F.lit("#"), F.lit("")).alias("station_url_name"),
        F.col("c_acctbal"),
    )
    param = _map(EVENT_PARAMETER, F.col("event_type"))
    group = _map({p: g for p, (g, _, _) in PARAMETER_LAYOUT.items()}, param)
    e = events.join(cust, "user_id").select(
        group.alias("group"),
        "station_url_name",
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("slot"),
        "c_acctbal",
        F.struct("ts", "event_id", "event_type", "value", "props").alias("ev"),
    )
    header = _map(
        {
            GROUP_HYDROMETRIC: "<tr><th>Time</th><th>Water Level (m)</th><th>Sensor Depth (m)</th></tr>",
            GROUP_PRESSURE: "<tr><th>Time</th><th>Pressure (kPa)</th></tr>",
            GROUP_TEMPERATURE: "<tr><th>Time</th><th>Air Temperature (C)</th><th>Water Temperature (C)</th></tr>",
        },
        F.col("group"),
    )
    # The same header over two rows, for some pages.
    tall = _map(
        {
            GROUP_HYDROMETRIC: "<tr><th rowspan=2>Time</th><th colspan=2>Water</th></tr><tr><th>Level (m)</th><th>Depth (m)</th></tr>",
            GROUP_PRESSURE: '<tr><th rowspan="2">Time</th><th>Pressure</th></tr><tr><th>kPa</th></tr>',
            GROUP_TEMPERATURE: "<tr><th rowspan=2>Time</th><th colspan=2>Temperature</th></tr><tr><th>Air</th><th>Water</th></tr>",
        },
        F.col("group"),
    )
    # Only the raw readings cross the shuffle; each page's rows are
    # formatted afterwards, spread over the pages' partitions.
    at = Window.partitionBy("group", "station_url_name", "slot").orderBy("ev")
    e = e.withColumn("page_no", F.floor((F.row_number().over(at) - 1) / F.lit(PAGE_ROWS)))
    pages = e.groupBy("group", "station_url_name", "slot", "page_no").agg(
        F.sort_array(F.collect_list("ev")).alias("rows"),
        F.min("c_acctbal").alias("c_acctbal"),
        F.min("ev.event_id").alias("first_id"),
    )
    fault = F.col("first_id") % F.lit(FAULTS) if corrupt else F.lit(0)
    narrow = (fault == 5) & (F.col("group") != GROUP_PRESSURE)
    look = F.col("first_id") % F.lit(5)  # 1: a row commented out, 2: a table in a cell, 3: a header of two rows
    pages = pages.withColumn("station_url_name", F.when(fault == 4, F.concat("station_url_name", F.lit("x")))
                             .otherwise(F.col("station_url_name")))

    def row_html(r: Column) -> Column:
        p = _map(EVENT_PARAMETER, r["event_type"])
        width = _map({q: w for q, (_, w, _) in PARAMETER_LAYOUT.items()}, p)
        pos = _map({q: i for q, (_, _, i) in PARAMETER_LAYOUT.items()}, p)
        k = F.get_json_object(r["props"], "$.k").try_cast("int")
        text = r["value"].cast("string")
        cell = F.when(k < 10, F.concat(text, F.lit(ESTIMATED_TAG))).otherwise(text)
        if corrupt:
            cell = F.when(k == 0, F.lit("#VALUE!")).otherwise(cell)
        inner = F.when((look == 2) & (r["event_id"] == F.col("first_id")), F.lit("<table><tr><td></td></tr></table>"))
        td = F.concat(F.lit("<td>"), cell, F.coalesce(inner, F.lit("")), F.lit("</td>"))
        empty = F.lit("<td></td>")
        cells = F.when((width == 2) | narrow, td).when(pos == 1, F.concat(td, empty)).otherwise(F.concat(empty, td))
        cells = F.concat(cells, F.when(fault == 2, empty).otherwise(F.lit("")))
        time = F.when((fault == 3) & (r["event_id"] == F.col("first_id")), F.lit("no time")).otherwise(F.date_format(r["ts"], PAGE_TIME_FORMAT))
        return F.concat(F.lit("<tr><td>"), time, F.lit("</td>"), cells, F.lit("</tr>"))

    html = F.concat(
        F.lit('<html><body><div id="content"><table class="' + DATA_TABLE_CLASS + '" cellspacing="0">'),
        F.when(narrow, F.lit("<tr><th>Time</th><th>Reading</th></tr>"))
        .when(fault == 2, F.replace(header, F.lit("</tr>"), F.lit("<th>Other</th></tr>")))
        .when(look == 3, tall).otherwise(header),
        F.when(look == 1, F.lit("<!-- <tr><td>Jan 01, 1999 00:00:00</td><td>1</td><td>1</td></tr> </table> -->")).otherwise(""),
        F.array_join(F.transform("rows", row_html), ""),
        F.lit("</table></div></body></html>"),
    )
    html = F.when(fault == 1, F.lit("<html><body><p>No data</p></body></html>")).otherwise(html)
    url = F.concat(
        F.lit(base_url + CONTENT_PATH),
        F.col("station_url_name"),
        F.lit("/"),
        _map(GROUP_PAGE, F.col("group")),
        F.lit(".aspx?week="),
        F.col("slot"),
        F.when(F.col("page_no") > 0, F.concat(F.lit("&page="), F.col("page_no").cast("string"))).otherwise(""),
    )
    return pages.select(
        "group",
        "station_url_name",
        url.alias("url"),
        F.when(F.col("c_acctbal") < 0, F.lit(404)).otherwise(F.lit(200)).cast("int").alias("http_status"),
        html.alias("html"),
        F.lit(FETCHED_AT).cast("timestamp").alias("fetched_at"),
    )


# Names that some stations carry, as text and as references in a page (ours).
NAME_ENDS = {4: (" Café", " Caf&eacute;"), 5: (" Café", " Caf&#233;"), 6: (" Café & Fils", " Caf&#xE9; &amp; Fils")}


def station_title(name: Column, key: Column, encoded: bool = False) -> Column:
    """A station's name in the sidebar, plain or as written in the page."""
    ends = F.create_map(*[F.lit(x) for k, v in NAME_ENDS.items() for x in (k, v[encoded])])
    return F.concat(name, F.coalesce(ends[(key % 8).cast("int")], F.lit("")))


def nav_pages(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Sidebar pages (NAV_PAGES schema): one per order.

    Each page has an untitled home link, one station section (the order's
    customer, some names written with character references) with one link labelled by the order priority, and an Admin
    section.
    """
    names = customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    # Landed pages arrive in many files; spread the (light) order rows like
    # that before the pages are formatted (the test table is one split).
    o = orders.join(names, "o_custkey").repartition("o_orderkey")
    label = _map(PRIORITY_LABEL, F.col("o_orderpriority"))
    page = _map(LABEL_PAGE, label)
    href = F.concat(
        F.lit(CONTENT_PATH),
        F.replace(F.col("c_name"), F.lit("#"), F.lit("")),
        F.lit("/"),
        page,
        F.lit(".aspx?o="),
        F.col("o_orderkey").cast("string"),
    )
    title = f'<p class="{NAV_TITLE_CLASS}">'
    html = F.concat(
        F.lit('<html><body><div id="sidebar"><div class="c2 alignleft"><ul id="example">'),
        F.lit('<li><a href="Default.aspx">Home</a></li>'),
        F.lit("<li>" + title),
        station_title(F.col("c_name"), F.col("o_custkey"), encoded=True),
        F.lit('</p><ul><li><a href="'),
        href,
        F.lit('">'),
        label,
        F.lit("</a></li></ul></li>"),
        F.lit("<li>" + title + ADMIN_TITLE + '</p><ul><li><a href="Admin/Login.aspx">Login</a></li></ul></li>'),
        F.lit("</ul></div></div></body></html>"),
    )
    return o.select(F.col("o_orderkey").alias("page_id"), F.lit("http://stations.example/").alias("url"), html.alias("html"))


def location_pages(dim: DataFrame, key: str, name: str, lat: str, long: str,
                   page_offset: int = 0) -> DataFrame:
    """Coordinate script pages (NAV_PAGES schema): entries of ``dim`` in
    scripts of at most LOCATIONS_PER_SCRIPT consecutive keys."""
    entry = F.concat(
        F.lit("['"),
        F.col(name),
        F.lit("', "),
        F.col(lat).cast("string"),
        F.lit(", "),
        F.col(long).cast("string"),
        F.lit(", 'http://stations.example/"),
        F.col(key).cast("string"),
        F.lit("']"),
    )
    chunk = F.floor(F.col(key) / LOCATIONS_PER_SCRIPT)
    scripts = dim.select(chunk.alias("chunk"), F.col(key).alias("k"), entry.alias("entry")).groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("k", "entry"))).alias("entries")
    )
    body = F.array_join(F.transform("entries", lambda e: e["entry"]), ",\n    ")
    html = F.concat(
        F.lit('<html><body><div id="main"><script type="text/javascript">\n  var map;\n  var locations = [\n    '),
        body,
        F.lit("\n  ];\n  function initMap() { return locations.length; }\n</script></div></body></html>"),
    )
    return scripts.select((F.col("chunk") + page_offset).cast("long").alias("page_id"),
                          F.lit("http://stations.example/").alias("url"), html.alias("html"))


def series_ranges(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Date range texts per station url name as the site reports them:
    first order date in 12-hour text, last in 24-hour text."""
    names = customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    o = orders.join(names, "o_custkey")
    r = o.groupBy("c_name").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return r.select(
        F.replace(F.col("c_name"), F.lit("#"), F.lit("")).alias("station_url_name"),
        F.date_format("a", "MMM dd, yyyy hh:mm a").alias("start_text"),
        F.date_format("b", "MMM dd, yyyy HH:mm").alias("end_text"),
    )
