"""Column helpers on the edge rows of FIXTURES §3."""

import math

import pytest
from pyspark.sql import functions as F

from gaugeflow.functions import (
    cell_text,
    coord_station_id,
    estimated_code,
    link_status,
    numeric_value,
    parse_page_time,
    parse_site_date,
    picker_text,
    split_timestamp,
    station_id,
    url_name,
)


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first()["x"]


def test_estimated_code_shared_by_row(spark):
    df = spark.createDataFrame([(["1.20**Estimated", "3.4"],), (["1.20", "3.4**Estimated"],), ([None, "3.4"],), (["1", "2"],)],
                               "c array<string>")
    assert [r.x for r in df.select(estimated_code("c").alias("x")).collect()] == ["21", "21", "", ""]


@pytest.mark.parametrize(
    "text,expected",
    [("1.20**Estimated", 1.2), ("3.4", 3.4), ("1,234.5", 1234.5), (" 7 ", 7.0), ("-2e3", -2000.0),
     ("1_000", 1000.0), ("", None), ("NA", None), (None, None)],
)
def test_numeric_value_ok(spark, text, expected):
    r = one(spark, numeric_value(F.col("s")), text)
    assert r["error"] is None
    assert r["value"] == expected


@pytest.mark.parametrize("text", ["1.0d", "0x1p3", "abc", "**Estimated", "1.2.3"])
def test_numeric_value_error(spark, text):
    r = one(spark, numeric_value(F.col("s")), text)
    assert r["value"] is None and "could not convert" in r["error"]


def test_numeric_value_specials(spark):
    assert math.isnan(one(spark, numeric_value(F.col("s")), "nan**Estimated")["value"])
    assert one(spark, numeric_value(F.col("s")), "-inf")["value"] == float("-inf")
    # 'nan' alone is a missing-value text of an HTML table -> null, not NaN
    assert one(spark, numeric_value(F.col("s")), "nan")["value"] is None


def test_plain_number_is_matched_once_a_cell(spark):
    expr = numeric_value(F.col("s"))
    plan = spark.createDataFrame([("1",)], "s string").select(expr.alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(r"^-?\d+(?:\.\d+)?(?:\*\*Estimated)?$") == 1


@pytest.mark.parametrize(
    "text,expected",
    [("", ""), (None, None), ("Jan 04, 2024 10:15", "Jan 04, 2024 10:15"), (" a", "a"), ("a ", "a"), ("a  b", "a b"), (" ", ""),
     ("a\nb", "a b"), ("a\n", "a"), ("a\tb", "a\tb"), ("1<b>2</b>", "12"), ("a &amp; b", "a & b"), ("Café é", "Café é"),
     ("\u00a0a", "a"), ("a\u00a0\u00a0b", "a b"), ("~!%';=", "~!%';=")],
)
def test_cell_text_with_and_without_odd_characters(spark, text, expected):
    assert one(spark, cell_text(F.col("s")), text) == expected


def test_split_timestamp(spark):
    ts = parse_page_time(F.col("s"))
    d, t = split_timestamp(ts)
    r = spark.createDataFrame([("Jan 04, 2024 10:15",)], "s string").select(d.alias("d"), t.alias("t")).first()
    assert str(r.d) == "2024-01-04" and r.t == "10:15:00"


@pytest.mark.parametrize(
    "text,expected",
    [("Jan 01, 2020 03:04 PM", "2020/01/01 15:04"), ("Jan 1, 2020 15:04", "2020/01/01 15:04"), ("2020-01-01", None)],
)
def test_site_date(spark, text, expected):
    assert one(spark, parse_site_date(F.col("s")), text) == expected


@pytest.mark.parametrize(
    "name,expected",
    [("Sarita River Upper", "P_U_SARITA"), ("Upper Sarita", "P_UPPERSARITA"), ("Lakeview", "P_VIEW"),
     ("St.Mary Upper", "P_ST.MARYUPPER"), ("Étion Lower", "P_L_ÉTION"), ("Flower Creek", "P_L_F"),
     ("Sarita Upper X", "P_U_SARITA")],
)
def test_station_id(spark, name, expected):
    assert one(spark, station_id(F.col("s")), name) == expected


@pytest.mark.parametrize(
    "name,expected",
    [("U Sarita River", "P_U_SARITA"), ("Small Ring", "P_SMALL_RING"), ("Sarita Upper", "P_SARITAUPPER"),
     ("Flower Creek", "P_FLOWER")],
)
def test_coord_station_id(spark, name, expected):
    assert one(spark, coord_station_id(F.col("s")), name) == expected


def test_url_name(spark):
    assert one(spark, url_name(F.col("s")), "http://x/Content%20Pages/Sarita/SiteInfo.aspx") == "Sarita"
    assert one(spark, url_name(F.col("s")), "http://x/other/Sarita.aspx") is None


def test_link_status(spark):
    df = spark.createDataFrame([(200,), (404,), (301,), (None,)], "s int")
    got = [r.x for r in df.select(link_status("s").alias("x")).collect()]
    assert got == ["success"] + ["Error: link invalid"] * 3


def test_picker_text(spark):
    import datetime as dt

    assert one(spark, picker_text(F.col("s")), dt.date(2024, 1, 23), "s date") == "Jan 23, 2024 00:00"
