"""Readers against their schemas and the small helpers."""

import datetime as dt

from pyspark.sql import functions as F

from gaugeflow import standins as S
from gaugeflow.operators.aggregate import has_new
from gaugeflow.operators.filters import select_station
from gaugeflow.operators.links import combine_status
from gaugeflow.operators.reshape import conform, reorder, with_comments
from gaugeflow.schemas import HOURLY, NAV_PAGES, PAGES, SERIES_RANGES, STATIONS
from gaugeflow.sinks.tables import replace_table
from gaugeflow.sources.tables import read_nav_pages, read_pages, read_series_ranges, read_station_metadata

SF = "/root/testdata/sf0.001"


def test_landed_inputs_round_trip_through_readers(spark, tmp_dir):
    ev, cu, o = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ["events", "customer", "orders"])
    S.data_pages(ev, cu).write.parquet(f"{tmp_dir}/pages")
    S.nav_pages(o, cu).write.parquet(f"{tmp_dir}/nav")
    S.series_ranges(o, cu).write.parquet(f"{tmp_dir}/ranges")
    assert read_pages(spark, f"{tmp_dir}/pages").schema == PAGES
    assert read_pages(spark, f"{tmp_dir}/pages").count() > 0
    assert read_nav_pages(spark, f"{tmp_dir}/nav").schema == NAV_PAGES
    ranges = read_series_ranges(spark, f"{tmp_dir}/ranges")
    assert ranges.schema == SERIES_RANGES and ranges.where(F.col("station_url_name").isNull()).count() == 0
    # a table not written yet reads as empty with its schema
    missing = read_station_metadata(spark, f"{tmp_dir}/nothing-here")
    assert missing.schema == STATIONS and missing.count() == 0


def test_combine_status_and_has_new(spark):
    a = spark.createDataFrame([("S1", "success")], "station_url_name string, status string")
    b = spark.createDataFrame([("S2", "Error: link invalid")], "station_url_name string, status string")
    got = sorted(tuple(r) for r in combine_status(("Hydrometric", a), ("Pressure", b)).collect())
    assert got == [("Hydrometric", "S1", "success"), ("Pressure", "S2", "Error: link invalid")]
    assert has_new(a) and not has_new(a.where("false"))


def test_select_station_equality(spark):
    st = spark.createDataFrame([("P_SAR", "x"), ("P_SARITA", "y"), ("XP_SAR", "z")], "station_id string, n string")
    assert [r.station_id for r in select_station(st, "P_SAR").collect()] == ["P_SAR"]
    assert sorted(r.station_id for r in select_station(st, "P_SAR", regex=True).collect()) == ["P_SAR", "P_SARITA"]


def test_conform_reorder_comments(spark):
    raw = spark.createDataFrame(
        [("2024-01-05", "1.5", "01:00:00", "P_A", "A", "Pressure", "")],
        "Date string, Value string, Time string, STATION_NUMBER string, STATION_NAME string, Parameter string, Code string",
    )
    out = reorder(conform(with_comments(raw)))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in HOURLY]
    r = out.first()
    assert r.Date == dt.date(2024, 1, 5) and r.Value == 1.5 and r.Comments == ""
    bad = conform(with_comments(raw.withColumn("Value", F.lit("abc")))).first()
    assert bad.Value is None


def test_replace_table_from_itself(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(1,), (2,)], "x int").write.parquet(path)
    replace_table(spark.read.parquet(path).where("x > 1"), path, stage=True)
    assert [r.x for r in spark.read.parquet(path).collect()] == [2]
