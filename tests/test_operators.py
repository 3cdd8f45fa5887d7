"""Operators on the edge rows of FIXTURES §3."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators.aggregate import daily, daily_two_level, pivot_params
from gaugeflow.operators.dedup import new_rows, replicate_rows
from gaugeflow.operators.filters import drop_unserved, lookback, recent, select_station, stations_with
from gaugeflow.operators.joins import new_stations
from gaugeflow.operators.links import all_links, all_valid, fetch_manifest, reset_manifest, urls_by_variable
from gaugeflow.operators.replace import replace_rows
from gaugeflow.operators.reshape import canonical_columns, snake_names, to_long
from gaugeflow.schemas import HOURLY, STATIONS

D = dt.date(2024, 1, 5)


def h(station="P_A", name="A", date=D, time="01:00:00", value=1.0, param="Water Level", code="", comments=""):
    return (station, name, date, time, value, param, code, comments)


@pytest.mark.parametrize("how", ["auto", "grouped"])
def test_new_rows_edges(spark, how):
    stored = spark.createDataFrame(
        [h(value=1.0), h(time="02:00:00", value=None), h(time="03:00:00", value=float("nan")), h(name=None, time="04:00:00")],
        HOURLY,
    )
    incoming = spark.createDataFrame(
        [
            h(value=1.0),  # same row stored -> dropped
            h(value=1.5),  # same key, other value -> appended
            h(time="02:00:00", value=None),  # null value stored -> dropped
            h(time="03:00:00", value=float("nan")),  # NaN stored -> dropped
            h(name=None, time="04:00:00"),  # null name stored -> dropped
            h(time="05:00:00", value=9.0),  # new row twice -> both appended
            h(time="05:00:00", value=9.0),
        ],
        HOURLY,
    )
    got = sorted((r.Time, r.Value) for r in new_rows(incoming, stored, how=how).collect())
    assert got == [("01:00:00", 1.5), ("05:00:00", 9.0), ("05:00:00", 9.0)]


def test_replicate_rows_chunks(spark):
    df = spark.createDataFrame([("a", 3), ("b", 25), ("c", 1)], "k string, n long")
    out = replicate_rows(df, "n", chunk=4)
    counts = {r.k: r["count"] for r in out.groupBy("k").count().collect()}
    assert counts == {"a": 3, "b": 25, "c": 1}


def test_new_rows_hot_copies(spark):
    # one group of identical new rows much larger than the chunk size
    rows = [h(time="09:00:00", value=7.0)] * 300
    incoming = spark.createDataFrame(rows, HOURLY)
    stored = spark.createDataFrame([], HOURLY)
    from gaugeflow.operators import dedup

    out = dedup.replicate_rows(
        incoming.groupBy(*incoming.columns).agg(F.count("*").alias("_n")), "_n", chunk=16
    )
    assert out.count() == 300
    assert new_rows(incoming, stored, how="grouped").count() == 300


def test_daily_semantics(spark):
    rows = [
        h(value=1.0),
        h(value=None),  # counted, not averaged
        h(value=3.0, name="B"),  # two names -> greatest
        h(param="Pressure", value=None),  # all-null group -> null mean
        h(param="Sensor Depth", value=float("nan")),  # NaN propagates
        h(param="Sensor Depth", value=1.0),
    ]
    df = spark.createDataFrame(rows, HOURLY)
    for fn in (daily, daily_two_level):
        got = {r.Parameter: r for r in fn(df).collect()}
        wl = got["Water Level"]
        assert (wl.STATION_NAME, wl.Value, wl.numObservations) == ("B", 2.0, 3)
        assert got["Pressure"].Value is None and got["Pressure"].numObservations == 1
        assert math.isnan(got["Sensor Depth"].Value)


def test_windows_inclusive(spark):
    as_of = dt.date(2024, 1, 30)
    df = spark.createDataFrame([h(date=dt.date(2023, 12, 31)), h(date=dt.date(2023, 12, 30))], HOURLY)
    assert [r.Date for r in lookback(df, as_of, 30).collect()] == [dt.date(2023, 12, 31)]
    df2 = spark.createDataFrame([h(date=as_of - dt.timedelta(days=366)), h(date=as_of - dt.timedelta(days=367))], HOURLY)
    assert recent(df2, as_of).count() == 1


def test_to_long_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None)], "id int, a double, b double")
    got = sorted((r.Parameter, r.Value) for r in to_long(df, ["id"], ["a", "b"]).collect())
    assert got == [("a", 1.0), ("b", None)]


def test_canonical_columns(spark):
    df = spark.createDataFrame(
        [("Hydrometric", 3), ("Hydrometric", 2), ("Pressure", 2), ("Pressure", 3), ("Temperature", 3), ("Other", 2), ("Hydrometric", 4)],
        "g string, w int",
    )
    got = [r.c for r in df.select(canonical_columns("g", "w").alias("c")).collect()]
    assert got == [
        ["Water Level", "Sensor Depth"],
        ["Water Level"],
        ["Pressure"],
        None,
        ["Air Temperature", "Water Temperature"],
        ["Water Temperature"],
        None,
    ]


def stations_df(spark):
    rows = [
        ("P_A", "A", "A", None, None, True, True, False, False, None, None, None),
        ("P_B", "B", "B", None, None, False, True, False, True, None, None, None),
        ("XP_A", "X", "X", None, None, None, False, False, False, None, None, None),
    ]
    return spark.createDataFrame(rows, STATIONS)


def test_station_filters(spark):
    st = stations_df(spark)
    assert [r.station_id for r in select_station(st, "P_A", regex=True).collect()] == ["P_A"]
    assert sorted(r.station_url_name for r in stations_with(st, "water_temperature").collect()) == ["A"]
    with pytest.raises(ValueError):
        stations_with(st, "voltage")
    urls = urls_by_variable(st, "barometric_pressure", "http://h/").collect()
    assert [r.url for r in urls] == ["http://h/Content%20Pages/B/Pressure.aspx"]
    links = sorted(tuple(r) for r in all_links(st, "http://h/").collect())
    assert links == [
        ("Hydrometric", "A", "http://h/Content%20Pages/A/WaterLevel.aspx"),
        ("Hydrometric", "B", "http://h/Content%20Pages/B/WaterLevel.aspx"),
        ("Pressure", "B", "http://h/Content%20Pages/B/Pressure.aspx"),
        ("Temperature", "A", "http://h/Content%20Pages/A/Temperature.aspx"),
    ]
    m = fetch_manifest(spark.createDataFrame([("g", "A", "u")], "group string, station_url_name string, url string"),
                       dt.date(2024, 1, 30), 7).first()
    assert m.start_text == "Jan 23, 2024 00:00"
    r = reset_manifest(spark.createDataFrame([("g", "Leiner", "u"), ("g", "A", "u")],
                                             "group string, station_url_name string, url string")).collect()
    assert [x.start_text for x in r] == ["Oct 09, 2018 11:01", "Jan 01, 2000 00:00"]


def test_all_valid_empty_group(spark):
    status = spark.createDataFrame([("Hydrometric", "A", "success"), ("Pressure", "B", "Error: link invalid")],
                                   "group string, station_url_name string, status string")
    got = {r.group: r.all_valid for r in all_valid(status).collect()}
    assert got == {"Hydrometric": True, "Pressure": False, "Temperature": True}


def test_pivot_last_label_wins_and_drop(spark):
    links = spark.createDataFrame(
        [("S1", "Staff Gauge", "u1", 1), ("S1", "Staff Gauge", "u2", 2), ("S2", "Voltage", "v", 3), ("S2", "Site Info", "s", 4)],
        "station_name string, label string, url string, pos int",
    )
    wide = pivot_params(links)
    got = {r.station_name: r for r in wide.collect()}
    assert got["S1"]["Staff Gauge"] == "u2"
    kept = [r.station_name for r in drop_unserved(wide).collect()]
    assert kept == ["S1"]
    assert snake_names(wide).columns == ["station_name", "water_temperature", "barometric_pressure", "staff_gauge", "voltage", "site_info"]


def test_new_stations(spark):
    st = stations_df(spark)
    assert sorted(r.station_id for r in new_stations(st, None).collect()) == ["P_A", "P_B", "XP_A"]
    cur = st.where("station_id = 'P_A'")
    assert sorted(r.station_id for r in new_stations(st, cur).collect()) == ["P_B", "XP_A"]


def test_replace_rows_only_given_parameter(spark):
    cur = spark.createDataFrame([h(param="Water Level", value=1.0), h(param="Sensor Depth", value=2.0), h(station="P_B")], HOURLY)
    new = spark.createDataFrame([h(param="Water Level", value=5.0, time="07:00:00")], HOURLY)
    got = sorted((r.STATION_NUMBER, r.Parameter, r.Value) for r in replace_rows(cur, new).collect())
    assert got == [("P_A", "Sensor Depth", 2.0), ("P_A", "Water Level", 5.0), ("P_B", "Water Level", 1.0)]


def test_new_rows_same_lineage(spark):
    df = spark.createDataFrame([h(value=1.0), h(value=2.0)], HOURLY)
    for how in ("auto", "grouped"):
        assert new_rows(df, df, how=how).count() == 0
        assert new_rows(df, df.where("Value > 1.5"), how=how).count() == 1


@pytest.mark.parametrize("how", ["auto", "grouped"])
def test_new_rows_keep_signed_zeros(spark, how):
    df = spark.createDataFrame([("a", -0.0), ("a", 0.0), ("b", -0.0), ("b", -0.0), ("c", float("nan")), ("d", None), ("e", -0.0)], "k string, v double")
    old = spark.createDataFrame([("e", 0.0), ("x", 1.0)], "k string, v double")
    got = sorted(str(tuple(r)) for r in new_rows(df, old, how=how).collect())
    assert got == sorted(["('a', -0.0)", "('a', 0.0)", "('b', -0.0)", "('b', -0.0)", "('c', nan)", "('d', None)"])
