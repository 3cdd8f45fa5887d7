"""The folder index: what holds a station's parameter, without reading the readings."""

import datetime as dt

import pytest

from gaugeflow import standins as S
from gaugeflow.plans.jobs import run_reset
from gaugeflow.schemas import FOLDER_INDEX, HOURLY
from gaugeflow.sinks.swap import exists
from gaugeflow.sinks.tables import (append_hourly, create_index, folder_ids, folders_holding, overwrite_partitions, refresh_index,
                                    reset_tables, with_partitions)
from gaugeflow.sources.tables import Warehouse, index_path, read_hourly, read_table

SF = "/root/testdata/sf0.001"


def rows(spark, *readings):
    data = [(s, "A", m and dt.date.fromisoformat(f"{m}-03"), "00:00:00", 1.0, p, "", "") for s, p, m in readings]
    return spark.createDataFrame(data, HOURLY)


def listed(spark, path):
    return sorted(tuple(r)[:3] for r in read_table(spark, FOLDER_INDEX, index_path(path)).collect())


def keys(spark, *pairs):
    return spark.createDataFrame(list(pairs), "STATION_NUMBER string, Parameter string")


@pytest.fixture
def wh(spark, tmp_dir):
    found = Warehouse(tmp_dir)
    reset_tables(spark, found)
    return found


def test_entries_are_kept_once_and_found_in_the_index_alone(spark, wh):
    first = [("P_A", "Pressure", "2023-11"), ("P_A", "Pressure", "2023-12"), ("P_B", "Pressure", "2023-11"), ("P_A", "Pressure", None)]
    append_hourly(rows(spark, *first, *first), wh.hourly)
    append_hourly(rows(spark, *first, ("P_A", "Water", "2024-01")), wh.hourly)
    want = [(s, p, m or "none") for s, p, m in first] + [("P_A", "Water", "2024-01")]
    assert listed(spark, wh.hourly) == sorted(want)
    found = folders_holding(spark, wh.hourly, keys(spark, ("P_A", "Pressure")))
    assert {m for m, _ in folder_ids(found)} == {"2023-11", "2023-12", "none"}
    assert all("/hourly.index/" in f for f in found.inputFiles() if "/hourly" in f) and found.inputFiles()
    assert folder_ids(folders_holding(spark, wh.hourly, keys(spark, ("P_C", "Pressure")))) == []


def test_a_rewrite_leaves_the_index_exact(spark, wh):
    append_hourly(rows(spark, ("P_A", "Pressure", "2023-11"), ("P_A", "Water", "2023-11"), ("P_A", "Water", "2023-12")), wh.hourly)
    touched = folder_ids(with_partitions(rows(spark, ("P_A", "Water", "2023-11"))))
    overwrite_partitions(rows(spark, ("P_A", "Pressure", "2023-11")), wh.hourly, touched)
    refresh_index(spark, wh.hourly, touched)
    assert listed(spark, wh.hourly) == [("P_A", "Pressure", "2023-11"), ("P_A", "Water", "2023-12")]
    every = folder_ids(read_hourly(spark, wh.hourly, keep_partitions=True))
    overwrite_partitions(rows(spark), wh.hourly, every)
    refresh_index(spark, wh.hourly, every)
    assert listed(spark, wh.hourly) == []


def test_a_table_without_an_index_is_scanned_until_it_gets_one(spark, tmp_dir):
    path = f"{tmp_dir}/hourly"
    append_hourly(rows(spark, ("P_A", "Pressure", "2023-11"), ("P_B", "Pressure", "2023-12")), path)
    assert not exists(spark, index_path(path))
    key = keys(spark, ("P_A", "Pressure"))
    scanned = folder_ids(folders_holding(spark, path, key))
    create_index(spark, path)
    assert folder_ids(folders_holding(spark, path, key)) == scanned and [m for m, _ in scanned] == ["2023-11"]


def test_reset_drops_stale_months_of_its_stations(spark, wh):
    """The replaced parameter's rows in a month that the new archive lacks go, from table and index."""
    events, customer = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("events", "customer"))
    S.stations(customer).write.mode("overwrite").parquet(wh.station_metadata)
    one = events.agg({"user_id": "min"}).first()[0]
    station = f"P_{one}"
    append_hourly(rows(spark, (station, "Pressure", "1999-05"), (station, "Other", "1999-05"), ("P_X", "Pressure", "1999-05")), wh.hourly)
    archive = S.data_pages(events.where(f"user_id = {one} and event_type = 'view'"), customer)
    new = run_reset(spark, wh, archive, base_url=S.BASE_URL)
    assert new.count() > 0 and new.where("Date < '2000-01-01'").count() == 0
    old = {(s, p) for s, p, m in listed(spark, wh.hourly) if m == "1999-05"}
    assert old == {(station, "Other"), ("P_X", "Pressure")}
    held = with_partitions(read_hourly(spark, wh.hourly)).select("STATION_NUMBER", "Parameter", "month").distinct().collect()
    assert listed(spark, wh.hourly) == sorted(map(tuple, held))
