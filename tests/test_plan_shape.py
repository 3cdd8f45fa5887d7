"""Physical-plan properties the design relies on at scale."""

import datetime as dt
import re

from pyspark.sql import functions as F

from gaugeflow import standins as S
from gaugeflow.operators.aggregate import daily_two_level
from gaugeflow.operators.dedup import new_rows
from gaugeflow.operators.links import all_links
from gaugeflow.plans.normalize import normalize_pages
from gaugeflow.schemas import HOURLY
from gaugeflow.sinks.tables import append_hourly
from gaugeflow.sources.tables import read_hourly

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_read_prunes_and_pushes(spark, tmp_dir):
    path = f"{tmp_dir}/hourly"
    rows = [("P_A", "A", dt.date(2023, m, 1), "00:00:00", 1.0, "Pressure", "", "") for m in range(1, 13)]
    append_hourly(spark.createDataFrame(rows, HOURLY), path)
    df = read_hourly(spark, path, dt.date(2023, 12, 20), 30)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ >= 2023-11", text)
    assert "GreaterThanOrEqual(Date,2023-11-20)" in text
    assert df.count() == 1


def test_daily_two_level_hashes_the_big_level(spark):
    h = S.hourly(spark.read.parquet(f"{SF}/events.parquet"), spark.read.parquet(f"{SF}/customer.parquet"))
    text = plan(daily_two_level(h))
    # level 1 (all rows) is a hash aggregate with a partial step before the shuffle
    assert "partial_sum" in text and "HashAggregate" in text
    first_sort = text.find("SortAggregate")
    assert first_sort == -1 or text.find("partial_sum") > first_sort  # sort aggregation only above level 1


def test_grouped_anti_join_aggregates_before_shuffle(spark):
    h = S.hourly(spark.read.parquet(f"{SF}/events.parquet"), spark.read.parquet(f"{SF}/customer.parquet"))
    text = plan(new_rows(h, h, how="grouped"))
    assert "partial_sum" in text and "partial_max" in text
    assert "SortMergeJoin" not in text and "BroadcastNestedLoopJoin" not in text


def test_page_parse_does_not_shuffle_pages(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    cu = spark.read.parquet(f"{SF}/customer.parquet")
    landed = f"{tmp_dir}/pages"
    S.data_pages(ev, cu).write.parquet(landed)
    rows = normalize_pages(spark.read.parquet(landed), S.stations(cu)).rows
    text = plan(rows)
    # the only exchanges belong to the station lookup (dimension side)
    for m in re.finditer(r"Exchange hashpartitioning\(([^)]*)\)", text):
        assert "station_url_name" in m.group(1)
    assert "SortMergeJoin" not in text


def test_update_joins_pages_once_with_the_dimension(spark, tmp_dir):
    cu = spark.read.parquet(f"{SF}/customer.parquet")
    landed = f"{tmp_dir}/pages"
    S.data_pages(spark.read.parquet(f"{SF}/events.parquet"), cu).write.parquet(landed)
    pages = spark.read.parquet(landed)
    parsed = normalize_pages(pages, S.stations(cu), wanted_only=True).rows
    assert len(re.findall(r"\bBroadcastHashJoin\b|\bSortMergeJoin\b|\bShuffledHashJoin\b", plan(parsed))) == 1
    # the same pages as a semi-join with the links, then the station lookup
    links = all_links(S.stations(cu), S.BASE_URL).select("group", "station_url_name")
    want = normalize_pages(pages.join(links, ["group", "station_url_name"], "left_semi"), S.stations(cu)).rows
    assert parsed.exceptAll(want).count() == want.exceptAll(parsed).count() == 0 < parsed.count()
