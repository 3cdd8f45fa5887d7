"""Pages are consumed once: rows and the record of their pages appear together."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeflow import standins as S
from gaugeflow.plans.jobs import full_reset, run_reset, run_update
from gaugeflow.schemas import CONSUMED
from gaugeflow.sinks import swap
from gaugeflow.sinks.tables import replace_table, reset_tables
from gaugeflow.sources.tables import Warehouse, read_daily, read_hourly, read_table

SF = "/root/testdata/sf0.001"
LATE = dt.date(2031, 1, 1)  # every row is older than the lookback


@pytest.fixture
def landed(spark, tmp_dir):
    events, customer = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("events", "customer"))
    wh = Warehouse(f"{tmp_dir}/wh")
    reset_tables(spark, wh)
    replace_table(S.stations(customer), wh.station_metadata)
    few = events.select("user_id").distinct().orderBy("user_id").limit(6)
    S.data_pages(events.join(few, "user_id", "left_semi"), customer).write.parquet(f"{tmp_dir}/pages")
    return wh, spark.read.parquet(f"{tmp_dir}/pages")


def rows(spark, wh):
    return sorted(map(repr, read_hourly(spark, wh.hourly).collect()))


def consumed(spark, wh):
    return read_table(spark, CONSUMED, wh.consumed)


def test_old_pages_landed_again_add_nothing(spark, landed):
    wh, pages = landed
    first = run_update(spark, wh, pages, LATE, base_url=S.BASE_URL).count()
    held, status = rows(spark, wh), sorted(map(repr, spark.read.json(f"{wh.report}/status").collect()))
    assert first == len(held) > 0
    assert run_update(spark, wh, pages, LATE, base_url=S.BASE_URL).count() == 0
    assert rows(spark, wh) == held
    assert sorted(map(repr, spark.read.json(f"{wh.report}/status").collect())) == status
    # the same content fetched at another time is another page, as before
    other = pages.withColumn("fetched_at", F.col("fetched_at") + F.expr("interval 40 days"))
    assert run_update(spark, wh, other, LATE, base_url=S.BASE_URL).count() == first


def test_copies_in_one_run_are_kept_and_recorded_once(spark, landed):
    wh, pages = landed
    twice = pages.unionByName(pages)
    n = run_update(spark, wh, twice, LATE, base_url=S.BASE_URL).count()
    assert n == len(rows(spark, wh)) and n % 2 == 0
    assert consumed(spark, wh).count() == consumed(spark, wh).select("digest").distinct().count() > 0
    assert run_update(spark, wh, twice, LATE, base_url=S.BASE_URL).count() == 0


@pytest.mark.parametrize("at", [0, 2])
def test_a_run_that_stops_in_its_append_is_recognised(spark, landed, at):
    wh, pages = landed
    with pytest.raises(OSError):
        run_update(spark, wh, pages, LATE, base_url=S.BASE_URL, mover=S.StopsAfter(at))
    run_update(spark, wh, pages, LATE, base_url=S.BASE_URL)
    once = rows(spark, wh)
    assert len(once) == len(set(once)) > 0
    daily = read_daily(spark, wh.daily)
    assert daily.agg(F.sum("numObservations")).first()[0] == sum(1 for _ in once)


def test_a_failed_move_leaves_neither_rows_nor_record(spark, landed):
    wh, pages = landed

    class FailsOnce:
        calls = 0

        def __call__(self, spark, source, target):
            self.calls += 1
            if self.calls == 3:
                raise OSError("no")
            swap.move(spark, source, target)

    with pytest.raises(OSError):
        run_update(spark, wh, pages, LATE, base_url=S.BASE_URL, mover=FailsOnce())
    assert rows(spark, wh) == [] and consumed(spark, wh).count() == 0


def test_rejected_pages_are_not_recorded_and_null_fetch_times_are(spark, landed):
    wh, pages = landed
    some = pages.withColumn("http_status", F.when(F.col("group") == "Pressure", F.lit(404)).otherwise(F.col("http_status"))) \
        .withColumn("fetched_at", F.lit(None).cast("timestamp"))
    run_update(spark, wh, some, LATE, base_url=S.BASE_URL)
    found = consumed(spark, wh)
    assert found.where(F.col("group") == "Pressure").count() == 0 and found.where("landed = 'none'").count() == found.count() > 0
    before = len(rows(spark, wh))
    assert run_update(spark, wh, some, LATE, base_url=S.BASE_URL).count() == 0
    assert len(rows(spark, wh)) == before


def test_a_reset_lets_its_stations_pages_land_again(spark, landed):
    wh, pages = landed
    run_update(spark, wh, pages, LATE, base_url=S.BASE_URL)
    name = consumed(spark, wh).agg(F.min("station_url_name")).first()[0]
    others = consumed(spark, wh).where(F.col("station_url_name") != name).count()
    run_reset(spark, wh, pages.where(F.col("station_url_name") == name), S.BASE_URL)
    assert consumed(spark, wh).count() == others
    assert consumed(spark, wh).where(F.col("station_url_name") == name).count() == 0


def test_only_the_pages_months_are_read(spark, landed):
    from gaugeflow.sources.tables import read_consumed

    wh, pages = landed
    run_update(spark, wh, pages, LATE, base_url=S.BASE_URL)
    scan = read_consumed(spark, wh.consumed, pages)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [" in scan and "landed#" in scan.split("PartitionFilters: [")[1].split("\n")[0]
