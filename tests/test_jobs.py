"""Jobs over a warehouse folder: refresh, reset, update, marts."""

import datetime as dt

from pyspark.sql import functions as F

from gaugeflow import standins as S
from gaugeflow.operators.aggregate import daily_two_level
from gaugeflow.plans.jobs import full_reset, refresh_and_backfill, run_marts, run_refresh, run_reset, run_update
from gaugeflow.sinks.tables import folder_ids, overwrite_partitions, reset_tables, with_partitions
from gaugeflow.session import checkpoint_root
from gaugeflow.sources.tables import Warehouse, read_daily, read_hourly, read_station_metadata, read_stations

SF = "/root/testdata/sf0.001"


def tables(spark):
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ["events", "customer", "orders"]}


def stations_into(spark, wh):
    t = tables(spark)
    S.stations(t["customer"]).write.mode("overwrite").parquet(wh.station_metadata)


def test_update_then_marts(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    reset_tables(spark, wh)
    stations_into(spark, wh)
    t = tables(spark)
    ev = t["events"]
    as_of = dt.date(2024, 1, 30)
    p1 = S.data_pages(ev.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), t["customer"])
    p2 = S.data_pages(ev.where(F.col("ts") >= F.lit("2024-01-13").cast("timestamp_ntz")), t["customer"])
    n1 = run_update(spark, wh, p1, as_of, base_url=S.BASE_URL, recent_days=10).count()
    n2 = run_update(spark, wh, p2, as_of, base_url=S.BASE_URL, recent_days=10).count()
    hourly = read_hourly(spark, wh.hourly)
    assert hourly.count() == n1 + n2
    # incremental recent mart == window filter over the whole table
    from gaugeflow.operators.filters import recent

    inc_recent = sorted(map(repr, read_hourly(spark, wh.hourly_recent).collect()))
    assert inc_recent == sorted(map(repr, recent(hourly, as_of, 10).collect())) and inc_recent
    # no duplicate full rows after the overlapping second run
    assert hourly.distinct().count() == hourly.count()
    # incremental daily == full rebuild
    inc = {tuple(r) for r in read_daily(spark, wh.daily).withColumn("Value", F.round("Value", 6)).collect()}
    full = {tuple(r) for r in daily_two_level(hourly).withColumn("Value", F.round("Value", 6)).collect()}
    assert inc == full
    run_marts(spark, wh, as_of)
    assert read_daily(spark, wh.daily).count() == len(full)
    assert spark.read.parquet(wh.hourly_recent).count() == hourly.count()
    status = spark.read.json(f"{wh.report}/status")
    assert status.count() > 0 and set(spark.read.json(f"{wh.report}/summary").columns) >= {"group", "all_valid"}


def test_reset_replaces_only_given_pairs(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    reset_tables(spark, wh)
    stations_into(spark, wh)
    t = tables(spark)
    ev, cu = t["events"], t["customer"]
    as_of = dt.date(2024, 1, 30)
    run_update(spark, wh, S.data_pages(ev, cu), as_of, base_url=S.BASE_URL)
    before = read_hourly(spark, wh.hourly).checkpoint()
    one = ev.agg(F.min("user_id")).first()[0]
    archive = S.data_pages(ev.where((F.col("user_id") == one) & (F.col("event_type") == "view")), cu)
    new = run_reset(spark, wh, archive, base_url=S.BASE_URL)
    after = read_hourly(spark, wh.hourly)
    key = (F.col("STATION_NUMBER") == f"P_{one}") & (F.col("Parameter") == "Pressure")
    assert after.where(~key).exceptAll(before.where(~key)).count() == 0
    assert before.where(~key).exceptAll(after.where(~key)).count() == 0
    assert after.where(key).count() == new.count()


def test_emptied_partition_is_removed(spark, tmp_dir):
    from gaugeflow.schemas import HOURLY

    wh = Warehouse(tmp_dir)
    rows = [("P_A", "A", dt.date(2020, 1, 1), "00:00:00", 1.0, "Pressure", "", "")]
    df = spark.createDataFrame(rows, HOURLY)
    from gaugeflow.sinks.tables import append_hourly

    append_hourly(df, wh.hourly)
    touched = folder_ids(with_partitions(df))
    overwrite_partitions(spark.createDataFrame([], HOURLY), wh.hourly, touched)
    assert read_hourly(spark, wh.hourly).count() == 0


def test_refresh_and_full_reset(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    t = tables(spark)
    cu, orders, ev = t["customer"], t["orders"], t["events"]
    nav = S.nav_pages(orders, cu).unionByName(
        S.location_pages(cu.withColumn("lng", F.col("c_nationkey").cast("double")), "c_custkey", "c_name", "c_acctbal", "lng",
                         page_offset=10**12)
    )
    ranges = S.series_ranges(orders, cu)
    reset_tables(spark, wh)
    new_ids = run_refresh(spark, wh, nav, ranges, S.BASE_URL)
    meta = read_station_metadata(spark, wh.station_metadata)
    assert new_ids.count() == meta.count() > 0
    # a second refresh finds nothing new
    assert run_refresh(spark, wh, nav, ranges, S.BASE_URL).count() == 0
    meta = read_station_metadata(spark, wh.station_metadata)
    csv = read_stations(spark, wh.station_csv)
    assert csv.count() == meta.count()
    assert csv.where(F.col("lat").isNull()).count() == meta.where(F.col("lat").isNull()).count()
    # full reset: the stations of the refreshed dimension receive their archives
    full_reset(spark, wh, nav, ranges, S.data_pages(ev, cu, base_url=S.BASE_URL), dt.date(2024, 1, 30), S.BASE_URL)
    assert read_hourly(spark, wh.hourly).count() == read_hourly(spark, wh.hourly_recent).count()


def test_refresh_and_backfill_loads_only_new_stations(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    t = tables(spark)
    cu, orders, ev = t["customer"], t["orders"], t["events"]
    nav = S.nav_pages(orders, cu)
    ranges = S.series_ranges(orders, cu)
    reset_tables(spark, wh)
    # a previous dimension that already knows some stations
    run_refresh(spark, wh, S.nav_pages(orders.where(F.col("o_custkey") >= 3), cu), ranges, S.BASE_URL)
    known = {r.station_url_name for r in read_station_metadata(spark, wh.station_metadata).collect()}
    new_ids = refresh_and_backfill(spark, wh, nav, ranges, S.data_pages(ev, cu), S.BASE_URL)
    loaded = {r.STATION_NAME.replace("#", "") for r in read_hourly(spark, wh.hourly).select("STATION_NAME").distinct().collect()}
    assert {r.station_id for r in new_ids.collect()} == {"P_CUSTOMER#000000000", "P_CUSTOMER#000000001", "P_CUSTOMER#000000002"}
    assert loaded and loaded <= {"Customer000000000", "Customer000000001", "Customer000000002"}
    assert not (loaded & known)


def test_drop_months_before(spark, tmp_dir):
    from gaugeflow.schemas import HOURLY
    from gaugeflow.sinks.tables import append_hourly, drop_months_before

    rows = [("P_A", "A", dt.date(y, m, 3), "00:00:00", 1.0, "Pressure", "", "") for y, m in [(2023, 11), (2023, 12), (2024, 1)]]
    path = f"{tmp_dir}/t"
    append_hourly(spark.createDataFrame(rows, HOURLY), path)
    assert drop_months_before(spark, path, "2023-12") == ["2023-11"]
    assert sorted(r.Date.month for r in read_hourly(spark, path).collect()) == [1, 12]


def test_sql_tables_and_daily_sql(spark, tmp_dir):
    from gaugeflow.operators.aggregate import daily, daily_sql
    from gaugeflow.sinks.catalog import drop_tables, register_tables
    from gaugeflow.sinks.tables import append_hourly

    wh = Warehouse(tmp_dir)
    reset_tables(spark, wh)
    t = tables(spark)
    h = S.hourly(t["events"], t["customer"])
    append_hourly(h, wh.hourly)
    register_tables(spark, wh, "hydro_test")
    assert spark.sql("SELECT count(*) AS n FROM hydro_test.hourly").first().n == h.count()
    stored = spark.table("hydro_test.hourly").drop("month", "sbucket")
    got = {tuple(r) for r in daily_sql(stored).withColumn("Value", F.round("Value", 6)).collect()}
    want = {tuple(r) for r in daily(h).withColumn("Value", F.round("Value", 6)).collect()}
    assert got == want
    drop_tables(spark, "hydro_test")
    assert "hydro_test" not in [d.name for d in spark.catalog.listDatabases()]


def test_marts_follow_reset_and_update(spark, tmp_dir):
    """Reset, then update, then a failed update run again: the daily mart is
    what a rebuild gives, with few files per folder and no staging left."""
    import glob

    from gaugeflow.operators.aggregate import daily
    from gaugeflow.sinks.tables import append_hourly, mark_pending, pending_folders, replace_table
    from gaugeflow.sources.tables import read_daily

    wh = Warehouse(tmp_dir)
    t = tables(spark)
    ev, cu = t["events"], t["customer"]
    replace_table(S.stations(cu), wh.station_metadata, stage=False)

    def same():
        cols = ["STATION_NUMBER", "Date", "Parameter", "numObservations"]
        want = daily(read_hourly(spark, wh.hourly)).withColumn("Value", F.round("Value", 6)).select(*cols, "Value")
        got = read_daily(spark, wh.daily).withColumn("Value", F.round("Value", 6)).select(*cols, "Value")
        return want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0 and want.count() > 0

    stage = f"{checkpoint_root(spark)}/gaugeflow-stage"
    before = set(glob.glob(f"{stage}/*"))
    early = ev.where("ts < timestamp '2024-01-10'")
    run_reset(spark, wh, S.data_pages(early, cu), base_url=S.BASE_URL)
    assert same() and pending_folders(spark, wh, "daily") == [] != pending_folders(spark, wh, "recent")
    run_update(spark, wh, S.data_pages(ev.where("ts < timestamp '2024-01-20'"), cu), dt.date(2024, 1, 30), base_url=S.BASE_URL)
    assert same() and pending_folders(spark, wh, "recent") == []
    late = spark.createDataFrame([("P_1", "A", dt.date(2020, 1, 1), "00:00:00", 1.0, "Pressure", "", "")], read_hourly(spark, wh.hourly).schema)
    mark_pending(spark, wh, folder_ids(with_partitions(late)))
    append_hourly(late, wh.hourly)  # a run that stopped here
    run_update(spark, wh, S.data_pages(early, cu), dt.date(2024, 1, 30), base_url=S.BASE_URL)
    assert same()
    some = S.stations(cu).first()["station_id"]
    run_reset(spark, wh, S.data_pages(ev, cu), base_url=S.BASE_URL, as_of=dt.date(2024, 1, 30), station=some)
    assert same()
    assert set(glob.glob(f"{stage}/*")) == before  # every job deletes its staged copies
    for folder in glob.glob(f"{tmp_dir}/daily/month=*/sbucket=*"):
        assert len(glob.glob(f"{folder}/*.parquet")) <= 2


def test_bucket_count_is_a_table_property(spark, tmp_dir):
    """A warehouse created with other than the default buckets keeps them
    through update, reset and rebuild, and its marts stay complete."""
    import glob

    from gaugeflow.sinks.tables import table_buckets

    wh = Warehouse(f"{tmp_dir}/wh")
    reset_tables(spark, wh, buckets=3)
    stations_into(spark, wh)
    t = tables(spark)
    pages, as_of = S.data_pages(t["events"], t["customer"]), dt.date(2024, 1, 30)
    run_update(spark, wh, pages, as_of, base_url=S.BASE_URL)
    some = S.stations(t["customer"]).first()["station_id"]
    run_reset(spark, wh, pages, base_url=S.BASE_URL, as_of=as_of, station=some)

    def check():
        for path in (wh.hourly, wh.daily, wh.hourly_recent):
            assert table_buckets(spark, path) == 3
            assert {f.rsplit("=", 1)[1] for f in glob.glob(f"{path}/month=*/sbucket=*")} == {"0", "1", "2"}
        assert read_daily(spark, wh.daily).count() == daily_two_level(read_hourly(spark, wh.hourly)).count() > 0
    check()
    run_marts(spark, wh, as_of)
    check()
    reset_tables(spark, wh)
    assert table_buckets(spark, wh.daily) == 3
