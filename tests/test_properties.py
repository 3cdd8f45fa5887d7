"""Properties from SURVEY §5.4 and a brute-force check of the anti-join."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeflow import standins as S
from gaugeflow.operators.aggregate import daily_two_level
from gaugeflow.operators.dedup import new_rows
from gaugeflow.plans.jobs import run_reset
from gaugeflow.plans.update import update_hourly
from gaugeflow.schemas import HOURLY
from gaugeflow.sinks.tables import reset_tables
from gaugeflow.sources.tables import Warehouse, read_hourly

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 1, 30)

ROW = st.tuples(
    st.sampled_from(["P_A", "P_B", None]),
    st.sampled_from(["A", None]),
    st.sampled_from([dt.date(2024, 1, 1), None]),
    st.sampled_from(["00:00:00", "01:00:00"]),
    st.sampled_from([1.0, 2.0, float("nan"), None]),
    st.sampled_from(["Pressure", "Water Level"]),
    st.sampled_from(["", "21"]),
    st.just(""),
)


def key(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


def brute_force(incoming, stored):
    seen = {key(r) for r in stored}
    return sorted((key(r) for r in incoming if key(r) not in seen), key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(incoming=st.lists(ROW, max_size=8), stored=st.lists(ROW, max_size=8))
def test_new_rows_matches_brute_force(spark, incoming, stored):
    inc = spark.createDataFrame(incoming, HOURLY)
    cur = spark.createDataFrame(stored, HOURLY)
    want = brute_force(incoming, stored)
    for how in ("auto", "grouped"):
        got = sorted((key(tuple(r)) for r in new_rows(inc, cur, how=how).collect()), key=repr)
        assert got == want, how


def tables(spark):
    return spark.read.parquet(f"{SF}/events.parquet"), spark.read.parquet(f"{SF}/customer.parquet")


def rounded(df):
    return {tuple(r) for r in df.withColumn("Value", F.round("Value", 6)).collect()}


def test_marts_independent_of_partitioning(spark):
    ev, cu = tables(spark)
    h = S.hourly(ev, cu)
    assert rounded(daily_two_level(h.repartition(1))) == rounded(daily_two_level(h.repartition(7, "Time")))


def test_one_batch_equals_disjoint_batches(spark):
    ev, cu = tables(spark)
    st_ = S.stations(cu)
    pages = S.data_pages(ev, cu)
    empty = spark.createDataFrame([], HOURLY)
    whole = update_hourly(pages, st_, empty, AS_OF, base_url=S.BASE_URL).new_rows
    stored = empty
    for k in range(3):
        part = pages.where(F.pmod(F.xxhash64("url"), F.lit(3)) == k)
        fresh = update_hourly(part, st_, stored, AS_OF, base_url=S.BASE_URL).new_rows
        stored = stored.unionByName(fresh).checkpoint()
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, stored.collect()))


def test_reset_twice_equals_once(spark, tmp_dir):
    ev, cu = tables(spark)
    wh = Warehouse(tmp_dir)
    reset_tables(spark, wh)
    S.stations(cu).write.mode("overwrite").parquet(wh.station_metadata)
    archive = S.data_pages(ev, cu)
    run_reset(spark, wh, archive, base_url=S.BASE_URL)
    once = sorted(map(repr, read_hourly(spark, wh.hourly).collect()))
    run_reset(spark, wh, archive, base_url=S.BASE_URL)
    twice = sorted(map(repr, read_hourly(spark, wh.hourly).collect()))
    assert once == twice and len(once) > 0
