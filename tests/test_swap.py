"""Folder replacement: whatever move fails, the table holds all old or all new rows."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from gaugeflow import standins as S
from gaugeflow.schemas import HOURLY
from gaugeflow.sinks import swap
from gaugeflow.sinks.tables import append_hourly, folder_ids, overwrite_partitions, replace_partitioned, replace_table, with_partitions
from gaugeflow.sources.tables import Warehouse, read_hourly

MONTHS = ["2023-11", "2023-12", "2024-01", "2024-02"]


def rows(spark, months, value):
    data = [(f"P_{s}", "A", None if m is None else dt.date.fromisoformat(f"{m}-03"), "00:00:00", value, "Pressure", "", "")
            for m in months for s in "AB"]
    return spark.createDataFrame(data, HOURLY)


def content(spark, path):
    return sorted(((str(r.Date), r.STATION_NUMBER, r.Value) for r in read_hourly(spark, path).collect()), key=str)


class FailsOnce:
    def __init__(self, at):
        self.at, self.calls = at, 0

    def __call__(self, spark, source, target):
        self.calls += 1
        if self.calls == self.at:
            raise OSError("no")
        swap.move(spark, source, target)


@pytest.fixture
def one_mover(monkeypatch):
    monkeypatch.setattr(swap, "MOVERS", 1)


def table(spark, tmp_dir):
    path = f"{tmp_dir}/hourly"
    append_hourly(rows(spark, MONTHS[:3] + [None], 1.0), path)
    return path


def replace(spark, path, mover):
    """Two months replaced, one emptied, one added, the undated rows replaced."""
    new = rows(spark, MONTHS[:2] + MONTHS[3:] + [None], 2.0)
    touched = folder_ids(with_partitions(rows(spark, MONTHS + [None], 0.0)))
    overwrite_partitions(new, path, touched, mover=mover, mark=("_seen-1", None))


def new_content(spark, path):
    replace(spark, path, None)
    return content(spark, path)


def test_every_failing_move_keeps_all_old_or_all_new_rows(spark, tmp_dir, one_mover):
    done = new_content(spark, table(spark, f"{tmp_dir}/done"))
    assert {d for d, _, _ in done} == {"2023-11-03", "2023-12-03", "2024-02-03", "None"}
    count = S.StopsAfter(1 << 30)
    replace(spark, table(spark, f"{tmp_dir}/count"), count)
    moves = (1 << 30) - count.left
    assert moves > 8
    for k in range(1, moves + 1):
        path = table(spark, f"{tmp_dir}/once{k}")
        old = content(spark, path)
        with pytest.raises(OSError):
            replace(spark, path, FailsOnce(k))
        assert content(spark, path) == old  # undone
        assert swap.open_swaps(spark, path) == [] and not glob.glob(f"{path}/_seen*")

        path = table(spark, f"{tmp_dir}/stop{k}")
        with pytest.raises(OSError):
            replace(spark, path, S.StopsAfter(k - 1))  # undoing fails too, as when the process died
        if k == 1:  # nothing had moved
            assert content(spark, path) == old and swap.open_swaps(spark, path) == []
            continue
        assert len(swap.open_swaps(spark, path)) == 1
        swap.finish_swaps(spark, path)
        assert content(spark, path) == done and swap.open_swaps(spark, path) == []
        assert os.path.exists(f"{path}/_seen-1")


def test_finishing_may_fail_and_go_on(spark, tmp_dir, one_mover, monkeypatch):
    done = new_content(spark, table(spark, f"{tmp_dir}/done"))
    path = table(spark, tmp_dir)
    with pytest.raises(OSError):
        replace(spark, path, S.StopsAfter(2))
    for _ in range(30):  # a few moves at a time
        with monkeypatch.context() as m:
            m.setattr(swap, "move", S.StopsAfter(1))
            try:
                swap.finish_swaps(spark, path)
                break
            except OSError:
                pass
    assert content(spark, path) == done and swap.open_swaps(spark, path) == []


def test_a_swap_that_never_began_is_dropped_by_the_next_write(spark, tmp_dir):
    path = table(spark, tmp_dir)
    old = content(spark, path)
    left = f"{swap.new_swap(path)}"
    rows(spark, MONTHS, 9.0).write.parquet(f"{left}/new")  # the process died while writing
    append_hourly(rows(spark, ["2020-05"], 1.0), path)
    assert not os.path.exists(left)
    assert len(content(spark, path)) == len(old) + 2


@pytest.mark.parametrize("k", [0, 1])
def test_whole_table_replacement(spark, tmp_dir, one_mover, k):
    path = f"{tmp_dir}/t"
    spark.range(3).write.parquet(path)
    real = swap.move
    try:
        swap.move = S.StopsAfter(k)
        with pytest.raises(OSError):
            replace_table(spark.range(10, 14).toDF("id"), path)
    finally:
        swap.move = real
    swap.finish_swaps(spark, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == ([10, 11, 12, 13] if k else [0, 1, 2])
    replace_table(spark.range(10, 14).toDF("id"), path)
    replace_table(spark.read.parquet(path).where("id > 11"), path)  # from itself
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [12, 13]
    new = f"{tmp_dir}/first"  # a table that is not there yet
    replace_partitioned(rows(spark, MONTHS, 1.0), new)
    assert len(content(spark, new)) == 8


def test_tables_of_one_name_prefix_do_not_share_swaps(spark, tmp_dir):
    path, other = f"{tmp_dir}/hourly", f"{tmp_dir}/hourly_recent"
    left = swap.new_swap(other)
    rows(spark, MONTHS, 9.0).write.parquet(f"{left}/new")
    assert swap.open_swaps(spark, path) == [] and swap.open_swaps(spark, other) == [left]


@pytest.mark.parametrize("moves", [1, 4, 9])
def test_full_reset_leaves_the_live_tables_until_its_switch(spark, tmp_dir, one_mover, moves):
    from gaugeflow.plans.jobs import full_reset, refresh_marts, run_refresh, run_update
    from gaugeflow.sinks.tables import reset_tables, table_buckets
    from gaugeflow.sources.tables import read_daily, read_station_metadata

    sf = "/root/testdata/sf0.001"
    ev, cu, orders = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("events", "customer", "orders"))
    nav, ranges = S.nav_pages(orders, cu), S.series_ranges(orders, cu)
    pages, as_of = S.data_pages(ev, cu), dt.date(2024, 1, 30)
    wh = Warehouse(f"{tmp_dir}/wh")
    reset_tables(spark, wh, 3)
    run_refresh(spark, wh, nav, ranges, S.BASE_URL)
    run_update(spark, wh, pages.where(F.col("group") == "Pressure"), as_of, base_url=S.BASE_URL)
    before = content(spark, wh.hourly)
    assert before and len(swap.open_swaps(spark, wh.root)) == 0
    with pytest.raises(OSError):
        full_reset(spark, wh, nav, ranges, pages, as_of, S.BASE_URL, 2, mover=S.StopsAfter(moves))
    refresh_marts(spark, wh, as_of)  # the next run completes the switch
    assert table_buckets(spark, wh.hourly) == table_buckets(spark, wh.daily) == 2
    after = content(spark, wh.hourly)
    assert len(after) > len(before) and not set(before) - set(after)
    assert read_daily(spark, wh.daily).agg(F.sum("numObservations")).first()[0] == len(after)
    assert read_station_metadata(spark, wh.station_metadata).count() > 0
    assert not glob.glob(f"{tmp_dir}/*.swap-*")
