"""Structured Streaming jobs: multi-batch results equal the batch results."""

import datetime as dt
import hashlib
import re

from pyspark.sql import functions as F

from gaugeflow import standins as S
from gaugeflow.operators.aggregate import daily
from gaugeflow.schemas import HOURLY
from gaugeflow.session import staging_path
from gaugeflow.sources.tables import read_daily, read_hourly
from gaugeflow.streaming.common import run_available_now
from gaugeflow.streaming.daily import stream_daily
from gaugeflow.streaming.dedup import stream_dedup
from gaugeflow.streaming.update import stream_update

SF = "/root/testdata/sf0.001"


def rounded(df):
    return {tuple(r) for r in df.withColumn("Value", F.round("Value", 6)).collect()}


def test_stream_daily_three_batches_equals_batch(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    cu = spark.read.parquet(f"{SF}/customer.parquet")
    hourly = S.hourly(ev, cu)
    src = staging_path(spark, "t-hourly-src")
    # three files with overlapping days, so later batches update earlier keys
    for lo, hi in [("2024-01-01", "2024-01-12"), ("2024-01-10", "2024-01-22"), ("2024-01-20", "2024-02-01")]:
        part = hourly.where((F.col("Date") >= F.lit(lo).cast("date")) & (F.col("Date") < F.lit(hi).cast("date")))
        part.write.mode("append").parquet(src)
    union = spark.read.schema(HOURLY).parquet(src)
    out = staging_path(spark, "t-daily-out")
    stream = spark.readStream.schema(HOURLY).option("maxFilesPerTrigger", 1).parquet(src)
    stream_daily(stream, out, staging_path(spark, "t-daily-ckpt"))
    assert rounded(read_daily(spark, out)) == rounded(daily(union))


def test_stream_dedup_collapses_in_batch_copies(spark):
    rows = [("P_A", "A", dt.date(2024, 1, 5), "01:00:00", 1.0, "Pressure", "", "")] * 3
    src = staging_path(spark, "t-dedup-src")
    spark.createDataFrame(rows, HOURLY).write.parquet(src)
    out = staging_path(spark, "t-dedup-out")
    stream = spark.readStream.schema(HOURLY).parquet(src)
    stream_dedup(stream, out, staging_path(spark, "t-dedup-ckpt"))
    # unlike the table anti-join (bag semantics), one copy is kept
    assert read_hourly(spark, out).count() == 1


def test_streams_keep_late_rows_under_new_checkpoints(spark):
    def land(*days):
        src = staging_path(spark, "t-late")
        for day, value in days:
            rows = [("P_A", "A", dt.date.fromisoformat(day), "01:00:00", value, "Pressure", "", "")]
            spark.createDataFrame(rows, HOURLY).coalesce(1).write.mode("append").parquet(src)
        return spark.readStream.schema(HOURLY).option("maxFilesPerTrigger", 1).parquet(src)

    out, distinct = staging_path(spark, "t-late-daily"), staging_path(spark, "t-late-distinct")
    runs = [(("2024-06-01", 1.0), ("2024-01-10", 1.0)), (("2020-01-01", 2.0), ("2020-02-01", 3.0)), (("2024-01-10", 9.0),)]
    for run in runs:
        stream_daily(land(*run), out, staging_path(spark, "t-late-ckpt"))
        stream_dedup(land(*run), distinct, staging_path(spark, "t-late-ckpt"))
    got = {(str(r.Date), r.Value, r.numObservations) for r in read_daily(spark, out).collect()}
    assert got == {("2024-06-01", 1.0, 1), ("2024-01-10", 5.0, 2), ("2020-01-01", 2.0, 1), ("2020-02-01", 3.0, 1)}
    stream_dedup(land(*runs[1]), distinct, staging_path(spark, "t-late-ckpt"))
    assert read_hourly(spark, distinct).count() == 5


def test_stream_update_replay_adds_nothing(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    cu = spark.read.parquet(f"{SF}/customer.parquet")
    pages_dir = staging_path(spark, "t-pages")
    S.data_pages(ev, cu).repartition(3).write.parquet(pages_dir)
    hourly_path = staging_path(spark, "t-stream-hourly")
    st = S.stations(cu)
    report = staging_path(spark, "t-stream-report")
    stream_update(spark, pages_dir, st, hourly_path, "2024-01-30", base_url=S.BASE_URL, max_files=1,
                  report_path=report)
    first = read_hourly(spark, hourly_path).count()
    statuses = spark.read.json(report)
    # one micro-batch per landed file, each reporting its pages
    assert statuses.select("batch").distinct().count() == 3
    from gaugeflow.operators.links import all_links

    wanted = S.data_pages(ev, cu).join(
        all_links(st, S.BASE_URL).select("group", "station_url_name"), ["group", "station_url_name"], "left_semi"
    )
    assert statuses.count() == wanted.count() > 0
    stream_update(spark, pages_dir, st, hourly_path, "2024-01-30", base_url=S.BASE_URL, max_files=1)
    assert read_hourly(spark, hourly_path).count() == first > 0


def undated(*values):
    return [("P_A", "A", None if d is None else dt.date.fromisoformat(d), None, v, "Pressure", "", "") for d, v in values]


def test_daily_batches_merge_once_with_null_dates_and_values(spark, tmp_dir):
    from gaugeflow.streaming.daily import apply_batch

    path = f"{tmp_dir}/mart"
    batches = [undated((None, 1.0), (None, 3.0), ("2024-01-01", None)),
               undated((None, None), ("2024-01-01", 5.0), ("2024-02-01", float("nan"))), [],
               undated(("2024-01-01", 7.0), ("2024-02-01", 1.0), (None, -0.5))]
    frames = [spark.createDataFrame(b, HOURLY) for b in batches]
    for i, b in enumerate(frames):
        apply_batch(b, path, "run", i)
        apply_batch(b, path, "run", i)  # run again after its merge
    for i, b in enumerate(frames[:2]):
        apply_batch(b, path, "run", i)  # an old batch
    everything = frames[0].union(frames[1]).union(frames[3])
    assert rounded(read_daily(spark, path).fillna(-9.0)) == rounded(daily(everything).fillna(-9.0))
    apply_batch(frames[0], path, "other", 0)  # another checkpoint's first batch
    assert rounded(read_daily(spark, path).fillna(-9.0)) == rounded(daily(everything.union(frames[0])).fillna(-9.0))


def test_daily_batch_that_fails_in_its_swap_counts_once(spark, tmp_dir, monkeypatch):
    import pytest

    from gaugeflow.sinks import swap
    from gaugeflow.streaming.daily import apply_batch

    monkeypatch.setattr(swap, "MOVERS", 1)
    path = f"{tmp_dir}/mart"
    one = spark.createDataFrame(undated(("2024-01-01", 1.0), ("2024-02-01", 2.0)), HOURLY)
    apply_batch(one, path, "run", 0)
    for moves in range(6):
        with monkeypatch.context() as m:
            m.setattr(swap, "move", S.StopsAfter(moves))
            with pytest.raises(OSError):
                apply_batch(one, path, "run", moves + 1)
        apply_batch(one, path, "run", moves + 1)  # the stream's retry
        assert {r.numObservations for r in read_daily(spark, path).collect()} == {moves + 2}


def test_daily_batch_reads_only_its_folders(spark, tmp_dir):
    from gaugeflow.sinks.tables import folder_ids, in_folders, with_partitions
    from gaugeflow.sources.tables import read_table
    from gaugeflow.streaming.daily import STORED, apply_batch, merge_partials, partial_daily

    path = f"{tmp_dir}/mart"
    old = spark.createDataFrame(undated(*[(f"2023-{m:02d}-01", 1.0) for m in range(1, 13)]), HOURLY)
    apply_batch(old, path, "run", 0)
    part = partial_daily(spark.createDataFrame(undated(("2023-05-01", 2.0)), HOURLY))
    stored = read_table(spark, STORED, path).where(in_folders(folder_ids(with_partitions(part))))
    plan = merge_partials(stored, part)
    files = [r[0] for r in stored.select(F.input_file_name()).collect()]
    assert len(files) == 1 and "month=2023-05" in files[0]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*month", text) and text.count("FileScan") == 1
    assert not glob_batches(path)


def glob_batches(path):
    import glob

    return glob.glob(f"{path}*/**/batch=*", recursive=True)


def test_dedup_with_null_dates(spark):
    src = staging_path(spark, "t-null-src")
    for values in ([(None, 1.0), (None, 1.0), ("2024-01-01", 1.0)], [(None, 1.0), (None, 2.0), ("2024-01-01", 1.0)]):
        spark.createDataFrame(undated(*values), HOURLY).coalesce(1).write.mode("append").parquet(src)
    out = staging_path(spark, "t-null-out")
    stream = spark.readStream.schema(HOURLY).option("maxFilesPerTrigger", 1).parquet(src)
    stream_dedup(stream, out, staging_path(spark, "t-null-ckpt"))
    assert sorted((str(r.Date), r.Value) for r in read_hourly(spark, out).collect()) == [
        ("2024-01-01", 1.0), ("None", 1.0), ("None", 2.0)]


def test_link_errors_merge_in_any_order_and_repeatedly(spark, tmp_dir):
    from gaugeflow.constants import STATUS_SUCCESS
    from gaugeflow.schemas import LINK_ERRORS
    from gaugeflow.sources.tables import read_table
    from gaugeflow.streaming.update import merge_errors

    def batch(*rows):
        return spark.createDataFrame([("g", link, "u", s, 1) for link, s in rows],
                                     "group string, station_url_name string, url string, status string, n_rows long")

    a = batch(("x", STATUS_SUCCESS), ("y", "Error: a"))
    b = batch(("x", STATUS_SUCCESS), ("y", "Error: b"), ("y", STATUS_SUCCESS), ("z", "Error: c"))
    got = []
    for i, order in enumerate(([a, b], [b, a, a], [a, b, b, a])):
        path = f"{tmp_dir}/links{i}"
        for part in order:
            merge_errors(part, path)
        got.append(sorted((r.station_url_name, r.error) for r in read_table(spark, LINK_ERRORS, path).collect()))
    assert got[0] == got[1] == got[2] == [("x", None), ("y", "Error: b"), ("z", "Error: c")]


def test_stream_update_deals_a_batch_out_before_the_parse(spark, tmp_dir, monkeypatch):
    """A batch of one file is read by one task, its pages are parsed by several."""
    from gaugeflow.schemas import PAGES
    from gaugeflow.streaming import update

    texts = ["".join(hashlib.sha512(f"{i} {j}".encode()).hexdigest() for j in range(20)) for i in range(300)]
    rows = [("Pressure", "A", None if i % 2 else f"u{i}", 200, f"<p>{t}</p>", dt.datetime(2024, 1, 1)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, PAGES).coalesce(1).write.parquet(f"{tmp_dir}/pages")
    seen, real = [], update.update_hourly

    def spy(pages, *args, **more):
        seen.append((pages.rdd.getNumPartitions(), sorted(r.html for r in pages.select("html").collect())))
        return real(pages, *args, **more)

    monkeypatch.setattr(update, "update_hourly", spy)
    stations = S.stations(spark.read.parquet(f"{SF}/customer.parquet"))
    stream_update(spark, f"{tmp_dir}/pages", stations, f"{tmp_dir}/hourly", "2024-01-30")
    assert [s[1] for s in seen] == [sorted(r[4] for r in rows)]
    assert seen[0][0] > 1
