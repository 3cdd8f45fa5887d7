"""Page normalization (C1/E1), the update run (C2) and its properties."""

import datetime as dt

from gaugeflow.plans.normalize import normalize_pages
from gaugeflow.plans.update import update_hourly
from gaugeflow.schemas import HOURLY, PAGES, STATIONS

STATIONS_ROWS = [
    ("P_S", "Sarita", "Sarita", None, None, True, True, False, True, None, None, None),
]


def page(group, rows, station="Sarita", status=200, width_header=None):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    html = f'<table class="CenteredGrid"><tr><th>Time</th></tr>{body}</table>'
    return (group, station, f"http://h/{group}/{station}", status, html, dt.datetime(2024, 1, 31))


def run(spark, pages):
    st = spark.createDataFrame(STATIONS_ROWS, STATIONS)
    n = normalize_pages(spark.createDataFrame(pages, PAGES), st)
    status = {(r.group, r.url): (r.status, r.n_rows) for r in n.status.collect()}
    return sorted((tuple(r) for r in n.rows.collect()), key=lambda t: tuple("" if v is None else str(v) for v in t)), status


def test_two_streams_share_code(spark):
    rows, status = run(spark, [page("Hydrometric", [("Jan 04, 2024 10:15", "1.20**Estimated", "3.4")])])
    assert rows == [
        ("P_S", "Sarita", dt.date(2024, 1, 4), "10:15:00", 1.2, "Water Level", "21", ""),
        ("P_S", "Sarita", dt.date(2024, 1, 4), "10:15:00", 3.4, "Sensor Depth", "21", ""),
    ]
    assert status[("Hydrometric", "http://h/Hydrometric/Sarita")] == ("success", 2)


def test_null_second_stream_kept(spark):
    rows, _ = run(spark, [page("Temperature", [("Jan 04, 2024 10:00", "5.5", "")])])
    assert sorted((r[5], r[4]) for r in rows) == [("Air Temperature", 5.5), ("Water Temperature", None)]


def test_bad_pages_rejected_whole(spark):
    pages = [
        page("Pressure", [("Jan 04, 2024 10:00", "1", "2")]),  # pressure page of 3 columns
        page("Hydrometric", [("Jan 04, 2024 10:00", "1", "2", "3")]),  # 4 columns
        page("Temperature", [("Jan 04, 2024 10:00", "1"), ("Jan 04, 2024 11:00", "abc")]),  # bad number
        page("Temperature", [("Jan 04, 2024 10:00", "1")], station="Nowhere"),  # no such station
        page("Temperature", [("Jan 04, 2024 10:00", "1")], station="Sarita", status=404),
    ]
    pages[3] = ("Temperature", "Nowhere", "http://h/T/Nowhere", 200, pages[3][4], pages[3][5])
    pages[4] = ("Temperature", "Sarita", "http://h/T/404", 404, pages[4][4], pages[4][5])
    rows, status = run(spark, pages)
    assert rows == []
    assert status[("Pressure", "http://h/Pressure/Sarita")][0].startswith("Error: Length mismatch")
    assert status[("Hydrometric", "http://h/Hydrometric/Sarita")][0].startswith("Error: Length mismatch")
    assert status[("Temperature", "http://h/Temperature/Sarita")][0] == "Error: could not convert string to float: 'abc'"
    assert status[("Temperature", "http://h/T/Nowhere")][0] == "Error: single positional indexer is out-of-bounds"
    assert status[("Temperature", "http://h/T/404")][0] == "Error: link invalid"


def test_good_page_survives_bad_neighbour(spark):
    pages = [page("Temperature", [("Jan 04, 2024 10:00", "1")]), page("Pressure", [("Jan 04, 2024 10:00", "x")])]
    rows, _ = run(spark, pages)
    assert [r[5] for r in rows] == ["Water Temperature"]


def test_update_twice_equals_once(spark):
    st = spark.createDataFrame(STATIONS_ROWS, STATIONS)
    pages = spark.createDataFrame(
        [page("Hydrometric", [("Jan 28, 2024 10:00", "1.0", "2.0"), ("Jan 28, 2024 11:00", "1.5", "")])], PAGES
    )
    empty = spark.createDataFrame([], HOURLY)
    as_of = dt.date(2024, 1, 30)
    first = update_hourly(pages, st, empty, as_of, base_url="http://h/").new_rows.checkpoint()
    assert first.count() == 4
    second = update_hourly(pages, st, first, as_of, base_url="http://h/")
    assert second.new_rows.count() == 0
    assert {r.group: r.status for r in second.status.collect()} == {
        "Hydrometric": "success",
        "Pressure": "Error: link invalid",  # linked but no landed page
        "Temperature": "Error: link invalid",
    }


def test_rows_older_than_lookback_are_appended_again(spark):
    st = spark.createDataFrame(STATIONS_ROWS, STATIONS)
    pages = spark.createDataFrame([page("Hydrometric", [("Dec 01, 2023 10:00", "1.0", "2.0")])], PAGES)
    empty = spark.createDataFrame([], HOURLY)
    as_of = dt.date(2024, 1, 30)
    first = update_hourly(pages, st, empty, as_of, base_url="http://h/").new_rows.checkpoint()
    again = update_hourly(pages, st, first, as_of, days=30, base_url="http://h/").new_rows
    assert again.count() == 2


def test_first_error_is_column_major(spark):
    # row 1 has a bad second cell, row 2 a bad first cell: columns are
    # converted in order, so the first column's bad cell is reported
    rows, status = run(spark, [page("Hydrometric", [("Jan 04, 2024 10:00", "1", "bad2"), ("Jan 04, 2024 11:00", "bad1", "2")])])
    assert rows == []
    assert status[("Hydrometric", "http://h/Hydrometric/Sarita")][0] == "Error: could not convert string to float: 'bad1'"


def test_large_page_parses_in_linear_time(spark):
    import time

    rows = [(f"Jan 04, 2024 {h % 24:02d}:{m % 60:02d}", f"{m}.5", "") for h, m in zip(range(8000), range(8000))]
    body = "".join(f"<tr><td>{a}</td><td>{b}</td><td>{c}</td></tr>" for a, b, c in rows)
    html = f'<table class="CenteredGrid"><thead><tr><th>Time</th><th>A</th><th>B</th></tr></thead><tbody>{body}</tbody></table>'
    st = spark.createDataFrame(STATIONS_ROWS, STATIONS)
    pages = spark.createDataFrame([("Hydrometric", "Sarita", "u", 200, html, dt.datetime(2024, 1, 31))], PAGES)
    t0 = time.perf_counter()
    n = normalize_pages(pages, st).rows.count()
    assert n == 16000
    assert time.perf_counter() - t0 < 20


def test_nbsp_cell_is_missing_value(spark):
    rows, status = run(spark, [page("Temperature", [("Jan 04, 2024 10:00", "5.5", "&nbsp;")])])
    assert sorted((r[5], r[4]) for r in rows) == [("Air Temperature", 5.5), ("Water Temperature", None)]
    assert status[("Temperature", "http://h/Temperature/Sarita")][0] == "success"
