"""Benchmark the headline queries.

Runs each headline query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line. Every query is fully
executed into Spark's ``noop`` sink (no collect to the driver); the time is
the median of ``$BENCH_REPEATS`` (default 3) runs after one warm-up run.
``jobs`` times the write jobs after a warm-up pass, on pages landed and tables
emptied before the clock starts, with the readings they parse or store a second.
With ``$BENCH_EVENT_LOG`` set to a folder, Spark's event log (stage and
task times) is written there; the web UI stays off.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaugeflow import catalog  # noqa: E402
from gaugeflow import standins as S  # noqa: E402
from gaugeflow.plans import jobs  # noqa: E402
from gaugeflow.plans.normalize import normalize_pages  # noqa: E402
from gaugeflow.session import build_session, checkpoint_root  # noqa: E402
from gaugeflow.sinks.tables import replace_table, reset_tables  # noqa: E402
from gaugeflow.sources.tables import Warehouse, read_hourly, read_pages  # noqa: E402

HEADLINE = [
    "daily",
    "daily_two_level",
    "new_rows",
    "new_rows_grouped",
    "to_long",
    "html_round_trip",
    "page_outcome",
    "nav_links",
    "refresh_stations",
    "replace_station",
    "update_pipeline",
]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def time_jobs(spark, sf_dir: str) -> dict[str, dict]:
    """Seconds and readings a second of parsing landed pages and of the jobs
    that write (each into a new warehouse; the second of two passes counts)."""
    root = tempfile.mkdtemp(prefix="gaugeflow-bench-")
    checkpoint_root(spark, fallback=f"{root}/checkpoints")
    customer = S.read_table(spark, sf_dir, "customer")
    stations = S.stations(customer)
    landed, out = f"{root}/pages", {}
    S.data_pages(S.read_table(spark, sf_dir, "events"), customer).write.parquet(landed)
    pages = read_pages(spark, landed)

    def timed(name, rows, fn):
        t0 = time.perf_counter()
        fn()
        took = time.perf_counter() - t0
        out[name] = {"sec": round(took, 3), "rows_per_sec": round(rows / took)}

    parsed = normalize_pages(pages, stations).rows
    for _ in range(2):  # the first pass warms up
        wh = Warehouse(tempfile.mkdtemp(dir=root))
        reset_tables(spark, wh)
        replace_table(stations, wh.station_metadata, stage=False)
        timed("parse_landed", parsed.count(), lambda: parsed.write.format("noop").mode("overwrite").save())
        timed("run_update", 1, lambda: jobs.run_update(spark, wh, pages, catalog.AS_OF, base_url=S.BASE_URL))
        stored = read_hourly(spark, wh.hourly).count()
        out["run_update"]["rows_per_sec"] = round(stored / out["run_update"]["sec"])
        timed("run_marts", stored, lambda: jobs.run_marts(spark, wh, catalog.AS_OF))
        timed("run_reset", stored, lambda: jobs.run_reset(spark, wh, pages, S.BASE_URL, catalog.AS_OF))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = build_session(f"local[{cpus}]", app="gaugeflow-bench", shuffle_partitions=int(cpus) * 2, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()
    times = {}
    for name in only or HEADLINE:
        fn = qs[name]
        run_once(spark, fn, sf_dir)  # warm-up: JIT, file listing, broadcast checks
        runs = [run_once(spark, fn, sf_dir) for _ in range(repeats)]
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "jobs": {} if only else time_jobs(spark, sf_dir),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
