"""The incremental update driven by a file stream of landed pages.

Each micro-batch of new page files runs the batch update (parse, link
filter, overlap anti-join against the stored table) and appends its new
rows. Rows are compared with everything stored in their months, so a retried
batch or replayed pages of any age append nothing again.

A link's pages may come in several batches: the greatest error of every link is
kept in a table beside the report and merged batch by batch. The maximum does
not change when a batch is merged again, so retries and restarts, under the
same checkpoint or a new one, leave the status of all pages seen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators.links import all_links
from gaugeflow.plans.normalize import PAGE_KEYS
from gaugeflow.plans.update import link_errors, outcome_of_errors, update_hourly
from gaugeflow.schemas import LINK_ERRORS, PAGES
from gaugeflow.sinks.swap import finish_swaps
from gaugeflow.sinks.tables import Staging, append_hourly, replace_table, write_report
from gaugeflow.sources.tables import read_hourly, read_table
from gaugeflow.streaming.common import new_checkpoint, run_available_now


def merge_errors(page_status: DataFrame, path: str) -> None:
    """Merge a batch's page statuses into the table of link errors (one row per
    link, so bounded by the station dimension)."""
    spark = page_status.sparkSession
    finish_swaps(spark, path)
    both = read_table(spark, LINK_ERRORS, path).unionByName(link_errors(page_status))
    replace_table(both.groupBy("group", "station_url_name").agg(F.max("error").alias("error")), path)


def stream_status(spark: SparkSession, stations: DataFrame, report_path: str, base_url: str = "") -> DataFrame:
    """Status per link of all pages that streams with this report have seen."""
    path = f"{report_path}-links"
    finish_swaps(spark, path)
    return outcome_of_errors(all_links(stations, base_url), read_table(spark, LINK_ERRORS, path))


def spread_pages(pages: DataFrame) -> DataFrame:
    """The pages dealt out over the tasks of a shuffle, the parts of about the
    same size. A batch is a few files, each read by few tasks however large,
    while parsing costs far more than moving the pages."""
    return pages.hint("rebalance", *PAGE_KEYS)


def stream_update(spark: SparkSession, pages_dir: str, stations: DataFrame, hourly_path: str, as_of=None,
                  base_url: str = "", checkpoint: str | None = None,
                  max_files: int = 1, report_path: str | None = None) -> None:
    """Drain the landed-pages folder into the hourly table.

    With ``report_path`` each micro-batch also writes the status of its
    landed pages (JSON under ``batch=<id>``; a retried batch overwrites its
    own report) and merges it into the links' status; when the folder is
    drained the run report (K7: status per link, all-valid flags) is written to
    ``<report_path>-run``.
    """
    stream = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", max_files).parquet(pages_dir)

    def batch(pages: DataFrame, batch_id: int) -> None:
        pages = spread_pages(pages)
        stored = read_hourly(spark, hourly_path, keep_partitions=True)
        with Staging(spark) as stage:
            result = update_hourly(pages, stations, stored, as_of, None, base_url, stage=stage)
            append_hourly(stage(result.new_rows), hourly_path)
            if report_path:
                result.page_status.write.mode("overwrite").json(f"{report_path}/batch={batch_id}")
                merge_errors(result.page_status, f"{report_path}-links")

    writer = stream.writeStream.option("checkpointLocation", checkpoint or new_checkpoint(spark, "update")).foreachBatch(batch)
    run_available_now(writer, "update")
    if report_path:
        status = stream_status(spark, stations, report_path, base_url)
        write_report(status, f"{report_path}-run", dt.datetime.now().isoformat(), "stream")
