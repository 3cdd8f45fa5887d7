"""Duplicate removal of a stream of hourly rows against its own table.

Unlike the table anti-join (J1), copies inside one batch collapse too. There
is no watermark: a row is compared with all stored rows of its month (rows
without a date with each other), so late rows are kept and their copies still
recognised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeflow.constants import HOURLY_COLUMNS
from gaugeflow.operators.dedup import new_rows
from gaugeflow.sinks.tables import append_hourly
from gaugeflow.sources.tables import month_key, read_hourly
from gaugeflow.streaming.common import run_available_now


def append_distinct(batch: DataFrame, path: str) -> None:
    """Append the batch's rows that the table at ``path`` does not hold, once each."""
    spark = batch.sparkSession
    rows = batch.select(*HOURLY_COLUMNS).distinct()
    months = rows.select(month_key().alias("month")).distinct()
    stored = read_hourly(spark, path, keep_partitions=True).join(months, "month", "left_semi")
    append_hourly(new_rows(rows, stored).checkpoint(), path)


def stream_dedup(hourly_stream: DataFrame, path: str, checkpoint: str) -> None:
    """Drain an hourly stream into the table at ``path`` without repeated rows."""
    writer = (hourly_stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, _id: append_distinct(df, path)))
    run_available_now(writer, "dedup")
