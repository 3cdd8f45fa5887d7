"""The daily mart maintained from a stream of new hourly rows.

The stored mart keeps, beside its columns, the sum and the number of the
values of every key, so a micro-batch is merged into it: the batch is
aggregated by key, joined by the stored rows of the (month, bucket) folders it
touches, and both are added up. Neither earlier batches nor other folders are
read. The folders and a mark of the merged batch replace the old ones in one
swap, so a batch that is run again is recognised and adds nothing. There is no
watermark: rows of any age, or without a date, count, and streams go on under a
new checkpoint.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.constants import DAILY_COLUMNS
from gaugeflow.operators.aggregate import DAILY_KEYS
from gaugeflow.schemas import DAILY
from gaugeflow.sinks.swap import exists, file_system, finish_swaps
from gaugeflow.sinks.tables import Staging, folder_ids, in_folders, overwrite_partitions, table_buckets, with_partitions
from gaugeflow.sources.tables import DAILY_STORED, read_table
from gaugeflow.streaming.common import run_available_now

SUMS = [T.StructField("value_sum", T.DoubleType()), T.StructField("value_count", T.LongType())]
STORED = T.StructType(DAILY.fields + SUMS + DAILY_STORED.fields[len(DAILY.fields):])


def partial_daily(hourly: DataFrame) -> DataFrame:
    """Sums, counts and greatest name per key of hourly rows (the name is folded
    in a second, small aggregation, as in ``daily_two_level``)."""
    by_name = hourly.groupBy(*DAILY_KEYS, "STATION_NAME").agg(
        F.sum("Value").alias("value_sum"), F.count("Value").alias("value_count"), F.count("Date").alias("numObservations"))
    return _merged(by_name)


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*DAILY_KEYS).agg(
        F.max("STATION_NAME").alias("STATION_NAME"), F.sum("value_sum").alias("value_sum"),
        F.sum("value_count").alias("value_count"), F.sum("numObservations").alias("numObservations"))


def merge_partials(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored daily rows with a batch's partial rows added, with their means."""
    columns = [*DAILY_KEYS, "STATION_NAME", "value_sum", "value_count", "numObservations"]
    both = _merged(stored.select(*columns).unionByName(batch.select(*columns)))
    mean = F.col("value_sum") / F.nullif("value_count", F.lit(0))
    return both.withColumn("Value", mean).select(*DAILY_COLUMNS, "value_sum", "value_count")


def last_merged(spark: SparkSession, path: str, run: str) -> int | None:
    """The last batch of a run that the mart at ``path`` holds."""
    if not exists(spark, path):
        return None
    fs, hadoop = file_system(spark, path)
    names = [re.fullmatch(rf"_merged-{run}-(\d+)", s.getPath().getName()) for s in fs.listStatus(hadoop(path))]
    return max((int(n[1]) for n in names if n), default=None)


def apply_batch(batch: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Merge one micro-batch of hourly rows into the mart, once."""
    spark = batch.sparkSession
    finish_swaps(spark, path)
    last = last_merged(spark, path, run)
    if last is not None and batch_id <= last:
        return
    buckets = table_buckets(spark, path)
    with Staging(spark) as stage:
        part = stage(partial_daily(batch))
        folders = folder_ids(with_partitions(part, buckets))
        if not folders:
            return
        stored = read_table(spark, STORED, path).where(in_folders(folders))
        mark = (f"_merged-{run}-{batch_id}", None if last is None else f"_merged-{run}-{last}")
        overwrite_partitions(merge_partials(stored, part), path, folders, buckets, mark=mark)


def stream_daily(hourly_stream: DataFrame, path: str, checkpoint: str) -> None:
    """Drain a stream of new hourly rows into the daily mart at ``path`` (one
    kept by this function: a mart of another job has no sums to add to)."""
    run = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    writer = (hourly_stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, i: apply_batch(df, path, run, i)))
    run_available_now(writer, "daily")
