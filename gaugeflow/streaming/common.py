"""Helpers shared by the streaming jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.session import staging_path


def table_stream(spark: SparkSession, folder: str, name: str, max_files: int = 1) -> DataFrame:
    """A file stream of the Parquet table ``name.parquet`` in ``folder``
    (the folder, filtered to that file name), with the table's schema."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .option("maxFilesPerTrigger", max_files)
        .parquet(folder)
    )


def run_available_now(writer, name: str) -> None:
    """Start a writer with ``availableNow`` and wait until it has drained."""
    query = writer.trigger(availableNow=True).queryName(f"{name}_{uuid.uuid4().hex[:8]}").start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def new_checkpoint(spark: SparkSession, name: str) -> str:
    """A fresh streaming checkpoint folder under the shared checkpoint root."""
    return staging_path(spark, f"{name}-checkpoint")
