"""Writers: append, replace, staged rewrite and the run report.

The hourly and daily tables are Parquet folders partitioned by ``month``
(``yyyy-MM`` of Date) and ``sbucket`` (hash bucket of the station). The number
of buckets is a property of the table, set when it is created and read back
from a marker beside its folder; all tables of a warehouse share it. Window
reads prune months; a station rewrite touches only its bucket's folders.
Station ids are never partition values themselves (their text would be
re-typed by partition discovery).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.constants import CSV_NULL
from gaugeflow.operators.links import all_valid
from gaugeflow.session import staging_path
from gaugeflow.operators.dedup import new_rows
from gaugeflow.schemas import CONSUMED, FOLDER_INDEX
from gaugeflow.sinks.swap import commit_swap, delete as _delete, exists, file_system as _file_system, finish_swaps, new_swap
from gaugeflow.sources.tables import PARTITION_COLUMNS, Warehouse, index_path, month_key, read_hourly, read_table

# Buckets of a table created without a number. A station reset rewrites one
# bucket of each touched month, so large tables are created with more.
STATION_BUCKETS = 16


def station_bucket(station: Column | str = "STATION_NUMBER", buckets: int = STATION_BUCKETS) -> Column:
    """Hash bucket (0..buckets-1) of a station id, the second partition column."""
    c = F.col(station) if isinstance(station, str) else station
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def with_partitions(df: DataFrame, buckets: int = STATION_BUCKETS) -> DataFrame:
    """Add the partition columns: ``month`` (yyyy-MM of Date, a folder of its
    own for null dates) and ``sbucket``."""
    return (df.withColumn("month", month_key())
            .withColumn("sbucket", station_bucket(buckets=buckets)))


def table_buckets(spark: SparkSession, path: str) -> int:
    """The table's number of station buckets (the default for a table that has no marker)."""
    fs, hadoop = _file_system(spark, path)
    parent, name = hadoop(path).getParent(), hadoop(path).getName()
    if fs.exists(parent):
        for status in fs.listStatus(parent):
            found = re.fullmatch(re.escape(name) + r"\.buckets-(\d+)", status.getPath().getName())
            if found:
                return int(found[1])
    return STATION_BUCKETS


def set_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Record the number of station buckets of a table that holds no rows yet."""
    fs, hadoop = _file_system(spark, path)
    fs.delete(hadoop(f"{path}.buckets-{table_buckets(spark, path)}"), False)
    fs.create(hadoop(f"{path}.buckets-{buckets}"), True).close()


def folder_ids(df: DataFrame) -> list[tuple[str, int]]:
    """Distinct (month, sbucket) folder ids of ``df`` (which has those
    columns). The list is bounded by the table's folder count (months x
    buckets), not by its rows; it becomes a literal partition filter."""
    return sorted({(r["month"], r["sbucket"]) for r in df.select(*PARTITION_COLUMNS).distinct().collect()})


def in_folders(ids: list[tuple[str, int]]) -> Column:
    """Partition predicate selecting the given (month, sbucket) folders; it is
    evaluated on folder names at planning time, so other folders are not
    listed or read."""
    if not ids:
        return F.lit(False)
    months = sorted({m for m, _ in ids})
    pairs = F.struct(F.col("month"), F.col("sbucket"))
    return F.col("month").isin(months) & pairs.isin([F.struct(F.lit(m), F.lit(b)) for m, b in ids])


_WRITE_ORDER = ["month", "sbucket", "STATION_NUMBER", "Date", "Time"]


def _clustered(df: DataFrame, buckets: int) -> DataFrame:
    """Rebalance rows on their folder before a write.

    The REBALANCE hint hashes on (month, sbucket) so a folder gets files from
    few tasks (no file per task and folder); AQE then splits a skewed folder
    (a hot station) over several tasks and coalesces small ones, without a
    sampling pass. Rows are sorted by station and time inside each file for
    row-group statistics."""
    order = [c for c in _WRITE_ORDER if c in PARTITION_COLUMNS or c in df.columns]
    return with_partitions(df, buckets).hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(*order)


def write_partitioned(df: DataFrame, path: str, mode: str, buckets: int | None = None) -> None:
    """Write by (month, sbucket), few files per folder; ``buckets`` is by
    default the table's own number."""
    buckets = buckets or table_buckets(df.sparkSession, path)
    _clustered(df, buckets).write.mode(mode).partitionBy(*PARTITION_COLUMNS).parquet(path)


def append_hourly(rows: DataFrame, path: str) -> None:
    """K1: append new rows in one write (atomic per job, not per page)."""
    finish_swaps(rows.sparkSession, path)
    note_folders(rows, path)
    write_partitioned(rows, path, "append")


def append_recorded(rows: DataFrame, accepted: DataFrame, wh: Warehouse,
                    mover: Callable[[SparkSession, str, str], None] | None = None) -> None:
    """K1 with its record: new hourly rows and the pages they came from
    (``CONSUMED``) are written beside the tables and appear by one journalled
    swap of files, so a run that failed has appended and recorded its pages or
    done neither."""
    spark = rows.sparkSession
    finish_swaps(spark, *wh.tables)
    note_folders(rows, wh.hourly)
    swap = new_swap(wh.root)
    new = f"{swap}/new"
    write_partitioned(rows, f"{new}/hourly", "errorifexists", table_buckets(spark, wh.hourly))
    accepted.hint("rebalance", "landed").write.partitionBy("landed").parquet(f"{new}/consumed")
    commit_swap(spark, swap, wh.root, {name: True for name in _data_files(spark, new)}, mover)


def _data_files(spark: SparkSession, root: str) -> list[str]:
    """Data files under a folder, as relative names (their names are unique to a write)."""
    fs, hadoop = _file_system(spark, root)
    base = fs.makeQualified(hadoop(root)).toString()
    files, names = fs.listFiles(hadoop(root), True), []
    while files.hasNext():
        path = files.next().getPath()
        if path.getName().startswith("part-"):
            names.append(path.toString()[len(base) + 1:])
    return names


def forget_pages(spark: SparkSession, wh: Warehouse, names: DataFrame) -> None:
    """Drop the record of the pages of stations (station_url_name) whose stored
    rows are about to be replaced, so that such pages can be landed again."""
    kept = read_table(spark, CONSUMED, wh.consumed).join(names, "station_url_name", "left_anti")
    finish_swaps(spark, wh.consumed)
    if exists(spark, wh.consumed):
        swap = new_swap(wh.consumed)
        kept.select(*CONSUMED.names).hint("rebalance", "landed").write.partitionBy("landed").parquet(f"{swap}/new")
        commit_swap(spark, swap, wh.consumed, {"": True})


def create_empty(spark: SparkSession, schema: T.StructType, path: str, partitioned: bool = False,
                 buckets: int | None = None) -> None:
    """K3: (re)create a table with no rows; a partitioned one gets ``buckets``
    station buckets (by default it keeps its number)."""
    finish_swaps(spark, path)
    empty = spark.createDataFrame([], schema)
    if partitioned:
        set_buckets(spark, path, buckets or table_buckets(spark, path))
        write_partitioned(empty, path, "overwrite")
    else:
        empty.write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, path: str, stage: bool = True) -> None:
    """K2/K5: replace a whole table: the result is written completely before
    the stored folder is moved aside, so a table can be rebuilt from itself and
    a failure keeps its rows. ``stage`` False writes over it at once (for
    outputs that any run can make again)."""
    if not stage:
        df.write.mode("overwrite").parquet(path)
        return
    finish_swaps(df.sparkSession, path)
    swap = new_swap(path)
    df.write.parquet(f"{swap}/new")
    commit_swap(df.sparkSession, swap, path, {"": True})


def replace_partitioned(df: DataFrame, path: str, buckets: int | None = None) -> None:
    """The same for a table of (month, sbucket) folders."""
    spark = df.sparkSession
    finish_swaps(spark, path)
    swap = new_swap(path)
    write_partitioned(df, f"{swap}/new", "errorifexists", buckets or table_buckets(spark, path))
    commit_swap(spark, swap, path, {"": True})


def overwrite_partitions(df: DataFrame, path: str, touched: list[tuple[str, int]] | None = None,
                         buckets: int | None = None, mark: tuple[str, str | None] | None = None,
                         mover: Callable[[SparkSession, str, str], None] | None = None) -> None:
    """Rewrite only the (month, sbucket) folders present in ``df``: one clustered
    write beside the table (so it can be rewritten from its own rows), whose
    folders then replace the table's in one journalled swap.

    ``touched``: folder ids that must end up holding exactly ``df``'s rows;
    those that ``df`` leaves empty are deleted. ``mark`` (a name and the one it
    follows, if any) is an empty file set in the table's folder by the same swap.
    ``mover`` moves a folder (the file system's rename).
    """
    spark = df.sparkSession
    finish_swaps(spark, path)
    swap = new_swap(path)
    write_partitioned(df, f"{swap}/new", "errorifexists", buckets or table_buckets(spark, path))
    full = with_partitions(df)
    written = folder_ids(spark.read.schema(full.schema).parquet(f"{swap}/new"))
    folders = {f"month={month}/sbucket={bucket}": (month, bucket) in written
               for month, bucket in set(written) | set(touched or [])}
    if mark:
        name, before = mark
        fs, hadoop = _file_system(spark, path)
        fs.create(hadoop(f"{swap}/new/{name}"), True).close()
        folders |= ({before: False} if before else {}) | {name: True}
    commit_swap(spark, swap, path, folders, mover)


# The folder index: distinct (STATION_NUMBER, Parameter, month) of the hourly
# table by bucket. It may name folders that no longer hold a pair (a job that
# failed), never leave one out: entries are written before the rows.


def index_entries(df: DataFrame) -> DataFrame:
    return df.select(*FOLDER_INDEX.names).distinct()


def create_index(spark: SparkSession, path: str) -> None:
    """The folder index of the table at ``path``, built from its rows (one scan
    of two columns); tables of ``reset_tables`` have one from the start. Rows
    that other tools write into the table need it built again."""
    index = index_path(path)
    finish_swaps(spark, path, index)
    swap = new_swap(index)
    (index_entries(read_hourly(spark, path, keep_partitions=True)).hint("rebalance", "sbucket")
     .write.partitionBy("sbucket").parquet(f"{swap}/new"))
    commit_swap(spark, swap, index, {"": True})


def note_folders(rows: DataFrame, path: str) -> None:
    """Enter the folders that hourly ``rows`` are about to be written to, those
    that are not listed yet (a table without an index stays so)."""
    finish_swaps(rows.sparkSession, index_path(path))
    if exists(rows.sparkSession, index_path(path)):
        with Staging(rows.sparkSession) as stage:
            note_entries(stage(index_entries(with_partitions(rows, table_buckets(rows.sparkSession, path)))), path)


def note_entries(entries: DataFrame, path: str) -> None:
    """The same from the rows' distinct (station, parameter, month) and bucket, written once."""
    spark, index = entries.sparkSession, index_path(path)
    finish_swaps(spark, index)
    if not exists(spark, index):
        return
    with Staging(spark) as stage:
        listed = read_table(spark, FOLDER_INDEX, index).where(F.col("sbucket").isin(_buckets_of(entries)))
        fresh = stage(new_rows(entries, listed))
        if not fresh.isEmpty():
            fresh.hint("rebalance", "sbucket").write.mode("append").partitionBy("sbucket").parquet(index)


def _buckets_of(df: DataFrame) -> list[int]:
    """Distinct station buckets (at most the table's number of them)."""
    return sorted(r[0] for r in df.select("sbucket").distinct().collect())


def folders_holding(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(month, sbucket) folders of the hourly table at ``path`` that hold rows of
    ``keys`` (STATION_NUMBER, Parameter). Read from the keys' buckets of the index;
    without one, from two columns of these buckets in all months."""
    placed = keys.select("STATION_NUMBER", "Parameter", station_bucket(buckets=table_buckets(spark, path)).alias("sbucket"))
    if exists(spark, index_path(path)):
        held = read_table(spark, FOLDER_INDEX, index_path(path))
    else:
        held = read_hourly(spark, path, keep_partitions=True)
    held = held.where(F.col("sbucket").isin(_buckets_of(placed)))
    return held.join(keys, ["STATION_NUMBER", "Parameter"], "left_semi").select(*PARTITION_COLUMNS).distinct()


def refresh_index(spark: SparkSession, path: str, folders: list[tuple[str, int]]) -> None:
    """Make the index exact for folders that were just rewritten: their buckets'
    entries are read from the new rows, those of other months are kept."""
    index = index_path(path)
    finish_swaps(spark, index)
    if not folders or not exists(spark, index):
        return
    hit = sorted({b for _, b in folders})
    kept = read_table(spark, FOLDER_INDEX, index).where(F.col("sbucket").isin(hit) & ~in_folders(folders))
    written = read_hourly(spark, path, keep_partitions=True).where(in_folders(folders))
    swap = new_swap(index)
    (index_entries(kept.unionByName(index_entries(written))).hint("rebalance", "sbucket")
     .write.partitionBy("sbucket").parquet(f"{swap}/new"))
    left = set(_buckets_of(spark.read.schema(FOLDER_INDEX).parquet(f"{swap}/new")))
    commit_swap(spark, swap, index, {f"sbucket={b}": b in left for b in hit})


# Folders whose marts are to be refreshed, with the mart's name.
PENDING = T.StructType([T.StructField("mart", T.StringType()), T.StructField("month", T.StringType()),
                        T.StructField("sbucket", T.IntegerType())])
MARTS = ("daily", "recent")


def mark_pending(spark: SparkSession, wh: Warehouse, folders: list[tuple[str, int]]) -> None:
    """Record the folders a job is about to change, before it changes them, so
    that a run after a failure still refreshes their marts."""
    if folders:
        rows = [(mart, month, bucket) for mart in MARTS for month, bucket in folders]
        spark.createDataFrame(rows, PENDING).coalesce(1).write.mode("append").parquet(wh.pending)


def pending_folders(spark: SparkSession, wh: Warehouse, mart: str) -> list[tuple[str, int]]:
    """Recorded folders of a mart (bounded by the table's folder count)."""
    fs, hadoop = _file_system(spark, wh.pending)
    if not fs.exists(hadoop(wh.pending)):
        return []
    return folder_ids(spark.read.schema(PENDING).parquet(wh.pending).where(F.col("mart") == mart))


def clear_pending(spark: SparkSession, wh: Warehouse, mart: str) -> None:
    """Forget a mart's recorded folders once they are refreshed."""
    rest = [(m, *f) for m in MARTS if m != mart for f in pending_folders(spark, wh, m)]
    if rest:
        spark.createDataFrame(rest, PENDING).coalesce(1).write.mode("overwrite").parquet(wh.pending)
    else:
        _delete(spark, wh.pending)


def drop_months_before(spark: SparkSession, path: str, month: str) -> list[str]:
    """Delete the ``month=...`` folders of a partitioned table older than
    ``month`` (``yyyy-MM``); returns the months removed. Only the folder
    names are listed (one entry per month), no data is read."""
    fs, hadoop = _file_system(spark, path)
    root = hadoop(path)
    if not fs.exists(root):
        return []
    removed = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("month=") and name[len("month="):] < month:
            fs.delete(status.getPath(), True)
            removed.append(name[len("month="):])
    return removed


class Staging:
    """Staged copies of one job: called with a DataFrame it writes it once as
    Parquet in the shared checkpoint folder and returns it read back; leaving
    the ``with`` block deletes the copies."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame) -> DataFrame:
        path = staging_path(self.spark, "rows")
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc) -> None:
        for path in self.paths:
            _delete(self.spark, path)


def write_station_csv(stations: DataFrame, path: str) -> None:
    """K6: station dimension as CSV with header and ``NA`` for nulls."""
    stations.write.mode("overwrite").option("header", "true").option("nullValue", CSV_NULL).csv(path)


def write_report(status: DataFrame, path: str, run_at: str, run_kind: str) -> None:
    """K7: the run report as two small JSON tables: the per-link status and
    one summary row per group (all-valid flag, run time and kind)."""
    status = status.checkpoint()  # small: one row per link
    status.write.mode("overwrite").json(f"{path}/status")
    summary = all_valid(status).select(
        "group", "all_valid", F.lit(run_at).alias("run_at"), F.lit(run_kind).alias("run_kind")
    )
    summary.write.mode("overwrite").json(f"{path}/summary")


def reset_tables(spark: SparkSession, wh: Warehouse, buckets: int | None = None) -> None:
    """K8: empty every table of the warehouse (drop + recreate), with ``buckets``
    station buckets (by default as many as before)."""
    from gaugeflow.schemas import DAILY, HOURLY, STATIONS

    buckets = buckets or table_buckets(spark, wh.hourly)
    create_empty(spark, HOURLY, wh.hourly, True, buckets)
    create_index(spark, wh.hourly)
    create_empty(spark, DAILY, wh.daily, True, buckets)
    create_empty(spark, HOURLY, wh.hourly_recent, True, buckets)
    create_empty(spark, STATIONS, wh.station_metadata)
    _delete(spark, wh.consumed)
    _delete(spark, wh.pending)
