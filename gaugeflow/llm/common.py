"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.session import staging_path

# Arrow batches handed to Python are cut at this many rows or bytes, whichever
# comes first, so a run of very long texts does not fill a worker's memory.
ARROW_ROWS = "2000"
ARROW_BYTES = str(8 << 20)


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on (runtime-settable ones only)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: lineage ends there and a lost executor recomputes nothing before.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    """The text, a null as the empty string."""
    return F.coalesce(F.col(name), F.lit(""))


def uniform(*key: Column) -> Column:
    """A reproducible pseudorandom double in [0, 1) drawn from ``key``."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") / F.lit(float(1 << 53))


# Bits of an id filter at most (16 MB).
FILTER_BITS = 1 << 27
_PART = 1 << 15


def _filter_place(key: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(size))


def maybe_among(rows: DataFrame, key: str, ids: DataFrame, bits: int | None = None) -> DataFrame:
    """``rows`` with ``__maybe``: false only where ``key`` is none of the values of
    ``ids`` (one column of the key's type; a null counts as a value). The others
    are to be joined exactly, so that rows which cannot match are not shuffled.

    The values' hashes are marked in a bitmap of 16 bits and more a value, up to
    ``bits`` (FILTER_BITS); beyond that more rows are let through."""
    name, count = ids.columns[0], ids.count()
    size = min(FILTER_BITS if bits is None else bits, max(_PART, 1 << (16 * count).bit_length()))
    marks = (ids.select(_filter_place(F.col(name), size).alias("p"))
             .select(F.floor(F.col("p") / _PART).cast("int").alias("__part"), F.pmod("p", F.lit(_PART)).alias("at"))
             .repartition("__part").groupBy("__part").agg(F.bitmap_construct_agg("at").alias("__bits")))
    place = _filter_place(F.col(key), size)
    at = F.pmod(place, F.lit(_PART))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (rows.withColumn("__part", F.floor(place / _PART).cast("int"))
            .join(F.broadcast(stage(marks, "id-filter")), "__part", "left")
            .withColumn("__maybe", F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False)))
            .drop("__part", "__bits"))


def exclusive_sums(df: DataFrame, keys: list[str], index: str, value: str, out: str,
                   fan: int = 4096) -> DataFrame:
    """Add ``out``: the sum of ``value`` over rows of the same ``keys`` with a
    smaller ``index`` (integers from 0, unique per key, not null).

    Two levels: ranges of ``fan`` indexes are summed on their own, then the
    range totals; no window sorts more than ``fan`` rows or one row per range.
    ``keys`` must not be null.
    """
    high, inner, base = f"__{out}_high", f"__{out}_inner", f"__{out}_base"
    before = (Window.unboundedPreceding, -1)
    df = df.withColumn(high, F.floor(F.col(index) / F.lit(fan)).cast("long"))
    fine = Window.partitionBy(*keys, high).orderBy(index).rowsBetween(*before)
    coarse = Window.partitionBy(*keys).orderBy(high).rowsBetween(*before)
    totals = (df.groupBy(*keys, high).agg(F.sum(value).alias(base))
              .withColumn(base, F.coalesce(F.sum(base).over(coarse), F.lit(0))))
    return (df.withColumn(inner, F.coalesce(F.sum(value).over(fine), F.lit(0)))
            .join(totals.hint("merge"), [*keys, high])
            .withColumn(out, (F.col(inner) + F.col(base)).cast("long"))
            .drop(high, inner, base))
