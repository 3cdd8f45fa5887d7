"""Full-row, null-safe removal of rows already stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups of identical new rows larger than this are expanded by chunks that
# are spread over tasks, so one hot group never lands in one task.
REPLICATE_CHUNK = 8192


def replicate_rows(df: DataFrame, count_col: str, chunk: int = REPLICATE_CHUNK) -> DataFrame:
    """Emit each row ``count_col`` times (the count column is dropped).

    Rows with a count up to ``chunk`` are expanded in place; larger counts
    are first cut into chunk descriptors which are hash-spread over the
    shuffle partitions, then expanded, so no task expands a huge group.
    """
    cols = [c for c in df.columns if c != count_col]
    n = F.col(count_col)
    small = df.where(n <= chunk).select(*cols, F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("_r"))
    big = (
        df.where(n > chunk)
        .select(*cols, n.alias("_n"), F.explode(F.sequence(F.lit(0), ((n - 1) / chunk).cast("long"))).alias("_c"))
        .withColumn("_len", F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_c") * chunk))
        .repartition("_c", *cols)
        .select(*cols, F.explode(F.sequence(F.lit(1), F.col("_len").cast("int"))).alias("_r"))
    )
    return small.unionByName(big).drop("_r")


def new_rows_joined(incoming: DataFrame, current: DataFrame) -> DataFrame:
    """Left anti-join on every column with null-safe equality. No hint: Spark
    broadcasts the stored side when its measured size allows and otherwise
    shuffles both sides. Duplicates inside ``incoming`` are all kept, values
    come out as they came in (a -0.0 stays one, though it equals 0.0)."""
    cols = incoming.columns
    left = incoming.alias("_new")
    right = current.select(*cols).alias("_old")
    cond = [F.col(f"_new.`{c}`").eqNullSafe(F.col(f"_old.`{c}`")) for c in cols]
    return left.join(right, cond, "left_anti").select(*[F.col(f"_new.`{c}`").alias(c) for c in cols])


def new_rows_grouped(incoming: DataFrame, current: DataFrame) -> DataFrame:
    """The same anti-join as a grouped pass, for heavily repeated rows.

    Both sides are tagged and grouped on all columns (grouping is null-safe
    and treats NaN as equal to NaN, as the original merge does). Partial
    aggregation collapses copies before the shuffle, so a hot group of
    identical rows is one row per task; groups never seen in ``current``
    are expanded back to their multiplicity. Grouping writes -0.0 as 0.0, so
    the signs of zeros are grouped along and put back.
    """
    cols = incoming.columns
    floats = [f.name for f in incoming.schema.fields if f.dataType.typeName() in ("double", "float")]
    signs = F.concat_ws("", *[F.when(F.col(f"`{c}`").cast("string") == "-0.0", "-").otherwise("+") for c in floats])
    new = incoming.select(*cols, signs.alias("_signs"), F.lit(1).cast("long").alias("_n"), F.lit(False).alias("_seen"))
    old = current.select(*cols, F.lit("").alias("_signs"), F.lit(0).cast("long").alias("_n"), F.lit(True).alias("_seen"))
    grouped = (
        new.unionByName(old)
        .groupBy(*cols, "_signs")
        .agg(F.sum("_n").alias("_n"), F.max("_seen").alias("_seen"))
        # per row at most two signs of each floating-point column
        .groupBy(*cols)
        .agg(F.max("_seen").alias("_seen"), F.collect_list(F.struct("_signs", "_n")).alias("_kinds"))
        .where(~F.col("_seen"))
        .select(*cols, F.explode("_kinds").alias("_kind"))
        .select(*cols, "_kind._signs", "_kind._n")
    )
    for i, c in enumerate(floats):
        negative = F.substring("_signs", i + 1, 1) == "-"
        grouped = grouped.withColumn(c, F.when(negative, F.lit(-0.0).cast(incoming.schema[c].dataType)).otherwise(F.col(f"`{c}`")))
    return replicate_rows(grouped.select(*cols, "_n"), "_n").select(*cols)


def new_rows(incoming: DataFrame, current: DataFrame, how: str = "auto") -> DataFrame:
    """Rows of ``incoming`` that do not equal (on every column, nulls equal)
    any stored row in ``current``.

    ``how``: ``auto`` (the join, planned by measured sizes) or ``grouped``;
    both give the same rows.
    """
    if how == "auto":
        return new_rows_joined(incoming, current)
    if how == "grouped":
        return new_rows_grouped(incoming, current)
    raise ValueError(f"unknown strategy {how!r}")
