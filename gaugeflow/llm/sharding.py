"""Sharding: minimax contiguous partition of ordered atomic groups.

Equal texts must share a shard, so the atomic groups are hash buckets of the
text: ``BUCKETS`` ordered buckets, a fixed number whatever the data's size.
Their byte sizes (at most 65,536 numbers) come to the driver, which searches
the smallest feasible shard capacity by bisection with a greedy check and cuts
there. Slots inside a shard are handed out by distributed prefix sums.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import exclusive_sums, stage, text_or_empty

BUCKETS = 65536
# Rows numbered by one window group; larger buckets are split by document id.
ROWS_PER_BIN = 256


def _greedy_ends(prefix: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Cuts (group counts) when every shard takes as much as fits, or None if
    ``shards`` shards of ``capacity`` cannot hold all groups."""
    ends, at = [], 0
    for _ in range(shards):
        at = int(np.searchsorted(prefix, (prefix[at - 1] if at else 0) + capacity, side="right"))
        ends.append(at)
        if at == len(prefix):
            return ends + [at] * (shards - len(ends))
    return None


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """The smallest capacity with which ``shards`` contiguous shards hold the
    ordered group ``sizes`` (bisection over the greedy check)."""
    sizes = np.asarray(sizes, dtype=np.int64)
    if not len(sizes):
        return 0
    prefix = np.cumsum(sizes)
    low = max(int(sizes.max()), -(-int(prefix[-1]) // shards))
    high = max(int(sizes.max()), int(prefix[-1]))
    while low < high:
        middle = (low + high) // 2
        if _greedy_ends(prefix, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def cut(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard number per ordered group. No shard exceeds the smallest feasible
    capacity; within that bound each cut lies as near as possible to an equal
    share of what is left (the greedy cut alone would starve the last shard)."""
    sizes = np.asarray(sizes, dtype=np.int64)
    out = np.zeros(len(sizes), dtype=np.int32)
    if not len(sizes):
        return out
    prefix = np.cumsum(sizes)
    capacity, total = smallest_capacity(sizes, shards), int(prefix[-1])
    # latest[k]: the fewest groups shards 0..k must hold so that the rest fits.
    back = np.cumsum(sizes[::-1])
    latest = [len(sizes) - e for e in _greedy_ends(back, capacity, shards)][::-1][1:] + [len(sizes)]
    at = 0
    for shard in range(shards):
        done = int(prefix[at - 1]) if at else 0
        most = int(np.searchsorted(prefix, done + capacity, side="right"))
        goal = done + (total - done) / (shards - shard)
        near = int(np.searchsorted(prefix, goal, side="left"))
        before = int(prefix[near - 1]) if near else 0
        if near < len(prefix) and prefix[near] - goal <= goal - before:
            near += 1
        end = min(max(near, latest[shard], at), most)
        out[at:end] = shard
        at = end
    return out


def assign_shards(docs: DataFrame, shards: int = 16, buckets: int = BUCKETS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text, null as none, plus 1),
    ``text_crc32``, ``law`` ("bytes"), ``shard``, ``slot`` (from 0 without gaps
    in each shard) and ``grown_shard`` (null: another shard count moves rows).

    Every row is kept, repeated rows too; rows of equal texts share a shard
    (a null and an empty text count as equal). Input columns of those names
    are replaced. An empty table gives an empty result. A null id is allowed.
    """
    added = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    body = text_or_empty(text_col)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]).alias("__row"),
        F.col(id_col).alias("__id"),
        (F.octet_length(body).cast("long") + 1).alias("__size"),
        F.crc32(body.cast("binary")).alias("__crc"),
        F.pmod(F.xxhash64(body), F.lit(buckets)).cast("int").alias("__bucket"))
    narrow = stage(rows.select("__id", "__size", "__bucket"), "shard-sizes")
    stats = (narrow.groupBy("__bucket").agg(F.sum("__size").alias("size"), F.count("*").alias("n"))
             .toPandas().sort_values("__bucket"))  # at most `buckets` rows
    stats["shard"] = cut(stats["size"].to_numpy(), shards)
    stats["first"] = (stats.groupby("shard")["n"].cumsum() - stats["n"]).astype("int64")
    stats["bins"] = (-(-stats["n"] // ROWS_PER_BIN)).astype("int64")
    spark = docs.sparkSession
    schema = "__bucket int, __shard int, __first long, __bins long"
    plan = (spark.createDataFrame(pd.DataFrame({"__bucket": stats["__bucket"], "__shard": stats["shard"],
                                                "__first": stats["first"], "__bins": stats["bins"]}), schema)
            if len(stats) else spark.createDataFrame([], schema))

    def binned(df):  # the plan has at most `buckets` rows of 24 bytes: broadcast is bounded
        return (df.join(F.broadcast(plan), "__bucket")
                .withColumn("__bin", F.pmod(F.xxhash64("__id", F.lit(17)), F.col("__bins"))))

    split = binned(narrow).filter("__bins > 1").groupBy("__bucket", "__bin").agg(F.count("*").alias("__n"))
    starts = (exclusive_sums(split, ["__bucket"], "__bin", "__n", "__start")
              .select("__bucket", "__bin", "__start"))
    order = Window.partitionBy("__bucket", "__bin").orderBy("__id", "__size", "__crc")
    return (binned(rows).join(stage(starts, "shard-starts"), ["__bucket", "__bin"], "left")
            .withColumn("__slot", F.col("__first") + F.coalesce("__start", F.lit(0))
                        + F.row_number().over(order) - 1)
            .select("__row.*", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
                    F.lit("bytes").alias("law"), F.col("__shard").alias("shard"),
                    F.col("__slot").cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
