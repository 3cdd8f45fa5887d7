"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes; chunks end where masked bits are zero,
with a strict mask before the normal size and a loose one after it (normalised
chunking). The fingerprint is the set of chunk digests with their lengths;
likeness is the share of a document's chunk bytes that the other set holds
(containment), so shifted text keeps its chunks.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import text_or_empty

MIN_BYTES, NORMAL_BYTES, MAX_BYTES = 32, 96, 512
STRICT_MASK, LOOSE_MASK = 0xFF000000, 0xF8000000  # 1/256 and 1/32 of all positions
# Ranges hold about this many rows; with more rows than MAX_RANGES of them the
# ranges grow instead (their rows are sorted with spilling and streamed), so the
# list of range starts, which is collected and broadcast, has a fixed bound.
ROWS_PER_BIN, MAX_RANGES = 4000, 1 << 16

SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def _gear_table() -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], dtype=np.uint32)


_GEAR = _gear_table()


def gear_hashes(data: bytes) -> np.ndarray:
    """Gear hash after each byte: the sum of the last 32 bytes' table values,
    each shifted left by its age, built by doubling the window."""
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    for width in (1, 2, 4, 8, 16):
        if len(h) > width:
            grown = h.copy()
            grown[width:] += h[:-width] << np.uint32(width)
            h = grown
    return h


def chunk_ends(data: bytes) -> list[int]:
    """End offsets of the chunks of ``data``, in order."""
    n = len(data)
    hashes = gear_hashes(data)
    loose = np.flatnonzero((hashes & np.uint32(LOOSE_MASK)) == 0)
    strict = loose[(hashes[loose] & np.uint32(STRICT_MASK)) == 0].tolist()
    loose = loose.tolist()
    ends, at = [], 0
    while n - at > MIN_BYTES:
        normal, end = at + NORMAL_BYTES, min(at + MAX_BYTES, n)
        i = bisect_left(strict, at + MIN_BYTES - 1)
        if i < len(strict) and strict[i] + 1 <= min(normal, end):
            end = strict[i] + 1
        else:
            i = bisect_left(loose, normal)
            if i < len(loose) and loose[i] + 1 < end:
                end = loose[i] + 1
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return ends


def chunks(text: str) -> dict[int, int]:
    """Chunk digest to chunk length."""
    data = text.encode()
    out, at = {}, 0
    for end in chunk_ends(data):
        out[xxhash.xxh3_64_intdigest(data[at:end])] = end - at
        at = end
    return out


def as_string(parts: dict[int, int]) -> str:
    """The fingerprint written out: sorted digest:length items."""
    return ",".join(f"{d:016x}:{n}" for d, n in sorted(parts.items()))


def containment(of: dict[int, int], within: dict[int, int]) -> float:
    """Share of ``of``'s chunk bytes found in ``within``; two empty sets are
    alike (1.0), an empty and a filled one are not (0.0)."""
    if not of:
        return 0.0 if within else 1.0
    return sum(n for d, n in of.items() if d in within) / sum(of.values())


def _fingerprinted(batches):
    """Rows sorted by document; each is matched with the row after it. Rows
    marked ``witness`` only close the partition."""
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

    last, rows = None, []
    for batch in batches:
        for doc_id, text, witness in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "witness"))):
            parts = chunks(text)
            if last is not None:
                own_id, own_text, own = last
                n = len(own_text)
                cut = n // 4
                edited = own_text[:n - cut] + text[:cut]
                edited_parts = chunks(edited)
                rows.append((own_id, n, hashlib.sha256(edited.encode()).hexdigest(), as_string(own),
                             as_string(edited_parts), containment(own, edited_parts), containment(own, parts)))
                if len(rows) >= 500:
                    yield batch_of(rows)
                    rows = []
            last = None if witness else (doc_id, text, parts)
    if rows:
        yield batch_of(rows)


def _bin_column(starts: list[int]):
    bounds = np.array(starts[1:], dtype=np.int64)

    @F.pandas_udf("int")
    def place(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), side="right").astype("int32"))
    return place


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row of ``docs`` (doc_id, text; others unused) and of
    its edited text: the last quarter replaced by the start of the next
    document in ascending doc_id (after the last, the first).

    A null text is empty; a null doc_id sorts last; rows with one doc_id follow
    each other in text order; a single row is its own next. An empty table gives
    an empty result.

    Documents are range-partitioned once by doc_id. The first row of every
    range is sent to the range before it as well. There are at most MAX_RANGES
    ranges, whatever the table's size.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("key"))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], SCHEMA)
    parts = min(MAX_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_BIN)))
    # one number per range, MAX_RANGES at most, comes to the driver
    starts = sorted(r[0] for r in rows.select("key").repartitionByRange(parts, "key")
                    .groupBy(F.spark_partition_id()).agg(F.min("key").alias("k")).select("k").collect())
    placed = rows.withColumn("bin", _bin_column(starts)("key"))
    heads = spark.createDataFrame([(k, (b - 1) % len(starts)) for b, k in enumerate(starts)], "key long, target int")
    # one row per range: its smallest text among those of its first id; MAX_RANGES
    # pairs of numbers are broadcast at most
    first = (placed.join(F.broadcast(heads), "key")
             .groupBy("key", "target").agg(F.min("text").alias("text"), F.min("doc_id").alias("doc_id"))
             .select("doc_id", "text", "key", F.col("target").alias("bin"), F.lit(True).alias("witness")))
    return (placed.withColumn("witness", F.lit(False)).unionByName(first)
            .repartitionById(len(starts), F.col("bin"))
            .sortWithinPartitions("witness", "key", "text")
            .select("doc_id", "text", "witness")
            .mapInArrow(_fingerprinted, SCHEMA))
