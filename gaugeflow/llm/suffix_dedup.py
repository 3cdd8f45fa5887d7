"""Suffix-array dedup: remove every byte covered by a long repeated string.

Suffixes that could share ``min_bytes`` bytes must meet in one task. Each
window of that length is keyed by its anchor, the smallest of its ``GRAM``-byte
hashes (leftmost on ties), so equal windows have equal anchors at equal
offsets. Consecutive windows with one anchor form a region of text. Only
regions whose anchor occurs twice or more go on; equal regions are folded to
one with a count. A task sorts the suffixes of its regions in two stages
(``suffix_array``) and marks starts whose common prefix with a neighbour
reaches the length. An anchor with very many different regions is split by
offset, keyed by the longer string that windows of near offsets share.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage, text_or_empty
from gaugeflow.llm.suffix_array import repeated_starts

MIN_BYTES, GRAM = 200, 48
# An anchor with more different regions than this is split by window offset,
# into cells of these widths level by level; at width 1 the key is the window.
HOT_REGIONS = 128
CELLS = (32, 8, 2, 1)
# Text a task hashes or sorts at once (or one document, one anchor).
BATCH_BYTES, BLOCK_BYTES = 1 << 20, 4 << 20

_MULT = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULT, -1, 1 << 64)
_TABLE = np.array([xxhash.xxh64_intdigest(bytes([b]), seed=3) for b in range(256)], dtype=np.uint64)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at each place (polynomial over prefix sums)."""
    n = len(data)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    power = np.full(n, _MULT, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * power, out=sums[1:])
    back = np.full(n - size + 1, _INVERSE, dtype=np.uint64)
    back[0] = 1
    h = (sums[size:] - sums[:n - size + 1]) * np.multiply.accumulate(back)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value in each run of ``width`` values."""
    at, low, size = np.arange(len(values)), values, 1
    while 2 * size <= width:
        right = low[size:] < low[:-size]
        at, low, size = np.where(right, at[size:], at[:-size]), np.where(right, low[size:], low[:-size]), 2 * size
    rest = width - size
    if rest:
        at = np.where(low[rest:] < low[:-rest], at[rest:], at[:-rest])
    return at


def regions(texts: list[bytes], min_bytes: int, gram: int):
    """(text number, start, windows, lead, anchor hash) arrays of the regions of
    ``texts``; ``lead`` is the anchor's offset from the region's start."""
    joined = b"".join(texts)
    data = np.frombuffer(joined, dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    base = np.cumsum(lengths) - lengths
    hashes = gram_hashes(data, gram)
    if len(data) < min_bytes:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty, hashes[:0]
    anchor = leftmost_minima(hashes, min_bytes - gram + 1)
    owner = np.repeat(np.arange(len(texts)), lengths)
    start = np.flatnonzero(owner[:len(anchor)] == owner[min_bytes - 1:])  # windows inside one text
    anchor, text = anchor[start], owner[start]
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))[:len(start)])
    width = np.diff(np.append(first, len(start)))
    return text[first], start[first] - base[text[first]], width, anchor[first] - start[first], hashes[anchor[first]]


_REGION = "doc_id long, th long, h long, dig long, start long, width int, lead int"
_REGION_TYPES = [pa.int64()] * 5 + [pa.int32(), pa.int32()]


def _signed(values) -> np.ndarray:
    return np.asarray(values, dtype=np.uint64).view(np.int64)


def _cut_regions(min_bytes, gram):
    names = [x.split()[0] for x in _REGION.split(", ")]

    def emit(docs):
        texts = [t for _, _, t in docs]
        text, start, width, lead, h = regions(texts, min_bytes, gram)
        digest = xxhash.xxh3_64_intdigest
        dig = [digest(texts[i][s:s + w - 1 + min_bytes]) for i, s, w in zip(text.tolist(), start.tolist(), width.tolist())]
        ids, th = [d[0] for d in docs], np.array([d[1] for d in docs], dtype=np.int64)
        columns = [pa.array([ids[i] for i in text.tolist()], pa.int64()), th[text], _signed(h), _signed(dig), start,
                   width.astype(np.int32), lead.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _REGION_TYPES)], names=names)

    def run(batches):
        docs, size = [], 0
        for batch in batches:
            for doc_id, th, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text"))):
                data = text.encode()
                if len(data) < min_bytes:
                    continue
                docs.append((doc_id, th, data))
                size += len(data)
                if size >= BATCH_BYTES:
                    yield emit(docs)
                    docs, size = [], 0
        if docs:
            yield emit(docs)
    return run


_BODIES = "h long, dig long, n long, lead int, width int, body binary"
_BODY_TYPES = [pa.int64()] * 3 + [pa.int32(), pa.int32(), pa.binary()]
_BODY_NAMES = ["h", "dig", "n", "lead", "width", "body"]


def _batch(rows, types, names):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _bodies(min_bytes):
    def run(batches):
        for batch in batches:
            rows = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
                data = text.encode()
                rows += [(p["h"], p["dig"], p["n"], p["lead"], p["width"], data[p["start"]:p["start"] + p["width"] - 1 + min_bytes])
                         for p in parts]
            if rows:
                yield _batch(rows, _BODY_TYPES, _BODY_NAMES)
    return run


_MARKS = "h long, dig long, runs array<struct<from:int,to:int>>"
_RUNS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _as_runs(starts: np.ndarray) -> list[dict]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return [{"from": int(starts[a]), "to": int(starts[b])}
            for a, b in zip(np.append(0, cut + 1), np.append(cut, len(starts) - 1))]


def _sort_suffixes(min_bytes):
    """Rows come sorted by anchor; blocks end between anchors."""
    def solve(rows):
        found = repeated_starts([r[4] for r in rows], [r[3] for r in rows], min_bytes)
        out = []
        for (h, dig, n, width, _), starts in zip(rows, found):
            runs = [{"from": 0, "to": width - 1}] if n > 1 else _as_runs(starts)  # n equal regions hold each other's suffixes
            if runs:
                out.append((h, dig, runs))
        return out

    def run(batches):
        rows, size, last = [], 0, None
        for batch in batches:
            for h, dig, n, width, body in zip(*(batch.column(c).to_pylist() for c in ("h", "dig", "n", "width", "body"))):
                if rows and (h, dig) == last:
                    continue  # of rows repeated with one id
                if rows and size >= BLOCK_BYTES and h != last[0]:
                    if out := solve(rows):
                        yield _batch(out, [pa.int64(), pa.int64(), _RUNS], ["h", "dig", "runs"])
                    rows, size = [], 0
                rows.append((h, dig, n, width, body))
                size += len(body)
                last = h, dig
        if rows and (out := solve(rows)):
            yield _batch(out, [pa.int64(), pa.int64(), _RUNS], ["h", "dig", "runs"])
    return run


_PIECES = "ph long, pdig long, at int, " + _BODIES


def _split(min_bytes, cell):
    def run(batches):
        for batch in batches:
            rows = []
            for h, dig, n, lead, width, body in zip(*(batch.column(c).to_pylist() for c in _BODY_NAMES)):
                at = 0
                while at < width:
                    offset = lead - at  # the anchor's offset in the window at ``at``
                    low = offset // cell * cell
                    count = min(offset - low + 1, width - at)
                    part = body[at:at + count - 1 + min_bytes]
                    # what all windows of the cell hold: from the anchor's offset `low` back, `high` on
                    shared = body[lead - low:lead - (low + cell - 1) + min_bytes]
                    rows.append((h, dig, at, *_signed([xxhash.xxh3_64_intdigest(shared, seed=cell * 1000 + low),
                                                       xxhash.xxh3_64_intdigest(part)]).tolist(), n, offset, count, part))
                    at += count
            if rows:
                yield _batch(rows, [pa.int64(), pa.int64(), pa.int32(), *_BODY_TYPES], ["ph", "pdig", "at", *_BODY_NAMES])
    return run


def _marks(found: DataFrame, min_bytes: int, cells=CELLS) -> DataFrame:
    """(h, dig, runs): repeated window starts of the regions ``found``."""
    keys = stage(found.groupBy("h").agg(F.count("*").alias("regions"), F.sum("n").alias("all"))
                 .filter("all > 1").select("h", (F.col("regions") > HOT_REGIONS).alias("hot")), "suffix-keys")
    known = found.join(keys, "h")
    hot = keys.filter("hot").limit(1).count() > 0 and len(cells) > 0
    cold = known.filter("not hot") if hot else known
    solved = stage(cold.select(*_BODY_NAMES).repartition("h").sortWithinPartitions("h", "dig")
                   .mapInArrow(_sort_suffixes(min_bytes), _MARKS), "suffix-marks")
    if not hot:
        return solved
    pieces = stage(known.filter("hot").select(*_BODY_NAMES).mapInArrow(_split(min_bytes, cells[0]), _PIECES), "suffix-pieces")
    folded = stage(pieces.groupBy("h", "dig").agg(F.sum("n").alias("n"), F.first("lead").alias("lead"),
                                                  F.first("width").alias("width"), F.first("body").alias("body")), "suffix-folded")
    deeper = _marks(folded, min_bytes, cells[1:])
    moved = F.transform("runs", lambda r: F.struct((r["from"] + F.col("at")).alias("from"), (r["to"] + F.col("at")).alias("to")))
    back = (pieces.select("ph", "pdig", "at", "h", "dig").join(deeper, ["h", "dig"])
            .groupBy(F.col("ph").alias("h"), F.col("pdig").alias("dig"))
            .agg(F.flatten(F.collect_list(moved)).alias("runs")))  # at most as many as a region has windows
    return stage(solved.unionByName(back), "suffix-marks")


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(min_bytes, with_kept):
    types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_kept
    names = [x.split()[0] for x in SCHEMA.split(", ")] + ["kept"] * with_kept

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "found"))):
                data = text.encode()
                spans: list[list[int]] = []
                for a, b in sorted((f["start"] + r["from"], f["start"] + r["to"] + min_bytes) for f in found or () for r in f["runs"]):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                body = b"".join(kept) + data[at:]
                rows.append((doc_id, len(data), len(data) - len(body), len(spans), hashlib.sha256(body).hexdigest(),
                             *[body] * with_kept))
            if rows:
                yield _batch(rows, types, names)
    return run


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, gram: int = GRAM, with_kept: bool = False) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): its UTF-8 size, bytes removed,
    maximal removed runs and the digest of the rest (``kept`` itself on
    request). A byte is removed if a string of ``min_bytes`` bytes covering it
    also starts at another place of any row's text, its own included.

    A null text is empty; texts shorter than ``min_bytes`` keep all; repeated
    rows are copies of each other; a null doc_id is allowed; other columns are
    unused; an empty table gives no rows.
    """
    # a row is named by its id and text hash; rows equal in both are treated alike
    body = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).withColumn("th", F.xxhash64("text"))
    cut = stage(body.mapInArrow(_cut_regions(min_bytes, gram), _REGION), "suffix-regions")
    again = stage(cut.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h"), "suffix-again")
    held = stage(cut.join(again, "h"), "suffix-held")
    shown = (held.groupBy("h", "dig").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "start", "width", "lead")).alias("r"))
             .groupBy(F.col("r.doc_id").alias("__id"), F.col("r.th").alias("__th"))
             .agg(F.collect_list(F.struct("h", "dig", "n", F.col("r.start").alias("start"), F.col("r.width").alias("width"),
                                          F.col("r.lead").alias("lead"))).alias("parts")))  # bounded by the text
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))
    found = stage(body.join(stage(shown, "suffix-shown").hint("shuffle_hash"), same).select("text", "parts")
                  .mapInArrow(_bodies(min_bytes), _BODIES), "suffix-bodies")
    marks = _marks(found, min_bytes)
    spots = stage(held.join(marks, ["h", "dig"]).groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th"))
                  .agg(F.collect_list(F.struct("start", "runs")).alias("found")), "suffix-spots")
    schema = SCHEMA + ", kept binary" * with_kept
    return (body.join(spots.hint("shuffle_hash"), same, "left").select("doc_id", "text", "found")
            .mapInArrow(_remove(min_bytes, with_kept), schema))
