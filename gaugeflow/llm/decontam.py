"""Benchmark decontamination by pigeonhole edit matching.

An item may occur with up to k edits. Cut into k + 1 pieces, one piece at
least survives any k edits unchanged, so exact piece hits (one automaton over
all pieces) find every candidate place; Myers' bit-parallel distance verifies
the item there. Texts are compared lower-cased with white space folded.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage

ERROR_RATE = 0.05
# Shorter items (normalised) have no error budget: they count where they stand
# verbatim as whole words.
MIN_CHARS = 24
# Pieces are this long at least; an item's error budget is lowered to fit.
MIN_PIECE = 12
# The benchmark is matched in blocks of this many characters at most (or one
# item), so that what a task holds does not grow with it.
BLOCK_CHARS = 4 << 20

MATCH_SCHEMA = "doc_id long, item_id long, distance int, error_budget int, match_end long"
_MATCH_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
_MATCH_NAMES = [x.split()[0] for x in MATCH_SCHEMA.split(", ")]


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(pattern: str, error_rate: float = ERROR_RATE) -> tuple[int, list[tuple[int, str]]]:
    """Error budget k and k + 1 consecutive (offset, piece) of a pattern."""
    m = len(pattern)
    k = max(0, min(int(m * error_rate), m // MIN_PIECE - 1))
    ends = [m * i // (k + 1) for i in range(k + 2)]
    return k, [(a, pattern[a:b]) for a, b in zip(ends, ends[1:])]


def masks(pattern: str) -> dict[str, int]:
    """Bit i of a character's mask is set where the pattern has it at i."""
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        out[c] |= 1 << i
    return dict(out)


def myers(m: int, peq: dict[str, int], text: str) -> tuple[int, int]:
    """Smallest edit distance of the pattern to any substring of ``text`` and
    the end of the first such substring (Myers' bit vectors, search form)."""
    ones, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = ones, 0, m, m, 0
    get = peq.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (ones & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & ones
        mh = (mh << 1) & ones
        pv = mh | (ones & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Finds the items of one benchmark block in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE):
        self.items, at = [], defaultdict(list)
        for item_id, text in items:
            pattern = normalised(text)
            if not pattern:
                continue
            k, cut = pieces(pattern, error_rate)
            for offset, piece in cut:
                at[piece].append((len(self.items), offset))
            self.items.append((item_id, len(pattern), k, masks(pattern)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str | None):
        """Yield (item_id, distance, error budget, end in the normalised text)
        for each item within its budget."""
        if not self.items:
            return
        body = normalised(text)
        near, short = defaultdict(list), {}
        for end, (n, places) in self.automaton.iter(body):
            for i, offset in places:
                if self.items[i][1] >= MIN_CHARS:
                    near[i].append(end + 1 - n - offset)
                elif i not in short and not (body[end - n:end - n + 1].isalnum() or body[end + 1:end + 2].isalnum()):
                    short[i] = end + 1
        for i, place in short.items():
            yield self.items[i][0], 0, 0, place
        for i, starts in near.items():
            item_id, m, k, peq = self.items[i]
            starts.sort()
            best, place, low, high = k + 1, 0, None, None
            for s in [*starts, None]:  # overlapping windows are searched once
                if s is not None and low is not None and s - k <= high:
                    high = s + m + k
                    continue
                if low is not None:
                    got, stop = myers(m, peq, body[max(low, 0):high])
                    if got < best:
                        best, place = got, max(low, 0) + stop
                if s is not None:
                    low, high = s - k, s + m + k
            if best <= k:
                yield item_id, best, k, place


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[tuple[int, str]], bool]]:
    """The benchmark in blocks of bounded size and whether more follow; one
    block at a time is on the driver, as callers stage what a block gives."""
    items = stage(benchmark.filter("text is not null").select(F.col("item_id").cast("long"), "text").distinct(), "benchmark")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for b in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else items
        yield [(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()], b < n - 1


def _match(items, error_rate):
    def run(batches):
        matcher = Matcher(items, error_rate)
        for batch in batches:
            rows = [(doc_id, *hit) for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                    for hit in matcher.find(text)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _MATCH_TYPES)],
                                                 names=_MATCH_NAMES)
    return run


def _clean(items, error_rate, at):
    def run(batches):
        matcher = Matcher(items, error_rate)
        for batch in batches:
            keep = [next(matcher.find(text), None) is None for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """(doc_id, item_id, distance, error_budget, match_end) for each row of
    ``docs`` (doc_id, text) and item of ``benchmark`` (item_id, text) that it
    contains within the item's error budget, floor(length * error_rate).

    Null and empty texts match nothing. Items under MIN_CHARS normalised
    characters match verbatim, where no letter or digit adjoins them. Repeated documents give rows each, repeated items with one id
    and text count once; other columns are unused; empty tables give no rows.
    ``match_end`` is an offset in the normalised text.
    """
    found = docs.sparkSession.createDataFrame([], MATCH_SCHEMA)
    for items, more in _blocks(benchmark):
        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_match(items, error_rate), MATCH_SCHEMA)
        found = found.unionByName(stage(part, "matches") if more else part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that match no item (see
    :func:`matches`). Rows with a null or empty text stay, texts of any length
    are searched whole, repeated rows stay or go together; an empty table of
    either kind drops nothing."""
    at = docs.columns.index("text")
    for items, more in _blocks(benchmark):
        docs = docs.mapInArrow(_clean(items, error_rate, at), docs.schema)
        docs = stage(docs, "clean") if more else docs
    return docs
