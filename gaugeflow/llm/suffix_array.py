"""Two-stage suffix sorting of a block of texts, vectorised over the block.

A suffix is of type B if it is smaller than its successor (the suffix one byte
on) and of type A otherwise. Type B suffixes are sorted directly. Type A
suffixes are then induced by scanning the buckets of first bytes in ascending
order: inside a bucket they come before type B, in the order of their
successors, all of which are already placed. Last, common prefixes of
neighbours are measured.
"""

from __future__ import annotations

import numpy as np


class Block:
    """Texts one after another, each followed by ``depth`` + 8 zero bytes.

    ``starts[i]`` counts the suffixes wanted of text i (its first ones); every
    order and prefix is up to ``depth`` bytes at least."""

    def __init__(self, texts: list[bytes], starts: list[int], depth: int):
        self.depth, self.words = depth, -(-depth // 8)
        pad = bytes(8 * self.words + 8)
        self.data = np.frombuffer(pad.join(texts) + pad, dtype=np.uint8)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.base = np.cumsum(lengths + len(pad)) - lengths - len(pad)
        self.ends, self.starts = self.base + lengths, np.array(starts, dtype=np.int64)
        n = len(self.data) - 8
        word = np.zeros(n, dtype=np.uint64)
        for i in range(8):
            word = (word << np.uint64(8)) | self.data[i:i + n]
        self.word = word  # eight bytes at each place, big-endian

    def _ranges(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """All numbers of the ranges [first, last)."""
        sizes = last - first
        out = np.ones(int(sizes.sum()), dtype=np.int64)
        if not len(out):
            return out
        at = np.cumsum(sizes) - sizes
        some = sizes > 0
        out[at[some]] = first[some]
        heads = at[some][1:]
        out[heads] -= last[some][:-1] - 1
        return np.cumsum(out)

    def types(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether each place is of type B, and the end of its run of equal bytes."""
        data = self.data
        n = len(data)
        change = np.flatnonzero(data[1:] != data[:-1])
        run_ends = np.append(change, n - 1)
        run = np.zeros(n, dtype=np.int64)
        run[change + 1] = 1
        run = run_ends[np.cumsum(run)]
        after = data[np.minimum(run + 1, n - 1)]
        return after >= data, run  # the last run, of padding, counts as B

    def sort_directly(self, places: np.ndarray) -> np.ndarray:
        """``places`` in the order of their suffixes, ``depth`` bytes deep.
        Each round compares eight more bytes, only within groups still tied and
        only if a group differs there."""
        order = np.sort(places)
        order = order[np.argsort(self.word[order], kind="stable")]
        key = self.word[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        tied = np.flatnonzero(~new | np.append(~new[1:], False))
        for r in range(1, self.words):
            if not len(tied):
                break
            group = np.cumsum(new[tied])
            key = self.word[order[tied] + 8 * r]
            same = group[1:] == group[:-1]
            differs = np.zeros(int(group[-1]) + 1, dtype=bool)
            differs[group[1:][same & (key[1:] != key[:-1])]] = True
            hit = np.flatnonzero(differs[group])
            if len(hit):
                sorted_hit = hit[np.lexsort((key[hit], group[hit]))]
                order[tied[hit]] = order[tied[sorted_hit]]
                key[hit] = key[sorted_hit]
                fresh = np.flatnonzero(same & (key[1:] != key[:-1])) + 1
                new[tied[fresh]] = True
                again = np.append(~new[tied[1:]], False) & np.append(tied[1:] == tied[:-1] + 1, False)
                tied = tied[~new[tied] | again]
        return order

    def suffix_array(self) -> np.ndarray:
        """The wanted suffixes' places in sorted order."""
        is_b, run = self.types()
        # an A suffix needs its successors up to the next B
        n = len(self.data)
        b_places = np.flatnonzero(is_b)
        closing = b_places[np.searchsorted(b_places, self.base + np.maximum(self.starts - 1, 0))]
        need = self._ranges(self.base, np.where(self.starts > 0, np.minimum(closing, self.ends) + 1, self.base))
        b = self.sort_directly(need[is_b[need]])
        a = need[~is_b[need]]
        a = a[np.argsort(self.data[a], kind="stable")]
        rank = np.full(n, -1, dtype=np.int64)
        out, at = np.empty(len(need), dtype=np.int64), 0
        a_cut = np.searchsorted(self.data[a], np.arange(257))
        b_cut = np.searchsorted(self.data[b], np.arange(257))
        for c in range(256):
            own = a[a_cut[c]:a_cut[c + 1]]
            if len(own):
                left = run[own] - own  # equal bytes still to come
                by_left = np.argsort(left, kind="stable")
                own, left = own[by_left], left[by_left]
                cuts = np.flatnonzero(np.append(True, left[1:] != left[:-1]))
                for lo, hi in zip(cuts, np.append(cuts[1:], len(own))):
                    part = own[lo:hi]
                    part = part[np.argsort(rank[part + 1], kind="stable")]
                    rank[part] = np.arange(at, at + len(part))
                    out[at:at + len(part)] = part
                    at += len(part)
            own = b[b_cut[c]:b_cut[c + 1]]
            rank[own] = np.arange(at, at + len(own))
            out[at:at + len(own)] = own
            at += len(own)
        text = np.searchsorted(self.base, out, side="right") - 1
        return out[out < self.base[text] + self.starts[text]]

    def common_prefixes(self, order: np.ndarray) -> np.ndarray:
        """Length, up to ``depth``, of the prefix each suffix shares with the one
        before it (0 for the first)."""
        out = np.zeros(len(order), dtype=np.int64)
        live = np.arange(1, len(order))
        for r in range(self.words):
            x = self.word[order[live] + 8 * r] ^ self.word[order[live - 1] + 8 * r]
            ended = x != 0
            high = x[ended]
            zero = np.zeros(len(high), dtype=np.int64)
            for i in range(1, 8):  # equal leading bytes
                zero += (high >> np.uint64(64 - 8 * i)) == 0
            out[live[ended]] = 8 * r + zero
            live = live[~ended]
        out[live] = self.depth
        return np.minimum(out, self.depth)


def repeated_starts(texts: list[bytes], starts: list[int], depth: int) -> list[np.ndarray]:
    """For each text the wanted starts whose first ``depth`` bytes also begin
    at another wanted start of the block."""
    block = Block(texts, starts, depth)
    order = block.suffix_array()
    long = block.common_prefixes(order) >= depth
    found = np.sort(order[long | np.append(long[1:], False)])
    cuts = np.searchsorted(found, np.append(block.base, len(block.data)))
    return [found[a:b] - base for a, b, base in zip(cuts, cuts[1:], block.base)]
