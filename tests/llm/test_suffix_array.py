import random
from collections import Counter

import numpy as np
import pytest

from gaugeflow.llm.suffix_array import Block, repeated_starts
from gaugeflow.llm.suffix_dedup import leftmost_minima, regions


@pytest.mark.parametrize("alphabet,seed", [(b"ab", 1), (b"a", 2), (b"\x00ab", 3), (bytes(range(256)), 4)])
def test_two_stage_order_and_prefixes(alphabet, seed):
    rng = random.Random(seed)
    texts = [bytes(rng.choices(alphabet, k=rng.randint(24, 90))) for _ in range(30)]
    texts += texts[:5] + [b"z" * 60, bytes(60)]
    starts = [len(t) - 23 for t in texts]
    block = Block(texts, starts, 24)
    order = block.suffix_array()
    wanted = sorted(b + i for b, s in zip(block.base.tolist(), starts) for i in range(s))
    assert sorted(order.tolist()) == wanted
    heads = [block.data[i:i + 24].tobytes() for i in order]
    assert heads == sorted(heads)
    lcp = block.common_prefixes(order)
    for i in range(1, len(heads)):
        n = next((k for k in range(24) if heads[i][k] != heads[i - 1][k]), 24)
        assert lcp[i] == n
    count = Counter(t[i:i + 24] for t, s in zip(texts, starts) for i in range(s))
    for text, s, got in zip(texts, starts, repeated_starts(texts, starts, 24)):
        assert got.tolist() == [i for i in range(s) if count[text[i:i + 24]] > 1]


def test_regions_cover_each_window_once():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 9, 300).astype(np.uint64)
    assert leftmost_minima(values, 37).tolist() == [i + int(values[i:i + 37].argmin()) for i in range(300 - 36)]
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (10, 40, 41, 500)]
    seen = Counter()
    for t, s, w, lead, _ in zip(*(x.tolist() for x in regions(texts, 40, 10))):
        assert 0 <= lead <= 30
        for i in range(w):
            seen[t, s + i] += 1
            assert 0 <= lead - i <= 30
    assert seen == Counter((t, i) for t, x in enumerate(texts) for i in range(len(x) - 39))
