"""Suffix and common-prefix arrays, and the run queue under them."""

import numpy as np
import pytest

from airlens.llm.induced import RunQueue, suffix_array


def brute(s: bytes):
    order = sorted(range(len(s)), key=lambda i: s[i:])

    def common(a, b):
        k = 0
        while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        return k

    return order, [0] * bool(order) + [common(a, b) for a, b in zip(order, order[1:])]


@pytest.mark.parametrize("memory", [1, 200, 1 << 20])
@pytest.mark.parametrize("base", [0, 4, 1 << 20])          # 0: recursion down to different names
def test_against_sorted_suffixes(memory, base):
    rng = np.random.default_rng(memory + base)
    for _ in range(60):
        t = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(0, 60)).astype(np.uint8)
        order, common = suffix_array(t, memory=memory, base=base)
        assert (order.tolist(), common.tolist()) == brute(t.tobytes())


def test_common_prefix_is_at_least_the_limit():
    t = np.frombuffer(b"ab" * 400 + b"x" + b"ab" * 400, np.uint8)
    order, common = suffix_array(t, memory=500, base=3, limit=64)
    want_order, want = brute(t.tobytes())
    assert order.tolist() == want_order
    assert all(g == w if w < 64 else g >= 64 for g, w in zip(common.tolist(), want))


@pytest.mark.parametrize("descending", [False, True])
def test_queue_goes_to_disk_and_keeps_arrival_order(descending):
    rng = np.random.default_rng(3)
    q = RunQueue(memory=300, descending=descending)
    seen, n = {}, 0
    for _ in range(30):
        ch = rng.integers(0, 6, 9)
        q.push(ch, np.arange(n, n + 9), np.arange(n, n + 9) * 2)
        for c, p in zip(ch.tolist(), range(n, n + 9)):
            seen.setdefault(c, []).append(p)
        n += 9
    assert q.spills
    for c in sorted(seen, reverse=descending):
        assert q.next_char() == c
        pos, src = q.pop(c)
        assert pos.tolist() == seen[c] and (src == 2 * pos).all()
    assert q.next_char() is None
