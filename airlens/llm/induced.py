"""Suffix and common-prefix arrays by external induced sorting.

Suffixes smaller than their right neighbour are S, the others L; an S suffix
behind an L one is a seed. Sorted seeds induce all L suffixes in one ascending
sweep, and those all S suffixes in one descending sweep: a suffix's left
neighbour is queued under its first character, in the order of the sweep. The
queue is a priority queue of sorted runs that goes to disk when it holds more
than ``memory`` bytes. Tuples carry the rank of their inducer, and the common
prefix of two neighbours is one more than the least common prefix between their
inducers. Seeds are sorted by the same two sweeps over the substrings between
them, which name the characters of a shorter text, and so on recursively, until a
text is short enough to be sorted in memory or its characters are all different.

Sweeps go bucket by bucket in numpy: all tuples of a character are taken at
once, then those they induce under the same character, and so on.
"""

from __future__ import annotations

import heapq
import os
import tempfile

import numpy as np

from airlens.llm.wordhash import mix, powers

_INT = np.int32              # texts of a task are far below 2**31 characters
_RECORD = np.dtype([("char", _INT), ("pos", _INT), ("src", _INT)])


def spill_folder() -> str:
    """Where Spark's own sorters spill on this machine; files are unnamed and
    go with the task."""
    return os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")[0]


class RunQueue:
    """Tuples (char, pos, src) by char, then in order of arrival."""

    def __init__(self, memory: int, descending: bool = False):
        self.memory, self.sign = memory, -1 if descending else 1
        self.heap: list[tuple[int, int]] = []
        self.runs: dict[int, list] = {}          # number: [records or file, next, length]
        self.number, self.held, self.spills = 0, 0, 0

    def push(self, char: np.ndarray, pos: np.ndarray, src: np.ndarray) -> None:
        if not len(char):
            return
        run = np.empty(len(char), _RECORD)
        run["char"], run["pos"], run["src"] = char * self.sign, pos, src
        self._add(run[np.argsort(run["char"], kind="stable")])
        if self.held > self.memory:
            self._spill()

    def _add(self, run: np.ndarray) -> None:
        self.runs[self.number] = [run, 0, len(run)]
        heapq.heappush(self.heap, (int(run["char"][0]), self.number))
        self.number += 1
        self.held += run.nbytes

    def _spill(self) -> None:
        """The runs in memory become one run on disk, at their place in the order."""
        mine = sorted(k for k, r in self.runs.items() if isinstance(r[0], np.ndarray))
        rest = np.concatenate([self.runs[k][0][self.runs[k][1]:] for k in mine])
        rest = rest[np.argsort(rest["char"], kind="stable")]
        f = tempfile.TemporaryFile(dir=spill_folder())
        rest.tofile(f)
        f.flush()
        chars, first = np.unique(rest["char"], return_index=True)
        gone = set(mine)
        for k in mine:
            del self.runs[k]
        self.heap = [x for x in self.heap if x[1] not in gone]
        self.runs[mine[0]] = [f, 0, len(rest), chars, first]
        self.heap.append((int(chars[0]), mine[0]))
        heapq.heapify(self.heap)
        self.held, self.spills = 0, self.spills + 1

    def next_char(self) -> int | None:
        return self.heap[0][0] * self.sign if self.heap else None

    def pop(self, char: int) -> tuple[np.ndarray, np.ndarray]:
        """All (pos, src) of a character, in order of arrival."""
        char *= self.sign
        parts = []
        while self.heap and self.heap[0][0] == char:
            _, k = heapq.heappop(self.heap)
            run = self.runs[k]
            if isinstance(run[0], np.ndarray):
                records, at = run[0], run[1]
                end = at + int(np.searchsorted(records["char"][at:], char, side="right"))
                parts.append(records[at:end])
                run[1] = end
                following = int(records["char"][end]) if end < run[2] else None
                if following is None:
                    self.held -= records.nbytes
            else:
                f, c, _, chars, first = run
                at = int(first[c])
                end = int(first[c + 1]) if c + 1 < len(chars) else run[2]
                f.seek(at * _RECORD.itemsize)
                parts.append(np.fromfile(f, _RECORD, end - at))
                run[1] = c + 1
                following = int(chars[c + 1]) if c + 1 < len(chars) else None
            if following is None:
                if not isinstance(run[0], np.ndarray):
                    run[0].close()
                del self.runs[k]
            else:
                heapq.heappush(self.heap, (following, k))
        got = np.concatenate(parts) if parts else np.zeros(0, _RECORD)
        return got["pos"], got["src"]


class _Sweep:
    """The order of one sweep, with the common prefix of each suffix with the
    one before it (in sweep order)."""

    def __init__(self, size: int, common: bool):
        self.pos = np.empty(size, _INT)
        self.lcp = np.zeros(size, np.int32) if common else None
        self.n = 0

    def add(self, pos: np.ndarray, lcp: np.ndarray | None) -> np.ndarray:
        rank = np.arange(self.n, self.n + len(pos))
        self.pos[rank] = pos
        if self.lcp is not None:
            self.lcp[rank] = lcp
        self.n += len(pos)
        return rank

    def induced(self, src: np.ndarray, before: int) -> np.ndarray | None:
        """Common prefixes of a bucket's next suffixes from their inducers'
        ranks (ascending); ``before``: the rank of the suffix before, or -1."""
        if self.lcp is None:
            return None
        out = np.zeros(len(src), np.int32)
        if before >= 0:
            out[0] = 1 + self.lcp[before + 1:src[0] + 1].min()
        if len(src) > 1:
            lo = src[0] + 1
            out[1:] = 1 + np.minimum.reduceat(self.lcp[lo:src[-1] + 1], src[:-1] + 1 - lo)
        return out


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, common: np.ndarray | None,
            memory: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Both sweeps. ``seeds``: sorted; ``common``: their common prefixes with
    the seed before, or None."""
    n = len(text)
    run = None
    if common is not None:                       # repeats of the first character
        edge = np.flatnonzero(np.append(text[1:] != text[:-1], True))
        run = (np.repeat(edge, np.diff(np.append(-1, edge))) + 1 - np.arange(n)).astype(_INT)

    def seam(a: int, b: int) -> int:
        return min(int(run[a]), int(run[b]))

    # Ascending: L suffixes.
    queue, sweep = RunQueue(memory), _Sweep(n, common is not None)
    first = text[seeds]
    chars, cut = np.unique(first, return_index=True)
    cut = np.append(cut, len(seeds)).tolist()
    seed_chars = dict(zip(chars.tolist(), zip(cut[:-1], cut[1:])))
    pending = sorted(seed_chars, reverse=True)
    large: dict[int, tuple[int, int]] = {}

    def left(pos: np.ndarray, rank: np.ndarray, want: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keep = pos > 0
        before, rank = pos[keep] - 1, rank[keep]
        keep = small[before] == want
        before, rank = before[keep], rank[keep]
        return text[before], before, rank

    while pending or queue.heap:
        c = min(x for x in (pending[-1] if pending else None, queue.next_char()) if x is not None)
        begin, last = sweep.n, -1
        pos, src = queue.pop(c)
        while len(pos):
            rank = sweep.add(pos, sweep.induced(src, last))
            last = int(src[-1])
            ch, p, r = left(pos, rank, False)
            same = ch == c
            queue.push(ch[~same], p[~same], r[~same])
            pos, src = p[same], r[same]
        large[c] = (begin, sweep.n)
        if pending and pending[-1] == c:
            pending.pop()
            a, b = seed_chars[c]
            pos = seeds[a:b]
            lcp = None
            if common is not None:
                lcp = common[a:b].copy()
                lcp[0] = seam(sweep.pos[sweep.n - 1], pos[0]) if sweep.n > begin else 0
            rank = sweep.add(pos, lcp)
            queue.push(*left(pos, rank, False))

    # Descending: S suffixes.
    queue, down = RunQueue(memory, descending=True), _Sweep(n, common is not None)
    pending = sorted(k for k, (a, b) in large.items() if b > a)
    buckets: list[tuple[np.ndarray, np.ndarray | None]] = []
    end = np.array([n - 1], _INT)
    while pending or queue.heap:
        c = max(x for x in (pending[-1] if pending else None, queue.next_char()) if x is not None)
        begin, last = down.n, -1
        pos, src = queue.pop(c)
        while len(pos):
            rank = down.add(pos, down.induced(src, last))
            last = int(src[-1])
            ch, p, r = left(pos, rank, True)
            same = ch == c
            queue.push(ch[~same], p[~same], r[~same])
            pos, src = p[same], r[same]
        if pending and pending[-1] == c:
            pending.pop()
            a, b = large[c]
            pos = sweep.pos[a:b][::-1]
            lcp = None
            if common is not None:
                # With the larger neighbour: the next one's value.
                lcp = np.append(sweep.lcp[a + 1:b], 0)[::-1].copy()
                lcp[0] = seam(down.pos[down.n - 1], pos[0]) if down.n > begin else 0
            rank = down.add(pos, lcp)
            queue.push(*left(pos, rank, True))
        buckets.append((down.pos[begin:down.n], down.lcp[begin:down.n] if common is not None else None))
    order = np.concatenate([end] + [b[0][::-1] for b in reversed(buckets)])
    if common is None:
        return order, None
    lcp = [np.zeros(1, np.int32)]
    for _, x in reversed(buckets):
        # x[i]: with the larger neighbour i - 1; ascending, with the smaller one.
        lcp.append(np.concatenate(([0], x[1:][::-1])).astype(np.int32))
    return order, np.concatenate(lcp)


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(S suffixes, seeds in text order); the last character is the least."""
    n = len(text)
    step = np.sign(np.diff(text, append=text[-1] + 1)).astype(np.int8)   # the end is S
    idx = np.where(step != 0, np.arange(n, dtype=_INT), _INT(n))
    idx = np.minimum.accumulate(idx[::-1])[::-1]            # next place with a change
    small = step[np.minimum(idx, n - 1)] > 0
    small[-1] = True
    seeds = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(_INT)
    return small, seeds


def _prefix(text: np.ndarray) -> np.ndarray:
    out = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(mix(text.astype(np.uint64) + np.uint64(1)) * powers(len(text))[0], out=out[1:])
    return out


def _span(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]


def _common(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of suffix pairs, up to ``limit``, by bisection on span hashes."""
    n = len(prefix) - 1
    low = np.zeros(len(a), np.int64)
    high = np.minimum(limit, n - np.maximum(a, b))
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = _span(prefix, a, a + mid) == _span(prefix, b, b + mid)
        low = np.where(same, mid, low)
        high = np.where(same, high, mid - 1)
    return low.astype(np.int32)


def _in_memory(names: np.ndarray) -> np.ndarray:
    """Suffix order of a short text by prefix doubling."""
    n = len(names)
    rank, k = names.astype(np.int64), 1
    while True:
        second = np.zeros(n, np.int64)
        second[:n - k] = rank[k:] + 1
        key = rank * (int(rank.max()) + 2) + second
        order = np.argsort(key, kind="stable")
        fresh = np.zeros(n, np.int64)
        fresh[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank = fresh
        if rank.max() == n - 1 or k >= n:
            return order
        k *= 2


def _order(text: np.ndarray, memory: int, base: int, limit: int, common: bool) -> tuple[np.ndarray, np.ndarray | None]:
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int32) if common else None
    small, seeds = _types(text)
    rough = seeds[np.argsort(text[seeds], kind="stable")]
    order, _ = _induce(text, small, rough, None, memory)
    is_seed = np.zeros(n, bool)
    is_seed[seeds] = True
    ordered = order[is_seed[order]]
    # Names: substrings up to and with the next seed, in their order.
    del order, rough
    prefix = _prefix(text)
    following = np.full(n, n, _INT)
    following[seeds[:-1]] = seeds[1:] + 1
    length = following[ordered] - ordered
    h = _span(prefix, ordered, following[ordered])
    fresh = np.append(True, (h[1:] != h[:-1]) | (length[1:] != length[:-1]))
    name = np.zeros(n, _INT)
    name[ordered] = np.cumsum(fresh) - 1
    names = name[seeds]
    if fresh.all():
        ranked = ordered
    elif len(seeds) <= base:
        ranked = seeds[_in_memory(names)]
    else:
        # The last seed is the text's end: the least and only one of its name.
        ranked = seeds[_order(names, memory, base, limit, False)[0]]
    lcp = None
    if common:
        lcp = np.zeros(len(ranked), np.int32)
        lcp[1:] = _common(prefix, ranked[:-1], ranked[1:], limit)
    del prefix, following, name, ordered, h, length, is_seed
    return _induce(text, small, ranked, lcp, memory)


def suffix_array(text: np.ndarray, memory: int = 64 << 20, base: int = 1 << 22,
                 limit: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix with the suffix before) of a byte text.

    ``memory``: bytes of a queue before it goes to disk; ``base``: seeds sorted in
    memory instead of by recursion. Common prefixes are exact up to ``limit``;
    longer ones are given as at least ``limit``."""
    if len(text) >= (1 << 31) - 2:
        raise ValueError("a text of one call must be shorter than 2**31 - 2")
    t = np.zeros(len(text) + 1, _INT)
    t[:-1] = text.astype(_INT) + 1
    order, lcp = _order(t, memory, base, limit, True)
    return order[1:], lcp[1:]
