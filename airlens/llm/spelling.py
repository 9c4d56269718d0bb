"""Spelling variants: words one edit apart, by k-d trees over letter counts.

``count_words`` takes maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z
lower-cased, and counts the distinct ones of at least ``min_length`` code points
over the whole corpus. With ``damage`` = q, a run whose crc32 of
``<doc_id>:<run>`` is divisible by q loses the code point at crc32 mod length (a
row with a null id loses none). Counts are pre-aggregated per task.

``near`` finds all pairs one inserted, deleted or replaced code point apart.
A word's vector counts its letters. A replaced letter changes two counts by
one, an inserted one changes one, so near words are at an L1 distance of at
most two. Words are searched per pair of lengths, (l, l) and (l, l + 1). A k-d
tree of each length, its planes fitted to a bounded sample of the words, cuts the
words into cells of about ``cell`` words; a word goes into the one cell of its own and, as
a query, to the cells of both lengths whose boxes are within reach, so no pair
is lost wherever the planes lie. A cell builds its own k-d tree with tight boxes
and runs its queries through it in blocks, pruning by box. Counts are written
in unary, so that one matrix product gives the shared letters of a block and a
leaf. Pairs that share enough letters are verified letter by letter.

``variants`` adds a word's form, the near word of largest n (ties: smallest in
code-point order) if that n is at least ``ratio`` times the word's, and its
root, where the forms lead; n grows at each step, so chains are short and
pointer doubling ends them in a few joins.

Null or empty texts have no words; very long texts and words are read whole.
Repeated rows count again. Empty tables give empty results; other columns are
ignored. Words of a task's run are told apart by 64-bit hashes, all else by
their letters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import by_bytes, partitions, stage
from airlens.llm.wordhash import LOWER, prefix_hashes, span_hashes

RUN_BYTES = 4 << 20
CELL_WORDS = 1 << 13
LEAF_WORDS = 1 << 7
QUERY_BLOCK = 1 << 12
ROUTE_WORDS = 1 << 17
SAMPLE_WORDS = 1 << 16
DEPTH = 12                  # of a length's tree over cells
LETTERS = 90                # a-z, U+00C0-U+00FF


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()
_LETTER = np.full(256, -1, np.int64)            # of a Latin-1 byte
_LETTER[97:123] = np.arange(26)
_LETTER[0xC0:] = np.arange(26, LETTERS)


def span_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray, stepped: int = 64) -> np.ndarray:
    """crc32 of a prefix, whose crc32 is ``before``, and data[start:end]."""
    order = np.argsort(start - end, kind="stable")           # longest first
    at, n = start[order], (end - start)[order]
    state = before[order] ^ np.uint32(0xFFFFFFFF)
    longest = min(int(n[0]) if len(n) else 0, stepped)
    going = np.searchsorted(-n, -np.arange(longest), side="left")
    for j, g in enumerate(going.tolist()):
        state[:g] = _CRC[(state[:g] ^ data[at[:g] + j]) & np.uint32(255)] ^ state[:g] >> np.uint32(8)
    out = np.empty(len(n), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(end - start > stepped).tolist():
        out[i] = zlib.crc32(data[start[i]:end[i]].tobytes(), int(before[i]))
    return out


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Spans of UTF-8 ``data`` as strings."""
    n = end - start
    first = np.concatenate(([0], np.cumsum(n)))
    picked = data[np.repeat(start - first[:-1], n) + np.arange(first[-1])]
    return pa.StringArray.from_buffers(len(n), pa.py_buffer(first.astype(np.int32)), pa.py_buffer(picked))


def word_counts(ids: list, texts: list[bytes], min_length: int, damage: int) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of a run of texts and their occurrences."""
    data = LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    two = data == 0xC3                                       # leads U+00C0 to U+00FF, all of them letters
    inside = (data >= 97) & (data <= 122) | two
    inside[1:] |= two[:-1]
    change = np.diff(inside.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    wide = np.concatenate(([0], np.cumsum(two)))
    n = end - start - (wide[end] - wide[start])
    use = n >= min_length
    start, end, n = start[use], end[use], n[use]
    extra: dict[str, int] = {}
    if damage and len(start):
        doc = np.searchsorted(np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1), start, side="right")
        known = np.array([i is not None for i in ids])
        before = np.array([zlib.crc32(b"%d:" % i) if i is not None else 0 for i in ids], np.uint32)
        crc = span_crcs(data, start, end, before[doc])
        hit = (crc % np.uint32(damage) == 0) & known[doc]
        for a, b, c in zip(start[hit].tolist(), end[hit].tolist(), crc[hit].tolist()):
            w = data[a:b].tobytes().decode()
            k = c % len(w)
            w = w[:k] + w[k + 1:]
            if len(w) >= min_length:
                extra[w] = extra.get(w, 0) + 1
        start, end = start[~hit], end[~hit]
    _, first, times = np.unique(span_hashes(prefix_hashes(data), start, end), return_index=True, return_counts=True)
    words = _strings(data, start[first], end[first])
    return pa.concat_arrays([words, pa.array(list(extra), pa.string())]), np.append(times, list(extra.values())).astype(np.int64)


def count_words(docs: DataFrame, min_length: int = 6, min_count: int = 5, damage: int = 0, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n) of the words with at least ``min_count`` occurrences, staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in by_bytes(batches, limit=RUN_BYTES):
            words, n = word_counts(rows.column("doc_id").to_pylist(), texts, min_length, damage)
            yield pa.record_batch({"word": words, "n": n})

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    counted = cols.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stage(counted.where(F.col("n") >= min_count), "words")


def letters(words: list[bytes]) -> np.ndarray:
    """Latin-1 words of one length, a row each."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def vectors(rows: np.ndarray) -> np.ndarray:
    """Letter counts of each word."""
    n, length = rows.shape
    cell = np.arange(n)[:, None] * LETTERS + _LETTER[rows]
    return np.bincount(cell.ravel(), minlength=n * LETTERS).reshape(n, LETTERS).astype(np.int32)


@dataclass
class Node:
    """A box of letter counts; a leaf (no ``below``) holds ``rows`` of its points."""

    low: np.ndarray
    high: np.ndarray
    below: tuple = ()
    axis: int = 0
    cut: int = 0                    # the first child has counts up to it
    rows: np.ndarray | None = None
    leaf: int = 0


@dataclass
class Tree:
    root: Node
    leaves: list[Node] = field(default_factory=list)


def build_tree(points: np.ndarray, depth: int, leaf_size: int, tight: bool) -> Tree:
    """A k-d tree, cut at the median of the letter whose count varies most.
    Tight boxes span their points; others only what the planes leave."""
    tree = Tree(Node(np.zeros(LETTERS, np.int32), np.full(LETTERS, np.iinfo(np.int32).max, np.int32)))
    todo = [(tree.root, np.arange(len(points)), depth)]
    while todo:
        node, rows, left = todo.pop()
        mine = points[rows]
        if tight and len(rows):
            node.low, node.high = mine.min(axis=0), mine.max(axis=0)
        axis = int(mine.var(axis=0).argmax()) if len(rows) else 0
        side = mine[:, axis]
        if left and len(rows) > leaf_size and side.min() < side.max():
            cut = min(int(np.median(side)), int(side.max()) - 1)
            node.axis, node.cut = axis, cut
            first, second = Node(node.low, node.high.copy()), Node(node.low.copy(), node.high)
            first.high[axis] = min(cut, first.high[axis])
            second.low[axis] = max(cut + 1, second.low[axis])
            node.below = (first, second)
            todo += [(first, rows[side <= cut], left - 1), (second, rows[side > cut], left - 1)]
        else:
            node.rows, node.leaf = rows, len(tree.leaves)
            tree.leaves.append(node)
    return tree


def home(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf of each point."""
    out = np.zeros(len(points), np.int64)
    todo = [(tree.root, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if not node.below:
            out[rows] = node.leaf
        elif len(rows):
            first = points[rows, node.axis] <= node.cut
            todo += [(node.below[0], rows[first]), (node.below[1], rows[~first])]
    return out


def reach(tree: Tree, points: np.ndarray, longer: int) -> Iterator[tuple[Node, np.ndarray]]:
    """Leaves with the points whose range meets the leaf's box: words of the same
    length differ by one letter more and one less, words ``longer`` by one have
    one more and none less."""
    todo = [(tree.root, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        mine = points[rows]
        near = np.maximum(node.low - mine, 0).sum(axis=1) <= 1
        near &= np.maximum(mine - node.high, 0).sum(axis=1) <= 1 - longer
        rows = rows[near]
        if not len(rows):
            continue
        if node.below:
            todo += [(child, rows) for child in node.below]
        else:
            yield node, rows


class Cell:
    """The words of one cell, sorted, and their k-d tree with tight boxes."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words, self.n = [words[i] for i in order], n[order]
        self.letters = letters(self.words)
        points = vectors(self.letters)
        self.most = points.max(axis=0)
        self.unary = self._unary(points)
        self.tree = build_tree(points, 64, LEAF_WORDS, tight=True)
        self.length = self.letters.shape[1]
        # Nodes get their boxes in unary, leaves their points as well.
        todo = [self.tree.root]
        while todo:
            node = todo.pop()
            node.bits = self._unary(np.stack((node.low, node.high))).T.copy()
            node.size = float(node.low.sum())
            todo += node.below
            if not node.below:
                node.points = self.unary[node.rows].T.copy()

    def _unary(self, points: np.ndarray) -> np.ndarray:
        """A column for each letter and count up to the largest in the cell, so a
        product of two rows is the number of letters that they share."""
        axis = np.repeat(np.arange(LETTERS), self.most)
        count = np.arange(len(axis)) - np.repeat(np.cumsum(self.most) - self.most, self.most)
        return (points[:, axis] > count).astype(np.float32)

    def pairs(self, asked: np.ndarray, longer: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of the near pairs; ``asked`` are the letters of queries
        as long as the cell's words, or shorter by ``longer`` = 1."""
        bits = self._unary(vectors(asked))
        need = self.length - 1                  # letters that a pair shares, for either kind
        todo = [(self.tree.root, np.arange(len(asked)))]
        q_out, p_out = [], []
        while todo:
            node, rows = todo.pop()
            shared = bits[rows] @ node.bits
            rows = rows[(node.size - shared[:, 0] <= 1) & (shared[:, 1] >= need)]
            if not len(rows):
                continue
            if node.below:
                todo += [(child, rows) for child in node.below]
                continue
            q, p = np.nonzero(bits[rows] @ node.points == need)
            q, p = rows[q], node.rows[p]
            good = one_edit(asked[q], self.letters[p])
            q_out.append(q[good])
            p_out.append(p[good])
        if not q_out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(q_out), np.concatenate(p_out)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where the rows of b are those of a with one letter replaced, or, if b is
    wider by one, with one letter inserted."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= n


NEAR = "word string, n_near long, best string, best_n long"


def _partial(mine: np.ndarray, other: np.ndarray, words: list[bytes], other_words: list[bytes], other_n: np.ndarray) -> pa.RecordBatch:
    """Per word of ``mine`` its pairs' number and its best partner. ``other_words``
    ascend, or the pairs are ordered by them within a word."""
    order = np.lexsort((other, -other_n[other], mine))
    mine, other = mine[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1]))[:len(mine)])
    return pa.record_batch({
        "word": pa.array([words[i].decode("latin-1") for i in mine[first].tolist()], pa.string()),
        "n_near": np.diff(np.append(first, len(mine))).astype(np.int64),
        "best": pa.array([other_words[i].decode("latin-1") for i in other[first].tolist()], pa.string()),
        "best_n": other_n[other[first]].astype(np.int64)})


def _split(blob: bytes, length: int) -> list[bytes]:
    return [blob[i:i + length] for i in range(0, len(blob), length)]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by cell, its words (role 0) before the queries of the same length
    (1) and of words shorter by one (2)."""
    at, cell, held, held_n = None, None, [], []
    for batch in batches:
        for r in batch.to_pylist():
            key = (r["length"], r["leaf"])
            if key != at:
                at, cell, held, held_n = key, None, [], []
            longer = int(r["role"] == 2)
            words, n = _split(r["words"], r["length"] - longer), np.frombuffer(r["n"], "<i8")
            if r["role"] == 0:
                held += words
                held_n.append(n)
                continue
            if cell is None:
                if not held:
                    continue                            # no word lies in this cell
                cell = Cell(held, np.concatenate(held_n))
            for a in range(0, len(words), QUERY_BLOCK):
                part = sorted(range(a, min(a + QUERY_BLOCK, len(words))), key=words.__getitem__)
                asked, asked_n = [words[i] for i in part], n[part]
                q, p = cell.pairs(letters(asked), longer)
                if len(q):
                    yield _partial(q, p, asked, cell.words, cell.n)
                    if longer:                          # the longer word's side; equal lengths ask both ways
                        yield _partial(p, q, cell.words, asked, asked_n)


def cell_trees(words: DataFrame, cell: int) -> dict[int, Tree]:
    """A tree over cells for each length with more words than one cell takes
    (long words count as several), fitted to a sample of about ``SAMPLE_WORDS``
    words, chosen by hash, and of twice as many at most."""
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    cells = {r["length"]: r["n"] * max(16, r["length"]) / (16 * cell) for r in sizes}
    cells = {k: c for k, c in cells.items() if c > 1}
    if not cells:
        return {}
    share = min(1.0, SAMPLE_WORDS / sum(r["n"] for r in sizes))
    chosen = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample: dict[int, list[bytes]] = {}
    for r in words.where(chosen).select("word").limit(2 * SAMPLE_WORDS).collect():
        sample.setdefault(len(r["word"]), []).append(r["word"].encode("latin-1"))
    return {k: build_tree(vectors(letters(sample[k])), min(DEPTH, int(np.ceil(np.log2(c)))), 1, False)
            for k, c in cells.items() if k in sample}


def near(words: DataFrame, cell: int = CELL_WORDS) -> DataFrame:
    """(word, n_near, best, best_n): each word that has near words, their
    number, and the one of largest n."""
    spark = words.sparkSession
    trees = spark.sparkContext.broadcast(cell_trees(words, cell))
    single = Tree(Node(np.zeros(LETTERS, np.int32), np.full(LETTERS, np.iinfo(np.int32).max, np.int32), rows=np.zeros(0, np.int64)))
    single.leaves.append(single.root)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(held: dict[int, list[tuple[bytes, int]]]) -> Iterator[pa.RecordBatch]:
            for length, pairs in held.items():
                words, n = [w for w, _ in pairs], np.array([c for _, c in pairs], "<i8")
                rows = letters(words)
                points = vectors(rows)
                own = trees.value.get(length, single)
                leaf = home(own, points)
                out = [(length, node.leaf, 0, np.flatnonzero(leaf == node.leaf)) for node in own.leaves]
                out += [(length, node.leaf, 1, some) for node, some in reach(own, points, 0)]
                out += [(length + 1, node.leaf, 2, some) for node, some in reach(trees.value.get(length + 1, single), points, 1)]
                out = [x for x in out if len(x[3])]
                yield pa.record_batch({
                    "length": pa.array([x[0] for x in out], pa.int32()), "leaf": pa.array([x[1] for x in out], pa.int32()),
                    "role": pa.array([x[2] for x in out], pa.int32()),
                    "words": pa.array([rows[x[3]].tobytes() for x in out], pa.binary()),
                    "n": pa.array([n[x[3]].tobytes() for x in out], pa.binary())})

        held: dict[int, list[tuple[bytes, int]]] = {}
        size = 0
        for batch in batches:
            for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                held.setdefault(len(w), []).append((w.encode("latin-1"), n))
            size += batch.num_rows
            if size >= ROUTE_WORDS:
                yield from send(held)
                held, size = {}, 0
        if held:
            yield from send(held)

    dealt = words.mapInArrow(route, "length int, leaf int, role int, words binary, n binary")
    dealt = dealt.repartition(partitions(spark), "length", "leaf").sortWithinPartitions("length", "leaf", "role")
    found = stage(dealt.mapInArrow(_search, NEAR), "near-words")
    least = F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least).select(
        "word", "n_near", F.col("b.best").alias("best"), (-F.col("b.minus")).alias("best_n"))


def variants(words: DataFrame, ratio: int = 5, cell: int = CELL_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n)."""
    strong = F.col("best_n") >= ratio * F.col("n")
    table = stage(words.join(near(words, cell), "word", "left").select(
        "word", F.when(strong, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best_n")).alias("form_n")), "forms")
    links = table.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        after = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stage(links.select("word", "root").join(after, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if links.where("moved").isEmpty():
            break
    return table.join(links.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
