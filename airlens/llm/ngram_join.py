"""Similarity join of documents on word n-grams by prefix trees.

A document's set: the distinct hashes of its ``n``-word shingles (with fewer
words: of the whole word sequence). Two sets link when their Jaccard similarity
is at least ``percent`` / 100. The result holds each document's class: the
smallest doc_id reachable by links.

1. Equal sets are one class. 2. Shingles are dealt out by hash, packed, each
once a task and class; only those of two or more sets go back, with their count,
which gives the global order (rarest first). A set whose shared part is too
short for any link is done. 3. Sets that share a token of their prefixes (the
tokens that any linked pair must meet in) form candidate clusters, found by
stars and components. 4. Each cluster is cut into pieces of at most ``piece``
sets. In a piece, and between its sets and the cluster's first set, a prefix
tree holds the sets in global order; a query walks it with the overlap so far,
and a subtree is left out when the tokens still ahead cannot reach the overlap
that its smallest set needs. 5. Sets of a cut cluster outside its largest
component so far are joined, in blocks, with all sets of the cluster; a pair in
one component already needs no test. So no link between components is lost, and
a large group of near copies costs one pass, not all its pairs.

Null or empty text, or no words: the empty set, linked with nothing (its own
doc_id). Repeated rows and ids are rows of their class. A null doc_id counts
for links but never as the smallest. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import by_bytes, grouped, partitions, stage, tidied
from airlens.llm.components import UnionFind, components
from airlens.llm.wordhash import SPACE_SEP, Words, gram_hashes

FLUSH_SHINGLES = 1 << 21
FLUSH_SETS = 1 << 15
BUCKET_BYTES = 4 << 20      # of text whose shingles are counted in one group


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    words = Words(texts, SPACE_SEP)
    out = []
    for i in range(len(texts)):
        h = words.hash[words.first[i]:words.first[i + 1]]
        out.append(np.unique(gram_hashes(h, min(n, len(h)))) if len(h) else np.zeros(0, np.uint64))
    return out


def class_key(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


class Trie:
    """A path-compressed prefix tree of ascending token lists."""

    __slots__ = ("tokens", "children", "sets", "least", "longest")

    def __init__(self, tokens: list[int]):
        self.tokens = tokens                 # of the edge into this node
        self.children: dict[int, Trie] = {}
        self.sets: list[int] = []            # sets that end here
        self.least = 1 << 62                 # smallest full set size below
        self.longest = 0                     # most tokens from the root, below

    def insert(self, tokens: list[int], size: int, name: int) -> None:
        node, at = self, 0
        while True:
            node.least, node.longest = min(node.least, size), max(node.longest, len(tokens))
            if at == len(tokens):
                node.sets.append(name)
                return
            child = node.children.get(tokens[at])
            if child is None:
                child = node.children[tokens[at]] = Trie(tokens[at:])
                child.least, child.longest, child.sets = size, len(tokens), [name]
                return
            edge, k = child.tokens, 0
            most = min(len(edge), len(tokens) - at)
            while k < most and edge[k] == tokens[at + k]:
                k += 1
            if k < len(edge):                # split the edge
                upper = Trie(edge[:k])
                upper.children[edge[k]] = child
                upper.least, upper.longest = child.least, child.longest
                child.tokens = edge[k:]
                node.children[tokens[at]] = upper
                child = upper
            node, at = child, at + k

    def search(self, tokens: list[int], size: int, percent: int, sizes: list[int]) -> Iterator[int]:
        """Names of the sets that link with the query."""
        query = set(tokens)
        stack = [(self, 0, 0)]
        while stack:
            node, overlap, depth = stack.pop()
            if node.tokens:
                overlap += len(query.intersection(node.tokens))
                depth += len(node.tokens)
            for s in node.sets:
                if (100 + percent) * overlap >= percent * (size + sizes[s]):
                    yield s
            for first, child in node.children.items():
                # What the subtree and the query still have ahead.
                ahead = min(child.longest - depth, len(tokens) - bisect_right(tokens, first - 1))
                if (100 + percent) * (overlap + ahead) >= percent * (size + child.least) \
                        and 100 * size >= percent * child.least:
                    stack.append((child, overlap, depth))


def _token_lists(frame: list[dict]) -> list[list[int]]:
    return [np.frombuffer(r["tokens"], np.uint64).tolist() for r in frame]


def join_piece(rows: list[dict], percent: int) -> list[tuple[int, int]]:
    """Links that span the components of a piece (rows: cid, n, tokens)."""
    tokens, sizes = _token_lists(rows), [r["n"] for r in rows]
    order = sorted(range(len(rows)), key=lambda i: sizes[i])
    root, uf, out = Trie([]), UnionFind(len(rows)), []
    inside = 0
    for i in order:
        fresh = inside                       # components of the sets in the tree
        seen = set()
        for s in root.search(tokens[i], sizes[i], percent, sizes):
            r = uf.find(s)
            if uf.union(s, i):
                out.append((rows[s]["cid"], rows[i]["cid"]))
                seen.add(r)
                if len(seen) == fresh:       # linked with all there is
                    break
        inside = fresh - len(seen) + 1
        root.insert(tokens[i], sizes[i], i)
    return out


def join_blocks(left: list[dict], right: list[dict], percent: int) -> list[tuple[int, int]]:
    """Links between two blocks of one cluster, of sets in different components."""
    rows = left + right
    tokens, sizes = _token_lists(rows), [r["n"] for r in rows]
    names = {c: k for k, c in enumerate({r["label"] for r in rows})}
    uf, label, out = UnionFind(len(names)), [names[r["label"]] for r in rows], []
    root = Trie([])
    for i in range(len(left)):
        root.insert(tokens[i], sizes[i], i)
    for j in range(len(left), len(rows)):
        for s in root.search(tokens[j], sizes[j], percent, sizes):
            if uf.union(label[s], label[j]):
                out.append((rows[s]["cid"], rows[j]["cid"]))
    return out


def _shared(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(cid, n, tokens): classes whose shared shingles can make a link."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(partitions(docs.sparkSession), -(-size // BUCKET_BYTES))
    schema = "bucket int, flush long, kind int, a binary, b binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush_id = TaskContext.get().partitionId() << 33
        sets: dict[int, np.ndarray] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            cids = np.fromiter(sets, np.int64, len(sets))
            size = np.fromiter((len(s) for s in sets.values()), np.int64, len(sets))
            h = np.concatenate(list(sets.values()))
            idx = np.repeat(np.arange(len(sets)), size).astype("<u2")
            # 40 bits beside the bucket, sorted, byte by byte, so that the high
            # bytes cost nothing in a compressed shuffle.
            key = (h % np.uint64(buckets)) << np.uint64(40) | h >> np.uint64(24)
            order = np.argsort(key, kind="stable")
            key, idx = key[order], idx[order]
            used, first = np.unique(key >> np.uint64(40), return_index=True)
            cut = np.append(first, len(h)).tolist()
            planes = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            spans = list(zip(cut[:-1], cut[1:]))
            k = len(spans)
            return pa.record_batch({
                "bucket": pa.array([flush_id % buckets, *used.astype(np.int64).tolist()], pa.int32()),
                "flush": pa.array([flush_id] * (k + 1), pa.int64()),
                "kind": pa.array([0] + [1] * k, pa.int32()),
                "a": pa.array([cids.tobytes()] + [planes[x:y].T.tobytes() for x, y in spans], pa.binary()),
                "b": pa.array([size.tobytes()] + [idx[x:y].tobytes() for x, y in spans], pa.binary())})

        for _, texts in by_bytes(batches):
            for s in shingle_sets(texts, n):
                if not len(s):
                    continue
                cid = class_key(s)
                if cid not in sets:
                    if sets and (held + len(s) > FLUSH_SHINGLES or len(sets) == FLUSH_SETS):
                        yield flush()
                        sets, held, flush_id = {}, 0, flush_id + 1
                    sets[cid] = s
                    held += len(s)
        if sets:
            yield flush()

    reply_schema = "flush long, kind int, a binary, b binary"

    def count(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = frame[frame["kind"] == 0][["flush", "kind", "a", "b"]]
        frame = frame[frame["kind"] == 1]
        if not len(frame):
            return out
        size = np.array([len(x) // 2 for x in frame["b"]])
        h = np.zeros((size.sum(), 8), np.uint8)
        at = 0
        for x, m in zip(frame["a"], size.tolist()):
            h[at:at + m, :5] = np.frombuffer(x, np.uint8).reshape(5, m).T
            at += m
        h = h.view("<u8").ravel()
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
        n_sets = np.diff(np.append(first, len(h)))
        times = np.empty(len(h), np.int64)
        times[order] = np.repeat(n_sets, n_sets)
        keep = times > 1
        token = (np.minimum(times, 255).astype(np.uint64) << np.uint64(56) | h << np.uint64(16)
                 | np.uint64(key[0] & 0xFFFF))
        idx = np.frombuffer(b"".join(frame["b"]), "<u2")
        rows, at = [], 0
        for f, m in zip(frame["flush"], size.tolist()):
            k = keep[at:at + m]
            if k.any():
                rows.append((f, 1, token[at:at + m][k].tobytes(), idx[at:at + m][k].tobytes()))
            at += m
        return pd.concat([out, pd.DataFrame(rows, columns=["flush", "kind", "a", "b"])], ignore_index=True)

    def gather(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        head = frame[frame["kind"] == 0].iloc[0]
        cids, size = np.frombuffer(head["a"], np.int64), np.frombuffer(head["b"], np.int64)
        tail = frame[frame["kind"] == 1]
        tokens = np.frombuffer(b"".join(tail["a"]), np.uint64)
        idx = np.frombuffer(b"".join(tail["b"]), "<u2").astype(np.int64)
        have = np.bincount(idx, minlength=len(cids))
        able = 100 * have >= percent * size
        keep = able[idx] if len(idx) else np.zeros(0, bool)
        tokens, idx = tokens[keep], idx[keep]
        order = np.lexsort((tokens, idx))
        tokens, idx = tokens[order], idx[order]
        used, first = np.unique(idx, return_index=True)
        cut = np.append(first, len(idx)).tolist()
        return pd.DataFrame({"cid": cids[used], "n": size[used],
                             "tokens": [tokens[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]})

    dealt = docs.select("text").mapInArrow(tidied(deal), schema)
    replies = dealt.groupBy("bucket").applyInPandas(count, reply_schema)
    sets = replies.groupBy("flush").applyInPandas(gather, "cid long, n long, tokens binary")
    return stage(sets.dropDuplicates(["cid"]), "shared-sets")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for cid, n, raw in zip(b.column("cid").to_pylist(), b.column("n").to_pylist(), b.column("tokens").to_pylist()):
                t = np.frombuffer(raw, np.int64)
                # Unshared shingles are the rarest, so they come first in the prefix.
                k = n - -(-percent * n // 100) + 1 - (n - len(t))
                yield pa.record_batch({"token": t[:k], "cid": np.full(min(k, len(t)), cid)})

    return sets.mapInArrow(tidied(run), "token long, cid long")


def _links(pairs: list[tuple[int, int]]) -> dict:
    return {"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())}


def linked_classes(sets: DataFrame, percent: int, piece: int) -> DataFrame:
    """(node, component) over class keys."""
    prefixes = stage(_prefixes(sets, percent), "prefixes")
    first = stage(prefixes.groupBy("token").agg(F.min("cid").alias("first"), F.count(F.lit(1)).alias("k"))
                  .where("k > 1").select("token", "first"), "prefix-groups")
    near = prefixes.join(first, "token").where("cid != first").select("cid", "first").distinct()
    cluster = components(near, "cid", "first").withColumnRenamed("component", "cluster")
    size = cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("k"))
    pieces = F.ceil(F.col("k") / F.lit(piece)).cast("int")
    # Pieces are numbered by rank-free hashing, so they hold about ``piece`` sets.
    rows = stage(sets.join(cluster.withColumnRenamed("node", "cid"), "cid"), "clusters")
    size = stage(size.withColumn("pieces", pieces), "cluster-sizes")
    rows = stage(rows.join(size, "cluster")
                 .withColumn("piece", F.pmod(F.xxhash64("cid"), F.col("pieces")).cast("int")), "pieces")
    hubs = (rows.where("pieces > 1 and cid = cluster")
            .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
            .where(F.col("piece") != F.pmod(F.xxhash64("cid"), F.col("pieces"))))
    cols = ["cluster", "piece", "cid", "n", "tokens"]
    inside = grouped(rows.select(*cols).unionByName(hubs.select(*cols)), ["cluster", "piece"], "cid",
                     lambda g: _links(join_piece(g, percent)), "a long, b long")
    inside = stage(inside, "piece-links")
    large = rows.where("pieces > 1")
    if large.isEmpty():
        return components(inside)
    label = stage(components(inside), "piece-components")
    large = stage(large.join(label.withColumnRenamed("node", "cid"), "cid", "left")
                  .withColumn("label", F.coalesce("component", "cid")).drop("component"), "large-clusters")
    main = (large.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("m"))
            .groupBy("cluster").agg(F.max(F.struct("m", "label")).alias("main"), F.sum("m").alias("all"))
            .select("cluster", F.col("main.label").alias("main"),
                    F.ceil((F.col("all") - F.col("main.m")) / F.lit(piece)).cast("int").alias("blocks"))
            .where("blocks > 0"))
    rest = large.join(stage(main, "main-components"), "cluster")
    cols = ["cluster", "block", "piece", "side", "cid", "n", "tokens", "label"]
    left = (rest.where("label != main").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
            .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("side", F.lit(0)))
    right = (rest.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("side", F.lit(1)))

    def blocks(g: list[dict]) -> dict:
        return _links(join_blocks([r for r in g if not r["side"]], [r for r in g if r["side"]], percent))

    across = grouped(left.select(*cols).unionByName(right.select(*cols)), ["cluster", "block", "piece"], "cid",
                     blocks, "a long, b long")
    return components(inside.unionByName(stage(across, "block-links")))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75,
            piece: int = 256, keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, the columns of ``keep``, n_shingles, component_id, kept (true for
    one row of each class: its first with the smallest doc_id): one row per row."""
    keep = keep or {}
    kept = tuple(keep)
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *[c.alias(k) for k, c in keep.items()])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch, texts in by_bytes(batches):
            sets = shingle_sets(texts, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", *kept)]
                + [np.arange(row, row + len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                   pa.array([class_key(s) if len(s) else None for s in sets], pa.int64())],
                names=["doc_id", *kept, "_row", "n_shingles", "cid"])
            row += len(sets)

    kinds = ", ".join(f"{c} {t}" for c, t in cols.drop("text").dtypes)
    rows = stage(cols.mapInArrow(tidied(name), f"{kinds}, _row long, n_shingles long, cid long"), "classes")
    found = linked_classes(_shared(cols, n, percent), percent, piece)
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("_row").alias("row"))
    own = rows.where("cid is not null").groupBy("cid").agg(F.min(least).alias("least"))
    own = own.join(found.withColumnRenamed("node", "cid"), "cid", "left").select(
        "cid", "least", F.coalesce("component", "cid").alias("component"))
    own = stage(own, "class-components")
    least = stage(own.groupBy("component").agg(F.min("least").alias("least")), "component-ids")
    ids = stage(own.select("cid", "component").join(least, "component")
                .select("cid", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("first")), "class-ids")
    out = rows.join(ids, "cid", "left")
    alone = F.col("cid").isNull()
    return out.select("doc_id", *kept, "n_shingles",
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (alone | (F.col("_row") == F.col("first"))).alias("kept"))
