"""Connected components of a link table, by alternating large and small stars.

Every round links each node to the smallest of its neighbours, first from the
larger side, then from the smaller, until the links are stars around each
component's smallest node. Links of a task are first replaced by a spanning
star of each local component. Each step is a pre-aggregated minimum, staged so
that the join after it has a plain exchange on both sides, which Spark may
split if one node has a large share of all links. What is left of the links
after the first step is counted: up to ``small`` of them are solved in one task
of so much memory, which saves the rounds' many short jobs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import stage


class UnionFind:
    def __init__(self, n: int):
        self.parent = list(range(n))
        self.sets = n

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.sets -= 1
        return True


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its local component) for nodes that are not it."""
    names, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    uf = UnionFind(len(names))
    for x, y in zip(at[:len(a)].tolist(), at[len(a):].tolist()):
        uf.union(x, y)
    root = np.array([uf.find(i) for i in range(len(names))], np.int64)
    own = root != np.arange(len(names))
    return names[own], names[root[own]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        u, v = stars(np.asarray(b.column("u")), np.asarray(b.column("v")))
        if len(u):
            yield pa.record_batch({"u": u, "v": v})


def _print(df: DataFrame) -> tuple:
    r = df.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return r["n"], r["x"]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(np.asarray(b.column("u")), np.asarray(b.column("v"))) for b in batches if b.num_rows]
    if held:
        u, v = stars(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
        roots = np.unique(v)
        yield pa.record_batch({"node": np.concatenate((u, roots)), "component": np.concatenate((v, roots))})


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60,
               small: int = 1_000_000) -> DataFrame:
    """(node, component): component is the smallest node reachable. Only nodes
    with a link to another node are returned; nulls link nothing."""
    e = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u != v")
    e = stage(e.mapInArrow(_contract, "u long, v long").distinct(), "links")
    before = _print(e)
    if before[0] <= small:
        return stage(e.coalesce(1).mapInArrow(_solve, "node long, component long"), "components")
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")), "least")
        large = stage(both.join(least, "u").where("v > u")
                      .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large-star")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select("v", "m").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = _print(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
