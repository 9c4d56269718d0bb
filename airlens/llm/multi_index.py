"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are cut in halves, each half has a codebook of its own (k-means on
a bounded sample of ``sample`` vectors), and the product grid of the two is the
index: every vector lies in the cell of its nearest codewords. A query visits
cells in the order of the summed distances of its halves (multi-sequence
traversal: the first T cells lie among the rank pairs (i, j) with
(i + 1)(j + 1) <= T). T is the largest of three numbers, each the least that
reaches ``target`` recall: on the true pairs of ``probe`` sample vectors, found
by brute force against all vectors; on the same pairs with each sample vector
weighing 1, so that a large group of near copies does not decide for the others;
and on sample vectors turned to the threshold's angle, the hardest links.
Every vector is indexed and every vector queries; cells that hold no vector are
left out. What a cell holds is then
verified in double precision, so no pair below the threshold is linked.

Equal vectors are one class, so copies are not expanded. A cell's vectors and
its visitors are cut in blocks. A pair met from both sides counts once: each row
carries the cells it visits. Blocks give sums and spanning stars, never pairs.

Only vectors of one length can link, so each length that several rows share has an
index of its own, built one after the other. Null, zero, or not wholly finite
vectors link with nothing: n_links 0, their own component. Repeated
rows and ids are vectors of their own. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import grouped, stage
from airlens.llm.components import components


def _units(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(usable, unit vectors of the usable ones) of a list column."""
    ok = np.zeros(len(column), bool)
    out = []
    for i, v in enumerate(column):
        if not v.is_valid or len(v.values) != dim or v.values.null_count:
            continue
        x = np.asarray(v.values, dtype=np.float64)
        big = np.abs(x).max() if np.isfinite(x).all() else 0
        if not big:
            continue
        x = x / big                          # no overflow, no underflow
        out.append(x / np.sqrt(x @ x) + 0.0)
        ok[i] = True
    return ok, np.array(out).reshape(-1, dim)


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, c).argmin(1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0][:, None]
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)


@functools.cache
def _rank_pairs(t: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.divmod(np.arange(k * k), k)
    keep = (i + 1) * (j + 1) <= t
    return i[keep], j[keep]


class Grid:
    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.half = first.shape[1]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, :self.half], self.first), _distances(x[:, self.half:], self.second)

    def traverse(self, x: np.ndarray, t: int) -> np.ndarray:
        """The ``t`` nearest cells of each vector, nearest first."""
        k = len(self.first)
        t = min(t, k * k)
        d1, d2 = self.halves(x)
        o1, o2 = d1.argsort(1, kind="stable"), d2.argsort(1, kind="stable")
        i, j = _rank_pairs(t, k)
        row = np.arange(len(x))[:, None]
        c1, c2 = o1[row, i], o2[row, j]
        order = (d1[row, c1] + d2[row, c2]).argsort(1, kind="stable")[:, :t]
        return (c1[row, order] * k + c2[row, order]).astype(np.int32)

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many cells vector x[i] visits before the cell of y[i]."""
        d1, d2 = self.halves(x)
        e1, e2 = self.halves(y)
        at = np.arange(len(x))
        own = d1[at, e1.argmin(1)] + d2[at, e2.argmin(1)]
        return np.array([int(((a[:, None] + b) < s - 1e-12).sum()) for a, b, s in zip(d1, d2, own)], np.int64)


def _fit(reps: DataFrame, n: int, dim: int, threshold: float, target: float, sample: int, probe: int,
         per_cell: int, seed: int) -> tuple[Grid, int]:
    rows = reps.orderBy(F.xxhash64("cid"), "cid").limit(sample).collect()
    x = np.array([np.frombuffer(r["vec"], np.float64) for r in rows])
    k = int(max(1, min(round((n / per_cell) ** 0.5), len(x) // 8, 512)))
    half = max(1, dim // 2)
    grid = Grid(kmeans(x[:, :half], k, 10, seed), kmeans(x[:, half:], k, 10, seed + 1))
    queries = x[:probe]
    shared = reps.sparkSession.sparkContext.broadcast((grid, queries))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, q = shared.value
        cells = len(grid.first) * len(grid.second)
        for b in batches:
            y = np.array([np.frombuffer(v, np.float64) for v in b.column("vec").to_pylist()]).reshape(-1, q.shape[1])
            for a in range(0, len(y), 1024):
                part = y[a:a + 1024]
                i, j = np.nonzero(q @ part.T >= threshold)
                other = (q[i] != part[j]).any(1)
                i, j = i[other], j[other]
                rank = [grid.ranks(q[i[c:c + 512]], part[j[c:c + 512]]) for c in range(0, len(i), 512)]
                own, m = np.unique(i * cells + (np.concatenate(rank) if rank else 0), return_counts=True)
                yield pa.record_batch({"probe": (own // cells).astype(np.int32), "rank": own % cells,
                                       "n": m.astype(np.int64)})

    met = stage(reps.select("vec").mapInArrow(meet, "probe int, rank long, n long")
                .groupBy("probe", "rank").agg(F.sum("n").alias("n")), "probe-ranks")
    degree = np.ones(len(queries))
    for r in met.groupBy("probe").agg(F.sum("n").alias("n")).collect():
        degree[r["probe"]] = r["n"]
    shares = reps.sparkSession.createDataFrame(list(enumerate((1 / degree).tolist())), "probe int, share double")
    # Ranks are less than the number of cells, so the histogram is bounded.
    seen = (met.join(F.broadcast(shares), "probe").groupBy("rank")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("share")).alias("w")).orderBy("rank").collect())
    rng = np.random.default_rng(seed)
    q = queries[rng.integers(0, len(queries), 1000)]
    side = rng.normal(size=q.shape)
    side -= (side * q).sum(1, keepdims=True) * q
    side /= np.maximum(np.sqrt((side * side).sum(1, keepdims=True)), 1e-12)
    turned = threshold * q + max(0.0, 1 - threshold ** 2) ** 0.5 * side
    t = max(visits_for(target, [r["rank"] for r in seen], [r["n"] for r in seen]),
            visits_for(target, [r["rank"] for r in seen], [r["w"] for r in seen]),
            visits_for(target, *np.unique(grid.ranks(q, turned), return_counts=True)))
    return grid, min(t, k * k)


def visits_for(target: float, ranks: list[int], weights: list[float]) -> int:
    """How many cells to visit so that ``target`` of the weight is met; ranks ascend."""
    total = np.cumsum(weights)
    return int(ranks[int((total < target * total[-1] - 1e-9).sum())]) + 1 if len(ranks) else 1


def _verify(threshold: float):
    def run(rows: list[dict]) -> dict:
        left, right = [r for r in rows if not r["role"]], [r for r in rows if r["role"]]
        if not left or not right:
            return {"kind": pa.array([], pa.int32()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())}
        cid = [np.array([r["cid"] for r in side], np.int64) for side in (left, right)]
        x, y = (np.array([np.frombuffer(r["vec"], np.float64) for r in side]) for side in (left, right))
        met = x @ y.T >= threshold
        met &= cid[0][:, None] != cid[1]
        # A pair met in both cells counts where the visitor has the smaller key.
        home = np.array([np.frombuffer(r["visits"], np.int32)[0] for r in left])
        visits = np.array([np.frombuffer(r["visits"], np.int32) for r in right])
        i, j = np.nonzero(met)
        both = np.concatenate([(visits[j[c:c + 65536]] == home[i[c:c + 65536], None]).any(1)
                               for c in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
        once = ~both | (cid[0][i] < cid[1][j])
        copies = [np.array([r["copies"] for r in side], float) for side in (left, right)]
        n = [np.bincount(i[once], copies[1][j[once]], len(left)), np.bincount(j[once], copies[0][i[once]], len(right))]
        # Spanning stars: every vector takes the smallest label it meets.
        names, at = np.unique(np.concatenate(cid), return_inverse=True)
        a, b = at[:len(left)][i], at[len(left):][j]
        label = np.arange(len(names))
        while True:
            new = label.copy()
            np.minimum.at(new, a, label[b])
            np.minimum.at(new, b, label[a])
            new = new[new]
            if (new == label).all():
                break
            label = new
        star = np.flatnonzero(label != np.arange(len(names)))
        out_a = np.concatenate((cid[0][n[0] > 0], cid[1][n[1] > 0], names[star]))
        out_b = np.concatenate((n[0][n[0] > 0], n[1][n[1] > 0])).astype(np.int64)
        kind = np.repeat([0, 1], [len(out_b), len(star)]).astype(np.int32)
        return {"kind": kind, "a": out_a, "b": np.concatenate((out_b, names[label[star]]))}

    return run


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.95, target: float = 0.995, sample: int = 8192, probe: int = 1024,
                    per_cell: int = 8, block: int = 256, seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row."""
    cols = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    shared_length = cols.where("size(v) > 0").groupBy(F.size("v").alias("d")).count().where("count > 1")
    dims = sorted(r["d"] for r in shared_length.collect())
    in_some = F.coalesce(F.size("v").isin(dims), F.lit(False))
    out = cols.where(~in_some).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for dim in dims:
        out = out.unionByName(_of_length(cols.where(F.size("v") == dim), dim, threshold, target, sample, probe, per_cell, block, seed))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _of_length(cols: DataFrame, dim: int, threshold: float, target: float, sample: int, probe: int, per_cell: int,
               block: int, seed: int) -> DataFrame:
    """vec_id, n_links, component_id of vectors of one length."""

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok, x = _units(b.column("v"), dim)
            raw = [v.tobytes() for v in x]
            key = [int.from_bytes(hashlib.blake2b(v, digest_size=8).digest(), "little", signed=True) for v in raw]
            at = np.cumsum(ok) - 1
            yield pa.record_batch({
                "vec_id": b.column("vec_id"),
                "cid": pa.array([key[k] if o else None for k, o in zip(at.tolist(), ok.tolist())], pa.int64()),
                "vec": pa.array([raw[k] if o else None for k, o in zip(at.tolist(), ok.tolist())], pa.binary())})

    rows = stage(cols.mapInArrow(unit, "vec_id long, cid long, vec binary"), "unit-vectors")
    reps = stage(rows.where("cid is not null").groupBy("cid").agg(
        F.min("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")), "vectors")
    n = reps.count()
    if n:
        grid, t = _fit(reps, n, dim, threshold, target, sample, probe, per_cell, seed)
    else:
        grid, t = Grid(np.zeros((1, 1)), np.zeros((1, 1))), 1
    shared = reps.sparkSession.sparkContext.broadcast(grid)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column("vec").to_pylist()
            for a in range(0, len(raw), 1024):
                x = np.array([np.frombuffer(v, np.float64) for v in raw[a:a + 1024]])
                cells = shared.value.traverse(x, t)
                yield pa.record_batch({
                    "cid": b.column("cid").slice(a, 1024), "vec": b.column("vec").slice(a, 1024),
                    "copies": b.column("copies").slice(a, 1024),
                    "cells": pa.array(list(cells), pa.list_(pa.int32())),
                    "visits": pa.array([c.tobytes() for c in cells], pa.binary())})

    placed = stage(reps.select("cid", "vec", "copies").mapInArrow(
        visit, "cid long, vec binary, copies long, cells array<int>, visits binary"), "visits")
    indexed = placed.select(F.col("cells")[0].alias("cell"), F.lit(1).alias("role"), "cid", "vec", "copies", "visits")
    # There are 512 x 512 cells at most. A visitor is asked only for its own cell.
    held = stage(placed.groupBy(F.col("cells")[0].alias("cell")).agg(F.count(F.lit(1)).alias("k")), "held-cells")
    probes = placed.select(F.explode("cells").alias("cell"), F.lit(0).alias("role"), "cid", "vec", "copies",
                           F.substring("visits", 1, 4).alias("visits"))
    probes = probes.join(F.broadcast(held.select("cell")), "cell", "left_semi")
    load = (placed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
            .join(held, "cell")
            .select("cell", F.ceil(F.col("k") / block).cast("int").alias("iblocks"),
                    F.ceil(F.col("m") / (2 * block)).cast("int").alias("pblocks"))
            .where("iblocks > 1 or pblocks > 1"))
    load = stage(load, "crowded-cells")
    both = indexed.unionByName(probes).join(load, "cell", "left")
    nb = {c: F.coalesce(c, F.lit(1)) for c in ("iblocks", "pblocks")}
    # One side is dealt to its block by hash, the other goes to all of them.
    part = F.pmod(F.xxhash64("cid"), F.when(F.col("role") == 1, nb["iblocks"]).otherwise(nb["pblocks"])).cast("int")
    copy = F.sequence(F.lit(0), F.when(F.col("role") == 1, nb["pblocks"]).otherwise(nb["iblocks"]) - 1)
    dealt = (both.withColumn("own", part).withColumn("other", F.explode(copy))
             .select("cell", F.when(F.col("role") == 1, F.col("own")).otherwise(F.col("other")).alias("ib"),
                     F.when(F.col("role") == 1, F.col("other")).otherwise(F.col("own")).alias("pb"),
                     "role", "cid", "vec", "copies", "visits"))
    met = stage(grouped(dealt, ["cell", "ib", "pb"], "cid", _verify(threshold), "kind int, a long, b long"), "met")
    links = met.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("links"))
    found = components(met.where("kind = 1").select("a", "b"))
    own = (reps.select("cid", "copies", "least").join(links, "cid", "left")
           .join(found.withColumnRenamed("node", "cid"), "cid", "left")
           .select("cid", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                   F.coalesce("component", "cid").alias("component")))
    own = stage(own, "vector-components")
    least = stage(own.groupBy("component").agg(F.min("least").alias("component_id")), "vector-component-ids")
    ids = stage(own.join(least, "component").select("cid", "n_links", "component_id"), "vector-ids")
    out = rows.select("vec_id", "cid").join(ids, "cid", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                     F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
