"""Benchmark decontamination by winnowing.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the ASCII-lower-cased
UTF-8 text. In every window of ``window`` words the smallest hash of its
``k``-grams is kept as a fingerprint, so each shared window shares a
fingerprint. Test fingerprints go into a bit table of fixed bound; a training
fingerprint found there is extended to the windows around it, and those are
joined with the test windows on their hash, which settles each hit. An item
of fewer words is one window, looked up by its own length.

Null text has no words and no hit. An item without words matches nothing; a
null item id is ignored. Rows are told apart by a number of their own, so
repeated or null ids are separate documents. Empty tables: no document, or no
hit. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import by_bytes, stage, tidied
from airlens.llm.wordhash import ALNUM_SEP, Words, gram_hashes

MAX_BITS = 1 << 28           # 32 MB at most, whatever the benchmark's size
_CHUNK = 1 << 13


def window_minima_at(h: np.ndarray, w: int) -> np.ndarray:
    """For every ``w`` consecutive hashes the position of the smallest (the
    last of equals)."""
    m = len(h) - w + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    best, at, k = h.copy(), np.arange(len(h), dtype=np.int32), 1
    size = len(h)

    def merge(shift: int, size: int) -> int:
        n = size - shift
        later = best[shift:shift + n] <= best[:n]
        at[:n] = np.where(later, at[shift:shift + n], at[:n])
        best[:n] = np.where(later, best[shift:shift + n], best[:n])
        return n

    while 2 * k <= w:
        size = merge(k, size)
        k *= 2
    if w > k:
        size = merge(w - k, size)
    return at[:m]


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Those positions, each once."""
    return np.unique(window_minima_at(h, w))


def _test_rows(items: DataFrame, window: int, k: int) -> DataFrame:
    """kind 0: (window hash, length, item); kind 1: a fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_bytes(batches):
            words = Words(texts, ALNUM_SEP)
            kind, value, length, item = [], [], [], []
            for i, name in enumerate(batch.column("item_id").to_pylist()):
                h = words.hash[words.first[i]:words.first[i + 1]]
                n = min(window, len(h))
                if not n or name is None:
                    continue
                grams = np.unique(gram_hashes(h, n))
                prints = np.zeros(0, np.uint64)
                if n == window:
                    g = gram_hashes(h, k)
                    prints = np.unique(g[window_minima(g, window - k + 1)])
                for t, v in ((0, grams), (1, prints)):
                    kind += [t] * len(v)
                    value.append(v)
                    length += [n] * len(v)
                    item += [name] * len(v)
            yield pa.record_batch({
                "kind": pa.array(kind, pa.int32()), "hash": (np.concatenate(value) if value else np.zeros(0, np.uint64)).view(np.int64),
                "length": pa.array(length, pa.int32()), "item_id": pa.array(item, pa.string())})

    cols = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    return cols.mapInArrow(run, "kind int, hash long, length int, item_id string")


def _bit_table(prints: DataFrame, n: int) -> np.ndarray:
    """Bits set at hash mod size; 16 bits a fingerprint up to MAX_BITS."""
    bits = min(MAX_BITS, max(1 << 16, 1 << (16 * n - 1).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits // 8, np.uint8)
        for b in batches:
            at = np.asarray(b.column("hash")).view(np.uint64) & np.uint64(bits - 1)
            np.bitwise_or.at(table, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        rows = table.reshape(-1, _CHUNK)
        used = np.flatnonzero(rows.any(1))
        yield pa.record_batch({"chunk": pa.array(used, pa.int32()),
                               "bits": pa.array([rows[i].tobytes() for i in used], pa.binary())})

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in frame["bits"]])
        return pd.DataFrame({"chunk": [key[0]], "bits": [out.tobytes()]})

    schema = "chunk int, bits binary"
    got = prints.select("hash").mapInArrow(tidied(mark), schema).groupBy("chunk").applyInPandas(merge, schema).collect()
    table = np.zeros((bits // 8 // _CHUNK, _CHUNK), np.uint8)
    for r in got:
        table[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)
    return table.ravel()


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         window: int = 10, k: int = 5, keep: dict[str, Column] | None = None, with_text: bool = False) -> DataFrame:
    """doc_id, the columns of ``keep``, with ``with_text`` text, n_words, n_hit, items
    (sorted), spans (array of word spans hit)."""
    keep = keep or {}
    kept = ("doc_id", *keep, *(["text"] if with_text else []))
    spark = docs.sparkSession
    test = stage(_test_rows(items, window, k), "test-windows")
    n_prints = test.where("kind = 1").count()
    table = spark.sparkContext.broadcast(_bit_table(test.where("kind = 1"), n_prints))
    short = sorted(r["length"] for r in test.where(f"kind = 0 and length < {window}").select("length").distinct().collect())
    # Windows of fewer words are looked up through bits of their own.
    n_short = test.where(f"kind = 0 and length < {window}").count()
    short_table = spark.sparkContext.broadcast(
        _bit_table(test.where(f"kind = 0 and length < {window}"), n_short) if short else None)

    def found(table: np.ndarray, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(len(table) * 8 - 1)
        return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, few = table.value, short_table.value
        uid = TaskContext.get().partitionId() << 33
        for batch, texts in by_bytes(batches):
            words = Words(texts, ALNUM_SEP)
            keys, starts, lengths = [[] for _ in texts], [[] for _ in texts], [[] for _ in texts]

            def add(pos: np.ndarray, h: np.ndarray, n: int) -> None:
                d = words.doc[pos]
                own = pos + n <= words.first[d + 1]        # inside its text
                for p, i, v in zip(pos[own].tolist(), d[own].tolist(), h[own].view(np.int64).tolist()):
                    keys[i].append(v)
                    starts[i].append(p - int(words.first[i]))
                    lengths[i].append(n)

            if n_prints and len(words.hash) >= window:
                g = gram_hashes(words.hash, k)
                # Minima over text borders only add candidates; windows are checked below.
                at = window_minima(g, window - k + 1)
                at = at[found(bits, g[at])]
                near = np.unique(at[:, None] - np.arange(window - k + 1))
                near = near[(near >= 0) & (near + window <= len(words.hash))]
                add(near, gram_hashes(words.hash, window)[near], window)
            for n in short:
                g = gram_hashes(words.hash, n)
                at = np.flatnonzero(found(few, g))
                add(at, g[at], n)
            m = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + m))] + [batch.column(c) for c in kept]
                + [pa.array(words.count.astype(np.int64)), pa.array(keys, pa.list_(pa.int64())),
                   pa.array(starts, pa.list_(pa.int32())), pa.array(lengths, pa.list_(pa.int32()))],
                names=["uid", *kept, "n_words", "hash", "start", "length"])
            uid += m

    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *[c.alias(x) for x, c in keep.items()])
    types = dict(cols.dtypes)
    kinds = ", ".join(f"`{x}` {types[x]}" for x in kept)
    scan = stage(cols.mapInArrow(tidied(run), f"uid long, {kinds}, n_words long, hash array<long>, "
                                      "start array<int>, length array<int>"), "windows")
    cand = (scan.where("size(hash) > 0")
            .select("uid", F.explode(F.arrays_zip("hash", "start", "length")).alias("c"))
            .select("uid", "c.hash", "c.start", "c.length"))
    win = test.where("kind = 0").select("hash", "length", "item_id").distinct()
    match = cand.join(win, ["hash", "length"])
    # Spans and items of a text, each once (pre-aggregated before the shuffle).
    per = (match.groupBy("uid").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("spans"),
        F.collect_set("item_id").alias("items")))
    out = scan.select("uid", *kept, "n_words").join(per, "uid", "left")
    spans = F.array_sort(F.coalesce("spans", F.expr("array()").cast("array<struct<start:int,end:int>>")))
    n_hit = F.aggregate(
        spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["upto"]))).alias("n"),
            F.greatest(a["upto"], s["end"]).alias("upto")),
        lambda a: a["n"].cast("long"))
    return out.select(*kept, "n_words", n_hit.alias("n_hit"),
                      F.array_sort(F.coalesce("items", F.expr("array()").cast("array<string>"))).alias("items"),
                      spans.alias("spans"))
