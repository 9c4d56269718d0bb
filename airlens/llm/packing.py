"""Cost-balanced packing of documents into training sequences.

A piece of ``n`` tokens costs ``linear * n + quadratic * n**2`` (projections
and attention inside the piece). Documents are packed in pools of about
``pool_tokens`` tokens, one after another as a Spark partition streams by, so
nothing is shuffled and memory is one pool. In a pool, pieces go in
descending cost to the lowest-cost sequence that has room for them; a piece
that fits nowhere is cut at the sequence with most room. The pool's last
``total % length`` tokens fill sequences of a power of two, which need no
padding: no sequence of any pool is padded.

Every partition is a deterministic function of its rows, so a recomputed task
gives the same sequences; ids hold the partition number and a counter.

Null text: the empty document, whose only id is the end id. Repeated rows are
documents of their own. An empty table gives no piece. Other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import texts_of, tidied
from airlens.llm.tokens import shared_encoder

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long, sequence_cost double")


def pack_pool(lengths: list[int], capacity: int = 4096, linear: float = 1.0,
              quadratic: float = 1.0 / 4096) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one pool."""
    out: list[tuple[int, int, int, int, int]] = []
    total = sum(lengths)
    full, rest = divmod(total, capacity)
    # Whole-sequence pieces of long documents come first: they are the dearest.
    todo: list[tuple[int, int, int]] = []
    made = 0
    for d, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            out.append((d, k * capacity, capacity, made, 0))
            made += 1
        if n % capacity:
            todo.append((n % capacity, d, whole * capacity))
    todo.sort(key=lambda x: (-x[0], x[1]))
    open_ = full - made
    room = np.full(open_, capacity, np.int64)
    cost = np.zeros(open_)
    tail: list[tuple[int, int, int]] = []
    for n, d, start in todo:
        while n:
            fits = room >= n
            if fits.any():
                s, take = int(np.where(fits, cost, np.inf).argmin()), n
            elif open_ and (most := int(room.max())):
                s, take = int(np.where(room == most, cost, np.inf).argmin()), most
            else:
                tail.append((n, d, start))
                break
            out.append((d, start, take, made + s, capacity - int(room[s])))
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            n, start = n - take, start + take
    s, size, used = full - 1, 0, 0
    for n, d, start in tail:
        while n:
            if used == size:                    # the next power of two
                s, size, used = s + 1, 1 << (rest.bit_length() - 1), 0
                rest -= size
            take = min(n, size - used)
            out.append((d, start, take, s, used))
            used, n, start = used + take, n - take, start + take
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
         end_id: int = 2, pool_tokens: int = 1 << 20, linear: float = 1.0,
         quadratic: float = 1.0 / 4096, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece (``SCHEMA``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer_path)
        base = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal base, held
            lengths = [len(t) for t in tokens]
            pieces = pack_pool(lengths, capacity, linear, quadratic)
            d, start, n, seq, offset = (np.array(x, np.int64) for x in zip(*pieces))
            seq_tokens = np.bincount(seq, n).astype(np.int64)
            seq_cost = np.bincount(seq, linear * n + quadratic * n.astype(float) ** 2)
            crc = [zlib.crc32(tokens[a][b:b + c].astype("<u4").tobytes())
                   for a, b, c in zip(d.tolist(), start.tolist(), n.tolist())]
            out = pa.record_batch({
                "doc_id": pa.array(ids, pa.int64()).take(pa.array(d)),
                "start": start, "length": n, "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": np.array(lengths, np.int64)[d],
                "sequence_id": seq + base, "offset": offset,
                "sequence_tokens": seq_tokens[seq], "sequence_cost": seq_cost[seq]})
            base += len(seq_tokens)
            ids.clear()
            tokens.clear()
            held = 0
            return out

        end = np.array([end_id], "<u2")
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                t = np.concatenate((encoder.encode(text), end))
                ids.append(i)
                tokens.append(t)
                held += len(t)
                if held >= pool_tokens:
                    yield flush()
        if tokens:
            yield flush()

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(tidied(run, "tokens"), SCHEMA)
