"""Exact-substring removal with suffix arrays by external induced sorting.

Every byte that lies in a ``length``-byte string which also starts anywhere else
(same document included, overlaps too) is marked on the input; matches never
cross documents.

Equal strings must share the place of their least ``k``-gram hash (their anchor),
so the work of comparing strings is dealt out by anchors:

1. Texts are kept in compressed blocks. Each string has one anchor; an anchor's
   strings are a run of neighbouring starts. Anchor and run hashes, each once a
   block, are counted by hash. An anchor seen once ends there; a run seen twice
   is repeated as a whole (the inside of copies), and if all runs of its anchor
   are equal, that is all there is.
2. The other runs of shared anchors (edges of copies, short passages) are cut into
   strips of at most ``strip`` starts at equal distance from the anchor; all
   strings of a strip contain its core. Cores are counted like anchors, and
   strips of a core seen once end there.
3. Strips of one core meet in one shard, equal ones kept once. A shard's strips
   are one text; its suffix and common-prefix arrays (``induced.py``) tell which
   strings have a neighbour with a common prefix of ``length``.
4. A core of more than ``hot`` strips would put an unbounded group into a shard; its
   strings are a group each and counted by hash like anchors.

Only counts and positions go back to the blocks. Null text is empty. Repeated
rows are documents, so they repeat each other. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import by_bytes, partitions, stage, tidied
from airlens.llm.decontamination import window_minima_at
from airlens.llm.induced import suffix_array
from airlens.llm.wordhash import mix, prefix_hashes, span_hashes, window_hashes

K = 32
SHARDS = 4                   # shards a shuffle partition: one is sorted at a time


def _zip(data: bytes) -> bytes:
    return pa.Codec("zstd", 3).compress(data, asbytes=True)


def _unzip(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(data, size), np.uint8) if size else np.zeros(0, np.uint8)


def runs_of(data: np.ndarray, sizes: np.ndarray, length: int, k: int) -> np.ndarray:
    """(anchor, first start, last start) of every run of a block."""
    if len(data) < length:
        return np.zeros((0, 3), np.int64)
    # The upper half of the hashes orders as well, in half the memory.
    h = (window_hashes(prefix_hashes(data), k) >> np.uint64(32)).astype(np.uint32)
    anchor = window_minima_at(h, length - k + 1)             # of the string at each start
    del h
    offset = np.concatenate(([0], np.cumsum(sizes)))
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[:len(anchor)]
    inside = np.zeros(len(anchor), bool)
    for a, b in zip(offset[:-1].tolist(), offset[1:].tolist()):
        inside[a:max(a, b - length + 1)] = True
    start = np.flatnonzero(inside)
    anchor, doc = anchor[inside].astype(np.int64), doc[inside]
    if not len(start):
        return np.zeros((0, 3), np.int64)
    # Starts of one anchor are neighbours, but a text border may cut a run.
    edge = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(doc) != 0))
    first, last = np.append(0, edge + 1), np.append(edge, len(start) - 1)
    return np.stack((anchor[first], start[first], start[last]), 1)


def blocks_of(docs: DataFrame, id_col: str, text_col: str, keep: dict[str, Column], length: int, k: int) -> DataFrame:
    """One row per run of texts of about 1 MB."""
    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *[c.alias(n) for n, c in keep.items()])
    kept = ("doc_id", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch, texts in by_bytes(batches):
            joined = b"".join(texts)
            data = np.frombuffer(joined, np.uint8)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            runs = runs_of(data, sizes, length, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64())]
                + [pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), _flat(batch.column(c))) for c in kept]
                + [pa.array([sizes.tobytes()], pa.binary()), pa.array([len(joined)], pa.int64()),
                   pa.array([_zip(joined)], pa.binary()), pa.array([runs[:, 0].astype("<u4").tobytes()], pa.binary()),
                   pa.array([(runs[:, 0:1] - runs[:, 1:]).astype(_back_type(length, k)).tobytes()], pa.binary())],
                names=["block", *kept, "sizes", "n", "data", "anchors", "spans"])
            block += 1

    kinds = ", ".join(f"`{n}` array<{t}>" for n, t in cols.select(*kept).dtypes)
    schema = f"block long, {kinds}, sizes binary, n long, data binary, anchors binary, spans binary"
    return stage(cols.mapInArrow(tidied(run), schema), "text-blocks", blobs=True)


def _flat(column: pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else pa.concat_arrays([column])


def _back_type(length: int, k: int) -> str:
    """Type of the distance from a start to its anchor."""
    return "u1" if length - k < 256 else "<u4"


def _runs(row, length: int, k: int) -> np.ndarray:
    anchor = np.frombuffer(row["anchors"], "<u4").astype(np.int64)
    back = np.frombuffer(row["spans"], _back_type(length, k)).astype(np.int64).reshape(-1, 2)
    return np.column_stack((anchor, anchor[:, None] - back))


def shared_hashes(hashes: DataFrame, buckets: int) -> DataFrame:
    """(block, hashes, times) of the hashes counted twice or more in all blocks.
    ``hashes``: (block, hashes, times), each hash once a block."""
    schema = "bucket int, block long, hashes binary, times binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                h, n = np.frombuffer(r["hashes"], np.uint64), np.frombuffer(r["times"], "<u2")
                b = ((h >> np.uint64(17)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(b, kind="stable")
                used, first = np.unique(b[order], return_index=True)
                cut = np.append(first, len(h)).tolist()
                h, n = h[order], n[order]
                spans = list(zip(cut[:-1], cut[1:]))
                yield pa.record_batch({
                    "bucket": pa.array(used, pa.int32()), "block": pa.array([r["block"]] * len(spans), pa.int64()),
                    "hashes": pa.array([h[x:y].tobytes() for x, y in spans], pa.binary()),
                    "times": pa.array([n[x:y].tobytes() for x, y in spans], pa.binary())})

    def count(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        size = [len(x) // 8 for x in frame["hashes"]]
        h = np.frombuffer(b"".join(frame["hashes"]), np.uint64)
        n = np.frombuffer(b"".join(frame["times"]), "<u2")
        _, at = np.unique(h, return_inverse=True)
        total = np.minimum(np.bincount(at, n)[at], 65535).astype("<u2")
        keep, rows, x = total > 1, [], 0
        for b, m in zip(frame["block"], size):
            k = keep[x:x + m]
            if k.any():
                rows.append((b, h[x:x + m][k].tobytes(), total[x:x + m][k].tobytes()))
            x += m
        return pd.DataFrame(rows, columns=["block", "hashes", "times"])

    return hashes.mapInArrow(tidied(deal), schema).groupBy("bucket").applyInPandas(
        count, "block long, hashes binary, times binary")


def _unique(h: np.ndarray) -> tuple[bytes, bytes]:
    own, n = np.unique(h, return_counts=True)
    return own.tobytes(), np.minimum(n, 65535).astype("<u2").tobytes()


def _reply(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and their totals of a block's replies."""
    h = np.frombuffer(b"".join(frame["hashes"]), np.uint64)
    n = np.frombuffer(b"".join(frame["times"]), "<u2")
    order = np.argsort(h, kind="stable")
    return h[order], n[order].astype(np.int64)


def _total(reply: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> np.ndarray:
    known, n = reply
    if not len(known):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, n[at], 0)


def _run_hashes(data: np.ndarray, runs: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    prefix = prefix_hashes(data)
    return (span_hashes(prefix, runs[:, 0], runs[:, 0] + k),
            mix(span_hashes(prefix, runs[:, 1], runs[:, 2] + length) + np.uint64(1)))


def _joined(start: np.ndarray, length: int) -> tuple[bytes, bytes]:
    """Packed (first bytes, ends) of the spans that strings at neighbouring starts cover together."""
    edge = np.flatnonzero(np.diff(start) != 1)
    first, last = np.append(0, edge + 1)[:len(start)], np.append(edge, len(start) - 1)[:len(start)]
    return start[first].astype("<u4").tobytes(), (start[last] + length).astype("<u4").tobytes()


def find_repeats(blocks: DataFrame, length: int, k: int, strip: int, hot: int) -> DataFrame:
    """(block, starts, ends): spans of repeated strings, not merged."""
    buckets = partitions(blocks.sparkSession)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                runs = _runs(r, length, k)
                if len(runs):
                    a, b = _run_hashes(_unzip(r["data"], r["n"]), runs, length, k)
                    h, n = _unique(np.concatenate((a, b)))
                    yield pa.record_batch({"block": [r["block"]], "hashes": [h], "times": [n]})

    triple = "block long, hashes binary, times binary"
    texts = blocks.select("block", "n", "data", "anchors", "spans")
    reply = shared_hashes(texts.mapInArrow(tidied(anchors), triple), buckets)

    strip_schema = ("block long, starts binary, ends binary, strip_lo binary, strip_hi binary, cores binary, "
                    "n long, data binary")

    def strips(key: tuple, block: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(reply):
            return pd.DataFrame([], columns=[c.split()[0] for c in strip_schema.split(", ")])
        row = block.iloc[0]
        data, runs, known = _unzip(row["data"], int(row["n"])), _runs(row, length, k), _reply(reply)
        a, b = _run_hashes(data, runs, length, k)
        n_anchor, n_run = _total(known, a), _total(known, b)
        whole = n_run > 1
        # A repeated run is settled, but another run of its anchor may repeat a
        # part of it: one of each kind stays for that. (Counts end at 65535.)
        others = (n_anchor > n_run) | (n_anchor == 65535)
        kind = np.zeros(len(runs), bool)
        kind[np.unique(b, return_index=True)[1]] = True
        edge = runs[(n_anchor > 1) & others & (~whole | kind)]
        # Strips by the distance from start to anchor, so that equal strings agree.
        lo_d, hi_d = edge[:, 0] - edge[:, 2], edge[:, 0] - edge[:, 1]
        n = hi_d // strip - lo_d // strip + 1
        at = np.repeat(np.arange(len(edge)), n)
        s = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo_d // strip, n)
        anchor = edge[at, 0]
        first = np.maximum(edge[at, 1], anchor - strip * s - (strip - 1))
        last = np.minimum(edge[at, 2], anchor - strip * s)
        core_from = anchor - strip * s
        prefix = prefix_hashes(data)
        core = mix(span_hashes(prefix, core_from, core_from - (strip - 1) + length)
                   + s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(2))
        joined = b"".join(data[x:y].tobytes() for x, y in zip(first.tolist(), (last + length).tolist()))
        return pd.DataFrame([{
            "block": key[0], "starts": runs[whole, 1].astype("<u4").tobytes(),
            "ends": (runs[whole, 2] + length).astype("<u4").tobytes(),
            "strip_lo": first.astype("<u4").tobytes(), "strip_hi": last.astype("<u4").tobytes(),
            "cores": core.tobytes(), "n": len(joined), "data": _zip(joined)}])

    cut = stage(texts.groupBy("block").cogroup(reply.groupBy("block")).applyInPandas(strips, strip_schema), "strips", blobs=True)

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                h, n = _unique(np.frombuffer(r["cores"], np.uint64))
                if h:
                    yield pa.record_batch({"block": [r["block"]], "hashes": [h], "times": [n]})

    reply = shared_hashes(cut.select("block", "cores").mapInArrow(tidied(cores), triple), buckets)
    send_schema = "kind int, shard int, block long, lo binary, sizes binary, hashes binary, n long, data binary"

    def send(key: tuple, strips: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in send_schema.split(", ")]
        if not len(strips) or not len(reply):
            return pd.DataFrame([], columns=names)
        row, known = strips.iloc[0], _reply(reply)
        lo, hi = (np.frombuffer(row[c], "<u4").astype(np.int64) for c in ("strip_lo", "strip_hi"))
        core = np.frombuffer(row["cores"], np.uint64)
        total = _total(known, core)
        data = _unzip(row["data"], int(row["n"]))
        size = hi - lo + length
        at = np.cumsum(size) - size
        out = []
        shard = np.where((total > 1) & (total <= hot), ((core >> np.uint64(21)) % np.uint64(SHARDS * buckets)).astype(np.int64), -1)
        order = np.argsort(shard, kind="stable")
        used, first = np.unique(shard[order], return_index=True)
        bounds = np.append(first, len(shard)).tolist()
        for s, x, y in zip(used.tolist(), bounds[:-1], bounds[1:]):
            if s < 0:
                continue
            mine = order[x:y]
            joined = b"".join(data[a:a + n].tobytes() for a, n in zip(at[mine].tolist(), size[mine].tolist()))
            out.append((0, s, key[0], lo[mine].astype("<u4").tobytes(), size[mine].astype("<u4").tobytes(), None,
                        len(joined), _zip(joined)))
        many = np.flatnonzero(total > hot)
        if len(many):
            prefix = prefix_hashes(data)
            n = size[many] - length + 1
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            where = np.repeat(at[many], n) + step
            h = span_hashes(prefix, where, where + length)
            out.append((1, -1, key[0], (np.repeat(lo[many], n) + step).astype("<u4").tobytes(), None, h.tobytes(), 0, None))
        return pd.DataFrame(out, columns=names)

    sent = stage(cut.select("block", "strip_lo", "strip_hi", "cores", "n", "data").groupBy("block")
                 .cogroup(reply.groupBy("block")).applyInPandas(send, send_schema), "strips-sent", blobs=True)
    span_schema = "block long, starts binary, ends binary"

    def sort_shard(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        # Equal strips are one, so a shard's text holds distinct ones only.
        names: dict[bytes, int] = {}
        times: list[int] = []
        rows = []
        for r in frame.itertuples():
            data = _unzip(r.data, r.n).tobytes()
            size = np.frombuffer(r.sizes, "<u4").tolist()
            ids, x = [], 0
            for n in size:
                part = data[x:x + n]
                i = names.setdefault(part, len(names))
                if i == len(times):
                    times.append(0)
                times[i] += 1
                ids.append(i)
                x += n
            rows.append((r.block, np.frombuffer(r.lo, "<u4").astype(np.int64), np.array(ids, np.int64)))
        size = np.fromiter(map(len, names), np.int64, len(names))
        # A separator behind each strip: a byte that UTF-8 never has.
        text = np.frombuffer(b"\xff".join(names) + b"\xff", np.uint8)
        base = np.cumsum(size + 1) - size - 1
        order, common = suffix_array(text)
        owner = np.repeat(np.arange(len(size)), size + 1)
        starts_string = np.arange(len(text)) + length <= (base + size)[owner]
        # Neighbours among the starts of strings; what lies between only shortens.
        mine = np.flatnonzero(starts_string[order])
        repeated = np.zeros(len(text), bool)
        if len(mine) > 1:
            least = np.minimum.reduceat(common[:mine[-1] + 1], mine[:-1] + 1)
            same = least >= length
            repeated[order[mine[1:]][same]] = True
            repeated[order[mine[:-1]][same]] = True
        repeated |= np.array(times)[owner] > 1
        out = []
        for block, lo, ids in rows:
            n = size[ids] - length + 1
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            hit = repeated[np.repeat(base[ids], n) + step]
            out.append((block, *_joined((np.repeat(lo, n) + step)[hit], length)))
        return pd.DataFrame(out, columns=["block", "starts", "ends"])

    sorted_ = sent.where("kind = 0").groupBy("shard").applyInPandas(sort_shard, span_schema)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                h, n = _unique(np.frombuffer(r["hashes"], np.uint64))
                yield pa.record_batch({"block": [r["block"]], "hashes": [h], "times": [n]})

    crowded = sent.where("kind = 1").select("block", "lo", "hashes")
    reply = shared_hashes(crowded.mapInArrow(tidied(strings), triple), buckets)

    def place(key: tuple, mine: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(reply):
            return pd.DataFrame([], columns=["block", "starts", "ends"])
        lo = np.frombuffer(b"".join(mine["lo"]), "<u4").astype(np.int64)
        start = lo[_total(_reply(reply), np.frombuffer(b"".join(mine["hashes"]), np.uint64)) > 1]
        return pd.DataFrame([(key[0], *_joined(start, length))], columns=["block", "starts", "ends"])

    placed = crowded.groupBy("block").cogroup(reply.groupBy("block")).applyInPandas(place, span_schema)
    return cut.select("block", "starts", "ends").unionByName(sorted_).unionByName(placed)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                   strip: int = 24, hot: int = 512, keep: dict[str, Column] | None = None,
                   with_text: bool = False) -> DataFrame:
    """doc_id, the columns of ``keep``, n_bytes, n_removed, n_spans, kept_sha256,
    and with ``with_text`` text: the kept bytes (a character whose bytes are not
    all kept is left out)."""
    keep = keep or {}
    kept = ("doc_id", *keep)
    k = min(K, max(1, length // 4))
    strip = min(strip, max(1, length // 4))
    blocks = blocks_of(docs, id_col, text_col, keep, length, k)
    spans = find_repeats(blocks, length, k, strip, hot)
    types = dict(blocks.dtypes)
    schema = ", ".join(f"`{c}` {types[c].removeprefix('array<')[:-1]}" for c in kept)
    schema += ", n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", text string" if with_text else "")

    def finish(key: tuple, block: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0]
        n = int(row["n"])
        data = _unzip(row["data"], n)
        depth = np.zeros(n + 1, np.int64)
        np.add.at(depth, np.frombuffer(b"".join(spans["starts"]), "<u4"), 1)
        np.add.at(depth, np.frombuffer(b"".join(spans["ends"]), "<u4"), -1)
        gone = np.cumsum(depth[:-1]) > 0
        size = np.frombuffer(row["sizes"], np.int64)
        cut = np.concatenate(([0], np.cumsum(size))).tolist()
        out = {c: row[c] for c in kept}
        removed, runs, digest, texts = [], [], [], []
        for a, b in zip(cut[:-1], cut[1:]):
            g = gone[a:b]
            removed.append(int(g.sum()))
            runs.append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
            left = data[a:b][~g].tobytes() if removed[-1] else data[a:b].tobytes()
            digest.append(hashlib.sha256(left).hexdigest())
            if with_text:
                texts.append(left.decode("utf-8", "ignore"))
        out |= {"n_bytes": size, "n_removed": removed, "n_spans": runs, "kept_sha256": digest}
        if with_text:
            out["text"] = texts
        return pd.DataFrame({c: pd.Series(list(v), dtype=object) if c in kept else v for c, v in out.items()})

    texts = blocks.select("block", *kept, "sizes", "n", "data")
    return texts.groupBy("block").cogroup(spans.groupBy("block")).applyInPandas(finish, schema)
