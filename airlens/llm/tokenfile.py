"""Token ids in Simple-8b files.

A file row is a frame of whole documents. Its ids lie in 64-bit little-endian
words: the top four bits select how many values of how many bits the other 60
bits hold (``SELECTORS``). Selector 0 is an escape: the next word is one raw
64-bit value, for values of more than 60 bits. Selector 1 is a run of 240
zeros. Every ``BLOCK`` ids start a new word; ``block_words`` holds the first
word of each block, so blocks are decoded independently and vectorised.

Frames are written in ascending id order: a range-partitioned, sorted table
whose parts are numbered in order, ``frame`` numbers within a part, and
``first`` (ids of the part before the frame).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.llm.common import texts_of, tidied
from airlens.llm.tokens import shared_encoder

# (count, bits) by selector; selector 0 escapes, selector 1 is 240 zeros.
SELECTORS = [(1, 64), (240, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
             (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
BLOCK = 4096
_TOP = np.uint64(60)
FRAME_SCHEMA = ("part int, frame int, first long, doc_ids array<long>, doc_tokens array<long>, "
                "n_ids long, block_words binary, words binary")


_SMALL = np.array([v.bit_length() for v in range(1 << 12)], np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each uint64."""
    out = np.zeros(len(values), np.uint8)
    rest = values
    while len(values) and int(rest.max()) >> 12:         # 12 bits at a time
        big = rest >= np.uint64(1 << 12)
        out += np.where(big, np.uint8(12), np.uint8(0))
        rest = np.where(big, rest >> np.uint64(12), rest)
    return out + _SMALL[rest]


def _longest(bits: np.ndarray, n: int) -> np.ndarray:
    """At each of the first ``n`` places of a row, the selector that packs most of
    the values that follow; rows end in at least 240 zeros. A selector that fits
    makes all with fewer values fit, so counting those that fit gives the first."""
    fits = np.zeros((len(bits), n), np.uint8)
    run = {1: bits}                              # widest of the next 2**k values
    k = 1
    while k < 128:
        a = run[k]
        run[2 * k] = np.maximum(a[:, :-k], a[:, k:])
        k *= 2
    for count, width in SELECTORS[1:]:
        p = 1 << (count.bit_length() - 1)
        widest = np.maximum(run[p][:, :n], run[p][:, count - p:count - p + n])
        fits += widest <= width
    return np.where(fits > 0, len(SELECTORS) - fits, 0)          # 0: escape


def encode_words(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) of an id array."""
    if not len(values):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    # A row a block, with zeros behind it: values of the next block must not leak in.
    blocks = -(-len(values) // BLOCK)
    row = BLOCK + 240
    padded = np.zeros((blocks, row), np.uint64)
    tail = len(values) - (blocks - 1) * BLOCK
    padded[:-1, :BLOCK] = values[:(blocks - 1) * BLOCK].reshape(-1, BLOCK)
    padded[-1, :tail] = values[(blocks - 1) * BLOCK:]
    best = _longest(_bits(padded.ravel()).reshape(blocks, row), BLOCK)
    step = np.array([c for c, _ in SELECTORS])[best]
    at: list[int] = []
    first = [0]
    for b, counts in enumerate(step.tolist()):
        i, base, end = 0, b * row, BLOCK if b < blocks - 1 else tail
        while i < end:
            at.append(base + i)
            i += counts[i]
        first.append(len(at))
    place = np.array(at)
    sel = best[place // row, place % row].astype(np.int64)
    words = sel.astype(np.uint64) << _TOP
    flat = padded.ravel()
    for s in np.unique(sel).tolist():
        count, width = SELECTORS[s]
        if s > 1:
            where = np.flatnonzero(sel == s)
            got = flat[place[where]]
            for j in range(1, count):
                got |= flat[place[where] + j] << np.uint64(j * width)
            words[where] |= got
    escaped = np.flatnonzero(sel == 0)
    if len(escaped):
        words = np.insert(words, escaped + 1, flat[place[escaped]])
    offsets = np.array(first[:-1])
    return words, (offsets + np.searchsorted(escaped, offsets)).astype(np.uint32)


def decode_words(words: np.ndarray, block_words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids, as uint64."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    sel = (words >> _TOP).astype(np.int64)
    literal = np.zeros(len(words), bool)
    for i in np.flatnonzero(sel == 0).tolist():  # rare: ids of over 60 bits
        if not literal[i]:
            literal[i + 1] = True
    counts = np.array([c for c, _ in SELECTORS])[sel]
    counts[literal] = 0
    block = np.searchsorted(block_words, np.arange(len(words)), side="right") - 1
    before = np.cumsum(counts) - counts
    at = before - before[block_words][block] + block * BLOCK
    end = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(sel[~literal]):
        count, width = SELECTORS[s]
        where = np.flatnonzero((sel == s) & ~literal)
        if s == 1:
            continue                              # zeros
        if s == 0:
            out[at[where]] = words[where + 1]
            continue
        mask = np.uint64((1 << width) - 1)
        got = (words[where][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width))) & mask
        pos = at[where][:, None] + np.arange(count)
        keep = pos < end[where][:, None]
        out[pos[keep]] = got[keep]
    return out


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int | None = 1, frame_ids: int = 1 << 16,
                 tokenizer_path: str | None = None) -> None:
    """Encode every text and write the files under ``path``.

    Null text: the empty text. Null ids come first, equal ids in text order.
    An empty table writes no frame. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer_path)
        part, frame, first = TaskContext.get().partitionId(), 0, 0
        end = np.array([] if end_id is None else [end_id], "<u2")
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal frame, first, held
            words, blocks = encode_words(np.concatenate(tokens))
            out = pa.record_batch({
                "part": pa.array([part], pa.int32()), "frame": pa.array([frame], pa.int32()),
                "first": [first], "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "doc_tokens": pa.array([[len(t) for t in tokens]], pa.list_(pa.int64())),
                "n_ids": [held], "block_words": [blocks.astype("<u4").tobytes()],
                "words": [words.astype("<u8").tobytes()]})
            frame, first, held = frame + 1, first + held, 0
            ids.clear()
            tokens.clear()
            return out

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                t = np.concatenate((encoder.encode(text), end))
                ids.append(i)
                tokens.append(t)
                held += len(t)
                if held >= frame_ids:
                    yield flush()
        if ids:
            yield flush()

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = cols.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(tidied(run, "tokens"), FRAME_SCHEMA).write.mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens,
    ids_crc32, and with ``ids`` the ids themselves."""
    frames = spark.read.schema(FRAME_SCHEMA).parquet(path)
    # One number per part: as many as the writer had tasks, whatever the rows.
    totals = sorted((r["part"], r["n"]) for r in frames.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, at = {}, 0
    for part, n in totals:
        before[part] = at
        at += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                got = decode_words(np.frombuffer(r["words"], "<u8"),
                                   np.frombuffer(r["block_words"], "<u4").astype(np.int64), r["n_ids"])
                got = got.astype("<u4")
                n = np.array(r["doc_tokens"], np.int64)
                cut = np.concatenate(([0], np.cumsum(n)))
                parts = [got[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                cols = {"doc_id": pa.array(r["doc_ids"], pa.int64()),
                        "start": cut[:-1] + before[r["part"]] + r["first"], "n_tokens": n,
                        "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64())}
                if ids:
                    cols["ids"] = pa.array([x.astype(np.int64) for x in parts], pa.list_(pa.int64()))
                yield pa.record_batch(cols)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")
    return frames.mapInArrow(run, schema)
