"""Exact deduplication against a minimal perfect hash of earlier digests.

Texts are equal when their (optionally normalised) UTF-8 bytes are; they are
compared by SHA-256. ``build_index`` keeps the distinct digests of earlier rows
in buckets of a bounded size. In a bucket a minimal perfect hash gives every
digest a slot of its own, and the slot holds the whole digest, the locator of
the row that stays (its doc_id and row number) and the number of its rows; the
function itself costs about three bits a digest. A lookup of any digest lands
in some slot, so all 32 bytes are compared there: equal ones are repeats of the
slot's row, others are no members and form groups of their own. Digests are
counted per task before they are dealt out, so a text with a third of all rows
is one lookup a task, and the number of buckets follows the digests counted.

Of equal texts the row with the largest doc_id stays; a null id is smaller than
any other, and of rows equal in text and doc_id the one with the largest row
number stays, so every group keeps exactly one row. A null text is the empty
text. Very long texts are hashed whole and never leave the JVM. An empty table
gives an empty result; other columns of the table are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm.common import stage
from airlens.llm.wordhash import mix

BUCKET_DIGESTS = 1 << 13
INDEX_SCHEMA = "bucket int, n int, sizes binary, bits binary, digests binary, ids array<bigint>, rows binary, counts binary"
FOUND_SCHEMA = "digest binary, member boolean, doc_id long, row long, n long"


class PerfectHash:
    """Minimal perfect hash of distinct keys (two uint64 each).

    A level is a bit table twice the size of the keys that reach it. Keys alone
    on their bit settle there, the others go on to the next level; a key's slot
    is the number of set bits before its own, over all levels."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        self.rank = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(a + mix(b ^ np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        if len(a) > 1:
            o = np.lexsort((b, a))
            if ((a[o][1:] == a[o][:-1]) & (b[o][1:] == b[o][:-1])).any():
                raise ValueError("keys of a perfect hash are distinct")
        sizes, tables = [], []
        while len(a):
            size = -(-2 * len(a) // 64) * 64
            at = cls._place(a, b, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            tables.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = ~alone[at]
            a, b = a[left], b[left]
        return cls(np.array(sizes, np.int64), np.concatenate(tables) if tables else np.zeros(0, "<u8"))

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 or any slot for one that is no member."""
        out = np.full(len(a), -1, np.int64)
        todo = np.arange(len(a))
        for level, size in enumerate(self.sizes.tolist()):
            at = self.first[level] + self._place(a[todo], b[todo], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit & np.uint64(1)).astype(bool)
            below = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.rank[word] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
        return out


def _packed(column: pa.ChunkedArray) -> np.ndarray:
    """Digests as rows of four uint64."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 4)


def _longs(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)       # a copy that can be written


@dataclass
class Index:
    """``table`` holds a row (``INDEX_SCHEMA``) per bucket that has digests."""

    table: DataFrame
    buckets: int


def digests(docs: DataFrame, normalise: Callable[[Column], Column] | None = None, id_col: str = "doc_id",
            text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """(row, doc_id, digest) of every row, staged; ``keep`` adds columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return stage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                             F.unhex(F.sha2((normalise(text) if normalise else text).cast("binary"), 256)).alias("digest"),
                             *[c.alias(n) for n, c in (keep or {}).items()]), "digests")


def winners(rows: DataFrame) -> DataFrame:
    """(digest, winner, n): the row that stays and the number of rows, staged."""
    return stage(rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("winner"), F.count(F.lit(1)).alias("n")),
                 "winners")


def buckets_for(*tables: DataFrame) -> int:
    return max(1, -(-max(t.count() for t in tables) // BUCKET_DIGESTS))


def _bucketed(found: DataFrame, buckets: int) -> DataFrame:
    return found.select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket"), "digest",
                        "winner.doc_id", "winner.row", "n")


def build_index(found: DataFrame, buckets: int | None = None) -> Index:
    """Index of ``winners``; buckets hold about ``BUCKET_DIGESTS`` of them."""
    buckets = buckets or buckets_for(found)

    def build(t: pa.Table) -> pa.Table:
        d = _packed(t.column("digest"))
        mph = PerfectHash.build(d[:, 0], d[:, 1])
        order = np.argsort(mph.slots(d[:, 0], d[:, 1]))
        t = t.take(pa.array(order))
        return pa.table({
            "bucket": t.column("bucket")[:1].cast(pa.int32()), "n": pa.array([len(d)], pa.int32()),
            "sizes": [mph.sizes.tobytes()], "bits": [mph.bits.tobytes()], "digests": [d[order].tobytes()],
            "ids": pa.array([t.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "rows": [_longs(t.column("row")).tobytes()], "counts": [_longs(t.column("n")).tobytes()]})

    table = _bucketed(found, buckets).groupBy("bucket").applyInArrow(build, INDEX_SCHEMA)
    return Index(stage(table, "digest-index"), buckets)


def _ids(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and where they are null (there the id is the smallest long)."""
    null = np.asarray(column.is_null()).astype(bool)
    return np.where(null, np.iinfo(np.int64).min, np.asarray(column.fill_null(0), np.int64)), null


def _later(null_a, id_a, row_a, null_b, id_b, row_b) -> np.ndarray:
    """Where locator a stays rather than b: by id (null is least), then by row."""
    same = null_a == null_b
    return (null_b & ~null_a) | same & ((id_a > id_b) | (id_a == id_b) & (row_a > row_b))


def lookup(index: Index, found: DataFrame) -> DataFrame:
    """``FOUND_SCHEMA``: the groups of the index's rows and of ``found`` (as ``winners``
    gives it) together. A digest of ``found`` that the index has (``member``) joins
    its slot's group, any other is a group of its own; slots that no digest of
    ``found`` equals follow as they are, with a null ``member``."""

    def probe(t: pa.Table, slots: pa.Table) -> pa.Table:
        d = _packed(t.column("digest"))
        ids, null = _ids(t.column("doc_id"))
        rows, n = _longs(t.column("row")), _longs(t.column("n"))
        member = np.zeros(len(d), bool)
        if slots.num_rows:
            r = slots.to_pylist()[0]
            held = np.frombuffer(r["digests"], "<u8").reshape(-1, 4)
            slot_ids, slot_null = _ids(pa.array(r["ids"], pa.int64()))
            slot_rows, counts = np.frombuffer(r["rows"], np.int64), np.frombuffer(r["counts"], np.int64)
            at = PerfectHash(np.frombuffer(r["sizes"], np.int64), np.frombuffer(r["bits"], "<u8")).slots(d[:, 0], d[:, 1])
            member = at >= 0
            member[member] = (held[at[member]] == d[member]).all(axis=1)
            at = at[member]
            own = np.flatnonzero(member)
            beats = _later(slot_null[at], slot_ids[at], slot_rows[at], null[own], ids[own], rows[own])
            later, other = own[beats], at[beats]
            ids[later], null[later], rows[later] = slot_ids[other], slot_null[other], slot_rows[other]
            n[member] += counts[at]
            rest = np.ones(len(held), bool)
            rest[at] = False
            d, n, rows = np.concatenate((d, held[rest])), np.append(n, counts[rest]), np.append(rows, slot_rows[rest])
            ids, null = np.append(ids, slot_ids[rest]), np.append(null, slot_null[rest])
        said = np.zeros(len(d), bool)
        said[len(member):] = True
        return pa.table({"digest": pa.array([x.tobytes() for x in d], pa.binary()),
                         "member": pa.array(np.append(member, said[len(member):]), mask=said),
                         "doc_id": pa.array(ids, mask=null), "row": rows, "n": n})

    asked = _bucketed(found, index.buckets)
    return asked.groupBy("bucket").cogroup(index.table.groupBy("bucket")).applyInArrow(probe, FOUND_SCHEMA)


def deduplicate(docs: DataFrame, history: Column, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and
    ``repeats_history`` (a later row whose text an earlier row has). Rows where
    ``history`` is true are the earlier ones (null counts as false)."""
    rows = digests(docs, normalise, keep={"earlier": F.coalesce(history, F.lit(False))})
    old, new = winners(rows.where("earlier")), winners(rows.where(~F.col("earlier")))
    index = build_index(old, buckets_for(old, new))
    # A group of one row is that row; only larger ones are joined to the rows.
    groups = stage(lookup(index, new).where("n > 1"), "groups").select(
        "digest", "member", "n", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    own = F.col("n").isNull()
    return rows.join(groups, "digest", "left").select(
        "doc_id", F.when(own, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (own | (F.col("row") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
        (~F.col("earlier") & F.coalesce("member", F.lit(False))).alias("repeats_history"))
