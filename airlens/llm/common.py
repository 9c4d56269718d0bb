"""Small helpers of the subpackage: tables, staged results, batched texts."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.session import scratch_dir, ship

CHUNK_BYTES = 1 << 20       # texts are handled in runs of about this many bytes


# What a Python worker keeps between tasks, by name: how to let go of it. Workers
# live as long as an executor and run the tasks of every operator.
HELD: dict[str, Callable[[], None]] = {}


def let_go(uses: tuple[str, ...]) -> None:
    for name in HELD.keys() - set(uses):
        HELD[name]()


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(run: Callable[[Iterator], Iterator], *uses: str) -> Callable[[Iterator], Iterator]:
    """``run`` as a task that first drops what other operators have left in the
    worker (all of ``HELD`` but ``uses``), and gives freed memory back when it ends.
    (``HELD`` is the worker's own only through functions of this module: what a task's
    function itself refers to is sent with it as a copy.)"""
    def task(batches: Iterator) -> Iterator:
        let_go(uses)
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def fold_of(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


# For rows that hold large packed values: the writer looks at its buffers after
# every row, not after a hundred, and does not try to pack them again.
BLOB_ROWS = {"compression": "uncompressed", "parquet.enable.dictionary": "false",
             "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
             "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1"}


def stage(df: DataFrame, label: str, blobs: bool = False) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage is cut and a lost executor costs a re-read, not a recomputation."""
    path = scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").options(**(BLOB_ROWS if blobs else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def by_bytes(batches: Iterator[pa.RecordBatch], text: str = "text",
             limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows whose UTF-8 texts hold about ``limit`` bytes (a longer
    text is a run of its own), with the texts as bytes; null is empty."""
    for batch in batches:
        col = batch.column(text)
        if not pa.types.is_binary(col.type) and not pa.types.is_large_binary(col.type):
            col = col.cast(pa.large_binary())
        start, size = 0, 0
        run: list[bytes] = []
        for i in range(len(col)):
            t = col[i].as_py() or b""
            if run and size + len(t) > limit:
                yield batch.slice(start, len(run)), run
                start, size, run = i, 0, []
            run.append(t)
            size += len(t)
        if run:
            yield batch.slice(start, len(run)), run


def grouped(df: DataFrame, keys: list[str], order: str, fn: Callable[[list[dict]], dict], schema: str) -> DataFrame:
    """The rows of each key go to ``fn``, in ``order``, which gives columns; a task streams over its groups, so many
    small ones cost no call each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for b in batches:
            for r in b.to_pylist():
                k = tuple(r[c] for c in keys)
                if k != at and held:
                    yield pa.record_batch(fn(held))
                    held = []
                at = k
                held.append(r)
        if held:
            yield pa.record_batch(fn(held))

    n = partitions(df.sparkSession)
    return df.repartition(n, *keys).sortWithinPartitions(*keys, order).mapInArrow(tidied(run), schema)
