"""Micro-batch metrics of a stream as a table: what came in, what the watermark
dropped, what the state holds, and the batch writer's own counts."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from airlens.sources.versions import file_system

SCHEMA = ("query string, batch_id long, started_at timestamp, input_rows long, dropped_rows long, updated_state_rows long, "
          "total_state_rows long, watermark timestamp, windows long, cities long, dangerous_cities long")


class BatchMetrics(StreamingQueryListener):
    """Collects a row per micro-batch of a query and writes them as JSON lines
    to ``path``: ``every`` rows a file, the rest when the query ends. Rows that the
    driver holds when it dies are lost; the stream itself is not affected.

    ``dropped_rows``: grouped rows (a window or bucket per city) that came after the
    watermark and were left out. ``windows``, ``cities`` and ``dangerous_cities`` are
    NULL in a batch that wrote nothing."""

    def __init__(self, path: str, every: int = 100):
        self.path, self.every = path.rstrip("/"), every
        self.spark: SparkSession | None = None
        self.counts: dict[int, dict] = {}
        self.rows: list[tuple[str, dict]] = []
        self.run: str | None = None
        self.ended = threading.Event()
        self.lock = threading.Lock()

    def listen(self, spark: SparkSession) -> None:
        """Before a query starts."""
        if self.spark is None:
            spark.streams.addListener(self)
        self.spark, self.run = spark, None
        self.ended.clear()

    def follow(self, query) -> None:
        """Keep the rows of ``query`` only."""
        self.run = str(query.runId)

    def note(self, batch_id: int, **counts) -> None:
        with self.lock:
            self.counts[batch_id] = counts

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        ops = p.stateOperators
        with self.lock:
            self.rows.append((str(p.runId), {
                "query": p.name, "batch_id": p.batchId, "started_at": p.timestamp, "input_rows": p.numInputRows,
                "dropped_rows": sum(o.numRowsDroppedByWatermark for o in ops),
                "updated_state_rows": sum(o.numRowsUpdated for o in ops), "total_state_rows": sum(o.numRowsTotal for o in ops),
                "watermark": (p.eventTime or {}).get("watermark")}))
            if len(self.rows) >= self.every:
                self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.run in (None, str(event.runId)):
            with self.lock:
                self._flush()
            self.ended.set()

    def _flush(self) -> None:
        own = [r | self.counts.pop(r["batch_id"], {}) for run, r in self.rows if self.run in (None, run)]
        self.rows.clear()
        if not own:
            return
        hpath, fs = file_system(self.spark, f"{self.path}/batches-{uuid.uuid4().hex}.json")
        out = fs.create(hpath, True)
        try:
            out.write(bytearray("".join(json.dumps(r) + "\n" for r in own).encode()))
        finally:
            out.close()

    def wait(self, timeout: float = 60) -> None:
        """Until the rows of an ended query are written; events come a little after it."""
        if not self.ended.wait(timeout):
            raise TimeoutError("the end of the query was not reported")
        self.spark.streams.removeListener(self)
        self.spark = None


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch (``SCHEMA``)."""
    return spark.read.schema(SCHEMA).json(path)
