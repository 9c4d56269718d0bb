"""Runs: rows of micro-batches in folders ``run=LEVEL-FROM-TO`` that are merged
by levels. Once ``fan_in`` runs of a level lie side by side they become one of the
next, so a row is rewritten once a level, not once a micro-batch, and readers meet
few runs. A run within a finished larger one is superseded and not read; a
replayed micro-batch overwrites its own run."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airlens.sources.versions import committed, folders

Run = tuple[int, int, int]
FAN_IN = 8


def live(spark: SparkSession, folder: str) -> list[Run]:
    """(level, from, to) of the finished runs that no larger one supersedes, in order."""
    names = (re.fullmatch(r"run=(\d+)-(\d+)-(\d+)", n) for n in committed(spark, folder))
    found = [tuple(int(g) for g in m.groups()) for m in names if m]
    return sorted((r for r in found if not any(o[0] > r[0] and o[1] <= r[1] and r[2] <= o[2] for o in found)), key=lambda r: r[1])


def path(folder: str, run: Run) -> str:
    return "{}/run={}-{}-{}".format(folder, *run)


def compact(spark: SparkSession, folder: str, below: int, merge: Callable[[list[Run], Run], None], fan_in: int = FAN_IN) -> None:
    """Merge runs of micro-batches before ``below`` while the last ``fan_in`` of them
    share a level; ``merge`` writes some runs as the given larger one."""
    while True:
        tail = [r for r in live(spark, folder) if r[2] < below][-fan_in:]
        if len(tail) < fan_in or len({r[0] for r in tail}) > 1:
            return
        merge(tail, (tail[0][0] + 1, tail[0][1], tail[-1][2]))


def of_stream(spark: SparkSession, root: str) -> tuple[str, list[Run]] | None:
    """The folder of the stream that writes to ``root``, and its live runs."""
    for name in folders(spark, root):
        runs = live(spark, f"{root}/{name}")
        if runs:
            return f"{root}/{name}", runs
    return None


def read(spark: SparkSession, folder: str, runs: list[Run], schema) -> DataFrame:
    """Rows of ``runs`` with the columns of ``schema``."""
    df = spark.read.schema(schema).option("basePath", folder).parquet(*[path(folder, r) for r in runs])
    return df.drop("run")
