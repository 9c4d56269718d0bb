"""Manifests: what belongs together in a folder of views, committed at once.

A table is a folder ``root``. Its views lie in folders of their own beside
``_manifests``, whose newest file ``m-N.json`` names the folder of every view
and any details of the commit. A writer fills new folders, then lands the
next manifest by a rename, so a reader sees all views of one commit or all
of the one before, and a failed write changes nothing. Reading takes one
listing of ``_manifests`` and one file, whatever the number of commits: the newest
``keep`` manifests stay, and folders that none of them names are deleted
with the commit that leaves them behind. A reader has until then to finish.

One job writes a table at a time; the manifest of a second one would carry the
same number, and its commit fails.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from airlens.sources.versions import file_system

FOLDER = "_manifests"
KEEP = 2


@dataclass(frozen=True)
class Manifest:
    """Commit ``number`` of ``root``: ``views`` names folders below it (one per
    view, or a list of them)."""

    root: str
    number: int
    views: dict[str, str | list[str]] = field(default_factory=dict)
    details: dict = field(default_factory=dict)

    def path(self, view: str) -> str | None:
        folder = self.views.get(view)
        return f"{self.root}/{folder}" if isinstance(folder, str) else None

    def paths(self, view: str) -> list[str]:
        folders = self.views.get(view) or []
        return [f"{self.root}/{f}" for f in ([folders] if isinstance(folders, str) else folders)]


def _numbers(spark: SparkSession, root: str) -> list[int]:
    hpath, fs = file_system(spark, f"{root}/{FOLDER}")
    try:
        names = [st.getPath().getName() for st in fs.listStatus(hpath)]
    except Exception as e:                      # no folder: nothing is committed
        if "FileNotFoundException" in str(e):
            return []
        raise
    return sorted(int(m.group(1)) for m in (re.fullmatch(r"m-(\d+)\.json", n) for n in names) if m)


def _load(spark: SparkSession, root: str, number: int) -> Manifest:
    hpath, fs = file_system(spark, f"{root}/{FOLDER}/m-{number:010d}.json")
    stream = fs.open(hpath)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    got = json.loads(text)
    return Manifest(root, number, got["views"], got["details"])


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The newest commit of ``root``; None before the first."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else None


class Draft:
    """The next commit of a table. ``folder`` gives the place of a view to write;
    views that are not named again stay as they are."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.before = current(spark, self.root)
        self.number = self.before.number + 1 if self.before else 0
        self.views = dict(self.before.views) if self.before else {}
        self.details = dict(self.before.details) if self.before else {}

    def folder(self, view: str) -> str:
        """A fresh path for ``view``, which it has from the commit on."""
        self.views[view] = self._fresh(view)
        return f"{self.root}/{self.views[view]}"

    def part(self, view: str) -> str:
        """A fresh path whose rows are added to those of ``view``."""
        fresh = self._fresh(view)
        self.views[view] = [*(self.views.get(view) or []), fresh]
        return f"{self.root}/{fresh}"

    def keep(self, view: str, folders: Iterable[str]) -> None:
        """``view`` consists of these of its folders only."""
        self.views[view] = list(folders)

    def _fresh(self, view: str) -> str:
        return f"{view}/v={self.number}-{uuid.uuid4().hex[:8]}"

    def commit(self, keep: int = KEEP) -> Manifest:
        name = f"m-{self.number:010d}.json"
        staged, fs = file_system(self.spark, f"{self.root}/{FOLDER}/.{name}-{uuid.uuid4().hex[:8]}")
        target, _ = file_system(self.spark, f"{self.root}/{FOLDER}/{name}")
        out = fs.create(staged, True)
        try:
            out.write(bytearray(json.dumps({"views": self.views, "details": self.details}).encode()))
        finally:
            out.close()
        if fs.exists(target) or not fs.rename(staged, target):
            fs.delete(staged, False)
            raise RuntimeError(f"another job has committed {name} in {self.root}")
        done = Manifest(self.root, self.number, self.views, self.details)
        self._drop_old(done, max(1, keep))
        return done

    def _drop_old(self, done: Manifest, keep: int) -> None:
        numbers = _numbers(self.spark, self.root)
        kept = [_load(self.spark, self.root, n) for n in numbers[-keep:]]
        named = {f for m in kept for v in m.views.values() for f in ([v] if isinstance(v, str) else v)}
        for n in numbers[:-keep]:
            hpath, fs = file_system(self.spark, f"{self.root}/{FOLDER}/m-{n:010d}.json")
            fs.delete(hpath, False)
        for view in done.views:
            hpath, fs = file_system(self.spark, f"{self.root}/{view}")
            if not fs.exists(hpath):
                continue
            for st in fs.listStatus(hpath):
                m = re.fullmatch(r"v=(\d+)-\w+", st.getPath().getName())
                if m and int(m.group(1)) <= done.number and f"{view}/{st.getPath().getName()}" not in named:
                    fs.delete(st.getPath(), True)
