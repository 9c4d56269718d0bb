"""All-or-nothing appends of files to a folder that file readers list.

Spark's committed output lies in a staging folder beside the target. An intent in
``<target>/_appends``, landed by one rename, commits the append; then its files
are moved one by one. Whoever meets an intent (the next writer, or a reader of
this library) finishes its moves first, so an append that was cut off shows no
file before its intent is there, and all of them after. Moves that several parties
make at once do no harm: a file that is gone has been moved."""

from __future__ import annotations

from pyspark.sql import SparkSession

from airlens.sources.versions import file_system

INTENTS = "_appends"


def _names(spark: SparkSession, path: str) -> list[str]:
    hpath, fs = file_system(spark, path)
    try:
        return sorted(st.getPath().getName() for st in fs.listStatus(hpath))
    except Exception as e:
        if "FileNotFoundException" in str(e):
            return []
        raise


def commit_append(spark: SparkSession, staging: str, target: str) -> None:
    """Add the data files of the finished write in ``staging`` to ``target``."""
    target = target.rstrip("/")
    name = staging.rstrip("/").rsplit("/", 1)[-1]
    into, fs = file_system(spark, f"{target}/{INTENTS}")
    fs.mkdirs(into)
    draft, _ = file_system(spark, f"{target}/{INTENTS}/.{name}")
    intent, _ = file_system(spark, f"{target}/{INTENTS}/{name}")
    fs.create(draft, True).close()
    if not fs.rename(draft, intent):
        raise RuntimeError(f"could not commit {name} to {target}")
    finish(spark, target, name)


def finish(spark: SparkSession, target: str, name: str) -> None:
    """Move what is left of the append ``name`` and drop its staging folder."""
    staging = f"{target.rsplit('/', 1)[0]}/{name}"
    for file in _names(spark, staging):
        if not file.startswith(("_", ".")):
            move(spark, f"{staging}/{file}", f"{target}/{file}")
    source, fs = file_system(spark, staging)
    fs.delete(source, True)
    intent, _ = file_system(spark, f"{target}/{INTENTS}/{name}")
    fs.delete(intent, False)


def move(spark: SparkSession, source: str, target: str) -> None:
    at, fs = file_system(spark, source)
    to, _ = file_system(spark, target)
    if not fs.rename(at, to) and fs.exists(at):
        raise RuntimeError(f"could not move {source} to {target}")


def discard(spark: SparkSession, staging: str) -> None:
    source, fs = file_system(spark, staging)
    fs.delete(source, True)


def recover(spark: SparkSession, target: str) -> None:
    """Finish the appends to ``target`` that were cut off after their intent; one
    listing if there is none. A path with a glob is read as it is."""
    target = target.rstrip("/")
    if any(c in target for c in "*?[{"):
        return
    for name in _names(spark, f"{target}/{INTENTS}"):
        if not name.startswith("."):
            finish(spark, target, name)
