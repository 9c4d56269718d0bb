"""Folders of finished Spark writes, and which stream a folder belongs to."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system): local, HDFS and object stores alike."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in ``root``; none if it is missing."""
    hpath, fs = file_system(spark, root)
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath) if st.isDirectory())


def committed(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in ``root`` that a Spark write has finished."""
    done = []
    for name in folders(spark, root):
        hpath, fs = file_system(spark, f"{root}/{name}/_SUCCESS")
        if fs.exists(hpath):
            done.append(name)
    return done


def stream_identity(spark: SparkSession, checkpoint_location: str | None) -> str:
    """The id that a stream's checkpoint gives it; it survives restarts, and a
    new checkpoint has a new one."""
    if checkpoint_location is None:
        return "direct"
    text = spark.read.text(f"{checkpoint_location.rstrip('/')}/metadata").first()[0]
    return re.search(r'"id"\s*:\s*"([^"]+)"', text).group(1)


def claim(spark: SparkSession, root: str, stream: str) -> str:
    """The folder of ``stream`` under ``root``. Batch ids count from 0 in every
    checkpoint, so output of two streams in one folder would overwrite or count
    files twice: a folder that another stream has written is refused."""
    others = [n for n in folders(spark, root) if n.startswith("stream=") and n != f"stream={stream}"]
    if others:
        raise RuntimeError(f"{root} holds the output of another stream ({others[0]}); resume its checkpoint, "
                           "or give the new one an output folder of its own")
    return f"{root}/stream={stream}"
