"""Tables that readers only ever see whole: each write is a folder of its own.

A version is complete once Spark's commit has left ``_SUCCESS`` in its folder,
so a job that dies leaves nothing that anyone reads. By path, the newest complete version is
the table. By name, a table points to one version and one catalog change moves it
to the next. Whoever opened the table before goes on reading the files it
listed; they stay until ``drop_old`` removes them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cabgrid.sinks import writers

PREFIX = "v-"


def new_version(path: str) -> str:
    """A folder for the next version; names sort by the time they were made."""
    return f"{path.rstrip('/')}/{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write(df: DataFrame, path: str, by: Sequence[str] = ()) -> str:
    """Write ``df`` as the next version of the table at ``path``; its folder."""
    folder = new_version(path)
    if by:
        writers.overwrite_partitioned(df, folder, by)
    else:
        writers.overwrite(df, folder)
    return folder


def _listed(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Versions at ``path``, oldest first, and whether each is complete."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
    join = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [
        (f"{path.rstrip('/')}/{name}", fs.exists(join(root, f"{name}/_SUCCESS"))) for name in names if name.startswith(PREFIX)
    ]


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete versions at ``path``, oldest first."""
    return [folder for folder, complete in _listed(spark, path) if complete]


def latest(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest complete version."""
    return (versions(spark, path) or [None])[-1]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of the table at ``path``."""
    folder = latest(spark, path)
    if folder is None:
        raise ValueError(f"{path} has no complete version")
    return spark.read.parquet(folder)


def publish(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """Let the table ``name`` stand for the version in ``folder``."""
    if folder not in versions(spark, folder.rsplit("/", 1)[0]):
        raise ValueError(f"{folder} is no complete version")
    return writers.register(spark, name, folder)


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` complete versions, and what dead jobs left before the newest; their folders.

    A write that is still running is newer than every complete version, or else
    its job was overtaken; readers of a deleted version fail, so ``keep`` has to
    cover the longest job that reads.
    """
    if keep < 1:
        raise ValueError("one version has to stay")
    listed = _listed(spark, path)
    complete = [folder for folder, done in listed if done]
    if not complete:
        return []
    gone = [folder for folder, done in listed if folder < complete[-1] and (not done or folder not in complete[-keep:])]
    for folder in gone:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return gone
