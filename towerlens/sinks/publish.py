"""Versions of a folder of tables, and the atomic step that makes one current.

A version is a folder ``v-...`` that is written, checked, and never changed
afterwards. It becomes current by one file system call: the creation of an
empty file ``_published/<number>.<version>`` that did not exist before. Nothing
is ever replaced, renamed or emptied, so there is no moment without a current
version on any store: readers take the highest number whose folder exists, and
a crash before the call leaves the version before it, a crash after it the new one.

``expire`` deletes what neither readers of the current version nor readers that
resolved the one before it can meet, marker first, so a crash in
between leaves a folder without a marker, which the next call removes.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from towerlens.sources import hadoop_fs

_MARKERS = "_published"


def new_version() -> str:
    """A folder name that no other run has; later names sort later."""
    return f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def published(spark: SparkSession, layer: str) -> list[tuple[int, str]]:
    """(number, version) of the published versions whose folders exist, oldest first."""
    folders = set(hadoop_fs.list_dirs(spark, layer))
    marks = [name.split(".", 1) for name in hadoop_fs.list_files(spark, f"{layer}/{_MARKERS}")]
    return sorted((int(m[0]), m[1]) for m in marks if len(m) == 2 and m[0].isdigit() and m[1] in folders)


def current(spark: SparkSession, layer: str) -> str:
    """The folder of the published version of a layer."""
    versions = published(spark, layer)
    if not versions:
        raise FileNotFoundError(f"nothing published under {layer}")
    return f"{layer}/{versions[-1][1]}"


def publish(spark: SparkSession, layer: str, version: str, keep: int = 2) -> None:
    """Make ``version``, whose folder is complete, the current one; ``keep`` versions stay (the current one and those
    before it). Of two runs that publish at once both appear, one after the other."""
    if version not in hadoop_fs.list_dirs(spark, layer):
        raise FileNotFoundError(f"no version {version} under {layer}")
    versions = published(spark, layer)
    hadoop_fs.create_empty(spark, f"{layer}/{_MARKERS}/{(versions[-1][0] if versions else 0) + 1:012d}.{version}")
    expire(spark, layer, keep)


def expire(spark: SparkSession, layer: str, keep: int = 2) -> None:
    """Delete the versions before the newest ``keep``, and folders older than those that were never published."""
    versions = published(spark, layer)
    stay = [v for _, v in versions[-keep:]]
    for number, version in versions[:-keep]:
        hadoop_fs.delete(spark, f"{layer}/{_MARKERS}/{number:012d}.{version}")
    for name in hadoop_fs.list_dirs(spark, layer):
        if name.startswith("v-") and stay and name < min(stay) and name not in stay:
            hadoop_fs.delete(spark, f"{layer}/{name}")
