"""File-system operations through Hadoop's FileSystem API, so they act on
whatever store the cluster uses (HDFS, object stores, local disk), not on the
driver's local disk."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files that ``pattern`` names (a folder: those in it), hidden ones left out."""
    fs, p = _fs(spark, pattern)
    found = list(fs.globStatus(p) or [])
    inner = [f for s in found if s.isDirectory() for f in fs.listStatus(s.getPath())]
    return [(s.getPath().toString(), int(s.getLen())) for s in [*found, *inner]
            if s.isFile() and not s.getPath().getName().startswith(("_", "."))]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def create_empty(spark: SparkSession, path: str) -> None:
    """Create a file of no bytes, with its folder; an error if the file exists. One call: the file is there or it is not."""
    fs, p = _fs(spark, path)
    if not fs.createNewFile(p):
        raise FileExistsError(path)
