"""File-level sources: CSV scans with rescued text, existence checks, checksums of files as a hash tree."""

from __future__ import annotations

import fnmatch
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from towerlens.sources import hadoop_fs


class SourceMissingError(FileNotFoundError):
    """A named bronze source does not exist."""


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, rescued: str | None = None) -> DataFrame:
    """CSV with a header row, columns resolved by their header names.

    With a schema, its columns are picked by name (a missing one is an error,
    files of one source whose headers differ are an error, no inference pass)
    and cast; a field that does not parse becomes NULL. With ``rescued`` the
    same parse also yields a column of that name: a map from column name to the
    text of every field of the row that did not parse, NULL if all did. Without
    a schema the types are inferred (audit of unknown files).
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    raw = reader.csv(path)
    columns = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.select(*columns, *([_rescued(schema).alias(rescued)] if rescued else []))


def _rescued(schema: StructType) -> Column:
    """name -> text of the fields that hold text but do not parse as their declared type."""
    typed = [f for f in schema.fields if f.dataType.simpleString() != "string"]
    bad = [F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
                  F.struct(F.lit(f.name).alias("name"), F.col(f"`{f.name}`").alias("text"))) for f in typed]
    if not bad:
        return F.lit(None).cast("map<string,string>")
    none = bad[0].isNull()
    for b in bad[1:]:
        none = none & b.isNull()
    return F.when(~none, F.map_from_entries(F.array_compact(F.array(*bad))))


def malformed_fields(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(column_name, malformed_count): fields that hold text which does not parse as the declared type, in one scan."""
    typed = [f for f in schema.fields if f.dataType.simpleString() != "string"]
    scan = read_csv(spark, path, schema, rescued="_bad")
    wide = scan.agg(*[F.count_if(F.map_contains_key(F.col("_bad"), f.name)).alias(f"_n{i}") for i, f in enumerate(typed)])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"_n{i}").alias("malformed_count"))
                                           for i, f in enumerate(typed)])).alias("_x")).select("_x.*")


#: Bytes of a leaf of the hash tree, and children of a node (fixed: a checksum depends on them, on nothing else).
BLOCK, FAN = 32 << 20, 4096
_STEP = 1 << 20


def _hash_blocks(size: int):
    """SHA-256 of byte ranges, each read where its task runs and hashed by the native library, a step at a time."""
    def hash_blocks(batches):
        from pyarrow.fs import FileSystem
        for b in batches:
            digests = []
            for path, block in zip(b.column("path").to_pylist(), b.column("block").to_pylist(), strict=True):
                store, at = FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
                digest, left = hashlib.sha256(), size
                with store.open_input_file(at) as stream:
                    stream.seek(block * size)
                    while left and (part := stream.read(min(left, _STEP))):
                        digest.update(part)
                        left -= len(part)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), pa.array(digests, pa.string())], names=["file", "node", "digest"])
    return hash_blocks


def _roots(nodes: DataFrame, keys: list[str], most: int) -> DataFrame:
    """(keys, digest): the root over each key's (node, digest) rows, ``most`` of them at most, FAN children a node in order.
    A node with one child is that child; otherwise it is the SHA-256 of its children's hexadecimal digests."""
    while most > 1:
        children = F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda c: c["digest"])
        nodes = nodes.groupBy(*keys, F.expr(f"node div {FAN}").alias("node")).agg(children.alias("_c")).select(
            *keys, "node", F.when(F.size("_c") == 1, F.col("_c")[0]).otherwise(F.sha2(F.array_join("_c", ""), 256)).alias("digest"))
        most = -(-most // FAN)
    return nodes.select(*keys, "digest")


def _listing(spark: SparkSession, pattern: str, glob: str) -> list[tuple[int, str, int]]:
    """(number, path, bytes) of the files that ``pattern`` names (a folder: those in it) in the order of their paths."""
    found = [(p, n) for p, n in hadoop_fs.files(spark, pattern) if fnmatch.fnmatch(p.rsplit("/", 1)[-1], glob)]
    return [(i, p, n) for i, (p, n) in enumerate(sorted(found))]


def _file_digests(spark: SparkSession, files: list[tuple[int, str, int]], block: int) -> DataFrame:
    """(file, digest) of every file: byte ranges of ``block`` are dealt to tasks, read once, and joined by the tree."""
    blocks = [max(1, -(-n // block)) for _, _, n in files]
    table = spark.createDataFrame([(i, p, b) for (i, p, _), b in zip(files, blocks, strict=True)], "file int, path string, blocks long")
    ranges = table.select("file", "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges.repartition(max(1, min(sum(blocks), max(parts, sum(blocks) // 16))), "file", "block")
    leaves = ranges.mapInArrow(_hash_blocks(block), "file int, node long, digest string")
    return _roots(leaves, ["file"], max(blocks, default=1))


def source_file_stats(spark: SparkSession, folder: str, glob: str = "*.csv", block: int = BLOCK) -> DataFrame:
    """One row for a source stored as one or more files: file count, total bytes and ``checksum_sha256_16``, 16 digits of
    a hash tree over the bytes of its files in the order of their paths.

    Files are listed without reading them, then every byte is read once, in ranges of fixed length hashed by many tasks, so
    no file, however large, meets one task, and the value is the same however tasks are cut. A source of one file of at
    most one range has the SHA-256 of its bytes.
    """
    files = _listing(spark, folder, glob)
    one = spark.createDataFrame([(len(files), sum(n for _, _, n in files))], "file_count long, size_bytes long")
    digests = _file_digests(spark, files, block).select(F.lit(0).alias("all"), F.col("file").cast("long").alias("node"), "digest")
    root = _roots(digests, ["all"], len(files)).agg(F.coalesce(F.max("digest"), F.sha2(F.lit(""), 256)).alias("d"))
    return one.select("*", F.substring(root.scalar(), 1, 16).alias("checksum_sha256_16"))


def read_mart_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A gold CSV export read back with its declared schema: date and
    timestamp columns are parsed by the scan, not by a later cast."""
    return read_csv(spark, path, schema)


def require_sources(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail when a named source is missing (checks the file system the
    cluster sees, through Hadoop, not the local disk of the driver)."""
    missing = [f"{name}: {path}" for name, path in paths.items() if not hadoop_fs.exists(spark, path)]
    if missing:
        raise SourceMissingError("sources that do not exist: " + "; ".join(missing))


def file_fingerprints(spark: SparkSession, pattern: str, block: int = BLOCK) -> DataFrame:
    """Per file, also an empty one: path, size in bytes and the checksum of its bytes as in ``source_file_stats``."""
    files = _listing(spark, pattern, "*")
    sizes = spark.createDataFrame(files, "file int, path string, size_bytes long")
    return sizes.join(_file_digests(spark, files, block), "file").select("path", "size_bytes", F.substring("digest", 1, 16).alias("checksum_sha256_16"))
