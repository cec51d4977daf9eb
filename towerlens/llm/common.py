"""Helpers shared by the operators: table access, the shared folder, hashing of text in batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.session import checkpoint_dir
from towerlens.sources import hadoop_fs

#: Bytes of rows that one Arrow batch to Python holds (one row may exceed it).
TEXT_BATCH_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees (``spark.checkpoint.dir``); local sessions without one get a private folder."""
    def private() -> str:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        return tempfile.mkdtemp(prefix="towerlens-llm-")
    return checkpoint_dir(spark, fallback=private).rstrip("/")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: cuts lineage, is never computed twice."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, buckets: int, *keys: str, partition_by: str | None = None) -> tuple[DataFrame, str]:
    """``df`` dealt by hash of ``keys`` as it comes and written as a bucketed table in the shared folder: grouping and
    joining by those keys then reads each bucket in one task, without an exchange. Returns the table read back and its
    catalog name, to be given to ``forget`` when nothing reads it any more."""
    spark = df.sparkSession
    table = f"towerlens_{name}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", "zstd").option("path", f"{shared_folder(spark)}/llm/{table}")
    (writer.partitionBy(partition_by) if partition_by else writer).bucketBy(buckets, *keys).saveAsTable(table)
    return spark.table(table), table


def forget(spark: SparkSession, *tables: str) -> None:
    """Take ``bucketed`` tables out of the catalog and delete their files."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        hadoop_fs.delete(spark, f"{shared_folder(spark)}/llm/{table}")


def whole_numbers(vec: str, scale: int, bound: int) -> Column:
    """floor(scale * x) of every component as int, computed in double; components beyond ``bound`` are held at it."""
    x = F.col(vec).cast("array<double>")
    return F.transform(x, lambda c: F.least(F.greatest(F.floor(c * F.lit(float(scale))), F.lit(-bound)), F.lit(bound)).cast("int"))


def finite(vec: str) -> Column:
    """Whether an array is there and holds neither nulls nor NaN nor infinities."""
    x = F.col(vec).cast("array<double>")
    return x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))


#: Keys that hold at least this share of all rows are told by a broadcast table, so that table has at most as many rows.
HEAVY = 1024


def add_total(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` (a written table) with ``value`` summed over all rows of the same ``key``, nulls being one key.

    Sums are added up before they are shuffled. They come back by a broadcast join for keys that hold a share of at
    least 1 in HEAVY of all rows, of which there are at most HEAVY, and by a shuffled join for the rest, whose groups are
    that small, so no task meets a group of rows larger than that share.
    """
    sums = written(rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("_n")), "totals")
    least = (sums.agg(F.sum("_n")).first()[0] or 0) / HEAVY
    heavy, light = F.broadcast(sums.where(F.col("_n") >= least)), sums.where(F.col("_n") < least)
    same = F.col(key).eqNullSafe(F.col("_key"))
    return rows.join(heavy, same).drop("_key", "_n").unionByName(rows.join(heavy, same, "left_anti").join(light, same).drop("_key", "_n"))


def small_batches(docs: DataFrame) -> DataFrame:
    """Bound the Arrow batches of this session by bytes, so that a batch of long texts stays small in a task."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH_BYTES))
    return docs


def fold(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def fresh(name: str, columns: Iterable[str]) -> str:
    """A column name that no given column has (names compare without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer that spreads all input bits (uint64 in, uint64 out)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values: log2(width) elementwise passes."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
