"""Tables bucketed by a unique key: joins and key checks on that key read each bucket in one task, without an exchange.

The rows are dealt by the key once, when they are written, and every later join of two such tables on it, and every
aggregate by it, uses that layout. Only tables with one row a key are bucketed (silver customers, the activity of a
customer): their buckets are even, whatever share of the fact rows a key holds, since facts are aggregated before they are
dealt. The files are ordinary Parquet files. The number of buckets and the key stand in the name of an empty file in the
folder, so that a reader needs nothing but the path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.sources import hadoop_fs

_MARK = "_bucketed."


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to the fresh folder ``path`` as one file a bucket, sorted by ``key``, and return the table read back.

    Rows are dealt by the hash that Spark's buckets use, so each task writes one bucket. A NULL key is a key. A table
    without rows is left as plain Parquet.
    """
    spark = df.sparkSession
    if hadoop_fs.exists(spark, path):
        raise FileExistsError(path)
    name = f"towerlens_write_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, F.col(f"`{key}`"))
    dealt.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    if not hadoop_fs.files(spark, path):  # no row, so no bucket has a file: one plain file keeps the columns
        spark.createDataFrame([], df.schema).write.mode("append").parquet(path)
        return read_bucketed(spark, path)
    hadoop_fs.create_empty(spark, f"{path}/{_MARK}{buckets}.{key}")
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_bucketed`` left in ``path``, with its buckets known to the planner; a folder without the mark
    is read as plain Parquet."""
    marks = [f for f in hadoop_fs.list_files(spark, path) if f.startswith(_MARK)]
    plain = spark.read.parquet(path)
    if not marks:
        return plain
    buckets, key = marks[0][len(_MARK):].split(".", 1)
    name = f"towerlens_read_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def forget_bucketed(spark: SparkSession, *paths: str) -> None:
    """Take the catalog entries of ``read_bucketed`` away; the files stay."""
    for path in paths:
        spark.sql(f"DROP TABLE IF EXISTS towerlens_read_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}")
