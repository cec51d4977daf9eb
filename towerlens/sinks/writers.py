"""Writers (SK1-SK7).

* ``write_parquet``: overwrite a table; optional ``partitionBy`` (CDRs by
  month) with rows sorted by folder and clustering keys inside each task.
* ``write_mart``: a gold mart as Parquet and CSV from one materialised pass.
* ``write_json_report``: a one-row nested report as a single JSON file.
* ``load_table``: replace the rows of a declared table: columns aligned by
  name and cast to the declared schema, missing DEFAULT columns filled, written
  to fresh files, gated, switched to, then the row count read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from towerlens.operators.constraints import TableConstraints, enforce, load_check
from towerlens.sinks.publish import new_version
from towerlens.sources import hadoop_fs


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None,
                  cluster_by: list[str] | None = None) -> None:
    """Overwrite a Parquet table, optionally in ``partition_by`` folders.

    Rows are sorted inside each task by the folder column and the clustering
    keys, so every task writes each folder once (few files) and Parquet
    min/max statistics on the clustering keys become selective. No shuffle
    is added: the task layout is the one of the upstream stage (which AQE
    sizes to the data), and a range repartition would cost a sampling pass
    over the whole upstream plan.
    """
    keys = ([partition_by] if partition_by else []) + list(cluster_by or [])
    writer_df = df.sortWithinPartitions(*keys) if keys else df
    w = writer_df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; dates and timestamps as ISO text, NULL as empty.
    Leading and trailing blanks are kept (a blank text is data, not NULL)."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_mart(df: DataFrame, parquet_path: str, csv_path: str | None = None) -> DataFrame:
    """Write a mart once as Parquet (the warehouse copy) and, if asked, as CSV
    read back from that Parquet copy rather than recomputed."""
    df.write.mode("overwrite").parquet(parquet_path)
    written = df.sparkSession.read.parquet(parquet_path)
    if csv_path:
        write_csv(written, csv_path)
    return written


def write_json_report(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON file (``coalesce(1)`` of one row)."""
    report.coalesce(1).write.mode("overwrite").json(path)


def conform(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """Align columns by name to a declared schema: cast each column, fill a
    missing column from ``defaults`` (DEFAULT clause) or NULL, drop extras."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def declare_table(spark: SparkSession, name: str, schema: StructType, location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING parquet with the declared columns."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")


def table_location(spark: SparkSession, name: str) -> str:
    """The folder that a declared table reads."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"].rstrip("/")


class TableMismatchError(ValueError):
    """A table is declared with other columns than those to be loaded."""


def switch_table(spark: SparkSession, name: str, schema: StructType, location: str) -> None:
    """Let the declared table read ``location`` from now on, by one change of its catalog entry.

    A table that does not exist is declared over the files, so it never shows up empty; one that exists keeps its entry and
    columns, and its former files stay where they are.
    """
    if not spark.catalog.tableExists(name):
        declare_table(spark, name, schema, location)
        return
    declared = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
    if declared != [(f.name, f.dataType) for f in schema.fields]:
        raise TableMismatchError(f"{name} is declared with other columns")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")


def load_table(spark: SparkSession, name: str, df: DataFrame, schema: StructType, defaults: dict | None = None,
               root: str | None = None, check: TableConstraints | None = None) -> int:
    """Replace the rows of a declared table and return the row count read back from it.

    The conformed rows go to a fresh folder under ``root`` (default: where the table's files are), ``check`` is enforced on
    them there, and the table is then switched to that folder. A reader sees the old rows or the new ones, never none and
    never both; a failed check or a crash leaves the old ones. The folder that was read before stays until the next load.
    """
    before = table_location(spark, name) if spark.catalog.tableExists(name) else None
    if root is None:
        if before is None:
            raise ValueError(f"{name} is not declared: say where its files go")
        root = before.rsplit("/v-", 1)[0]
    version = new_version()
    fresh = f"{root}/{version}"
    conform(df, schema, defaults).write.mode("errorifexists").parquet(fresh)
    if check:
        enforce(load_check(spark.read.schema(schema).parquet(fresh), check)[1])
    switch_table(spark, name, schema, fresh)
    for old in hadoop_fs.list_dirs(spark, root):
        if old.startswith("v-") and old < version and not (before or "").endswith(f"/{old}"):
            hadoop_fs.delete(spark, f"{root}/{old}")
    return spark.table(name).count()
