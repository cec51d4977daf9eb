"""Table profiles: audit records, NULL counts, value counts, fingerprints.

Each profile is one aggregate pass over its input (no per-column jobs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long form (column_name, null_count), one aggregate for all columns."""
    cols = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
        for i, c in enumerate(cols)])).alias("_x")).select("_x.*")


def audit_record(df: DataFrame, source: str, description: str, key_column: str, rescued: str | None = None) -> DataFrame:
    """One row: source, description, key column, row and column counts, the
    column list and the NULL count of every column as a map. With ``rescued``
    (the column of a CSV scan that holds what did not parse, none of the source's own) also ``malformed_fields``, counted by the same scan."""
    cols = [c for c in df.columns if c != rescued]
    bad = [F.coalesce(F.sum(F.coalesce(F.size(F.map_keys(rescued)), F.lit(0))), F.lit(0)).alias("malformed_fields")] if rescued else []
    aggs = bad + [F.count(F.lit(1)).alias("row_count")] + [
        F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    return wide.select(
        F.lit(source).alias("filename"),
        F.lit(description).alias("description"),
        F.lit(key_column).alias("key_column"),
        F.col("row_count"),
        F.lit(len(cols)).alias("column_count"),
        F.array(*[F.lit(c) for c in cols]).alias("columns"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                          F.array(*[F.col(f"_n{i}") for i in range(len(cols))])).alias("null_counts"),
        *(["malformed_fields"] if rescued else []),
    )


def value_counts(df: DataFrame, col: str, out_col: str = "n") -> DataFrame:
    """(value, n) for non-NULL values, most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out_col))
            .orderBy(F.col(out_col).desc(), F.col(col)))


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Order-free change detector: row count + sum of 60-bit row hashes (the
    first 15 hex digits of the MD5 of the columns' text, NULL marked apart).

    Equal tables give equal fingerprints however they are partitioned or
    ordered; the sum runs in decimal(38,0), so it cannot overflow.
    """
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in columns or df.columns])
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(h).cast("string").alias("hash_sum"))
