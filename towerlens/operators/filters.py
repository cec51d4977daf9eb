"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def outlier_filter(df: DataFrame, col: str, max_value: float,
                   observation: Observation | None = None) -> DataFrame:
    """Keep rows with ``col <= max_value``; NULLs are removed too.

    With an ``Observation`` the rows seen and kept are counted during the same
    scan that produces the result (no second job): ``rows_in``, ``rows_kept``.
    """
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows_in"),
                        F.count_if(F.col(col) <= F.lit(max_value)).alias("rows_kept"))
    return df.where(F.col(col) <= F.lit(max_value))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group-by keys must be present (dataframe group-bys drop NULL keys)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else (cond & c)
    return df.where(cond) if cond is not None else df
