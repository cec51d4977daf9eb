"""Labelled rows of a classifier, bounded and chosen alike at every size, and sums of arrays over a cluster."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Arrays that one task adds up in a round.
FAN_IN = 8
#: Rounds; FAN_IN ** ROUNDS tasks leave one array, more leave a few.
ROUNDS = 5


def labelled_sample(labels: DataFrame, label: str, training: Column, most: int) -> DataFrame:
    """(label_id, label): at most ``most`` training rows of ``labels``, those of the smallest hash of their id.

    ``training`` is a condition on ``doc_id``. Null ids and labels are left out; of rows that share an id the larger
    label counts. The bound makes the result safe to broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label")) \
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & training)
    one = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(F.col("doc_id").alias("label_id"), "label")


def _add(rows: pd.DataFrame) -> np.ndarray:
    return np.sum([np.frombuffer(x, dtype="<f8") for x in rows["total"]], axis=0)


def summed(df: DataFrame, per_batch, size: int) -> np.ndarray:
    """Sum over all batches of ``df`` of ``per_batch(frame)`` (an array of ``size`` numbers, whatever the data).

    Each task adds its batches; tasks are added FAN_IN at a time in ROUNDS rounds on the cluster, so neither a task nor
    the driver ever holds more than a few arrays.
    """
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for b in batches:
            total += per_batch(b)
        yield pd.DataFrame({"task": [TaskContext.get().partitionId()], "total": [total.astype("<f8").tobytes()]})

    def merge(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"task": [int(key[0])], "total": [_add(rows).tobytes()]})

    found = df.mapInPandas(task, "task long, total binary")
    for _ in range(ROUNDS):
        found = found.groupBy(F.expr(f"task div {FAN_IN}").alias("group_")).applyInPandas(merge, "task long, total binary")
    rows = found.toPandas()
    return _add(rows) if len(rows) else np.zeros(size)
