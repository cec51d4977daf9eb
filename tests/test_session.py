"""Session helpers: concurrent actions, materialized tables, checkpoint folder."""

import os

import pytest
from pyspark.sql import functions as F

from towerlens.session import checkpoint_dir, materialize, materialized, release, release_since, run_concurrently
from towerlens.sources import hadoop_fs


def test_run_concurrently_returns_all_and_raises_first_error(spark):
    out = run_concurrently(spark, {f"t{i}": (lambda i=i: spark.range(100 * (i + 1)).count()) for i in range(4)})
    assert out == {"t0": 100, "t1": 200, "t2": 300, "t3": 400}

    def boom():
        raise ValueError("boom")

    with pytest.raises(ValueError):
        run_concurrently(spark, {"ok": lambda: spark.range(5).count(), "bad": boom})


def test_materialize_cuts_lineage_and_release_deletes(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"))
    m = materialize(df, "unit")
    path = m._towerlens_path
    assert path.startswith(checkpoint_dir(spark).rstrip("/"))
    assert "FileScan parquet" in m._jdf.queryExecution().executedPlan().toString()
    assert m.exceptAll(df).count() == 0 and df.exceptAll(m).count() == 0
    release(m)
    assert not hadoop_fs.exists(spark, path)
    kept = materialize(df, "unit2")
    mark = materialized()
    other = materialize(df, "unit3")
    release_since(spark, mark)
    assert not hadoop_fs.exists(spark, other._towerlens_path) and hadoop_fs.exists(spark, kept._towerlens_path)
    release(kept)


def test_checkpoint_dir_prefers_session_setting(spark, scratch):
    current = checkpoint_dir(spark)
    assert current and checkpoint_dir(spark, fallback=lambda: os.path.join(scratch, "never")) == current
    assert not os.path.exists(os.path.join(scratch, "never"))
