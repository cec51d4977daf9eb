"""Publishing and loading: a crash at any step, and readers during a load."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from towerlens.operators import DataQualityError
from towerlens.operators.constraints import TableConstraints
from towerlens.schemas import FACT_REGIONAL_PERFORMANCE as REGIONAL
from towerlens.sinks import load_table
from towerlens.sinks import writers
from towerlens.sinks.publish import current, expire, new_version, publish, published
from towerlens.sources import hadoop_fs


class Crash(Exception):
    pass


def write_version(spark, layer, n):
    version = new_version()
    spark.range(n).write.parquet(f"{layer}/{version}/t")
    return version


def rows(spark, layer):
    return spark.read.parquet(f"{current(spark, layer)}/t").count()


@pytest.mark.parametrize("call", ["create_empty", "delete"])
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("nth", [1, 2])
def test_a_crash_at_any_file_system_call_leaves_a_readable_version(spark, scratch, monkeypatch, call, after, nth):
    for n in (1, 2, 3):
        publish(spark, scratch, write_version(spark, scratch, n))
    version, real, seen = write_version(spark, scratch, 4), getattr(hadoop_fs, call), []

    def crashing(*args):
        seen.append(args)
        if len(seen) == nth:
            if after:
                real(*args)
            raise Crash
        return real(*args)
    monkeypatch.setattr(hadoop_fs, call, crashing)
    crashed = False
    try:
        publish(spark, scratch, version)
    except Crash:
        crashed = True
    monkeypatch.undo()
    before_switch = crashed and call == "create_empty" and not after
    assert rows(spark, scratch) == (3 if before_switch else 4)
    publish(spark, scratch, write_version(spark, scratch, 5))  # the next run goes on and clears up
    assert rows(spark, scratch) == 5 and len(published(spark, scratch)) == 2
    assert len([d for d in os.listdir(scratch) if d.startswith("v-")]) <= 3


def test_a_version_that_is_still_written_is_not_current(spark, scratch):
    publish(spark, scratch, write_version(spark, scratch, 2))
    write_version(spark, scratch, 9)
    assert rows(spark, scratch) == 2
    expire(spark, scratch)
    assert rows(spark, scratch) == 2 and len(hadoop_fs.list_dirs(spark, scratch)) == 3  # two versions and the markers
    with pytest.raises(FileNotFoundError):
        publish(spark, scratch, "v-missing")
    with pytest.raises(FileNotFoundError):
        current(spark, f"{scratch}/nothing")


def regional(spark, n):
    values = [F.col("id").cast("string").alias("region") if f.name == "region" else F.lit(1).cast(f.dataType).alias(f.name) for f in REGIONAL.fields]
    return spark.range(n).select(*values)


def test_readers_see_old_or_new_rows_during_loads(spark, scratch):
    name = "tl_load_readers"
    load_table(spark, name, regional(spark, 3), REGIONAL, root=f"{scratch}/t")
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.table(name).count())
            except Exception as e:  # noqa: BLE001
                errors.append(e)
    reader = threading.Thread(target=read)
    reader.start()
    for n in (5, 3, 5, 3, 5):
        assert load_table(spark, name, regional(spark, n), REGIONAL) == n
    stop.set()
    reader.join()
    assert not errors and set(seen) <= {3, 5} and len(seen) > 5
    assert len(hadoop_fs.list_dirs(spark, f"{scratch}/t")) == 2  # the files read now and those before


def test_failed_check_or_crash_leaves_the_old_rows(spark, scratch, monkeypatch):
    name, rule = "tl_load_gate", TableConstraints("t", primary_key=("region",))
    load_table(spark, name, regional(spark, 4), REGIONAL, root=f"{scratch}/t", check=rule)
    twice = regional(spark, 4).unionByName(regional(spark, 4))
    with pytest.raises(DataQualityError):
        load_table(spark, name, twice, REGIONAL, check=rule)
    assert spark.table(name).count() == 4

    def crash(*_):
        raise Crash
    monkeypatch.setattr(writers, "switch_table", crash)
    with pytest.raises(Crash):
        load_table(spark, name, regional(spark, 6), REGIONAL)
    assert spark.table(name).count() == 4
    monkeypatch.undo()
    assert load_table(spark, name, regional(spark, 0), REGIONAL) == 0
    assert load_table(spark, name, regional(spark, 7), REGIONAL) == 7


def test_a_table_of_another_lake_keeps_its_files_and_columns(spark, scratch):
    name = "tl_load_lakes"
    load_table(spark, name, regional(spark, 2), REGIONAL, root=f"{scratch}/a")
    files = hadoop_fs.list_dirs(spark, f"{scratch}/a")
    assert load_table(spark, name, regional(spark, 8), REGIONAL, root=f"{scratch}/b") == 8
    assert hadoop_fs.list_dirs(spark, f"{scratch}/a") == files and writers.table_location(spark, name).startswith(f"file:{scratch}/b")
    from towerlens.schemas import FACT_CHURN_COHORT
    with pytest.raises(writers.TableMismatchError):
        load_table(spark, name, spark.createDataFrame([], FACT_CHURN_COHORT), FACT_CHURN_COHORT)
    assert spark.table(name).count() == 8
    with pytest.raises(ValueError):
        load_table(spark, "tl_never_declared", regional(spark, 1), REGIONAL)
