"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that are still unset. ``checkpoint_dir`` reads
``spark.checkpoint.dir`` from the session and installs a fallback only when
the caller passes one (tests and the local bench do, a cluster job must not).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from typing import Any

from pyspark import inheritable_thread_target

from pyspark.sql import DataFrame, SparkSession

from towerlens.sources import hadoop_fs

# Settings that every plan in this package assumes. They are defaults: a value
# already present in the session (cluster config) wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",  # a join whose smaller side is small in each task sorts neither
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "towerlens", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where the session does not set them already."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession, fallback=None) -> str | None:
    """The shared checkpoint folder named by the session.

    An installed SparkContext checkpoint dir wins, then ``spark.checkpoint.dir``
    (cluster setting); otherwise ``fallback`` (a path, or a callable making
    one, evaluated only then) is installed -- tests and local runs only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    target = named or (fallback() if callable(fallback) else fallback)
    if target:
        sc.setCheckpointDir(target)
        return sc.getCheckpointDir()
    return None


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the session's shared
    checkpoint folder and return the table read back. ``options`` are further
    options of the writer.

    Columnar and compressed (unlike row-serialized RDD checkpoint blocks),
    and the scan carries statistics. Requires ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("no checkpoint folder: set spark.checkpoint.dir to a shared folder")
    path = f"{root.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").options(compression="zstd", **options).parquet(path)
    _MATERIALIZED.append(path)
    out = spark.read.parquet(path)
    out._towerlens_path = path
    return out


_MATERIALIZED: list[str] = []


def release(df: DataFrame) -> None:
    """Delete the table behind a ``materialize``d DataFrame (no longer read)."""
    path = getattr(df, "_towerlens_path", None)
    if path:
        hadoop_fs.delete(df.sparkSession, path)
        if path in _MATERIALIZED:
            _MATERIALIZED.remove(path)


def materialized() -> int:
    """How many tables ``materialize`` has written so far and not released: a mark for ``release_since``."""
    return len(_MATERIALIZED)


def release_since(spark: SparkSession, mark: int) -> None:
    """Delete the tables written after ``mark``: what the caller made itself, never another owner's."""
    while len(_MATERIALIZED) > mark:
        hadoop_fs.delete(spark, _MATERIALIZED.pop())


def run_concurrently(spark: SparkSession, tasks: dict[str, Callable[[], Any]],
                     max_workers: int = 8) -> dict[str, Any]:
    """Run independent Spark actions from separate driver threads.

    Spark schedules jobs from different threads side by side, so small jobs
    (a one-row report, a dimension write) fill cores a large job leaves
    idle instead of queueing behind it. Job descriptions follow the task
    names; the first error is re-raised after all tasks finish.
    """
    def wrap(name, fn):
        def go():
            spark.sparkContext.setJobDescription(name)
            return fn()
        return inheritable_thread_target(spark)(go)

    with ThreadPoolExecutor(max_workers=min(max_workers, max(1, len(tasks)))) as pool:
        futures = {name: pool.submit(wrap(name, fn)) for name, fn in tasks.items()}
        wait(list(futures.values()))
    return {name: f.result() for name, f in futures.items()}
