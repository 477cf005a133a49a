"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

K = TypeVar("K")
V = TypeVar("V")

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # collect_set per order has many small groups: stay hashed instead of sorting after 128 keys.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # a run generates several hundred classes; with the default of 100 they are compiled over and over
    "spark.sql.codegen.cache.maxEntries": "2000",
}

# Tables that do not depend on each other are written at the same time, this many at once.
WRITERS = 4

_scratch: dict[str, str] = {}


def local_session(app: str = "ordermill", cpus: str | int = "*", **extra: str) -> SparkSession:
    """Session for one machine: tests, benches and trials."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(cores),
        # small stages keep all cores busy instead of ending up in one task
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **extra,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder of this application below spark.checkpoint.dir, removed when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if base is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
            path = tempfile.mkdtemp(prefix="ordermill-")
        else:
            path = f"{base.rstrip('/')}/ordermill-{uuid.uuid4().hex}"
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
        _scratch[app] = path
    return _scratch[app]


def at_the_same_time(action: Callable[[K], V], names: Iterable[K]) -> dict[K, V]:
    """Result of ``action`` for each name. The first failure is raised."""
    names = list(names)
    with ThreadPoolExecutor(WRITERS) as pool:
        return dict(zip(names, pool.map(action, names)))


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """``name`` set to ``value`` for the jobs that are run inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: computed once, lineage cut, safe to lose executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
