"""Session settings and lineage control."""

from __future__ import annotations

import atexit
import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this package is written for.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}

#: Rows that one task generates, where their number is known.
GENERATED_ROWS = 1 << 20

#: Scratch folder of a local session without a named one; removed when Python ends.
_SCRATCH: dict[str, tempfile.TemporaryDirectory] = {}


def build_session(app: str = "voxelry", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A scratch folder is only made for a local master: on a cluster every executor has to reach the folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _SCRATCH:
            _SCRATCH["local"] = tempfile.TemporaryDirectory(prefix="voxelry-checkpoint-", ignore_cleanup_errors=True)
        shared = _SCRATCH["local"].name
    return shared


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so a lost executor never replays the whole history."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed with its content when the session's Python process ends."""
    path = f"{shared_folder(spark).rstrip('/')}/stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    atexit.register(drop_stage, spark, path)
    return path


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a staged table; does nothing once the session has stopped."""
    if spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: computed once, columnar, and safe from lost executors."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Settings under which a folder of very many small files is listed and read: some tasks a core list them all, where Spark takes up to
    10 000, and a task reads some hundred files, where Spark takes 32."""
    wanted = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(8 * spark.sparkContext.defaultParallelism),
              "spark.sql.files.openCostInBytes": str(1 << 19)}
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, wherever they were started; once a Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_voxelry_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    held = tempfile.TemporaryDirectory(prefix="voxelry-package-", ignore_cleanup_errors=True)
    path = os.path.join(held.name, "voxelry.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._voxelry_shipped = held  # the driver serves the file as long as the context lives


def scatter(df: DataFrame, *columns: str, each: int = 0) -> DataFrame:
    """Spread few rows that each generate many over all shuffle partitions (an unnumbered repartition of small rows
    would be merged again by the adaptive planner). Where every row generates ``each`` rows, the rows are counted and
    spread so that a task generates about ``GENERATED_ROWS`` at most."""
    spark = df.sparkSession
    if each:
        return df.repartition(max(spark.sparkContext.defaultParallelism, math.ceil(df.count() * each / GENERATED_ROWS)), *columns)
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *columns)
