"""Results of processing stages, kept by subject, with a record of which subjects are complete.

A stage is a folder with ``data`` (Parquet, partitioned by bucket, a hash of the subject, and run) and ``commits`` (one row a subject of a finished write). Rows
of a run count only where a commit names that run for the subject: a write that was lost half-way leaves nothing that is read, and one that was repeated leaves
one result. Reading some subjects opens only their buckets and runs.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import SUBJECT
from ..session import drop_stage

BUCKETS = 256


@dataclass(frozen=True)
class StageStore:
    """The stages under ``root``, a folder that all executors reach."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(SUBJECT).cast("string")), F.lit(self.buckets)).cast("int")

    def _folder(self, stage: str, part: str) -> str:
        return f"{self.root.rstrip('/')}/{stage}/{part}"

    def commits(self, stage: str) -> DataFrame | None:
        """(subject_id, bucket, run) of the complete subjects, the run that finished last; None before the first commit."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(stage, "commits"))
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        found = self.spark.read.parquet(self._folder(stage, "commits"))
        return found.groupBy(SUBJECT, "bucket").agg(F.max_by("run", F.struct("at", "run")).alias("run"))

    def missing(self, stage: str, subjects: DataFrame) -> DataFrame:
        """Those of ``subjects`` that the stage has no complete result of."""
        done, wanted = self.commits(stage), subjects.select(SUBJECT).distinct()
        return wanted if done is None else wanted.join(done.select(SUBJECT), SUBJECT, "left_anti")

    def write_data(self, stage: str, rows: DataFrame) -> str:
        """Write rows as a run of their own, not yet committed. Large buckets are split over files, small ones share a task."""
        run = f"run-{uuid.uuid4().hex}"
        placed = rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").withColumn("run", F.lit(run))
        placed.write.mode("append").partitionBy("bucket", "run").parquet(self._folder(stage, "data"))
        return run

    def commit(self, stage: str, subjects: DataFrame, run: str) -> None:
        """The given subjects, also those without any row, are complete in this run."""
        rows = subjects.select(SUBJECT).distinct().select(SUBJECT, self._bucket().alias("bucket"), F.lit(run).alias("run"), F.lit(time.time_ns()).alias("at"))
        rows.write.mode("append").parquet(self._folder(stage, "commits"))

    def write(self, stage: str, rows: DataFrame, subjects: DataFrame) -> str:
        """Write the rows of ``subjects`` and commit them."""
        run = self.write_data(stage, rows)
        self.commit(stage, subjects, run)
        return run

    def read(self, stage: str, subjects: DataFrame | None = None) -> DataFrame:
        """Rows of the complete subjects, or of those of ``subjects`` that are. Only their buckets are listed (at most ``buckets`` numbers come to the driver), and runs
        are pruned by the join."""
        done = self.commits(stage)
        if done is None:
            raise ValueError(f"nothing is complete in stage {stage}")
        stored = self.spark.read.parquet(self._folder(stage, "data"))
        if subjects is not None:
            done = done.join(subjects.select(SUBJECT).distinct(), SUBJECT, "left_semi")
            buckets = [r[0] for r in done.select("bucket").distinct().collect()]
            stored = stored.filter(F.col("bucket").isin(buckets))
        return stored.join(done, [SUBJECT, "bucket", "run"], "left_semi").drop("bucket", "run")

    def resume(self, stage: str, subjects: DataFrame, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Rows of ``subjects``; ``make`` (missing subjects -> their rows) runs only for those that are not complete, and not at all if all are."""
        todo = self.missing(stage, subjects)
        if not todo.isEmpty():
            self.write(stage, make(todo), todo)
        return self.read(stage, subjects)

    def drop(self, stage: str) -> None:
        drop_stage(self.spark, f"{self.root.rstrip('/')}/{stage}")
