"""Model descriptors and checksums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Names that a model folder may carry (fixed values).
TARGETS = ["PVS", "WMH", "CMB", "LAC", "brain_mask"]
MODALITIES = ["t1", "flair", "swi", "t2", "t2s"]

DESCRIPTOR = """version string, `release date` string, author string, target string, modalities array<string>,
files array<struct<name: string, md5: string>>, script struct<name: string, md5: string>, url string"""


def file_checksums(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(name, md5) of every file below ``root``; names are relative to it."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root))
    prefix = root.rstrip("/") + "/"
    return files.select(F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "^" + prefix, "").alias("name"), F.md5("content").alias("md5"))


def directory_checksums(files: DataFrame, folder: str = "folder", name: str = "name", content: str = "content") -> DataFrame:
    """Checksum of each model directory: its files in name order, one after another. A directory is one saved model.

    A checksum of a sequence is sequential, so a directory is read by one task; it streams through, file by file, and is never held as a whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, count = None, None, 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current], pa.string()), pa.array([digest.hexdigest()]), pa.array([count], pa.int64())],
                                              names=[folder, "md5", "n_files"])

        for batch in batches:
            for k in range(batch.num_rows):
                where = batch.column(0)[k].as_py()
                if digest is None or where != current:
                    if digest is not None:
                        yield done()
                    current, digest, count = where, hashlib.md5(), 0
                digest.update(batch.column(2)[k].as_py() or b"")
                count += 1
        if digest is not None:
            yield done()

    rows = files.select(F.col(folder).cast("string").alias(folder), F.col(name).alias("_name"), F.col(content).cast("binary").alias("_content"))
    ordered = rows.repartition(folder).sortWithinPartitions(folder, "_name", "_content")
    return ordered.mapInArrow(run, f"`{folder}` string, md5 string, n_files bigint")


def read_descriptor(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DESCRIPTOR).option("multiLine", "true").json(path)


def listed_files(descriptor: DataFrame) -> DataFrame:
    """(name, md5) rows of a descriptor, its script included."""
    files = F.when(F.col("script").isNull(), F.col("files")).otherwise(F.concat("files", F.array("script")))
    return descriptor.select(F.inline(files))


def verify_model_files(listed: DataFrame, present: DataFrame) -> DataFrame:
    """Status of every listed or present file: ok, missing, mismatch or unlisted."""
    a = listed.select("name", F.col("md5").alias("listed_md5"))
    b = present.select("name", F.col("md5").alias("found_md5"))
    status = (F.when(F.col("found_md5").isNull(), "missing").when(F.col("listed_md5").isNull(), "unlisted")
              .when(F.col("listed_md5") != F.col("found_md5"), "mismatch").otherwise("ok"))
    return a.join(b, "name", "full_outer").withColumn("status", status)


def folder_target(folder: Column) -> Column:
    """The one target a folder name mentions; NULL if there is none or more than one."""
    hits = F.array_compact(F.array(*[F.when(F.contains(folder, F.lit(t)), F.lit(t)) for t in TARGETS],
                                   F.when(F.contains(folder, F.lit("brainmask")), F.lit("brain_mask"))))
    return F.when(F.size(hits) == 1, hits[0])


def folder_modalities(folder: Column) -> Column:
    """Modalities whose upper-case name is in the folder name."""
    return F.array_compact(F.array(*[F.when(F.contains(folder, F.lit(m.upper())), F.lit(m)) for m in MODALITIES]))


def build_descriptor(files: DataFrame) -> DataFrame:
    """One descriptor per model folder from (folder, name, md5) rows; a ``.py`` file becomes the script.

    ``status`` tells what a name lacks; ``json`` is the document to write.
    """
    script = F.col("name").endswith(".py")
    pair = F.struct("name", "md5")
    out = files.groupBy("folder").agg(F.array_sort(F.collect_list(F.when(~script, pair))).alias("files"), F.max(F.when(script, pair)).alias("script"))
    out = out.withColumns({"target": folder_target(F.col("folder")), "modalities": folder_modalities(F.col("folder"))})
    status = F.when(F.col("target").isNull(), "no single target").when(F.size("modalities") == 0, "no modality").otherwise("ok")
    return out.withColumns({"status": status, "json": F.to_json(F.struct("target", "modalities", "files", "script"))})
