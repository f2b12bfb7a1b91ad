"""Scans of a dataset as an ``images`` table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.joins import salted_join
from ..schema import SUBJECT

LAYOUTS = {
    "standard": r"/([^/]+)/([^/]+)/[^/]+\.nii(?:\.gz)?$",
    "bids": r"/([^/]+)/anat/\1_([^/]*?)\.nii(?:\.gz)?$",
}


def list_volumes(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """Paths of all volume files; the bytes are only read if ``content`` asks for them."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.nii*")
            .load(root).select("path", "length", *(["content"] if content else [])))


def scan_dataset(spark: SparkSession, root: str, acquisitions: dict[str, str], layout: str = "standard",
                 content: bool = False) -> DataFrame:
    """(subject_id, acq, path) of a directory tree, on request with the ``content`` of each file for decoding. ``acquisitions`` maps the name used here to the one in the paths: a
    folder (``standard``: subject/acq/file) or the start of the file name after the subject (``bids``)."""
    pattern = LAYOUTS[layout]
    extra = ["content"] if content else []
    found = list_volumes(spark, root, content).select(
        F.regexp_extract("path", pattern, 1).alias(SUBJECT), F.regexp_extract("path", pattern, 2).alias("_a"), "path", *extra)
    acq = F.lit(None).cast("string")
    for name, text in acquisitions.items():
        hit = F.col("_a") == text if layout == "standard" else F.col("_a").startswith(text)
        acq = F.when(hit, F.lit(name)).otherwise(acq)
    out = found.filter(F.col(SUBJECT) != "").select(SUBJECT, acq.alias("acq"), "path", *extra).filter("acq IS NOT NULL")
    checked_scans(out.drop("content"))
    return out


def scan_manifest(manifest: DataFrame) -> DataFrame:
    """The same table from explicit paths."""
    return checked_scans(manifest.select(SUBJECT, "acq", "path"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return scan_manifest(spark.read.schema("subject_id string, acq string, path string").json(path))


def duplicate_scans(scans: DataFrame) -> DataFrame:
    """Subjects with more than one file for an acquisition."""
    return scans.groupBy(SUBJECT, "acq").agg(F.count("*").alias("n")).filter("n > 1")


def checked_scans(scans: DataFrame, shown: int = 20) -> DataFrame:
    if scans.isEmpty():
        raise ValueError("no scan found")
    twice = [(r[SUBJECT], r.acq) for r in duplicate_scans(scans).limit(shown).collect()]
    if twice:
        raise ValueError(f"more than one file for {twice}")
    return scans


def pick_file(files: DataFrame, number: int, keys: Sequence[str] = (SUBJECT, "acq")) -> DataFrame:
    """The file with the given 0-based number in path order per scan; ``path`` is NULL where there are not as many."""
    ordered = files.groupBy(*keys).agg(F.array_sort(F.collect_list("path")).alias("_p"))  # a handful of echoes per scan
    return ordered.select(*keys, F.get("_p", F.lit(number)).alias("path"))


def reuse_stage(spark: SparkSession, stage_dir: str, subjects: DataFrame | None = None) -> DataFrame:
    """Stored results of a stage, partitioned by subject, for the wanted subjects only."""
    stored = spark.read.parquet(stage_dir)
    return stored if subjects is None else salted_join(stored, subjects.select(SUBJECT).distinct(), how="left_semi")
