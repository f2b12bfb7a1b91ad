"""Which participants and acquisitions a run needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import SUBJECT

# Acquisitions that each prediction needs (fixed values).
NEEDS = {
    "PVS": ["t1"],
    "PVS2": ["t1", "flair"],
    "WMH": ["t1", "flair"],
    "CMB": ["swi"],
    "LAC": ["t1", "flair"],
}
ALL_PREDICTIONS = ["PVS2", "WMH", "CMB", "LAC"]


def expand_predictions(predictions: Sequence[str]) -> list[str]:
    """``all`` stands for one model of each biomarker; PVS in the list picks the single-channel PVS model."""
    if "all" not in predictions:
        return list(predictions)
    return ["PVS" if p == "PVS2" and "PVS" in predictions else p for p in ALL_PREDICTIONS]


def prediction_acquisitions(spark: SparkSession, predictions: Sequence[str], replacements: dict[str, str] | None = None) -> DataFrame:
    """(prediction, role, acq): the role an acquisition plays and the scan that fills it (t2 for t1, say)."""
    swap = replacements or {}
    rows = [(p, role, swap.get(role, role)) for p in expand_predictions(predictions) for role in NEEDS[p]]
    return spark.createDataFrame(rows, "prediction string, role string, acq string")


def required_acquisitions(images: DataFrame, predictions: Sequence[str], replacements: dict[str, str] | None = None) -> DataFrame:
    """Every (subject, prediction, role) with the acquisition that fills it and whether the subject has it."""
    needs = prediction_acquisitions(images.sparkSession, predictions, replacements)
    listed = F.array(*[F.struct(*map(F.lit, r)) for r in needs.collect()])  # at most a dozen rows
    wanted = images.select(SUBJECT).distinct().withColumn("_n", F.explode(listed)).select(
        SUBJECT, *[F.col(f"_n.col{n + 1}").alias(c) for n, c in enumerate(needs.columns)])
    present = images.select(SUBJECT, "acq").distinct().withColumn("present", F.lit(True))
    return wanted.join(present, [SUBJECT, "acq"], "left").withColumn("present", F.coalesce("present", F.lit(False)))


def read_subject_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a text file, separated by line ends, blanks, ``;``, ``|`` or ``,``."""
    return split_subjects(spark.read.text(path).withColumnRenamed("value", "text"))


def split_subjects(texts: DataFrame) -> DataFrame:
    parts = F.split("text", r"[\s;|,]+")
    return texts.select(F.explode(parts).alias(SUBJECT)).filter(F.length(SUBJECT) > 0).distinct()


def select_subjects(available: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Available subjects of the inclusion list (all by default) that are not excluded."""
    out = available.select(SUBJECT).distinct()
    if include is not None:
        out = out.join(include.select(SUBJECT), SUBJECT, "left_semi")
    if exclude is not None:
        out = out.join(exclude.select(SUBJECT), SUBJECT, "left_anti")
    return out


def missing_subjects(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Requested subjects that are not available, sorted. Also the subjects without stored results of a stage."""
    return requested.select(SUBJECT).distinct().join(available.select(SUBJECT), SUBJECT, "left_anti").orderBy(SUBJECT)


def checked_subjects(available: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None, shown: int = 20) -> DataFrame:
    """:func:`select_subjects` that raises if a listed subject is unknown or nobody is left."""
    for name, listed in (("included", include), ("excluded", exclude)):
        if listed is not None:
            unknown = [r[SUBJECT] for r in missing_subjects(listed, available).limit(shown).collect()]
            if unknown:
                raise ValueError(f"{name} subjects that are not available: {unknown}")
    out = select_subjects(available, include, exclude)
    if out.isEmpty():
        raise ValueError("no subject left")
    return out
