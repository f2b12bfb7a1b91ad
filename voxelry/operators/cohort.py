"""Quality control, cohort tables and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import attach
from ..functions.quantiles import exact_percentiles
from ..schema import SUBJECT, Dims
from ..session import staged
from .geometry import registration_magnitude
from .stats import histogram_mode

#: From this cohort size on outliers are judged.
MIN_COHORT = 10
FENCE = 1.5
STATISTICS = ("n_clusters", "total_vol", "mean_vol", "median_vol", "std_vol", "min_vol", "max_vol")


def qc_row(mask: DataFrame, normalised: dict[str, DataFrame], dims: Dims, transforms: dict[str, DataFrame] | None = None) -> DataFrame:
    """Quality measures per subject: mask size, peak of each normalised image, size of each registration.

    Keys of ``normalised`` (main, flair, swi) and ``transforms`` (flair, swi) name the columns; a measure exists only if
    its input does.
    """
    out = mask.groupBy(SUBJECT).agg(F.count("*").alias("brain_mask_size"))
    for name, image in normalised.items():
        peak = histogram_mode(image, dims).withColumnRenamed("mode", f"{name}_norm_peak")
        out = out.join(peak, SUBJECT, "left")
    for name, table in (transforms or {}).items():
        moved = registration_magnitude(table).select(
            SUBJECT, F.col("rotation").alias(f"rotation_{name}_reg"), F.col("translation").alias(f"translation_{name}_reg"))
        out = out.join(moved, SUBJECT, "left")
    return out


def qc_latest(qc: DataFrame, date: str = "append_date", position: Sequence[str] = ()) -> DataFrame:
    """Newest row per subject of a table that results were appended to, without its date column."""
    rest = [c for c in qc.columns if c != SUBJECT]
    order = F.struct(*[F.col(c) for c in (date, *position)], *[F.col(c) for c in rest if c not in (date, *position)])
    newest = qc.groupBy(SUBJECT).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return newest.select(SUBJECT, "_r.*").drop(date)


def qc_with_population(qc: DataFrame, population: DataFrame) -> DataFrame:
    """Current rows and an earlier population on the columns both have, told apart by ``is_population``."""
    shared = [c for c in qc.columns if c in population.columns]
    return (qc.select(*shared, F.lit(False).alias("is_population"))
            .unionByName(population.select(*shared, F.lit(True).alias("is_population"))))


def metric_columns(qc: DataFrame, by: Sequence[str] = ()) -> list[str]:
    return [c for c in qc.columns if c not in (SUBJECT, "is_population", "append_date", *by)]


def qc_long(qc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per subject and measure; missing measures are left out."""
    metrics = metric_columns(qc, by)
    ids = [c for c in (SUBJECT, *by, "is_population") if c in qc.columns]
    rows = qc.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return rows.unpivot(ids, metrics, "metric", "value").filter("value IS NOT NULL")


def qc_bounds(qc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Fences per measure, and per cohort where ``by`` names one: 1.5 interquartile ranges beyond the quartiles."""
    q = exact_percentiles(staged(qc_long(qc, by), "measures"), [*by, "metric"], "value", [0.25, 0.75])
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return q.select(*by, "metric", (q1 - FENCE * (q3 - q1)).alias("low"), (q3 + FENCE * (q3 - q1)).alias("high"))


def _with_cohort_size(rows: DataFrame, qc: DataFrame, by: Sequence[str]) -> DataFrame:
    sizes = qc.groupBy(*by).agg(F.count("*").alias("cohort_size"))
    if not by:
        return rows.join(F.broadcast(sizes), how="cross")  # a single row
    return attach(rows, sizes, by, salt_by=[SUBJECT])


def qc_outliers(qc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Values beyond the fences, in cohorts of at least ten rows."""
    rows = attach(qc_long(qc, by), qc_bounds(qc, by), [*by, "metric"], salt_by=[SUBJECT])
    judged = _with_cohort_size(rows, qc, by).filter(F.col("cohort_size") >= MIN_COHORT)
    return judged.filter((F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))).drop("cohort_size")


def qc_peak_range(qc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Peaks of normalised images outside [0, 1]."""
    rows = qc_long(qc, by).filter(F.col("metric").endswith("_norm_peak"))
    return rows.filter((F.col("value") > 1) | (F.col("value") < 0))


def qc_failed(qc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Subjects with the sorted set of the measures they fail, current and population subjects apart."""
    ids = [c for c in (SUBJECT, *by, "is_population") if c in qc.columns]
    bad = qc_outliers(qc, by).select(*ids, "metric").unionByName(qc_peak_range(qc, by).select(*ids, "metric"))
    return bad.groupBy(*ids).agg(F.array_sort(F.collect_set("metric")).alias("metrics"))


def qc_small_cohort(qc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every value of a cohort too small to judge, none of them flagged."""
    rows = _with_cohort_size(qc_long(qc, by), qc, by).filter(F.col("cohort_size") < MIN_COHORT)
    return rows.select(SUBJECT, *by, "metric", "value", F.lit(False).alias("is_outlier"))


def qc_failed_json(failed: DataFrame) -> DataFrame:
    """One ``{subject: [metrics]}`` document per subject row, ready to be written as text."""
    entry = F.create_map(F.col(SUBJECT).cast("string"), F.col("metrics"))
    return failed.select(SUBJECT, F.to_json(entry).alias("json"))


def cohort_metrics_long(stats: DataFrame, biomarker: str | None = None) -> DataFrame:
    if biomarker is not None:
        stats = stats.filter(F.col("biomarker") == biomarker)
    return stats.select(SUBJECT, "region", *STATISTICS)


def metrics_wide(stats: DataFrame, regions: Sequence[str], drop_empty: bool = False) -> DataFrame:
    """One row per subject, columns ``Region - statistic`` sorted by name.

    ``drop_empty`` leaves out columns without any value in the cohort (one aggregate row decides).
    """
    if drop_empty:
        stats = staged(stats, "statistics")  # read twice, its clusters labelled once
    wide = stats.groupBy(SUBJECT).agg(*[
        F.avg(F.when(F.col("region") == r, F.col(s))).alias(f"{r} - {s}") for r in regions for s in STATISTICS])
    names = sorted(c for c in wide.columns if c != SUBJECT)
    if drop_empty:
        seen = stats.groupBy("region").agg(*[F.count(s).alias(s) for s in STATISTICS]).collect()  # one row per region
        filled = {f"{r.region} - {s}" for r in seen for s in STATISTICS if r[s]}
        names = [n for n in names if n in filled]
    return wide.select(SUBJECT, *[F.col(f"`{n}`") for n in names])


def report_table(stats: DataFrame, voxel_volume: float = 1.0, max_empty: int = 7) -> DataFrame:
    """Region rows in cubic millimetres with two decimals; if more than seven regions are empty they are only listed."""
    text = {s: F.format_string("%.2f", F.bround(F.col(s).cast("double") * voxel_volume, 2)) for s in STATISTICS if s != "n_clusters"}
    text = {s: F.when(F.col(s).isNotNull(), c) for s, c in text.items()}
    empty = stats.groupBy(SUBJECT).agg(
        F.count_if(F.col("n_clusters") == 0).alias("_n"),
        F.array_sort(F.collect_list(F.when(F.col("n_clusters") == 0, F.col("region")))).alias("_e"))
    rows = stats.join(empty, SUBJECT)
    folded = F.col("_n") > max_empty
    none = F.array().cast("array<string>")
    return (rows.filter(~folded | (F.col("n_clusters") > 0))
            .select(SUBJECT, "region", "n_clusters", *[c.alias(s) for s, c in text.items()],
                    F.array_join(F.when(folded, F.col("_e")).otherwise(none), ", ").alias("empty_regions")))


def report_provenance(models: DataFrame, parameters: DataFrame) -> DataFrame:
    """Model files, checksums, source and parameters per biomarker."""
    files = models.groupBy("biomarker").agg(
        F.array_sort(F.collect_list(F.struct("name", "md5"))).alias("files"), F.max("url").alias("url"))
    return parameters.join(files, "biomarker", "left")


def anonymise(rows: DataFrame, salt: str | None = None) -> DataFrame:
    """Drop the subject id from report rows, or replace it by a salted digest."""
    new: Column = F.lit("") if salt is None else F.sha2(F.concat(F.lit(salt), F.col(SUBJECT).cast("string")), 256)
    return rows.withColumn(SUBJECT, new)


