"""A whole cohort run: predictions to region statistics, cohort tables and quality control."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.regions import BIOMARKER_SCHEME, WHOLE_BRAIN, region_dictionary
from ..operators import clusters, cohort, components, models, voxel
from ..schema import SUBJECT, VOXEL
from ..session import cut_lineage
from ..sources import tables
from .settings import Settings


@dataclass
class CohortResult:
    """Result tables; ``census`` and ``stats`` carry a ``biomarker`` column."""

    census: DataFrame
    stats: DataFrame
    wide: dict[str, DataFrame] = field(default_factory=dict)
    reports: dict[str, DataFrame] = field(default_factory=dict)
    qc: DataFrame | None = None
    failed_qc: DataFrame | None = None


def predict_biomarker(channels: list[DataFrame], mask: DataFrame, model: models.Model, n_folds: int, settings: Settings) -> DataFrame:
    """Mean map of the folds of a model inside the brain mask."""
    maps = models.predict_volumes(voxel.stack_channels(channels), model, n_folds, settings.cropped_dims)
    return models.fold_ensemble(maps, n_folds, mask)


def run_cohort(predictions: dict[str, DataFrame], mask: DataFrame, settings: Settings, subjects: DataFrame, labels: DataFrame | None = None,
               qc: DataFrame | None = None, population: DataFrame | None = None, voxel_volume: float = 1.0,
               regions: DataFrame | None = None) -> CohortResult:
    """Post-process probability maps ``{biomarker: voxels}`` of a cohort.

    Without ``labels`` only the whole brain is reported. ``labels`` is the derived parcellation, or with ``regions``
    (region_label, region, ord) a custom one. ``qc`` rows, possibly next to an earlier ``population``, are judged.
    """
    spark = mask.sparkSession
    census, stats, wide, reports = None, None, {}, {}
    for name, prob in predictions.items():
        threshold, size = settings.threshold(name), settings.min_sizes[name]
        if labels is None:
            marked = components.label_clusters(prob, threshold, settings.cropped_dims, size, mask, settings.outside_ratio)
            found = components.census(marked).withColumn("region", F.lit(None).cast("string"))
            rows = clusters.whole_brain_stats(found, subjects).withColumn("region", F.lit(WHOLE_BRAIN))
            names = [WHOLE_BRAIN]
        else:
            found, rows = clusters.region_metrics(prob, labels, name, settings.cropped_dims, threshold, size, mask, subjects,
                                                  regions, regions is not None)
            table = region_dictionary(spark, BIOMARKER_SCHEME[name]) if regions is None else regions
            names = [WHOLE_BRAIN] + [r.region for r in table.orderBy("ord").collect()]
        found = cut_lineage(found.select(SUBJECT, F.lit(name).alias("biomarker"), "cluster_id", "cluster_size", "region"))
        rows = cut_lineage(rows.select(SUBJECT, F.lit(name).alias("biomarker"), "region", *cohort.STATISTICS))
        census = found if census is None else census.unionByName(found)
        stats = rows if stats is None else stats.unionByName(rows)
        wide[name] = cohort.metrics_wide(rows, names, drop_empty=True)
        reports[name] = cohort.report_table(rows, voxel_volume)
    failed = None
    if qc is not None:
        judged = qc.withColumn("is_population", F.lit(False)) if population is None else cohort.qc_with_population(qc, population)
        failed = cohort.qc_failed(judged)
    return CohortResult(census, stats, wide, reports, qc, failed)


def write_cohort(result: CohortResult, root: str, date: str | None = None) -> None:
    """Store a run: census and statistics per biomarker, wide tables and reports as CSV, quality control appended."""
    tables.write_results(result.census, f"{root}/census", partition="biomarker")
    tables.write_results(result.stats, f"{root}/region_stats", partition="biomarker")
    for name, df in result.wide.items():
        tables.write_results(df, f"{root}/prediction_metrics_wide/{name}", "csv", digits=2)
    for name, df in result.reports.items():
        tables.write_results(df, f"{root}/report/{name}", "csv")
    if result.qc is not None:
        tables.append_with_date(result.qc, f"{root}/qc_metrics", date)
    if result.failed_qc is not None:
        lines = cohort.qc_failed_json(result.failed_qc.filter("NOT is_population").drop("is_population"))
        lines.select("json").write.mode("overwrite").text(f"{root}/failed_qc")


def stored_stage(spark: SparkSession, root: str, subjects: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored images and masks of an earlier preprocessing, to start a run from."""
    from ..sources.layout import reuse_stage

    return (reuse_stage(spark, f"{root}/image", subjects).select(*VOXEL, "v"), reuse_stage(spark, f"{root}/mask", subjects).select(*VOXEL))
