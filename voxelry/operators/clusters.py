"""Regions and statistics of labelled clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import salted_join, shuffled_join
from ..functions.quantiles import exact_percentiles
from ..functions.regions import BIOMARKER_SCHEME, PRIORITY_REGIONS, WHOLE_BRAIN, region_dictionary
from ..schema import SUBJECT, VOXEL, Dims
from ..session import cut_lineage, staged
from .components import CLUSTER_SALT, label_clusters, label_components
from .morphology import euclidean_distance
from .parcellation import parcellate


def assign_region(clusters: DataFrame, labels: DataFrame, regions: DataFrame | None = None,
                  priority: Sequence[int] = ()) -> DataFrame:
    """Census: one row per cluster with its size and the region most of its voxels have (smallest label on ties).

    If a cluster touches one of the ``priority`` labels, the most frequent of those wins. A winner outside the
    ``regions`` dictionary is called ``Label_n``; background gives no region.
    """
    seen = (shuffled_join(clusters, labels.select(*VOXEL, F.col("label").alias("_l")), how="left")
            .groupBy(SUBJECT, "cluster_id", F.coalesce("_l", F.lit(0)).alias("label")).agg(F.count("*").alias("n")))
    first = F.col("label").isin(list(priority)) if priority else F.lit(False)
    won = seen.groupBy(SUBJECT, "cluster_id").agg(
        F.sum("n").alias("cluster_size"), F.max_by("label", F.struct(first, "n", -F.col("label"))).alias("label"))
    unnamed = F.when(F.col("label") != 0, F.concat(F.lit("Label_"), F.col("label").cast("string")))
    if regions is None:
        return won.select(SUBJECT, "cluster_id", "cluster_size", unnamed.alias("region"))
    # a region dictionary has at most a few dozen rows
    named = won.join(F.broadcast(regions.select(F.col("region_label").alias("label"), "region")), "label", "left")
    return named.select(SUBJECT, "cluster_id", "cluster_size", F.coalesce("region", unnamed).alias("region"))


def _statistics() -> list[Column]:
    size = F.col("cluster_size")
    return [F.count(size).alias("n_clusters"), F.coalesce(F.sum(size), F.lit(0)).alias("total_vol"), F.avg(size).alias("mean_vol"),
            F.percentile(size, 0.5).alias("median_vol"), F.stddev_samp(size).alias("std_vol"),
            F.min(size).alias("min_vol"), F.max(size).alias("max_vol")]


def whole_brain_stats(census: DataFrame, subjects: DataFrame | None = None) -> DataFrame:
    """Statistics of all clusters of a subject; with ``subjects`` also of those without any cluster."""
    if subjects is None:
        return census.groupBy(SUBJECT).agg(*_statistics())
    counted = census.groupBy(SUBJECT).agg(*_statistics())
    return _fill_counts(subjects.select(SUBJECT).join(counted, SUBJECT, "left"))


def _fill_counts(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_clusters", "total_vol")})


def region_stats(census: DataFrame, regions: DataFrame, subjects: DataFrame) -> DataFrame:
    """Whole brain and every region of the dictionary per subject, empty regions included."""
    names = F.array_compact(F.array(F.lit(WHOLE_BRAIN), F.col("region")))
    stats = (census.select(SUBJECT, "cluster_size", F.explode(names).alias("region"))
             .groupBy(SUBJECT, "region").agg(*_statistics()))
    listed = [WHOLE_BRAIN] + [r.region for r in regions.orderBy("ord").collect()]  # a few dozen names
    cells = subjects.select(SUBJECT, F.explode(F.array(*map(F.lit, listed))).alias("region"))
    return _fill_counts(shuffled_join(cells, stats, [SUBJECT, "region"], "left"))


def region_metrics(prob: DataFrame, labels: DataFrame, biomarker: str, dims: Dims, threshold: float, min_size: int,
                   brain: DataFrame | None = None, subjects: DataFrame | None = None,
                   regions: DataFrame | None = None, parcellated: bool = False) -> tuple[DataFrame, DataFrame]:
    """Census and region statistics of a biomarker map: label clusters, name their regions, count per region.

    ``labels`` is the derived parcellation, which the biomarker's own scheme turns into regions, or with
    ``parcellated`` a label map that ``regions`` already names.
    """
    spark = prob.sparkSession
    clusters = label_clusters(prob, threshold, dims, min_size, brain)
    priority: list[int] = []
    if not parcellated:
        scheme = BIOMARKER_SCHEME[biomarker]
        labels, regions = parcellate(labels, scheme), region_dictionary(spark, scheme)
        wanted = PRIORITY_REGIONS.get(biomarker, [])
        priority = [r.region_label for r in regions.filter(F.col("region").isin(wanted)).collect()] if wanted else []
    found = assign_region(clusters, labels, regions, priority)
    if subjects is None:
        subjects = prob.select(SUBJECT).distinct()
    return found, region_stats(found, regions, subjects)


def wmh_ventricle_distance(prob: DataFrame, ventricles: DataFrame, dims: Dims, threshold: float = 0.2,
                           near: float = 2.0, subjects: DataFrame | None = None,
                           spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """Per cluster: size, distance range to the lateral ventricles, periventricular (within ``near``) or deep.

    Voxels at the threshold belong to a cluster. With ``subjects``, one empty row stands for a subject without clusters.
    """
    marked = label_components(prob.filter(F.col("v") >= threshold).select(*VOXEL), dims)
    marked = cut_lineage(marked)
    far = euclidean_distance(ventricles, dims, spacing, where=marked)
    d = F.col("d")
    found = (shuffled_join(marked, far, how="left").groupBy(SUBJECT, "cluster_id")
             .agg(F.count("*").alias("n_voxels"), F.max(d).alias("max_distance"), F.min(d).alias("min_distance")))
    found = found.withColumns({"pvwmh": (F.col("min_distance") <= near).cast("int"),
                               "dwmh": (F.col("min_distance") > near).cast("int")})
    if subjects is not None:
        found = subjects.select(SUBJECT).join(found, SUBJECT, "left")
    return found.withColumn("threshold", F.lit(threshold))


def wmh_totals(per_cluster: DataFrame) -> DataFrame:
    """Clusters and voxels near the ventricles and deep, per subject."""
    return per_cluster.groupBy(SUBJECT, "threshold").agg(
        F.coalesce(F.sum("pvwmh"), F.lit(0)).alias("n_clusters_pv"), F.coalesce(F.sum("dwmh"), F.lit(0)).alias("n_clusters_deep"),
        F.coalesce(F.sum(F.col("n_voxels") * F.col("pvwmh")), F.lit(0)).alias("n_voxels_pv"),
        F.coalesce(F.sum(F.col("n_voxels") * F.col("dwmh")), F.lit(0)).alias("n_voxels_deep"))


def pvs_bg_dwm(prob: DataFrame, basal_ganglia: DataFrame, dims: Dims, threshold: float, size_filter: int = 6,
               subjects: DataFrame | None = None) -> DataFrame:
    """Clusters and voxels in the basal ganglia and in deep white matter. Only deep clusters of up to ``size_filter``
    voxels are dropped; a tie between the two counts as deep."""
    marked = label_components(prob.filter(F.col("v") >= threshold).select(*VOXEL), dims)
    inside = basal_ganglia.select(*VOXEL).withColumn("_in", F.lit(1))
    each = (shuffled_join(marked, inside, how="left").groupBy(SUBJECT, "cluster_id")
            .agg(F.count("*").alias("n"), F.count("_in").alias("n_in")))
    bg = F.col("n_in") * 2 > F.col("n")
    dwm = ~bg & (F.col("n") > size_filter)
    out = each.groupBy(SUBJECT).agg(
        F.count_if(dwm).alias("dwm_clusters"), F.coalesce(F.sum(F.when(dwm, F.col("n"))), F.lit(0)).alias("dwm_voxels"),
        F.count_if(bg).alias("bg_clusters"), F.coalesce(F.sum(F.when(bg, F.col("n"))), F.lit(0)).alias("bg_voxels"))
    if subjects is not None:
        zero = F.lit(0).cast("long")
        out = subjects.select(SUBJECT).join(out, SUBJECT, "left").withColumns(
            {c: F.coalesce(c, zero) for c in out.columns if c != SUBJECT})
    return out.withColumns({"total_clusters": F.col("dwm_clusters") + F.col("bg_clusters"),
                            "total_voxels": F.col("dwm_voxels") + F.col("bg_voxels")})


def extreme_threshold(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Above this a value is extreme: the larger of Q3 + 3 IQR and the 95th percentile."""
    rows = staged(df.select(*keys, value), "sizes")  # the clusters are labelled once for all its reads
    q = exact_percentiles(rows, keys, value, [0.25, 0.75, 0.95])
    q1, q3, p95 = (F.col("q")[n] for n in range(3))
    return q.select(*keys, F.col("n").alias("n_clusters"), F.greatest(q3 + 3 * (q3 - q1), p95).alias("extreme_above"))


def census_plot_data(census: DataFrame, voxel_volume: float = 1.0, few: int = 10) -> DataFrame:
    """Cluster volumes with the two flags a size plot needs: extreme within its region, region with few clusters."""
    region = F.when(F.col("region").startswith("Label_"), F.lit("Other")).otherwise(F.col("region"))
    rows = staged(census.filter("region IS NOT NULL").select(
        SUBJECT, "cluster_id", region.alias("region"), (F.col("cluster_size") * F.lit(voxel_volume)).alias("volume_mm3")), "sizes")
    limits = extreme_threshold(rows, [SUBJECT, "region"], "volume_mm3")
    return (salted_join(rows, limits, [SUBJECT, "region"], salt_by=["cluster_id"], buckets=CLUSTER_SALT)
            .select(SUBJECT, "cluster_id", "region", "volume_mm3", (F.col("volume_mm3") > F.col("extreme_above")).alias("is_extreme"),
                    (F.col("n_clusters") < few).alias("few_clusters")))


