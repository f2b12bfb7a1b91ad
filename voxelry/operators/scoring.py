"""Agreement of predicted and true segmentations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import shuffled_join
from ..functions.quantiles import exact_percentiles
from ..schema import AXES, SUBJECT, Dims
from ..session import cut_lineage
from .components import attach_to_clusters, census, component_chains, label_components
from .morphology import euclidean_distance, surface

KEYS = (SUBJECT,)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def _voxel_measures() -> dict[str, Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    nothing = (tp == 0) & (fp == 0) & (fn == 0)
    rate = {"sensitivity": _ratio(tp, tp + fn), "precision": _ratio(tp, tp + fp), "f1": _ratio(2 * tp, 2 * tp + fp + fn)}
    return {n: F.when(nothing, 1.0).otherwise(c) for n, c in rate.items()}


def voxel_scores(truth: DataFrame, predicted: DataFrame, keys: Sequence[str] = KEYS, subjects: DataFrame | None = None) -> DataFrame:
    """True and false positives, false negatives and derived rates, voxel by voxel, of two masks."""
    keys = list(keys)
    t = truth.select(*keys, *AXES).withColumn("_t", F.lit(1))
    p = predicted.select(*keys, *AXES).withColumn("_p", F.lit(1))
    hit, missed = F.col("_t").isNotNull(), F.col("_p").isNull()
    counts = t.join(p, [*keys, *AXES], "full_outer").groupBy(*keys).agg(
        F.count_if(hit & ~missed).alias("tp"), F.count_if(~hit).alias("fp"), F.count_if(missed).alias("fn"))
    if subjects is not None:
        counts = _with_subjects(counts, subjects, keys)
    return counts.withColumns(_voxel_measures())


def _with_subjects(counts: DataFrame, subjects: DataFrame, keys: list[str]) -> DataFrame:
    zero = F.lit(0).cast("long")
    return subjects.select(*keys).join(counts, keys, "left").withColumns(
        {c: F.coalesce(c, zero) for c in counts.columns if c not in keys})


def overlaps(truth: DataFrame, predicted: DataFrame, dims: Dims, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per pair of overlapping true and predicted clusters (either may be missing): ids, sizes, shared voxels."""
    return pair_up(sized_clusters(truth, dims, keys, "t"), sized_clusters(predicted, dims, keys, "p"), keys)


def sized_clusters(mask: DataFrame, dims: Dims, keys: Sequence[str], name: str) -> DataFrame:
    """Voxels of a mask with ``<name>_id`` and ``<name>_size`` of their cluster."""
    keys = list(keys)
    marked = cut_lineage(label_components(mask.select(*keys, *AXES), dims, by=keys))
    sized = attach_to_clusters(marked, census(marked, keys), keys)
    return sized.select(*keys, *AXES, F.col("cluster_id").alias(f"{name}_id"), F.col("cluster_size").alias(f"{name}_size"))


def pair_up(truth: DataFrame, predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (truth.join(predicted, [*keys, *AXES], "full_outer")
            .groupBy(*keys, "t_id", "t_size", "p_id", "p_size").agg(F.count("*").alias("n")))


def score_overlaps(pairs: DataFrame, size_filters: Sequence[int], keys: Sequence[str] = KEYS) -> DataFrame:
    """Voxel and cluster scores for every size filter (clusters of up to that size are ignored), in long rows.

    Everything is counted on the table of cluster pairs, so filters multiply clusters and not voxels. A true cluster
    counts as found for the sensitivity if any predicted voxel touches it, and for the precision if a predicted
    cluster that passed the filter does; a predicted cluster is false if it touches no true voxel.
    """
    keys = [*keys, "cluster_filter"]
    rows = pairs.withColumn("cluster_filter", F.explode(F.array(*map(F.lit, size_filters))))
    t_ok = F.coalesce(F.col("t_size") > F.col("cluster_filter"), F.lit(False))
    p_ok = F.coalesce(F.col("p_size") > F.col("cluster_filter"), F.lit(False))
    rows = rows.withColumns({"t_ok": t_ok, "p_ok": p_ok})
    zero = F.lit(0).cast("long")
    voxel = rows.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), zero).alias(n) for n, c in (
        ("tp", F.expr("t_ok AND p_ok")), ("fp", F.expr("NOT t_ok AND p_ok")), ("fn", F.expr("t_ok AND NOT p_ok")))])
    voxel = voxel.withColumns(_voxel_measures()).withColumn("output_type", F.lit("Voxel"))
    by_truth = (rows.filter("t_id IS NOT NULL").groupBy(*keys, "t_id")
                .agg(F.first("t_ok").alias("ok"), F.max(F.col("p_id").isNotNull()).alias("any_p"), F.max("p_ok").alias("kept_p"))
                .groupBy(*keys).agg(F.count_if("ok").alias("_true"), F.count_if(F.expr("ok AND any_p")).alias("tp"),
                                    F.count_if("kept_p").alias("tp2")))
    by_pred = (rows.filter("p_id IS NOT NULL").groupBy(*keys, "p_id")
               .agg(F.first("p_ok").alias("ok"), F.max(F.col("t_id").isNotNull()).alias("any_t"))
               .groupBy(*keys).agg(F.count_if(F.expr("ok AND NOT any_t")).alias("fp")))
    cluster = by_truth.join(by_pred, keys, "full_outer").select(*keys, *[F.coalesce(c, zero).alias(c) for c in ("_true", "tp", "tp2", "fp")])
    cluster = cluster.withColumn("fn", F.col("_true") - F.col("tp"))
    # a side without a hit is perfect if nothing was missed and nothing was invented, whatever the other side found
    flawless = F.when(F.expr("fn = 0 AND fp = 0"), 1.0).otherwise(0.0)
    cluster = cluster.withColumns({
        "sensitivity": F.when(F.col("tp") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(flawless),
        "precision": F.when(F.col("tp2") > 0, F.col("tp2") / (F.col("tp2") + F.col("fp"))).otherwise(flawless)})
    both = F.col("sensitivity") + F.col("precision")
    cluster = cluster.withColumns({"f1": _ratio(2 * F.col("sensitivity") * F.col("precision"), both), "output_type": F.lit("Cluster")})
    out = [*keys, "output_type", "sensitivity", "precision", "f1", "tp", "fp", "fn"]
    return voxel.select(*out).unionByName(cluster.select(*out))


def cluster_scores(truth: DataFrame, predicted: DataFrame, dims: Dims, size_filter: int = 0, keys: Sequence[str] = KEYS) -> DataFrame:
    scores = score_overlaps(overlaps(truth, predicted, dims, keys), [size_filter], keys)
    return scores.filter("output_type = 'Cluster'").drop("output_type", "cluster_filter")


def score_sweep(truth: DataFrame, prob: DataFrame, dims: Dims, thresholds: Sequence[float], size_filters: Sequence[int]) -> DataFrame:
    """Scores for every threshold, size filter and subject.

    Truth and prediction are labelled once each: the prediction by a tree of components whose cuts are the thresholds (``component_chains``). Voxels of one true
    cluster and one path through the tree are counted together, and only these counts are repeated for every threshold.
    """
    cuts = sorted(set(map(float, thresholds)))
    level = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: F.col("v") > x))
    chains, stars = component_chains(prob.select(SUBJECT, *AXES, level.alias("level")).filter("level > 0"), dims)
    t = sized_clusters(truth, dims, KEYS, "t")
    # the leaf of a path and its level name the whole path
    leaves = (t.join(chains, [SUBJECT, *AXES], "full_outer").withColumn("leaf", F.element_at("chain", -1))
              .groupBy(SUBJECT, "t_id", "t_size", "level", "leaf").agg(F.count("*").alias("n"), F.first("chain").alias("chain")))
    numbers = F.array(*[F.struct(F.lit(c).alias("threshold"), F.lit(k + 1).cast("long").alias("level")) for k, c in enumerate(cuts)])
    rows = (leaves.withColumn("_t", F.explode(numbers))
            .select(SUBJECT, "t_id", "t_size", "n", "_t.threshold", F.col("_t.level").alias("level"), F.get("chain", (F.col("_t.level") - 1).cast("int")).alias("part")))
    rows = rows.filter("t_id IS NOT NULL OR part IS NOT NULL")
    if stars is not None:
        rows = shuffled_join(rows, stars.select(SUBJECT, "level", F.col("u").alias("part"), F.col("v").alias("_root")), [SUBJECT, "level", "part"], "left").withColumn("part", F.coalesce("_root", "part"))
    keys = [SUBJECT, "threshold"]
    pairs = cut_lineage(rows.groupBy(*keys, "t_id", "t_size", F.col("part").alias("p_id")).agg(F.sum("n").alias("n")))
    sizes = pairs.filter("p_id IS NOT NULL").groupBy(*keys, "p_id").agg(F.sum("n").alias("p_size"))
    return score_overlaps(shuffled_join(pairs, sizes, [*keys, "p_id"], "left"), size_filters, keys)


def hd95(truth: DataFrame, predicted: DataFrame, dims: Dims, size_filter: int = 0,
         spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """95th percentile of the distances between the surfaces of true-positive clusters, both directions together."""
    sides = {}
    for name, mask in (("t", truth), ("p", predicted)):
        marked = cut_lineage(label_components(mask.select(SUBJECT, *AXES), dims))
        if size_filter:
            kept = census(marked).filter(F.col("cluster_size") > size_filter)
            marked = cut_lineage(attach_to_clusters(marked, kept))
        sides[name] = marked
    cells = [SUBJECT, *AXES]
    found = []
    for name, other in (("t", "p"), ("p", "t")):
        own = sides[name]
        touched = shuffled_join(own, sides[other].select(*cells), cells, "left_semi").select(SUBJECT, "cluster_id").distinct()
        found.append(attach_to_clusters(own, touched).select(*cells).withColumn("side", F.lit(name)))
    rims = cut_lineage(surface(found[0].unionByName(found[1]), (SUBJECT, "side")))
    # how far the voxels of one side's surface are from the other side's
    asked = cut_lineage(rims.withColumn("side", F.when(F.col("side") == "t", "p").otherwise("t")))
    gaps = cut_lineage(euclidean_distance(rims, dims, spacing, keys=(SUBJECT, "side"), where=asked).select(SUBJECT, "d"))
    return (exact_percentiles(gaps, [SUBJECT], "d", [0.95])
            .select(SUBJECT, F.col("q")[0].alias("hd95")))
