"""Voxel-level aggregates: histograms, modes, volumes, centres, thresholds."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import attach
from ..schema import AXES, SUBJECT, Dims
from .voxel import apply_mask, normalisation_scale, scaled

#: Share of the histogram that is searched for the mode.
MODE_FROM, MODE_TO = 0.2, 0.9


def _bin(v: Column, bins: int) -> Column:
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.floor((v - F.col("lo")) / width)
    return F.when(F.col("hi") > F.col("lo"), F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1))).otherwise(F.lit(bins // 2)).cast("int")


def histogram(image: DataFrame, dims: Dims, bins: int = 64, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Counts of equal bins over the value range of the whole grid; absent voxels are zeros."""
    keys, size = list(keys), math.prod(dims)
    rows = image.select(*keys, "v", *[a for a in AXES if a not in keys])
    limits = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    sparse = F.col("_n") < size
    limits = limits.withColumns({"lo": F.when(sparse, F.least("lo", F.lit(0.0))).otherwise(F.col("lo")),
                                 "hi": F.when(sparse, F.greatest("hi", F.lit(0.0))).otherwise(F.col("hi"))})
    binned = attach(rows, limits, on=keys).groupBy(*keys, "lo", "hi", _bin(F.col("v"), bins).alias("bin")).agg(F.count("*").alias("_c"))
    zeros = limits.filter(sparse).select(*keys, "lo", "hi", _bin(F.lit(0.0), bins).alias("bin"), (F.lit(size) - F.col("_n")).alias("_c"))
    return binned.unionByName(zeros).groupBy(*keys, "lo", "hi", "bin").agg(F.sum("_c").alias("n"))


def histogram_mode(image: DataFrame, dims: Dims, bins: int = 64, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Left edge of the fullest bin in the middle part of the histogram (first one on ties)."""
    first, last = int(MODE_FROM * bins), int(MODE_TO * bins) - 1
    counts = histogram(image, dims, bins, keys)
    middle = F.col("bin").between(first, last)
    best = counts.groupBy(*keys, "lo", "hi").agg(
        F.max_by("bin", F.when(middle, F.struct("n", -F.col("bin")))).alias("_b"))
    edge = F.col("lo") + F.coalesce("_b", F.lit(first)) * (F.col("hi") - F.col("lo")) / bins
    return best.select(*keys, edge.alias("mode"))


def best_percentile(images: DataFrame, mask: DataFrame, percentiles: Sequence[float], cohort: DataFrame, dims: Dims,
                    bins: int = 64) -> DataFrame:
    """The normalisation percentile whose mean mode is nearest the mean mode of an already normalised cohort."""
    listed = F.array(*[F.lit(float(p)) for p in percentiles])
    scales = normalisation_scale(images, mask, percentiles).select(
        SUBJECT, F.arrays_zip(listed.alias("p"), F.col("scale").alias("s")).alias("_ps"))
    rows = attach(images.select(SUBJECT, *AXES, "v"), scales).withColumn("_z", F.explode("_ps"))
    tried = rows.select(SUBJECT, F.col("_z.p").alias("percentile"), *AXES,
                        scaled(F.greatest("v", F.lit(0.0)), F.col("_z.s")).alias("v"))
    modes = histogram_mode(tried, dims, bins, [SUBJECT, "percentile"]).groupBy("percentile").agg(F.avg("mode").alias("m"))
    wanted = histogram_mode(cohort, dims, bins).agg(F.avg("mode").alias("cohort_mode"))
    # one row per percentile against one row
    scored = modes.join(F.broadcast(wanted), how="cross")
    return scored.agg(F.min_by("percentile", F.struct(F.abs(F.round(F.col("m") - F.col("cohort_mode"), 9)), "percentile")).alias("percentile"),
                      F.min(F.abs(F.col("m") - F.col("cohort_mode"))).alias("distance"))


def brain_volume(mask: DataFrame, images: DataFrame) -> DataFrame:
    """Voxel count and volume in cubic centimetres."""
    counts = mask.groupBy(SUBJECT).agg(F.count("*").alias("brain_mask_size"))
    cm3 = F.col("brain_mask_size") * F.col("vx") * F.col("vy") * F.col("vz") / 1000
    return counts.join(images.select(SUBJECT, "vx", "vy", "vz"), SUBJECT).select(SUBJECT, "brain_mask_size", cm3.alias("brain_volume_cm3"))


def centre_of_mass(voxels: DataFrame, weighted: bool = False) -> DataFrame:
    """Mean coordinate per axis, of the present voxels or weighted by ``v``."""
    def centre(a: str) -> Column:
        return F.sum(F.col(a) * F.col("v")) / F.sum("v") if weighted else F.avg(a)
    return voxels.groupBy(SUBJECT).agg(*[centre(a).alias(f"c{a}") for a in AXES])


def salient_slices(voxels: DataFrame) -> DataFrame:
    """Per axis the slice with the most voxels above zero (lowest one on ties)."""
    rows = (voxels.filter("v > 0").select(SUBJECT, F.explode(F.array(*[
        F.struct(F.lit(a).alias("axis"), F.col(a).alias("slice")) for a in AXES])).alias("_s"))
        .groupBy(SUBJECT, "_s.axis", "_s.slice").agg(F.count("*").alias("n")))
    return rows.groupBy(SUBJECT, "axis").agg(F.max_by("slice", F.struct("n", -F.col("slice"))).alias("slice"))


def otsu_threshold(image: DataFrame, dims: Dims, classes: int = 2, bins: int = 256) -> DataFrame:
    """Thresholds that maximise the between-class variance: ``thresholds`` holds the bin centres that close each class.

    Works on one short histogram array per subject: for every number of classes the best split that ends in a bin is
    found from the best splits with one class less.
    """
    if not 2 <= classes <= 5:
        raise ValueError("between 2 and 5 classes")
    counts = histogram(image, dims, bins)
    packed = counts.groupBy(SUBJECT, "lo", "hi").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_m"))
    idx = F.sequence(F.lit(0), F.lit(bins - 1))
    weights = packed.withColumn("_w", F.transform(idx, lambda b: F.coalesce(F.col("_m")[b], F.lit(0)).cast("double")))

    def cumulative(term):
        start = F.array().cast("array<double>")
        return F.aggregate(idx, start, lambda acc, b: F.concat(acc, F.array(
            F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + term(b))))

    sums = (weights.withColumn("_p", cumulative(lambda b: F.get("_w", b)))
            .withColumn("_s", cumulative(lambda b: F.get("_w", b) * b)))

    def gain(after, upto):
        """Squared mass over count of the class made of bins after+1..upto."""
        p = F.get("_p", upto) - F.when(after < 0, F.lit(0.0)).otherwise(F.get("_p", after))
        s = F.get("_s", upto) - F.when(after < 0, F.lit(0.0)).otherwise(F.get("_s", after))
        return F.when(p > 0, s * s / p).otherwise(F.lit(0.0))

    # a state is (score, negated cut bins), so the maximum prefers the lowest cuts on ties
    none = F.array().cast("array<int>")
    sums = sums.withColumn("_best", F.transform(idx, lambda t: F.struct(gain(F.lit(-1), t).alias("score"), none.alias("cuts"))))
    for _ in range(classes - 2):
        sums = sums.withColumn("_best", F.transform(idx, lambda t: _extend(t, gain)))
    last = F.lit(bins - 1)
    final = sums.withColumn("_z", _extend(last, gain))
    width = (F.col("hi") - F.col("lo")) / bins
    return final.select(SUBJECT, F.transform("_z.cuts", lambda c: F.col("lo") + (F.lit(0.5) - c) * width).alias("thresholds"))


def _extend(t: Column, gain) -> Column:
    """Best way to close a class at bin ``t`` after any earlier bin."""
    before = F.filter(F.sequence(F.lit(-1), t - 1), lambda s: s >= 0)
    options = F.transform(before, lambda s: F.struct(
        (F.get("_best", s)["score"] + gain(s, t)).alias("score"),
        F.concat(F.get("_best", s)["cuts"], F.array(-s)).alias("cuts")))
    return F.coalesce(F.array_max(options), F.struct(F.lit(-1.0).alias("score"), F.array().cast("array<int>").alias("cuts")))


def remove_dark_classes(image: DataFrame, mask: DataFrame, dims: Dims, dark: int = 1, classes: int = 2) -> DataFrame:
    """Zero the ``dark`` darkest of ``classes`` classes of intensity of a masked image."""
    inside = apply_mask(image, mask)
    cut = otsu_threshold(inside, dims, classes).select(SUBJECT, F.col("thresholds")[dark - 1].alias("_t"))
    return attach(inside, cut).filter(F.col("v") >= F.col("_t")).select(*inside.columns)
