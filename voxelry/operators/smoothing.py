"""Smoothing and edges."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.joins import attach
from ..functions.offsets import neighbours
from ..schema import AXES, SUBJECT, VOXEL, Dims, in_grid, other_axes
from ..session import scatter, staged
from .blocks import fits
from .lines import Kernel, sweep, weighted_kernel
from .morphology import by_brick
from .stats import remove_dark_classes

#: Ratio of the wide to the narrow kernel of a difference of Gaussians.
WIDE_RATIO = 1.6


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    """Normalised weights for the distances 0..radius."""
    radius = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (n / sigma) ** 2) for n in range(radius + 1)]
    total = raw[0] + 2 * sum(raw[1:])
    return [w / total for w in raw]


def sigma_voxels(fwhm: float, size: float) -> float:
    """Standard deviation, in voxels of ``size`` millimetres, of a Gaussian of ``fwhm`` millimetres."""
    return fwhm / size / math.sqrt(8 * math.log(2))


def spaced_gaussian(fwhm: float) -> Kernel:
    """One pass of a Gaussian of ``fwhm`` millimetres over lines with a voxel size each."""
    def run(d: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        out = np.empty_like(d)
        for size in np.unique(sizes):
            out[sizes == size] = weighted_kernel(gaussian_weights(sigma_voxels(fwhm, float(size))), "symmetric")(d[sizes == size])
        return out
    return run


def gaussian_smooth(image: DataFrame, dims: Dims, fwhm: float, voxel_size: tuple[float, float, float] = (1.0, 1.0, 1.0),
                    grids: DataFrame | None = None) -> DataFrame:
    """Gaussian of ``fwhm`` millimetres, one pass per axis, borders mirrored about the voxel edge.

    With ``grids`` (subject_id, ni, nj, nk, vx, vy, vz) every scan is smoothed by its own voxel sizes and mirrored at the borders of its own grid, which lies
    inside of ``dims``; voxels beyond it are left out, and so are subjects it does not name.
    """
    rows = image.select(*VOXEL, F.when(F.isnan("v"), 0.0).otherwise(F.col("v")).alias("v"))
    if grids is None:
        return sweep(rows, dims, [weighted_kernel(gaussian_weights(sigma_voxels(fwhm, s)), "symmetric") for s in voxel_size], 0.0)
    lengths, sizes = ["_ni", "_nj", "_nk"], ["_vx", "_vy", "_vz"]
    own = grids.select(SUBJECT, *[F.least(F.col(c[1:]), F.lit(n)).cast("int").alias(c) for c, n in zip(lengths, dims)], *[F.col(c[1:]).cast("double").alias(c) for c in sizes])
    inside = attach(rows, own).filter(" AND ".join(f"{a} < {n}" for a, n in zip(AXES, lengths)))
    return sweep(inside, dims, [spaced_gaussian(fwhm)] * 3, 0.0, keys=(SUBJECT, *lengths, *sizes), own_lengths=lengths, own_spacings=sizes).select(*VOXEL, "v")


def fast_smooth(image: DataFrame, dims: Dims) -> DataFrame:
    """Weights 1 for the voxel and 0.2 for its six neighbours, divided by their sum of 2.2."""
    share = [((0, 0, 0), 1.0)] + [(o, 0.2) for o in neighbours(6)]
    taps = F.array(*[F.struct(*[F.lit(x).alias(f"d{a}") for a, x in zip(AXES, o)], F.lit(w).alias("w")) for o, w in share])
    rows = image.select(*VOXEL, "v")
    # small volumes stay whole from here on, in tasks of a bounded number of taps: no sum is shuffled, and no hash table grows with the cohort
    rows = scatter(staged(rows, "image"), SUBJECT, each=len(share)) if fits(dims) else by_brick(rows)
    rows = rows.withColumn("_o", F.explode(taps))
    moved = rows.select(SUBJECT, *[(F.col(a) + F.col(f"_o.d{a}")).alias(a) for a in AXES], (F.col("v") * F.col("_o.w")).alias("v"))
    return moved.filter(in_grid(dims)).groupBy(*VOXEL).agg((F.sum("v") / 2.2).alias("v"))


def difference_of_gaussians(image: DataFrame, dims: Dims, fwhm: float = 3.0,
                            voxel_size: tuple[float, float, float] = (1.0, 1.0, 1.0), grids: DataFrame | None = None) -> DataFrame:
    """Narrow minus wide smoothing, where the wide one continues the narrow one; ``grids`` as in ``gaussian_smooth``."""
    narrow = staged(gaussian_smooth(image, dims, fwhm, voxel_size, grids), "narrow")  # read by the wide one and by the difference
    wide = gaussian_smooth(narrow, dims, fwhm * math.sqrt(WIDE_RATIO ** 2 - 1), voxel_size, grids)
    both = narrow.unionByName(wide.withColumn("v", -F.col("v")))
    return both.groupBy(*VOXEL).agg(F.sum("v").alias("v"))


def inner_edges(mask: DataFrame, dims: Dims) -> DataFrame:
    """Mask voxels with a face neighbour that is in the grid but not in the mask."""
    rows = mask.select(*VOXEL).withColumn("_deep", F.lit(True))
    for axis, n in zip(AXES, dims):
        line, x = W.partitionBy(SUBJECT, *other_axes(axis)).orderBy(axis), F.col(axis)
        below = (x == 0) | F.coalesce(F.lag(x).over(line) == x - 1, F.lit(False))
        above = (x == n - 1) | F.coalesce(F.lead(x).over(line) == x + 1, F.lit(False))
        rows = rows.withColumn("_deep", F.col("_deep") & below & above)
    return rows.filter("NOT _deep").drop("_deep")


#: Dark classes that are removed, of how many, by level (fixed values): the higher the level, the more is kept.
DARK_CLASSES = {1: (3, 4), 2: (2, 3), 3: (1, 2), 4: (1, 3), 5: (1, 4)}


def dog_edges(image: DataFrame, mask: DataFrame, dims: Dims, fwhm: float = 3.0,
              voxel_size: tuple[float, float, float] = (1.0, 1.0, 1.0), level: int = 3, tiny: float = 1e-9) -> DataFrame:
    """One-voxel edges of an image: dark classes removed, difference of Gaussians, rim of its positive part.

    ``level`` names a row of ``DARK_CLASSES``, beyond its ends the nearest. Values up to ``tiny`` are rounding noise of the two sums and count as not positive.
    """
    row = min(DARK_CLASSES, key=lambda known: abs(known - level))
    bright = remove_dark_classes(image, mask, dims, *DARK_CLASSES[row])
    positive = difference_of_gaussians(bright, dims, fwhm, voxel_size).filter(F.col("v") > tiny)
    return inner_edges(positive, dims)
