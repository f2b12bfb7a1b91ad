"""Projections, filters and boxes on voxel tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import permutations, product

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import matrix
from ..functions.joins import attach, shuffled_join
from ..functions.quantiles import exact_percentiles
from ..schema import AXES, SUBJECT, VOXEL, Dims, in_grid
from ..session import scatter, staged

#: Label lists longer than this are joined instead of written into the predicate.
MAX_LITERALS = 200

#: Ceiling of a normalised intensity, in units of the reference percentile.
CEILING = 1.3


def threshold(df: DataFrame, level: float, sign: str = "+", binarise: bool = False) -> DataFrame:
    """Keep voxels on one side of ``level`` (inclusive), or mark those strictly beyond it with 1."""
    if sign not in ("+", "-"):
        raise ValueError(f"sign has to be + or -, not {sign!r}")
    v = F.col("v")
    if binarise:
        return df.filter(v > level if sign == "+" else v < level).withColumn("v", F.lit(1.0))
    return df.filter(v >= level if sign == "+" else v <= level)


def apply_mask(df: DataFrame, mask: DataFrame) -> DataFrame:
    return shuffled_join(df, mask.select(*VOXEL), how="left_semi")


def outside_mask(df: DataFrame, mask: DataFrame) -> DataFrame:
    return shuffled_join(df, mask.select(*VOXEL), how="left_anti")


def apply_weights(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Multiply by a weighted mask (absent weight = 0)."""
    w = weights.select(*VOXEL, F.col("v").alias("_w"))
    return shuffled_join(df, w).withColumn("v", F.col("v") * F.col("_w")).drop("_w").filter("v <> 0")


def union_masks(*masks: DataFrame) -> DataFrame:
    out = masks[0].select(*VOXEL)
    for m in masks[1:]:
        out = out.unionByName(m.select(*VOXEL))
    return out.distinct()


def label_in(labels: DataFrame, values: int | Sequence[int]) -> DataFrame:
    """Voxels whose label is one of ``values``."""
    values = [values] if isinstance(values, int) else list(values)
    if len(values) <= MAX_LITERALS:
        return labels.filter(F.col("label").isin(values))
    wanted = labels.sparkSession.createDataFrame([(v,) for v in values], "label int").distinct()
    return labels.join(wanted, "label", "left_semi").select(*labels.columns)


def _in_mask_values(image: DataFrame, mask: DataFrame) -> DataFrame:
    clean = F.greatest(F.nanvl(F.coalesce("v", F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    marked = mask.select(*VOXEL).withColumn("_m", F.lit(1))
    return (image.select(*VOXEL, "v").join(marked, list(VOXEL), "full_outer")
            .select(*VOXEL, clean.alias("v"), F.col("_m").isNotNull().alias("in_mask")))


def normalisation_scale(image: DataFrame, mask: DataFrame, percentiles: Sequence[float] = (99.0,)) -> DataFrame:
    """In-mask percentiles per subject; a zero percentile is NULL with a status, because nothing can be divided by it."""
    return _scale(staged(_in_mask_values(image, mask), "in-mask"), percentiles)


def _scale(values: DataFrame, percentiles: Sequence[float]) -> DataFrame:
    rows = values.filter("in_mask")
    q = exact_percentiles(rows, [SUBJECT], "v", [p / 100.0 for p in percentiles])
    scale = F.transform("q", lambda x: F.nullif(x, F.lit(0.0)))
    return q.select(SUBJECT, scale.alias("scale"),
                    F.when(F.exists("q", lambda x: x == 0), "zero percentile").otherwise("ok").alias("status"))


def scaled(v: Column, scale: Column) -> Column:
    return F.least(v / scale, F.lit(CEILING)) / CEILING


def normalise(image: DataFrame, mask: DataFrame, percentile: float = 99.0, inverse: bool = False) -> DataFrame:
    """Intensities in [0, 1]: negative and missing values are 0, the in-mask percentile is the unit, the ceiling is
    1.3 units. With ``inverse`` in-mask values become 1 - v. Only non-zero rows are returned, and NULL for the zeros of a mask whose percentile is zero."""
    values = staged(_in_mask_values(image, mask), "in-mask")  # the join of voxels is made once, for the sketch, the ranking and the result
    per_subject = _scale(values, [percentile]).select(SUBJECT, F.col("scale")[0].alias("_p"))
    rows = attach(values, per_subject)
    # with a zero percentile what is above it is at the ceiling, and zero itself undefined
    value = F.when(F.col("_p").isNotNull() | (F.col("v") > 0), scaled(F.col("v"), F.col("_p")))
    if inverse:
        value = F.when(F.col("in_mask"), 1 - value).otherwise(value)
    return rows.select(*VOXEL, value.alias("v")).filter("v IS NULL OR v <> 0")


def drop_near_zero(df: DataFrame, level: float = 0.001) -> DataFrame:
    return df.filter(F.col("v") >= level)


def value_range(df: DataFrame, dims: Dims, grids: DataFrame | None = None) -> DataFrame:
    """Minimum and maximum per subject; absent voxels of its grid (``dims``, or its own in ``grids``: subject_id, ni, nj, nk) count as zero."""
    found = df.groupBy(SUBJECT).agg(F.count("*").alias("_n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    size = F.lit(math.prod(dims))
    if grids is not None:
        found = found.join(grids.select(SUBJECT, (F.col("ni").cast("long") * F.col("nj") * F.col("nk")).alias("_size")), SUBJECT)
        size = F.col("_size")
    full, zero = F.col("_n") >= size, F.lit(0.0)
    return found.select(SUBJECT, F.when(full, F.col("lo")).otherwise(F.least("lo", zero)).alias("lo"),
                        F.when(full, F.col("hi")).otherwise(F.greatest("hi", zero)).alias("hi"))


def clamp_to_source_range(df: DataFrame, source: DataFrame, dims: Dims, grids: DataFrame | None = None) -> DataFrame:
    rows = attach(df, value_range(source, dims, grids))
    return (rows.withColumn("v", F.least(F.greatest("v", "lo"), "hi")).select(*df.columns).filter("v <> 0"))


def binarise_clusters(clusters: DataFrame) -> DataFrame:
    return clusters.select(*VOXEL, F.lit(1).alias("v"))


# Axis letters of the world directions: positive and negative end of each axis (fixed values).
WORLD_AXES = (("R", "L"), ("A", "P"), ("S", "I"))


def orientation_codes() -> list[str]:
    """The 48 axis codes: every order of the three axes with every choice of ends."""
    return ["".join(c) for order in permutations(WORLD_AXES) for c in product(*order)]


def _axis_moves(orient: Column, target: str) -> list[tuple[Column, Column]]:
    """Per target axis: 0-based source axis and whether it is flipped."""
    moves = []
    for letter in target:
        pair = next(p for p in WORLD_AXES if letter in p)
        other = pair[1] if letter == pair[0] else pair[0]
        same = F.locate(letter, orient)
        moves.append((F.greatest(same, F.locate(other, orient)) - 1, same == 0))
    return moves


def reorient(voxels: DataFrame, images: DataFrame, target: str = "RAS") -> DataFrame:
    """Permute and flip the axes of each subject's volume from ``images.orient`` to ``target``."""
    header = images.select(SUBJECT, "orient", F.array("ni", "nj", "nk").alias("_n"))
    rows = attach(voxels, header).withColumn("_c", F.array(*AXES))
    out = []
    for axis, (source, flipped) in zip(AXES, _axis_moves(F.col("orient"), target)):
        at = F.get("_c", source)
        out.append(F.when(flipped, F.get("_n", source) - 1 - at).otherwise(at).alias(axis))
    rest = [c for c in voxels.columns if c not in AXES]
    return rows.select(*out, *rest).select(*voxels.columns)


def reorient_images(images: DataFrame, target: str = "RAS") -> DataFrame:
    """Header after :func:`reorient`: new dims, voxel sizes, orientation and affine."""
    n, s = F.array("ni", "nj", "nk"), F.array("vx", "vy", "vz")
    moves = _axis_moves(F.col("orient"), target)
    a = matrix.cells(F.col("affine"), 4)
    rows = []
    for r in range(3):
        cols, shift = [], a[r][3]
        for source, flipped in moves:
            step = F.get("affine", source + 4 * r)
            cols.append(F.when(flipped, -step).otherwise(step))
            shift = shift + F.when(flipped, step * (F.get(n, source) - 1)).otherwise(F.lit(0.0))
        rows.append([*cols, shift])
    rows.append([F.lit(0.0)] * 3 + [F.lit(1.0)])
    changed = {name: F.get(n, m[0]) for name, m in zip(("ni", "nj", "nk"), moves)}
    changed |= {name: F.get(s, m[0]) for name, m in zip(("vx", "vy", "vz"), moves)}
    return images.withColumns({**changed, "affine": matrix.pack(rows), "orient": F.lit(target)})


def crop_box(images: DataFrame, dimensions: Dims, mask: DataFrame | None = None, centre: str = "mask",
             given: DataFrame | None = None, margin: int = 5) -> DataFrame:
    """Crop box per subject: centre ``ci cj ck``, unclamped corners ``i0..k0`` and ``i1..k1``, affine of the crop.

    ``centre`` is ``mask`` (centre of mass, rounded up), ``grid``, ``world`` (origin of the scanner space) or ``given``
    (a table with ci, cj, ck). When the top of the mask would be cut off, the box moves up past it by ``margin``.
    """
    halves = [d // 2 for d in dimensions]
    head = images.select(SUBJECT, "ni", "nj", "nk", "affine")
    names = ("ci", "cj", "ck")
    if centre == "mask":
        mass = mask.groupBy(SUBJECT).agg(*[F.ceil(F.avg(a)).cast("int").alias(c) for a, c in zip(AXES, names)],
                                         F.max("k").alias("_top"))
        box = head.join(mass, SUBJECT)
    elif centre == "given":
        box = head.join(given.select(SUBJECT, *names), SUBJECT)
    elif centre == "grid":
        box = head.withColumns({c: F.ceil(F.col(n) / 2).cast("int") for c, n in zip(names, ("ni", "nj", "nk"))})
    elif centre == "world":
        box = head.withColumn("_at", matrix.origin_voxel(F.col("affine"))).withColumns(
            {c: F.ceil(F.col("_at")[t]).cast("int") for t, c in enumerate(names)})
    else:
        raise ValueError(centre)
    if centre != "mask" and mask is not None:
        box = box.join(mask.groupBy(SUBJECT).agg(F.max("k").alias("_top")), SUBJECT, "left")
    if mask is not None:
        end = F.least(F.col("ck") + halves[2], F.col("nk"))
        box = box.withColumn("ck", F.col("ck") + F.when(end <= F.col("_top"), F.col("_top") - end + margin).otherwise(0))
    corners = {f"{a}0": F.col(f"c{a}") - h for a, h in zip(AXES, halves)}
    corners |= {f"{a}1": F.col(f"c{a}") + h for a, h in zip(AXES, halves)}
    box = box.withColumns(corners)
    a = matrix.cells(F.col("affine"), 4)
    moved = [[*a[r][:3], a[r][0] * F.col("i0") + a[r][1] * F.col("j0") + a[r][2] * F.col("k0") + a[r][3]] for r in range(3)]
    return box.select(SUBJECT, *names, "i0", "j0", "k0", "i1", "j1", "k1", matrix.pack([*moved, a[3]]).alias("affine"))


def crop_voxels(voxels: DataFrame, box: DataFrame) -> DataFrame:
    corners = box.select(SUBJECT, "i0", "j0", "k0", "i1", "j1", "k1")
    rows = attach(voxels, corners).filter(" AND ".join(f"{a} >= {a}0 AND {a} < {a}1" for a in AXES))
    return rows.withColumns({a: F.col(a) - F.col(f"{a}0") for a in AXES}).select(*voxels.columns)


def uncrop_voxels(voxels: DataFrame, box: DataFrame, images: DataFrame) -> DataFrame:
    """Put a cropped volume back into its original grid; what lies outside that grid is dropped."""
    place = box.select(SUBJECT, "i0", "j0", "k0").join(images.select(SUBJECT, "ni", "nj", "nk"), SUBJECT)
    rows = attach(voxels, place).withColumns({a: F.col(a) + F.col(f"{a}0") for a in AXES})
    return rows.filter(" AND ".join(f"{a} >= 0 AND {a} < n{a}" for a in AXES)).select(*voxels.columns)


def _drawn_offset(axis: str, seed: int) -> Column:
    return (F.pmod(F.xxhash64(F.col(SUBJECT), F.lit(seed), F.lit(axis)), F.lit(7)) - 3).cast("int")


def shift_volume(voxels: DataFrame, dims: Dims, offset: tuple[int, int, int] | None = None, seed: int = 0) -> DataFrame:
    """Translate by whole voxels; without an offset each axis moves by a reproducible draw from -3..3 per subject."""
    moves = [F.lit(o) for o in offset] if offset else [_drawn_offset(a, seed) for a in AXES]
    return voxels.withColumns({a: F.col(a) + m for a, m in zip(AXES, moves)}).filter(in_grid(dims))


def shift_affine(images: DataFrame, offset: tuple[int, int, int] | None = None, seed: int = 0) -> DataFrame:
    """Move the image by changing its affine only: the origin goes back by the offset, the voxels stay."""
    moves = [F.lit(o) for o in offset] if offset else [_drawn_offset(a, seed) for a in AXES]
    a = matrix.cells(F.col("affine"), 4)
    rows = [[*a[r][:3], a[r][3] - (a[r][0] * moves[0] + a[r][1] * moves[1] + a[r][2] * moves[2])] for r in range(3)]
    return images.withColumn("affine", matrix.pack([*rows, a[3]]))


def bounding_box(mask: DataFrame, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Smallest and largest coordinate per axis (``k1`` is the topmost slice)."""
    return mask.groupBy(*keys).agg(*[f(a).alias(f"{a}{n}") for n, f in ((0, F.min), (1, F.max)) for a in AXES])


def crop_to_mask_box(voxels: DataFrame, mask: DataFrame) -> DataFrame:
    """Voxels inside the bounding box of a mask, both ends included, counted from its corner."""
    rows = attach(voxels, bounding_box(mask)).filter(" AND ".join(f"{a} BETWEEN {a}0 AND {a}1" for a in AXES))
    return rows.withColumns({a: F.col(a) - F.col(f"{a}0") for a in AXES}).select(*voxels.columns)


def register_clusters(clusters: DataFrame, transforms: DataFrame, dims: Dims, label: str = "cluster_id") -> DataFrame:
    """Move labelled voxels through ``transforms.affine`` (source to target voxels); round, clamp to the grid, and let
    the largest label win where two meet."""
    rows = attach(clusters, transforms.select(SUBJECT, F.col("affine").alias("_a")))
    moved = matrix.apply_affine(F.col("_a"), [F.col(a) for a in AXES])
    target = {a: F.least(F.greatest(F.rint(m), F.lit(0.0)), F.lit(n - 1.0)).cast("int")
              for a, m, n in zip(AXES, moved, dims)}
    return rows.withColumns(target).groupBy(*VOXEL).agg(F.max(label).alias(label))


def voxel_size_policy(images: DataFrame, target: tuple[float, float, float], dims: Dims, tolerance: float = 0.0,
                      adapt_dims: bool = False) -> DataFrame:
    """Voxel size, grid and interpolation order of a conformed scan: an axis within the tolerance keeps its own size,
    and a scan that keeps all three needs no interpolation."""
    sizes, native, grid = ("vx", "vy", "vz"), ("ni", "nj", "nk"), ("oi", "oj", "ok")
    kept = {s: F.abs(F.col(s) - t) <= tolerance for s, t in zip(sizes, target)}
    out = {f"out_{s}": F.when(kept[s], F.col(s)).otherwise(F.lit(t)) for s, t in zip(sizes, target)}
    for o, s, t, d in zip(grid, sizes, target, dims):
        out[o] = F.when(kept[s], F.ceil(F.lit(d * t) / F.col(s)).cast("int")).otherwise(d) if adapt_dims else F.lit(d)
    all_kept = kept["vx"] & kept["vy"] & kept["vz"]
    out["interpolation_order"] = F.when(all_kept, F.lit(0)).otherwise(3)
    return images.select(SUBJECT, *native, *sizes, *[c.alias(n) for n, c in out.items()])


def slice_indices(length: int, n: int) -> list[int]:
    """``n`` evenly spaced slices of an axis after a border of a tenth on both sides."""
    border, step = math.ceil(0.1 * length), 0.8 * length / n
    count = math.ceil((length - 2 * border) / step)
    return [int(border + t * step) for t in range(count)]


def qc_slices(image: DataFrame, mask: DataFrame, dims: Dims, n: int = 12, axes: Sequence[str] = ("k",)) -> DataFrame:
    """Pixels of evenly spaced slices: value and mask flag, one row per (axis, slice, pixel)."""
    wanted = [F.when(F.col(a).isin(slice_indices(dims[AXES.index(a)], n)), F.lit(a)) for a in axes]
    marked = mask.select(*VOXEL).withColumn("_m", F.lit(1))
    on_slice = F.array_compact(F.array(*wanted))
    rows = (image.select(*VOXEL, "v").filter(F.size(on_slice) > 0)
            .join(marked.filter(F.size(on_slice) > 0), list(VOXEL), "full_outer").withColumn("axis", F.explode(on_slice)))
    at = F.coalesce(*[F.when(F.col("axis") == a, F.col(a)) for a in AXES])
    return rows.select(*VOXEL, "axis", at.alias("slice"), F.coalesce("v", F.lit(0.0)).alias("v"),
                       F.coalesce("_m", F.lit(0)).alias("in_mask"))


def crop_box_slices(image: DataFrame, mask: DataFrame, box: DataFrame) -> DataFrame:
    """The three slices through the crop centre with mask and in-box flags."""
    marked = mask.select(*VOXEL).withColumn("_m", F.lit(1))
    both = image.select(*VOXEL, "v").join(marked, list(VOXEL), "full_outer")
    rows = attach(both, box.drop("affine")).filter("i = ci OR j = cj OR k = ck")
    inside = F.expr(" AND ".join(f"{a} >= {a}0 AND {a} < {a}1" for a in AXES))
    return rows.select(*VOXEL, F.coalesce("v", F.lit(0.0)).alias("v"), F.coalesce("_m", F.lit(0)).alias("in_mask"),
                       inside.cast("int").alias("in_box"))


def stack_channels(channels: Sequence[DataFrame]) -> DataFrame:
    """Voxels of several aligned images side by side as ``c1``, ``c2``, …; absent is zero."""
    out = channels[0].select(*VOXEL, F.col("v").alias("c1"))
    for n, channel in enumerate(channels[1:], start=2):
        out = out.join(channel.select(*VOXEL, F.col("v").alias(f"c{n}")), list(VOXEL), "full_outer")
    return out.select(*VOXEL, *[F.coalesce(f"c{n}", F.lit(0.0)).alias(f"c{n}") for n in range(1, len(channels) + 1)])


def shape_mismatch(images: DataFrame) -> DataFrame:
    """Subjects whose scans do not share one grid."""
    return (images.groupBy(SUBJECT).agg(F.collect_set(F.struct("ni", "nj", "nk")).alias("shapes"))
            .filter(F.size("shapes") > 1))


def dense_grid(subjects: DataFrame, dims: Dims) -> DataFrame:
    """Every voxel of the grid for every subject."""
    ni, nj, nk = dims
    slabs = subjects.select(SUBJECT).distinct().withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(ni - 1))))
    return (scatter(slabs, SUBJECT, "i").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(nj - 1))))
            .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(nk - 1)))))


