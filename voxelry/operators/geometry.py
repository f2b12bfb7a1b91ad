"""Affines, resampling and alignment."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import matrix
from ..functions.joins import attach, shuffled_join
from ..functions.quantiles import exact_percentiles
from ..schema import AXES, SUBJECT, VOXEL, Dims
from ..session import scatter, staged
from .lines import sweep

MILD, SEVERE = 5e-5, 0.005
#: Source bricks of the interpolation and the voxels they borrow on each side.
BRICK, HALO = 32, 2


def _vox() -> list[Column]:
    return [F.col("vx"), F.col("vy"), F.col("vz")]


def affine_deviation(affine: Column) -> Column:
    """Largest deviation of R Rt from the identity, with R the rotation part per unit voxel."""
    def deviation(unit: Column) -> Column:
        rot = matrix.cells(unit, 3)
        square = matrix.product(rot, matrix.transpose(rot))
        return F.greatest(*[F.abs(square[r][c] - (1.0 if r == c else 0.0)) for r in range(3) for c in range(3)])

    m = matrix.cells(affine, 4)
    return matrix.let(matrix.pack([[m[r][c] / _vox()[c] for c in range(3)] for r in range(3)]), deviation)


def nearest_rotation(rot: Column, steps: int = 8) -> Column:
    """Polar factor of a 3x3 matrix (nine values): the mean of the matrix and its inverse transpose, repeated."""
    def step(x: Column) -> Column:
        m = matrix.cells(x, 3)
        back = matrix.transpose(matrix.inverse3(m))
        return matrix.pack([[(m[r][c] + back[r][c]) / 2 for c in range(3)] for r in range(3)])

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), rot, lambda acc, _: step(acc))


def _axis_aligned(affine: Column) -> Column:
    """World axis (0-based) and sign of each voxel axis: (axis0, sign0, axis1, sign1, axis2, sign2).

    Every voxel axis in turn takes the world axis it is strongest in among those still free.
    """
    def strongest(col: int, taken: Column) -> Column:
        free = F.filter(F.sequence(F.lit(0), F.lit(2)), lambda r: ~F.array_contains(taken, r))
        scored = F.transform(free, lambda r: F.struct(F.abs(F.get(affine, 4 * r + col)).alias("s"), (-r).alias("r")))
        return F.array(-F.array_max(scored)["r"])

    axes = F.array().cast("array<int>")
    for c in range(3):
        axes = matrix.let(axes, lambda taken, c=c: F.concat(taken, strongest(c, taken)))
    return F.flatten(F.transform(axes, lambda a, c: F.array(
        a.cast("double"), F.when(F.get(affine, 4 * a + c) < 0, -1.0).otherwise(1.0))))


def check_affine(images: DataFrame, centres: DataFrame, mild: float = MILD, severe: float = SEVERE) -> DataFrame:
    """``images`` with ``deviation``, ``status`` (ok, mild, severe) and the corrected ``affine``.

    A mild fault is moved to the nearest rotation; a severe one becomes an axis-aligned affine centred on the rounded
    centre of mass (``centres``: ci, cj, ck) with the voxel size and axis directions kept.
    """
    rows = images.join(centres.select(SUBJECT, "ci", "cj", "ck"), SUBJECT, "left").withColumn("deviation", affine_deviation(F.col("affine")))
    status = F.when(F.col("deviation") >= severe, "severe").when(F.col("deviation") >= mild, "mild").otherwise("ok")
    rows = rows.withColumn("status", status)
    m, vox = matrix.cells(F.col("affine"), 4), _vox()
    unit = matrix.pack([[m[r][c] / vox[c] for c in range(3)] for r in range(3)])
    rows = rows.withColumn("_r", F.when(F.col("status") == "mild", nearest_rotation(unit)))
    rows = rows.withColumn("_o", F.when(F.col("status") == "severe", _axis_aligned(F.col("affine"))))
    fixed = matrix.pack([[*[F.col("_r")[3 * r + c] * vox[c] for c in range(3)], m[r][3]] for r in range(3)] + [m[3]])
    centre = [F.rint(c) for c in ("ci", "cj", "ck")]
    plain = []
    for r in range(3):
        cols = [F.when(F.col("_o")[2 * c] == r, F.col("_o")[2 * c + 1] * vox[c]).otherwise(0.0) for c in range(3)]
        plain.append([*cols, -(cols[0] * centre[0] + cols[1] * centre[1] + cols[2] * centre[2])])
    plain.append([F.lit(0.0)] * 3 + [F.lit(1.0)])
    affine = F.when(F.col("status") == "mild", fixed).when(F.col("status") == "severe", matrix.pack(plain)).otherwise(F.col("affine"))
    return rows.select(*[c for c in images.columns if c != "affine"], "deviation", "status", affine.alias("affine"))


def companion_affine(images: DataFrame, corrected: DataFrame, main: str = "img1") -> DataFrame:
    """Move the sibling scans of a subject along with its corrected main scan: corrected * inverse(original) * sibling."""
    original = images.filter(F.col("role") == main).select(SUBJECT, F.col("affine").alias("_old"))
    new = corrected.filter(F.col("role") == main).select(SUBJECT, F.col("affine").alias("_new"))
    moves = original.join(new, SUBJECT).select(SUBJECT, matrix.matmul4(F.col("_new"), matrix.inverse_affine(F.col("_old"))).alias("_t"))
    rows = images.join(moves, SUBJECT, "left")
    moved = F.when(F.col("_t").isNull(), F.col("affine")).otherwise(matrix.matmul4(F.col("_t"), F.col("affine")))
    return rows.withColumn("affine", moved).select(*images.columns)


def registration_magnitude(transforms: DataFrame, column: str = "transform") -> DataFrame:
    """Sum of the absolute x, y, z rotation angles in degrees, and the length of the translation."""
    m = [F.col(column)[n] for n in range(12)]
    angles = [F.atan2(m[7], m[8]), F.asin(-m[6]), F.atan2(m[3], m[0])]
    total = F.abs(F.degrees(angles[0])) + F.abs(F.degrees(angles[1])) + F.abs(F.degrees(angles[2]))
    return transforms.withColumns({"rotation": total, "translation": F.sqrt(m[9] * m[9] + m[10] * m[10] + m[11] * m[11])})


def grid_transform(source_affine: Column, target_affine: Column, world: Column | None = None) -> Column:
    """Target voxel to source voxel; ``world`` optionally maps target space to source space."""
    inverse = matrix.inverse_affine(source_affine)
    through = inverse if world is None else matrix.matmul4(inverse, world)
    return matrix.matmul4(through, target_affine)


def cluster_transform(source_affine: Column, transform: Column, target_affine: Column) -> Column:
    """Source voxel to target voxel through a stored registration, which uses the opposite x and y directions and maps
    target points to source points."""
    flip = F.array(*[F.lit(float(x)) for x in (-1, 0, 0, 0, 0, -1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1)])
    back = matrix.inverse_affine(matrix.matmul4(matrix.matmul4(flip, transform), flip))
    return matrix.matmul4(matrix.matmul4(matrix.inverse_affine(target_affine), back), source_affine)


#: Columns with the grid of a participant's own source scan.
OWN_GRID = ("_ni", "_nj", "_nk")


def own_grids(grids: DataFrame | None) -> DataFrame | None:
    """(subject_id, ni, nj, nk) of scans under the names of ``OWN_GRID``."""
    return None if grids is None else grids.select(SUBJECT, *[F.col(c[1:]).cast("int").alias(c) for c in OWN_GRID])


def target_points(transforms: DataFrame, target_dims: Dims, source_dims: Dims, grids: DataFrame | None = None) -> DataFrame:
    """Every target voxel with its source coordinate ``x y z``, as far as that lies inside the source grid: that of ``grids`` (subject_id, ni, nj, nk)
    where it is given, else ``source_dims`` for all. The grid comes along in the columns of ``OWN_GRID``."""
    ni, nj, nk = target_dims
    rows = (transforms.select(SUBJECT, "affine").withColumns({c: F.lit(n) for c, n in zip(OWN_GRID, source_dims)}) if grids is None
            else transforms.select(SUBJECT, "affine").join(own_grids(grids), SUBJECT))
    slabs = rows.select(SUBJECT, *OWN_GRID, *[F.col("affine")[n].alias(f"_m{n}") for n in range(12)],
                              F.explode(F.sequence(F.lit(0), F.lit(ni - 1))).alias("i"))
    points = (scatter(slabs, SUBJECT, "i").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(nj - 1))))
              .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(nk - 1)))))
    # exact lattice points must not fall out of the grid by rounding
    rounded = [f"round(_m{4 * r} * i + _m{4 * r + 1} * j + _m{4 * r + 2} * k + _m{4 * r + 3}, 9)" for r in range(3)]
    inside = " AND ".join(f"{c} BETWEEN 0 AND {n} - 1" for c, n in zip("xyz", OWN_GRID))
    return points.select(*VOXEL, *OWN_GRID, *[F.expr(c).alias(n) for n, c in zip("xyz", rounded)]).filter(inside)


def resample_nearest(voxels: DataFrame, transforms: DataFrame, target_dims: Dims, source_dims: Dims, value: str = "v",
                     grids: DataFrame | None = None) -> DataFrame:
    """Put a volume on another grid, nearest voxel; ``transforms.affine`` maps target voxels to source voxels."""
    points = target_points(transforms, target_dims, source_dims, grids)
    near = points.select(*[F.col(a).alias(f"_{a}") if a in AXES else F.col(a) for a in VOXEL],
                         *[F.floor(F.col(c) + 0.5).cast("int").alias(a) for a, c in zip(AXES, "xyz")])
    return (shuffled_join(near, voxels.select(*VOXEL, value))
            .select(SUBJECT, *[F.col(f"_{a}").alias(a) for a in AXES], value))


def spline_system(n: int) -> np.ndarray:
    """Values at the ``n`` voxels of a line of the cubic B-splines centred at them, borders mirrored about the last voxel."""
    system = (np.diag(np.full(n, 4.0)) + np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1)) / 6
    if n > 1:
        system[0, 1] = system[-1, -2] = 2 / 6
    else:
        system[0, 0] = 1.0
    return system


@lru_cache(64)
def _spline_inverse(n: int) -> np.ndarray:
    return np.linalg.inv(spline_system(n)).T


def spline_coefficients(voxels: DataFrame, dims: Dims, grids: DataFrame | None = None) -> DataFrame:
    """Cubic B-spline coefficients of a volume: along every axis the exact solution of a line's spline system, of the length of the scan's own
    grid where ``grids`` tells it."""
    kernels = [lambda d: d @ _spline_inverse(d.shape[1])] * 3
    if grids is None:
        return sweep(voxels.select(*VOXEL, "v"), dims, kernels, 0.0)
    sized = attach(voxels.select(*VOXEL, "v"), own_grids(grids))
    return sweep(sized, dims, kernels, 0.0, keys=(SUBJECT, *OWN_GRID), own_lengths=OWN_GRID).select(*VOXEL, "v")


def _linear(t: np.ndarray) -> list[np.ndarray]:
    return [1 - t, t]


def _cubic(t: np.ndarray) -> list[np.ndarray]:
    s = 1 - t
    return [s ** 3 / 6, (4 - 6 * t ** 2 + 3 * t ** 3) / 6, (4 - 6 * s ** 2 + 3 * s ** 3) / 6, t ** 3 / 6]


def _interpolate(points: pd.DataFrame, source: pd.DataFrame, order: int) -> pd.DataFrame:
    """Values at the points of one source brick from the voxels of that brick and its halo."""
    out = points[list(VOXEL)].copy()
    dims = [int(points[c].iloc[0]) if len(points) else 1 for c in OWN_GRID]
    corner = [int(points[f"_b{a}"].iloc[0]) * BRICK - HALO if len(points) else 0 for a in AXES]
    block = np.zeros((BRICK + 2 * HALO + 1,) * 3)
    if len(source):
        block[tuple(source[a].to_numpy() - c for a, c in zip(AXES, corner))] = source["v"].to_numpy()
    first, weights = (0, _linear) if order == 1 else (-1, _cubic)
    taps = []
    for c, n, lowest in zip("xyz", dims, corner):
        at = points[c].to_numpy()
        base = np.floor(at).astype(int)
        w = weights(at - base)
        indices = []
        for t in range(len(w)):
            p = np.abs(base + first + t)
            p = np.where(p > n - 1, 2 * (n - 1) - p, p)
            indices.append(np.maximum(p, 0) - lowest)
        taps.append(list(zip(indices, w)))
    total = np.zeros(len(points))
    for x, wx in taps[0]:
        for y, wy in taps[1]:
            for z, wz in taps[2]:
                total += wx * wy * wz * block[x, y, z]
    out["v"] = total
    return out


def resample(voxels: DataFrame, transforms: DataFrame, target_dims: Dims, source_dims: Dims, order: int = 3,
             tiny: float = 1e-12, grids: DataFrame | None = None) -> DataFrame:
    """Put a volume on another grid with linear (1) or cubic (3) interpolation, nearest for order 0.

    ``grids`` (subject_id, ni, nj, nk) tells the own grid of every source scan, none larger than ``source_dims``; borders are mirrored there.

    Target points are sent to the source brick they read from, and source voxels to their brick and to the bricks whose
    halo they are in; each brick is interpolated as one dense block, so no tap ever becomes a row.
    """
    if order == 0:
        return resample_nearest(voxels, transforms, target_dims, source_dims, grids=grids)
    source = voxels.select(*VOXEL, "v") if order == 1 else spline_coefficients(voxels, source_dims, grids)
    home = [f"_b{a}" for a in AXES]
    points = target_points(transforms, target_dims, source_dims, grids)
    points = points.withColumns({b: F.floor(F.col(c) / BRICK).cast("int") for b, c in zip(home, "xyz")})
    spread = source
    for a, b, n in zip(AXES, home, source_dims):
        # mirrored taps stay within the halo of the last brick
        first, last = F.floor((F.col(a) - HALO) / BRICK), F.floor((F.col(a) + HALO) / BRICK)
        bricks = F.sequence(F.greatest(first, F.lit(0)).cast("int"), F.least(last, F.lit((n - 1) // BRICK)).cast("int"))
        spread = spread.withColumn(b, F.explode(bricks))
    schema = T.StructType([*points.select(*VOXEL).schema.fields, T.StructField("v", T.DoubleType())])

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _interpolate(left, right, order)

    # dealt by number: the planner would merge bricks by their bytes, which are few for the work on them
    points, spread = scatter(points, SUBJECT, *home), scatter(spread, SUBJECT, *home)
    done = points.groupBy(SUBJECT, *home).cogroup(spread.groupBy(SUBJECT, *home)).applyInPandas(run, schema)
    return done.filter(F.abs("v") > tiny)


def warp_labels(labels: DataFrame, transforms: DataFrame, target_dims: Dims, source_dims: Dims) -> DataFrame:
    """Move a label map into the space of another scan.

    ``transforms`` holds the affines of both scans and the known rigid transform (``source_affine``, ``target_affine``,
    ``transform``: 4x4, source space to target space), which is inverted.
    """
    composed = grid_transform(F.col("source_affine"), F.col("target_affine"), matrix.inverse_affine(F.col("transform")))
    return resample_nearest(labels, transforms.select(SUBJECT, composed.alias("affine")), target_dims, source_dims, "label")


def mutual_information(first: DataFrame, second: DataFrame, mask: DataFrame, bins: int = 64, low: float = 0.005,
                       high: float = 0.995) -> DataFrame:
    """Mutual information (nats) of two aligned images inside a mask, from a joint histogram of winsorised values."""
    both = mask.select(*VOXEL)
    for name, image in (("a", first), ("b", second)):
        both = shuffled_join(both, image.select(*VOXEL, F.col("v").alias(name)), how="left")
    both = staged(both.withColumns({n: F.coalesce(n, F.lit(0.0)) for n in "ab"}), "aligned")  # one join for the quantiles and the histogram
    limits = None
    for n in "ab":
        q = exact_percentiles(both, [SUBJECT], n, [low, high]).select(
            SUBJECT, F.col("q")[0].alias(f"{n}0"), F.col("q")[1].alias(f"{n}1"))
        limits = q if limits is None else limits.join(q, SUBJECT)
    rows = attach(both, limits)

    def bucket(n: str) -> Column:
        v = F.least(F.greatest(n, f"{n}0"), f"{n}1")
        at = F.floor((v - F.col(f"{n}0")) * bins / F.nullif(F.col(f"{n}1") - F.col(f"{n}0"), F.lit(0.0)))
        return F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).alias(f"bin_{n}")

    joint = staged(rows.groupBy(SUBJECT, bucket("a"), bucket("b")).agg(F.count("*").cast("double").alias("n")), "joint")
    # at most bins x bins rows per subject from here on
    entropy = F.sum(F.col("n") * F.ln("n"))
    def margin(cols: list[str], name: str) -> DataFrame:
        return joint.groupBy(SUBJECT, *cols).agg(F.sum("n").alias("n")).groupBy(SUBJECT).agg(entropy.alias(name), F.sum("n").alias("total"))
    parts = margin(["bin_a", "bin_b"], "_ab").join(margin(["bin_a"], "_a").drop("total"), SUBJECT).join(margin(["bin_b"], "_b").drop("total"), SUBJECT)
    mi = F.ln("total") + (F.col("_ab") - F.col("_a") - F.col("_b")) / F.col("total")
    return parts.select(SUBJECT, mi.alias("mutual_information"))
