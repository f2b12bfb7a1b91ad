"""Erosion, dilation, opening, closing and distance maps on sparse voxel masks.

Box operators work on runs along one axis: a window over a line finds neighbours or run ends, and only the new voxels
are generated, once each. Distance operators are separable passes over lines.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..functions.joins import attach, shuffled_join
from ..functions.offsets import Offset, neighbours, spread
from ..schema import AXES, SUBJECT, VOXEL, Dims, in_grid, other_axes
from ..session import cut_lineage
from .blocks import fits, map_volumes, sweep_dense
from .lines import squared_distances, squared_kernel, sweep, taxicab_kernel

Radii = tuple[int, int, int]

#: Edge of the dense blocks of the footprint operators.
BLOCK = 32


def radii_in_voxels(size: float, voxel_size: Sequence[float]) -> Radii:
    """Whole-voxel radii of a physical size, at least one per axis."""
    a, b, c = (max(1, int(size / v)) for v in voxel_size)
    return a, b, c


def opening_radii(iterations: int, voxel_size: Sequence[float], dims: Dims) -> Radii:
    """Radii of an opening by ``iterations`` of the finest axis, at most a quarter of the longest axis."""
    cap = max(dims) // 4
    a, b, c = (max(1, min(int(iterations * min(voxel_size) / v), cap)) for v in voxel_size)
    return a, b, c


def _line(axis: str, keys: Sequence[str]) -> W:
    return W.partitionBy(*keys, *other_axes(axis)).orderBy(axis)


def dilate_axis(mask: DataFrame, axis: str, r: int, dims: Dims, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    n = dims[AXES.index(axis)]
    line = _line(axis, keys)
    x = F.col(axis)
    start = F.greatest(x - r, F.lag(x).over(line) + (r + 1), F.lit(0))
    spans = mask.select(*keys, *AXES).withColumn("_from", start).withColumn("_to", F.least(x + r, F.lit(n - 1)))
    return (spans.filter("_from <= _to")
            .withColumn(axis, F.explode(F.sequence("_from", "_to"))).select(*keys, *AXES))


def erode_axis(mask: DataFrame, axis: str, r: int, dims: Dims, border_erodes: bool = False,
               keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    n = dims[AXES.index(axis)]
    x = F.col(axis)
    runs = (mask.select(*keys, *AXES).withColumn("_run", x - F.row_number().over(_line(axis, keys)))
            .groupBy(*keys, *other_axes(axis), "_run").agg(F.min(axis).alias("_a"), F.max(axis).alias("_b")))
    low, high = F.col("_a") + r, F.col("_b") - r
    if not border_erodes:
        low = F.when(F.col("_a") == 0, F.lit(0)).otherwise(low)
        high = F.when(F.col("_b") == n - 1, F.lit(n - 1)).otherwise(high)
    return (runs.withColumn("_a", low).withColumn("_b", high).filter("_a <= _b")
            .withColumn(axis, F.explode(F.sequence("_a", "_b"))).select(*keys, *AXES))


def dilate_box(mask: DataFrame, radii: Radii, dims: Dims) -> DataFrame:
    for axis, r in zip(AXES, radii):
        mask = dilate_axis(mask, axis, r, dims)
    return mask.select(*VOXEL)


def erode_box(mask: DataFrame, radii: Radii, dims: Dims) -> DataFrame:
    """Outside the grid counts as inside the mask."""
    for axis, r in zip(AXES, radii):
        mask = erode_axis(mask, axis, r, dims)
    return mask.select(*VOXEL)


def open_box(mask: DataFrame, radii: Radii, dims: Dims) -> DataFrame:
    return dilate_box(erode_box(mask, radii, dims), radii, dims)


def by_brick(df: DataFrame, edge: int = 16) -> DataFrame:
    """Place neighbouring voxels in the same partition, so a partial aggregate absorbs most of a neighbour explode."""
    return df.repartition(SUBJECT, *[F.floor(F.col(a) / edge) for a in AXES])


Block = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _in_blocks(rows: DataFrame, dims: Dims, halo: Sequence[int], kernel: Block, edge: int = BLOCK) -> DataFrame:
    """Non-zero voxels of ``kernel(block, valid)`` over dense blocks of ``edge`` voxels and their halo; ``valid`` marks the grid.

    A voxel goes to the few blocks whose halo it lies in, whatever the size of a footprint: one shuffle, bounded memory.
    """
    home = [f"_b{a}" for a in AXES]
    for a, b, h, n in zip(AXES, home, halo, dims):
        first, last = F.floor((F.col(a) - h) / edge), F.floor((F.col(a) + h) / edge)
        blocks = F.sequence(F.greatest(first, F.lit(0)).cast("int"), F.least(last, F.lit((n - 1) // edge)).cast("int"))
        rows = rows.withColumn(b, F.explode(blocks))
    schema = T.StructType([rows.schema[SUBJECT], *[T.StructField(a, T.IntegerType()) for a in AXES], T.StructField("v", T.DoubleType())])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        corner = [int(b) * edge - h for b, h in zip(key[1:], halo)]
        shape = [edge + 2 * h for h in halo]
        block = np.zeros(shape)
        block[tuple(pdf[a].to_numpy() - c for a, c in zip(AXES, corner))] = pdf["v"].to_numpy()
        valid = np.ones(shape, bool)
        for axis, (c, n, size) in enumerate(zip(corner, dims, shape)):
            at = np.arange(c, c + size)
            valid &= ((at >= 0) & (at < n)).reshape([-1 if x == axis else 1 for x in range(3)])
        own = tuple(slice(h, h + edge) for h in halo)
        out = np.where(valid, kernel(block, valid), 0.0)[own]
        spots = np.argwhere(out)
        return pd.DataFrame({SUBJECT: key[0], **{a: (spots[:, x] + corner[x] + halo[x]).astype("int32") for x, a in enumerate(AXES)},
                             "v": out[tuple(spots.T)]})

    return rows.groupBy(SUBJECT, *home).applyInPandas(run, schema)


def _over(block: np.ndarray, footprint: Sequence[Offset], pick: np.ufunc, outside: float) -> np.ndarray:
    """``pick`` over the footprint around every cell; cells beyond the block are ``outside``."""
    reach = [max(abs(o[a]) for o in footprint) for a in range(3)]
    wide = np.pad(block, [(r, r) for r in reach], constant_values=outside)
    out = np.full(block.shape, outside)
    for o in footprint:
        pick(out, wide[tuple(slice(r + x, r + x + n) for r, x, n in zip(reach, o, block.shape))], out=out)
    return out


def _reach(footprint: Sequence[Offset], times: int = 1) -> list[int]:
    return [times * max(abs(o[a]) for o in footprint) for a in range(3)]


def _eroded(block: np.ndarray, valid: np.ndarray, footprint: Sequence[Offset]) -> np.ndarray:
    return _over(np.where(valid, block, np.inf), footprint, np.minimum, np.inf)


def _dilated(block: np.ndarray, valid: np.ndarray, footprint: Sequence[Offset]) -> np.ndarray:
    return _over(np.where(valid, block, -np.inf), [tuple(-x for x in o) for o in footprint], np.maximum, -np.inf)


def grey_erode(image: DataFrame, footprint: Sequence[Offset], dims: Dims) -> DataFrame:
    """Minimum over the footprint; an absent voxel is zero, as is one that is not returned; voxels outside the grid are ignored."""
    footprint = list(footprint)
    return _in_blocks(image.select(*VOXEL, "v"), dims, _reach(footprint), lambda x, valid: _eroded(x, valid, footprint))


def grey_dilate(image: DataFrame, footprint: Sequence[Offset], dims: Dims) -> DataFrame:
    footprint = list(footprint)
    return _in_blocks(image.select(*VOXEL, "v"), dims, _reach(footprint), lambda x, valid: _dilated(x, valid, footprint))


def grey_opening(image: DataFrame, footprint: Sequence[Offset], dims: Dims) -> DataFrame:
    """Erosion and dilation in one step over blocks with twice the halo."""
    footprint = list(footprint)
    return _in_blocks(image.select(*VOXEL, "v"), dims, _reach(footprint, 2), lambda x, valid: _dilated(_eroded(x, valid, footprint), valid, footprint))


def dilate_footprint(mask: DataFrame, footprint: Sequence[Offset], dims: Dims) -> DataFrame:
    return grey_dilate(mask.select(*VOXEL).withColumn("v", F.lit(1.0)), footprint, dims).select(*VOXEL)


def l1_distance(mask: DataFrame, dims: Dims, limit: float | None = None, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Taxicab distance ``d`` of every grid voxel (or of those up to ``limit``) to the mask; none for an empty mask."""
    seeds = mask.select(*keys, *AXES).withColumn("d", F.lit(0.0))
    return (sweep(seeds, dims, [taxicab_kernel] * 3, float("inf"), "d", keys, limit)
            .withColumn("d", F.col("d").cast("int")))


def dilate_l1(mask: DataFrame, r: int, dims: Dims, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    return l1_distance(mask, dims, r, keys).select(*keys, *AXES)


def rim_outside(mask: DataFrame, dims: Dims, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Background voxels that touch the mask: the only ones a taxicab distance into the mask can start from."""
    touched = spread(by_brick(mask.select(*keys, *AXES)), neighbours(6)).filter(in_grid(dims)).distinct()
    return shuffled_join(touched, mask.select(*keys, *AXES), [*keys, *AXES], "left_anti")


def _near(x: np.ndarray, r: float) -> np.ndarray:
    """Cells within taxicab distance ``r`` of the marked ones of their volume."""
    return sweep_dense(np.where(x, 0.0, math.inf), [taxicab_kernel] * 3, math.inf, r) <= r


def _cores(x: np.ndarray, r: int, border_erodes: bool = False) -> np.ndarray:
    """Marked cells at taxicab distance of at least ``r`` from the others, and with ``border_erodes`` from the outside of the grid."""
    kept = x & ~_near(~x, r - 1) if r > 1 else x
    if border_erodes:
        for axis, n in enumerate(x.shape[1:]):
            at = np.arange(n)
            kept = kept & ((at + 1 >= r) & (n - at >= r)).reshape([-1 if a == axis else 1 for a in range(3)])
    return kept


def _on_masks(mask: DataFrame, dims: Dims, run: Callable[[np.ndarray], np.ndarray], keys: Sequence[str]) -> DataFrame:
    """``run`` on the dense masks of a grid of one block."""
    rows = mask.select(*keys, *AXES, F.lit(1.0).alias("v"))
    return map_volumes(rows, dims, lambda x, _: run(x > 0).astype(float), 0.0, "v", keys).drop("v")


def erode_l1(mask: DataFrame, r: int, dims: Dims, border_erodes: bool = False, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Mask voxels at taxicab distance of at least ``r`` from the background (the grid border is no background
    unless ``border_erodes``)."""
    kept = mask.select(*keys, *AXES)
    if r > 1:
        kept = mask = cut_lineage(kept)  # read three times below
        near = (_on_masks(mask, dims, lambda x: x & (_near(~x, r - 1)), keys) if fits(dims)
                else dilate_l1(rim_outside(mask, dims, keys), r - 1, dims, keys))
        kept = shuffled_join(kept, near, [*keys, *AXES], "left_anti")
    if border_erodes:
        kept = kept.filter(" AND ".join(f"{a} + 1 >= {r} AND {n} - {a} >= {r}" for a, n in zip(AXES, dims)))
    return kept


def close_l1(mask: DataFrame, r: int, dims: Dims, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    if fits(dims):
        return _on_masks(mask, dims, lambda x: _cores(_near(x, r), r), keys)
    return erode_l1(dilate_l1(mask, r, dims, keys), r, dims, keys=keys)


def erode_steps(mask: DataFrame, steps: int, dims: Dims, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """``steps`` erosions by the 6-neighbour cross; the grid border erodes too."""
    if fits(dims):
        return _on_masks(mask, dims, lambda x: _cores(x, steps + 1, True), keys)
    return erode_l1(mask, steps + 1, dims, True, keys)


def open_steps(mask: DataFrame, steps: int, dims: Dims, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    if fits(dims):
        return _on_masks(mask, dims, lambda x: _near(_cores(x, steps + 1, True), steps), keys)
    return dilate_l1(erode_steps(mask, steps, dims, keys), steps, dims, keys)


def euclidean_distance(mask: DataFrame, dims: Dims, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0),
                       limit: float | None = None, keys: Sequence[str] = (SUBJECT,), where: DataFrame | None = None, grids: DataFrame | None = None) -> DataFrame:
    """Exact Euclidean distance ``d`` to the mask of all grid voxels, or of those of ``where`` (with the same keys). With ``grids`` (subject_id, vx, vy, vz) every scan is
    measured by its own voxel sizes; subjects it does not name have no distance."""
    seeds = mask.select(*keys, *AXES).withColumn("d", F.lit(0.0))
    far = None if limit is None else limit ** 2 * (1 + 1e-9)
    if grids is None:
        squared = sweep(seeds, dims, [squared_kernel(s) for s in spacing], math.inf, "d", keys, far, where, keys)
        return squared.withColumn("d", F.sqrt("d"))
    own = ["_vx", "_vy", "_vz"]
    sizes = grids.select(SUBJECT, *[F.col(c[1:]).cast("double").alias(c) for c in own])
    squared = sweep(attach(seeds, sizes), dims, [squared_distances] * 3, math.inf, "d", [*keys, *own], far, where, keys, own_spacings=own)
    return squared.select(*keys, *AXES, F.sqrt("d").alias("d"))


def surface(mask: DataFrame, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Mask voxels with a 6-neighbour outside the mask; the grid border counts as outside."""
    rows = mask.select(*keys, *AXES).withColumn("_deep", F.lit(True))
    for axis in AXES:
        line, x = _line(axis, keys), F.col(axis)
        both = (F.coalesce(F.lag(x).over(line) == x - 1, F.lit(False))
                & F.coalesce(F.lead(x).over(line) == x + 1, F.lit(False)))
        rows = rows.withColumn("_deep", F.col("_deep") & both)
    return rows.filter("NOT _deep").drop("_deep")
