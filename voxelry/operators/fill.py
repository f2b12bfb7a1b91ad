"""Nearest-label fill and hull fill."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.hull import complement, half_spaces
from ..functions.joins import shuffled_join
from ..schema import AXES, SUBJECT, Dims
from ..session import cut_lineage, scatter
from .lines import chessboard_kernel, sweep_labels


def nearest_label_fill(labels: DataFrame, mask: DataFrame, dims: Dims, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Every mask voxel with the label of its nearest labelled voxel (chessboard metric, smallest label on ties).

    An exact separable transform for all labels at once: cells carry fronts of distance and label, so rows do not grow with the number of labels, and only
    cells on the way to a mask voxel are made.
    """
    voxel = [*keys, *AXES]
    wanted = cut_lineage(mask.select(*voxel).distinct())
    return sweep_labels(labels.select(*voxel, "label"), dims, chessboard_kernel, wanted, keys).select(*voxel, "label")


def _upper_corners(v: np.ndarray) -> np.ndarray:
    """Corners of the upper hull of each row's points (column, value); ``-inf`` where there is none. Andrew's monotone chain on all rows at once: of every row that still has to,
    one point is taken off at a time."""
    n, length = v.shape
    top, stack = np.full(n, -1), np.zeros((n, length), np.int64)
    for q in range(length):
        todo = np.flatnonzero(np.isfinite(v[:, q]))
        while len(todo):
            t = top[todo]
            # without two points yet, the new one stands in for them
            b, a = (np.where(t >= 1, stack[todo, np.maximum(t - k, 0)], q) for k in (0, 1))
            inside = (t >= 1) & ((b - a) * (v[todo, q] - v[todo, a]) >= (v[todo, b] - v[todo, a]) * (q - a))
            put = todo[~inside]
            top[put] += 1
            stack[put, top[put]] = q
            top[todo[inside]] -= 1
            todo = todo[inside]
    found = np.zeros(v.shape, bool)
    rows, at = np.nonzero(np.arange(length)[None, :] <= top[:, None])
    found[rows, stack[rows, at]] = True
    return found


def _slab_corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slabs (..., list of x, list of y) -> only the points that are corners of the slab's own hull."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            xs, ys = (batch.column(batch.num_columns - k) for k in (2, 1))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(xs.offsets.to_numpy()))
            x, y = xs.flatten().to_numpy(), ys.flatten().to_numpy().astype(float)
            first = x.min() if len(x) else 0
            high = np.full((batch.num_rows, int(x.max() - first) + 1 if len(x) else 1), -np.inf)
            low = high.copy()
            np.maximum.at(high, (rows, x - first), y)
            np.maximum.at(low, (rows, x - first), -y)
            (a, p), (b, q) = np.nonzero(_upper_corners(high)), np.nonzero(_upper_corners(low))
            of, order = np.concatenate([a, b]), np.argsort(np.concatenate([a, b]), kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=batch.num_rows))]).astype(np.int32)
            found = (np.concatenate([p, q])[order] + first, np.concatenate([high[a, p], -low[b, q]])[order])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *[pa.ListArray.from_arrays(ends, f.astype(np.int32)) for f in found]], names=batch.schema.names)


def hull_corners(mask: DataFrame, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """The voxels of a mask that can be corners of its hull: ends of their lines, then corners of the flat hull of their slab along each of the axes in turn.
    A slab is one row whose points are bounded by an axis."""
    keys = list(keys)
    ends = mask.groupBy(*keys, "i", "j").agg(F.min("k").alias("_k0"), F.max("k").alias("_k1"))
    points = ends.select(*keys, "i", "j", F.explode(F.array("_k0", "_k1")).alias("k"))
    for slab, x, y in (("i", "j", "k"), ("j", "i", "k"), ("k", "i", "j")):
        packed = (points.groupBy(*keys, slab).agg(F.collect_list(F.struct(x, y)).alias("_p"))
                  .select(*keys, slab, F.col(f"_p.{x}").cast("array<int>").alias("_x"), F.col(f"_p.{y}").cast("array<int>").alias("_y")))
        found = packed.mapInArrow(_slab_corners, packed.schema).select(*keys, slab, F.inline(F.arrays_zip("_x", "_y")))
        points = found.select(*keys, slab, F.col("_x").alias(x), F.col("_y").alias(y)).distinct()
    return points.select(*keys, *AXES)


def _shadow(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the points' hull seen along k: each i with the first and last whole j."""
    i0, i1, j0 = points[:, 0].min(), points[:, 0].max(), points[:, 1].min()
    width = int(i1 - i0) + 1
    bounds = np.full((2, width), -np.inf)
    np.maximum.at(bounds[0], points[:, 0] - i0, points[:, 1] - j0)
    np.maximum.at(bounds[1], points[:, 0] - i0, j0 - points[:, 1])
    ends = []
    for values, chosen in zip(bounds, _upper_corners(bounds)):
        x = np.flatnonzero(chosen)
        y = values[x].astype(np.int64)
        at = np.arange(width)
        k = np.minimum(np.searchsorted(x, at, "right") - 1, max(len(x) - 2, 0))
        nxt = np.minimum(k + 1, len(x) - 1)
        run = np.maximum(x[nxt] - x[k], 1)
        ends.append((y[k] * run + (y[nxt] - y[k]) * (at - x[k])) // run)
    return at + i0, j0 - ends[1], ends[0] + j0


def _hull_planes(keys: Sequence[str]):
    """Half-spaces of one group of hull corners with the (i, j) they can bound, and the lines that the hull covers."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf[list(AXES)].to_numpy(np.int64)
        found = half_spaces(points)
        found = found[found[:, 2] != 0]
        box = np.tile([points[:, 0].min(), points[:, 0].max(), points[:, 1].min(), points[:, 1].max()], (len(found), 1))
        if not len(complement(points)):
            # a facet of a solid hull bounds the lines that meet it; a flat hull has few, which are taken for all
            for n, (a, b, c, h) in enumerate(found):
                on = points[points @ (a, b, c) == h]
                box[n] = on[:, 0].min(), on[:, 0].max(), on[:, 1].min(), on[:, 1].max()
        row = {k: [pdf[k].iloc[0]] for k in keys}
        row |= {name: [v.tolist()] for name, v in zip(("_a", "_b", "_c", "_h", "_i0", "_i1", "_j0", "_j1"), np.column_stack([found, box]).T)}
        row |= {name: [v.astype(np.int64).tolist()] for name, v in zip(("_li", "_l0", "_l1"), _shadow(points))}
        return pd.DataFrame(row)
    return run


def hull_fill(mask: DataFrame, keys: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Grid voxels inside the convex hull of a mask, its border included, per value of ``keys``; exact, also for flat masks.

    In two stages: slabs lose all but the corners of their own hulls, and only what is left of a group (a few hundred points of a rounded mask) meets in one task, which
    finds the half-spaces. A half-space goes to the slabs that its facet touches, and there bounds the lines it can.
    """
    keys = list(keys)
    names = ("_a", "_b", "_c", "_h", "_i0", "_i1", "_j0", "_j1", "_li", "_l0", "_l1")
    schema = T.StructType([*[mask.schema[k] for k in keys], *[T.StructField(c, T.ArrayType(T.LongType())) for c in names]])
    # corners are few bytes and much work: dealt by number, or the planner would merge all groups into one task
    shape = cut_lineage(scatter(hull_corners(mask, keys), *keys).groupBy(*keys).applyInPandas(_hull_planes(keys), schema))
    facets = shape.select(*keys, F.inline(F.arrays_zip(*names[:8]))).withColumn("i", F.explode(F.sequence("_i0", "_i1")))
    # what a half-space leaves of a line of the slab: an upper or a lower end
    bounds = (facets.select(*keys, "i", F.struct("_j0", "_j1", "_b", "_c", (F.col("_h") - F.col("i") * F.col("_a")).alias("_r")).alias("_f"))
              .groupBy(*keys, "i").agg(F.collect_list("_f").alias("_f")))
    slabs = shape.select(*keys, F.inline(F.arrays_zip("_li", "_l0", "_l1"))).select(*keys, F.col("_li").alias("i"), "_l0", "_l1")
    lines = shuffled_join(slabs, bounds, [*keys, "i"]).filter("_l0 <= _l1").withColumn("j", F.explode(F.sequence("_l0", "_l1")))
    met = F.filter("_f", lambda f: (f["_j0"] <= F.col("j")) & (F.col("j") <= f["_j1"]))
    ends = F.transform(met, lambda f: F.struct(f["_c"].alias("c"), (f["_r"] - F.col("j") * f["_b"]).alias("r")))
    lines = lines.select(*keys, "i", "j", ends.alias("_l"))
    high = F.array_min(F.transform(F.filter("_l", lambda x: x["c"] > 0), lambda x: F.floor(x["r"] / x["c"])))
    low = F.array_max(F.transform(F.filter("_l", lambda x: x["c"] < 0), lambda x: F.ceil(x["r"] / x["c"])))
    return (lines.select(*keys, "i", "j", low.alias("_a"), high.alias("_b")).filter("_a <= _b")
            .withColumn("k", F.explode(F.sequence(F.col("_a").cast("int"), F.col("_b").cast("int"))))
            .select(*keys, F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), "k"))
