"""Separable operators: one pass per axis over lines of voxels.

A line is the set of voxels of one subject that share two coordinates, so its length is bounded by the grid, never
by the data. Spark groups the rows of a line into two short arrays; a vectorised kernel then treats a whole Arrow
batch of lines at once, and the result is exploded back to rows on the JVM side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.joins import attach, shuffled_join
from ..schema import AXES, SUBJECT, Dims, other_axes
from .blocks import fits, map_volumes, nearest_labels, sweep_dense

Kernel = Callable[[np.ndarray], np.ndarray]


def along(df: DataFrame, axis: str, dims: Dims, kernel: Kernel, fill: float, value: str = "v",
          keys: Sequence[str] = (SUBJECT,), limit: float | None = None, wanted: DataFrame | None = None,
          own_length: str | None = None, own_spacing: str | None = None) -> DataFrame:
    """Apply ``kernel`` to the dense ``(lines, length)`` matrix of each batch of lines.

    Absent voxels are ``fill``; result cells that are not finite, equal ``fill``, or exceed ``limit`` are dropped.
    Lines without any row stay absent. ``wanted`` names the only cells to return: some columns of a line and ``_w``, the list of
    positions along it; lines it does not name are left out. ``own_length`` names a key with the length of a line's own grid, where it is
    shorter than the longest: the kernel then sees lines of equal length together, each cut to it. ``own_spacing`` names a key with the voxel size of a
    line's own scan, which the kernel gets as a second argument, a number a line.
    """
    length = dims[AXES.index(axis)]
    line = [*keys, *other_axes(axis)]
    packed = (df.groupBy(*line).agg(F.collect_list(F.struct(F.col(axis).alias("x"), F.col(value).cast("double").alias("y"))).alias("_c"))
              .select(*line, F.col("_c.x").alias("_x"), F.col("_c.y").alias("_y")))
    width, result, chosen = len(line), packed.schema, wanted is not None
    sized = None if own_length is None else line.index(own_length)
    spaced = None if own_spacing is None else line.index(own_spacing)
    if wanted is not None:
        on = [c for c in wanted.columns if c != "_w"]
        along_subject = set(on).isdisjoint(AXES)  # then a hot subject is spread by its lines
        packed = (attach(packed, wanted, on, salt_by=other_axes(axis)) if along_subject else shuffled_join(packed, wanted, on)).select(*line, "_x", "_y", "_w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            xs, ys = batch.column(width), batch.column(width + 1)
            rows = np.repeat(np.arange(n), np.diff(xs.offsets.to_numpy()))
            dense = np.full((n, length), fill)
            dense[rows, xs.flatten().to_numpy()] = ys.flatten().to_numpy(zero_copy_only=False)
            spacing = () if spaced is None else (batch.column(spaced).to_numpy(),)
            if sized is None:
                out = kernel(dense, *spacing)
            else:
                out, sizes = np.full_like(dense, fill), batch.column(sized).to_numpy()
                for size in np.unique(sizes):
                    out[sizes == size, :size] = kernel(dense[sizes == size, :size], *[x[sizes == size] for x in spacing])
            keep = np.isfinite(out) & (out != fill)
            if limit is not None:
                keep &= out <= limit
            if chosen:
                ask = batch.column(width + 2)
                asked = np.zeros_like(keep)
                asked[np.repeat(np.arange(n), np.diff(ask.offsets.to_numpy())), ask.flatten().to_numpy()] = True
                keep &= asked
            ends = np.concatenate([[0], np.cumsum(keep.sum(axis=1))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in range(width)]
                + [pa.ListArray.from_arrays(ends, np.nonzero(keep)[1].astype(np.int32)),
                   pa.ListArray.from_arrays(ends, out[keep])],
                names=batch.schema.names[:width + 2])

    done = packed.mapInArrow(run, result)
    return (done.select(*line, F.inline(F.arrays_zip("_x", "_y")))
            .select(*keys, *[F.col("_x").alias(a) if a == axis else F.col(a) for a in AXES], F.col("_y").alias(value)))


def sweep(df: DataFrame, dims: Dims, kernels: Sequence[Kernel], fill: float, value: str = "v",
          keys: Sequence[str] = (SUBJECT,), limit: float | None = None, where: DataFrame | None = None,
          where_keys: Sequence[str] = (SUBJECT,), own_lengths: Sequence[str] | None = None, own_spacings: Sequence[str] | None = None) -> DataFrame:
    """Passes along k, j and i; ``kernels`` are given in the order i, j, k, and so are ``own_lengths`` and ``own_spacings``, keys with the grid and the voxel sizes of a
    line's participant.

    With ``where`` (``where_keys``, among the keys, and voxels; read three times) only its voxels are returned, and every pass
    only makes the cells that lead to one: rows then grow with ``where`` and the seeds, not with the grid.

    On a grid of one block the passes are made on whole volumes in one step, with a single shuffle.
    """
    if fits(dims) and (where is None or set(where_keys) == set(keys)):
        def passes(dense: np.ndarray, of: pa.Table) -> np.ndarray:
            own = [None if names is None else [of.column(n).to_numpy() for n in names] for names in (own_lengths, own_spacings)]
            return sweep_dense(dense, kernels, fill, limit, *own)

        return map_volumes(df, dims, passes, fill, value, keys, where)
    final: list[str] = []
    for axis, kernel in reversed(list(zip(AXES, kernels))):
        wanted = None if where is None else where.groupBy(*where_keys, *final).agg(F.collect_set(axis).alias("_w"))
        own = [names[AXES.index(axis)] if names else None for names in (own_lengths, own_spacings)]
        df = along(df, axis, dims, kernel, fill, value, keys, limit, wanted, *own)
        final.append(axis)
    return df


def taxicab_kernel(d: np.ndarray) -> np.ndarray:
    x = np.arange(d.shape[1])
    ahead = np.minimum.accumulate(d - x, axis=1) + x
    behind = np.minimum.accumulate((d + x)[:, ::-1], axis=1)[:, ::-1] - x
    return np.minimum(ahead, behind)


def chessboard_kernel(d: np.ndarray) -> np.ndarray:
    """``min(max(d[y], |x - y|))`` over a line, for whole numbers, by two scans for a batch of lines at once: places that are nearest somewhere are kept on a stack with the
    cell from which on they are, then read off from the end. The steps are at most twice the length."""
    n, length = d.shape
    some = np.isfinite(d)
    g = np.where(some, d, 0).astype(np.int64)
    top, place, since = np.full(n, -1), np.zeros((n, length), np.int64), np.zeros((n, length), np.int64)
    for u in range(length):
        todo = np.flatnonzero(some[:, u])
        while len(todo):
            q = np.maximum(top[todo], 0)
            v, x = place[todo, q], since[todo, q]
            worse = (top[todo] >= 0) & (np.maximum(np.abs(x - v), g[todo, v]) > np.maximum(np.abs(x - u), g[todo, u]))
            put, v = todo[~worse], v[~worse]
            own, new = g[put, v], g[put, u]
            # from the cell after this one on u is nearer than v
            border = np.where(own <= new, np.maximum(v + new, (v + u) // 2), np.minimum(u - own, (v + u) // 2))
            border = np.where(top[put] < 0, 0, border + 1)
            put, border = put[border < length], border[border < length]
            top[put] += 1
            place[put, top[put]], since[put, top[put]] = u, border
            top[todo[worse]] -= 1
            todo = todo[worse]
    out = np.full(d.shape, np.inf)
    rows = np.flatnonzero(top >= 0)
    q = top[rows]
    for u in range(length - 1, -1, -1):
        v = place[rows, q]
        out[rows, u] = np.maximum(np.abs(u - v), g[rows, v])
        q = np.where(since[rows, q] == u, np.maximum(q - 1, 0), q)
    return out


def squared_distances(d: np.ndarray, spacing: np.ndarray) -> np.ndarray:
    """One axis of the squared Euclidean distance, with a voxel size for each line: the lower envelope of the parabolas over a line, for a batch of lines at once.

    The envelope is built from left to right; of every line that still has to, one parabola is taken off at a time, so the steps are at most twice the length.
    """
    n, length = d.shape
    x = np.arange(length)[None, :] * spacing[:, None]
    lift = d + x ** 2
    top = np.full(n, -1)
    vertex, border = np.zeros((n, length + 1), np.int64), np.full((n, length + 2), np.inf)
    for q in range(length):
        todo = np.flatnonzero(np.isfinite(d[:, q]))
        while len(todo):
            t = top[todo]
            v = vertex[todo, np.maximum(t, 0)]
            with np.errstate(divide="ignore", invalid="ignore"):
                meet = np.where(t < 0, -np.inf, (lift[todo, q] - lift[todo, v]) / (2 * (x[todo, q] - x[todo, v])))
            hidden = (t >= 0) & (meet <= border[todo, np.maximum(t, 0)])
            put = todo[~hidden]
            top[put] += 1
            vertex[put, top[put]] = q
            border[put, top[put]] = meet[~hidden]
            top[todo[hidden]] -= 1
            todo = todo[hidden]
    out = np.full(d.shape, np.inf)
    some = np.flatnonzero(top >= 0)
    at = np.zeros(len(some), np.int64)
    for q in range(length):
        while True:
            go = (at < top[some]) & (border[some, np.minimum(at + 1, length)] < x[some, q])
            if not go.any():
                break
            at[go] += 1
        v = vertex[some, at]
        out[some, q] = d[some, v] + (x[some, q] - x[some, v]) ** 2
    return out


def squared_kernel(spacing: float = 1.0) -> Kernel:
    return lambda d: squared_distances(d, np.full(len(d), float(spacing)))


def _fronts(dense: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Of layers (rows of ``dense``) that lie one after the other for each line in the order of their labels, what no smaller label reaches as near."""
    best = np.full((len(first), dense.shape[1]), np.inf)
    keep = np.zeros(dense.shape, bool)
    for k in range(int(count.max(initial=0))):
        lines = np.flatnonzero(count > k)
        layer = first[lines] + k
        keep[layer] = dense[layer] < best[lines]
        best[lines] = np.minimum(best[lines], dense[layer])
    return keep


def sweep_labels(seeds: DataFrame, dims: Dims, kernel: Kernel, where: DataFrame, keys: Sequence[str] = (SUBJECT,), label: str = "label") -> DataFrame:
    """(keys, voxel, ``label``, d) of the nearest seed for the voxels of ``where``, the smallest label on ties; ``d`` combines along the axes by ``kernel``.

    All labels pass along the axes together: a cell keeps its front of distance and label, that is what is nearer than every smaller label, so its rows do not depend on the number
    of labels. The passes make only the cells that lead to a wanted voxel (``where`` is read three times). On a grid of one block a volume is treated whole.
    """
    if fits(dims):
        return nearest_labels(seeds, dims, kernel, where, keys, label).withColumn(label, F.col("label").cast(seeds.schema[label].dataType))
    df, final = seeds.select(*keys, *AXES, F.lit(0.0).alias("d"), F.col(label).cast("long").alias("label")), []
    for axis in reversed(AXES):
        wanted = where.groupBy(*keys, *final).agg(F.collect_set(axis).alias("_w"))
        df = _labels_along(df, axis, dims, kernel, keys, wanted, axis == AXES[0])
        final.append(axis)
    return df.withColumn(label, F.col("label").cast(seeds.schema[label].dataType))


def _labels_along(df: DataFrame, axis: str, dims: Dims, kernel: Kernel, keys: Sequence[str], wanted: DataFrame, last: bool) -> DataFrame:
    length = dims[AXES.index(axis)]
    line = [*keys, *other_axes(axis)]
    packed = (df.groupBy(*line).agg(F.collect_list(F.struct(F.col(axis).alias("x"), "d", "label")).alias("_c"))
              .select(*line, F.col("_c.x").alias("_x"), F.col("_c.d").alias("_d"), F.col("_c.label").alias("_l")))
    result, width = packed.schema, len(line)
    on = [c for c in wanted.columns if c != "_w"]
    along_subject = set(on).isdisjoint(AXES)  # then a hot subject is spread by its lines
    packed = (attach(packed, wanted, on, salt_by=other_axes(axis)) if along_subject else shuffled_join(packed, wanted, on)).select(*line, "_x", "_d", "_l", "_w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                n, xs = batch.num_rows, batch.column(width)
                rows = np.repeat(np.arange(n), np.diff(xs.offsets.to_numpy()))
                labels, of = np.unique(batch.column(width + 2).flatten().to_numpy(), return_inverse=True)
                layers, layer = np.unique(rows * len(labels) + of, return_inverse=True)
                owner = layers // len(labels)
                dense = np.full((len(layers), length), np.inf)
                np.minimum.at(dense, (layer, xs.flatten().to_numpy()), batch.column(width + 1).flatten().to_numpy())
                dense = kernel(dense)
                first = np.searchsorted(owner, np.arange(n))
                keep = _fronts(dense, first, np.searchsorted(owner, np.arange(n), "right") - first)
                ask = batch.column(width + 3)
                asked = np.zeros((n, length), bool)
                asked[np.repeat(np.arange(n), np.diff(ask.offsets.to_numpy())), ask.flatten().to_numpy()] = True
                keep &= asked[owner]
                if last:
                    # the nearest of a front is the one of its largest label
                    nearest = np.zeros((n, length), np.int64)
                    np.maximum.at(nearest, owner, np.where(keep, np.arange(1, len(layers) + 1)[:, None], 0))
                    keep &= nearest[owner] == np.arange(1, len(layers) + 1)[:, None]
                on_layer, place = np.nonzero(keep)
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner[on_layer], minlength=n))]).astype(np.int32)
                arrays = (place.astype(np.int32), dense[on_layer, place], labels[layers[on_layer] % len(labels)])
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in range(width)] + [pa.ListArray.from_arrays(ends, a) for a in arrays],
                                                 names=batch.schema.names[:width + 3])

    done = packed.mapInArrow(run, result)
    return (done.select(*line, F.inline(F.arrays_zip("_x", "_d", "_l")))
            .select(*keys, *[F.col("_x").alias(a) if a == axis else F.col(a) for a in AXES], F.col("_d").alias("d"), F.col("_l").alias("label")))


def weighted_kernel(weights: Sequence[float], border: str) -> Kernel:
    """Symmetric moving weighted sum; ``weights[n]`` belongs to distance n, ``border`` names a padding rule of numpy."""
    reach = len(weights) - 1

    def run(d: np.ndarray) -> np.ndarray:
        length = d.shape[1]
        padded = np.pad(d, ((0, 0), (reach, reach)), mode=border)
        out = weights[0] * d
        for n in range(1, reach + 1):
            out = out + weights[n] * (padded[:, reach - n:reach - n + length] + padded[:, reach + n:reach + n + length])
        return out

    return run
