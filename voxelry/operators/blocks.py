"""Volumes of a small grid as dense blocks: one shuffle, after which every step on a volume is array work inside a task.

Only grids of at most ``VOLUME`` voxels are treated so; larger ones go line by line or brick by brick. Rows stay rows in the shuffle and in the batches: a task
holds a bounded number of them, whatever the number of participants it is dealt.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..schema import AXES, SUBJECT, VOXEL, Dims, in_grid, voxel_id
from ..session import scatter

#: Voxels of the largest grid that is one block.
VOLUME = 32 ** 3
#: Rows, and cells of dense blocks, that a task holds at a time.
ROWS = CELLS = 1 << 18

#: Dense volumes (number of volumes, ni, nj, nk) and the key columns of each -> new volumes of the same shape.
Volumes = Callable[[np.ndarray, pa.Table], np.ndarray]


def fits(dims: Dims) -> bool:
    return math.prod(dims) <= VOLUME


def whole_groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that come group by group, some whole groups at a time, with the number of each row's group; the first ``width`` columns name a group."""
    def numbered(rows: pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        for column in rows.columns[:width]:
            new[1:] |= np.diff(column.combine_chunks().dictionary_encode("encode").indices.to_numpy()) != 0
        return np.cumsum(new)

    held, count = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
        if count >= ROWS:
            rows = pa.Table.from_batches(held)
            owner = numbered(rows)
            whole = int(np.searchsorted(owner, owner[-1]))  # the last group may go on in the next batch
            if whole:
                yield rows.slice(0, whole), owner[:whole]
                held, count = rows.slice(whole).to_batches(), count - whole
    if count:
        rows = pa.Table.from_batches(held)
        yield rows, numbered(rows)


def _chunks(batches: Iterator[pa.RecordBatch], width: int, cells: int) -> Iterator[tuple[pa.Table, np.ndarray, pa.Table]]:
    """Rows of some whole volumes, the number of each row's volume and the keys of the volumes, as many as may be dense at a time."""
    step = max(1, CELLS // cells)
    for rows, owner in whole_groups(batches, width):
        for first in range(0, int(owner[-1]) + 1, step):
            a, b = np.searchsorted(owner, [first, first + step])
            part, of = rows.slice(a, b - a), owner[a:b] - first
            starts = np.searchsorted(of, np.arange(int(of[-1]) + 1))
            yield part, of, part.select(range(width)).take(pa.array(starts))


def _places(rows: pa.Table, of: np.ndarray) -> tuple[np.ndarray, ...]:
    return (of, *[rows.column(a).to_numpy() for a in AXES])


def _voxels(keep: np.ndarray, keys: pa.Table, schema: pa.Schema) -> tuple[list[pa.Array], tuple[np.ndarray, ...]]:
    """Key and axis columns of the marked cells, and the cells."""
    at = np.nonzero(keep)
    columns = [keys.column(c).take(pa.array(at[0])).combine_chunks() for c in range(keys.num_columns)]
    return columns + [pa.array(x).cast(schema.field(a).type) for a, x in zip(AXES, at[1:])], at


def _dealt(rows: DataFrame, keys: Sequence[str], where: DataFrame | None) -> DataFrame:
    """Rows volume by volume; those of ``where`` (the same keys) come along as ``_w``."""
    rows = rows.withColumn("_w", F.lit(False))
    if where is not None:
        typed = [F.col(c).cast(rows.schema[c].dataType).alias(c) for c in (*keys, *AXES)]
        rows = rows.unionByName(where.select(*typed, F.lit(True).alias("_w")), allowMissingColumns=True)
    return scatter(rows, *keys).sortWithinPartitions(*keys)  # the planner would merge partitions by their bytes, not by their cells


def _asked(rows: pa.Table, of: np.ndarray, shape: tuple[int, ...], where: bool) -> tuple[pa.Table, np.ndarray, np.ndarray | None]:
    """The rows of values, their volumes, and the cells that are wanted."""
    if not where:
        return rows, of, None
    wish = rows.column("_w").to_numpy()
    asked = np.zeros(shape, bool)
    asked[_places(rows.filter(pa.array(wish)), of[wish])] = True
    return rows.filter(pa.array(~wish)), of[~wish], asked


def map_volumes(df: DataFrame, dims: Dims, run: Volumes, fill: float, value: str = "v", keys: Sequence[str] = (SUBJECT,),
                where: DataFrame | None = None) -> DataFrame:
    """``run`` on the dense volumes of a small grid, some at a time; absent voxels are ``fill``, and cells that are ``fill`` or not finite afterwards are dropped.

    With ``where`` (the same keys and voxels) only its voxels are returned.
    """
    width, shape = len(keys), tuple(dims)
    rows = df.select(*keys, *AXES, F.col(value).cast("double").alias(value))
    schema, chosen = rows.schema, where is not None

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, of, names in _chunks(batches, width, math.prod(shape)):
            part, of, asked = _asked(part, of, (names.num_rows, *shape), chosen)
            dense = np.full((names.num_rows, *shape), fill)
            dense[_places(part, of)] = part.column(value).to_numpy()
            out = run(dense, names)
            keep = np.isfinite(out) & (out != fill)
            if asked is not None:
                keep &= asked
            columns, at = _voxels(keep, names, part.schema)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out[at])], names=[*names.column_names, *AXES, value])

    return _dealt(rows, keys, where).mapInArrow(mapped, schema)


def map_labels(labels: DataFrame, dims: Dims, run: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``run`` on the dense label maps of a small grid, some at a time, laid along the last axis: (ni, nj, nk, number of maps). Label 0 is an absent voxel, before and
    afterwards. Rows travel with the number of their voxel, and are read once."""
    cells = math.prod(dims)
    number = F.when(in_grid(dims), voxel_id(dims)).otherwise(F.raise_error(F.lit("voxel outside the grid")))
    rows = labels.filter("label <> 0").select(SUBJECT, number.cast("int").alias("_at"), F.col("label").cast("int").alias("label"))
    schema = T.StructType([labels.schema[SUBJECT], *[T.StructField(c, T.IntegerType()) for c in (*AXES, "label")]])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, of, names in _chunks(batches, 1, cells):
            dense = np.zeros((cells, names.num_rows), np.int32)
            dense[part.column("_at").to_numpy(), of] = part.column("label").to_numpy()
            out = run(dense.reshape(*dims, -1))
            at = np.nonzero(out)
            columns = [names.column(SUBJECT).combine_chunks().take(pa.array(at[3])), *[pa.array(x, pa.int32()) for x in (*at[:3], out[at])]]
            yield pa.RecordBatch.from_arrays(columns, names=[SUBJECT, *AXES, "label"])

    found = scatter(rows, SUBJECT).sortWithinPartitions(SUBJECT).mapInArrow(mapped, schema)
    return found.select(*[F.col(c).cast(labels.schema[c].dataType).alias(c) for c in VOXEL], "label")


def sweep_dense(dense: np.ndarray, kernels: Sequence[Callable], fill: float, limit: float | None = None,
                lengths: Sequence[np.ndarray] | None = None, spacings: Sequence[np.ndarray] | None = None) -> np.ndarray:
    """Passes of line kernels (in the order i, j, k) along k, j and i; between them cells that are not finite or beyond ``limit`` are dropped, and lines
    without any value are left out. ``lengths`` and ``spacings`` are those of each volume, per axis."""
    for axis in (2, 1, 0):
        lines = np.moveaxis(dense, axis + 1, -1)
        shape = lines.shape
        lines = lines.reshape(-1, shape[-1])
        some = np.flatnonzero((lines != fill).any(axis=1))
        volume = some // (shape[1] * shape[2])
        size = np.full(len(some), shape[-1]) if lengths is None else lengths[axis][volume]
        spacing = None if spacings is None else spacings[axis][volume]
        out = np.full_like(lines, fill)
        for n in np.unique(size):
            on = size == n
            own = some[on]
            found = kernels[axis](lines[own, :n], *([] if spacing is None else [spacing[on]]))
            good = np.isfinite(found)
            if limit is not None:
                good &= found <= limit
            out[own, :n] = np.where(good, found, fill)
        dense = np.moveaxis(out.reshape(shape), -1, axis + 1)
    return dense


def nearest_labels(seeds: DataFrame, dims: Dims, kernel: Callable, where: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """(keys, voxel, ``label``, d) of the nearest seed for the voxels of ``where`` on a small grid, the smallest label on ties. The labels of a volume pass one after
    the other, those of the same rank for all volumes of a block."""
    width, shape = len(keys), tuple(dims)
    rows = seeds.select(*keys, *AXES, F.lit(0.0).alias("d"), F.col(label).cast("long").alias("label"))
    schema = rows.schema

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, of, names in _chunks(batches, width, math.prod(shape)):
            part, of, asked = _asked(part, of, (names.num_rows, *shape), True)
            if not part.num_rows:
                continue
            found, code = np.unique(part.column("label").to_numpy(), return_inverse=True)
            layers, layer = np.unique(of * len(found) + code, return_inverse=True)
            owner = layers // len(found)
            rank = np.arange(len(layers)) - np.searchsorted(owner, owner)
            best, nearest = np.full((names.num_rows, *shape), np.inf), np.zeros((names.num_rows, *shape), np.int64)
            places = _places(part, of)[1:]
            for r in range(int(rank.max()) + 1):
                now = np.flatnonzero(rank == r)
                mine = rank[layer] == r
                dense = np.full((len(now), *shape), np.inf)
                dense[(np.searchsorted(now, layer[mine]), *[x[mine] for x in places])] = 0.0
                dense = sweep_dense(dense, [kernel] * 3, math.inf)
                nearer = dense < best[owner[now]]
                best[owner[now]] = np.where(nearer, dense, best[owner[now]])
                nearest[owner[now]] = np.where(nearer, found[layers[now] % len(found)][:, None, None, None], nearest[owner[now]])
            columns, at = _voxels(asked & np.isfinite(best), names, part.schema)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(best[at]), pa.array(nearest[at])], names=[*names.column_names, *AXES, "d", "label"])

    return _dealt(rows, keys, where).mapInArrow(mapped, schema)
