"""Model inference and ensembles. The model is a callable of the user, or a factory that loads one a fold."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..schema import AXES, SUBJECT, VOXEL, Dims
from .voxel import apply_mask

#: (dense channels with shape (tile..., channels), fold) -> map with the shape of the tile
Model = Callable[[np.ndarray, int], np.ndarray]
NEAR_ZERO = 0.001
#: Edge of a tile where the receptive field of the model is known.
TILE = 64

#: Networks that this worker holds, by factory and fold.
_HELD: dict[tuple[str, int], Callable[[np.ndarray], np.ndarray]] = {}


class Loaded:
    """A model whose network of each fold is loaded by ``load(fold)`` once in every Python worker and kept for all tiles and tasks that it runs.

    ``load`` returns a function from dense channels to a map; it is what is shipped to the workers, not the weights.
    """

    def __init__(self, load: Callable[[int], Callable[[np.ndarray], np.ndarray]]):
        self.load, self.name = load, uuid.uuid4().hex

    def __call__(self, dense: np.ndarray, fold: int) -> np.ndarray:
        key = (self.name, fold)
        if key not in _HELD:
            for old in [k for k in _HELD if k[0] != self.name]:  # the networks of an earlier run
                del _HELD[old]
            _HELD[key] = self.load(fold)
        return _HELD[key](dense)


def predict_volumes(channels: DataFrame, model: Model, n_folds: int, dims: Dims, tile: Dims | None = None,
                    halo: int = 0, near_zero: float = NEAR_ZERO, subjects: DataFrame | None = None, field: int | None = None) -> DataFrame:
    """Apply a model per fold; rows (subject, fold, voxel, v), values below ``near_zero`` dropped.

    ``channels`` has columns c1, c2, …. Each step sees one tile of the grid plus ``halo`` voxels around it, as one packed row. With ``field``, the voxels along an axis
    that a voxel of the map depends on, tiles of 64 voxels with half the field around them give the same map as the whole grid; without it the model may look at everything,
    and the tile is the grid. Every tile of every subject (those of ``subjects``, by default those with a voxel) is given to the model, also one without voxels. The
    voxels of a tile are shuffled once for all folds.
    """
    names = [c for c in channels.columns if c not in VOXEL]
    if field is not None:
        tile, halo = tile or tuple(min(TILE, n) for n in dims), max(halo, field // 2)
    tile = tile or dims
    home = [f"_t{a}" for a in AXES]
    rows = channels
    for a, t, size, n in zip(AXES, home, tile, dims):
        first, last = F.floor((F.col(a) - halo) / size), F.floor((F.col(a) + halo) / size)
        rows = rows.withColumn(t, F.explode(F.sequence(F.greatest(first, F.lit(0)), F.least(last, F.lit((n - 1) // size)))))
    everyone = (channels if subjects is None else subjects).select(SUBJECT).distinct()
    for t, size, n in zip(home, tile, dims):
        everyone = everyone.withColumn(t, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((n - 1) // size).cast("bigint"))))
    rows = rows.unionByName(everyone, allowMissingColumns=True)
    voxel = F.when(F.col(AXES[0]).isNotNull(), F.struct(*[F.col(a).cast("int").alias(a) for a in AXES], *[F.col(c).cast("double").alias(c) for c in names]))
    packed = rows.groupBy(SUBJECT, *home).agg(F.collect_list(voxel).alias("_c"))  # a list leaves nulls out
    packed = packed.select(SUBJECT, *home, *[F.col(f"_c.{c}").alias(f"_{c}") for c in (*AXES, *names)])
    schema = T.StructType([channels.schema[SUBJECT], T.StructField("fold", T.IntegerType()),
                           *[T.StructField(a, T.IntegerType()) for a in AXES], T.StructField("v", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                place = [batch.column(1 + x)[n].as_py() for x in range(3)]
                start = [max(0, p * s - halo) for p, s in zip(place, tile)]
                stop = [min(n_, (p + 1) * s + halo) for p, s, n_ in zip(place, tile, dims)]
                dense = np.zeros([b - a for a, b in zip(start, stop)] + [len(names)], dtype=np.float32)
                cells = [batch.column(4 + x)[n].values.to_numpy() for x in range(3 + len(names))]
                at = tuple(c - s for c, s in zip(cells[:3], start))
                for c, values in enumerate(cells[3:]):
                    dense[(*at, c)] = values
                for fold in range(n_folds):
                    out = np.asarray(model(dense, fold), dtype=float)
                    spots = np.argwhere(out >= near_zero)
                    own = np.all([(spots[:, x] + start[x]) // s == p for x, (p, s) in enumerate(zip(place, tile))], axis=0)
                    spots = spots[own]
                    if len(spots):
                        arrays = [pa.array((spots[:, x] + start[x]).astype(np.int32)) for x in range(3)]
                        who = batch.column(0).slice(n, 1).take(pa.array(np.zeros(len(spots), np.int64)))
                        yield pa.RecordBatch.from_arrays([who, pa.array(np.full(len(spots), fold, np.int32)), *arrays, pa.array(out[tuple(spots.T)])],
                                                         names=[SUBJECT, "fold", *AXES, "v"])

    return packed.mapInArrow(run, schema)


def fold_ensemble(folds: DataFrame, n_folds: int, mask: DataFrame | None = None) -> DataFrame:
    """Mean map of the folds (absent rows are zeros, so the sum is divided by the number of folds), cut to the mask."""
    mean = folds.groupBy(*VOXEL).agg((F.sum("v") / n_folds).alias("v"))
    return mean if mask is None else apply_mask(mean, mask)


def hilo_ensemble(folds: DataFrame, n_folds: int, threshold: float) -> DataFrame:
    """Union of the thresholded means of the first and the second half of the folds."""
    half = n_folds // 2
    low, high = F.col("fold") < half, F.col("fold") >= half
    means = folds.groupBy(*VOXEL).agg(F.sum(F.when(low, F.col("v"))).alias("_l"), F.sum(F.when(high, F.col("v"))).alias("_h"))
    over = F.lit(False)
    for column, count in (("_l", half), ("_h", n_folds - half)):
        if count:
            over = over | F.coalesce(F.col(column) / count > threshold, F.lit(False))
    return means.filter(over).select(*VOXEL)


def binarise_prediction(folds: DataFrame, threshold: float, hook: Callable[[DataFrame, float], DataFrame] | None = None) -> DataFrame:
    """Voxels of a prediction: a plain threshold, or whatever ``hook(folds, threshold)`` returns."""
    return folds.filter(F.col("v") > threshold).select(*VOXEL) if hook is None else hook(folds, threshold).select(*VOXEL)


