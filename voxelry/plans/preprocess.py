"""Preprocessing of scans: conform, mask, crop, normalise."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import matrix
from ..operators import cohort, components, geometry, models, morphology, parcellation, stats, voxel
from ..schema import SUBJECT, VOXEL, Dims
from ..session import cut_lineage
from .settings import Settings


@dataclass
class Prepared:
    """Tables of one preprocessing stage; ``status`` has a row for every participant, also for one whose mask failed."""

    images: DataFrame
    image: DataFrame
    mask: DataFrame
    box: DataFrame
    qc: DataFrame
    status: DataFrame | None = None


def rescaled_affine(affine: Column, dims: list[Column], old: list[Column], new: list[Column], out_dims: Dims) -> Column:
    """Affine with new voxel sizes and grid that keeps the middle voxel where it is."""
    m = matrix.cells(affine, 4)
    middle = [F.floor((n - 1) / 2) for n in dims]
    out_middle = [(n - 1) // 2 for n in out_dims]
    rows = []
    for r in range(3):
        cols = [m[r][c] * new[c] / old[c] for c in range(3)]
        shift = m[r][3]
        for c in range(3):
            shift = shift + m[r][c] * middle[c] - cols[c] * out_middle[c]
        rows.append([*cols, shift])
    return matrix.pack([*rows, m[3]])


def common_dims(images: DataFrame) -> Dims:
    """The grid that holds every scan; each keeps its own limits inside it."""
    r = images.agg(F.max("ni"), F.max("nj"), F.max("nk")).first()
    return int(r[0]), int(r[1]), int(r[2])


def conform(images: DataFrame, voxels: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Scans on a common grid: checked affine, voxel-size policy, cubic interpolation clamped to the source range, RAS.

    Scans that keep all their voxel sizes are moved without interpolation.
    """
    out = settings.conformed_dims
    checked = geometry.check_affine(images, stats.centre_of_mass(voxels, weighted=True))
    policy = voxel.voxel_size_policy(checked, settings.voxel_size, out, settings.tolerance).select(
        SUBJECT, "out_vx", "out_vy", "out_vz", "interpolation_order")
    rows = checked.join(policy, SUBJECT)
    target = rescaled_affine(F.col("affine"), [F.col(n) for n in ("ni", "nj", "nk")], [F.col(v) for v in ("vx", "vy", "vz")],
                             [F.col(f"out_{v}") for v in ("vx", "vy", "vz")], out)
    rows = cut_lineage(rows.withColumn("_target", target))
    moves = cut_lineage(rows.select(SUBJECT, "interpolation_order", geometry.grid_transform(F.col("affine"), F.col("_target")).alias("affine")))
    source = common_dims(images)
    parts = []
    for order in [r[0] for r in moves.select("interpolation_order").distinct().collect()]:  # 0, 3 or both
        chosen = moves.filter(F.col("interpolation_order") == order)
        own = voxel.attach(voxels, chosen.select(SUBJECT), how="left_semi") if order else voxels
        moved = geometry.resample(own, chosen, out, source, order, grids=images).select(*VOXEL, "v")
        parts.append(voxel.clamp_to_source_range(moved, own, source, images) if order else moved)
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    header = rows.select(SUBJECT, *[F.lit(n).alias(c) for c, n in zip(("ni", "nj", "nk"), out)],
                         *[F.col(f"out_{v}").alias(v) for v in ("vx", "vy", "vz")], F.col("_target").alias("affine"), "orient", "status")
    return voxel.reorient_images(header), voxel.reorient(both, header)


def mask_on_grid(mask: DataFrame, mask_images: DataFrame, images: DataFrame, settings: Settings, dims: Dims,
                 world: DataFrame | None = None) -> components.Selection:
    """A mask map on the grid of other scans: nearest voxel, strictly above the threshold, small clusters dropped, what lies
    within ``settings.mask_growth`` of a kept one brought back.

    ``world`` (subject_id, transform) maps the space of the target scans to that of the mask.
    """
    pair = mask_images.select(SUBJECT, F.col("affine").alias("_s")).join(images.select(SUBJECT, F.col("affine").alias("_t")), SUBJECT)
    through = None
    if world is not None:
        pair, through = pair.join(world.select(SUBJECT, "transform"), SUBJECT), F.col("transform")
    moves = pair.select(SUBJECT, geometry.grid_transform(F.col("_s"), F.col("_t"), through).alias("affine"))
    near = geometry.resample_nearest(mask, moves, dims, common_dims(mask_images), grids=mask_images)
    binary = voxel.threshold(near, settings.mask_threshold, "+", True).select(*VOXEL)
    return components.check_clusters(binary, dims, "keep_all", settings.min_mask_volume / math.prod(settings.voxel_size),
                                     morphology.radii_in_voxels(settings.mask_growth, settings.voxel_size), subjects=images)


def crop_and_normalise(images: DataFrame, image: DataFrame, mask: DataFrame, settings: Settings, name: str = "main",
                       transforms: dict[str, DataFrame] | None = None, status: DataFrame | None = None) -> Prepared:
    """Crop around the mask, normalise inside it, measure the quality."""
    dims = settings.cropped_dims
    box = cut_lineage(voxel.crop_box(images, dims, mask, margin=settings.crop_margin))
    cropped, small = voxel.crop_voxels(image.select(*VOXEL, "v"), box), cut_lineage(voxel.crop_voxels(mask, box))
    normal = cut_lineage(voxel.normalise(cropped, small, settings.percentile))
    header = (images.drop("affine", "ni", "nj", "nk").join(box.select(SUBJECT, "affine"), SUBJECT)
              .withColumns({c: F.lit(n) for c, n in zip(("ni", "nj", "nk"), dims)}))
    return Prepared(header, normal, small, box, cohort.qc_row(small, {name: normal}, dims, transforms), status)


def preprocess(images: DataFrame, voxels: DataFrame, mask: DataFrame, mask_images: DataFrame, settings: Settings) -> Prepared:
    """The main scan of every participant with a given brain mask map."""
    header, conformed = conform(images, voxels, settings)
    header, conformed = cut_lineage(header), cut_lineage(conformed)
    brain, status = mask_on_grid(mask, mask_images, header, settings, settings.conformed_dims)
    return crop_and_normalise(header, conformed, cut_lineage(brain), settings, status=status)


def preprocess_secondary(images: DataFrame, voxels: DataFrame, main: Prepared, settings: Settings,
                         transforms: DataFrame | None = None, inverse: bool = False) -> DataFrame:
    """Another scan of the same participants on the cropped grid of the main one, masked and normalised.

    ``transforms`` (subject_id, transform: 4x4) maps the space of the main scan to that of this one; without it the
    scans are already aligned. ``inverse`` is for a T2 that stands in for a T1.
    """
    pair = images.select(SUBJECT, F.col("affine").alias("_s")).join(main.images.select(SUBJECT, F.col("affine").alias("_t")), SUBJECT)
    through = None
    if transforms is not None:
        pair, through = pair.join(transforms.select(SUBJECT, "transform"), SUBJECT), F.col("transform")
    moves = pair.select(SUBJECT, geometry.grid_transform(F.col("_s"), F.col("_t"), through).alias("affine"))
    source = common_dims(images)
    moved = voxel.clamp_to_source_range(geometry.resample(voxels, moves, settings.cropped_dims, source, 3, grids=images), voxels, source, images)
    return voxel.normalise(voxel.apply_mask(moved, main.mask), main.mask, settings.percentile, inverse)


def preprocess_swi(images: DataFrame, voxels: DataFrame, mask: DataFrame, mask_images: DataFrame, transforms: DataFrame,
                   settings: Settings) -> Prepared:
    """A scan that keeps its own grid: the mask of the main scan comes over through the inverse of the known transform
    (main space to this space), then crop and normalise."""
    header, conformed = conform(images, voxels, settings)
    header, conformed = cut_lineage(header), cut_lineage(conformed)
    back = transforms.select(SUBJECT, matrix.inverse_affine(F.col("transform")).alias("transform"))
    brain, status = mask_on_grid(mask, mask_images, header, settings, settings.conformed_dims, back)
    return crop_and_normalise(header, conformed, cut_lineage(brain), settings, "swi", status=status)


def two_pass_mask(images: DataFrame, image: DataFrame, model: models.Model, n_folds: int, settings: Settings,
                  opening: int = 3, min_volume: float = 600_000.0) -> components.Selection:
    """Brain mask by a model in two passes: a rough mask of the whole conformed image (opened, biggest cluster) gives the
    crop and the normalisation of the second pass, whose result is put back on the conformed grid. The status tells for every participant
    of ``images`` whether the rough mask passed; one that failed has no mask."""
    dims, crop = settings.conformed_dims, settings.cropped_dims
    volume = math.prod(settings.voxel_size)

    def passed(channel: DataFrame, grid: Dims) -> DataFrame:
        maps = models.predict_volumes(voxel.stack_channels([channel]), model, n_folds, grid)
        return voxel.threshold(models.fold_ensemble(maps, n_folds), settings.mask_threshold, "+", True).select(*VOXEL)

    radii = morphology.opening_radii(opening, settings.voxel_size, dims)
    rough = morphology.open_box(passed(image, dims), radii, dims)
    grown = morphology.radii_in_voxels(settings.mask_growth, settings.voxel_size)
    checked = components.check_clusters(rough, dims, "size", min_volume / volume, grown, subjects=images)
    rough = cut_lineage(checked.voxels.select(*VOXEL))
    box = cut_lineage(voxel.crop_box(images, crop, rough, margin=settings.crop_margin))
    small = voxel.crop_voxels(rough, box)
    normal = voxel.normalise(voxel.crop_voxels(image.select(*VOXEL, "v"), box), small, settings.percentile)
    return components.Selection(voxel.uncrop_voxels(passed(normal, crop), box, images), checked.status)


def brain_segmentation(mode: str, dims: Dims, settings: Settings, mask: DataFrame | None = None, image: DataFrame | None = None,
                       labels: DataFrame | None = None, ignore: tuple[int, ...] = ()) -> tuple[DataFrame | None, DataFrame]:
    """Labels and mask of a run: a given ``mask``, a ``premasked`` scan, a FreeSurfer-like parcellation (``fs``: cleaned
    of islands and turned into the derived one), or a ``custom`` parcellation that is used as it is."""
    if mode == "mask":
        return None, mask.select(*VOXEL)
    if mode == "premasked":
        return None, image.filter("v > 0").select(*VOXEL)
    if mode == "custom":
        return labels, (mask if mask is not None else labels.filter("label > 0")).select(*VOXEL)
    if mode != "fs":
        raise ValueError(mode)
    clean = parcellation.remove_islands(labels, dims, settings.island_size, ignore).filter("label <> 0").select(*VOXEL, "label")
    clean = cut_lineage(clean)
    return cut_lineage(parcellation.lobar_wm_parcellation(clean, dims)), clean.select(*VOXEL)
