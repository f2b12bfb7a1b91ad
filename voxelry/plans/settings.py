"""Parameters of a cohort run and their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..schema import Dims


@dataclass(frozen=True)
class Settings:
    percentile: float = 99.0
    mask_threshold: float = 0.5
    #: probability above which a voxel belongs to a biomarker, and smallest cluster in voxels
    thresholds: dict[str, float] = field(default_factory=lambda: {"pvs": 0.5, "wmh": 0.2, "cmb": 0.5, "lac": 0.2})
    min_sizes: dict[str, int] = field(default_factory=lambda: {"pvs": 5, "wmh": 1, "cmb": 1, "lac": 3})
    conformed_dims: Dims = (256, 256, 256)
    cropped_dims: Dims = (160, 214, 176)
    voxel_size: tuple[float, float, float] = (1.0, 1.0, 1.0)
    tolerance: float = 0.0
    outside_ratio: float = 0.25
    min_mask_volume: float = 100.0
    #: what lies so many mm around a kept part of a mask stays with it
    mask_growth: float = 5.0
    island_size: int = 100
    crop_margin: int = 5

    def threshold(self, biomarker: str, common: float | None = None) -> float:
        """One common threshold overrides those of the biomarkers."""
        return self.thresholds[biomarker] if common is None else common
