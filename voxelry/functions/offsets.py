"""Neighbour offsets and structuring elements."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import product as cartesian
from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import AXES

Offset = tuple[int, int, int]


def neighbours(connectivity: int = 26) -> list[Offset]:
    """Offsets of the 6, 18 or 26 neighbours of a voxel."""
    reach = {6: 1, 18: 2, 26: 3}[connectivity]
    return [o for o in cartesian((-1, 0, 1), repeat=3) if 0 < sum(map(abs, o)) <= reach]


def ellipsoid(radii: tuple[float, float, float], max_radius: int | None = None) -> list[Offset]:
    """Integer points of an axis-aligned ellipsoid; every radius is a whole number of at least one voxel."""
    whole = [int(max(1.0, r if max_radius is None else min(r, max_radius))) for r in radii]
    spans = [range(-r, r + 1) for r in whole]
    return [o for o in cartesian(*spans) if sum((x / r) ** 2 for x, r in zip(o, whole)) <= 1]


def offset_column(offsets: Iterable[Offset]) -> Column:
    """Constant array of offset structs, to be exploded."""
    cells = ", ".join(f"({a}, {b}, {c})" for a, b, c in offsets)
    return F.expr(f"cast(array({cells}) AS array<struct<di: int, dj: int, dk: int>>)")


def spread(df: DataFrame, offsets: Iterable[Offset]) -> DataFrame:
    """One row per (row, offset), moved by the offset. Grid limits are left to the caller."""
    rest = [c for c in df.columns if c not in AXES]
    exploded = df.withColumn("_o", F.explode(offset_column(offsets)))
    return exploded.select(*[(F.col(a) + F.col(f"_o.d{a}")).alias(a) for a in AXES], *rest).select(*df.columns)
