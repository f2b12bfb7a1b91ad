"""Column conventions and table schemas.

Voxel tables are sparse: an intensity row that is absent is zero, a mask row that is absent is outside.
``dims`` is the common grid ``(ni, nj, nk)`` of a conformed cohort.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

SUBJECT = "subject_id"
AXES = ("i", "j", "k")
VOXEL = (SUBJECT, *AXES)

Dims = tuple[int, int, int]

IMAGES = T.StructType([
    T.StructField("subject_id", T.StringType()),
    T.StructField("acq", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("ni", T.IntegerType()),
    T.StructField("nj", T.IntegerType()),
    T.StructField("nk", T.IntegerType()),
    T.StructField("vx", T.DoubleType()),
    T.StructField("vy", T.DoubleType()),
    T.StructField("vz", T.DoubleType()),
    T.StructField("affine", T.ArrayType(T.DoubleType())),
    T.StructField("orient", T.StringType()),
])

VOXELS = T.StructType([
    T.StructField("subject_id", T.StringType()),
    T.StructField("image", T.StringType()),
    T.StructField("i", T.IntegerType()),
    T.StructField("j", T.IntegerType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("v", T.DoubleType()),
])


def voxel_id(dims: Dims) -> Column:
    """Row-major voxel number in a grid of size ``dims``."""
    _, nj, nk = dims
    return ((F.col("i").cast("long") * nj + F.col("j")) * nk + F.col("k"))


def in_grid(dims: Dims) -> Column:
    return F.expr(" AND ".join(f"{a} >= 0 AND {a} < {n}" for a, n in zip(AXES, dims)))


def other_axes(axis: str) -> tuple[str, str]:
    first, second = (a for a in AXES if a != axis)
    return first, second
