"""Joins of voxel tables with one-row-per-subject tables.

A voxel table may hold a third of its rows in one subject, so it is never hash-partitioned on the subject alone.
A small side whose row count was measured below the limit is broadcast; a larger one is replicated over salt
buckets and joined on (subject, salt), which spreads a hot subject over as many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..schema import AXES, SUBJECT, VOXEL
from ..session import cut_lineage

#: Row limit under which a measured table is broadcast. A plan may hold a dozen of them on the driver at once, with rows of a few hundred bytes.
BROADCAST_ROWS = 20_000
SALT_BUCKETS = 32


def shuffled_join(rows: DataFrame, other: DataFrame, on: Sequence[str] = VOXEL, how: str = "inner") -> DataFrame:
    """Equi-join of two tables that both grow with the voxels: both are shuffled, none is gathered on the driver.

    Left to itself the planner takes the rows of an explode, and of a checkpoint of one, for as few as those they came from, and
    broadcasts them.
    """
    return rows.join(other.hint("merge"), list(on), how)


def salted_join(rows: DataFrame, small: DataFrame, on: Sequence[str] = (SUBJECT,), how: str = "inner",
                salt_by: Sequence[str] = AXES, buckets: int = SALT_BUCKETS) -> DataFrame:
    """Equi-join in which each key of ``small`` meets its rows in ``buckets`` separate tasks."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"the small side is replicated, so {how!r} would repeat its unmatched rows")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(buckets)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return shuffled_join(salted, copies, [*on, "_salt"], how).drop("_salt")


def attach(rows: DataFrame, small: DataFrame, on: Sequence[str] = (SUBJECT,), how: str = "inner",
           salt_by: Sequence[str] = AXES, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join per-subject values onto rows: broadcast if the measured size allows, salted otherwise."""
    small = cut_lineage(small)
    if small.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(small), list(on), how)
    return salted_join(rows, small, on, how, salt_by)
