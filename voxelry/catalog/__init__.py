"""Registered queries over the driver's tables, each with a SQL check where SQL can express it."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("voxel_queries", "geometry_queries", "neighbour_queries", "parcellation_queries", "cluster_queries",
            "cohort_queries", "source_queries", "large_queries", "plan_queries", "preprocess_queries")


def load():
    """Import every family and return the registry."""
    from . import registry

    for family in FAMILIES:
        import_module(f"{__name__}.{family}")
    return registry
