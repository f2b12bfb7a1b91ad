"""Components of a graph of links: union-find inside tasks, then alternating star steps until only stars are left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import staged

#: Links that a task joins at a time.
CHUNK = 1 << 20


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes joined by the links, but for the smallest of each component, and that smallest node."""
    names, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[:len(u)], place[len(u):]
    least = np.arange(len(names))
    while True:
        now = least.copy()
        np.minimum.at(now, a, least[b])
        np.minimum.at(now, b, least[a])
        np.minimum.at(now, least[a], now[a])
        np.minimum.at(now, least[b], now[b])
        now = now[now]
        if (now == least).all():
            break
        least = now
    moved = np.flatnonzero(least != np.arange(len(names)))
    return names[moved], names[least[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task -> stars, a bounded number of links at a time."""
    held, count = [], 0

    def joined() -> pa.RecordBatch:
        u, v = stars(*(np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= CHUNK:
            yield joined()
            held, count = [], 0
    if count:
        yield joined()


def _apart(edges: DataFrame) -> bool:
    """Whether some node has two smaller members, or is a member and a centre at once: then the edges are not stars yet."""
    ends = edges.select(F.col("u").alias("k"), F.lit(1).alias("n"), F.lit(0).alias("c")).unionByName(
        edges.select(F.col("v").alias("k"), F.lit(0).alias("n"), F.lit(1).alias("c")))
    return not ends.groupBy("k").agg(F.sum("n").alias("n"), F.max("c").alias("c")).filter("n > 1 OR n = 1 AND c = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Every node u that is not the smallest of its component, with that smallest node v; ``edges``: links (u, v) of bigints, in any order and number.

    A node of very many links meets them in a join whose partition the planner splits, and in aggregates that combine before the shuffle. Rounds are written to
    the shared folder.
    """
    edges = staged(edges.select("u", "v").filter("u <> v").mapInArrow(_contract, "u bigint, v bigint").distinct(), "stars")
    while _apart(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = staged(small.select("e.*").filter("u > v").mapInArrow(_contract, "u bigint, v bigint").distinct(), "stars")
    return edges
