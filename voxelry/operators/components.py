"""Connected components of voxel tables.

Bricks of ``brick``^3 voxels are labelled inside tasks (a brick holds at most 32 768 rows, whatever the size of a
subject). Only labels that touch across a brick face become edges of a graph, and that much smaller graph is
contracted by alternating star steps, each a min-aggregate and a salted join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.joins import salted_join, shuffled_join
from ..functions.offsets import neighbours, offset_column
from ..schema import AXES, SUBJECT, Dims, voxel_id
from ..session import cut_lineage, staged

BRICK = 32
#: Tasks over which the clusters of one subject are spread when they meet a per-subject row.
CLUSTER_SALT = 8


def merge_pairs(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of ``n`` nodes."""
    root = np.arange(n)
    while a.size:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low < high
        a, b = a[open_], b[open_]
        np.minimum.at(root, high[open_], low[open_])
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
    return root


#: Turns the voxels of some bricks, their order by place and the touching pairs (positions in that order) into new values of some of their fields.
Assign = Callable[[pa.StructArray, np.ndarray, np.ndarray, np.ndarray], dict[str, pa.Array]]


def _one_label(equal: str | None) -> Assign:
    def assign(voxels: pa.StructArray, order: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict[str, pa.Array]:
        if equal:
            values = voxels.field(equal).to_numpy(zero_copy_only=False)[order]
            same = values[a] == values[b]
            a, b = a[same], b[same]
        part = voxels.field("part_id").to_numpy()
        out = np.empty_like(part)
        out[order] = part[order][merge_pairs(len(order), a, b)]
        return {"part_id": pa.array(out)}

    return assign


def _merge_tree(voxels: pa.StructArray, order: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict[str, pa.Array]:
    """``chain``: the smallest voxel of the component at every level from 1 up to the voxel's own. Pairs are united from the highest level down, each once."""
    n, level = len(order), voxels.field("level").to_numpy()[order]
    part = voxels.field("part_id").to_numpy()[order]
    weight = np.minimum(level[a], level[b])
    top = int(level.max(initial=0))
    roots, root = np.zeros((n, top), np.int64), np.arange(n)
    for t in range(top, 0, -1):
        now = weight == t
        root = merge_pairs(n, root[a[now]], root[b[now]])[root]
        roots[:, t - 1] = part[root]
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    roots, level = roots[back], level[back]
    kept = np.arange(1, top + 1)[None, :] <= level[:, None]
    return {"chain": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(level)]).astype(np.int32), roots[kept])}


#: Voxels that a task labels at a time, in whole bricks.
VOXELS = 1 << 18


def _brick_labeller(connectivity: int, brick: int, assign: Assign, width: int):
    """Labels voxel rows that come brick by brick, some bricks at a time; the first ``width`` columns name a brick."""
    side = brick + 2
    steps = [(p * side + q) * side + r for p, q, r in neighbours(connectivity) if (p, q, r) > (0, 0, 0)]

    def label(voxels: pa.StructArray, owner: np.ndarray) -> dict[str, pa.Array]:
        x, y, z = ((voxels.field(a).to_numpy() % brick) + 1 for a in AXES)
        # position in a padded brick, so a step over a face never meets a voxel
        code = ((owner * side + x) * side + y) * side + z
        order = np.argsort(code)
        code, n = code[order], len(code)
        starts, ends = [], []
        for step in steps:
            at = np.searchsorted(code, code + step)
            met = np.flatnonzero(code[np.minimum(at, n - 1)] == code + step)
            starts.append(met)
            ends.append(at[met])
        return assign(voxels, order, np.concatenate(starts), np.concatenate(ends))

    def bricks(rows: pa.Table) -> np.ndarray:
        """Number of the brick of each row, from 0 on."""
        new = np.zeros(rows.num_rows, bool)
        for column in rows.columns[:width]:
            new[1:] |= np.diff(column.combine_chunks().dictionary_encode("encode").indices.to_numpy()) != 0
        return np.cumsum(new)

    def labelled(rows: pa.Table, owner: np.ndarray) -> pa.RecordBatch:
        columns, names = [c.combine_chunks() for c in rows.columns], rows.column_names
        found = label(pa.StructArray.from_arrays(columns[width:], names=names[width:]), owner)
        return pa.RecordBatch.from_arrays([found.get(n, c) for n, c in zip(names, columns)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count >= VOXELS:
                rows = pa.Table.from_batches(held)
                owner = bricks(rows)
                # the last brick may go on in the next batch
                whole = int(np.searchsorted(owner, owner[-1]))
                if whole:
                    yield labelled(rows.slice(0, whole), owner[:whole])
                    held, count = rows.slice(whole).to_batches(), count - whole
        if count:
            rows = pa.Table.from_batches(held)
            yield labelled(rows, bricks(rows))

    return run


def _in_bricks(rows: DataFrame, by: Sequence[str], connectivity: int, brick: int, assign: Assign) -> DataFrame:
    """``rows`` with the fields that ``assign`` gives anew; the voxels of a brick come one after the other, as rows, so that a batch is bounded by
    its rows and not by the size of bricks."""
    home = [F.floor(F.col(a) / brick).cast("int").alias(f"_b{a}") for a in AXES]
    keys = [*by, *[f"_b{a}" for a in AXES]]
    flat = rows.select(*by, *home, *[c for c in rows.columns if c not in by])
    flat = flat.repartition(*keys).sortWithinPartitions(*keys)
    return flat.mapInArrow(_brick_labeller(connectivity, brick, assign, len(keys)), flat.schema).select(*rows.columns)


#: Edges that a task unites at a time.
CHUNK = 1 << 20


def _united(by: Sequence[str]):
    """Edges of a task -> stars of what they join there, a bounded number of edges at a time."""
    def stars(edges: pa.Table) -> pa.RecordBatch:
        code = np.zeros(edges.num_rows, np.int64)
        for c in by:
            coded = edges.column(c).combine_chunks().dictionary_encode()
            code = np.unique(code * len(coded.dictionary) + coded.indices.to_numpy(), return_inverse=True)[1]
        u, v = (edges.column(c).to_numpy() for c in "uv")
        ids, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        # nodes of one key are numbered in the order of their ids
        nodes, first, node = np.unique(np.tile(code, 2) * len(ids) + place, return_index=True, return_inverse=True)
        root = merge_pairs(len(nodes), node[:len(u)], node[len(u):])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        rows = edges.take(pa.array(first[moved] % len(u)))
        found = {"u": ids[nodes[moved] % len(ids)], "v": ids[nodes[root[moved]] % len(ids)]}
        arrays = [pa.array(found[n], pa.int64()) if n in found else rows.column(n).combine_chunks() for n in edges.column_names]
        return pa.RecordBatch.from_arrays(arrays, names=edges.column_names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count >= CHUNK:
                yield stars(pa.Table.from_batches(held))
                held, count = [], 0
        if count:
            yield stars(pa.Table.from_batches(held))

    return run


def contract(edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stars of a graph given as edges (``by``, u, v) with u > v: every node u with its smallest member v.

    Edges are united inside tasks before every round of star steps, so that a round joins what partitions hold and not single edges; a graph whose tasks leave stars takes
    none. A node of very many edges is combined before the shuffle of the aggregates, and the planner splits its partition in the joins.
    """
    by = list(by)
    schema = edges.select(*by, "u", "v").schema

    def settled(df: DataFrame) -> DataFrame:
        return staged(df.select(*by, "u", "v").mapInArrow(_united(by), schema).distinct(), "stars")

    edges = settled(edges)
    while True:
        # a node with two smaller members, or one that is a member and a centre: not stars yet
        ends = edges.select(*by, F.col("u").alias("k"), F.lit(1).alias("n"), F.lit(0).alias("c")).unionByName(
            edges.select(*by, F.col("v").alias("k"), F.lit(0).alias("n"), F.lit(1).alias("c")))
        if ends.groupBy(*by, "k").agg(F.sum("n").alias("n"), F.max("c").alias("c")).filter("n > 1 OR n = 1 AND c = 1").isEmpty():
            return edges
        both = edges.unionByName(edges.select(*by, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*by, "u").agg(F.least("u", F.min("v")).alias("m"))
        large = shuffled_join(both, least, [*by, "u"]).filter("v > u").select(*by, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        floor = large.groupBy(*by, "u").agg(F.min("v").alias("m"))
        small = shuffled_join(large, floor, [*by, "u"])
        edges = settled(small.select(*by, F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("_e"))
                        .select(*by, "_e.u", "_e.v").filter("u > v"))


def _across_faces(rows: DataFrame, carried: Sequence[str], by: Sequence[str], connectivity: int, brick: int) -> DataFrame:
    """Pairs of touching voxels of different bricks: ``by``, and the ``carried`` columns of both with the endings _a and _b."""
    faces = rows.filter(" OR ".join(f"{a} % {brick} IN (0, {brick - 1})" for a in AXES))
    half = [o for o in neighbours(connectivity) if o > (0, 0, 0)]
    ending = lambda e: [F.col(c).alias(f"{c}_{e}") for c in carried]
    outgoing = (faces.select(*by, *AXES, *ending("a"), F.explode(offset_column(half)).alias("_o"))
                .filter(" OR ".join(f"floor(({a} + _o.d{a}) / {brick}) <> floor({a} / {brick})" for a in AXES))
                .select(*by, *[(F.col(a) + F.col(f"_o.d{a}")).alias(a) for a in AXES], *[f"{c}_a" for c in carried]))
    return shuffled_join(outgoing, faces.select(*by, *AXES, *ending("b")), [*by, *AXES])


def component_chains(df: DataFrame, dims: Dims, connectivity: int = 26, by: Sequence[str] = (SUBJECT,), brick: int = BRICK) -> tuple[DataFrame, DataFrame | None]:
    """Components at many levels from one labelling: voxels (``by``, voxel, level from 1 on) -> their ``chain``, and ``stars`` of it.

    Inside a brick the voxels are united from the highest level down into a tree of components; element t of ``chain`` (an array as long as the voxel's level)
    names its part of the component of all voxels of level t or more. Parts that meet over faces of bricks are joined by ``stars`` (``by``, level, u, v: part u belongs to
    component v; other parts are their own), None where the grid is one brick. A threshold is a cut through the chains, and costs no further labelling.
    """
    by = list(by)
    own = df.select(*by, *AXES, F.col("level").cast("long").alias("level"), voxel_id(dims).alias("part_id"), F.array(voxel_id(dims)).alias("chain"))
    local = _in_bricks(own, by, connectivity, brick, _merge_tree).drop("part_id")
    if all(n <= brick for n in dims):
        return local, None
    local = cut_lineage(local)
    met = _across_faces(local, ["chain"], by, connectivity, brick)
    both = F.arrays_zip(F.col("chain_a"), F.col("chain_b"))
    pairs = (met.select(*by, F.posexplode(both).alias("level", "p")).filter("p.chain_a IS NOT NULL AND p.chain_b IS NOT NULL")
             .select(*by, (F.col("level") + 1).cast("long").alias("level"), F.greatest("p.chain_a", "p.chain_b").alias("u"), F.least("p.chain_a", "p.chain_b").alias("v")))
    return local, contract(pairs.distinct(), [*by, "level"])


def label_components(df: DataFrame, dims: Dims, connectivity: int = 26, equal: str | None = None,
                     by: Sequence[str] = (SUBJECT,), brick: int = BRICK) -> DataFrame:
    """``df`` with ``cluster_id``, the smallest voxel number of the component, and ``part_id``, its part in one brick.

    With ``equal`` two neighbours belong together only if that column agrees.
    """
    by = list(by)
    local = _in_bricks(df.withColumn("part_id", voxel_id(dims)), by, connectivity, brick, _one_label(equal))
    if all(n <= brick for n in dims):
        return local.withColumn("cluster_id", F.col("part_id"))
    local = cut_lineage(local)
    same = [equal] if equal else []
    met = _across_faces(local, ["part_id", *same], by, connectivity, brick)
    if equal:
        met = met.filter(F.col(f"{equal}_a") == F.col(f"{equal}_b"))
    edges = met.select(*by, F.greatest("part_id_a", "part_id_b").alias("u"), F.least("part_id_a", "part_id_b").alias("v")).distinct()
    stars = contract(edges, by).select(*by, F.col("u").alias("part_id"), F.col("v").alias("_root"))
    # a part has at most brick^3 rows, so this join has no hot key however large a component is
    joined = shuffled_join(local, stars, [*by, "part_id"], "left")
    return joined.withColumn("cluster_id", F.coalesce("_root", "part_id")).select(*df.columns, "part_id", "cluster_id")


def attach_to_clusters(voxels: DataFrame, per_cluster: DataFrame, by: Sequence[str] = (SUBJECT,),
                       how: str = "inner") -> DataFrame:
    """Bring per-cluster columns onto labelled voxels through their parts, so a giant cluster is no hot key."""
    by = list(by)
    parts = voxels.select(*by, "part_id", "cluster_id").distinct()
    verdict = shuffled_join(parts, per_cluster, [*by, "cluster_id"], how).drop("cluster_id")
    return shuffled_join(voxels, verdict, [*by, "part_id"], "left" if how == "left" else "inner")


def census(voxels: DataFrame, by: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """One row per cluster with its voxel count."""
    return voxels.groupBy(*by, "cluster_id").agg(F.count("*").alias("cluster_size"))


def renumber(clusters: DataFrame, by: Sequence[str] = (SUBJECT,), block: int = 65_536) -> DataFrame:
    """``new_id`` = 1..n per subject in ascending ``cluster_id``.

    Ranks are counted inside blocks of voxel numbers and shifted by a running total over blocks, so the clusters of
    one subject never have to be sorted in one task.
    """
    by = list(by)
    rows = clusters.withColumn("_block", F.floor(F.col("cluster_id") / block))
    totals = rows.groupBy(*by, "_block").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*by).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    shift = totals.select(*by, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = W.partitionBy(*by, "_block").orderBy("cluster_id")
    return (shuffled_join(rows, shift, [*by, "_block"])
            .withColumn("new_id", F.col("_shift") + F.row_number().over(inside)).drop("_block", "_shift"))


def outside_share(voxels: DataFrame, brain: DataFrame, by: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Voxel count of each cluster and the number of its voxels outside the brain mask."""
    inside = brain.select(SUBJECT, *AXES).distinct().withColumn("_in", F.lit(1))
    return (shuffled_join(voxels, inside, how="left").groupBy(*by, "cluster_id")
            .agg(F.count("*").alias("cluster_size"), (F.count("*") - F.count("_in")).alias("n_outside")))


def drop_outside_clusters(voxels: DataFrame, brain: DataFrame, ratio: float = 0.25,
                          by: Sequence[str] = (SUBJECT,)) -> DataFrame:
    """Remove clusters with more than ``ratio`` of their voxels outside the brain mask."""
    kept = outside_share(voxels, brain, by).filter(F.col("n_outside") <= ratio * F.col("cluster_size"))
    return attach_to_clusters(voxels, kept.select(*by, "cluster_id"), by)


def label_clusters(prob: DataFrame, threshold: float, dims: Dims, min_size: int = 1, brain: DataFrame | None = None,
                   outside_ratio: float = 0.25, connectivity: int = 26, inclusive: bool = False,
                   by: Sequence[str] = (SUBJECT,), brick: int = BRICK) -> DataFrame:
    """Labelled voxels of a probability map: strictly above the threshold, clusters of at least ``min_size`` voxels,
    not mostly outside the brain. ``new_id`` numbers the survivors from 1."""
    by = list(by)
    level = F.col("v") >= threshold if inclusive else F.col("v") > threshold
    rows = prob.filter(level).select(*dict.fromkeys([*by, SUBJECT, *AXES]))
    labelled = label_components(rows, dims, connectivity, by=by, brick=brick)
    sizes = census(labelled, by) if brain is None else (
        outside_share(labelled, brain, by).filter(F.col("n_outside") <= outside_ratio * F.col("cluster_size")).drop("n_outside"))
    kept = renumber(sizes.filter(F.col("cluster_size") >= min_size), by)
    return attach_to_clusters(labelled, kept, by)


class Selection(NamedTuple):
    """``voxels`` of the kept clusters (subjects whose status is not ok have none) and one row of ``status`` per subject."""

    voxels: DataFrame
    status: DataFrame


def select_cluster(mask: DataFrame, dims: Dims, keep: str = "size", min_voxels: float = 0.0,
                   dilate: tuple[int, int, int] | None = None, brick: int = BRICK) -> DataFrame:
    """Voxels of ``check_clusters``, with their ``status``."""
    return check_clusters(mask, dims, keep, min_voxels, dilate, brick).voxels.withColumn("status", F.lit("ok"))


def check_clusters(mask: DataFrame, dims: Dims, keep: str = "size", min_voxels: float = 0.0, dilate: tuple[int, int, int] | None = None,
                   brick: int = BRICK, subjects: DataFrame | None = None) -> Selection:
    """The main cluster of every mask, and for every subject whether its mask passed.

    ``keep`` is ``size`` (biggest, which has to be the topmost too), ``top`` (reaching highest, then biggest) or
    ``keep_all``. Clusters up to ``min_voxels`` are dropped unless the mask has one cluster only. The kept clusters are
    dilated by the box radii ``dilate`` and cut with the mask again, so thin attached structures stay. A subject that fails
    loses its voxels but never its row of ``status`` (subject_id, n_clusters, n_eligible, status); those of ``subjects`` without any
    voxel are told too.
    """
    from .morphology import dilate_box

    if keep not in ("size", "top", "keep_all"):
        raise ValueError(keep)
    labelled = cut_lineage(label_components(mask.select(SUBJECT, *AXES), dims, brick=brick))
    sizes = labelled.groupBy(SUBJECT, "cluster_id").agg(F.count("*").alias("n"), F.max("k").alias("top"))
    # order by size with one aggregate per subject instead of a sort of all clusters
    counts = sizes.groupBy(SUBJECT).agg(F.count("*").alias("n_clusters"))
    eligible = salted_join(sizes, counts, salt_by=["cluster_id"], buckets=CLUSTER_SALT).withColumn(
        "_ok", (F.col("n_clusters") == 1) | (F.col("n") > min_voxels))
    verdict = eligible.groupBy(SUBJECT).agg(
        F.first("n_clusters").alias("n_clusters"), F.count_if("_ok").alias("n_eligible"),
        F.max_by("cluster_id", F.when(F.col("_ok"), F.struct("n", -F.col("cluster_id")))).alias("biggest"),
        F.max_by("cluster_id", F.when(F.col("_ok"), F.struct("top", "n", -F.col("cluster_id")))).alias("topmost"))
    status = (F.when(F.col("n_eligible") == 0, "no cluster above the minimum volume")
              .when((F.lit(keep) == "size") & (F.col("biggest") != F.col("topmost")), "biggest cluster is not the topmost")
              .otherwise("ok"))
    verdict = verdict.withColumn("status", status)
    chosen = F.col("_ok") if keep == "keep_all" else F.col("cluster_id") == (
        F.col("topmost") if keep == "top" else F.col("biggest"))
    verdict = cut_lineage(verdict)
    judged = salted_join(eligible, verdict.drop("n_clusters"), salt_by=["cluster_id"], buckets=CLUSTER_SALT)
    kept = judged.filter(chosen & (F.col("status") == "ok"))
    core = attach_to_clusters(labelled, kept.select(SUBJECT, "cluster_id", "n_clusters"))
    told = verdict.select(SUBJECT, "n_clusters", "n_eligible", "status")
    if subjects is not None:
        none = F.lit(0).cast("long")
        told = subjects.select(SUBJECT).join(told, SUBJECT, "left").select(
            SUBJECT, F.coalesce("n_clusters", none).alias("n_clusters"), F.coalesce("n_eligible", none).alias("n_eligible"),
            F.coalesce("status", F.lit("empty mask")).alias("status"))
    if dilate is None:
        return Selection(core.select(SUBJECT, *AXES), told)
    grown = dilate_box(core.filter("n_clusters > 1"), dilate, dims)
    single = core.filter("n_clusters = 1").select(SUBJECT, *AXES)
    return Selection(shuffled_join(labelled.select(SUBJECT, *AXES), grown.unionByName(single), how="left_semi"), told)
