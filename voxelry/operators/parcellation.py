"""Anatomical relabelling: region schemes, islands, lobes, capsules, callosum, basal-ganglia box.

Label volumes are sparse tables (subject_id, i, j, k, label). Both hemispheres of a rule run in one pass with ``side``
(L or R) as an extra key.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Sequence
from functools import reduce, wraps

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import regions as R
from ..functions.joins import salted_join, shuffled_join
from ..functions.offsets import neighbours, spread
from ..schema import AXES, SUBJECT, VOXEL, Dims, in_grid
from ..session import cut_lineage
from . import rules
from .blocks import fits, map_labels
from .components import CLUSTER_SALT, attach_to_clusters, label_components
from .fill import hull_fill, nearest_label_fill
from .morphology import close_l1, dilate_l1, erode_steps, open_steps
from .voxel import apply_mask, label_in, outside_mask, union_masks

SIDED = (SUBJECT, "side")
SIDED_VOXEL = [*SIDED, *AXES]
#: Thickness in voxels of the white-matter layers.
JUXTACORTICAL_THICKNESS, PERIVENTRICULAR_THICKNESS = 3, 2


def also_for_maps(rule: Callable[..., np.ndarray]) -> Callable[[Callable], Callable]:
    """The operator takes dense label maps (``rules``) as well as tables, and gives such maps for them."""
    def both(operator: Callable) -> Callable:
        signature = inspect.signature(operator)

        @wraps(operator)
        def run(labels, *args, **options):
            if not isinstance(labels, np.ndarray):
                return operator(labels, *args, **options)
            given = signature.bind(labels, *args, **options)
            given.apply_defaults()
            return rule(**given.arguments)

        return run

    return both


def parcellate(labels: DataFrame, scheme: str) -> DataFrame:
    """Merge the codes of the derived parcellation into the regions of a scheme (``pvs``, ``wmh`` or ``mars``)."""
    lut = R.scheme_lut(labels.sparkSession, scheme)
    return (labels.join(F.broadcast(lut), labels["label"] == lut["src_label"])
            .select(*VOXEL, F.col("region_label").alias("label"), "region"))


def parcellate_for_biomarker(labels: DataFrame, biomarkers: Sequence[str]) -> DataFrame:
    """Region map of every biomarker's own scheme."""
    parts = [parcellate(labels, R.BIOMARKER_SCHEME[b]).withColumn("biomarker", F.lit(b)) for b in biomarkers]
    return reduce(DataFrame.unionByName, parts)


def fs_regions(labels: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """FreeSurfer codes as named regions: CSF dropped, cortical parcels collapsed per hemisphere."""
    wanted = {n: c for n, c in R.FS_REGIONS.items() if regions is None or n in regions}
    label = F.col("label")
    for low, high, code in R.FS_CORTEX.values():
        label = F.when(F.col("label").between(low, high), F.lit(code)).otherwise(label)
    lut = labels.sparkSession.createDataFrame([(c, n) for n, c in wanted.items()], "label int, region string")
    return (labels.filter(F.col("label") != R.FS_CSF).withColumn("label", label)
            .join(F.broadcast(lut), "label").select(*VOXEL, "label", "region"))


def sided(labels: DataFrame, members: dict[str, Sequence[int]]) -> DataFrame:
    """Voxels of the given labels with their hemisphere."""
    side = F.when(F.col("label").isin(list(members["L"])), "L").when(F.col("label").isin(list(members["R"])), "R")
    return labels.withColumn("side", side).filter("side IS NOT NULL").select(*SIDED_VOXEL, "label")


@also_for_maps(rules.white_matter)
def white_matter(labels: DataFrame) -> DataFrame:
    return sided(labels, {s: [c] for s, c in R.WHITE_MATTER.items()}).drop("label")


def on_white_matter(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows on the white matter of their own hemisphere."""
    return shuffled_join(rows.select(*SIDED_VOXEL), white_matter(labels), SIDED_VOXEL, "left_semi")


def _both(left: Sequence[int]) -> dict[str, list[int]]:
    return {"L": list(left), "R": [v + R.RIGHT_PARCEL for v in left]}


def remove_islands(labels: DataFrame, dims: Dims, max_size: int = 100, ignore: Sequence[int] = ()) -> DataFrame:
    """Give small components that are not the largest of their label the label most of their face neighbours have.

    Returns ``label`` (0 rows dropped) and ``removed``, the old label of a relabelled voxel. Neighbours are looked up in
    the original volume, background included; the smallest label wins ties.
    """
    marked = cut_lineage(label_components(labels.select(*VOXEL, "label"), dims, 26, equal="label"))
    sizes = marked.groupBy(SUBJECT, "cluster_id").agg(F.first("label").alias("label"), F.count("*").alias("n"))
    main = sizes.groupBy(SUBJECT, "label").agg(F.max_by("cluster_id", F.struct("n", -F.col("cluster_id"))).alias("_main"))
    ranked = salted_join(sizes, main, [SUBJECT, "label"], salt_by=["cluster_id"], buckets=CLUSTER_SALT)
    islands = ranked.filter((F.col("cluster_id") != F.col("_main")) & (F.col("n") <= max_size))
    if ignore:
        islands = islands.filter(~F.col("label").isin(list(ignore)))
    own = attach_to_clusters(marked, islands.select(SUBJECT, "cluster_id"))
    touched = spread(own.select(*VOXEL, F.col("cluster_id").alias("island")), neighbours(6)).filter(in_grid(dims)).distinct()
    around = shuffled_join(touched, marked.select(*VOXEL, "label", "cluster_id"), how="left").filter("cluster_id IS NULL OR cluster_id <> island")
    votes = around.groupBy(SUBJECT, "island", F.coalesce("label", F.lit(0)).alias("_new")).agg(F.count("*").alias("_n"))
    winner = votes.groupBy(SUBJECT, "island").agg(F.max_by("_new", F.struct("_n", -F.col("_new"))).alias("_new"))
    moved = attach_to_clusters(marked, winner.withColumnRenamed("island", "cluster_id"), how="left")
    return (moved.select(*VOXEL, F.coalesce("_new", "label").alias("label"),
                         F.when(F.col("_new").isNotNull(), F.col("label")).alias("removed"))
            .filter("label <> 0 OR removed IS NOT NULL"))


@also_for_maps(rules.hyperintensity_to_wm)
def hyperintensity_to_wm(labels: DataFrame, dims: Dims) -> DataFrame:
    """Turn each component of white-matter hyperintensity into the white matter of the side it touches in more voxels
    (the bigger hemisphere on ties)."""
    left, right = R.WHITE_MATTER["L"], R.WHITE_MATTER["R"]
    marked = cut_lineage(label_components(label_in(labels, R.HYPERINTENSITY).select(*VOXEL), dims, 6))
    wm = label_in(labels, [left, right]).select(*VOXEL, F.col("label").alias("wm"))
    near = marked.select(SUBJECT, "cluster_id", *AXES, *[F.col(a).alias(f"_{a}") for a in AXES])
    contact = (shuffled_join(spread(near, neighbours(6)).filter(in_grid(dims)), wm)
               .groupBy(SUBJECT, "cluster_id", *[f"_{a}" for a in AXES])
               .agg(F.max((F.col("wm") == left).cast("int")).alias("l"), F.max((F.col("wm") == right).cast("int")).alias("r"))
               .groupBy(SUBJECT, "cluster_id").agg(F.sum("l").alias("l"), F.sum("r").alias("r")))
    sizes = wm.groupBy(SUBJECT).agg(F.count_if(F.col("wm") == left).alias("all_l"), F.count_if(F.col("wm") == right).alias("all_r"))
    touched = shuffled_join(marked.select(SUBJECT, "cluster_id").distinct(), contact, [SUBJECT, "cluster_id"], "left")
    clusters = salted_join(touched, sizes, how="left", salt_by=["cluster_id"], buckets=CLUSTER_SALT)
    zero = F.lit(0)
    l, r, al, ar = (F.coalesce(c, zero) for c in ("l", "r", "all_l", "all_r"))
    new = F.when(l > r, left).when(r > l, right).when(al >= ar, left).otherwise(right)
    turned = attach_to_clusters(marked, clusters.select(SUBJECT, "cluster_id", new.alias("label")))
    return (labels.filter(F.col("label") != R.HYPERINTENSITY).select(*VOXEL, "label")
            .unionByName(turned.select(*VOXEL, F.col("label").cast("int").alias("label"))))


def _recode(pairs: dict[int, int]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.try_element_at(table, F.col("label"))


@also_for_maps(rules.lobar_labels)
def lobar_labels(labels: DataFrame, dims: Dims) -> DataFrame:
    """Lobes and deep structures: white matter (and the parcels kept out of the seeds) takes the nearest lobe of its
    hemisphere."""
    seeds, open_labels, others = rules.lobe_tables()
    seed_labels = {s: [v for v, c in seeds.items() if (v >= 2000) == (s == "R")] for s in "LR"}
    seeded = sided(labels, seed_labels).withColumn("label", _recode(seeds))
    filled = nearest_label_fill(seeded, sided(labels, open_labels), dims, SIDED)
    rest = label_in(labels, list(others)).withColumn("label", _recode(others)).select(*VOXEL, "label")
    return filled.unionByName(seeded).drop("side").unionByName(rest)


@also_for_maps(rules.internal_capsule)
def internal_capsule(labels: DataFrame, dims: Dims) -> DataFrame:
    """White matter inside the eroded hull of basal ganglia and thalamus, per side."""
    nuclei = sided(labels, R.CAPSULE_NUCLEI)
    return on_white_matter(erode_steps(hull_fill(nuclei, SIDED), 2, dims, SIDED), labels)


@also_for_maps(rules.juxtacortical_wm)
def juxtacortical_wm(labels: DataFrame, dims: Dims, thickness: int = JUXTACORTICAL_THICKNESS) -> DataFrame:
    """White matter within ``thickness`` steps of the cortex (insula excluded), per side."""
    parcels = [p for ps in R.LOBE_PARCELS.values() for p in ps]
    near = dilate_l1(label_in(labels, parcels + [p + R.RIGHT_PARCEL for p in parcels]), thickness, dims)
    return shuffled_join(white_matter(labels), near, how="left_semi").select(*SIDED_VOXEL)


@also_for_maps(rules.periventricular)
def periventricular(labels: DataFrame, dims: Dims, thickness: int = PERIVENTRICULAR_THICKNESS) -> DataFrame:
    """Voxels outside the lateral ventricles and within ``thickness`` steps of them."""
    ventricles = label_in(labels, R.VENTRICLES["L"] + R.VENTRICLES["R"])
    return outside_mask(dilate_l1(ventricles, thickness, dims), ventricles)


def periventricular_wm(labels: DataFrame, dims: Dims, thickness: int = PERIVENTRICULAR_THICKNESS) -> DataFrame:
    """White matter near the ventricle of its own side."""
    return on_white_matter(dilate_l1(sided(labels, R.VENTRICLES), thickness, dims, SIDED), labels)


@also_for_maps(rules.external_capsule)
def external_capsule(labels: DataFrame, dims: Dims, exclude: DataFrame,
                     reach: int = 10, low: int = 5, closing: int = 3) -> DataFrame:
    """White matter between insula and putamen per side, away from ``exclude``, hippocampus and ventral DC."""
    walls = sided(labels, {s: [R.PUTAMEN[s], R.INSULA[s]] for s in "LR"})
    part = F.when(F.col("label").isin(list(R.PUTAMEN.values())), "putamen").otherwise("insula")
    keys = (*SIDED, "part")
    near = dilate_l1(walls.withColumn("part", part), reach, dims, keys).groupBy(*SIDED_VOXEL).count().filter("count = 2")
    lower = dilate_l1(label_in(labels, R.HIPPOCAMPUS_VENTRAL_DC), low, dims)
    barred = union_masks(exclude, lower)
    raw = shuffled_join(hull_fill(walls, SIDED), near, SIDED_VOXEL, "left_semi")
    core = on_white_matter(outside_mask(raw, barred), labels)
    walls = walls.select(*SIDED_VOXEL)
    closed = close_l1(core.unionByName(walls), closing, dims, SIDED)
    return on_white_matter(shuffled_join(closed, walls, SIDED_VOXEL, "left_anti"), labels)


@also_for_maps(rules.corpus_callosum)
def corpus_callosum(labels: DataFrame, dims: Dims, ventricle_reach: int = 6, cingulum_closing: int = 5,
                    growth: int = 10, opening: int = 2) -> DataFrame:
    """Corpus callosum per side: from its own labels where the parcellation has them, otherwise from where the two
    white-matter halves meet, without the ventricle and cingulum zones."""
    own = label_in(labels, R.CORPUS_CALLOSUM)
    has_own = own.select(SUBJECT).distinct()
    # labelled subjects: one step of dilation, split by the nearest white-matter half inside it
    grown = dilate_l1(own, 1, dims)
    halves = shuffled_join(white_matter(labels).withColumn("label", F.when(F.col("side") == "L", 1).otherwise(2)), grown, how="left_semi")
    split = (nearest_label_fill(halves.select(*VOXEL, "label"), grown, dims)
             .select(SUBJECT, F.when(F.col("label") == 1, "L").otherwise("R").alias("side"), *AXES))
    # other subjects
    rest = salted_join(labels, has_own, how="left_anti")
    lateral = label_in(rest, R.LATERAL_VENTRICLES)
    third = dilate_l1(label_in(rest, R.THIRD_VENTRICLE), ventricle_reach, dims)
    fornix = close_l1(union_masks(lateral, third), ventricle_reach, dims)
    cingulum = close_l1(sided(rest, _both(R.CINGULATE_PARCELS)), cingulum_closing, dims, SIDED)
    halves = white_matter(rest)
    free = outside_mask(halves.select(*VOXEL), union_masks(fornix, cingulum))
    meet = apply_mask(dilate_l1(halves, 1, dims, SIDED), free).groupBy(*VOXEL).count().filter("count = 2")
    body = open_steps(apply_mask(dilate_l1(meet, growth, dims), free), opening, dims)
    return split.unionByName(shuffled_join(halves, body, how="left_semi").select(*split.columns))


def lobar_wm_parcellation(labels: DataFrame, dims: Dims) -> DataFrame:
    """The derived parcellation: lobes with white-matter layers, deep structures, capsules, callosum, periventricular
    parts. Overlays follow a fixed order in which the later one wins.

    On a grid of one block the maps of a task are laid side by side, and the same operators work on them there after one shuffle of the labels.
    """
    if fits(dims):
        return map_labels(labels, dims, lambda maps: _parcellated_maps(maps, dims))
    labels = cut_lineage(hyperintensity_to_wm(labels, dims))
    lobar = cut_lineage(lobar_labels(labels, dims))
    wm = white_matter(labels)
    juxta = cut_lineage(juxtacortical_wm(labels, dims))
    near = cut_lineage(periventricular(labels, dims))
    capsule = cut_lineage(internal_capsule(labels, dims))
    near_wm = shuffled_join(wm, near, how="left_semi").select(*SIDED_VOXEL)
    inner = shuffled_join(capsule, near_wm, SIDED_VOXEL, "left_anti")
    outer = external_capsule(labels, dims, union_masks(juxta, inner))
    callosum = corpus_callosum(labels, dims)
    lobes = list(R.LOBE_CODES.values())
    on_lobe = shuffled_join(wm, lobar).filter(F.col("label").isin(lobes + [v + R.RIGHT_LOBE for v in lobes]))

    def layer(zone: DataFrame | None, step: int, prio: int) -> DataFrame:
        rows = on_lobe if zone is None else shuffled_join(on_lobe, zone, SIDED_VOXEL, "left_semi")
        return rows.select(*VOXEL, (F.col("label") + step).alias("label"), F.lit(prio).alias("prio"))

    def overlay(rows: DataFrame, name: str, prio: int) -> DataFrame:
        value = F.when(F.col("side") == "L", R.code(name, "L")).otherwise(R.code(name, "R"))
        return rows.select(*VOXEL, value.alias("label"), F.lit(prio).alias("prio"))

    def near_structure(name: str) -> DataFrame:
        own = lobar.filter(F.col("label").isin(R.code(name, "L"), R.code(name, "R")))
        side = F.when(F.col("label") == R.code(name, "L"), "L").otherwise("R")
        return apply_mask(own, near).withColumn("side", side)

    layers = [lobar.select(*VOXEL, "label", F.lit(0).alias("prio")),
              layer(None, R.DEEP, 1), layer(juxta, R.JUXTACORTICAL, 2), layer(near_wm, R.PERIVENTRICULAR, 3),
              overlay(inner, "Internal capsule", 4), overlay(outer, "External capsule", 5),
              overlay(callosum, "Corpus callosum", 6),
              overlay(near_structure("Basal ganglia"), "Basal ganglia periventricular", 7),
              overlay(shuffled_join(capsule, near, how="left_semi"), "Internal capsule periventricular", 8),
              overlay(near_structure("Thalamus"), "Thalamus periventricular", 9)]
    return reduce(DataFrame.unionByName, layers).groupBy(*VOXEL).agg(F.max_by("label", "prio").alias("label"))


def _parcellated_maps(labels: np.ndarray, dims: Dims) -> np.ndarray:
    """``lobar_wm_parcellation`` of dense label maps."""
    labels = hyperintensity_to_wm(labels, dims)
    lobar = lobar_labels(labels, dims)
    wm = white_matter(labels)
    juxta = juxtacortical_wm(labels, dims)
    near = periventricular(labels, dims)
    capsule = internal_capsule(labels, dims)
    near_wm = (wm > 0) & near
    inner = np.where(near_wm, 0, capsule)
    outer = external_capsule(labels, dims, (juxta > 0) | (inner > 0))
    callosum = corpus_callosum(labels, dims)
    lobes = list(R.LOBE_CODES.values())
    on_lobe = (wm > 0) & rules.marked(lobar, lobes + [v + R.RIGHT_LOBE for v in lobes])

    def overlay(sides: np.ndarray, name: str) -> np.ndarray:
        return rules.recode(sides, {rules.SIDES[s]: R.code(name, s) for s in "LR"})

    def near_structure(name: str) -> np.ndarray:
        return np.where(near, rules.sided(lobar, {s: [R.code(name, s)] for s in "LR"}), 0)

    layers = [np.where(on_lobe, lobar + R.DEEP, 0), np.where(on_lobe & (juxta > 0), lobar + R.JUXTACORTICAL, 0),
              np.where(on_lobe & near_wm, lobar + R.PERIVENTRICULAR, 0),
              overlay(inner, "Internal capsule"), overlay(outer, "External capsule"), overlay(callosum, "Corpus callosum"),
              overlay(near_structure("Basal ganglia"), "Basal ganglia periventricular"),
              overlay(np.where(near, capsule, 0), "Internal capsule periventricular"),
              overlay(near_structure("Thalamus"), "Thalamus periventricular")]
    return reduce(lambda under, over: np.where(over > 0, over, under), layers, lobar)


def basal_ganglia_box(labels: DataFrame, dims: Dims) -> DataFrame:
    """Box over the basal ganglia in y and z, cut in x by a wall along the insula of each side.

    The wall follows the insula line by line; a line without insula reuses the previous one. At the ends of the insula
    in y and z the last line is carried on to the grid border.
    """
    ni, nj, nk = dims
    box = label_in(labels, R.BASAL_GANGLIA_BOX).groupBy(SUBJECT).agg(
        F.min("j").alias("j0"), F.max("j").alias("j1"), F.min("k").alias("k0"), F.max("k").alias("k1"))
    side = F.when(F.col("i") < ni // 2, "L").otherwise("R")
    insula = label_in(labels, list(R.INSULA.values())).withColumn("side", side)
    lines = insula.groupBy(*SIDED, "j", "k").agg(F.min("i").alias("a"), F.max("i").alias("b"))
    columns = lines.groupBy(*SIDED, "j").agg(F.min("k").alias("ka"), F.max("k").alias("kb"))
    span = columns.groupBy(*SIDED).agg(F.min("j").alias("ja"), F.max("j").alias("jb"))
    every = (shuffled_join(span.withColumn("j", F.explode(F.sequence("ja", "jb"))), columns, [*SIDED, "j"], "left")
             .withColumns({"ka": F.coalesce("ka", F.lit(0)), "kb": F.coalesce("kb", F.lit(0))})
             .withColumn("k", F.explode(F.sequence("ka", "kb"))))
    every = shuffled_join(every, lines, [*SIDED, "j", "k"], "left")
    # at most nj * nk lines per side
    carry = W.partitionBy(*SIDED).orderBy("j", "k").rowsBetween(W.unboundedPreceding, W.currentRow)
    every = every.withColumns({c: F.last(c, ignorenulls=True).over(carry) for c in ("a", "b")})
    low_j = F.when(F.col("j") == F.col("ja"), F.lit(0)).otherwise(F.col("j"))
    high_j = F.when((F.col("j") == F.col("jb")) & (F.col("j") != F.col("ja")), F.lit(nj - 1)).otherwise(F.col("j"))
    low_k = F.when(F.col("k") == F.col("ka"), F.lit(0)).otherwise(F.col("k"))
    high_k = F.when(F.col("k") == F.col("kb"), F.lit(nk - 1)).otherwise(F.col("k"))
    wall = (every.select(*SIDED, "a", "b", F.explode(F.sequence(low_j, high_j)).alias("j"), low_k.alias("_x"), high_k.alias("_y"))
            .withColumn("k", F.explode(F.sequence("_x", "_y")))
            .groupBy(SUBJECT, "j", "k").agg(F.max(F.when(F.col("side") == "L", F.col("a"))).alias("from_i"),
                                            F.min(F.when(F.col("side") == "R", F.col("b"))).alias("to_i")))
    cells = box.withColumn("j", F.explode(F.sequence("j0", "j1"))).withColumn("k", F.explode(F.sequence("k0", "k1")))
    cells = shuffled_join(cells, wall, [SUBJECT, "j", "k"], "left")
    first, last = F.coalesce("from_i", F.lit(0)), F.coalesce("to_i", F.lit(ni - 1))
    return cells.filter(first <= last).withColumn("i", F.explode(F.sequence(first, last))).select(*VOXEL)
