"""Steps whose memory may not grow with the cohort: plans of joins, tasks that generate rows, batches in Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxelry import session
from voxelry.catalog import load, recipe
from voxelry.functions import hull, quantiles
from voxelry.functions.joins import attach, salted_join
from voxelry.operators import clusters, cohort, components, fill, geometry, lines, morphology, parcellation, rules, smoothing, voxel

DIMS = (4, 4, 4)


def cells(spark, n=3):
    """Every voxel of some subjects, made by explodes: the planner takes them for as few rows as the subjects."""
    out = spark.range(n).withColumnRenamed("id", "subject_id")
    for a, size in zip("ijk", DIMS):
        out = out.withColumn(a, F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    return out


def values(spark):
    return cells(spark).filter("(i + j + k) % 2 = 0").withColumn("v", F.lit(0.5))


def labels(spark):
    return cells(spark).withColumn("label", F.col("i") % 2 + 2)


def marked(spark):
    return components.label_components(values(spark).drop("v"), DIMS)


def affines(spark):
    identity = [F.lit(float(n % 5 == 0)) for n in range(16)]
    return spark.range(3).select(F.col("id").alias("subject_id"), F.array(*identity).alias("affine"))


JOINS = {
    "apply_mask": lambda s: voxel.apply_mask(values(s), cells(s)),
    "outside_mask": lambda s: voxel.outside_mask(values(s), cells(s)),
    "apply_weights": lambda s: voxel.apply_weights(values(s), values(s)),
    "drop_outside_clusters": lambda s: components.drop_outside_clusters(marked(s), cells(s)),
    "assign_region": lambda s: clusters.assign_region(marked(s), labels(s)),
    "rim_outside": lambda s: morphology.rim_outside(values(s), DIMS),
    "erode_l1": lambda s: morphology.erode_l1(cells(s), 2, DIMS),
    "resample_nearest": lambda s: geometry.resample_nearest(values(s), affines(s), DIMS, DIMS),
    "remove_islands": lambda s: parcellation.remove_islands(labels(s), DIMS),
    "salted_join": lambda s: salted_join(values(s), affines(s)),
}


@pytest.mark.parametrize("name", sorted(JOINS))
def test_voxel_tables_are_not_broadcast(spark, name):
    plan = JOINS[name](spark)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan
    assert "BroadcastHashJoin" not in plan


QUERIES = ["assign_region_wta", "cohort_metrics_long", "cohort_metrics_wide", "dog_edges", "drop_outside_clusters", "fold_ensemble", "predict_biomarker", "region_stats", "region_stats_wide", "warp_labels"]


@pytest.mark.parametrize("name", QUERIES)
def test_queries_broadcast_no_voxels(spark, sf, monkeypatch, name):
    """What is joined by a voxel, a cluster or a region of a participant grows with the cohort: it is shuffled, even where the planner takes it for small."""
    frame = type(spark.range(0))
    plain, frames = frame.checkpoint, []
    monkeypatch.setattr(frame, "checkpoint", lambda df, *a, **b: frames.append(df) or plain(df, *a, **b))
    monkeypatch.setattr(cohort, "staged", lambda df, place: frames.append(df) or session.staged(df, place))
    frames.append(load().QUERIES[name](spark, sf))
    plans = "\n".join(df._jdf.queryExecution().executedPlan().toString() for df in frames)
    assert "SortMergeJoin" in plans
    assert not re.search(r"BroadcastHashJoin \[[^\]]+, ", plans)


def test_wide_statistics_are_made_once(spark):
    """Whether a region has values, and the values, are read from the same stored rows."""
    rows = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], "subject_id string, region string, n int")
    stats = rows.select("subject_id", "region", *[F.col("n").alias(c) for c in cohort.STATISTICS])
    wide = cohort.metrics_wide(stats, ["x", "y"], drop_empty=True)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan
    assert len(wide.columns) == 8 and {r[1] for r in wide.collect()} == {1.0, 2.0}


def test_generated_rows_are_spread(spark, sf, monkeypatch):
    """Whole subjects are dealt to tasks by the rows they make, however small their table is."""
    monkeypatch.setattr(session, "GENERATED_ROWS", 1200)
    rows = recipe.grid(spark, sf)
    counts = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    per_subject = recipe.NI * recipe.NJ * recipe.NK
    assert sum(counts) == recipe.subjects(spark, sf).count() * per_subject
    assert max(counts) <= 2 * per_subject


def test_components_pack_no_bricks(spark):
    plan = marked(spark)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    assert "collect_list" not in plan


def test_bricks_are_labelled_some_at_a_time(monkeypatch):
    """Batches may cut bricks anywhere; what is labelled at once stays bounded and every brick is whole."""
    monkeypatch.setattr(components, "VOXELS", 100)
    rows = [(s, x, 0, 0, 4 * x + i, j, k) for s in ("a", None, "b") for x in range(20) for i in range(4) for j in range(2) for k in range(2)]
    cells_of = pa.table([pa.array(c) if n == 0 else pa.array(c, pa.int32()) for n, c in enumerate(zip(*rows))],
                        names=["subject_id", "_bi", "_bj", "_bk", "i", "j", "k"])
    cells_of = cells_of.append_column("part_id", pa.array(np.arange(len(rows)), pa.int64()))
    run = components._brick_labeller(26, 4, components._one_label(None), 4)
    out = list(run(iter(cells_of.to_batches(max_chunksize=7))))
    assert max(b.num_rows for b in out) < 100 + 7 and len(out) > 5
    found = pa.Table.from_batches(out)
    assert found.drop_columns("part_id") == cells_of.drop_columns("part_id")
    assert found.column("part_id").to_pylist() == [16 * (n // 16) for n in range(len(rows))]


def some_masks(spark):
    """Seeds of some participants on a rather empty grid."""
    rng = np.random.default_rng(5)
    rows = {(s, *map(int, rng.integers(0, 4, 3))) for s in ("a", "b", "c") for _ in range(9)}
    return spark.createDataFrame([(*r, sum(r[1:]) % 3 + 1) for r in sorted(rows, key=str)], "subject_id string, i int, j int, k int, label int")


BLOCKS = {
    "dilate_l1": lambda m: morphology.dilate_l1(m, 2, DIMS),
    "close_l1": lambda m: morphology.close_l1(m, 2, DIMS),
    "erode_l1": lambda m: morphology.erode_l1(morphology.dilate_l1(m, 2, DIMS), 2, DIMS),
    "erode_steps": lambda m: morphology.erode_steps(morphology.dilate_l1(m, 3, DIMS), 1, DIMS),
    "open_steps": lambda m: morphology.open_steps(morphology.dilate_l1(m, 3, DIMS), 1, DIMS),
    "euclidean_distance": lambda m: morphology.euclidean_distance(m.filter("label = 1"), DIMS, (1.0, 2.0, 0.5), where=m.select("subject_id", "i", "j", "k")),
    "nearest_label_fill": lambda m: fill.nearest_label_fill(m, cells(m.sparkSession).withColumn("subject_id", F.lit("a")).distinct(), DIMS),
    "spline_coefficients": lambda m: geometry.spline_coefficients(m.withColumn("v", F.col("label") / 3), DIMS).withColumn("v", F.round("v", 9)),
}


@pytest.mark.parametrize("name", sorted(BLOCKS))
def test_small_volumes_are_as_line_by_line(spark, monkeypatch, name):
    as_block = sorted(BLOCKS[name](some_masks(spark)).collect(), key=str)
    for module in (lines, morphology):
        monkeypatch.setattr(module, "fits", lambda dims: False)
    assert as_block and as_block == sorted(BLOCKS[name](some_masks(spark)).collect(), key=str)


def label_maps(n, dims, seed=7):
    """Blocks of all codes of the rules, with holes; the first map is empty, the second one all white matter, every third has a callosum of its own."""
    rng = np.random.default_rng(seed)
    codes = np.array([0, 2, 41, 2, 41, 2, 41, 4, 43, 14, 77, 10, 49, 11, 50, 12, 51, 1035, 2035, 1003, 2003, 1008, 2008, 1002, 2002, 17, 16])
    maps = rng.choice(codes, (*[-(-d // 2) for d in dims], n)).astype(np.int32)
    for axis in range(3):
        maps = np.repeat(maps, 2, axis=axis)
    maps = maps[tuple(slice(d) for d in dims)]
    maps = np.where(rng.random(maps.shape) < 0.1, rng.choice(codes, maps.shape), maps).astype(np.int32)
    maps[..., 2::3] = np.where(rng.random(maps[..., 2::3].shape) < 0.05, 251, maps[..., 2::3])
    maps[..., 0] = 0
    maps[..., 1] = np.where(np.arange(dims[0])[:, None, None] < dims[0] // 2, 2, 41)
    return maps


def as_rows(spark, maps):
    """Rows of the maps; a map without any voxel has none."""
    at = np.nonzero(maps)
    return spark.createDataFrame([(f"s{s}", int(i), int(j), int(k), int(v)) for i, j, k, s, v in zip(*at, maps[at])],
                                 "subject_id string, i int, j int, k int, label int")


RULES = {
    "hyperintensity_to_wm": (), "lobar_labels": (), "internal_capsule": (), "juxtacortical_wm": (2,), "periventricular": (1,), "corpus_callosum": (1, 2, 3, 1),
}


@pytest.mark.parametrize("name", sorted(RULES))
def test_rules_on_maps_are_as_on_tables(spark, name):
    dims, operator = (10, 9, 8), getattr(parcellation, name)
    maps = label_maps(8, dims)
    found = operator(as_rows(spark, maps), dims, *RULES[name])
    value = [F.col("label") if "label" in found.columns else F.when(F.col("side") == "L", 1).otherwise(2) if "side" in found.columns else F.lit(1)]
    table = np.zeros_like(maps)
    for r in found.select("subject_id", "i", "j", "k", *[v.alias("v") for v in value]).collect():
        table[r.i, r.j, r.k, int(r.subject_id[1:])] = r.v
    assert table.any() and np.array_equal(table, operator(maps, dims, *RULES[name]))


def test_parcellation_of_maps_is_as_of_tables(spark, monkeypatch):
    dims = (10, 9, 8)
    rows = as_rows(spark, label_maps(6, dims))
    as_maps = sorted(parcellation.lobar_wm_parcellation(rows, dims).collect())
    monkeypatch.setattr(parcellation, "fits", lambda d: False)
    tables = parcellation.lobar_wm_parcellation(rows, dims)
    assert as_maps and as_maps == sorted(tables.collect())
    assert tables.dtypes == parcellation.map_labels(rows, dims, lambda x: x).dtypes


def test_parcellation_of_small_grids_takes_one_shuffle(spark, monkeypatch):
    """The rules of a volume are worked through in one task; no table of voxels is stored or joined between them."""
    stored = []
    monkeypatch.setattr(parcellation, "cut_lineage", lambda df: stored.append(df) or session.cut_lineage(df))
    plan = parcellation.lobar_wm_parcellation(as_rows(spark, label_maps(4, DIMS)), DIMS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and "Join" not in plan and not stored


def test_parcellation_tells_voxels_outside_the_grid(spark):
    rows = spark.createDataFrame([("a", 0, 4, 0, 2)], "subject_id string, i int, j int, k int, label int")
    with pytest.raises(Exception, match="voxel outside the grid"):
        parcellation.lobar_wm_parcellation(rows, DIMS).collect()


def test_hulls_found_together_are_as_alone(monkeypatch):
    """Solid, flat, straight and single sets; also where only some of them are searched at a time, and where some were not in general position."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 7, (n, 3)) * flat, axis=0) for n in (1, 2, 5, 30) for flat in ((1, 1, 1), (1, 0, 1), (0, 0, 1))]
    points, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grid = np.indices((7, 7, 7)).reshape(3, -1).T
    inside = [((grid @ rows[:, :3].T) <= rows[:, 3]).all(axis=1) for rows in map(hull.half_spaces, sets)]
    plain = hull._simplices_each

    def shaky(x, owner):
        tri, of, good = plain(x, owner)
        good[::2] = False
        return tri, of, good

    for pairs, search in ((hull.PAIRS, plain), (1, plain), (hull.PAIRS, shaky)):
        monkeypatch.setattr(hull, "PAIRS", pairs)
        monkeypatch.setattr(hull, "_simplices_each", search)
        of, rows = hull.half_spaces_each(points, owner)
        assert (np.diff(of) >= 0).all()
        for s, want in enumerate(inside):
            own = rows[of == s]
            assert np.array_equal(((grid @ own[:, :3].T) <= own[:, 3]).all(axis=1), want)


def test_small_volumes_take_one_shuffle(spark):
    """Dealt by a number of partitions: the planner would merge few bytes of much work into one task."""
    plan = morphology.close_l1(some_masks(spark), 2, DIMS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan


def test_resampled_bricks_are_dealt_by_number(spark):
    plan = geometry.resample(values(spark), affines(spark), DIMS, DIMS, 1)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" in plan
    assert plan.count("REPARTITION_BY_NUM") == 3 and "ENSURE_REQUIREMENTS" not in plan


def test_hulls_are_found_by_many_tasks(spark, monkeypatch):
    """The groups of a hull lie in as many partitions as the session has, however few bytes their corners are."""
    seen = []
    plain = fill.cut_lineage
    monkeypatch.setattr(fill, "cut_lineage", lambda df: seen.append(plain(df)) or seen[-1])
    many = spark.range(40).withColumnRenamed("id", "subject_id").withColumn("i", F.lit(0)).withColumn("j", F.lit(0)).withColumn("k", F.explode(F.array(F.lit(0), F.lit(2))))
    assert fill.hull_fill(many).count() == 120
    assert seen[0].select(F.spark_partition_id()).distinct().count() > 4


def test_samples_are_spread_by_their_number(spark, sf, monkeypatch):
    monkeypatch.setattr(session, "GENERATED_ROWS", 400)
    counts = [r["n"] for r in recipe.prob(spark, sf).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(counts) > 10 and max(counts) < 800


def test_smoothing_of_small_volumes_shuffles_no_sums(spark, monkeypatch):
    monkeypatch.setattr(session, "GENERATED_ROWS", 70)
    smooth = smoothing.fast_smooth(values(spark), DIMS)
    plan = smooth._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert smooth.rdd.getNumPartitions() == 10  # 3 subjects of 32 voxels with 7 taps


def test_merged_values_are_dealt_by_their_number(spark, monkeypatch):
    dealt = []
    monkeypatch.setattr(quantiles, "scatter", lambda df, *c, each=0: dealt.append((c, each)) or session.scatter(df, *c, each=each))
    rows = spark.range(101).select(F.lit("a").alias("subject_id"), F.col("id").cast("double").alias("v"))
    assert quantiles.exact_percentiles(rows, ["subject_id"], "v", [0.25]).first()["q"] == [25.0]
    assert dealt == [(("subject_id", "_v"), 1)]


def test_tables_of_many_subjects_are_not_broadcast(spark):
    """A plan may hold a dozen tables of statistics on the driver at once."""
    small = spark.range(20_001).select(F.col("id").alias("subject_id"), F.array(F.lit(1.0)).alias("affine"))
    rows = attach(cells(spark), small)
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 3 * 64
