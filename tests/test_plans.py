"""The composed plans on a small made-up cohort."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import dense, table

from voxelry.operators import cohort, geometry
from voxelry.plans import cohort_run, preprocess
from voxelry.plans.settings import Settings
from voxelry.sources import tables
from voxelry.streaming import qc_stream

DIMS = (14, 12, 10)
SETTINGS = Settings(conformed_dims=DIMS, cropped_dims=(8, 8, 8), voxel_size=(1.0, 1.0, 1.0), tolerance=0.01, min_mask_volume=4.0,
                    crop_margin=1, min_sizes={"pvs": 2, "wmh": 1, "cmb": 1, "lac": 3})
IDENTITY = np.eye(4)


def header(spark, rows):
    return spark.createDataFrame([(s, *dims, *vox, aff.ravel().tolist(), "RAS") for s, dims, vox, aff in rows],
                                 "subject_id string, ni int, nj int, nk int, vx double, vy double, vz double, affine array<double>, orient string")


@pytest.fixture(scope="module")
def scans(spark):
    rng = np.random.default_rng(8)
    volume, mask = np.zeros(DIMS), np.zeros(DIMS)
    mask[4:11, 3:9, 2:8] = 1
    volume[mask > 0] = 10 + rng.random(int(mask.sum()))
    names = ("a", "b")
    images = header(spark, [(s, DIMS, (1.0, 1.0, 1.0), IDENTITY) for s in names])
    stack = lambda v: table(spark, v, "a").unionByName(table(spark, v, "b"))
    return images, stack(volume), stack(mask), volume, mask


def test_preprocess(spark, scans):
    images, voxels, mask, volume, brain = scans
    out = preprocess.preprocess(images, voxels, mask, images, SETTINGS)
    box = {r.subject_id: r for r in out.box.collect()}["a"]
    assert (box.ci, box.cj, box.ck) == (7, 6, 5)
    small = dense(out.mask.filter("subject_id = 'a'"), (8, 8, 8))
    assert (small == brain[3:11, 2:10, 1:9]).all()
    inside = dense(out.image.filter("subject_id = 'a'"), (8, 8, 8), "v")
    p99 = np.percentile(volume[3:11, 2:10, 1:9][small > 0], 99)
    assert np.allclose(inside, np.minimum(volume[3:11, 2:10, 1:9] / p99, 1.3) / 1.3)
    assert {r.brain_mask_size for r in out.qc.collect()} == {int(small.sum())}

    again = preprocess.preprocess_secondary(images, voxels, out, SETTINGS)
    assert np.allclose(dense(again.filter("subject_id = 'a'"), (8, 8, 8), "v"), inside, atol=1e-6)

    shift = np.eye(4)
    shift[0, 3] = 1.0  # a point at x in the main scan is at x + 1 in the other one
    moves = spark.createDataFrame([(s, shift.ravel().tolist()) for s in ("a", "b")], "subject_id string, transform array<double>")
    moved = preprocess.preprocess_swi(images, voxels, mask, images, moves, SETTINGS)
    assert {r.ci for r in moved.box.collect()} == {8}


def test_conform_interpolates_other_sizes(spark, scans):
    _, voxels, *_ = scans
    twice = np.diag([2.0, 1.0, 1.0, 1.0])
    images = header(spark, [("a", DIMS, (2.0, 1.0, 1.0), twice), ("b", DIMS, (1.0, 1.0, 1.0), IDENTITY)])
    head, out = preprocess.conform(images, voxels, SETTINGS)
    assert {(r.ni, r.nj, r.nk) for r in head.collect()} == {DIMS}
    limits = {r.subject_id: (r.lo, r.hi) for r in out.groupBy("subject_id").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    assert limits["a"][1] <= 11.0 and limits["b"][0] >= 10.0


def test_cubic_resampling_is_exact_on_the_lattice(spark):
    image = np.random.default_rng(0).random(DIMS) + 1
    moves = spark.createDataFrame([("a", IDENTITY.ravel().tolist())], "subject_id string, affine array<double>")
    out = geometry.resample(table(spark, image), moves, DIMS, DIMS, 3)
    assert np.allclose(dense(out, DIMS, "v"), image, atol=1e-6)
    half = np.eye(4)
    half[0, 3] = 0.5
    moves = spark.createDataFrame([("a", half.ravel().tolist())], "subject_id string, affine array<double>")
    line = np.broadcast_to(np.arange(1.0, 15.0)[:, None, None], DIMS)
    mid = dense(geometry.resample(table(spark, line), moves, DIMS, DIMS, 1), DIMS, "v")
    assert np.allclose(mid[:-1], line[:-1] + 0.5) and not mid[-1].any()


def test_cubic_between_lattice_points(spark):
    """Against a spline solved as a linear system along one axis."""
    n = DIMS[0]
    values = np.random.default_rng(1).random(n) + 1
    system = np.diag(np.full(n, 4.0)) + np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1)
    system[0, 1] = system[-1, -2] = 2.0  # mirrored ends
    c = np.linalg.solve(system / 6, values)
    move = np.eye(4)
    move[0, 3] = 0.3
    moves = spark.createDataFrame([("a", move.ravel().tolist())], "subject_id string, affine array<double>")
    image = np.broadcast_to(values[:, None, None], DIMS)
    got = dense(geometry.resample(table(spark, image), moves, DIMS, DIMS, 3), DIMS, "v")[:, 4, 4]
    mirror = lambda x: c[n - 1 - abs(n - 1 - abs(x))]
    t, s = 0.3, 0.7
    w = [s ** 3 / 6, (4 - 6 * t ** 2 + 3 * t ** 3) / 6, (4 - 6 * s ** 2 + 3 * s ** 3) / 6, t ** 3 / 6]
    want = [sum(w[m] * mirror(x + m - 1) for m in range(4)) for x in range(n - 1)]
    assert np.allclose(got[:-1], want, atol=1e-6) and got[-1] == 0


def test_two_pass_mask(spark, scans):
    images, voxels, _, volume, brain = scans
    def bright(channels, fold):
        return (channels[..., 0] > 0.5) * 1.0

    settings = Settings(conformed_dims=DIMS, cropped_dims=(10, 10, 10), mask_threshold=0.5)
    out = preprocess.two_pass_mask(images, voxels, bright, 1, settings, opening=1, min_volume=5.0)
    assert (dense(out.voxels.filter("subject_id = 'a'"), DIMS) == brain).all()
    assert {(r.subject_id, r.status) for r in out.status.collect()} == {("a", "ok"), ("b", "ok")}
    one = preprocess.two_pass_mask(images, voxels.filter("subject_id = 'a'"), bright, 1, settings, opening=1, min_volume=5.0)
    assert {(r.subject_id, r.status) for r in one.status.collect()} == {("a", "ok"), ("b", "empty mask")}


def test_segmentation_modes(spark):
    labels = np.zeros(DIMS, int)
    labels[2:7, 2:10, 2:8], labels[7:12, 2:10, 2:8] = 2, 41
    labels[2:4, 2:10, 2:8], labels[10:12, 2:10, 2:8] = 1003, 2008
    labels[5, 5, 5] = 41
    df = table(spark, labels, value="label")
    derived, mask = preprocess.brain_segmentation("fs", DIMS, SETTINGS, labels=df)
    got = dense(derived, DIMS, "label")
    assert got[5, 5, 5] in (2, 3, 46) and got[3, 5, 5] == 1 and got[11, 5, 5] == 25 and mask.count() == (labels > 0).sum()
    assert preprocess.brain_segmentation("custom", DIMS, SETTINGS, labels=df)[1].count() == mask.count()
    assert preprocess.brain_segmentation("mask", DIMS, SETTINGS, mask=mask)[0] is None
    with pytest.raises(ValueError):
        preprocess.brain_segmentation("other", DIMS, SETTINGS)


def test_run_and_write(spark, tmp_path):
    dims = SETTINGS.cropped_dims
    prob = np.zeros(dims)
    prob[1:3, 1, 1], prob[5, 5, 5] = 0.9, 0.9
    labels = np.full(dims, 43)
    labels[4:] = 60
    channel, mask = table(spark, prob), table(spark, np.ones(dims))
    subjects = spark.createDataFrame([("a",), ("z",)], "subject_id string")
    maps = cohort_run.predict_biomarker([channel], mask, lambda c, f: c[..., 0], 2, SETTINGS)
    qc = spark.createDataFrame([("a", 5.0, 1.5)], "subject_id string, brain_mask_size double, main_norm_peak double")
    result = cohort_run.run_cohort({"pvs": maps, "cmb": maps}, mask, SETTINGS, subjects, table(spark, labels, value="label"), qc)
    stats = {(r.subject_id, r.biomarker, r.region): r for r in result.stats.collect()}
    assert stats["a", "pvs", "Whole brain"].n_clusters == 1 and stats["a", "cmb", "Whole brain"].n_clusters == 2
    assert stats["a", "pvs", "Left Hippoc."].total_vol == 2 and stats["a", "cmb", "Brainstem"].max_vol == 1
    assert stats["z", "pvs", "Brainstem"].n_clusters == 0 and stats["z", "pvs", "Brainstem"].mean_vol is None
    assert [(r.subject_id, r.metrics) for r in result.failed_qc.collect()] == [("a", ["main_norm_peak"])]
    cohort_run.write_cohort(result, str(tmp_path), "2024-01-01")
    assert spark.read.parquet(f"{tmp_path}/region_stats").count() == result.stats.count()
    assert spark.read.text(f"{tmp_path}/failed_qc").first()[0] == '{"a":["main_norm_peak"]}'
    assert "Left Hippoc. - total_vol" in spark.read.option("header", "true").csv(f"{tmp_path}/prediction_metrics_wide/pvs").columns
    alone = cohort_run.run_cohort({"pvs": maps}, mask, SETTINGS, subjects)
    assert {r.region for r in alone.stats.collect()} == {"Whole brain"}


def test_provenance_and_anonymise(spark):
    found = spark.createDataFrame([("pvs", "f1", "aa", "http://x"), ("pvs", "f0", "bb", "http://x")], "biomarker string, name string, md5 string, url string")
    parameters = spark.createDataFrame([("pvs", 0.5, 5), ("wmh", 0.2, 1)], "biomarker string, threshold double, min_size int")
    rows = {r.biomarker: r for r in cohort.report_provenance(found, parameters).collect()}
    assert [f.name for f in rows["pvs"].files] == ["f0", "f1"] and rows["wmh"].files is None
    qc = spark.createDataFrame([("a", 1.0)], "subject_id string, x double")
    assert len(cohort.anonymise(qc, "salt").first().subject_id) == 64


def test_streamed_qc_equals_batch(spark, tmp_path):
    """Three files arrive one after another; a subject that comes again is ignored."""
    population = spark.createDataFrame([(f"p{n}", float(n)) for n in range(20)], "subject_id string, size double")
    source = str(tmp_path / "in")
    batches = [[("a", 5.0, 1), ("b", 90.0, 2)], [("a", 99.0, 3), ("c", -40.0, 4), ("c", 6.0, 5)], [("d", 7.0, 6)]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "subject_id string, size double, at int").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("subject_id string, size double, at int").parquet(source)
        qc_stream.qc_stream(stream, population, str(tmp_path / "store"), str(tmp_path / "progress"), ("at",)).awaitTermination()
    got = {r.subject_id: (r["size"], r.failed) for r in spark.read.parquet(str(tmp_path / "store")).collect()}
    assert got == {"a": (5.0, []), "b": (90.0, ["size"]), "c": (-40.0, ["size"]), "d": (7.0, [])}
    assert tables.dated(population, "2024-02-03").first().append_date.isoformat() == "2024-02-03"
