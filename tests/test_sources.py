"""Files that the tests write themselves."""

import gzip
import hashlib
import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelry.sources import descriptors, layout, lut_files, nifti as nifti_source, subjects, tables, volumes


def nifti(volume, affine, dtype="f4", slope=1.0):
    """Bytes of a single-file NIfTI-1 volume."""
    codes = {"f4": 16, "i2": 4, "u1": 2}
    h = bytearray(352)
    struct.pack_into("<i", h, 0, 348)
    struct.pack_into("<8h", h, 40, 3, *volume.shape, 1, 1, 1, 1)
    struct.pack_into("<2h", h, 70, codes[dtype], np.dtype(dtype).itemsize * 8)
    struct.pack_into("<8f", h, 76, 1.0, *np.sqrt((affine[:3, :3] ** 2).sum(axis=0)), 0, 0, 0, 0)
    struct.pack_into("<3f", h, 108, 352.0, slope, 0.0)
    struct.pack_into("<2h", h, 252, 0, 1)
    struct.pack_into("<12f", h, 280, *affine[:3].ravel())
    h[344:348] = b"n+1\0"
    return bytes(h) + np.asarray(volume, dtype="<" + dtype).tobytes(order="F")


@pytest.fixture(scope="module")
def dataset(tmp_path_factory):
    root = tmp_path_factory.mktemp("scans")
    rng = np.random.default_rng(1)
    made = {}
    for n, sub in enumerate(["s1", "s2"]):
        for acq in ("t1", "flair"):
            volume = np.where(rng.random((5, 4, 3)) < 0.5, rng.integers(1, 9, (5, 4, 3)), 0)
            affine = np.diag([1.0, 1.5, 2.0, 1.0])
            affine[:3, 3] = [n, -2, 3]
            (root / sub / acq).mkdir(parents=True)
            raw = nifti(volume, affine, "i2" if acq == "t1" else "f4", 2.0)
            (root / sub / acq / ("scan.nii.gz" if n else "scan.nii")).write_bytes(gzip.compress(raw) if n else raw)
            made[sub, acq] = (volume, affine)
    return root, made


def test_frames_are_chosen_not_lost(spark, tmp_path):
    volume = np.arange(1, 13).reshape(2, 3, 2)
    raw = bytearray(nifti(volume, np.eye(4)))
    struct.pack_into("<8h", raw, 40, 4, *volume.shape, 2, 1, 1, 1)
    path = tmp_path / "series.nii"
    path.write_bytes(bytes(raw) + np.asarray(volume + 100, dtype="<f4").tobytes(order="F"))
    scans = spark.createDataFrame([("a", "swi", str(path), bytearray(path.read_bytes()))],
                                  "subject_id string, acq string, path string, content binary")
    second = {(r.i, r.j, r.k): r.v for r in volumes.read_volumes(scans, 1).collect()}
    assert second == {ix: float(v + 100) for ix, v in np.ndenumerate(volume)}
    with pytest.raises(Exception, match="frames"):
        volumes.read_volumes(scans).collect()


ACQS = json.dumps({"t1": "t1", "flair": "flair"})


def cells(df):
    return {(r.subject_id, r.acq, r.i, r.j, r.k): r.v for r in df.collect()}


def made_cells(made):
    return {(*key, *map(int, ix)): float(volume[tuple(ix)]) * 2.0 for key, (volume, _) in made.items() for ix in np.argwhere(volume)}


@pytest.mark.parametrize("slab_bytes", [1 << 20, 400, 1])
def test_nifti_format_over_a_tree(spark, dataset, slab_bytes):
    """Plain and gzipped files, whole and in slabs; every slab is a partition of its own."""
    root, made = dataset
    nifti_source.register(spark)
    df = spark.read.format("nifti").option("acquisitions", ACQS).option("slabBytes", slab_bytes).load(str(root))
    got = cells(df)
    assert got == made_cells(made) and df.count() == len(got)
    assert df.rdd.getNumPartitions() > (1 if slab_bytes < 500 else 0)
    reader = nifti_source.NiftiReader({"path": str(root), "acquisitions": ACQS, "slabBytes": "1"})
    plain = [p for p in reader.partitions() if p.scans[0].slabs > 1]
    assert len({(p.scans[0].path, p.scans[0].slab) for p in plain}) == len(plain) > 500  # slabs without a plane are empty
    heads = {(r.subject_id, r.acq): r for r in spark.read.format("nifti").option("acquisitions", ACQS).option("headers", "true").load(f"file://{root}").collect()}
    for key, (volume, affine) in made.items():
        assert (heads[key].ni, heads[key].nj, heads[key].nk) == volume.shape and np.allclose(np.reshape(heads[key].affine, (4, 4)), affine)


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_nifti_format_over_a_manifest(spark, dataset, tmp_path, kind):
    """Rows of the manifest are read by the tasks; the plan of the driver has their numbers only."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    root, made = dataset
    rows = [dict(subject_id=s, acq=a, path=str(next((root / s / a).iterdir()))) for s, a in made]
    path = tmp_path / f"manifest.{kind}"
    if kind == "parquet":
        pq.write_table(pa.Table.from_pylist(rows), path, row_group_size=3)
    else:
        path.write_text("\n".join(map(json.dumps, rows)))
    nifti_source.register(spark)
    reader = nifti_source.NiftiReader({"manifest": str(path), "manifestRows": "1"})
    assert [(p.first, p.last, p.scans) for p in reader.partitions()] == [(n, n + 1, []) for n in range(4)]
    for step in ("1", "3", "100"):
        assert cells(spark.read.format("nifti").option("manifest", str(path)).option("manifestRows", step).load()) == made_cells(made)


def test_nifti_filters_prune_files(spark, dataset):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    root, made = dataset
    reader = nifti_source.NiftiReader({"path": str(root), "acquisitions": ACQS})
    left = list(reader.pushFilters([EqualTo(("subject_id",), "s1"), In(("acq",), ("t1", "swi")), GreaterThan(("v",), 1.0)]))
    assert [type(f) for f in left] == [GreaterThan]
    assert [(s.subject_id, s.acq) for p in reader.partitions() for s in p.scans] == [("s1", "t1")]
    nifti_source.register(spark)
    df = spark.read.format("nifti").option("acquisitions", ACQS).load(str(root)).filter("subject_id = 's2' AND acq IN ('flair') AND v > 6")
    assert cells(df) == {k: v for k, v in made_cells(made).items() if k[:2] == ("s2", "flair") and v > 6}


def test_nifti_format_refuses(spark, dataset, tmp_path):
    root, _ = dataset
    with pytest.raises(ValueError):
        nifti_source.NiftiReader({})
    cut = tmp_path / "a" / "t1"
    cut.mkdir(parents=True)
    (cut / "scan.nii").write_bytes((root / "s1" / "t1" / "scan.nii").read_bytes()[:-3])
    nifti_source.register(spark)
    with pytest.raises(Exception, match="before its last plane"):
        spark.read.format("nifti").option("acquisitions", ACQS).load(str(tmp_path)).collect()
    (cut / "other.nii").write_bytes(b"")
    with pytest.raises(Exception, match="more than one file"):
        spark.read.format("nifti").option("acquisitions", ACQS).load(str(tmp_path)).collect()
    nobody = spark.read.format("nifti").option("acquisitions", json.dumps({"x": "nothing"})).load(str(root))
    assert nobody.count() == 0


def test_scan_and_read(spark, dataset):
    root, made = dataset
    scans = layout.scan_dataset(spark, str(root), {"t1": "t1", "flair": "flair"})
    assert scans.count() == 4
    heads = {(r.subject_id, r.acq): r for r in volumes.read_headers(scans).collect()}
    rows = volumes.read_volumes(scans).collect()
    carried = layout.scan_dataset(spark, str(root), {"t1": "t1", "flair": "flair"}, content=True)
    assert sorted(map(tuple, volumes.read_volumes(carried).collect())) == sorted(map(tuple, rows))
    for key, (volume, affine) in made.items():
        assert (heads[key].ni, heads[key].nj, heads[key].nk) == volume.shape
        assert np.allclose(np.reshape(heads[key].affine, (4, 4)), affine)
        back = np.zeros(volume.shape)
        for r in rows:
            if (r.subject_id, r.acq) == key:
                back[r.i, r.j, r.k] = r.v
        assert np.allclose(back, volume * 2.0)


def test_store_and_reuse(spark, dataset, tmp_path):
    root, _ = dataset
    scans = layout.scan_dataset(spark, str(root), {"t1": "t1"})
    volumes.store_voxels(volumes.read_volumes(scans), str(tmp_path / "stage"))
    only = spark.createDataFrame([("s1",)], "subject_id string")
    assert [r[0] for r in layout.reuse_stage(spark, str(tmp_path / "stage"), only).select("subject_id").distinct().collect()] == ["s1"]
    asked = spark.createDataFrame([("s1",), ("s9",)], "subject_id string")
    stored = layout.reuse_stage(spark, str(tmp_path / "stage"))
    assert [r[0] for r in subjects.missing_subjects(asked, stored).collect()] == ["s9"]


def test_bids_and_duplicates(spark, tmp_path):
    for name in ("a_T1w.nii", "a_FLAIR.nii.gz"):
        (tmp_path / "a" / "anat").mkdir(parents=True, exist_ok=True)
        (tmp_path / "a" / "anat" / name).write_bytes(b"x")
    found = layout.scan_dataset(spark, str(tmp_path), {"t1": "T1", "flair": "FLAIR"}, "bids")
    assert {(r.subject_id, r.acq) for r in found.collect()} == {("a", "t1"), ("a", "flair")}
    (tmp_path / "a" / "anat" / "a_T1w_2.nii").write_bytes(b"x")
    with pytest.raises(ValueError, match="more than one"):
        layout.scan_dataset(spark, str(tmp_path), {"t1": "T1"}, "bids")
    with pytest.raises(ValueError, match="no scan"):
        layout.scan_dataset(spark, str(tmp_path), {"t1": "SWI"}, "bids")


def test_manifest_and_pick(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"subject_id": "a", "acq": "swi", "path": "/x/2.nii"}\n{"subject_id": "b", "acq": "swi", "path": "/x/1.nii"}\n')
    assert layout.read_manifest(spark, str(tmp_path / "m.json")).count() == 2
    files = spark.createDataFrame([("a", "swi", f"/x/{n}.nii") for n in (3, 1, 2)], "subject_id string, acq string, path string")
    assert layout.pick_file(files, 1).first().path == "/x/2.nii"
    assert layout.pick_file(files, 5).first().path is None


def test_subject_lists(spark, tmp_path):
    (tmp_path / "list.txt").write_text("a; b|c\nd,e f\n\n")
    listed = subjects.read_subject_list(spark, str(tmp_path / "list.txt"))
    assert sorted(r[0] for r in listed.collect()) == list("abcdef")
    here = spark.createDataFrame([("a",), ("b",)], "subject_id string")
    with pytest.raises(ValueError, match="not available"):
        subjects.checked_subjects(here, listed)
    with pytest.raises(ValueError, match="no subject"):
        subjects.checked_subjects(here, here, here)
    assert subjects.expand_predictions(["all"]) == ["PVS2", "WMH", "CMB", "LAC"]
    assert subjects.expand_predictions(["all", "PVS"]) == ["PVS", "WMH", "CMB", "LAC"]


@pytest.mark.parametrize("name, text", [
    ("a.json", '{"Left": 1, "Right side": 2}'), ("b.json", '{"1": "Left", "2": "Right side"}'),
    ("c.tsv", "index\tname\tabbreviation\n1\tx\tLeft\n2\ty\tRight side\n"), ("d.tsv", "name\tindex\nLeft\t1\nRight side\t2\n"),
    ("e.lut", "1  0.5 0.5 0.5  Left\n2 0 0 0 Right side\n\n"),
    ("g.xml", '<atlas><data><label index="1" x="0">Left</label><label index="2" x="0">Right side</label></data></atlas>')])
def test_lut_formats(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    assert {(r.label, r.region) for r in lut_files.read_lut(spark, str(tmp_path / name)).collect()} == {(1, "Left"), (2, "Right side")}


def test_lut_txt_and_errors(spark, tmp_path):
    (tmp_path / "f.txt").write_text("# comment\n1 Left 10 10 10 0\n2   Right-side 0 0 0 0\n")
    assert {(r.label, r.region) for r in lut_files.read_lut(spark, str(tmp_path / "f.txt")).collect()} == {(1, "Left"), (2, "Right-side")}
    (tmp_path / "bad.json").write_text('{"a": "b"}')
    with pytest.raises(ValueError):
        lut_files.read_lut(spark, str(tmp_path / "bad.json")).collect()


def test_model_files(spark, tmp_path):
    (tmp_path / "m").mkdir()
    for n in range(3):
        (tmp_path / "m" / f"fold{n}.bin").write_bytes(bytes([n]) * 10)
    digest = {n: hashlib.md5(bytes([n]) * 10).hexdigest() for n in range(3)}
    doc = {"target": "WMH", "modalities": ["t1"], "files": [{"name": "m/fold0.bin", "md5": digest[0]}, {"name": "m/fold1.bin", "md5": "0"},
                                                            {"name": "m/fold9.bin", "md5": "1"}]}
    (tmp_path / "model_info.json").write_text(json.dumps(doc, indent=1))
    listed = descriptors.listed_files(descriptors.read_descriptor(spark, str(tmp_path / "model_info.json")))
    found = descriptors.file_checksums(spark, str(tmp_path), "*.bin")
    status = {r.name: r.status for r in descriptors.verify_model_files(listed, found).collect()}
    assert status == {"m/fold0.bin": "ok", "m/fold1.bin": "mismatch", "m/fold2.bin": "unlisted", "m/fold9.bin": "missing"}


def test_append_and_csv(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.005)], "subject_id string, peak double")
    tables.append_with_date(rows, str(tmp_path / "qc"), "2024-01-01")
    tables.append_with_date(rows, str(tmp_path / "qc"), "2024-01-02")
    assert spark.read.parquet(str(tmp_path / "qc")).count() == 2
    for sub, text in (("a", "size,peak\n1,0.5\n"), ("b", "size,peak,extra\n2,0.25,x\n"), ("c", "size,peak\n3,0.75\n")):
        (tmp_path / "csv" / sub).mkdir(parents=True)
        (tmp_path / "csv" / sub / "qc.csv").write_text(text)
    read = tables.read_subject_csvs(spark, str(tmp_path / "csv/*/qc.csv"))
    assert {(r.subject_id, r["size"], r.extra) for r in read.collect()} == {("a", "1", None), ("b", "2", "x"), ("c", "3", None)}
    tables.write_results(rows.withColumn("biomarker", F.lit("pvs")), str(tmp_path / "out"), "csv", "biomarker", digits=2)
    assert (tmp_path / "out" / "biomarker=pvs").exists()


def test_csv_quoted_line_ends_and_odd_files(spark, tmp_path):
    """Quoted line ends, quotes and commas, headers in other order or case, short, long and blank lines, empty files, a column named like the tag."""
    files = {"a": 'Size,note\n1,"two\nlines, ""quoted"""\r\n\n2,\n', "b": "note , size,SIZE\r\nx,3,9\r\ny\r\nz,4,9,9,9\r\n", "c": "", "d": "size,note\n",
             "e": "\ufeffsubject_id,size\nother,5", "f": 'size,note\n6,"' + "long " * 50_000 + '"\n'}
    for name, text in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "t.csv").write_bytes(text.encode())
    out = tables.read_subject_csvs(spark, str(tmp_path / "*/t.csv"))
    got = sorted(((r.subject_id, r["Size"], r.note, r.subject_id_in_file) for r in out.collect()), key=str)
    assert got == sorted([("a", "1", 'two\nlines, "quoted"', None), ("a", "2", None, None), ("b", "3", "x", None), ("b", None, "y", None), ("b", "4", "z", None),
                          ("e", "5", None, "other"), ("f", "6", "long " * 50_000, None)], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Union" not in plan
    assert tables.read_subject_csvs(spark, str(tmp_path / "[cd]/t.csv")).columns == ["subject_id"]


def test_many_csvs_are_listed_by_few_tasks(spark, tmp_path):
    """Files beyond a session's tasks are listed and read several a task; rows of several files travel together; the session's settings stay."""
    for n in range(100):
        (tmp_path / str(n)).mkdir()
        (tmp_path / str(n) / "t.csv").write_text(f"a,b\n{n},x\n" * 2 if n % 10 else "")
    keys = ["spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(k) for k in keys]
    sc = spark.sparkContext
    sc.setJobGroup("csvs", "")
    try:
        out = tables.read_subject_csvs(spark, str(tmp_path / "*/t.csv"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("csvs") for s in tracker.getJobInfo(j).stageIds]
    assert 1 < max(s.numTasks for s in stages if s) <= 8 * sc.defaultParallelism < 100
    assert [spark.conf.get(k) for k in keys] == before
    rows = [(str(n), *row) for n in range(100) if n % 10 for row in ((str(n), "x"), ("a", "b"), (str(n), "x"))]
    assert sorted(map(tuple, out.collect())) == sorted(rows)


def test_stage_store(spark, tmp_path):
    """Lost, repeated and empty writes; resumed runs make only what is missing; reading some subjects opens their buckets only."""
    from voxelry.sources.stages import StageStore

    store = StageStore(spark, str(tmp_path / "stages"), 8)
    everyone = spark.createDataFrame([(f"s{n}",) for n in range(12)], "subject_id string")
    rows = everyone.filter("subject_id <> 's3'").select("subject_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("i"))  # s3 has no row
    made = []

    def make(todo):
        names = sorted(r.subject_id for r in todo.collect())
        made.append(names)
        return rows.join(todo, "subject_id", "left_semi").withColumn("turn", F.lit(len(made)))

    with pytest.raises(ValueError):
        store.read("crop")
    first = everyone.filter("subject_id IN ('s1', 's2', 's3')")
    store.write_data("crop", rows.withColumn("turn", F.lit(99)))  # lost before its commit
    assert {(r.subject_id, r.i, r.turn) for r in store.resume("crop", first, make).collect()} == {(s, i, 1) for s in ("s1", "s2") for i in range(1, 6)}
    out = store.resume("crop", everyone, make)
    assert made == [["s1", "s2", "s3"], sorted(f"s{n}" for n in range(12) if n not in (1, 2, 3))]
    assert out.count() == 55 and out.filter("turn = 99").count() == 0
    assert store.resume("crop", everyone, make).count() == 55 and len(made) == 2 and store.missing("crop", everyone).isEmpty()
    store.write("crop", rows.filter("subject_id = 's5'").withColumn("turn", F.lit(7)), everyone.filter("subject_id = 's5'"))
    one = store.read("crop", everyone.filter("subject_id = 's5'"))
    assert [(r.i, r.turn) for r in one.orderBy("i").collect()] == [(i, 7) for i in range(1, 6)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    store.drop("crop")
    assert store.commits("crop") is None
