"""Positions of scans whose origin lies on a voxel."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from voxelry.functions import matrix


def test_origin_on_a_voxel_is_not_rounded_past_it(spark, tmp_path):
    """Headers whose origin is a whole number of voxels away, as SQL computes it."""
    path = tmp_path / "supplier.parquet"
    rows = "(5454::BIGINT, 1::INT, 6170.25::DOUBLE), (12792, 3, 8630.25), (16230, 4, 9090.25)"
    duckdb.execute(f"COPY (SELECT * FROM (VALUES {rows}) t(s_suppkey, s_nationkey, s_acctbal)) TO '{path}' (FORMAT parquet)")
    got = {tuple(r) for r in entry.queries()["crop_box_world"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{path}'")
    assert got == set(con.execute(entry.oracle_sql()["crop_box_world"]).fetchall())


def test_origin_voxel_of_any_axes(spark):
    rng = np.random.default_rng(1)
    affines = rng.normal(size=(20, 4, 4))
    for a in affines[:10]:
        a[:3, :3] = np.eye(3)[rng.permutation(3)] * [-2.0, 0.5, 1.5]
    rows = spark.createDataFrame([(n, a.ravel().tolist()) for n, a in enumerate(affines)], "n int, a array<double>")
    for r in rows.select("n", matrix.origin_voxel(F.col("a")).alias("x")).collect():
        assert r.x == pytest.approx(np.linalg.solve(affines[r.n, :3, :3], -affines[r.n, :3, 3]), abs=1e-8)
