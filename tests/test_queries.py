"""Every registered query against its SQL check, on the driver's tables."""

import sys

import pytest
from compare import check, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    result, *_ = check(spark, name, QUERIES[name], ORACLES.get(name), sf, con)
    assert result in ("ok", "rows only"), result


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert "voxelry.catalog" in sys.modules


def test_wide_metrics_hold_every_region(spark, sf):
    """One column for every region and statistic that anybody has a value of, with the values of the table that keeps empty ones."""
    every = QUERIES["region_stats_wide"](spark, sf).toPandas().set_index("subject_id").sort_index().dropna(axis=1, how="all")
    wide = QUERIES["cohort_metrics_wide"](spark, sf).toPandas().set_index("subject_id").sort_index()
    assert len({c.split(" - ")[0] for c in wide.columns}) == 12
    assert list(wide.columns) == list(every.columns) and wide.equals(every)
