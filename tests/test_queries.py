"""Every registered query against its SQL, and the driver's contract."""

import re

import pytest

import __spark_entry__ as entry
from suite.catalog import ORACLES, QUERIES
from suite.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    # The smallest tables have no row for some filters.
    assert compare(spark, con, name, SF_DIR, may_be_empty=True) is None


def test_contract(spark):
    assert entry.entry(spark).columns == ["bucket", "key", "version_id", "size"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


def test_results_do_not_depend_on_partitioning(spark):
    names = ("greedy_batches", "quantile_bins", "attribute_clusters", "dim_steps", "facility_subset")
    for name in names:
        seen = []
        for partitions in ("1", "5"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            seen.append(sorted(map(str, QUERIES[name](spark, SF_DIR).collect())))
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert seen[0] == seen[1], name


def test_no_cross_joins(spark):
    for name in ("stale_products", "similar_attribute_pairs", "missing_variables", "extent_rollup",
                 "quantile_bins", "mapping_correctness", "delta_inventory"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan), name
