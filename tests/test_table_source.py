import pyarrow.dataset as ds
import pytest
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from fathom.sources import table_source as S
from fathom.sources.inventory import Scan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "inventory")
    rows = [("b", f"IMOS/{'ANMN' if i % 3 else 'SOOP'}/k{i:04d}.nc", str(i) if i % 4 else None, i if i % 5 else None, i % 2 == 0, i / 7)
            for i in range(600)]
    df = spark.createDataFrame(rows, "bucket string, key string, version_id string, size bigint, is_delete_marker boolean, share double")
    df = df.selectExpr("*", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, size) AS seen")
    df = df.selectExpr("*", "cast(seen AS timestamp) AS at", "cast(seen AS date) AS day")
    df.repartitionByRange(4, "key").write.option("parquet.block.size", 4096).parquet(path)
    return path


FILTERS = [
    "size > 500", "size >= 100 AND size < 120", "size IS NULL", "size IS NOT NULL AND version_id IS NULL",
    "key LIKE 'IMOS/SOOP/%'", "key LIKE '%7.nc'", "key LIKE '%k01%'", "size IN (3, 4, 5)", "NOT (size > 10)", "size <> 7",
    "NOT (size IN (1, 2))", "is_delete_marker", "NOT is_delete_marker", "version_id <=> '5'", "size = 5 OR key LIKE '%9.nc'",
    "size > 500 AND key RLIKE '[02468].nc'", "share > 80.5", "share < 1", "size IN (3, NULL)", "size = NULL", "NOT (size IN (3, NULL))",
    "seen >= timestamp_ntz'2024-01-03 07:00:00'", "seen = timestamp_ntz'2024-01-02 00:00:00'", "at < timestamp'2024-01-03 00:00:00'",
    "seen IN (timestamp_ntz'2024-01-01 05:00:00')", "day > date'2024-01-05'",
]


@pytest.mark.parametrize("row_filter", FILTERS)
def test_same_rows_as_a_plain_scan(spark, stored, row_filter):
    scan = Scan(row_filter=row_filter, fields=("key", "size"))
    want = scan.apply(spark.read.parquet(stored))
    got = S.scan_source(spark, stored, scan)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_filters_reach_the_source(spark, stored):
    df = S.scan_source(spark, stored, Scan(row_filter="size > 500 AND key LIKE 'IMOS/SOOP/%' AND key RLIKE 'k'", fields=("key",)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" in plan and "StartsWith(key" not in plan and "size#" in plan and "version_id" not in plan
    assert "> 500" not in plan  # only the source tests it


def test_row_groups_are_left_out(stored):
    reader = S.InventoryTable({"path": stored, "groupsPerTask": "1"})
    every = reader.reader(reader.schema()).partitions()
    one = reader.reader(reader.schema())
    assert list(one.pushFilters([D.EqualTo(("key",), "IMOS/SOOP/k0003.nc")])) == []
    assert len(every) >= 4 and len(one.partitions()) == 1
    none = reader.reader(reader.schema())
    list(none.pushFilters([D.GreaterThan(("size",), 10**9)]))
    assert [list(none.read(p)) for p in none.partitions()] == [[]]


def test_limit(spark, stored):
    assert S.scan_source(spark, stored, Scan(limit=7)).count() == 7
    assert S.scan_source(spark, stored, Scan(limit=10**6)).count() == 600
    # Rows that Spark alone can test: the limit holds for what is left.
    some = S.scan_source(spark, stored, Scan(row_filter="key RLIKE '[13579].nc'", limit=290))
    assert some.count() == 290 and some.filter("key RLIKE '[02468].nc'").count() == 0
    reader = S.InventoryTable({"path": stored, "limit": "3"})
    task = reader.reader(reader.schema())
    assert all(sum(b.num_rows for b in task.read(p)) <= 3 for p in task.partitions())
    list(task.pushFilters([D.GreaterThan(("share",), 0.5)]))
    assert task.limit is None


def test_names_by_case(spark, stored):
    with pytest.raises(Exception, match="Size"):
        S.scan_source(spark, stored, Scan(fields=("Size",))).collect()
    with pytest.raises(Exception, match="(?i)size"):
        S.scan_source(spark, stored, Scan(row_filter="SIZE > 1", fields=("key",))).collect()
    loose = S.scan_source(spark, stored, Scan(row_filter="SIZE = 6", fields=("KEY", "Version_id")), case_sensitive=False)
    assert loose.columns == ["key", "version_id"] and [r.version_id for r in loose.collect()] == ["6"]
    assert spark.conf.get(S.CASE_CONF) == "false"
    assert S.resolve(["a", "A"], ["A"], True) == ["A"]
    with pytest.raises(ValueError, match="ambiguous"):
        S.resolve(["a", "A"], ["A"], False)


def test_empty_table_and_delete_markers(spark, stored, tmp_path):
    path = str(tmp_path / "none")
    spark.read.parquet(stored).filter("size < 0").write.parquet(path)
    assert S.scan_source(spark, path, Scan(row_filter="size > 1")).collect() == []
    kept = S.scan_source(spark, stored, Scan(fields=("key",), drop_delete_markers=True, limit=1000))
    assert kept.columns == ["key"] and kept.count() == 300
    assert ds.dataset(stored).count_rows() == S.scan_source(spark, stored).count()
    assert S.scan_source(spark, stored, Scan(row_filter=F.col("size") > 590, fields=("key",))).count() == 8
