import datetime as dt

import pytest
from pyspark.sql import functions as F

from fathom.functions.identity import object_hash
from fathom.sources import inventory as I

DDL = "bucket string, key string, version_id string, size bigint"


def refs(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def test_delta(spark):
    source = refs(spark, ("b1", "k1", "v1", 100), ("b1", "k2", "v1", 200), ("b2", "k3", "v1", 300))
    sink = refs(spark, ("b1", "k1", "v1", 100), ("b4", "k9", "v1", 999))
    got = I.delta_inventory(source, [sink]).orderBy("key").collect()
    assert [tuple(r) for r in got] == [("b1", "k2", "v1", 200), ("b2", "k3", "v1", 300)]


def test_delta_custom_keys_and_many_sinks(spark):
    source = spark.createDataFrame([("k1",), ("k2",), ("k3",), (None,)], "src_key string")
    one = spark.createDataFrame([("k1",), (None,)], "snk_key string")
    two = spark.createDataFrame([("k3", 1), ("k3", 2)], "snk_key string, n int")
    got = I.delta_inventory(source, [one, two], ["src_key"], ["snk_key"]).collect()
    assert sorted(str(r.src_key) for r in got) == ["None", "k2"]
    with pytest.raises(ValueError):
        I.delta_inventory(source, [])


def test_lookback_start():
    now = dt.datetime(2026, 7, 1, 12, 34, 56, 7, tzinfo=dt.UTC)
    assert I.lookback_start(now, days=1, hours=2) == dt.datetime(2026, 6, 30, 10)
    assert I.lookback_start(now, days=10, floor="day") == dt.datetime(2026, 6, 21)


def test_lookback_joins_existing_filter(spark):
    rows = [(dt.datetime(2026, 6, 30, 10), 1), (dt.datetime(2026, 6, 30, 9, 59, 59), 1),
            (dt.datetime(2026, 7, 1), 5)]
    df = spark.createDataFrame(rows, "last_modified_date timestamp_ntz, n int")
    now = dt.datetime(2026, 7, 1, 12)
    kept = df.filter(I.lookback(now, 1, 2, existing="n = 1 OR n = 2"))
    assert [r.last_modified_date for r in kept.collect()] == [dt.datetime(2026, 6, 30, 10)]


def test_scan_filters_before_projection(spark):
    df = refs(spark, ("b", "IMOS/SOOP/x", "v", 1), ("b", "IMOS/XX/x", "v", 2))
    scan = I.Scan(row_filter="size > 1", fields=("key",), limit=5)
    assert [tuple(r) for r in scan.apply(df).collect()] == [("IMOS/XX/x",)]
    assert df.filter(I.starts_with_any(F.col("key"))).count() == 1
    assert df.filter(I.key_like("IMOS/%", "size = 1")).count() == 1
    assert df.filter(I.key_like()).count() == 2
    empty = I.empty_inventory(spark)
    assert empty.count() == 0 and empty.dtypes[-1] == ("size", "bigint")


def test_delete_markers_are_kept_unless_asked(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "n int, is_delete_marker boolean")
    assert I.Scan().apply(df).count() == 3
    assert I.Scan(drop_delete_markers=True).apply(df).count() == 2


def test_prefixes_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "inv")
    refs(spark, ("b", "IMOS/SOOP/x", "v", 1)).write.parquet(path)
    scan = I.scan_parquet(
        spark, path, I.Scan(row_filter=I.starts_with_any(F.col("key")), fields=("size",))
    )
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith" in plan and "version_id" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_facility_subset_equals_one_ranking(spark, buckets):
    rows = [("b", f"r/F{0 if i % 10 else 1}/{i}/x.nc", str(i), i) for i in range(500)]
    df = refs(spark, *rows)
    got = I.facility_subset(df, per_facility=40, seed="s", buckets=buckets)
    drawn = df.withColumn("f", F.split("key", "/")[1]).withColumn(
        "d", F.sha2(F.concat(F.lit("s:"), object_hash(*map(F.col, ("bucket", "key", "version_id")))), 256)
    ).collect()
    want = set()
    for f in ("F0", "F1"):
        want |= {r.key for r in sorted((r for r in drawn if r.f == f), key=lambda r: r.d)[:40]}
    assert {r.key for r in got.collect()} == want and len(want) == 80
