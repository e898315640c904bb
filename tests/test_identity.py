import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fathom.functions import identity as N


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expr.alias("x")).first().x


@pytest.mark.parametrize("version", ["v1", None])
def test_hash_equals_hashlib(spark, version):
    got = one(
        spark, N.object_hash(F.col("b"), F.col("k"), F.col("v")), b="bucket", k="å/ü.nc", v=version
    )
    want = hashlib.sha256(f"bucket:bucket|key:å/ü.nc|version:{version}".encode()).hexdigest()
    assert got == want


def test_uris_and_paths(spark):
    b, k, v = F.col("b"), F.col("k"), F.col("v")
    values = {"b": "b", "k": "x//y/./z.nc", "v": "7"}
    assert one(spark, N.object_uri(b, k), **values) == "s3://b/x//y/./z.nc"
    assert one(spark, N.versioned_uri(b, k, v), **values) == "s3://b/x//y/./z.nc?versionId=7"
    assert one(spark, N.object_path(b, k, v), **values) == "b/x/y/z.nc/7"
    assert one(spark, N.version_path(b, k, v), **values) == "b/x/y/z.nc:7"
    assert one(spark, N.version_path(b, k, v), b="b", k="k/", v="") == "b/k"
    assert one(spark, N.versioned_uri(b, k, v), b="b", k="k", v=None) == "s3://b/k?versionId=None"


@pytest.mark.parametrize(
    "key, facility",
    [
        ("IMOS/ANMN/NSW/file.nc", "ANMN"),
        ("/IMOS//ANMN/file.nc", "ANMN"),
        ("IMOS/ANMN", "UNKNOWN"),
        ("IMOS/ANMN/", "UNKNOWN"),
        ("a/  /c", "UNKNOWN"),
        ("a/ b\t/c", "b"),
        ("", "UNKNOWN"),
        ("file.nc", "UNKNOWN"),
    ],
)
def test_facility(spark, key, facility):
    assert one(spark, N.derive_facility(F.col("k")), k=key) == facility


@pytest.mark.parametrize(
    "uri, collection",
    [
        ("s3://bucket/IMOS/SOOP/x/file.nc", "SOOP"),
        ("s3://bucket/IMOS/file.nc", None),
        ("s3://bucket", None),
    ],
)
def test_collection(spark, uri, collection):
    assert one(spark, N.derive_collection(F.col("u")), u=uri) == collection


@pytest.mark.parametrize(
    "magic, name",
    [
        (b"CDF\x01rest", "NETCDF3_CLASSIC"),
        (b"CDF\x02", "NETCDF3_64BIT_OFFSET"),
        (b"CDF\x05", "NETCDF5"),
        (b"\x89HDF\r\n\x1a\n", "NETCDF4"),
        (b"\x89HDF\r\n", None),
        (b"PK\x03\x04", None),
        (b"", None),
    ],
)
def test_magic(spark, magic, name):
    df = spark.createDataFrame([(bytearray(magic),)], "m binary")
    assert df.select(N.format_from_magic(F.col("m")).alias("x")).first().x == name


def test_small_rules(spark):
    k = F.col("k")
    assert one(spark, N.dir_prefix(k), k="a/b/c.nc") == "a/b/"
    assert one(spark, N.extract_year(k), k="from 12345 to 2019-01") == 2019
    assert one(spark, N.extract_year(k), k="none") is None
    assert one(spark, N.item_id(k), k="a/b.c.nc") == "a_b_c_nc"
    assert one(spark, N.file_type(k), k="a.b/c") == "b/c"
    sizes = spark.createDataFrame([(1,), (N.RANGE_READ_BYTES + 1,), (None,)], "s bigint")
    got = [r.x for r in sizes.select(N.route_by_size(F.col("s")).alias("x")).collect()]
    assert got == ["disk", "cloud", "cloud"]


def test_hash_parts_cannot_shift(spark):
    rng = random.Random(1)
    rows = [tuple("".join(rng.choices("ab|:k", k=3)) for _ in range(3)) for _ in range(300)]
    df = spark.createDataFrame(sorted(set(rows)), "b string, k string, v string")
    hashes = df.select(N.object_hash(F.col("b"), F.col("k"), F.col("v")).alias("h"))
    assert hashes.distinct().count() == df.count()
