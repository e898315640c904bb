import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom import schema as C
from fathom.functions import attributes as A
from fathom.operators import dead_letters as D
from fathom.operators import extract as E

HDF = b"\x89HDF\r\n\x1a\n"


def attr(name, value, vtype="str"):
    return {"name": name, "value": value, "vtype": vtype}


def header(spark, attrs=(), variables=(), dims=(), magic=HDF, key="r/f/x.nc", version="0"):
    schema = T.StructType.fromDDL(C.HEADER_DDL)
    row = {
        "bucket": "test", "key": key, "version_id": version, "size": 32,
        "magic": bytearray(magic), "global_attrs": list(attrs), "variables": list(variables),
        "dims": list(dims),
    }
    return spark.createDataFrame([row], schema)


def structured(spark, **parts):
    row = E.extract(header(spark, **parts)).first()
    assert row.error is None, row.error
    return row.structured


def test_names_vary(spark):
    got = structured(
        spark,
        attrs=[attr("conventions", "CF-1.7 draft"), attr("featureType", "profile"),
               attr("instrumentSerialNumber", "SN 77-b")],
    )
    assert (got.conventions, got.feature_type) == ("CF-1.7 draft", "profile")
    assert got.instrument_serial_number == "SN 77-b"
    assert got.facility == "f" and got.file_format == "NETCDF4" and got.schema_version == 6


def test_exact_names_by_priority_before_similar_ones(spark):
    got = structured(
        spark,
        attrs=[attr("CONVENTIONS", "first"), attr("conventions", "lower form"),
               attr("Conventions", "upper form"), attr("Site-Code", "loose1"), attr("SITECODE", "loose2"),
               attr("platformcode", "x"), attr("platform_code", "exact")],
    )
    assert got.conventions == "upper form"
    assert got.site_code == "loose1"
    assert got.platform_code == "exact"


def variable(name, dtype, dims, is_coord, **attrs):
    return {"name": name, "dtype": dtype, "dims": dims, "is_coord": is_coord,
            "attrs": [attr(k, v) for k, v in attrs.items()]}


VARIABLES = [
    variable("temp", "float64", ["time", "lat"], False, standard_name="sea_water_temperature"),
    variable("salinity", "float64", ["time", "lat"], False, standard_name="sea_water_salinity"),
    variable("time", "int64", ["time"], True, standard_name="time"),
    variable("lat", "float64", ["lat"], True, standard_name="latitude"),
    variable("flag", "int8", [], False, standard_name=""),
]


def test_shapes(spark):
    got = structured(spark, variables=VARIABLES,
                     dims=[{"name": "time", "size": 1}, {"name": "lat", "size": 2}])
    assert got.variable_schema == {"flag": "int8", "salinity": "float64", "temp": "float64"}
    assert got.coordinate_schema == {"lat": "float64", "time": "int64"}
    assert got.dimension_sizes == {"lat": 2, "time": 1}
    assert got.standard_names == {
        "lat": "latitude", "salinity": "sea_water_salinity", "temp": "sea_water_temperature",
        "time": "time",
    }


def test_empty_maps_are_null(spark):
    got = structured(spark)
    for name in ("variable_schema", "coordinate_schema", "dimension_sizes", "standard_names"):
        assert got[name] is None


@pytest.mark.parametrize(
    "text", ["1.5", " 2 ", "1_0", "1e3", "-.5", "5.", "inf", "-Infinity", "12d", "n/a", "", "1__0",
             "_1", "1,5", "0x10", "1e", "+3", "NaN"],
)
def test_numbers_read_like_python(spark, text):
    try:
        want = float(text)
    except ValueError:
        want = None
    got = spark.createDataFrame([(text,)], "t string").select(A.to_number(F.col("t")).alias("x")).first().x
    assert got == want or (got != got and want != want)


def test_payload(spark):
    row = E.extract(
        header(spark, attrs=[attr("title", 'a "b" \\ \n'), attr("n", "1.5", "float"),
                             attr("l", "[1,2]", "list")], variables=VARIABLES)
    ).first()
    payload = json.loads(row.unstructured.metadata)
    assert payload["global_attrs"] == {"title": 'a "b" \\ \n', "n": 1.5, "l": [1, 2]}
    assert list(payload["variables"]) == ["temp", "salinity", "flag"]
    assert payload["coordinates"]["lat"] == {
        "attrs": {"standard_name": "latitude"}, "dims": ["lat"],
    }


@pytest.mark.parametrize(
    "parts, error",
    [
        ({"magic": b"PK"}, "unrecognised file format"),
        ({"version": None}, "identity field is missing: version_id"),
        ({"variables": [VARIABLES[0], VARIABLES[0]]}, "repeated variable name"),
        ({"attrs": [attr("a", "1"), attr("a", "2")]}, "repeated attribute name"),
        ({"dims": [{"name": "d", "size": 1}] * 2}, "repeated dimension name"),
    ],
)
def test_bad_headers_become_errors(spark, parts, error):
    row = E.extract(header(spark, **parts)).first()
    assert (row.structured, row.unstructured, row.error) == (None, None, error)


def test_reader_plug_in(spark):
    refs = spark.createDataFrame(
        [("b", "r/f/good.nc", "1", 1), ("b", "r/f/bad.nc", "1", 2)],
        "bucket string, key string, version_id string, size bigint",
    )

    attrs = [attr("title", f"{chr(0xDCFF)}bad"), attr("raw", b"\xffz")]

    def reader(reference):
        if "bad" in reference["key"]:
            raise OSError("truncated file")
        return {
            "magic": b"CDF\x01",
            "global_attrs": attrs,
            "variables": [],
            "dims": [],
        }

    good, bad = D.split_results(E.extract(E.read_headers(refs, reader)))
    payload = json.loads(good.first().unstructured.metadata)
    assert payload["global_attrs"] == {"title": "\\udcffbad", "raw": "\\xffz"}
    assert good.first().structured.file_format == "NETCDF3_CLASSIC"
    assert [r.error for r in bad.collect()] == ["truncated file"]


def test_bytes_text(spark):
    df = spark.createDataFrame([(bytearray(b"ok \xc3\xa9"),), (bytearray(b"\xe9x"),), (None,)], "b binary")
    got = [r.x for r in df.select(A.text_from_bytes(F.col("b")).alias("x")).collect()]
    assert got == ["ok é", "\\xe9x", None]


def test_no_shuffle_and_no_python(spark, tmp_path):
    path = str(tmp_path / "h")
    header(spark, variables=VARIABLES).write.parquet(path)
    plan = E.extract(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan


def test_headers_are_not_shuffled(spark, monkeypatch):
    """What is dealt to the tasks that write the header table are orders, not the rows made of them."""
    from suite import views as V

    seen = []
    monkeypatch.setattr(V, "_STORED", {})
    monkeypatch.setattr(V, "materialize", lambda df: seen.append(df) or df)
    V.header(spark, "/root/testdata/sf0.001")
    shuffle = seen[0]._jdf.queryExecution().optimizedPlan()
    while "Repartition" not in shuffle.nodeName():
        shuffle = shuffle.children().head()
    names = {a.name() for a in (shuffle.output().apply(i) for i in range(shuffle.output().size()))}
    assert names and all(n.startswith("o_") for n in names)
