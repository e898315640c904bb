import datetime as dt

import pytest
from pyspark.sql import functions as F

from fathom.functions import units as U
from fathom.functions.coordinates import classify_coord
from fathom.operators import collections as T
from fathom.operators import extents as X
from fathom.sources import files as S


@pytest.mark.parametrize(
    "name, units, positive, dtype, role",
    [
        ("Latitude", "m", None, "f", "latitude"),
        ("depth", None, None, "f", "depth"),
        (None, "degrees_east", None, "f", "longitude"),
        (None, "degree_N", "up", "f", "latitude"),
        (None, None, None, "datetime64[ns]", "time"),
        (None, "days since 1950-01-01", None, "f", "time"),
        (None, "dbar", None, "f", "depth"),
        (None, "m", "Down", "f", "depth"),
        ("air_pressure", "hPa", None, "f", "other"),
        ("surface_downward_stress", "Pa", None, "f", "other"),
        (None, "celsius", None, "f", "other"),
        (None, None, None, "f", "other"),
        (None, "kbar", None, "f", "depth"),
        (None, "mmHg", None, "f", "depth"),
        (None, "pascals", None, "f", "depth"),
        (None, "N m-2", None, "f", "depth"),
        (None, "kg m^-1 s**-2", None, "f", "depth"),
        (None, "1e4 N/m2", None, "f", "depth"),
        (None, "Pa s", None, "f", "other"),
        (None, "N m", None, "f", "other"),
        (None, "nonsense", "down", "f", "other"),
        (None, "m furlongs", "up", "f", "other"),
        (None, "", "up", "f", "depth"),
        (None, None, "up", "f", "depth"),
    ],
)
def test_coordinate_roles(spark, name, units, positive, dtype, role):
    df = spark.createDataFrame([(name, units, positive, dtype)], "n string, u string, p string, d string")
    got = df.select(classify_coord(*[F.col(c) for c in "nupd"]).alias("x")).first().x
    assert got == role


@pytest.mark.parametrize(
    "text, powers",
    [
        ("m", (1, 0, 0)), ("km", (1, 0, 0)), ("kilometres", (1, 0, 0)), ("min", (0, 0, 1)), ("minutes", (0, 0, 1)),
        ("hPa", (-1, 1, -2)), ("decibars", (-1, 1, -2)), ("dag", (0, 1, 0)), ("MPa", (-1, 1, -2)), ("m s-1", (1, 0, -1)),
        ("m/s", (1, 0, -1)), ("m.s-2", (1, 0, -2)), ("kg m-3", (-3, 1, 0)), ("W m-2", (0, 1, -3)), ("kg/m/s2", (-1, 1, -2)),
        ("1", (0, 0, 0)), ("%", (0, 0, 0)), ("1e-3", (0, 0, 0)), ("", (0, 0, 0)), ("1e-3 kg * m", (1, 1, 0)), ("2 / s", (0, 0, -1)),
        ("kilom", None), ("mmeter", None), ("kkm", None), ("m//s", None), ("(m)", None), ("m-", None), ("psuu", None),
    ],
)
def test_unit_dimensions(spark, text, powers):
    got = spark.createDataFrame([(text,)], "u string").select(U.dimension(F.col("u")).alias("d")).first().d
    assert (got and tuple(got[:3])) == powers and (not got or set(got[3:]) == {0})


COORDS = "hash string, var string, idx bigint, value double"


def test_boxes(spark):
    rows = [("p", "LATITUDE", 0, 1.0), ("p", "LONGITUDE", 0, 2.0), ("p", "TIME", 0, 5.0),
            ("q", "LATITUDE", 0, 1.0), ("q", "LATITUDE", 1, 3.0), ("q", "LONGITUDE", 0, 2.0),
            ("q", "TIME", 0, None), ("q", "TIME", 1, 6.0), ("q", "TIME", 2, 9.0)]
    got = {r.hash: r for r in X.file_extents(spark.createDataFrame(rows, COORDS)).collect()}
    assert got["p"].geometry.type == "Point" and got["p"].geometry.coordinates == [[2.0, 1.0]]
    assert got["p"].time == (5.0, None, None)
    assert got["q"].geometry.coordinates == [[2, 1], [2, 1], [2, 3], [2, 3], [2, 1]]
    assert got["q"].time == (None, 6.0, 9.0)


def test_steps(spark):
    rows = [("f", "x", i, 2.0 * i) for i in range(4)]
    rows += [("f", "y", 0, 1.0), ("f", "y", 1, 2.0), ("f", "z", 0, 1.0), ("f", "z", 1, 2.0), ("f", "z", 2, 4.0)]
    df = spark.createDataFrame(rows, COORDS)
    for stretch in (1, 2, 3, 100):
        got = {r["var"]: r for r in X.dim_steps(df, stretch=stretch).collect()}
        assert {v: r.step for v, r in got.items()} == {"x": 2.0, "y": None, "z": None}
        assert (got["x"].n_values, got["x"].extent_min, got["x"].extent_max) == (4, 0.0, 6.0)


def test_properties(spark):
    kind = "array<struct<name:string,value:string,vtype:string>>"
    rows = [([("abstract", "A", "str"), ("b", "1", "int"), ("description", "D", "str")],),
            ([("description", "D", "str")],)]
    df = spark.createDataFrame(rows, f"attrs {kind}")
    got = [[(a.name, a.value) for a in r.x] for r in
           df.select(X.item_properties(F.col("attrs")).alias("x")).collect()]
    assert got == [[("description", "A"), ("b", "1")], [("description", "D")]]


@pytest.mark.parametrize(
    "key, prefix",
    [
        ("IMOS/ANMN/NSW/S/Temperature/X_FV01_Y.nc", "7e13b5f3"),
        ("IMOS/ANMN/NSW/S/Wave/X_FV01_AWAC_Y.nc", "aaebf991"),
        ("IMOS/ANMN/NSW/S/hourly_timeseries/X.nc", "efd8201c"),
        ("xIMOS/ANMN/NSW/S/hourly_timeseries/X.nc", "unknown_collection"),
        ("IMOS/ANMN/AM/a-realtime.nc", "4d3d4aca"),
    ],
)
def test_collection_rules(spark, key, prefix):
    got = spark.createDataFrame([(key,)], "k string").select(T.collection_id(F.col("k")).alias("x"))
    assert got.first().x.startswith(prefix)


TREE = [("r", None), ("n1", "r"), ("n2", "r"), ("c1", "n1"), ("c2", "n1")]


def test_rollup(spark):
    tree = spark.createDataFrame(TREE, "id string, parent_id string")
    sides = ", ".join(f"{s} double" for s in X.SIDES)
    items = spark.createDataFrame(
        [("c1", 0.0, 0.0, 1.0, 1.0, 5.0, 6.0), ("c1", -3.0, 0.0, 1.0, 2.0, 4.0, 5.0),
         ("n2", 9.0, 9.0, 9.0, 9.0, 1.0, 1.0)], f"collection_id string, {sides}",
    )
    got = {r.collection_id: tuple(r)[1:] for r in
           T.extent_rollup(X.collection_extent(items), tree).collect()}
    assert got["c1"] == got["n1"] == (-3.0, 0.0, 1.0, 2.0, 4.0, 6.0, 2)
    assert got["r"] == (-3.0, 0.0, 9.0, 9.0, 1.0, 6.0, 3)
    assert "c2" not in got


def test_cycles_fail(spark):
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "id string, parent_id string")
    with pytest.raises(ValueError, match="cycle"):
        T.ancestors(loop)


def test_a_cycle_above_a_collection_fails(spark):
    loop = spark.createDataFrame([("x", "a"), ("a", "b"), ("b", "a")], "id string, parent_id string")
    with pytest.raises(ValueError, match="cycle"):
        T.ancestors(loop)


def test_tree_of_wanted(spark):
    info = spark.createDataFrame(
        [(i, "" if i == "n1" else f"T{i}", "d", p) for i, p in TREE],
        "id string, title string, description string, parent_id string",
    )
    wanted = spark.createDataFrame([("c1",), ("new",)], "id string")
    got = {r.id: (r.title, r.parent_id) for r in T.collection_tree(wanted, info).collect()}
    assert got == {"c1": ("Tc1", "n1"), "n1": ("n1", "r"), "r": ("Tr", None), "new": ("new", None)}


def test_changes(spark):
    found = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "item_id string, checksum string")
    old = spark.createDataFrame([("a", "1"), ("b", "9"), ("z", "0")], "item_id string, checksum string")
    got = {r.item_id: r.action for r in T.changed_objects(found, old).collect()}
    assert got == {"a": "skip", "b": "replace", "c": "add"}
    assert sorted(r.item_id for r in T.work_list(found, old).collect()) == ["b", "c"]


@pytest.mark.parametrize(
    "names, want",
    [
        (["Latitude", "LON", "time"], ("Latitude", "LON", "time", None)),
        (["my_time", "date", "lat"], ("lat", None, "date", None)),
        (["my_time", "other_date"], (None, None, "my_time", None)),
        (["a", "b"], (None, None, None, "Time column not found")),
        (["time", "Date"], (None, None, "Date", None)),
    ],
)
def test_csv_roles(spark, names, want):
    rows = [("f", i, n) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "file_path string, pos int, name string")
    assert tuple(S.column_roles(df).first())[1:] == want


def test_csv_files_of_many_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time,lat,lon,n\n2020-01-01,1,2,1\n2020-01-03,0.5,3,2\n")
    (tmp_path / "b.csv").write_text('n,"Lon, raw",LON,Date,LAT,ok\n9,x,8,2020-01-05,7,true\n,,8.5,2020-01-05,,TRUE\n')
    (tmp_path / "no_lat.csv").write_text("lon,start date\n4,2021-02-03\n")
    (tmp_path / "no_time.csv").write_text('lat,lon,"a ""b""\nc"\n1,2,"x,y"\n')
    (tmp_path / "only_names.csv").write_text("\ufefftime,lat,lon")
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "other.txt").write_text("time\n2020-01-01\n")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "z.csv").write_text("time\nnot a time\n")
    path = str(tmp_path)
    name = lambda r: r.file_path.rsplit("/", 1)[1].removesuffix(".csv")
    heads = {name(r): r.names for r in S.csv_layouts(spark, path).collect()}
    assert heads == {
        "a": ["time", "lat", "lon", "n"], "b": ["n", "Lon, raw", "LON", "Date", "LAT", "ok"], "no_lat": ["lon", "start date"],
        "no_time": ["lat", "lon", 'a "b"\nc'], "only_names": ["time", "lat", "lon"], "z": ["time"],
    }
    got = {name(r): r for r in S.csv_extents(spark, path).collect()}
    a, b = got["a"], got["b"]
    assert (a.west, a.south, a.east, a.north, a.latitude) == (2.0, 0.5, 3.0, 1.0, "lat")
    assert (a.start_datetime, a.end_datetime, a.datetime) == (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 3), None)
    assert (b.west, b.south, b.east, b.north) == (8.0, 7.0, 8.5, 7.0)
    assert b.datetime == dt.datetime(2020, 1, 5) and b.start_datetime is None
    assert got["no_lat"].west is None and got["no_lat"].datetime == dt.datetime(2021, 2, 3) and got["no_lat"].error is None
    assert got["no_time"].error == "Time column not found" and got["no_time"].west is None
    assert got["only_names"].error is None and got["only_names"].datetime is None
    assert got["z"].datetime is None and "none" not in got
    types = {}
    for r in S.csv_table_profile(spark, path).collect():
        types.setdefault((name(r), r.row_count), {})[r.column_name] = r.col_type
    assert types["a", 2] == {"time": "object", "lat": "float64", "lon": "int64", "n": "int64"}
    assert types["b", 2] == {"n": "float64", "Lon, raw": "object", "LON": "float64", "Date": "object", "LAT": "float64", "ok": "bool"}
    assert types["only_names", 0] == dict.fromkeys(("time", "lat", "lon"), "object")
    listed = S.list_files(spark, path).collect()
    assert len(listed) == 7 and {r.path[-5:]: r.size for r in listed}["a.csv"] == 51


def test_long_first_record(spark, tmp_path, monkeypatch):
    """A first record beyond the first block, with line ends in its names."""
    names = [f"name {i}\nof \"it\", {'x' * 40}" for i in range(40)]
    (tmp_path / "w.csv").write_text(",".join('"' + n.replace('"', '""') + '"' for n in names) + "\n1\n")
    monkeypatch.setattr(S, "FIRST_BLOCK", 64)
    assert S._names((tmp_path / "w.csv").as_uri()) == names
    assert S.first_record('a,"b\n', False) is None and S.first_record("a,b", False) is None
    assert S.first_record("a,b\r\n1", False) == S.first_record("a,b", True) == ["a", "b"]
