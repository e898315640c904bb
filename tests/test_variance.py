import pytest

from fathom.operators import variance as X

ROWS = [
    ("IMOS/A/x/1.nc", ["b", "a"]),
    ("IMOS/A/x/2.nc", ["a", "b"]),
    ("IMOS/B/y/3.nc", ["a", "b"]),
    ("IMOS/B/y/4.nc", ["a", "c"]),
    ("IMOS/B/y/5.nc", []),
    ("IMOS/B/y/6.nc", None),
]


@pytest.fixture(params=["array", "text"])
def files(request, spark):
    if request.param == "array":
        return spark.createDataFrame(ROWS, "key string, variables array<string>")
    rows = [(k, None if v is None else str(v)) for k, v in ROWS]
    return spark.createDataFrame(rows, "key string, variables string")


def test_order_does_not_matter(files):
    got = [(r.schema, r.n_files) for r in X.schema_counts(files).collect()]
    assert got == [("['a', 'b']", 3), ("['a', 'c']", 1), ("[]", 1)]


def test_prefixes(files):
    got = {(r.schema, r.prefix): r.n_files for r in X.schema_prefixes(files).collect()}
    assert got[("['a', 'b']", "IMOS/A/x/")] == 2
    assert {r.schema: r.n_prefixes for r in X.prefix_counts(files).collect()}["['a', 'b']"] == 2


def test_differences(files):
    assert [r.variable for r in X.all_variables(files).collect()] == ["a", "b", "c"]
    assert {(r.schema, r.variable) for r in X.unique_variables(files).collect()} == {
        ("['a', 'b']", "b"), ("['a', 'c']", "c"),
    }
    assert {(r.variable, r.n_schemas, r.in_core) for r in X.variable_spread(files).collect()} == {
        ("a", 2, True), ("b", 1, False), ("c", 1, False),
    }
    assert {tuple(r) for r in X.variable_departures(files).collect()} == {
        ("['a', 'b']", "b", "adds"), ("['a', 'c']", "c", "adds"), ("[]", "a", "lacks"),
    }
    missing = X.missing_variables(files, ["['a', 'b']", "[]"]).collect()
    assert {tuple(r) for r in missing} == {("['a', 'b']", "c"), ("[]", "a"), ("[]", "b"), ("[]", "c")}
    assert X.variance_summary(files).first() == (3, 6, 3)


def test_top_schemas_are_whole(spark):
    wide = [("a/b.nc", [f"variable_{i:02d}" for i in range(9)])]
    df = spark.createDataFrame(wide, "key string, variables array<string>")
    shown = X.top_schemas(df).first().schema
    assert shown.endswith("'variable_07', 'variable_08']")


def test_report(files):
    lines = [r.text for r in X.variance_report(files).collect()]
    assert lines[2:6] == [
        "Query Prefix: All data", "Total Records: 6", "Total Distinct Schemas: 3",
        "Total Unique Variables: 3",
    ]
    assert lines[6:10] == ["=" * 80, "All Variables Found", "=" * 80, "  - a"]
    at = lines.index("Schema #1")
    assert lines[at - 7 : at] == [
        "=" * 80, "Variables of Most Schemas (1)", "=" * 80, "  - a: 2", "=" * 80, "Schema Variance Details", "=" * 80,
    ]
    assert lines[at + 1 : at + 10] == [
        "  Variables (2): ['a', 'b']", "  Record Count: 3", "  Variables Unique to This Schema:", "    + b",
        "  Variables Missing from This Schema (1):", "    and 1 that most schemas lack",
        "  Associated Prefixes (2):", "    - IMOS/A/x/", "    - IMOS/B/y/",
    ]
    assert "    - a" in lines[lines.index("Schema #3"):]


def test_departures_are_no_more_than_names(spark):
    """Many schemas with names of their own: all pairs would be 40,000 rows."""
    rows = [(f"a/{i}.nc", ["time", "lat", *([] if i % 10 == 0 else ["depth"]), f"own_{i}"]) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, variables array<string>")
    found = X.variable_departures(df).collect()
    assert len(found) == 200 + 20 and {r.variable for r in found if r.departs == "lacks"} == {"depth"}
    assert X.variance_report(df).count() < 200 * 12


def test_list_text_is_never_run(spark):
    df = spark.createDataFrame([("k", "__import__('os').getcwd()")], "key string, variables string")
    assert X.schema_counts(df).count() == 0


def test_variable_contains(spark):
    rows = [("k1", {"TEMP": "f", "PSAL": "f"}), ("k2", {"TEMP_2": "f"}), ("k3", None)]
    df = spark.createDataFrame(rows, "key string, variables map<string,string>")
    assert [r.key for r in X.variable_contains(df, "TEMP").collect()] == ["k1"]
    assert [r.key for r in X.variable_contains(df, "TEMP", part=True).collect()] == ["k1", "k2"]


ODD = [["it's", "B"], ['say "x"', "y"], ["both ' and \"", "back\\slash"], ["a', 'b"], ["a", "b"], ["tab\t", "line\n"], [],
       ["café", "\u200b", "\x07", "\U0001f30a", "\U000e0001"], ["[", "]", ",", ", "], ['"', "'"], ["\\'", "x\\"]]


def test_list_text_is_read_as_python_writes_it(spark):
    bad = ["", "[", "['a'", "[a]", "['a' 'b']", "['a',, 'b']", "('a',)", "{'a'}", "['a']x", "[1]"]
    odd = [("  [ 'a' ,\"b\", ] ", ["a", "b"])]
    rows = [(i, repr(v), v) for i, v in enumerate(ODD)] + [(100 + i, t, None) for i, t in enumerate(bad)]
    rows += [(200 + i, t, v) for i, (t, v) in enumerate(odd)]
    df = spark.createDataFrame(rows, "n int, variables string, want array<string>")
    for r in df.withColumn("got", X.variable_list(df)).collect():
        assert r.got == (None if r.want is None else sorted(r.want, key=lambda x: x.encode())), r.variables
    assert {r.variables for r in X.unreadable_lists(df).collect()} == set(bad)
    texts = [r.schema for r in X.with_schema(df).filter("n < 100").collect()]
    assert len(set(texts)) == len(ODD)
    import ast

    assert all(ast.literal_eval(t) == sorted(ast.literal_eval(t), key=lambda x: x.encode()) for t in texts)
