"""What must not grow faster than the input: shuffles, tasks' rows, columns worked out."""

import glob

from pyspark.sql import functions as F

from fathom import schema as C
from fathom.operators import collections as T
from fathom.operators import drift as R
from fathom.operators import extents as X
from fathom.operators import extract as E
from fathom.operators import store as S
from fathom.session import tasks_for
from suite import views as V

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dim_steps_shuffles_once(spark):
    steps = X.dim_steps(V.coords(spark, SF), order=("idx", "tie", "value"))
    assert plan(steps).count("Exchange hashpartitioning") == 1
    split = X.dim_steps(V.coords(spark, SF), order=("idx", "tie", "value"), stretch=2)
    assert sorted(steps.collect()) == sorted(split.collect())


def test_dim_profile_has_one_row_a_dimension_and_moves_no_headers(spark):
    header = V.header(spark, SF).withColumn("hash", F.regexp_extract("key", r"(\d+)\.nc$", 1))
    twice = header.withColumn("variables", F.concat("variables", "variables"))
    profile = X.dim_profile(twice, V.coords(spark, SF), order=("idx", "tie", "value"))
    assert profile.count() == header.select(F.explode("dims")).count()


def test_tasks_grow_with_the_rows(spark):
    assert tasks_for(spark.range(1000), rows=2) == 500


def test_spread_write_keeps_rows_in_their_tasks(spark, tmp_path):
    schema = C.struct_type({"hash": str, "facility": str})
    rows = spark.range(40, numPartitions=2).select(
        F.col("id").cast("string").alias("hash"), F.concat(F.lit("f"), F.col("id") % 2).alias("facility")
    )
    S.write(str(tmp_path), rows, schema, "facility", unique=True, spread=True)
    assert sorted(S.read(spark, str(tmp_path), schema).collect()) == sorted(rows.collect())
    assert len(glob.glob(f"{tmp_path}/commit_id=*/facility=f0/*.parquet")) == 2
    assert spark.conf.get(S.OPEN_FILES_CONF) == "0"


def test_documents_are_compressed(spark, tmp_path):
    rows = spark.createDataFrame([("a", "i", "{}"), ("b", "j", "{}")], "collection_id string, item_id string, document string")
    T.write_documents(rows, str(tmp_path / "out"))
    assert len(glob.glob(f"{tmp_path}/out/collection_id=*/*.txt.gz")) == 2
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_rows_of_a_half_are_those_of_extract(spark):
    header = V.header(spark, SF)
    good = E.extract(header).filter("error IS NULL")
    for half, rows in (("structured", E.structured_rows(header)), ("unstructured", E.unstructured_rows(header))):
        want = good.select(f"{half}.*")
        assert rows.columns == want.columns
        # Maps do not compare; their entries do.
        show = [F.to_json(c) if t.startswith("map") else F.col(c) for c, t in want.dtypes]
        assert rows.select(*show).exceptAll(want.select(*show)).isEmpty() and rows.count() == want.count()
    assert "sha2" not in plan(E.structured_rows(header).select("key"))


def test_attribute_names_are_read_without_their_values(spark):
    payloads = spark.createDataFrame(
        [('{"global_attrs":{"a":1,"b\\"":{"x":[2]}},"variables":{"v":{}}}',), ('{"global_attrs":{}}',), (None,), ("[",), ('{"global_attrs":{"a":null}}',)],
        "metadata string",
    )
    found = R.attribute_keys(payloads)
    assert "from_json" not in plan(found)
    assert {(r.attribute, r.n_files) for r in found.collect()} == {("a", 2), ('b"', 1)}
