import pytest
from pyspark.sql import types as T

from fathom import schema as C


def test_accepted_annotations():
    got = C.struct_type(
        {
            "a": str,
            "b": int | None,
            "c": float,
            "d": bool | None,
            "e": list[int],
            "f": list[str] | None,
            "g": dict[str, int] | None,
            "h": dict[int, float],
        }
    )
    assert got == T.StructType(
        [
            T.StructField("a", T.StringType(), False),
            T.StructField("b", T.LongType(), True),
            T.StructField("c", T.DoubleType(), False),
            T.StructField("d", T.BooleanType(), True),
            T.StructField("e", T.ArrayType(T.LongType(), False), False),
            T.StructField("f", T.ArrayType(T.StringType(), False), True),
            T.StructField("g", T.MapType(T.StringType(), T.LongType(), True), True),
            T.StructField("h", T.MapType(T.StringType(), T.DoubleType(), True), False),
        ]
    )


@pytest.mark.parametrize(
    "annotation", [int | str, int | str | None, set, list[int, str], list, dict, bytes]
)
def test_rejected_annotations(annotation):
    with pytest.raises(ValueError):
        C.spark_type(annotation)


def test_contracts():
    assert len(C.STRUCTURED) == 33
    assert [f.name for f in C.STRUCTURED if not f.nullable] == [
        "bucket", "key", "version_id", "hash", "file_format", "facility", "schema_version",
    ]
    assert C.STRUCTURED["dimension_sizes"].dataType == T.MapType(T.StringType(), T.LongType())
    assert C.UNSTRUCTURED.names[-1] == "metadata" and not C.UNSTRUCTURED["metadata"].nullable
    assert [f.name for f in C.DEAD_LETTER if f.nullable] == [
        "version_id", "size", "error", "index_flow_id", "batch_flow_id",
    ]


def test_conform(spark):
    df = spark.createDataFrame([("1", "x", "y")], "size string, key string, bucket string")
    got = C.conform(df, C.OBJECT_REFERENCE)
    assert got.first() == ("y", "x", None, 1)
    assert got.dtypes[-1] == ("size", "bigint")
    with pytest.raises(ValueError, match="bucket"):
        C.conform(df.drop("bucket"), C.OBJECT_REFERENCE)
    bad = spark.createDataFrame([(None, "b")], "key string, bucket string")
    with pytest.raises(Exception, match="required column is null: key"):
        C.conform(bad, C.OBJECT_REFERENCE).collect()
