"""Table contracts: annotations to Spark types, and typed, checked projections."""

from __future__ import annotations

import types
import typing
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SCALARS: dict[type, T.DataType] = {
    str: T.StringType(),
    float: T.DoubleType(),
    int: T.LongType(),
    bool: T.BooleanType(),
}


def spark_type(annotation: object) -> tuple[T.DataType, bool]:
    """Spark type and nullability of one annotation; ``X | None`` is the only union allowed."""
    if isinstance(annotation, types.UnionType) or typing.get_origin(annotation) is typing.Union:
        concrete = [a for a in typing.get_args(annotation) if a is not type(None)]
        if len(concrete) != 1:
            raise ValueError(f"ambiguous union, only `T | None` has a column type: {annotation}")
        return _concrete(concrete[0]), True
    return _concrete(annotation), False


def _concrete(annotation: object) -> T.DataType:
    if annotation in _SCALARS:
        return _SCALARS[annotation]
    args = typing.get_args(annotation)
    container = typing.get_origin(annotation)
    if container is list and len(args) == 1:
        return T.ArrayType(_concrete(args[0]), containsNull=False)
    if container is dict and len(args) == 2:
        # Map keys are strings whatever the annotation says.
        return T.MapType(T.StringType(), _concrete(args[1]), valueContainsNull=True)
    raise ValueError(f"no column type for annotation: {annotation}")


def struct_type(fields: Mapping[str, object]) -> T.StructType:
    """StructType with one field per annotation, in declaration order."""
    return T.StructType([T.StructField(n, *spark_type(a)) for n, a in fields.items()])


# Column names, order, types and schema versions of the four tables.
IDENTITY_FIELDS = ("bucket", "key", "version_id")
STRUCTURED_VERSION = 6
UNSTRUCTURED_VERSION = 4
DEAD_LETTER_VERSION = 4

OBJECT_REFERENCE = struct_type(
    {"bucket": str, "key": str, "version_id": str | None, "size": int | None}
)
_BASE = {
    "bucket": str,
    "key": str,
    "version_id": str,
    "hash": str,
    "file_format": str,
    "facility": str,
    "schema_version": int,
}
STRUCTURED = struct_type(
    {
        **_BASE,
        "geospatial_lat_min": float | None,
        "geospatial_lat_max": float | None,
        "geospatial_lon_min": float | None,
        "geospatial_lon_max": float | None,
        "geospatial_vertical_min": float | None,
        "geospatial_vertical_max": float | None,
        "geospatial_vertical_positive": str | None,
        "time_coverage_start": str | None,
        "time_coverage_end": str | None,
        "date_created": str | None,
        "crs": str | None,
        "keywords": str | None,
        "conventions": str | None,
        "file_version": str | None,
        "metadata_uuid": str | None,
        "platform_code": str | None,
        "site_code": str | None,
        "deployment_code": str | None,
        "instrument": str | None,
        "instrument_nominal_depth": float | None,
        "feature_type": str | None,
        "instrument_serial_number": str | None,
        "variable_schema": dict[str, str] | None,
        "coordinate_schema": dict[str, str] | None,
        "dimension_sizes": dict[str, int] | None,
        "standard_names": dict[str, str] | None,
    }
)
UNSTRUCTURED = struct_type({**_BASE, "metadata": str})
DEAD_LETTER = struct_type(
    {
        "schema_version": int,
        "bucket": str,
        "key": str,
        "version_id": str | None,
        "size": int | None,
        "hash": str,
        "error": str | None,
        "index_flow_id": str | None,
        "batch_flow_id": str | None,
    }
)
# End of fixed values.

# The header row: what a reader takes from one array file. Attributes are arrays because
# their order in the file decides which of two similar names wins.
_ATTR = "struct<name: string, value: string, vtype: string>"
HEADER_DDL = (
    "bucket string, key string, version_id string, size bigint, magic binary, "
    f"global_attrs array<{_ATTR}>, "
    "variables array<struct<name: string, dtype: string, dims: array<string>, "
    f"is_coord: boolean, attrs: array<{_ATTR}>>>, "
    "dims array<struct<name: string, size: bigint>>"
)


def required(column: Column, field: T.StructField) -> Column:
    """``column`` that fails the job when it is null, in the same pass that reads it."""
    message = F.lit(f"required column is null: {field.name}")
    return F.when(column.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(column)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: declared order and types, absent nullable columns null."""
    present = set(df.columns)
    columns = []
    for field in schema:
        if field.name in present:
            column = F.col(field.name).cast(field.dataType)
            column = column if field.nullable else required(column, field)
        elif field.nullable:
            column = F.lit(None).cast(field.dataType)
        else:
            raise ValueError(f"required column is missing: {field.name}")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def required_nulls(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Per required column of ``schema``: how many rows are null, and how many empty text."""
    wanted = [f for f in schema if not f.nullable and f.name in df.columns]
    counts = []
    for f in wanted:
        counts.append(F.count_if(F.col(f.name).isNull()).alias(f"null_{f.name}"))
        blank = F.col(f.name) == "" if isinstance(f.dataType, T.StringType) else F.lit(False)
        counts.append(F.count_if(blank).alias(f"blank_{f.name}"))
    cells = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"null_{f.name}").alias("n_null"),
                F.col(f"blank_{f.name}").alias("n_empty"),
            )
            for f in wanted
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
        .select("n_rows", F.inline(cells))
        .select(F.lit(table).alias("table_name"), "column_name", "n_rows", "n_null", "n_empty")
    )
