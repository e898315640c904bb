"""Header rows to index rows: structured, unstructured, or an error."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fathom.functions import attributes as A
from fathom.functions.coordinates import attribute
from fathom.functions.identity import derive_facility, format_from_magic, object_hash
from fathom.schema import (
    HEADER_DDL,
    IDENTITY_FIELDS,
    STRUCTURED,
    STRUCTURED_VERSION,
    UNSTRUCTURED,
    UNSTRUCTURED_VERSION,
)

_BY_NAME = "_by_name"


def _entries(variables: Column, keep, value) -> Column:
    chosen = F.filter(variables, keep)
    return F.transform(chosen, lambda v: F.struct(v["name"].alias("key"), value(v).alias("value")))


def variable_schema(variables: Column) -> Column:
    """Data variable to type."""
    return A.as_map_or_null(_entries(variables, lambda v: ~v["is_coord"], lambda v: v["dtype"]))


def coordinate_schema(variables: Column) -> Column:
    """Coordinate variable to type."""
    return A.as_map_or_null(_entries(variables, lambda v: v["is_coord"], lambda v: v["dtype"]))


def dimension_sizes(dims: Column) -> Column:
    """Dimension to length."""
    entry = F.transform(dims, lambda d: F.struct(d["name"].alias("key"), d["size"].alias("value")))
    return A.as_map_or_null(entry)


def standard_names(variables: Column) -> Column:
    """Variable to standard name, data and coordinate variables alike; empty names left out."""
    named = F.transform(
        variables,
        lambda v: F.struct(
            v["name"].alias("key"), attribute(v["attrs"], "standard_name").alias("value")
        ),
    )
    return A.as_map_or_null(F.filter(named, lambda e: e["value"] != ""))


def raw_values(headers: DataFrame) -> DataFrame:
    """Headers with ``raw``: one text field per mapped structured field."""
    df = headers.withColumn(_BY_NAME, A.best_by_name(F.col("global_attrs")))
    found = [A.mapped_value(F.col(_BY_NAME), f).alias(f.name) for f in A.MAPPED_FIELDS]
    return df.withColumn("raw", F.struct(*found)).drop(_BY_NAME)


def _error() -> Column:
    """Why a header cannot be indexed; null when it can."""
    variables = F.col("variables")
    checks = [
        (F.coalesce(F.col(c), F.lit("")) == "", f"identity field is missing: {c}")
        for c in ("bucket", "key", "version_id")
    ]
    checks += [
        (format_from_magic(F.col("magic")).isNull(), "unrecognised file format"),
        (F.col("global_attrs").isNull(), "header could not be read"),
        (A.repeats(F.col("global_attrs.name")), "repeated attribute name"),
        (A.repeats(variables["name"]), "repeated variable name"),
        (A.repeats(F.col("dims.name")), "repeated dimension name"),
    ]
    found = F.lit(None).cast("string")
    for test, message in reversed(checks):
        found = F.when(test, message).otherwise(found)
    return F.coalesce(F.col("read_error"), found)


def _checked(headers: DataFrame) -> DataFrame:
    """Headers with ``raw`` and ``error``."""
    df = raw_values(headers)
    if "read_error" not in df.columns:
        df = df.withColumn("read_error", F.lit(None).cast("string"))
    return df.withColumn("error", _error())


def readable(headers: DataFrame) -> DataFrame:
    """Headers that can be indexed, with ``raw`` and ``facility``."""
    return _checked(headers).filter(F.col("error").isNull()).withColumn("facility", derive_facility(F.col("key")))


def _values() -> tuple[dict[str, Column], dict[str, Column]]:
    """Structured and unstructured fields of a header that was checked."""
    base = {
        "bucket": F.col("bucket"),
        "key": F.col("key"),
        "version_id": F.col("version_id"),
        "hash": object_hash(*[F.col(c) for c in IDENTITY_FIELDS]),
        "file_format": format_from_magic(F.col("magic")),
        "facility": derive_facility(F.col("key")),
    }
    fields = {}
    for f in A.MAPPED_FIELDS:
        raw = F.col(f"raw.{f.name}")
        fields[f.name] = A.to_number(raw) if f.numeric else raw
    variables = F.col("variables")
    shapes = {
        "variable_schema": variable_schema(variables),
        "coordinate_schema": coordinate_schema(variables),
        "dimension_sizes": dimension_sizes(F.col("dims")),
        "standard_names": standard_names(variables),
    }
    structured = {**base, "schema_version": F.lit(STRUCTURED_VERSION), **fields, **shapes}
    unstructured = {
        **base,
        "schema_version": F.lit(UNSTRUCTURED_VERSION),
        "metadata": F.concat(
            F.lit('{"global_attrs":'),
            A.attrs_json(F.col("global_attrs")),
            F.lit(',"variables":'),
            A.variables_json(F.filter(variables, lambda v: ~v["is_coord"])),
            F.lit(',"coordinates":'),
            A.variables_json(F.filter(variables, lambda v: v["is_coord"])),
            F.lit("}"),
        ),
    }
    return structured, unstructured


def extract(headers: DataFrame) -> DataFrame:
    """Reference columns, ``structured``, ``unstructured`` and ``error``.

    One projection without a shuffle or a Python function. A bad header gives an error row;
    it cannot fail the job.
    """
    structured, unstructured = _values()
    good = F.col("error").isNull()
    return _checked(headers).select(
        *IDENTITY_FIELDS,
        "size",
        F.when(good, _row(structured, STRUCTURED)).alias("structured"),
        F.when(good, _row(unstructured, UNSTRUCTURED)).alias("unstructured"),
        "error",
    )


def _flat(headers: DataFrame, values: dict[str, Column], schema: T.StructType) -> DataFrame:
    return readable(headers).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def structured_rows(headers: DataFrame) -> DataFrame:
    """The structured half of ``extract`` as plain columns; what is not selected is not worked out."""
    return _flat(headers, _values()[0], STRUCTURED)


def unstructured_rows(headers: DataFrame) -> DataFrame:
    """The unstructured half of ``extract`` as plain columns."""
    return _flat(headers, _values()[1], UNSTRUCTURED)


def _row(values: dict[str, Column], schema: T.StructType) -> Column:
    absent = F.lit(None)
    return F.struct(
        *[values.get(f.name, absent).cast(f.dataType).alias(f.name) for f in schema]
    )


def cast_failures(headers: DataFrame) -> DataFrame:
    """Per mapped field: values present, and values lost by the cast."""
    raw = raw_values(headers).select("raw.*")
    counts = []
    for f in A.MAPPED_FIELDS:
        lost = A.number_is_lost(F.col(f.name)) if f.numeric else F.lit(False)
        counts += [
            F.count(F.col(f.name)).alias(f"n_{f.name}"),
            F.count_if(lost).alias(f"lost_{f.name}"),
        ]
    cells = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("field"),
                F.col(f"n_{f.name}").alias("n_present"),
                F.col(f"lost_{f.name}").alias("n_cast_failed"),
            )
            for f in A.MAPPED_FIELDS
        ]
    )
    return raw.agg(*counts).select(F.inline(cells))


def _storable(value: object) -> object:
    """Header value whose text is valid UTF-8; the magic bytes are the only bytes kept."""
    if isinstance(value, str):
        return value.encode("utf-8", "backslashreplace").decode("utf-8")
    if isinstance(value, dict):
        return {
            k: v.decode("utf-8", "backslashreplace") if isinstance(v, bytes) else _storable(v)
            for k, v in value.items()
        }
    if isinstance(value, (list, tuple)):
        return [_storable(v) for v in value]
    return value


def read_headers(
    references: DataFrame, reader: Callable[[dict], dict]
) -> DataFrame:
    """Plug-in reading: ``reader`` maps one reference to its header fields.

    ``reader`` opens the file on the executor and returns ``magic``, ``global_attrs``,
    ``variables`` and ``dims``. What it raises becomes that row's ``read_error``, and it is
    handed one reference at a time, so memory does not depend on the number of files.
    """
    schema = T.StructType(
        [*T.StructType.fromDDL(HEADER_DDL), T.StructField("read_error", T.StringType())]
    )
    arrow = to_arrow_schema(schema)
    parts = ("magic", "global_attrs", "variables", "dims")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for reference in batch.to_pylist():
                header = dict.fromkeys(parts)
                failure = None
                try:
                    header |= {k: _storable(v) for k, v in reader(reference).items()}
                except Exception as error:  # noqa: BLE001 - becomes a dead letter
                    failure = str(error)
                rows.append({**reference, **header, "read_error": failure})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return references.select(*IDENTITY_FIELDS, "size").mapInArrow(read, schema)

