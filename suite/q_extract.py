"""Header rows to index rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom import schema as C
from fathom.functions import attributes as A
from fathom.operators import dead_letters as D
from fathom.operators import extract as E
from suite import views as V
from suite.registry import query


def _resolved(aliases: list[str]) -> str:
    """Value per file: exact names by priority, then the first normalized one."""
    exact = " ".join(f"WHEN name = '{a}' THEN {i}" for i, a in enumerate(aliases))
    norms = list(dict.fromkeys(a.lower().replace("_", "").replace("-", "") for a in aliases))
    loose = " ".join(f"WHEN norm = '{n}' THEN {10 + i}" for i, n in enumerate(norms))
    return f"""(SELECT k AS rk, arg_min(value, rank * 1000 + pos) AS found FROM (
                  SELECT k, value, pos, CASE {exact} {loose} END AS rank FROM attr_rows)
                WHERE rank IS NOT NULL GROUP BY k)"""


@query(
    "resolve_alias",
    f"""SELECT h.key, c.found AS conventions, f.found AS feature_type, s.found AS serial
        FROM header_state h
        LEFT JOIN {_resolved(['Conventions', 'conventions'])} c ON h.k = c.rk
        LEFT JOIN {_resolved(['featureType', 'feature_type'])} f ON h.k = f.rk
        LEFT JOIN {_resolved(['instrument_serial_number', 'instrumentSerialNumber'])} s
               ON h.k = s.rk""",
)
def resolve_alias(spark, sf_dir):
    raw = E.raw_values(V.header(spark, sf_dir))
    return raw.select(
        "key",
        F.col("raw.conventions").alias("conventions"),
        F.col("raw.feature_type").alias("feature_type"),
        F.col("raw.instrument_serial_number").alias("serial"),
    )


@query(
    "normalize_attr_key",
    "SELECT name, norm AS normalized, count(*) AS n FROM attr_rows GROUP BY ALL",
)
def normalize_attr_key(spark, sf_dir):
    names = V.header(spark, sf_dir).select(F.explode("global_attrs.name").alias("name"))
    counted = names.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("name", A.normalize_name(F.col("name")).alias("normalized"), "n")


NUMBER_SQL = r"""CASE WHEN regexp_matches(trim({0}), '^[+-]?(\d+(_\d+)*\.?\d*|\.\d+)([eE][+-]?\d+)?$')
                 THEN TRY_CAST(replace(trim({0}), '_', '') AS DOUBLE) END"""


@query(
    "cast_or_null",
    f"""SELECT h.key, {NUMBER_SQL.format('a.found')} AS lat_min,
               {NUMBER_SQL.format('b.found')} AS lat_max, {NUMBER_SQL.format('c.found')} AS depth
        FROM header_state h
        LEFT JOIN {_resolved(['geospatial_lat_min'])} a ON h.k = a.rk
        LEFT JOIN {_resolved(['geospatial_lat_max'])} b ON h.k = b.rk
        LEFT JOIN {_resolved(['instrument_nominal_depth'])} c ON h.k = c.rk""",
)
def cast_or_null(spark, sf_dir):
    raw = E.raw_values(V.header(spark, sf_dir))
    return raw.select(
        "key",
        A.to_number(F.col("raw.geospatial_lat_min")).alias("lat_min"),
        A.to_number(F.col("raw.geospatial_lat_max")).alias("lat_max"),
        A.to_number(F.col("raw.instrument_nominal_depth")).alias("depth"),
    )


def _pairs(entries):
    """Map as sorted ``key=value`` text."""
    text = F.transform(
        F.array_sort(F.map_entries(entries)),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return F.array_join(text, ",")


def _map_sql(value: str, test: str) -> str:
    return f"""SELECT h.key, m.pairs AS entries FROM header_state h LEFT JOIN (
                 SELECT k, string_agg(name || '=' || {value}, ',' ORDER BY name) AS pairs
                 FROM var_rows WHERE {test} GROUP BY k) m ON h.k = m.k
               WHERE h.error IS NULL"""


def _structured(spark, sf_dir):
    return E.structured_rows(V.header(spark, sf_dir))


@query("variable_schema", _map_sql("dtype", "NOT is_coord"))
def variable_schema(spark, sf_dir):
    return _structured(spark, sf_dir).select("key", _pairs("variable_schema").alias("entries"))


@query("coordinate_schema", _map_sql("dtype", "is_coord"))
def coordinate_schema(spark, sf_dir):
    return _structured(spark, sf_dir).select("key", _pairs("coordinate_schema").alias("entries"))


@query(
    "dimension_sizes",
    """SELECT key, CASE WHEN k % 23 <> 0 THEN 'LATITUDE=1,LONGITUDE=1,TIME=' || (k % 100 + 1) END
              AS entries FROM header_state WHERE error IS NULL""",
)
def dimension_sizes(spark, sf_dir):
    return _structured(spark, sf_dir).select("key", _pairs("dimension_sizes").alias("entries"))


_STANDARD = "list_filter(attrs, lambda a: a.name = 'standard_name')[1].value"


@query("standard_names", _map_sql(_STANDARD, f"{_STANDARD} <> ''"))
def standard_names(spark, sf_dir):
    return _structured(spark, sf_dir).select("key", _pairs("standard_names").alias("entries"))


@query(
    "structured_rows",
    f"""SELECT h.bucket, h.key, h.version_id, h.hash, h.file_format,
               CASE WHEN h.k % 37 = 0 THEN 'UNKNOWN' ELSE 'ANMN' END AS facility,
               CAST(6 AS BIGINT) AS schema_version, {NUMBER_SQL.format('a.found')} AS geospatial_lat_min,
               t.found AS time_coverage_start, CAST(NULL AS VARCHAR) AS crs, w.found AS keywords,
               c.found AS conventions, s.found AS site_code, f.found AS feature_type,
               v.pairs AS variable_schema, CAST(33 AS INTEGER) AS n_columns
        FROM header_state h
        LEFT JOIN {_resolved(['geospatial_lat_min'])} a ON h.k = a.rk
        LEFT JOIN {_resolved(['time_coverage_start'])} t ON h.k = t.rk
        LEFT JOIN {_resolved(['keywords'])} w ON h.k = w.rk
        LEFT JOIN {_resolved(['Conventions', 'conventions'])} c ON h.k = c.rk
        LEFT JOIN {_resolved(['site_code'])} s ON h.k = s.rk
        LEFT JOIN {_resolved(['featureType', 'feature_type'])} f ON h.k = f.rk
        LEFT JOIN (SELECT k, string_agg(name || '=' || dtype, ',' ORDER BY name) AS pairs
                   FROM var_rows WHERE NOT is_coord GROUP BY k) v ON h.k = v.k
        WHERE h.error IS NULL""",
)
def structured_rows(spark, sf_dir):
    rows = _structured(spark, sf_dir)
    return rows.select(
        *C.STRUCTURED.names[:8],
        "time_coverage_start",
        "crs",
        "keywords",
        "conventions",
        "site_code",
        "feature_type",
        _pairs("variable_schema").alias("variable_schema"),
        F.lit(len(rows.columns)).alias("n_columns"),
    )


def _object_sql(rows: str, value: str, test: str = "true") -> str:
    """JSON object text per file from long rows, in file order."""
    return f"""(SELECT k AS jk, '{{' || string_agg(CAST(to_json(name) AS VARCHAR) || ':' || {value},
                 ',' ORDER BY pos) || '}}' AS j FROM {rows} WHERE {test} GROUP BY k)"""


_VALUE_SQL = "CASE WHEN vtype = 'str' THEN CAST(to_json(value) AS VARCHAR) ELSE value END"
_VARIABLE_SQL = """'{"attrs":{' || array_to_string(list_transform(attrs, lambda a:
    CAST(to_json(a.name) AS VARCHAR) || ':' || CASE WHEN a.vtype = 'str'
      THEN CAST(to_json(a.value) AS VARCHAR) ELSE a.value END), ',') || '},"dims":'
    || CAST(to_json(vdims) AS VARCHAR) || '}'"""


UNSTRUCTURED_SQL = f"""
    SELECT h.k, h.key, h.hash, CAST(4 AS BIGINT) AS schema_version,
           CASE WHEN h.k % 37 = 0 THEN 'UNKNOWN' ELSE 'ANMN' END AS facility,
           '{{"global_attrs":' || g.j || ',"variables":' || coalesce(v.j, '{{}}')
             || ',"coordinates":' || coalesce(c.j, '{{}}') || '}}' AS metadata
    FROM header_state h
    JOIN {_object_sql('attr_rows', _VALUE_SQL)} g ON h.k = g.jk
    LEFT JOIN {_object_sql('var_rows', _VARIABLE_SQL, 'NOT is_coord')} v ON h.k = v.jk
    LEFT JOIN {_object_sql('var_rows', _VARIABLE_SQL, 'is_coord')} c ON h.k = c.jk
    WHERE h.error IS NULL"""


def unstructured(spark, sf_dir):
    return E.unstructured_rows(V.header(spark, sf_dir))


@query(
    "unstructured_rows",
    f"SELECT key, hash, schema_version, facility, metadata FROM ({UNSTRUCTURED_SQL})",
)
def unstructured_rows(spark, sf_dir):
    return unstructured(spark, sf_dir).select(
        "key", "hash", "schema_version", "facility", "metadata"
    )


@query(
    "sanitize_json",
    r"""SELECT doc_id, array_to_string(list_transform(string_split(text, ''),
                 lambda c: CASE WHEN unicode(c) < 128 THEN c WHEN unicode(c) < 256
                                THEN '\x' || lower(hex(unicode(c))) ELSE '?' END), '') AS text
        FROM documents""",
)
def sanitize_json(spark, sf_dir):
    """Documents stored in a one-byte encoding, as bytes attributes often are."""
    raw = F.encode("text", "ISO-8859-1")
    return V.table(spark, sf_dir, "documents").select(
        "doc_id", A.text_from_bytes(raw).alias("text")
    )


@query(
    "extract_or_dead_letter",
    """SELECT hash, key, error IS NULL AS has_structured, error IS NULL AS has_unstructured, error
       FROM header_state""",
)
def extract_or_dead_letter(spark, sf_dir):
    results = E.extract(V.header(spark, sf_dir))
    return results.select(
        V.identity_hash().alias("hash"),
        "key",
        F.col("structured").isNotNull().alias("has_structured"),
        F.col("unstructured").isNotNull().alias("has_unstructured"),
        "error",
    )


@query(
    "fetch_or_dead_letter",
    """SELECT key, size, 'object could not be fetched' AS error FROM header
       WHERE k NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def fetch_or_dead_letter(spark, sf_dir):
    """Requested: every order's file. Fetched: files whose order has lines."""
    lines = V.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order")
    )
    requested = V.header(spark, sf_dir).select("bucket", "key", "version_id", "size")
    number = F.regexp_extract("key", r"(\d+)\.nc$", 1)
    fetched = requested.join(lines, number == F.col("order"), "left_semi")
    return D.unfetched(requested, fetched).select("key", "size", "error")


@query(
    "dead_letter_rows",
    """SELECT CAST(4 AS BIGINT) AS schema_version, bucket, key, version_id, size, hash, error,
              'run-7' AS index_flow_id, 'batch-9' AS batch_flow_id
       FROM header_state WHERE error IS NOT NULL""",
)
def dead_letter_rows(spark, sf_dir):
    _, bad = D.split_results(E.extract(V.header(spark, sf_dir)))
    return D.dead_letters(bad, F.col("error"), "run-7", "batch-9")


@query(
    "partition_results",
    "SELECT error IS NULL AS ok, count(*) AS n FROM header_state GROUP BY 1",
)
def partition_results(spark, sf_dir):
    good, bad = D.split_results(E.extract(V.header(spark, sf_dir)))
    return (
        good.agg(F.lit(True).alias("ok"), F.count(F.lit(1)).alias("n"))
        .unionByName(bad.agg(F.lit(False).alias("ok"), F.count(F.lit(1)).alias("n")))
    )


# Columns that may not be null, by table.
_REQUIRED = {
    "structured": ("bucket", "key", "version_id", "hash", "file_format", "facility", "schema_version"),
    "unstructured": ("bucket", "key", "version_id", "hash", "file_format", "facility", "schema_version", "metadata"),
    "dead_letter": ("schema_version", "bucket", "key", "hash"),
}
# How many rows lack a value, and how many have an empty one.
_HOLES = {
    "bucket": ("0", "count(*) FILTER (key LIKE 'IMOS/SOOP/%')"),
    "key": ("count(*) FILTER (size <= 65536000 OR size IS NULL)", "0"),
    "version_id": ("count(*) FILTER (version_id IS NULL)", "0"),
    "hash": ("count(*) FILTER (version_id IS NULL)", "0"),
    "file_format": ("count(*) FILTER (size % 3 = 1)", "count(*) FILTER (size % 3 = 2)"),
}


@query(
    "required_nulls",
    "SELECT table_name, c.column_name, n_rows, c.n_null, c.n_empty FROM (SELECT n_rows, unnest(cells) AS c, table_name FROM ("
    + " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS n_rows, ["
        + ", ".join(
            f"{{'column_name': '{c}', 'n_null': CAST({_HOLES.get(c, ('0', '0'))[0]} AS BIGINT),"
            f" 'n_empty': CAST({_HOLES.get(c, ('0', '0'))[1]} AS BIGINT)}}"
            for c in columns
        )
        + "] AS cells FROM inv"
        for table, columns in _REQUIRED.items()
    )
    + "))",
)
def required_nulls(spark, sf_dir):
    """All three tables with holes: emptied buckets, dropped keys, hashes only with a version."""
    versioned = F.col("version_id").isNotNull()
    rows = V.inv(spark, sf_dir).select(
        F.lit(4).alias("schema_version"),
        F.when(F.col("key").startswith("IMOS/SOOP/"), "").otherwise(F.col("bucket")).alias("bucket"),
        F.when(F.col("size") > 65536000, F.col("key")).alias("key"),
        F.when(versioned, F.col("version_id")).alias("version_id"),
        F.when(versioned, V.identity_hash()).alias("hash"),
        F.when(F.col("size") % 3 == 1, F.lit(None)).when(F.col("size") % 3 == 2, "").otherwise("NETCDF4").alias("file_format"),
        F.lit("ANMN").alias("facility"),
        F.lit("{}").alias("metadata"),
    )
    parts = [
        C.required_nulls(rows, schema, table)
        for table, schema in (
            ("structured", C.STRUCTURED), ("unstructured", C.UNSTRUCTURED), ("dead_letter", C.DEAD_LETTER)
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "cast_failures",
    f"""SELECT f.field, count(v.value) AS n_present,
               count(*) FILTER (f.field IN ('geospatial_lat_min', 'geospatial_lat_max',
                    'geospatial_lon_min', 'geospatial_lon_max', 'geospatial_vertical_min',
                    'geospatial_vertical_max', 'instrument_nominal_depth')
                 AND v.value IS NOT NULL AND {NUMBER_SQL.format('v.value')} IS NULL) AS n_cast_failed
        FROM (SELECT unnest({[f.name for f in A.MAPPED_FIELDS]}) AS field) f
        LEFT JOIN (SELECT k, min_by(value, pos) AS value, norm FROM attr_rows GROUP BY k, norm) v
          ON v.norm = replace(f.field, '_', '') GROUP BY f.field""",
)
def cast_failures(spark, sf_dir):
    return E.cast_failures(V.header(spark, sf_dir))
