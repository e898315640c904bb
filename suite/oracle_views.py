"""The SQL counterparts of ``views``, as bodies of common table expressions.

A body may name other views; the registry puts them in front.
"""

ATTR_SQL = "struct_pack(name := {n}, value := {v}, vtype := {t})"


def _attr(name: str, value: str, vtype: str = "'str'") -> str:
    return ATTR_SQL.format(n=name, v=value, t=vtype)


def _when(test: str, body: str) -> str:
    return f"CASE WHEN {test} THEN {body} END"


def _list(*items: str) -> str:
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


_NO_ATTR = "CAST(NULL AS STRUCT(name VARCHAR, value VARCHAR, vtype VARCHAR))"


def _variable(name: str, dtype: str, dims: list[str], is_coord: str, *attrs: str) -> str:
    dim_list = "[" + ", ".join(f"'{d}'" for d in dims) + "]::VARCHAR[]"
    return (
        f"struct_pack(name := '{name}', dtype := '{dtype}', dims := {dim_list}, "
        f"is_coord := {is_coord}, attrs := {_list(*(attrs or [_NO_ATTR]))})"
    )


_HEADER_ATTRS = _list(
    _attr("'title'", "o_orderstatus || ' \"quoted\" title'"),
    _attr(
        "CASE k % 3 WHEN 0 THEN 'Conventions' WHEN 1 THEN 'conventions' ELSE 'CON-VENTIONS' END",
        "'CF-1.' || (k % 4 + 4)",
    ),
    _attr("CASE WHEN k % 2 = 0 THEN 'featureType' ELSE 'feature-type' END", "lower(o_orderpriority)"),
    _attr(
        "'geospatial_lat_min'",
        "CASE WHEN k % 11 = 0 THEN 'n/a' WHEN k % 13 = 0 THEN '12d' WHEN k % 17 = 0 THEN '1_0' "
        "ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END",
        "CASE WHEN k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 THEN 'str' ELSE 'float' END",
    ),
    _attr("'geospatial_lat_max'", "'  ' || o_custkey || ' '"),
    _attr("'time_coverage_start'", "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T00:00:00Z'"),
    _when("k % 9 <> 0", _attr("'site_code'", "'SITE' || (o_custkey % 25)")),
    _when("k % 5 = 0", _attr("'abstract'", "'About ' || k")),
    _when("k % 10 = 0", _attr("'description'", "'old text'")),
    _when("k % 4 = 0", _attr("'InstrumentSerial-Number'", "'S' || k")),
    _when("k % 4 = 1", _attr("'instrumentSerialNumber'", "'T' || k")),
    _when("k % 6 = 0",
          _attr("'instrument_nominal_depth'", "CASE WHEN k % 12 = 0 THEN '1e2' ELSE 'deep' END")),
    _when("k % 8 = 0", _attr("'Keywords'", "'sea, water'")),
    _when("k % 2 = 0", _attr("'geospatial_vertical_max'",
                             "CASE WHEN k % 100 = 0 THEN '12.5' ELSE 'unknown' END")),
)
_HEADER_VARIABLES = _list(
    _variable("TIME", "float64", ["TIME"], "true",
              _attr("'units'", "'days since 1950-01-01 00:00:00'"),
              _when("k % 2 = 0", _attr("'standard_name'", "'time'"))),
    _variable("LATITUDE", "float64", ["LATITUDE"], "(k % 7 <> 0)",
              _attr("'standard_name'", "'latitude'"), _attr("'long_name'", "'site latitude'")),
    _when("k % 19 <> 0", _variable(
        "LONGITUDE", "float64", ["LONGITUDE"], "true",
        _attr("'units'", "CASE WHEN k % 2 = 0 THEN 'degrees_east' ELSE 'degreeE' END"))),
    _when("k % 3 = 0", _variable(
        "NOMINAL_DEPTH", "float32", [], "true",
        _attr("'positive'", "'Down'"), _attr("'units'", "'m'"))),
    _variable("TEMP", "float32", ["TIME", "LATITUDE"], "false",
              _attr("'standard_name'", "'sea_water_temperature'"),
              _attr("'valid_max'", "'40.0'", "'float'")),
    _when("k % 3 = 1", _variable(
        "PRES", "float32", ["TIME"], "false",
        _attr("'units'", "'dbar'"), _attr("'standard_name'", "''"))),
    _when("k % 29 = 0", _variable("TEMP", "int16", ["TIME"], "false")),
)

VIEWS: dict[str, str] = {
    "inv": """
        SELECT 'corpus' AS bucket,
               'IMOS/' || CASE event_type WHEN 'signup' THEN 'SOOP' WHEN 'error' THEN 'ANMN'
                   WHEN 'click' THEN 'AATAMS' WHEN 'view' THEN 'SRS' ELSE 'ANFOG' END
                 || '/' || user_id || '/' || event_id || '.nc' AS key,
               CASE WHEN value <= 400 THEN CAST(event_id AS VARCHAR) END AS version_id,
               CASE WHEN value >= 0.5 THEN CAST(floor(value * 100) AS BIGINT) * 65536 END AS size,
               ts AS last_modified_date
        FROM events""",
    "sink_a": """
        SELECT bucket, key, version_id, size FROM inv
        WHERE last_modified_date < TIMESTAMP '2024-01-20' AND key NOT LIKE 'IMOS/SRS/%'""",
    "sink_b": """
        SELECT bucket, key, version_id, size FROM inv WHERE key LIKE 'IMOS/ANFOG/%'""",
    "hashed": """
        SELECT *, sha256('bucket:' || bucket || '|key:' || key || '|version:'
                         || coalesce(version_id, 'None')) AS hash,
               split_part(key, '/', 2) AS facility
        FROM inv""",
    "inv_docs": """
        SELECT 'corpus' AS bucket,
               'IMOS/' || source || '/' || lang || '/' || doc_id || '.nc' AS key,
               CAST(doc_id AS VARCHAR) AS version_id, n_chars AS size
        FROM documents""",
    "inv_lines": """
        SELECT 'corpus' AS bucket,
               'IMOS/' || l_returnflag || l_linestatus || '/' || l_partkey || '/' || l_orderkey
                 || '_' || l_linenumber || '_' || l_suppkey || '.nc' AS key,
               CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS version_id,
               CAST(floor(l_extendedprice) AS BIGINT) * 1024 AS size,
               l_returnflag || l_linestatus AS facility
        FROM lineitem""",
    "url_keys": """
        SELECT 'corpus' AS bucket,
               CASE page_id % 5
                 WHEN 0 THEN regexp_replace(u, '/[^/]*$', '/')
                 WHEN 1 THEN '/' || u || '//x.nc'
                 WHEN 2 THEN 'a/ ' || replace(u, '/', '.') || ' /b.csv'
                 WHEN 3 THEN 'a/  /' || u
                 ELSE u END AS key,
               CASE WHEN page_id % 3 > 0 THEN CAST(page_id AS VARCHAR) END AS version_id,
               page_id AS size
        FROM (SELECT page_id, regexp_replace(url, '^https?://', '') AS u FROM pages)""",
    "shipped": """
        SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
               max(l_suppkey) AS last_supp
        FROM lineitem GROUP BY l_orderkey""",
    "idx_base": """
        SELECT o_orderkey AS orderkey, 'corpus' AS bucket,
               'IMOS/' || CASE o_orderpriority WHEN '1-URGENT' THEN 'ANMN/NSW'
                   WHEN '2-HIGH' THEN 'ANMN/QLD' WHEN '3-MEDIUM' THEN 'ANMN/SA'
                   WHEN '5-LOW' THEN 'SOOP/SOOP-ASF' ELSE 'ANMN/WA' END
                 || '/SITE' || c_nationkey || '/'
                 || CASE c_mktsegment WHEN 'MACHINERY' THEN 'Temperature'
                   WHEN 'AUTOMOBILE' THEN 'CTD_profiles' WHEN 'BUILDING' THEN 'Velocity'
                   WHEN 'HOUSEHOLD' THEN 'hourly_timeseries' ELSE 'aggregated_timeseries' END
                 || '/IMOS_' || o_orderkey || '_FV01_SBE'
                 || CASE WHEN o_orderstatus = 'P' THEN '_Real-Time' ELSE '' END
                 || '_END-1.nc' AS key,
               CAST(o_orderkey AS VARCHAR) AS version_id, 'NETCDF4' AS file_format,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'SOOP' ELSE 'ANMN' END AS facility,
               CAST(6 AS BIGINT) AS schema_version,
               CASE WHEN c_acctbal >= -900 THEN 'SITE' || c_nationkey END AS site_code,
               'PLAT' || last_supp AS platform_code,
               CASE WHEN o_totalprice >= 20000 THEN 'DEP' || (o_orderkey % 40) END
                 AS deployment_code,
               c_mktsegment AS instrument,
               CASE WHEN o_totalprice >= 5000 THEN
                 CASE o_orderstatus WHEN 'F' THEN 'Level 1 - Quality Controlled'
                   WHEN 'O' THEN 'Level 0 - Raw' WHEN 'P' THEN 'Level 2 - Derived'
                   ELSE 'Unknown' END END AS file_version,
               CAST(CAST(first_ship AS DATE) AS VARCHAR) || 'T00:00:00Z' AS time_min,
               CAST(CAST(last_ship AS DATE) AS VARCHAR) || 'T00:00:00Z' AS time_max,
               CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS geospatial_lat_min,
               list_sort(list_filter([
                 CASE WHEN (o_orderkey & 1) > 0 THEN 'TEMP' END,
                 CASE WHEN (o_orderkey & 2) > 0 THEN 'PSAL' END,
                 CASE WHEN (o_orderkey & 4) > 0 THEN 'UCUR' END,
                 CASE WHEN (o_orderkey & 8) > 0 THEN 'PRES' END,
                 CASE WHEN (o_orderkey & 16) > 0 THEN 'DEPTH' END], lambda x: x IS NOT NULL)) AS names,
               o_orderdate AS changed
        FROM orders JOIN customer ON o_custkey = c_custkey
        LEFT JOIN shipped ON o_orderkey = l_orderkey""",
    "idx": """
        SELECT *, CASE WHEN len(names) > 0 THEN names END AS variables,
               sha256('bucket:' || bucket || '|key:' || key || '|version:' || version_id) AS hash,
               's3://' || bucket || '/' || key AS s3_uri
        FROM idx_base""",
    # The patterns of a moorings file's columns.
    "moorings_sql": r"""
        SELECT *, split_part(key, '/', 3) AS subfac,
               regexp_extract(s3_uri, 'Temperature|(CTD|Biogeochem)_(timeseries|profiles)|Velocity|Wave|CO2|Meteorology|aggregated_products|(aggregated|hourly|gridded)_timeseries') AS data_category,
               TRY_CAST(regexp_extract(file_version, 'Level ([0-4])', 1) AS INTEGER) AS fv,
               regexp_matches(s3_uri, 'real[-_]?time', 'i') AS is_realtime
        FROM idx WHERE key LIKE 'IMOS/ANMN/%'""",
    # End of fixed values.
    "variance_rows": """
        SELECT key, facility, names,
               CASE WHEN len(names) = 0 THEN '[]'
                    ELSE '[''' || array_to_string(names, ''', ''') || ''']' END AS schema
        FROM idx WHERE variables IS NOT NULL""",
    "header": f"""
        SELECT 'corpus' AS bucket,
               CASE WHEN k % 37 = 0 THEN 'IMOS/' || k || '.nc'
                    ELSE 'IMOS/ANMN/P' || substr(o_orderpriority, 1, 1) || '/' || k || '.nc' END AS key,
               CASE WHEN k % 41 <> 0 THEN CAST(k AS VARCHAR) END AS version_id,
               k * 10 AS size, k,
               CASE WHEN k % 31 = 0 THEN NULL WHEN k % 5 = 0 THEN 'NETCDF3_CLASSIC'
                    WHEN k % 5 = 1 THEN 'NETCDF3_64BIT_OFFSET' WHEN k % 5 = 2 THEN 'NETCDF5'
                    ELSE 'NETCDF4' END AS file_format,
               {_HEADER_ATTRS} AS attrs,
               CASE WHEN k % 23 = 0 THEN list_filter({_HEADER_VARIABLES}, lambda y: false)
                    ELSE {_HEADER_VARIABLES} END AS vars,
               CASE WHEN k % 23 = 0 THEN []
                    ELSE [struct_pack(name := 'TIME', size := k % 100 + 1),
                          struct_pack(name := 'LATITUDE', size := CAST(1 AS BIGINT)),
                          struct_pack(name := 'LONGITUDE', size := CAST(1 AS BIGINT))] END AS dims
        FROM (SELECT *, o_orderkey AS k FROM orders)""",
    "header_state": """
        SELECT *,
               CASE WHEN version_id IS NULL THEN 'identity field is missing: version_id'
                    WHEN file_format IS NULL THEN 'unrecognised file format'
                    WHEN k % 29 = 0 AND k % 23 <> 0 THEN 'repeated variable name' END AS error,
               sha256('bucket:' || bucket || '|key:' || key || '|version:'
                      || coalesce(version_id, 'None')) AS hash
        FROM header""",
    "attr_rows": """
        SELECT k, hash, error, a.name AS name, a.value AS value, a.vtype AS vtype, pos,
               replace(replace(lower(a.name), '_', ''), '-', '') AS norm
        FROM (SELECT k, hash, error, unnest(attrs) AS a, generate_subscripts(attrs, 1) AS pos
              FROM header_state)""",
    "var_rows": """
        SELECT k, hash, error, dims, v.name AS name, v.dtype AS dtype, v.dims AS vdims,
               v.is_coord AS is_coord, v.attrs AS attrs, pos
        FROM (SELECT k, hash, error, dims, unnest(vars) AS v, generate_subscripts(vars, 1) AS pos
              FROM header_state)""",
    "coords": """
        SELECT CAST(l_orderkey AS VARCHAR) AS hash, CAST(l_linenumber AS BIGINT) AS idx,
               l_extendedprice AS tie, var, value
        FROM (
          SELECT *, 'LATITUDE' AS var, l_quantity - 50.0 AS value FROM lineitem
          UNION ALL
          SELECT *, 'LONGITUDE', floor(l_tax * 100 + 0.5) + 110 FROM lineitem
          UNION ALL
          SELECT *, 'TIME',
                 CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE)
          FROM lineitem)""",
    "collections": """
        SELECT 'R' || r_regionkey AS id, r_name AS title, NULL AS parent_id,
               'about R' || r_regionkey AS description FROM region
        UNION ALL
        SELECT 'N' || n_nationkey, '', 'R' || n_regionkey, 'about N' || n_nationkey FROM nation
        UNION ALL
        SELECT 'C' || c_custkey, c_name, 'N' || c_nationkey, 'about C' || c_custkey FROM customer""",
    "items": """
        SELECT 'C' || o_custkey AS collection_id,
               floor(l_tax * 100 + 0.5) + 110 AS west, l_quantity - 50.0 AS south,
               floor(l_tax * 100 + 0.5) + 111 AS east, l_quantity - 49.0 AS north,
               CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS t_min,
               CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 1 AS DOUBLE) AS t_max
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}
