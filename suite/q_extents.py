"""Extents and the collection tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import collections as T
from fathom.operators import extents as X
from fathom.functions.identity import derive_facility, item_id
from fathom.session import shared_dir
from suite import views as V
from suite.registry import query


def _rules_sql(key: str) -> str:
    """The collections of the given keys, written out by their folders.

    Their files are named alike (level 1, an instrument, an end mark), so the category decides.
    """
    # Names of collections.
    return f"""
      CASE WHEN {key} NOT LIKE 'IMOS/ANMN/%' THEN 'unknown_collection'
           WHEN {key} LIKE '%/Temperature/%' THEN '7e13b5f3-4a70-4e31-9e95-335efa491c5c'
           WHEN {key} LIKE '%/Velocity/%' THEN 'ae86e2f5-eaaf-459e-a405-e654d85adb9c'
           WHEN {key} LIKE '%/hourly_timeseries/%' THEN 'efd8201c-1eca-412e-9ad2-0534e96cea14'
           WHEN {key} LIKE '%/aggregated_timeseries/%' THEN 'moorings-aggregated-timeseries-product'
           ELSE 'unknown_collection' END"""
    # End of fixed values.


@query("collection_id", f"SELECT key, {_rules_sql('key')} AS collection_id FROM idx")
def collection_id(spark, sf_dir):
    return V.idx(spark, sf_dir).select("key", T.collection_id(F.col("key")).alias("collection_id"))


_STD = "lower(coalesce(list_filter(attrs, lambda a: a.name = 'standard_name')[1].value, ''))"
_UNITS = "list_filter(attrs, lambda a: a.name = 'units')[1].value"
_POSITIVE = "lower(coalesce(list_filter(attrs, lambda a: a.name = 'positive')[1].value, ''))"
ROLES_SQL = f"""
    roles AS (
      SELECT k, hash, name, is_coord, pos,
             CASE WHEN std IN ('latitude', 'longitude', 'depth', 'time') THEN std
                  WHEN units IN ('degrees_north') THEN 'latitude'
                  WHEN units IN ('degrees_east', 'degreeE') THEN 'longitude'
                  WHEN units LIKE '% since %' THEN 'time'
                  WHEN (units = 'dbar' OR positive IN ('up', 'down')) AND std NOT LIKE '%air%'
                       AND std NOT LIKE '%stress%' THEN 'depth'
                  ELSE 'other' END AS role
      FROM (SELECT *, {_STD} AS std, {_UNITS} AS units, {_POSITIVE} AS positive FROM var_rows))"""


def headers(spark, sf_dir):
    return V.header(spark, sf_dir).withColumn("hash", V.identity_hash())


@query(
    "classify_coord",
    f"WITH {ROLES_SQL} SELECT hash, CAST(pos - 1 AS INTEGER) AS pos, name, is_coord, role FROM roles",
)
def classify_coord(spark, sf_dir):
    return X.variable_roles(headers(spark, sf_dir))


AXES_SQL = ROLES_SQL + """,
    picked AS (
      SELECT k,
        arg_min(name, pos + CASE WHEN is_coord THEN 0 ELSE 1000 END) FILTER (role = 'latitude') AS latitude,
        arg_min(name, pos + CASE WHEN is_coord THEN 0 ELSE 1000 END) FILTER (role = 'longitude') AS longitude,
        arg_min(name, pos + CASE WHEN is_coord THEN 0 ELSE 1000 END) FILTER (role = 'time') AS time,
        arg_min(name, pos) FILTER (role = 'depth' AND is_coord) AS depth
      FROM roles GROUP BY k),
    axes AS (
      SELECT h.k, h.hash, latitude, longitude, time, depth,
             CASE WHEN latitude IS NULL THEN 'Latitude coordinate not found'
                  WHEN longitude IS NULL THEN 'Longitude coordinate not found'
                  WHEN time IS NULL THEN 'Time coordinate not found' END AS error
      FROM header_state h LEFT JOIN picked p ON h.k = p.k)"""


@query(
    "pick_axes",
    f"WITH {AXES_SQL} SELECT hash, latitude, longitude, time, depth, error FROM axes",
)
def pick_axes(spark, sf_dir):
    return X.pick_axes(headers(spark, sf_dir))


EXTENT_SQL = """
    extent AS (
      SELECT hash, min(value) FILTER (var = 'LONGITUDE') AS west,
             min(value) FILTER (var = 'LATITUDE') AS south,
             max(value) FILTER (var = 'LONGITUDE') AS east,
             max(value) FILTER (var = 'LATITUDE') AS north,
             min(value) FILTER (var = 'TIME') AS t_min, max(value) FILTER (var = 'TIME') AS t_max
      FROM coords GROUP BY hash)"""


@query(
    "bbox_geometry",
    f"""WITH {EXTENT_SQL}
        SELECT hash, west, south, east, north,
               CASE WHEN west = east AND south = north THEN 'Point' ELSE 'Polygon' END AS kind,
               CASE WHEN west = east AND south = north THEN 1 ELSE 5 END AS n_points,
               west AS first_x, CASE WHEN west = east AND south = north THEN NULL ELSE east END AS third_x,
               CASE WHEN west = east AND south = north THEN NULL ELSE north END AS third_y
        FROM extent""",
)
def bbox_geometry(spark, sf_dir):
    places = F.col("geometry.coordinates")
    third = F.get(places, F.lit(2))
    return X.file_extents(V.coords(spark, sf_dir)).select(
        "hash",
        "west",
        "south",
        "east",
        "north",
        F.col("geometry.type").alias("kind"),
        F.size(places).alias("n_points"),
        F.get(F.get(places, F.lit(0)), F.lit(0)).alias("first_x"),
        F.get(third, F.lit(0)).alias("third_x"),
        F.get(third, F.lit(1)).alias("third_y"),
    )


@query(
    "time_extent",
    f"""WITH {EXTENT_SQL}
        SELECT hash, CASE WHEN t_min = t_max THEN t_min END AS datetime,
               CASE WHEN t_min <> t_max THEN t_min END AS start_datetime,
               CASE WHEN t_min <> t_max THEN t_max END AS end_datetime FROM extent""",
)
def time_extent(spark, sf_dir):
    return X.file_extents(V.coords(spark, sf_dir)).select("hash", "time.*")


@query(
    "item_properties",
    """SELECT hash, string_agg(CASE WHEN name = 'abstract' THEN 'description' ELSE name END
                               || '=' || value, ';' ORDER BY pos) AS properties
       FROM attr_rows a
       WHERE NOT (name = 'description' AND k % 5 = 0) GROUP BY hash""",
)
def item_properties(spark, sf_dir):
    shown = F.transform(
        X.item_properties(F.col("global_attrs")), lambda a: F.concat(a["name"], F.lit("="), a["value"])
    )
    return headers(spark, sf_dir).select("hash", F.array_join(shown, ";").alias("properties"))


STEPS_SQL = """
    steps AS (
      SELECT hash, var, count(*) AS n_values, min(value) AS extent_min, max(value) AS extent_max,
             CASE WHEN count(gap) > 1 AND min(gap) = max(gap) THEN min(gap) END AS step
      FROM (SELECT *, value - lag(value) OVER (PARTITION BY hash, var ORDER BY idx, tie, value) AS gap
            FROM coords) GROUP BY hash, var)"""


@query("dim_steps", f"WITH {STEPS_SQL} SELECT * FROM steps")
def dim_steps(spark, sf_dir):
    return X.dim_steps(V.coords(spark, sf_dir), order=("idx", "tie", "value"))


@query(
    "dim_profile",
    f"""WITH {AXES_SQL}, {STEPS_SQL},
        d AS (SELECT h.k, h.hash, u.name AS var FROM header_state h, unnest(h.dims) AS t(u)),
        texts AS (SELECT k, name, any_value(list_filter(attrs, lambda a: a.name = 'long_name')[1].value)
                           AS description,
                         any_value(list_filter(attrs, lambda a: a.name = 'units')[1].value) AS unit
                  FROM var_rows GROUP BY k, name)
        SELECT CAST(d.k AS VARCHAR) AS hash, d.var,
               CASE WHEN d.var = time THEN 'temporal'
                    WHEN d.var IN (longitude, latitude, depth) THEN 'spatial' ELSE 'other' END AS type,
               CASE WHEN d.var = time THEN NULL WHEN d.var = longitude THEN 'x'
                    WHEN d.var = latitude THEN 'y' WHEN d.var = depth THEN 'z' END AS axis,
               extent_min, extent_max, step, description, unit
        FROM d JOIN axes a ON a.k = d.k LEFT JOIN texts t ON t.k = d.k AND t.name = d.var
        LEFT JOIN steps s ON s.hash = CAST(d.k AS VARCHAR) AND s.var = d.var""",
)
def dim_profile(spark, sf_dir):
    number = F.regexp_extract("key", r"(\d+)\.nc$", 1)
    named = V.header(spark, sf_dir).withColumn("hash", number)
    steps = V.coords(spark, sf_dir)
    return X.dim_profile(named, steps, order=("idx", "tie", "value"))


@query(
    "var_profile",
    """SELECT hash, name, array_to_string(vdims, ',') AS dimensions,
              CASE WHEN is_coord THEN 'auxiliary' ELSE 'data' END AS type,
              list_filter(attrs, lambda a: a.name = 'long_name')[1].value AS description,
              list_filter(attrs, lambda a: a.name = 'units')[1].value AS unit,
              len(attrs) AS n_attrs,
              array_to_string(list_transform(vdims, lambda d:
                CAST(list_filter(dims, lambda x: x.name = d)[1].size AS VARCHAR)), ',') AS shape
       FROM var_rows WHERE NOT is_coord OR len(list_filter(dims, lambda x: x.name = var_rows.name)) = 0""",
)
def var_profile(spark, sf_dir):
    profile = X.var_profile(headers(spark, sf_dir))
    return profile.select(
        "hash",
        "name",
        F.array_join("dimensions", ",").alias("dimensions"),
        "type",
        "description",
        "unit",
        F.size("attrs").cast("bigint").alias("n_attrs"),
        F.array_join(F.transform("shape", lambda n: n.cast("string")), ",").alias("shape"),
    )


SIDES_SQL = """min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north,
               min(t_min) AS t_min, max(t_max) AS t_max"""


@query(
    "join_extents",
    f"""SELECT collection_id, {SIDES_SQL} FROM items
        WHERE south < 0 OR west >= 113 GROUP BY collection_id""",
)
def join_extents(spark, sf_dir):
    every = V.items(spark, sf_dir)
    left = X.collection_extent(every.filter(F.col("south") < 0))
    right = X.collection_extent(every.filter(F.col("west") >= 113))
    return X.join_extents(left, right, "collection_id")


@query(
    "collection_extent",
    f"SELECT collection_id, {SIDES_SQL}, count(*) AS n_items FROM items GROUP BY collection_id",
)
def collection_extent(spark, sf_dir):
    return X.collection_extent(V.items(spark, sf_dir))


@query(
    "extent_rollup",
    f"""WITH RECURSIVE up AS (
          SELECT id, id AS ancestor, parent_id FROM collections
          UNION ALL
          SELECT u.id, c.id, c.parent_id FROM up u JOIN collections c ON u.parent_id = c.id)
        SELECT ancestor AS collection_id, {SIDES_SQL}, count(*) AS n_items
        FROM items JOIN up ON items.collection_id = up.id GROUP BY ancestor""",
)
def extent_rollup(spark, sf_dir):
    extents = X.collection_extent(V.items(spark, sf_dir))
    return T.extent_rollup(extents, V.collections(spark, sf_dir))


CHANGED_SQL = """
    found AS (SELECT replace(replace(key, '/', '_'), '.', '_') AS item_id, hash AS checksum FROM hashed),
    old AS (SELECT replace(replace(key, '/', '_'), '.', '_') AS item_id,
                   CASE WHEN facility = 'ANMN' THEN 'stale' ELSE hash END AS checksum
            FROM hashed WHERE last_modified_date < TIMESTAMP '2024-01-20')"""


def found_and_old(spark, sf_dir):
    rows = V.inv(spark, sf_dir)
    found = rows.select(item_id(F.col("key")).alias("item_id"), V.identity_hash().alias("checksum"))
    early = rows.filter(F.col("last_modified_date") < F.lit("2024-01-20").cast("timestamp_ntz"))
    stale = F.when(F.col("key").startswith("IMOS/ANMN/"), "stale").otherwise(V.identity_hash())
    return found, early.select(item_id(F.col("key")).alias("item_id"), stale.alias("checksum"))


@query(
    "changed_objects",
    f"""WITH {CHANGED_SQL}
        SELECT f.item_id, f.checksum, CASE WHEN o.item_id IS NULL THEN 'add'
                 WHEN o.checksum = f.checksum THEN 'skip' ELSE 'replace' END AS action
        FROM found f LEFT JOIN old o ON f.item_id = o.item_id""",
)
def changed_objects(spark, sf_dir):
    return T.changed_objects(*found_and_old(spark, sf_dir))


@query(
    "work_list",
    f"""WITH {CHANGED_SQL}
        SELECT f.item_id, f.checksum FROM found f LEFT JOIN old o ON f.item_id = o.item_id
        WHERE o.item_id IS NULL OR o.checksum <> f.checksum""",
)
def work_list(spark, sf_dir):
    return T.work_list(*found_and_old(spark, sf_dir))


@query(
    "collection_tree",
    """WITH RECURSIVE wanted AS (SELECT DISTINCT collection_id AS id FROM items
                                 WHERE south >= 0),
       up AS (SELECT id FROM wanted
              UNION
              SELECT c.parent_id FROM up JOIN collections c ON up.id = c.id
              WHERE c.parent_id IS NOT NULL)
       SELECT up.id, coalesce(nullif(title, ''), up.id) AS title, description, parent_id
       FROM up LEFT JOIN collections c ON c.id = up.id""",
)
def collection_tree(spark, sf_dir):
    wanted = V.items(spark, sf_dir).filter(F.col("south") >= 0)
    wanted = wanted.select(F.col("collection_id").alias("id"))
    return T.collection_tree(wanted, V.collections(spark, sf_dir))


@query(
    "items_by_collection",
    f"""SELECT {_rules_sql('key')} AS collection_id, count(*) AS n_items,
               CAST(sum(orderkey) AS BIGINT) AS total_bytes FROM idx GROUP BY 1""",
)
def items_by_collection(spark, sf_dir):
    items = V.idx(spark, sf_dir).select(
        T.collection_id(F.col("key")).alias("collection_id"), F.col("orderkey").alias("size")
    )
    return T.items_by_collection(items)


def documents(spark, sf_dir):
    number = F.regexp_extract("key", r"(\d+)\.nc$", 1)
    header = V.header(spark, sf_dir).withColumn("hash", number)
    extents = X.file_extents(V.coords(spark, sf_dir))
    return T.item_documents(
        header.join(extents, "hash").select(
            "*",
            item_id(F.col("key")).alias("item_id"),
            derive_facility(F.col("key")).alias("collection_id"),
            V.identity_hash().alias("checksum"),
            F.lit("2024-01-31T00:00:00Z").alias("created"),
        )
    )


@query(
    "item_documents",
    f"""WITH {EXTENT_SQL}
        SELECT CASE WHEN k % 37 = 0 THEN 'UNKNOWN' ELSE 'ANMN' END AS collection_id,
               replace(replace(key, '/', '_'), '.', '_') AS item_id,
               's3://corpus/' || key AS href, 'application/netcdf' AS media_type,
               CAST(size AS VARCHAR) AS size, h.hash AS checksum,
               coalesce(list_filter(attrs, lambda a: a.name = 'abstract')[1].value,
                        list_filter(attrs, lambda a: a.name = 'description')[1].value) AS description,
               e.west, e.north, CASE WHEN t_min = t_max THEN t_min END AS single_time
        FROM header_state h JOIN extent e ON CAST(h.k AS VARCHAR) = e.hash""",
)
def item_documents(spark, sf_dir):
    path = shared_dir(spark)
    T.write_documents(documents(spark, sf_dir), path)
    text = F.col("value")

    def at(place: str):
        return F.get_json_object(text, f"$.{place}")

    return spark.read.text(path).select(
        "collection_id",
        at("id").alias("item_id"),
        at("assets.data.href").alias("href"),
        at("assets.data.type").alias("media_type"),
        at("assets.data['file:size']").alias("size"),
        at("assets.data['file:checksum']").alias("checksum"),
        at("properties.description").alias("description"),
        at("bbox[0]").cast("double").alias("west"),
        at("bbox[3]").cast("double").alias("north"),
        at("time.datetime").cast("double").alias("single_time"),
    )
