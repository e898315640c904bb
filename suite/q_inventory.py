"""Scans and sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fathom.functions.identity import derive_facility
from fathom.operators import profile as P
from fathom.sources import files as files_source
from fathom.sources import inventory as I
from fathom.sources.table_source import scan_source as scan_through_source
from fathom.session import shared_dir
from suite import views as V
from suite.registry import query

NOW = dt.datetime(2024, 1, 31, 12, 34, 56)


@query(
    "scan_inventory",
    """SELECT bucket, key, version_id, size FROM inv
       WHERE size > 65536000 AND last_modified_date < TIMESTAMP '2024-01-25'""",
)
def scan_inventory(spark, sf_dir):
    scan = I.Scan(
        row_filter="size > 65536000 AND last_modified_date < timestamp_ntz'2024-01-25'",
        fields=("bucket", "key", "version_id", "size"),
    )
    return scan.apply(V.inv(spark, sf_dir))


def _stored(spark, sf_dir):
    """The inventory as a stored table of one folder a facility."""
    path = shared_dir(spark)
    rows = V.inv(spark, sf_dir).withColumn("facility", derive_facility(F.col("key")))
    rows.write.partitionBy("facility").parquet(path)
    return path


@query(
    "scan_source",
    """SELECT key, size, facility FROM hashed
       WHERE size > 65536000 AND last_modified_date >= TIMESTAMP '2024-01-10' AND key LIKE 'IMOS/A%'
         AND version_id IS NOT NULL AND facility <> 'AATAMS'""",
)
def scan_source(spark, sf_dir):
    """Through the data source: names in another case, filters on columns that are not returned."""
    scan = I.Scan(
        row_filter="""SIZE > 65536000 AND Last_Modified_Date >= timestamp_ntz'2024-01-10' AND KEY LIKE 'IMOS/A%'
                      AND version_ID IS NOT NULL AND Facility <> 'AATAMS'""",
        fields=("Key", "SIZE", "facility"),
    )
    return scan_through_source(spark, _stored(spark, sf_dir), scan, case_sensitive=False)


@query(
    "scan_source_limit",
    """SELECT least(count(*), 700) AS n_rows, least(count(*), 700) AS n_keys, 'bucket,key' AS columns FROM inv""",
)
def scan_source_limit(spark, sf_dir):
    """A row limit on the scan: that many different rows, of the fields asked for."""
    found = scan_through_source(spark, _stored(spark, sf_dir), I.Scan(fields=("bucket", "key"), limit=700))
    return found.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("key").alias("n_keys"),
        F.lit(",".join(found.columns)).alias("columns"),
    )


@query("scan_empty_typed", "SELECT bucket, key, version_id, size FROM inv WHERE size < 0")
def scan_empty_typed(spark, sf_dir):
    empty = I.Scan(row_filter="size < 0", fields=("bucket", "key", "version_id", "size"))
    return empty.apply(V.inv(spark, sf_dir)).unionByName(I.empty_inventory(spark))


# Folders of the indexed facilities.
_INDEXED = (
    "SOOP", "AATAMS", "ANMN", "FAIMMS", "OceanCurrent", "DWM", "AUV", "COASTAL-WAVE-BUOYS", "NTP", "ANFOG", "eMII",
)
# End of fixed values.


@query(
    "facility_prefix_scan",
    "SELECT key, size FROM inv WHERE " + " OR ".join(f"key LIKE 'IMOS/{name}/%'" for name in _INDEXED),
)
def facility_prefix_scan(spark, sf_dir):
    scan = I.Scan(row_filter=I.starts_with_any(F.col("key")), fields=("key", "size"))
    return scan.apply(V.inv(spark, sf_dir))


@query(
    "facility_subset",
    """SELECT facility, key, size FROM (
         SELECT *, row_number() OVER (PARTITION BY facility
                                      ORDER BY sha256('7:' || hash), size) AS n FROM hashed)
       WHERE n <= 300""",
)
def facility_subset(spark, sf_dir):
    sampled = I.facility_subset(V.inv(spark, sf_dir), per_facility=300, seed="7")
    return sampled.select("facility", "key", "size")


@query(
    "delta_inventory",
    """SELECT bucket, key, version_id, size FROM inv i
       WHERE last_modified_date >= TIMESTAMP '2024-01-16 10:00:00'
         AND NOT EXISTS (SELECT 1 FROM sink_a s WHERE s.bucket = i.bucket AND s.key = i.key
                         AND s.version_id = i.version_id)
         AND NOT EXISTS (SELECT 1 FROM sink_b s WHERE s.bucket = i.bucket AND s.key = i.key
                         AND s.version_id = i.version_id)""",
)
def delta_inventory(spark, sf_dir):
    recent = V.inv(spark, sf_dir).filter(I.lookback(NOW, days=15, hours=2))
    source = recent.select("bucket", "key", "version_id", "size")
    return I.delta_inventory(source, [V.sink_a(spark, sf_dir), V.sink_b(spark, sf_dir)])


@query(
    "lookback_filter",
    """SELECT key, last_modified_date FROM inv
       WHERE size > 1000 AND last_modified_date >= TIMESTAMP '2024-01-28 07:00:00'""",
)
def lookback_filter(spark, sf_dir):
    recent = I.lookback(NOW, days=3, hours=5, existing="size > 1000")
    return V.inv(spark, sf_dir).filter(recent).select("key", "last_modified_date")


@query(
    "lookback_day_floor",
    """SELECT key, last_modified_date FROM inv
       WHERE last_modified_date >= TIMESTAMP '2024-01-21 00:00:00'""",
)
def lookback_day_floor(spark, sf_dir):
    recent = I.lookback(NOW, days=10, floor="day")
    return V.inv(spark, sf_dir).filter(recent).select("key", "last_modified_date")


@query(
    "query_with_filter",
    "SELECT key, size FROM inv WHERE key LIKE 'IMOS/A%/1%' AND (size > 10000 OR size IS NULL)",
)
def query_with_filter(spark, sf_dir):
    wanted = I.key_like("IMOS/A%/1%", "size > 10000 OR size IS NULL")
    return I.Scan(row_filter=wanted, fields=("key", "size")).apply(V.inv(spark, sf_dir))


@query(
    "scan_parquet_dir",
    "SELECT facility, key, size FROM inv_lines",
)
def scan_parquet_dir(spark, sf_dir):
    path = shared_dir(spark)
    V.inv_lines(spark, sf_dir).write.partitionBy("facility").parquet(path)
    return I.scan_parquet(spark, path, I.Scan(fields=("facility", "key", "size")))


@query(
    "list_prefix",
    """SELECT key, hash AS etag, size, last_modified_date AS last_modified FROM hashed
       WHERE key LIKE 'IMOS/ANMN/%'""",
)
def list_prefix(spark, sf_dir):
    found = I.list_prefix(V.inv(spark, sf_dir), "IMOS/ANMN/", V.BUCKET)
    return found.select(
        "key",
        V.identity_hash().alias("etag"),
        "size",
        F.col("last_modified_date").alias("last_modified"),
    )


@query(
    "list_files",
    """SELECT facility, CAST(sum(strlen(key) + 1) AS BIGINT) AS size, true AS is_recent
       FROM inv_lines GROUP BY facility""",
)
def list_files(spark, sf_dir):
    """Text files of known length in a folder a facility: place, bytes and time as listed."""
    path = shared_dir(spark)
    lines = V.inv_lines(spark, sf_dir).select("facility", F.col("key").alias("value"))
    lines.write.partitionBy("facility").text(path)
    files = files_source.list_files(spark, path).filter(F.col("path").endswith(".txt"))
    facility = F.regexp_extract("path", "/facility=([^/]+)/", 1)
    recent = F.col("last_modified") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return files.groupBy(facility.alias("facility")).agg(
        F.sum("size").cast("bigint").alias("size"), F.bool_and(recent).alias("is_recent"),
    )


def _csv(spark, sf_dir):
    """Events as CSV files of four layouts, three files a type, each in a folder of its own.

    Clicks have another order and a name with a comma, errors no latitude, views no time.
    """
    path = shared_dir(spark)
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    latitude, longitude = F.col("value") / 10 - 50, F.col("user_id") + 0.5
    note = F.concat(F.lit('x "y", '), F.coalesce("props", F.lit("")))
    layouts = {
        "click": {"n": F.col("event_id"), "Date": time, 'a, "b"': note, "LON": longitude, "LAT": latitude},
        "error": {"n": F.col("event_id"), "lon": longitude, "time": time},
        "view": {"Latitude": latitude, "lon": longitude, "n": F.col("event_id")},
        None: {"sample_time": time, "Latitude": latitude, "lon": longitude, "n": F.col("event_id"), "note": note},
    }
    events = V.table(spark, sf_dir, "events").withColumn("part", F.col("event_id") % 3)
    known = [k for k in layouts if k]
    for kind, columns in layouts.items():
        own = F.col("event_type") == kind if kind else ~F.col("event_type").isin(*known)
        rows = events.filter(own).repartition("event_type", "part")
        rows = rows.select("event_type", "part", *[c.alias(n) for n, c in columns.items()])
        rows.write.mode("append").partitionBy("event_type", "part").option("header", True).option("escape", '"').csv(path)
    return path


def _place(rows):
    """Which file it is, by its folder."""
    kind = F.regexp_extract("file_path", "/event_type=([^/]+)/", 1)
    part = F.regexp_extract("file_path", "/part=([^/]+)/", 1)
    return rows.withColumn("file", F.concat(kind, F.lit("-"), part)).drop("file_path")


_CSV_FILES = """
    csv AS (SELECT event_type || '-' || CAST(event_id % 3 AS VARCHAR) AS file, event_type AS kind, event_id AS n,
                   value / 10 - 50 AS lat, user_id + 0.5::DOUBLE AS lon, date_trunc('second', ts) AS t
            FROM events)"""


@query(
    "scan_csv_files",
    f"""WITH {_CSV_FILES}
        SELECT file, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS sum_n,
               CASE kind WHEN 'click' THEN 5 WHEN 'error' THEN 3 WHEN 'view' THEN 3 ELSE 5 END AS n_columns
        FROM csv GROUP BY file, kind""",
)
def scan_csv_files(spark, sf_dir):
    """Files of all layouts in one scan; the column ``n`` stands at another place in each layout."""
    path = _csv(spark, sf_dir)
    layouts = files_source.csv_layouts(spark, path)
    rows = files_source.csv_cells(spark, path, layouts).join(layouts, "file_path")
    n = F.element_at("cells", F.array_position("names", "n").cast("int")).cast("bigint")
    return _place(rows.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(n).alias("sum_n"), F.first(F.size("names")).alias("n_columns")
    ))


_CSV_ROLES = """CASE kind WHEN 'click' THEN 'LAT' WHEN 'error' THEN NULL ELSE 'Latitude' END AS latitude,
               CASE kind WHEN 'click' THEN 'LON' ELSE 'lon' END AS longitude,
               CASE kind WHEN 'click' THEN 'Date' WHEN 'error' THEN 'time' WHEN 'view' THEN NULL
                         ELSE 'sample_time' END AS time,
               CASE kind WHEN 'view' THEN 'Time column not found' END AS error"""


@query("csv_column_roles", f"WITH {_CSV_FILES} SELECT DISTINCT file, {_CSV_ROLES} FROM csv")
def csv_column_roles(spark, sf_dir):
    layouts = files_source.csv_layouts(spark, _csv(spark, sf_dir))
    return _place(files_source.column_roles(files_source.named_columns(layouts)))


@query(
    "csv_extent",
    f"""WITH {_CSV_FILES},
        ends AS (
          SELECT file, kind, min(t) AS first_t, max(t) AS last_t,
                 min(lon) FILTER (kind NOT IN ('error', 'view')) AS west, min(lat) FILTER (kind NOT IN ('error', 'view')) AS south,
                 max(lon) FILTER (kind NOT IN ('error', 'view')) AS east, max(lat) FILTER (kind NOT IN ('error', 'view')) AS north
          FROM csv GROUP BY file, kind)
        SELECT file, {_CSV_ROLES}, west, south, east, north,
               CASE WHEN kind <> 'view' AND first_t = last_t THEN first_t END AS datetime,
               CASE WHEN kind <> 'view' AND first_t < last_t THEN first_t END AS start_datetime,
               CASE WHEN kind <> 'view' AND first_t < last_t THEN last_t END AS end_datetime
        FROM ends""",
)
def csv_extent(spark, sf_dir):
    return _place(files_source.csv_extents(spark, _csv(spark, sf_dir)))


@query(
    "csv_table_profile",
    f"""WITH {_CSV_FILES},
        counted AS (SELECT file, kind, count(*) AS row_count FROM csv GROUP BY file, kind),
        listed AS (
          SELECT file, row_count, unnest(CASE kind
            WHEN 'click' THEN ['n', 'Date', 'a, "b"', 'LON', 'LAT'] WHEN 'error' THEN ['n', 'lon', 'time']
            WHEN 'view' THEN ['Latitude', 'lon', 'n'] ELSE ['sample_time', 'Latitude', 'lon', 'n', 'note'] END) AS column_name
          FROM counted)
        SELECT file, row_count, column_name,
               CASE WHEN column_name = 'n' THEN 'int64'
                    WHEN lower(column_name) IN ('lat', 'lon', 'latitude') THEN 'float64' ELSE 'object' END AS col_type
        FROM listed""",
)
def csv_table_profile(spark, sf_dir):
    return _place(files_source.csv_table_profile(spark, _csv(spark, sf_dir))).drop("pos")


@query(
    "read_results",
    """SELECT facility, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS total
       FROM inv_lines GROUP BY facility""",
)
def read_results(spark, sf_dir):
    path = shared_dir(spark)
    V.inv_lines(spark, sf_dir).write.parquet(path)
    I.scan_parquet(spark, path).createOrReplaceTempView("index_table")
    return spark.sql(
        "SELECT facility, count(*) AS n_files, sum(size) AS total FROM index_table GROUP BY facility"
    )


@query("distinct_values", "SELECT DISTINCT split_part(key, '/', 2) AS facility FROM inv")
def distinct_values(spark, sf_dir):
    rows = V.inv(spark, sf_dir).withColumn("facility", derive_facility(F.col("key")))
    return P.distinct_values(rows, "facility")
