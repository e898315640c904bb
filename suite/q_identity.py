"""Identity, derived columns, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import identity as N
from fathom.operators import batches as B
from fathom.operators import quality as Q
from fathom.operators.store import latest
from suite import views as V
from suite.registry import query

def cols():
    return F.col("bucket"), F.col("key"), F.col("version_id")


@query("object_hash", "SELECT key, version_id, hash FROM hashed")
def object_hash(spark, sf_dir):
    return V.inv(spark, sf_dir).select(
        "key", "version_id", N.object_hash(*cols()).alias("hash")
    )


@query("object_uri", "SELECT version_id, 's3://' || bucket || '/' || key AS uri FROM inv")
def object_uri(spark, sf_dir):
    return V.inv(spark, sf_dir).select(
        "version_id", N.object_uri(F.col("bucket"), F.col("key")).alias("uri")
    )


@query(
    "versioned_uri",
    """SELECT 's3://' || bucket || '/' || key || '?versionId=' || coalesce(version_id, 'None')
              AS uri FROM inv""",
)
def versioned_uri(spark, sf_dir):
    return V.inv(spark, sf_dir).select(N.versioned_uri(*cols()).alias("uri"))


@query(
    "object_path",
    r"""SELECT key,
         rtrim(regexp_replace(bucket || '/' || key || '/' || coalesce(version_id, 'None'),
               '/+', '/', 'g'), '/') AS full_path,
         rtrim(regexp_replace(bucket || '/' || key || coalesce(':' || version_id, ''),
               '/+', '/', 'g'), '/') AS short_path
       FROM url_keys""",
)
def object_path(spark, sf_dir):
    return V.url_keys(spark, sf_dir).select(
        "key",
        N.object_path(*cols()).alias("full_path"),
        N.version_path(*cols()).alias("short_path"),
    )


_FACILITY_SQL = """CASE WHEN len(parts) >= 3 AND trim(parts[2]) <> '' THEN trim(parts[2]) END"""


@query(
    "derive_facility",
    f"""SELECT key, coalesce({_FACILITY_SQL}, 'UNKNOWN') AS facility
        FROM (SELECT key, list_filter(string_split(key, '/'), lambda x: x <> '') AS parts
              FROM url_keys UNION ALL
              SELECT key, list_filter(string_split(key, '/'), lambda x: x <> '') FROM inv)""",
)
def derive_facility(spark, sf_dir):
    keys = V.url_keys(spark, sf_dir).select("key").unionAll(V.inv(spark, sf_dir).select("key"))
    return keys.select("key", N.derive_facility(F.col("key")).alias("facility"))


@query(
    "derive_collection",
    f"""SELECT url AS uri, {_FACILITY_SQL} AS collection
        FROM (SELECT url, list_filter(string_split(array_to_string(
                string_split(url, '/')[4:], '/'), '/'), lambda x: x <> '') AS parts FROM pages)""",
)
def derive_collection(spark, sf_dir):
    return V.table(spark, sf_dir, "pages").select(
        F.col("url").alias("uri"), N.derive_collection(F.col("url")).alias("collection")
    )


@query(
    "identity_duplicates",
    """SELECT 's3://corpus/IMOS/' || l_orderkey || '/' || l_linenumber || '.nc?versionId=None'
              AS uri, count(*) AS n
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def identity_duplicates(spark, sf_dir):
    """Order lines named by order and line number only, which some lines share."""
    name = F.concat_ws("/", F.lit("IMOS"), "l_orderkey", "l_linenumber")
    references = V.table(spark, sf_dir, "lineitem").select(
        F.lit(V.BUCKET).alias("bucket"),
        F.concat(name, F.lit(".nc")).alias("key"),
        F.lit(None).cast("string").alias("version_id"),
    )
    return Q.identity_duplicates(references)


@query(
    "latest_per_key",
    """SELECT hash, size, seq FROM (
         SELECT *, row_number() OVER (PARTITION BY hash ORDER BY seq DESC) AS n FROM (
           SELECT hash, size, 1 AS seq FROM hashed
           UNION ALL SELECT hash, size + 1, 2 FROM hashed WHERE facility = 'SOOP'))
       WHERE n = 1""",
)
def latest_per_key(spark, sf_dir):
    rows = V.inv(spark, sf_dir).withColumn("hash", V.identity_hash())
    first = rows.select("hash", "size", F.lit(1).alias("seq"))
    again = rows.filter(F.col("key").startswith("IMOS/SOOP/")).select(
        "hash", (F.col("size") + 1).alias("size"), F.lit(2).alias("seq")
    )
    return latest(first.unionAll(again), F.col("seq"))


@query(
    "identity_not_null",
    """SELECT bucket, key, version_id, size, hash, 'identity field is missing: version_id' AS error
       FROM hashed WHERE version_id IS NULL""",
)
def identity_not_null(spark, sf_dir):
    _, bad = Q.check_identity(V.inv(spark, sf_dir))
    return bad.select("bucket", "key", "version_id", "size", "hash", "error")


@query(
    "batch_bytes",
    """SELECT CAST(sum(coalesce(size, 0)) AS BIGINT) AS total_bytes,
              sum(coalesce(size, 0)) / 1048576.0::DOUBLE AS total_mb FROM inv""",
)
def batch_bytes(spark, sf_dir):
    return B.batch_bytes(V.inv(spark, sf_dir))


@query("format_from_magic", "SELECT key, file_format FROM header")
def format_from_magic(spark, sf_dir):
    return V.header(spark, sf_dir).select(
        "key", N.format_from_magic(F.col("magic")).alias("file_format")
    )


@query(
    "extract_year",
    r"""SELECT key, TRY_CAST(nullif(regexp_extract(key, '\b(\d{4})\b', 1), '') AS INTEGER) AS year
        FROM inv""",
)
def extract_year(spark, sf_dir):
    return V.inv(spark, sf_dir).select("key", N.extract_year(F.col("key")).alias("year"))


@query(
    "key_dir_prefix",
    "SELECT key, array_to_string(string_split(key, '/')[:-2], '/') || '/' AS prefix FROM inv",
)
def key_dir_prefix(spark, sf_dir):
    return V.inv(spark, sf_dir).select("key", N.dir_prefix(F.col("key")).alias("prefix"))


@query(
    "route_by_size",
    """SELECT CASE WHEN size <= 104857600 THEN 'disk' ELSE 'cloud' END AS route,
              count(*) AS n_files FROM inv GROUP BY 1""",
)
def route_by_size(spark, sf_dir):
    routed = V.inv(spark, sf_dir).groupBy(N.route_by_size(F.col("size")).alias("route"))
    return routed.agg(F.count(F.lit(1)).alias("n_files"))


@query(
    "item_id",
    "SELECT key, replace(replace(key, '/', '_'), '.', '_') AS item_id FROM inv",
)
def item_id(spark, sf_dir):
    return V.inv(spark, sf_dir).select("key", N.item_id(F.col("key")).alias("item_id"))


@query(
    "file_type_dispatch",
    """SELECT key, reader,
              CASE WHEN reader IS NULL THEN 'Unsupported file type: ' || kind END AS error
       FROM (SELECT key, kind, CASE WHEN kind IN ('nc', 'csv') THEN kind END AS reader
             FROM (SELECT key, string_split(key, '.')[-1] AS kind FROM url_keys))""",
)
def file_type_dispatch(spark, sf_dir):
    key = F.col("key")
    reader = N.item_reader(key)
    unsupported = F.concat(F.lit("Unsupported file type: "), N.file_type(key))
    return V.url_keys(spark, sf_dir).select(
        "key", reader.alias("reader"), F.when(reader.isNull(), unsupported).alias("error")
    )
