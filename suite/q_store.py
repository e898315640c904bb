"""Sinks, upsert, schema evolution. What is written is read back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom import schema as C
from fathom.operators import dead_letters as D
from fathom.operators import extract as E
from fathom.operators import store as S
from fathom.operators.batches import greedy_batches
from fathom.functions.identity import derive_facility
from fathom.plans.index_pipeline import HeaderTable, IndexTables, run_index
from fathom.session import materialize, shared_dir
from suite import views as V
from suite.registry import query

ENTRY = C.struct_type(
    {
        "hash": str,
        "bucket": str,
        "key": str,
        "version_id": str | None,
        "size": int | None,
        "facility": str,
    }
)
ENTRY_V2 = T.StructType([*ENTRY, T.StructField("last_modified_date", T.TimestampNTZType())])


def entries(spark, sf_dir):
    return V.inv(spark, sf_dir).select(
        V.identity_hash().alias("hash"),
        "bucket",
        "key",
        "version_id",
        "size",
        derive_facility(F.col("key")).alias("facility"),
        "last_modified_date",
    )


def first_half(rows):
    return rows.filter(F.col("last_modified_date") < F.lit("2024-01-20").cast("timestamp_ntz"))


def second_half(rows):
    late = F.col("last_modified_date") >= F.lit("2024-01-10").cast("timestamp_ntz")
    return rows.filter(late).withColumn("size", F.col("size") + 1)


FIRST_SQL = "SELECT * FROM hashed WHERE last_modified_date < TIMESTAMP '2024-01-20'"
SECOND_SQL = """SELECT * REPLACE (size + 1 AS size) FROM hashed
                WHERE last_modified_date >= TIMESTAMP '2024-01-10'"""
MERGED_SQL = f"""
    WITH first AS ({FIRST_SQL}), second AS ({SECOND_SQL})
    SELECT coalesce(s.hash, f.hash) AS hash, coalesce(s.key, f.key) AS key,
           CASE WHEN s.hash IS NULL THEN f.size ELSE s.size END AS size,
           coalesce(s.facility, f.facility) AS facility
    FROM first f FULL OUTER JOIN second s ON f.hash = s.hash"""


def two_commits(spark, sf_dir, partition_by="facility"):
    """A table provisioned and written twice, the second write overlapping the first."""
    path = shared_dir(spark)
    S.provision(spark, path, ENTRY, partition_by)
    rows = entries(spark, sf_dir)
    S.write(path, first_half(rows), ENTRY, partition_by, unique=True)
    S.write(path, second_half(rows), ENTRY, partition_by, unique=True)
    return path


@query("scan_as_of", f"SELECT hash, key, size, facility FROM ({FIRST_SQL})")
def scan_as_of(spark, sf_dir):
    path = two_commits(spark, sf_dir)
    return S.read(spark, path, ENTRY, snapshot=1).select("hash", "key", "size", "facility")


@query(
    "provision_table",
    "SELECT hash, key, size, facility FROM hashed",
)
def provision_table(spark, sf_dir):
    path = shared_dir(spark)
    S.provision(spark, path, ENTRY, "facility")
    S.write(path, entries(spark, sf_dir), ENTRY, "facility", unique=True)
    S.provision(spark, path, ENTRY, "facility")  # a second call keeps the rows
    return S.read(spark, path, ENTRY).select("hash", "key", "size", "facility")


@query("provision_reset", f"SELECT hash, key, size, facility FROM ({SECOND_SQL})")
def provision_reset(spark, sf_dir):
    path = shared_dir(spark)
    rows = entries(spark, sf_dir)
    S.provision(spark, path, ENTRY, "facility")
    S.write(path, first_half(rows), ENTRY, "facility", unique=True)
    S.provision(spark, path, ENTRY, "facility", reset=True)
    S.write(path, second_half(rows), ENTRY, "facility", unique=True)
    return S.read(spark, path, ENTRY).select("hash", "key", "size", "facility")


@query(
    "partition_by_column",
    """SELECT facility, count(*) AS n_rows, 'facility=' || facility AS folder
       FROM hashed GROUP BY facility""",
)
def partition_by_column(spark, sf_dir):
    path = shared_dir(spark)
    S.write(path, entries(spark, sf_dir), ENTRY, "facility", unique=True)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/(facility=[^/]+)/", 1)
    log = S.read_log(spark, path, ENTRY).withColumn("folder", folder)
    return log.groupBy("facility", "folder").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "evolve_schema",
    f"""WITH first AS ({FIRST_SQL}), second AS ({SECOND_SQL})
        SELECT hash, size, last_modified_date FROM second
        UNION ALL
        SELECT hash, size, NULL FROM first WHERE hash NOT IN (SELECT hash FROM second)""",
)
def evolve_schema(spark, sf_dir):
    path = shared_dir(spark)
    rows = entries(spark, sf_dir)
    S.write(path, first_half(rows), ENTRY, "facility", unique=True)
    S.write(path, second_half(rows), ENTRY_V2, "facility", unique=True)
    return S.read(spark, path).select("hash", "size", "last_modified_date")


@query("upsert_by_hash", MERGED_SQL)
def upsert_by_hash(spark, sf_dir):
    path = two_commits(spark, sf_dir)
    return S.read(spark, path, ENTRY).select("hash", "key", "size", "facility")


@query("upsert_merge", MERGED_SQL)
def upsert_merge(spark, sf_dir):
    rows = entries(spark, sf_dir)
    merged = S.upsert(first_half(rows), second_half(rows), partition_by="facility")
    return merged.select("hash", "key", "size", "facility")


@query(
    "dedupe_last_write",
    """SELECT hash, CASE WHEN facility = 'ANMN' THEN size * 3 ELSE size END AS size
       FROM hashed""",
)
def dedupe_last_write(spark, sf_dir):
    rows = entries(spark, sf_dir).withColumn("seq", F.lit(1))
    anmn = rows.filter(F.col("facility") == "ANMN")
    again = anmn.withColumn("size", F.col("size") * 2).withColumn("seq", F.lit(2))
    last = anmn.withColumn("size", F.col("size") * 3).withColumn("seq", F.lit(3))
    path = shared_dir(spark)
    S.write(path, rows.unionAll(last).unionAll(again), ENTRY, "facility", order=F.col("seq"))
    return S.read_log(spark, path, ENTRY).select("hash", "size")


@query(
    "to_typed_table",
    """SELECT key, schema_version, geospatial_lat_min, CAST(NULL AS VARCHAR) AS crs,
              CAST(NULL AS DOUBLE) AS geospatial_lon_max, site_code,
              array_to_string(list_transform(variables, lambda v: v || '=float32'), ',')
                AS variable_schema,
              CAST(33 AS INTEGER) AS n_columns
       FROM idx""",
)
def to_typed_table(spark, sf_dir):
    typed = C.conform(V.idx(spark, sf_dir), C.STRUCTURED)
    entries_ = F.array_sort(F.map_entries("variable_schema"))
    shown = F.array_join(F.transform(entries_, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return typed.select(
        "key",
        "schema_version",
        "geospatial_lat_min",
        "crs",
        "geospatial_lon_max",
        "site_code",
        shown.alias("variable_schema"),
        F.lit(len(typed.columns)).alias("n_columns"),
    )


@query(
    "sink_dead_letters",
    """SELECT hash, key, size, 'identity field is missing: version_id' AS error,
              CAST(4 AS BIGINT) AS schema_version, 'run-1' AS index_flow_id,
              CAST(NULL AS VARCHAR) AS batch_flow_id
       FROM hashed WHERE version_id IS NULL""",
)
def sink_dead_letters(spark, sf_dir):
    path = shared_dir(spark)
    S.provision(spark, path, C.DEAD_LETTER)
    bad = entries(spark, sf_dir).filter(F.col("version_id").isNull())
    rows = D.dead_letters(bad, "identity field is missing: version_id", "run-1")
    for _ in range(2):  # a repeated write changes nothing
        D.sink_dead_letters(rows, lambda r: S.write(path, r, C.DEAD_LETTER, order=F.col("error")))
    D.sink_dead_letters(rows.filter("size < 0"), lambda r: S.write(path, r, C.DEAD_LETTER, order=F.col("error")))
    columns = ["hash", "key", "size", "error", "schema_version", "index_flow_id", "batch_flow_id"]
    return S.read(spark, path, C.DEAD_LETTER).select(*columns)


@query("noop_sink", "SELECT count(*) AS n_rows FROM inv")
def noop_sink(spark, sf_dir):
    rows = V.inv(spark, sf_dir)
    S.write_noop(rows)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "write_sample",
    "SELECT hash, key FROM hashed ORDER BY sha256('3:' || hash) LIMIT 1000",
)
def write_sample(spark, sf_dir):
    path = shared_dir(spark)
    S.write_sample(entries(spark, sf_dir).select("hash", "key"), path, 1000, seed="3")
    return spark.read.parquet(path)


@query(
    "split_load",
    """SELECT CASE WHEN k % 37 = 0 THEN 'UNKNOWN' ELSE 'ANMN' END AS facility,
              count(*) AS n_structured, count(*) AS n_unstructured
       FROM header_state WHERE error IS NULL GROUP BY 1""",
)
def split_load(spark, sf_dir):
    structured, unstructured = shared_dir(spark), shared_dir(spark)
    S.provision(spark, structured, C.STRUCTURED, "facility")
    S.provision(spark, unstructured, C.UNSTRUCTURED, "facility")
    good, _ = D.split_results(E.extract(V.header(spark, sf_dir)))  # each write works out its half
    failed = D.split_load(
        good,
        lambda rows: S.write(structured, rows, C.STRUCTURED, "facility", unique=True, spread=True),
        lambda rows: S.write(unstructured, rows, C.UNSTRUCTURED, "facility", unique=True, spread=True),
    )
    assert failed is None
    a = S.read(spark, structured, C.STRUCTURED).groupBy("facility")
    b = S.read(spark, unstructured, C.UNSTRUCTURED).groupBy("facility")
    return a.agg(F.count(F.lit(1)).alias("n_structured")).join(
        b.agg(F.count(F.lit(1)).alias("n_unstructured")), "facility"
    )


@query(
    "index_run_repaired",
    """SELECT CASE WHEN k % 37 = 0 THEN 'UNKNOWN' ELSE 'ANMN' END AS facility,
              count(*) AS n_structured, count(*) AS n_unstructured, 0::BIGINT AS n_left
       FROM header_state WHERE error IS NULL GROUP BY 1""",
)
def index_run_repaired(spark, sf_dir):
    """A run whose second sink is down, then the same run again, then one with nothing to do."""
    tables = IndexTables.below(shared_dir(spark))
    header = V.header(spark, sf_dir)
    inventory = header.select(*C.IDENTITY_FIELDS, "size")

    read = HeaderTable(header)

    def write(path, *args, **options):
        if path == tables.unstructured:
            raise ConnectionError("sink is down")
        return S.write(path, *args, **options)

    first = run_index(inventory, tables, read, write=write)
    assert first.n_indexed == 0 and first.n_dead_letters >= first.n_new
    run_index(inventory, tables, read)
    # What cannot be indexed is tried again; of the rest nothing is left.
    assert run_index(inventory, tables, read).n_indexed == 0
    both = [
        S.read(spark, path, schema).groupBy("facility").agg(F.count(F.lit(1)).alias(name))
        for path, schema, name in (
            (tables.structured, C.STRUCTURED, "n_structured"),
            (tables.unstructured, C.UNSTRUCTURED, "n_unstructured"),
        )
    ]
    seen = S.read(spark, tables.structured, C.STRUCTURED).join(tables.indexed(spark), list(C.IDENTITY_FIELDS), "left_anti")
    left = seen.groupBy("facility").agg(F.count(F.lit(1)).alias("n_left"))
    return both[0].join(both[1], "facility").join(left, "facility", "left").fillna(0, ["n_left"])


@query(
    "concurrent_commits",
    """SELECT hash, CAST(1 + h AS INTEGER) AS writer
       FROM (SELECT hash, ascii(substr(hash, 1, 1)) % 3 AS h FROM hashed)""",
)
def concurrent_commits(spark, sf_dir):
    """Three writers at once, each with a part of the inventory; no commit is lost."""
    path = shared_dir(spark)
    part = F.ascii(F.substring("hash", 1, 1)) % 3
    rows = entries(spark, sf_dir).select("hash", (part + 1).cast("int").alias("writer"))
    schema = C.struct_type({"hash": str, "writer": int | None})
    S.provision(spark, path, schema)
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(S.write, path, rows.filter(part == i), schema, unique=True) for i in range(3)]
    assert sorted(job.result() for job in jobs) == [1, 2, 3]
    return S.read(spark, path, schema).select("hash", F.col("writer").cast("int").alias("writer"))


@query(
    "load_failure_dead_letters",
    """SELECT hash, key, size, 'sink is down' AS error FROM header_state WHERE error IS NULL""",
)
def load_failure_dead_letters(spark, sf_dir):
    good, _ = D.split_results(E.extract(V.header(spark, sf_dir)))

    def down(rows):
        raise ConnectionError("sink is down")

    return D.split_load(good, S.write_noop, down).select("hash", "key", "size", "error")


BATCHED_SQL = """
    rn AS (SELECT *, row_number() OVER (ORDER BY bucket, key, version_id) AS r FROM inv_docs),
    packed AS (
      SELECT r, CAST(0 AS BIGINT) AS batch_id, 1 AS n, size AS total FROM rn WHERE r = 1
      UNION ALL
      SELECT rn.r,
             CASE WHEN n >= {max_files} OR total + rn.size > {max_bytes} THEN batch_id + 1
                  ELSE batch_id END,
             CASE WHEN n >= {max_files} OR total + rn.size > {max_bytes} THEN 1 ELSE n + 1 END,
             CASE WHEN n >= {max_files} OR total + rn.size > {max_bytes} THEN rn.size
                  ELSE total + rn.size END
      FROM packed JOIN rn ON rn.r = packed.r + 1),
    batched AS (SELECT rn.*, batch_id FROM rn JOIN packed USING (r))
""".format(max_files=16, max_bytes=60000)


@query(
    "batch_failure_dead_letters",
    f"""WITH RECURSIVE {BATCHED_SQL},
        bad AS (SELECT batch_id FROM batched GROUP BY batch_id HAVING sum(size) > 55000)
        SELECT key, size, 'batch ended in an unknown state' AS error
        FROM batched WHERE batch_id IN (SELECT batch_id FROM bad)""",
)
def batch_failure_dead_letters(spark, sf_dir):
    batched = materialize(greedy_batches(V.inv_docs(spark, sf_dir), 16, 60000))
    totals = batched.groupBy("batch_id").agg(F.sum("size").alias("total"))
    bad = totals.filter(F.col("total") > 55000)
    lost = batched.join(bad, "batch_id", "left_semi")
    rows = D.dead_letters(lost, "batch ended in an unknown state")
    return rows.select("key", "size", "error")


@query(
    "dead_letter_total",
    """SELECT error, count(*) AS n_dead_letters FROM header_state
       WHERE error IS NOT NULL GROUP BY error""",
)
def dead_letter_total(spark, sf_dir):
    _, bad = D.split_results(E.extract(V.header(spark, sf_dir)))
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("n_dead_letters"))
