"""Batch partitioning and resumption."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import batches as B
from fathom.session import materialize, shared_dir
from suite import views as V
from suite.q_store import BATCHED_SQL
from suite.registry import query


def batched(spark, sf_dir):
    return materialize(B.greedy_batches(V.inv_docs(spark, sf_dir), 16, 60000))


@query(
    "greedy_batches",
    f"""WITH RECURSIVE {BATCHED_SQL}
        SELECT key, size, CAST(r - 1 AS BIGINT) AS idx, batch_id FROM batched""",
)
def greedy_batches(spark, sf_dir):
    packed = B.greedy_batches(V.inv_docs(spark, sf_dir), 16, 60000)
    return packed.select("key", "size", "idx", "batch_id")


@query(
    "greedy_batches_lines",
    f"""WITH RECURSIVE
        run AS (SELECT r, size, sum(size) OVER (ORDER BY r) AS total
                FROM (SELECT row_number() OVER (ORDER BY bucket, key, version_id) AS r,
                             coalesce(size, 0) AS size FROM inv_lines)),
        first_at AS (SELECT total, min(r) AS r FROM run GROUP BY total),
        next AS (
          SELECT a.r, a.size, a.total,
                 least(a.r + 1000, greatest(a.r + 1, coalesce(b.r, (SELECT max(r) + 1 FROM run)))) AS stop
          FROM (SELECT *, total - size + {10 * 1024**3} AS room FROM run) a
          ASOF LEFT JOIN first_at b ON a.room < b.total),
        batch AS (
          SELECT CAST(0 AS BIGINT) AS batch_id, r, size, total, stop FROM next WHERE r = 1
          UNION ALL
          SELECT batch_id + 1, n.r, n.size, n.total, n.stop FROM batch b JOIN next n ON n.r = b.stop)
        SELECT batch_id, least(stop, (SELECT max(r) + 1 FROM run)) - batch.r AS n_files,
               CAST((SELECT max(e.total) FROM run e WHERE e.r = least(stop, (SELECT max(r) + 1 FROM run)) - 1)
                    - batch.total + batch.size AS BIGINT) AS total_bytes
        FROM batch""",
)
def greedy_batches_lines(spark, sf_dir):
    """The largest inventory with the default bounds; its SQL steps from batch to batch."""
    packed = B.greedy_batches(V.inv_lines(spark, sf_dir), B.MAX_FILES, B.MAX_BYTES)
    return packed.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("total_bytes")
    )


@query(
    "facility_batches",
    """WITH RECURSIVE
       rn AS (SELECT *, split_part(key, '/', 2) AS facility,
                     row_number() OVER (ORDER BY split_part(key, '/', 2), bucket, key, version_id) AS r
              FROM inv_docs),
       packed AS (
         SELECT r, facility, CAST(0 AS BIGINT) AS batch_id, 1 AS n, size AS total FROM rn WHERE r = 1
         UNION ALL
         SELECT rn.r, rn.facility,
                CASE WHEN cut THEN batch_id + 1 ELSE batch_id END,
                CASE WHEN cut THEN 1 ELSE n + 1 END,
                CASE WHEN cut THEN rn.size ELSE total + rn.size END
         FROM (SELECT p.*, q.r AS nr, (n >= 16 OR total + q.size > 60000 OR q.facility <> p.facility)
                      AS cut
               FROM packed p JOIN rn q ON q.r = p.r + 1) p JOIN rn ON rn.r = p.nr)
       SELECT rn.facility, rn.key, packed.batch_id FROM rn JOIN packed USING (r)""",
)
def facility_batches(spark, sf_dir):
    packed = B.facility_batches(V.inv_docs(spark, sf_dir), 16, 60000)
    return packed.select("facility", "key", "batch_id")


DIGEST_SQL = """
    digests AS (
      SELECT batch_id, count(*) AS n_files,
             sha256(string_agg(h, ',' ORDER BY h)) AS batch_digest
      FROM (SELECT batch_id, sha256('bucket:' || bucket || '|key:' || key || '|version:'
                                    || version_id) AS h FROM batched)
      GROUP BY batch_id)"""


@query(
    "batch_digest",
    f"WITH RECURSIVE {BATCHED_SQL}, {DIGEST_SQL} SELECT batch_id, n_files, batch_digest FROM digests",
)
def batch_digest(spark, sf_dir):
    return B.batch_digest(batched(spark, sf_dir))


@query(
    "resume_batches",
    f"""WITH RECURSIVE {BATCHED_SQL}, {DIGEST_SQL}
        SELECT key, batch_id FROM batched
        WHERE batch_id NOT IN (SELECT batch_id FROM digests WHERE n_files < 16)""",
)
def resume_batches(spark, sf_dir):
    packed = batched(spark, sf_dir)
    done = B.batch_digest(packed).filter(F.col("n_files") < 16).select("batch_digest")
    return B.resume_batches(packed, done).select("key", "batch_id")


@query(
    "batch_manifest",
    f"""WITH RECURSIVE {BATCHED_SQL}
        SELECT batch_id, bucket, key, version_id, size FROM batched""",
)
def batch_manifest(spark, sf_dir):
    path = shared_dir(spark)
    B.write_manifest(batched(spark, sf_dir), path)
    return spark.read.parquet(path).select("batch_id", "bucket", "key", "version_id", "size")


@query(
    "split_to_byte_cap",
    f"""WITH RECURSIVE {BATCHED_SQL},
        line AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY r) - 1 AS i,
                        length(bucket || key || version_id) AS len FROM batched),
        part AS (
          SELECT batch_id, CAST(0 AS BIGINT) AS lo, max(i) + 1 AS hi, sum(len) AS total
          FROM line GROUP BY batch_id
          UNION ALL
          SELECT p.batch_id, p.lo2, p.hi2,
                 (SELECT sum(len) FROM line l
                  WHERE l.batch_id = p.batch_id AND l.i >= p.lo2 AND l.i < p.hi2)
          FROM (SELECT batch_id, total, unnest([lo, lo + (hi - lo) // 2]) AS lo2,
                       unnest([lo + (hi - lo) // 2, hi]) AS hi2 FROM part WHERE total > 100) p),
        final AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY lo) - 1 AS part_no
                  FROM part WHERE total <= 100)
        SELECT line.batch_id, key, CAST(part_no AS BIGINT) AS part_no
        FROM line JOIN final f ON line.batch_id = f.batch_id AND i >= lo AND i < hi""",
)
def split_to_byte_cap(spark, sf_dir):
    encoded = F.length(F.concat("bucket", "key", "version_id"))
    parts = B.split_to_byte_cap(batched(spark, sf_dir), encoded, 100)
    return parts.select("batch_id", "key", "part_no")
