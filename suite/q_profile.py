"""Corpus profiling, coverage and attribute drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import attributes as A
from fathom.functions.identity import derive_facility
from fathom.operators import drift as R
from fathom.operators import paths as T
from fathom.operators import profile as P
from fathom.session import materialize
from suite import views as V
from suite.q_extract import UNSTRUCTURED_SQL, unstructured
from suite.registry import query


def inventory(spark, sf_dir):
    return V.inv(spark, sf_dir).withColumn("facility", derive_facility(F.col("key")))


def _round(df, places: int, *columns: str):
    return df.select(
        *[F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


@query(
    "corpus_totals",
    """SELECT count(*) AS n_rows, count(*) FILTER (key LIKE '%.nc') AS n_suffix,
              CAST(sum(size) AS DECIMAL(38,0)) AS total_bytes,
              round(CAST(sum(size) AS DOUBLE) / 1099511627776, 2) AS total_tb FROM inv""",
)
def corpus_totals(spark, sf_dir):
    return P.corpus_totals(V.inv(spark, sf_dir))


@query(
    "collection_sizes",
    """SELECT facility, CAST(total AS DECIMAL(38,0)) AS size_bytes,
              round(total / 1048576.0::DOUBLE, 6) AS size_mb,
              round(total / 1073741824.0::DOUBLE, 6) AS size_gb,
              round(total / 1099511627776.0::DOUBLE, 6) AS size_tb, n_files,
              round(total / 1048576.0::DOUBLE / n_files, 6) AS average_mb
       FROM (SELECT facility, CAST(sum(size) AS DOUBLE) AS total, count(*) AS n_files
             FROM hashed GROUP BY facility) WHERE total <> 0""",
)
def collection_sizes(spark, sf_dir):
    sizes = P.collection_sizes(inventory(spark, sf_dir))
    return _round(sizes, 6, "size_mb", "size_gb", "size_tb", "average_mb")


_QCUT = """
    WITH sized AS (SELECT facility, size / 1024.0::DOUBLE AS kb FROM {0} WHERE size > 0),
    breaks AS (SELECT list_sort(list_distinct(quantile_cont(kb, [{1}]))) AS b FROM sized)
    SELECT facility, CAST(len(list_filter(b, lambda x: x < kb)) AS INTEGER) AS size_bin,
           count(*) AS n_files FROM sized, breaks GROUP BY ALL"""
_PROBS = ", ".join(f"{i / 50}" for i in range(1, 50))


@query("quantile_bins", _QCUT.format("hashed", _PROBS))
def quantile_bins(spark, sf_dir):
    return P.quantile_bins(inventory(spark, sf_dir))


@query("quantile_bins_lines", _QCUT.format("inv_lines", _PROBS))
def quantile_bins_lines(spark, sf_dir):
    return P.quantile_bins(V.inv_lines(spark, sf_dir))


@query(
    "fixed_bins",
    """SELECT facility, size_bin, n_files,
              ['[-inf, 1)', '[1, 10)', '[10, 50)', '[50, 100)', '[100, 500)', '[500, 1000)',
               '[1000, 5000)', '[5000, inf)'][size_bin + 1] AS label
       FROM (SELECT facility, CASE WHEN mb < 1 THEN 0 WHEN mb < 10 THEN 1 WHEN mb < 50 THEN 2
                    WHEN mb < 100 THEN 3 WHEN mb < 500 THEN 4 WHEN mb < 1000 THEN 5
                    WHEN mb < 5000 THEN 6 ELSE 7 END AS size_bin, count(*) AS n_files
             FROM (SELECT facility, size / 1048576.0::DOUBLE AS mb FROM hashed WHERE size > 0)
             GROUP BY ALL)""",
)
def fixed_bins(spark, sf_dir):
    return P.fixed_bins(inventory(spark, sf_dir))


@query(
    "describe_by_group",
    """WITH r AS (SELECT facility, size, row_number() OVER (PARTITION BY facility ORDER BY size) - 1
                         AS i, count(*) OVER (PARTITION BY facility) AS n
                  FROM hashed WHERE size IS NOT NULL),
       marks AS (SELECT facility,
                   max(CASE WHEN i = floor((n - 1) * 0.25::DOUBLE + 0.5) THEN size END)::DOUBLE AS p25,
                   max(CASE WHEN i = floor((n - 1) * 0.5::DOUBLE + 0.5) THEN size END)::DOUBLE AS p50,
                   max(CASE WHEN i = floor((n - 1) * 0.75::DOUBLE + 0.5) THEN size END)::DOUBLE AS p75
                 FROM r GROUP BY facility)
       SELECT facility, count(size) AS n, count(*) FILTER (size IS NULL) AS n_null,
              round(avg(size), 3) AS mean, round(stddev(size), 3) AS std, min(size) AS min,
              max(size) AS max, any_value(p25) AS p25, any_value(p50) AS p50, any_value(p75) AS p75
       FROM hashed JOIN marks USING (facility) GROUP BY facility""",
)
def describe_by_group(spark, sf_dir):
    return _round(P.describe_by_group(inventory(spark, sf_dir), "facility", "size"), 3, "mean", "std")


@query("facility_counts", "SELECT facility, count(*) AS n FROM inv_lines GROUP BY facility")
def facility_counts(spark, sf_dir):
    return P.value_counts(V.inv_lines(spark, sf_dir), "facility")


ATTRIBUTES_SQL = f"""
    SELECT name AS attribute, count(*) AS n_files FROM attr_rows WHERE error IS NULL GROUP BY name"""


@query("attribute_keys", ATTRIBUTES_SQL)
def attribute_keys(spark, sf_dir):
    return R.attribute_keys(unstructured(spark, sf_dir))


def _names(spark, sf_dir):
    """Attribute names: those of the headers, and words that documents' sources spell."""
    return materialize(R.attribute_keys(unstructured(spark, sf_dir)).select("attribute"))


def _vocabulary(spark, sf_dir):
    """A larger set of names: every path element of the page URLs and every part name."""
    pages = V.table(spark, sf_dir, "pages").select(
        F.explode(F.split(F.regexp_replace("url", "^https?://", ""), "[/?&#]")).alias("attribute")
    )
    parts = V.table(spark, sf_dir, "part").select(
        F.concat_ws("_", "p_name", "p_type").alias("attribute")
    )
    return pages.unionAll(parts).distinct()


# The same names in SQL.
VOCABULARY_SQL = """
    SELECT DISTINCT attribute FROM (
      SELECT unnest(string_split_regex(regexp_replace(url, '^https?://', ''), '[/?&#]')) AS attribute
      FROM pages
      UNION ALL SELECT concat_ws('_', p_name, p_type) FROM part)"""


def alike_sql(names: str, cutoff: int) -> str:
    """Common table expressions up to ``alike`` (a, b, score): all pairs that score ``cutoff``.

    Pairs with too few letters in common are left out first. The longest common subsequence
    is the last number of a row that is carried over the letters of the second text.
    """
    return rf"""
    vocabulary AS ({names}),
    spelled AS (
      SELECT attribute, array_to_string(list_sort(list_filter(
               string_split_regex(lower(regexp_replace(attribute, '[^\p{{L}}\p{{N}}]', ' ', 'g')), '\s+'),
               lambda w: w <> '')), ' ') AS t
      FROM vocabulary),
    texts AS (SELECT DISTINCT t, length(t) AS n FROM spelled WHERE t <> ''),
    letters AS (
      SELECT t, n, c, row_number() OVER (PARTITION BY t, c) AS nth
      FROM (SELECT t, n, unnest(string_split(t, '')) AS c FROM texts)),
    near AS (
      SELECT x.t AS x, y.t AS y, any_value(x.n) + any_value(y.n) AS total
      FROM letters x JOIN letters y ON x.c = y.c AND x.nth = y.nth AND x.t <= y.t
      GROUP BY x.t, y.t HAVING 200 * count(*) >= {cutoff - 0.5} * (any_value(x.n) + any_value(y.n))),
    subsequence AS (
      SELECT x, y, total, list_reduce(
        list_transform(string_split(y, ''), lambda c: list_transform(string_split(x, ''),
                       lambda a: CASE WHEN a = c THEN 1::BIGINT ELSE 0::BIGINT END)),
        lambda r, m: list_transform(range(1, len(m) + 1), lambda i: greatest(
                       r[i], list_max(list_transform(range(1, i + 1), lambda j: coalesce(r[j - 1], 0) + m[j])))),
        list_transform(string_split(x, ''), lambda a: 0::BIGINT))[-1] AS n
      FROM near),
    scored AS (
      SELECT x, y, CAST(round_even(200.0::DOUBLE * n / total, 0) AS BIGINT) AS score FROM subsequence),
    alike AS (
      SELECT DISTINCT p.attribute AS a, q.attribute AS b, score
      FROM (SELECT x, y, score FROM scored UNION SELECT y, x, score FROM scored) s
      JOIN spelled p ON p.t = x JOIN spelled q ON q.t = y
      WHERE score >= {cutoff} AND p.attribute <> q.attribute)"""


@query("similar_attribute_pairs", f"WITH {alike_sql(VOCABULARY_SQL, 80)} SELECT a, b, score FROM alike")
def similar_attribute_pairs(spark, sf_dir):
    return R.similar_pairs(_vocabulary(spark, sf_dir))


@query(
    "attribute_clusters",
    rf"""WITH RECURSIVE {alike_sql(VOCABULARY_SQL, 80)},
        placed AS (
          SELECT attribute AS name, row_number() OVER (ORDER BY list_transform(
                   regexp_extract_all(lower(attribute), '\d+|\D+'),
                   lambda r: CASE WHEN regexp_matches(r, '^\d')
                     THEN '0' || lpad(CAST(length(ltrim(r, '0')) AS VARCHAR), 10, '0') || ltrim(r, '0')
                     ELSE '1' || r END), attribute) AS place
          FROM vocabulary),
        earlier AS (
          SELECT q.place, list(p.place) AS before, row_number() OVER (ORDER BY q.place) AS step
          FROM alike JOIN placed p ON p.name = a JOIN placed q ON q.name = b
          WHERE p.place < q.place GROUP BY q.place),
        walk AS (
          SELECT 0::BIGINT AS step, []::BIGINT[] AS members
          UNION ALL
          SELECT e.step, CASE WHEN len(list_filter(e.before, lambda x: NOT list_contains(w.members, x))) > 0
                              THEN list_append(w.members, e.place) ELSE w.members END
          FROM walk w JOIN earlier e ON e.step = w.step + 1),
        done AS (SELECT members FROM walk ORDER BY step DESC LIMIT 1),
        taken AS (
          SELECT place, list_min(list_filter(before, lambda x: NOT list_contains(members, x))) AS by
          FROM earlier, done WHERE list_contains(members, place))
        SELECT l.name AS leader, m.name AS member
        FROM placed m LEFT JOIN taken t ON t.place = m.place JOIN placed l ON l.place = coalesce(t.by, m.place)""",
)
def attribute_clusters(spark, sf_dir):
    return R.attribute_clusters(_vocabulary(spark, sf_dir))


# The payloads of the given tables are four levels deep.
PATHS_SQL = f"""
    p AS ({UNSTRUCTURED_SQL}),
    sections AS (SELECT '' AS parent, e.key AS path, e.value AS v, e.type AS kind
                 FROM p, json_each(CAST(p.metadata AS JSON)) e),
    lower AS (SELECT s.path AS parent, s.path || '.' || e.key AS path, e.value AS v, e.type AS kind
              FROM sections s, json_each(s.v) e WHERE s.kind = 'OBJECT'),
    deep AS (SELECT s.path AS parent, s.path || '.' || e.key AS path, e.value AS v, e.type AS kind
             FROM lower s, json_each(s.v) e WHERE s.kind = 'OBJECT'),
    deepest AS (SELECT s.path AS parent, s.path || '.' || e.key AS path, e.value AS v, e.type AS kind
                FROM deep s, json_each(s.v) e WHERE s.kind = 'OBJECT'),
    every AS (FROM sections UNION ALL FROM lower UNION ALL FROM deep UNION ALL FROM deepest),
    paths AS (
      SELECT path, parent, CASE kind WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array'
               WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
               WHEN 'NULL' THEN 'null' WHEN 'UBIGINT' THEN 'integer'
               WHEN 'BIGINT' THEN 'integer' ELSE 'number' END AS kind, count(*) AS n_rows
      FROM every GROUP BY ALL)"""


@query("payload_paths", f"WITH {PATHS_SQL} SELECT path, kind, n_rows FROM paths")
def payload_paths(spark, sf_dir):
    return T.payload_paths(unstructured(spark, sf_dir))


@query(
    "infer_json_schema",
    f"""WITH {PATHS_SQL}
        SELECT path, kind, n_rows,
               sum(n_rows) OVER (PARTITION BY path) =
               CASE WHEN parent = '' THEN (SELECT count(*) FROM p)
                    ELSE (SELECT sum(h.n_rows) FROM paths h WHERE h.path = x.parent AND h.kind = 'object')
               END AS required
        FROM paths x""",
)
def infer_json_schema(spark, sf_dir):
    return T.infer_json_schema(unstructured(spark, sf_dir))


@query(
    "facility_success",
    """WITH a AS (SELECT facility, count(*) AS n_inventory FROM hashed GROUP BY facility),
       b AS (SELECT split_part(key, '/', 2) AS facility, count(DISTINCT key) AS n FROM sink_a GROUP BY 1)
       SELECT facility, n_inventory, least(n_inventory, 1500) AS n_sampled,
              coalesce(n, 0) AS n_indexed,
              coalesce(n, 0) * 100.0::DOUBLE / least(n_inventory, 1500) AS success_pct
       FROM a LEFT JOIN b USING (facility)""",
)
def facility_success(spark, sf_dir):
    indexed = V.sink_a(spark, sf_dir).withColumn("facility", derive_facility(F.col("key")))
    return P.facility_success(inventory(spark, sf_dir), indexed, 1500, identity="key")


_COVERED = ("site_code", "deployment_code", "file_version", "time_coverage_end", "variable_schema")


@query(
    "field_coverage",
    """WITH long AS (
         SELECT facility, unnest([
           {'f': 'site_code', 'v': site_code IS NOT NULL},
           {'f': 'deployment_code', 'v': deployment_code IS NOT NULL},
           {'f': 'file_version', 'v': file_version IS NOT NULL},
           {'f': 'time_coverage_end', 'v': time_max IS NOT NULL},
           {'f': 'variable_schema', 'v': variables IS NOT NULL}]) AS c FROM idx)
       SELECT 'facility' AS scope, facility, count(*) AS n_rows, c.f AS field,
              count(*) FILTER (c.v) AS n_present,
              count(*) FILTER (c.v) * 100.0::DOUBLE / count(*) AS coverage_pct
       FROM long GROUP BY facility, c.f
       UNION ALL
       SELECT 'global', NULL, count(*), c.f, count(*) FILTER (c.v),
              count(*) FILTER (c.v) * 100.0::DOUBLE / count(*) FROM long GROUP BY c.f""",
)
def field_coverage(spark, sf_dir):
    return P.field_coverage(V.idx(spark, sf_dir), _COVERED)


def _correctness(spark, sf_dir):
    return R.mapping_correctness(V.header(spark, sf_dir))


_NUMERIC = [f.name for f in A.MAPPED_FIELDS if f.numeric]
_ALIASES = [{"field": f.name, "alias": a} for f in A.MAPPED_FIELDS for a in f.aliases]
_NUMBER = r"'^\s*[+-]?(\d+(_\d+)*\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"
CORRECTNESS_SQL = f"""
    names AS (SELECT a.field, a.alias FROM (SELECT unnest({_ALIASES}) AS a)),
    fields AS (SELECT DISTINCT field FROM names),
    files AS (SELECT k, CASE WHEN k % 37 = 0 THEN 'UNKNOWN' ELSE 'ANMN' END AS facility
              FROM header_state WHERE error IS NULL),
    hits AS (
      SELECT r.k, n.field, bool_or(r.name = n.alias) AS exact,
             bool_or(lower(r.name) = lower(n.alias)) AS anycase,
             arg_min(r.value, CASE WHEN r.name = n.alias THEN 0 ELSE 1000 END + r.pos) AS value
      FROM attr_rows r JOIN names n
        ON r.norm = replace(replace(lower(n.alias), '_', ''), '-', '')
      GROUP BY r.k, n.field),
    cells AS (
      SELECT f.k, f.facility, d.field, coalesce(exact, false) AS exact,
             coalesce(anycase, false) AND NOT coalesce(exact, false) AS case_only,
             value IS NOT NULL AND (d.field NOT IN ({', '.join(repr(n) for n in _NUMERIC)})
               OR regexp_matches(value, {_NUMBER})) AS filled,
             d.field IN ({', '.join(repr(n) for n in _NUMERIC)}) AS numeric
      FROM files f CROSS JOIN fields d LEFT JOIN hits h ON h.k = f.k AND h.field = d.field),
    correctness AS (
      SELECT facility, count(*) AS n_files, field, count(*) FILTER (exact) AS n_key,
             count(*) FILTER (filled) AS n_populated,
             count(*) FILTER (numeric AND exact AND NOT filled) AS n_cast_failed,
             count(*) FILTER (case_only) AS n_case_only,
             count(*) FILTER (exact) * 100.0::DOUBLE / count(*) AS key_pct,
             count(*) FILTER (filled) * 100.0::DOUBLE / count(*) AS populated_pct
      FROM cells GROUP BY GROUPING SETS ((field), (facility, field)))"""


@query("mapping_correctness", f"WITH {CORRECTNESS_SQL} SELECT * FROM correctness")
def mapping_correctness(spark, sf_dir):
    return _correctness(spark, sf_dir)


@query(
    "mapping_flags",
    f"""WITH {CORRECTNESS_SQL}
        SELECT * FROM correctness WHERE key_pct >= 20 AND populated_pct <= 5""",
)
def mapping_flags(spark, sf_dir):
    return R.mapping_flags(_correctness(spark, sf_dir))


@query(
    "mapping_suggestions",
    f"""WITH {alike_sql(f"SELECT attribute FROM ({ATTRIBUTES_SQL}) UNION SELECT a.alias FROM (SELECT unnest({_ALIASES}) AS a)", 90)},
        known AS (SELECT a.field, a.alias FROM (SELECT unnest({_ALIASES}) AS a))
        SELECT k.field, b AS key, score,
               replace(replace(lower(b), '_', ''), '-', '') = replace(replace(lower(k.alias), '_', ''), '-', '')
                 AS same_normalized
        FROM alike JOIN known k ON k.alias = a
        WHERE b IN (SELECT attribute FROM ({ATTRIBUTES_SQL}))
          AND NOT EXISTS (FROM known o WHERE o.field = k.field AND o.alias = b)""",
)
def mapping_suggestions(spark, sf_dir):
    return R.mapping_suggestions(_names(spark, sf_dir))
