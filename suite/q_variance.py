"""Schema variance."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import variance as X
from fathom.plans.analyse import analyse
from fathom.session import shared_dir
from suite import views as V
from suite.registry import query


def rows(spark, sf_dir):
    return V.idx(spark, sf_dir).select(
        "key", "facility", F.col("variable_schema").alias("variables")
    )


#: Names with one kind of quote, the other, both, a backslash, and a list's own marks.
ODD_NAMES = ("it's", 'say "x"', "both ' and \"", "back\\slash", "a', 'b", "[,]")
_ODD_SQL = ", ".join("'" + name.replace("'", "''") + "'" for name in ODD_NAMES)


@query(
    "normalized_schema",
    rf"""SELECT key, '[' || array_to_string(list_transform(
                  list_sort(CASE WHEN len(names) % 2 = 0 THEN list_concat(names, [{_ODD_SQL}]) ELSE names END),
                  lambda n: CASE WHEN contains(n, '''') AND NOT contains(n, '"')
                            THEN '"' || replace(n, '\', '\\') || '"'
                            ELSE '''' || replace(replace(n, '\', '\\'), '''', '\''') || '''' END), ', ')
                || ']' AS schema
        FROM variance_rows""",
)
def normalized_schema(spark, sf_dir):
    """From list text in file order, as older tables hold it; every other file has odd names too."""
    listed = rows(spark, sf_dir).filter(F.col("variables").isNotNull())
    names = F.reverse(F.map_keys("variables"))
    odd = F.array(*[F.lit(name) for name in ODD_NAMES])
    names = F.when(F.size(names) % 2 == 0, F.concat(names, odd)).otherwise(names)
    listed = listed.withColumn("variables", X.schema_text(names))
    return X.with_schema(listed).select("key", "schema")


@query("schema_counts", "SELECT schema, count(*) AS n_files FROM variance_rows GROUP BY schema")
def schema_counts(spark, sf_dir):
    return X.schema_counts(rows(spark, sf_dir)).select("schema", "n_files")


PREFIXED = "(SELECT schema, regexp_replace(key, '/[^/]*$', '/') AS prefix FROM variance_rows)"


@query(
    "schema_prefixes",
    f"SELECT schema, prefix, count(*) AS n_files FROM {PREFIXED} GROUP BY ALL",
)
def schema_prefixes(spark, sf_dir):
    return X.schema_prefixes(rows(spark, sf_dir))


@query(
    "prefix_counts",
    f"""SELECT schema, count(*) AS n_files, count(DISTINCT prefix) AS n_prefixes
        FROM {PREFIXED} GROUP BY schema""",
)
def prefix_counts(spark, sf_dir):
    return X.prefix_counts(rows(spark, sf_dir))


@query("all_variables", "SELECT DISTINCT unnest(names) AS variable FROM variance_rows")
def all_variables(spark, sf_dir):
    return X.all_variables(rows(spark, sf_dir))


@query(
    "unique_variables",
    """SELECT any_value(schema) AS schema, variable
       FROM (SELECT DISTINCT schema, unnest(names) AS variable FROM wide) GROUP BY variable
       HAVING count(*) = 1""".replace(
        "wide",
        """(SELECT list_sort(CASE WHEN facility = 'SOOP' AND len(names) = 5
                                  THEN list_append(names, 'ONLY') ELSE names END) AS names,
                   array_to_string(list_sort(CASE WHEN facility = 'SOOP' AND len(names) = 5
                                  THEN list_append(names, 'ONLY') ELSE names END), '|') AS schema
            FROM variance_rows)""",
    ),
)
def unique_variables(spark, sf_dir):
    """One facility's fullest schema has a variable of its own."""
    names = F.map_keys("variables")
    own = (F.col("facility") == "SOOP") & (F.size(names) == 5)
    wide = rows(spark, sf_dir).withColumn(
        "variables", F.when(own, F.array_append(names, "ONLY")).otherwise(names)
    )
    found = X.unique_variables(wide)
    plain = F.regexp_replace(F.regexp_replace("schema", "', '", "|"), r"^\['|'\]$", "")
    return found.select(plain.alias("schema"), "variable")


# Variables by the number of schemas that have them; how schemas depart from what most have.
SPREAD_SQL = """
    schemas AS (SELECT DISTINCT schema, names FROM variance_rows),
    spread AS (SELECT v AS variable, count(*) AS n_schemas,
                      2 * count(*) > (SELECT count(*) FROM schemas) AS in_core
               FROM (SELECT unnest(list_distinct(names)) AS v FROM schemas) GROUP BY v),
    departures AS (
      SELECT schema, variable, CASE WHEN in_core THEN 'lacks' ELSE 'adds' END AS departs
      FROM schemas, spread WHERE list_contains(names, variable) <> in_core)"""


@query("missing_variables", f"WITH {SPREAD_SQL} SELECT schema, variable, departs FROM departures")
def missing_variables(spark, sf_dir):
    """What schemas lack, coded by the difference to the variables of most schemas."""
    return X.variable_departures(rows(spark, sf_dir))


@query("variable_spread", f"WITH {SPREAD_SQL} SELECT variable, n_schemas, in_core FROM spread")
def variable_spread(spark, sf_dir):
    return X.variable_spread(rows(spark, sf_dir))


@query(
    "missing_of_top_schemas",
    f"""WITH {SPREAD_SQL},
        top AS (SELECT schema FROM variance_rows GROUP BY schema ORDER BY count(*) DESC, schema LIMIT 10)
        SELECT schema, variable FROM schemas JOIN top USING (schema), spread WHERE NOT list_contains(names, variable)""",
)
def missing_of_top_schemas(spark, sf_dir):
    """In full for the most frequent schemas."""
    files = rows(spark, sf_dir)
    wanted = [r.schema for r in X.top_schemas(files).select("schema").collect()]
    return X.missing_variables(files, wanted)


@query(
    "variance_summary",
    """SELECT (SELECT count(DISTINCT schema) FROM variance_rows) AS total_schemas,
              (SELECT count(*) FROM idx) AS total_records,
              (SELECT count(DISTINCT v) FROM (SELECT unnest(names) AS v FROM variance_rows))
                AS total_variables""",
)
def variance_summary(spark, sf_dir):
    return X.variance_summary(rows(spark, sf_dir))


@query(
    "top_schemas",
    f"""SELECT n_files, n_prefixes, schema
        FROM (SELECT schema, count(*) AS n_files, count(DISTINCT prefix) AS n_prefixes
              FROM {PREFIXED} GROUP BY schema ORDER BY n_files DESC, schema LIMIT 10)""",
)
def top_schemas(spark, sf_dir):
    return X.top_schemas(rows(spark, sf_dir))


@query(
    "schemas_by_facility",
    "SELECT facility, schema, count(*) AS n_files FROM variance_rows GROUP BY ALL",
)
def schemas_by_facility(spark, sf_dir):
    return X.schemas_by(rows(spark, sf_dir), "facility")


@query(
    "variable_contains",
    """SELECT key, list_contains(names, 'TEMP') AS exact
       FROM variance_rows WHERE len(list_filter(names, lambda v: v LIKE '%EM%')) > 0""",
)
def variable_contains(spark, sf_dir):
    part = X.variable_contains(rows(spark, sf_dir), "EM", part=True)
    exact = X.variable_contains(rows(spark, sf_dir), "TEMP").select("key")
    return part.join(exact.withColumn("exact", F.lit(True)), "key", "left").select(
        "key", F.coalesce("exact", F.lit(False)).alias("exact")
    )


_BAR = "repeat('=', 80)"


@query(
    "variance_report",
    f"""WITH {SPREAD_SQL},
        ranked AS (
          SELECT schema, any_value(names) AS names, count(*) AS n,
                 row_number() OVER (ORDER BY count(*) DESC, schema) AS rank
          FROM variance_rows GROUP BY schema),
        places AS (SELECT DISTINCT schema, prefix FROM {PREFIXED}),
        lacking AS (
          SELECT rank, (SELECT count(*) FROM spread) - len(list_distinct(names)) AS n_missing,
                 (SELECT count(*) FROM departures d WHERE d.schema = r.schema AND departs = 'lacks') AS n_lacks
          FROM ranked r),
        lone AS (SELECT schema, variable FROM schemas, spread WHERE n_schemas = 1 AND list_contains(names, variable))
        SELECT text FROM (
          SELECT unnest(['Schema variance', {_BAR}, 'Query Prefix: IMOS/%',
            'Total Records: ' || (SELECT count(*) FROM idx),
            'Total Distinct Schemas: ' || (SELECT count(*) FROM ranked),
            'Total Unique Variables: ' || (SELECT count(*) FROM spread),
            {_BAR}, 'All Variables Found', {_BAR},
            {_BAR}, 'Variables of Most Schemas (' || (SELECT count(*) FROM spread WHERE in_core) || ')', {_BAR},
            {_BAR}, 'Schema Variance Details', {_BAR}]) AS text
          UNION ALL SELECT '  - ' || variable FROM spread
          UNION ALL SELECT '  - ' || variable || ': ' || n_schemas FROM spread WHERE in_core
          UNION ALL SELECT 'Schema #' || rank FROM ranked
          UNION ALL SELECT '  Variables (' || len(names) || '): ' || schema FROM ranked
          UNION ALL SELECT '  Record Count: ' || n FROM ranked
          UNION ALL SELECT '  Variables Unique to This Schema:' FROM (SELECT DISTINCT schema FROM lone)
          UNION ALL SELECT '    + ' || variable FROM lone
          UNION ALL SELECT '  Variables Missing from This Schema (' || n_missing || '):' FROM lacking WHERE n_missing > 0
          UNION ALL SELECT '    - ' || variable FROM departures WHERE departs = 'lacks'
          UNION ALL SELECT '    and ' || (n_missing - n_lacks) || ' that most schemas lack'
            FROM lacking WHERE n_missing > n_lacks
          UNION ALL SELECT '  Associated Prefixes (' || count(*) || '):' FROM places GROUP BY schema
          UNION ALL SELECT '    - ' || prefix FROM places)""",
)
def variance_report(spark, sf_dir):
    path = shared_dir(spark)
    X.write_report(X.variance_report(rows(spark, sf_dir), prefix="IMOS/%"), path)
    return spark.read.text(path).select(F.col("value").alias("text"))


@query(
    "analyse_job",
    """SELECT (SELECT count(DISTINCT schema) FROM variance_rows WHERE key LIKE 'IMOS/ANMN/%') AS total_schemas,
              (SELECT count(*) FROM idx WHERE key LIKE 'IMOS/ANMN/%') AS total_records,
              (SELECT count(DISTINCT v) FROM (SELECT unnest(names) AS v FROM variance_rows WHERE key LIKE 'IMOS/ANMN/%'))
                AS total_variables""",
)
def analyse_job(spark, sf_dir):
    """The whole job over a key pattern, its report written; its summary."""
    summary, _, _ = analyse(V.idx(spark, sf_dir), "IMOS/ANMN/%", output=shared_dir(spark))
    return summary
