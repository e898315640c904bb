"""Schema variance: which sets of variables occur, where, and how they differ.

Everything after the first count runs on distinct schemas, not on files. Lists that grow
with the corpus (directories of a schema, the vocabulary) stay rows; lists that are bounded by
one schema are arrays.

What schemas lack is coded by its difference to a common core, the variables that more than half
of the schemas have: a schema's rows are the core variables it lacks and the others it has. The
core is at most twice as long as the mean schema, and there are never more rows than variables
in all schemas together, whatever the number of schemas and of names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.functions.identity import dir_prefix
from fathom.operators.ranking import with_position
from fathom.session import materialize

# How many schemas the overview shows, and the report's heads.
TOP_SCHEMAS = 10
ALL_HEAD = "All Variables Found"
DETAILS_HEAD = "Schema Variance Details"
UNIQUE_HEAD = "  Variables Unique to This Schema:"
MISSING_HEAD = "  Variables Missing from This Schema"
PREFIXES_HEAD = "  Associated Prefixes"
# End of fixed values.

_ITEM = r"""'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+\""""
_TOKEN = r"\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|(?s:\\.)|[^\\]+"
_ESCAPES = (("n", "\n"), ("r", "\r"), ("t", "\t"), ("a", "\a"), ("b", "\b"), ("f", "\f"), ("v", "\v"), ("0", "\0"))


def variable_list(df: DataFrame, column: str = "variables") -> Column:
    """Sorted variable names of an array, a map, or the text form of a list.

    List text is read as Python writes lists of text, with either quote and its escapes; it is
    never evaluated. Text that is no such list is null, see ``unreadable_lists``.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.MapType):
        names = F.map_keys(column)
    elif isinstance(kind, T.StringType):
        names = read_list(F.col(column))
    else:
        names = F.col(column)
    return F.sort_array(names)


def _character(token: Column) -> Column:
    """What a token of a quoted text stands for: itself, or the character of an escape."""
    code = F.lpad(F.substring(token, F.lit(3), F.length(token)), 8, "0")
    out = F.when(F.left(token, F.lit(1)) != "\\", token)
    for name, character in _ESCAPES:
        out = out.when(token == "\\" + name, character)
    out = out.when(token.rlike(r"^\\[xuU]"), F.decode(F.unhex(code), "UTF-32"))
    return out.otherwise(F.substring(token, F.lit(2), F.length(token)))


def read_list(text: Column) -> Column:
    """Items of a Python list of texts; null for anything else."""
    items = F.regexp_extract_all(text, F.lit(_ITEM), F.lit(0))
    read = F.transform(
        items,
        lambda i: F.array_join(
            F.transform(
                F.regexp_extract_all(F.substring(i, F.lit(2), F.length(i) - 2), F.lit(_TOKEN), F.lit(0)), _character
            ),
            "",
        ),
    )
    return F.when(text.rlike(rf"^\s*\[\s*(?:(?:{_ITEM})\s*(?:,\s*(?:{_ITEM})\s*)*+,?\s*)?\]\s*$"), read)


def unreadable_lists(df: DataFrame, column: str = "variables") -> DataFrame:
    """Rows whose list text cannot be read: they have no schema, and are none the less files."""
    return df.filter(F.col(column).isNotNull() & variable_list(df, column).isNull())


def _quoted(name: Column) -> Column:
    """``name`` as Python writes it: double quotes only if it holds single ones alone."""
    double = F.contains(name, F.lit("'")) & ~F.contains(name, F.lit('"'))
    body = F.replace(name, F.lit("\\"), F.lit("\\\\"))
    for character, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(character), F.lit(escape))
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(single)


def schema_text(names: Column) -> Column:
    """List text of sorted names: the schema's key, free of the order in the file.

    Different lists have different texts, whatever quotes the names hold.
    """
    return F.concat(F.lit("["), F.array_join(F.transform(names, _quoted), ", "), F.lit("]"))


def with_schema(df: DataFrame, column: str = "variables") -> DataFrame:
    """Rows that have variables, with ``names`` and ``schema``."""
    return (
        df.withColumn("names", variable_list(df, column))
        .filter(F.col("names").isNotNull())
        .withColumn("schema", schema_text(F.col("names")))
    )


def schema_counts(df: DataFrame, column: str = "variables") -> DataFrame:
    """Files per schema with its variables; most frequent first."""
    counted = with_schema(df, column).groupBy("schema", "names").agg(
        F.count(F.lit(1)).alias("n_files")
    )
    return counted.orderBy(F.desc("n_files"), "schema")


def schema_prefixes(df: DataFrame, column: str = "variables") -> DataFrame:
    """One row per schema and directory, in order, with the file count."""
    rows = with_schema(df, column).withColumn("prefix", dir_prefix(F.col("key")))
    counted = rows.groupBy("schema", "prefix").agg(F.count(F.lit(1)).alias("n_files"))
    return counted.orderBy("schema", "prefix")


def prefix_counts(df: DataFrame, column: str = "variables") -> DataFrame:
    """Per schema: files and distinct directories."""
    return (
        schema_prefixes(df, column)
        .groupBy("schema")
        .agg(F.sum("n_files").alias("n_files"), F.count(F.lit(1)).alias("n_prefixes"))
    )


def _distinct(df: DataFrame, column: str) -> DataFrame:
    return with_schema(df, column).select("schema", "names").distinct()


def _variables(schemas: DataFrame) -> DataFrame:
    return schemas.select("schema", F.explode(F.array_distinct("names")).alias("variable"))


def _vocabulary(schemas: DataFrame) -> DataFrame:
    return _variables(schemas).select("variable").distinct()


def _unique(schemas: DataFrame) -> DataFrame:
    return (
        _variables(schemas)
        .groupBy("variable")
        .agg(F.count(F.lit(1)).alias("n"), F.min("schema").alias("schema"))
        .filter(F.col("n") == 1)
        .select("schema", "variable")
    )


def _spread(schemas: DataFrame) -> DataFrame:
    """``variable, n_schemas, in_core``: in how many schemas each variable is, and if in most."""
    total = schemas.agg(F.count(F.lit(1))).scalar()
    counted = _variables(schemas).groupBy("variable").agg(F.count(F.lit(1)).alias("n_schemas"))
    return counted.withColumn("in_core", 2 * F.col("n_schemas") > total)


def _departures(schemas: DataFrame, spread: DataFrame) -> DataFrame:
    """``schema, variable, departs``: core variables a schema ``lacks``, others that it ``adds``."""
    core = spread.filter("in_core").agg(F.sort_array(F.collect_list("variable"))).scalar()
    lacks = schemas.select("schema", F.explode(F.array_except(core, "names")).alias("variable"), F.lit("lacks").alias("departs"))
    others = spread.filter("NOT in_core").select("variable")
    adds = _variables(schemas).join(others, "variable").select("schema", "variable", F.lit("adds").alias("departs"))
    return lacks.unionByName(adds)


def all_variables(df: DataFrame, column: str = "variables") -> DataFrame:
    """Every variable name of any schema, in order."""
    return _vocabulary(_distinct(df, column)).orderBy("variable")


def unique_variables(df: DataFrame, column: str = "variables") -> DataFrame:
    """Variables that occur in one schema only, with that schema."""
    return _unique(_distinct(df, column))


def variable_spread(df: DataFrame, column: str = "variables") -> DataFrame:
    """Each variable with the number of schemas that have it, and whether most do (the core)."""
    return _spread(materialize(_distinct(df, column)))


def variable_departures(df: DataFrame, column: str = "variables") -> DataFrame:
    """Per schema how it departs from the core: rows ``(schema, variable, departs)``.

    With ``variable_spread`` this tells all that any schema lacks: the core variables it
    ``lacks``, and of those outside the core all but the ones it ``adds``.
    """
    schemas = materialize(_distinct(df, column))
    return _departures(schemas, materialize(_spread(schemas)))


def missing_variables(df: DataFrame, wanted: Sequence[str], column: str = "variables") -> DataFrame:
    """``schema, variable``: all that the ``wanted`` schemas (a short list of texts) lack."""
    schemas = materialize(_distinct(df, column))
    spread = materialize(_spread(schemas))
    chosen = schemas.filter(F.col("schema").isin(*wanted))
    departs = _departures(chosen, spread)
    lacks = departs.filter("departs = 'lacks'").select("schema", "variable")
    adds = departs.filter("departs = 'adds'").select("schema", "variable")
    known = F.array_sort(F.collect_set("schema"))
    others = spread.filter("NOT in_core").select(F.explode(chosen.agg(known).scalar()).alias("schema"), "variable")
    return lacks.unionByName(others.join(adds, ["schema", "variable"], "left_anti"))


def variance_summary(df: DataFrame, column: str = "variables") -> DataFrame:
    """Schemas, files (also those without variables) and variable names in total.

    One pass over the files: rows without variables are counted under a null schema.
    """
    names = variable_list(df, column)
    counted = (
        df.select(names.alias("names"))
        .groupBy("names")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )
    total = counted.agg(
        F.count("names").alias("total_schemas"),
        F.coalesce(F.sum("n_files"), F.lit(0)).alias("total_records"),
    )
    schemas = counted.filter(F.col("names").isNotNull()).withColumn("schema", schema_text(F.col("names")))
    vocabulary = _vocabulary(schemas).agg(F.count(F.lit(1))).scalar()
    return total.withColumn("total_variables", vocabulary)


def top_schemas(df: DataFrame, column: str = "variables", n: int = TOP_SCHEMAS) -> DataFrame:
    """The most frequent schemas, with their whole text."""
    return (
        prefix_counts(df, column)
        .orderBy(F.desc("n_files"), "schema")
        .limit(n)
        .select("n_files", "n_prefixes", "schema")
    )


def schemas_by(df: DataFrame, group: str, column: str = "variables") -> DataFrame:
    """Files per group and schema."""
    return with_schema(df, column).groupBy(group, "schema").agg(
        F.count(F.lit(1)).alias("n_files")
    )


def variable_contains(
    df: DataFrame, name: str, column: str = "variables", part: bool = False
) -> DataFrame:
    """Files that have the variable, or one whose name contains the text."""
    kind = df.schema[column].dataType
    names = F.map_keys(column) if isinstance(kind, T.MapType) else F.col(column)
    if part:
        return df.filter(F.exists(names, lambda v: v.contains(name)))
    return df.filter(F.array_contains(names, name))


def variance_report(
    df: DataFrame, column: str = "variables", prefix: str | None = None
) -> DataFrame:
    """The report as ordered lines ``(block, line, item, text)``.

    Block 0 is the head, then come all variables, those of the common core, and from block 4 on
    the schemas by frequency. What a schema lacks is listed as far as most schemas have it; of
    the rest the number is given. Every line is a row, so a schema with very many directories is
    not one long text. The run's time is left out; ``write_report`` puts it in front.
    """
    bar = "=" * 80
    # Files are read once; the report is made from their counts per schema and directory.
    places = materialize(
        df.withColumn("names", variable_list(df, column))
        .withColumn("schema", F.when(F.col("names").isNotNull(), schema_text(F.col("names"))))
        .groupBy("schema", "names", dir_prefix(F.col("key")).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n_files"))
    )
    known = places.filter(F.col("schema").isNotNull())
    counts = materialize(
        known.groupBy("schema", "names").agg(F.sum("n_files").alias("n_files"), F.count(F.lit(1)).alias("n_prefixes"))
    )
    ranked = materialize(_ranked(counts))
    spread = materialize(_spread(counts))
    departs = materialize(_departures(counts, spread))
    n_variables = spread.agg(F.count(F.lit(1))).scalar()
    n_core = spread.agg(F.count_if("in_core")).scalar()
    summary = counts.agg(F.count(F.lit(1)).alias("total_schemas")).select(
        "total_schemas",
        F.coalesce(places.agg(F.sum("n_files")).scalar(), F.lit(0)).alias("total_records"),
        n_variables.alias("total_variables"), n_core.alias("total_core"),
    )

    def lines(source: DataFrame, block: Column, line: int, item: Column, *text: Column | str):
        parts = [F.lit(t) if isinstance(t, str) else t.cast("string") for t in text]
        return source.select(
            block.cast("bigint").alias("block"), F.lit(line).alias("line"), item.cast("string").alias("item"),
            F.concat(*parts).alias("text"),
        )

    def heads(block: int, *text: Column | str):
        parts = F.array(*[F.lit(t) if isinstance(t, str) else t for t in text])
        return summary.select(F.lit(block).cast("bigint").alias("block"), F.posexplode(parts).alias("line", "text")).select(
            "block", "line", F.lit("").alias("item"), "text"
        )

    def total(name: str) -> Column:
        return F.col(f"total_{name}").cast("string")

    none = F.lit("")
    block = F.col("rank") + 3
    variable = F.col("variable")
    rank_of = ranked.select("schema", "rank")
    unique = materialize(_unique(counts).join(rank_of, "schema"))
    lacks = departs.filter("departs = 'lacks'").join(rank_of, "schema")
    n_lacks = departs.groupBy("schema").agg(F.count_if(F.col("departs") == "lacks").alias("n_lacks"))
    lacking = ranked.join(n_lacks, "schema", "left").withColumn(
        "n_missing", n_variables - F.size(F.array_distinct("names"))
    ).withColumn("n_other", F.col("n_missing") - F.coalesce("n_lacks", F.lit(0)))
    report = heads(
        0, "Schema variance", bar, f"Query Prefix: {prefix or 'All data'}",
        F.concat(F.lit("Total Records: "), total("records")), F.concat(F.lit("Total Distinct Schemas: "), total("schemas")),
        F.concat(F.lit("Total Unique Variables: "), total("variables")),
    )
    parts = (
        heads(1, bar, ALL_HEAD, bar),
        lines(spread, F.lit(1), 3, variable, "  - ", variable),
        heads(2, bar, F.concat(F.lit("Variables of Most Schemas ("), total("core"), F.lit(")")), bar),
        lines(spread.filter("in_core"), F.lit(2), 3, variable, "  - ", variable, ": ", F.col("n_schemas")),
        heads(3, bar, DETAILS_HEAD, bar),
        lines(ranked, block, 0, none, "Schema #", F.col("rank")),
        lines(ranked, block, 1, none, "  Variables (", F.size("names"), "): ", F.col("schema")),
        lines(ranked, block, 2, none, "  Record Count: ", F.col("n_files")),
        lines(unique.select("rank").distinct(), block, 3, none, UNIQUE_HEAD),
        lines(unique, block, 4, variable, "    + ", variable),
        lines(lacking.filter("n_missing > 0"), block, 5, none, MISSING_HEAD, " (", F.col("n_missing"), "):"),
        lines(lacks, block, 6, variable, "    - ", variable),
        lines(lacking.filter("n_other > 0"), block, 7, none, "    and ", F.col("n_other"), " that most schemas lack"),
        lines(ranked, block, 8, none, PREFIXES_HEAD, " (", F.col("n_prefixes"), "):"),
        lines(known.select("schema", "prefix").join(rank_of, "schema"), block, 9, F.col("prefix"), "    - ", F.col("prefix")),
    )
    for part in parts:
        report = report.unionByName(part)
    return report.orderBy("block", "line", "item")


def _ranked(counts: DataFrame) -> DataFrame:
    order = [F.desc("n_files"), F.col("schema")]
    return with_position(counts, order, "rank").withColumn("rank", F.col("rank") + 1)


def write_report(report: DataFrame, path: str) -> None:
    """Report lines as text files in order."""
    report.orderBy("block", "line", "item").select("text").write.text(path)
