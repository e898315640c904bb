"""Views and summaries over the index: prefixes, moorings files and their products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.identity import object_uri

# The moorings folder, the patterns of its columns, what counts as source data.
MOORINGS = "IMOS/ANMN/"
CATEGORY_PATTERN = (
    "Temperature|(CTD|Biogeochem)_(timeseries|profiles)|Velocity|Wave|CO2|Meteorology"
    "|aggregated_products|(aggregated|hourly|gridded)_timeseries"
)
LEVEL_PATTERN = "Level ([0-4])"
REALTIME_PATTERN = "real[-_]?time"
PRODUCT_CATEGORY = "hourly_timeseries"
NOT_SOURCE = ("CTD_profiles", "Biogeochem_profiles", "aggregated_timeseries", "CO2")
SOURCE_LEVEL = 1
SOURCE_VARIABLES = ("TEMP", "PSAL", "UCUR")
# End of fixed values.


def index_rows(structured: DataFrame) -> DataFrame:
    """Index rows with the columns the queries use: URI, variable names and time range."""
    return structured.select(
        "*",
        object_uri(F.col("bucket"), F.col("key")).alias("s3_uri"),
        F.col("time_coverage_start").alias("time_min"),
        F.col("time_coverage_end").alias("time_max"),
        F.sort_array(F.map_keys("variable_schema")).alias("variables"),
    )


def index_ordered(structured: DataFrame) -> DataFrame:
    return index_rows(structured).orderBy("s3_uri")


def prefix_summary(structured: DataFrame) -> DataFrame:
    """Per leading two folders: files and distinct codes.

    Four distinct counts on one key let Spark expand each row four times; the expanded rows
    are reduced to distinct values before the shuffle.
    """
    prefix = F.regexp_extract("key", "^([^/]+/[^/]+)", 1)
    codes = {
        "n_sites": "site_code",
        "n_platforms": "platform_code",
        "n_deployments": "deployment_code",
        "n_instruments": "instrument",
    }
    return (
        structured.groupBy(prefix.alias("prefix"))
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            *[F.count_distinct(c).alias(n) for n, c in codes.items()],
        )
        .orderBy("prefix")
    )


def moorings(structured: DataFrame, root: str = MOORINGS) -> DataFrame:
    """Moorings files with sub-facility, category, processing level and real-time flag."""
    level = F.regexp_extract("file_version", LEVEL_PATTERN, 1).try_cast("int")
    below_root = F.substring("key", F.lit(len(root) + 1), F.length("key"))
    return (
        index_rows(structured)
        .filter(F.col("key").startswith(root))
        .withColumn("subfac", F.regexp_extract(below_root, "^([^/]+)", 1))
        .withColumn("data_category", F.regexp_extract("s3_uri", CATEGORY_PATTERN, 0))
        .withColumn("fv", level)
        .withColumn("is_realtime", F.col("s3_uri").rlike(f"(?i){REALTIME_PATTERN}"))
    )


def _level_counts(levels: Sequence[int] = (0, 1, 2)) -> list[Column]:
    return [F.count_if(F.col("fv") == n).alias(f"n_fv{n}") for n in levels]


def subfacility_summary(files: DataFrame) -> DataFrame:
    return (
        files.groupBy("subfac")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.count_distinct("site_code").alias("n_sites"),
            *_level_counts(),
            F.count_if("is_realtime").alias("n_realtime"),
        )
        .orderBy("subfac")
    )


def category_summary(files: DataFrame) -> DataFrame:
    return (
        files.groupBy("subfac", "data_category")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.count_distinct("site_code").alias("n_sites"),
            *_level_counts(),
        )
        .orderBy("subfac", "data_category")
    )


def hourly_products(files: DataFrame) -> DataFrame:
    return files.filter(F.col("data_category") == PRODUCT_CATEGORY).select(
        "subfac", "site_code", "time_min", "time_max", "variables", "key"
    )


def exploded_variables(files: DataFrame) -> DataFrame:
    """One row per source file and variable.

    The negated tests drop rows in which they are unknown, as SQL does.
    """
    source = files.filter(
        (F.col("fv") == SOURCE_LEVEL)
        & ~F.col("is_realtime")
        & ~F.col("data_category").isin(*NOT_SOURCE)
    )
    return source.select(
        "key", "site_code", F.explode("variables").alias("var"), "time_min", "time_max"
    )


def site_variable_ranges(
    exploded: DataFrame, variables: Sequence[str] = SOURCE_VARIABLES
) -> DataFrame:
    """Per site and variable of interest: files and time range."""
    return (
        exploded.filter(F.col("var").isin(*variables))
        .groupBy("site_code", "var")
        .agg(
            F.count_distinct("key").alias("n_files"),
            F.min("time_min").alias("time_min"),
            F.max("time_max").alias("time_max"),
        )
    )


def _day(text: Column) -> Column:
    return F.substring(text, 1, 10).try_cast("date")


def stale_products(ranges: DataFrame, products: DataFrame) -> DataFrame:
    """Products older than their source data, and sites' variables without any product.

    Products are exploded to their variables and met by an equi-join on site and variable;
    an inner join, so adaptive execution can split a hot site on either side. Source ranges
    without a partner come from an anti-join.
    """
    source = ranges.select(
        F.col("site_code").alias("v_site"), "var", _day(F.col("time_max")).alias("source_end")
    )
    offered = products.select(
        "site_code",
        _day(F.col("time_max")).alias("product_data_end"),
        F.col("key").alias("product_key"),
        F.explode(F.array_distinct("variables")).alias("h_var"),
    )
    same = (F.col("v_site") == F.col("site_code")) & (F.col("var") == F.col("h_var"))

    def per_product(rows: DataFrame) -> DataFrame:
        return rows.groupBy("v_site", "product_data_end", "product_key").agg(
            F.sort_array(F.collect_list("var")).alias("vars"),
            F.max("source_end").alias("source_data_end"),
        )

    older = per_product(source.join(offered, same)).filter(
        F.col("source_data_end") > F.col("product_data_end")
    )
    lone = source.join(offered, same, "left_anti").select(
        "*",
        F.lit(None).cast("date").alias("product_data_end"),
        F.lit(None).cast("string").alias("product_key"),
    )
    return (
        older.unionByName(per_product(lone))
        .select(
            F.col("v_site").alias("site_code"),
            "vars",
            "source_data_end",
            "product_data_end",
            "product_key",
        )
        .orderBy("site_code", "product_data_end", "product_key")
    )


def register_views(structured: DataFrame) -> None:
    """Temporary views for SQL users: the index, moorings files and hourly products."""
    index_rows(structured).createOrReplaceTempView("index_rows")
    files = moorings(structured)
    files.createOrReplaceTempView("moorings_files")
    hourly_products(files).createOrReplaceTempView("moorings_hourly_products")
