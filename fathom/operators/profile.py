"""Corpus profiling: totals, sizes per group, size bins, descriptions, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.operators.ranking import quantiles

# Size bins in MB, number of equal-probability bins, facility sample bound.
SIZE_BREAKS_MB = (1, 10, 50, 100, 500, 1000, 5000)
QUANTILE_BINS = 50
# End of fixed values.

_MB, _GB, _TB = 1024**2, 1024**3, 1024**4


def _wide_sum(column: str) -> Column:
    """Sum that cannot overflow."""
    return F.sum(F.col(column).cast("decimal(38,0)"))


def corpus_totals(inventory: DataFrame, suffix: str = ".nc") -> DataFrame:
    """Files, files with the suffix, bytes, and TB to two places."""
    total = _wide_sum("size")
    return inventory.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("key").endswith(suffix)).alias("n_suffix"),
        total.alias("total_bytes"),
        F.round(total.cast("double") / _TB, 2).alias("total_tb"),
    )


def collection_sizes(inventory: DataFrame, group: str = "facility") -> DataFrame:
    """Per group: bytes in three units, files, and average MB per file; empty groups left out."""
    size = F.col("size_bytes").cast("double")
    return (
        inventory.groupBy(group)
        .agg(_wide_sum("size").alias("size_bytes"), F.count(F.lit(1)).alias("n_files"))
        .filter(F.col("size_bytes") != 0)
        .select(
            group,
            "size_bytes",
            (size / _MB).alias("size_mb"),
            (size / _GB).alias("size_gb"),
            (size / _TB).alias("size_tb"),
            "n_files",
            (size / _MB / F.col("n_files")).alias("average_mb"),
        )
    )


def _bin_of(value: Column, breaks: Sequence[float], left_closed: bool) -> Column:
    """How many breaks lie at or below (left-closed) or below (right-closed) the value."""
    passed = F.lit(0)
    for b in breaks:
        edge = F.lit(float(b))
        passed = passed + ((value >= edge) if left_closed else (value > edge)).cast("int")
    return passed


def quantile_bins(
    inventory: DataFrame, group: str = "facility", bins: int = QUANTILE_BINS
) -> DataFrame:
    """Files per group and equal-probability size bin; bins are right-closed.

    The breaks are exact (``ranking.quantiles``), repeated breaks count once, and at most
    ``bins - 1`` numbers come to the driver.
    """
    sized = inventory.filter(F.col("size") > 0).withColumn("size_kb", F.col("size") / 1024)
    probs = [i / bins for i in range(1, bins)]
    everything = sized.select(F.lit(0).alias("all"), "size_kb")
    found = quantiles(everything, ["all"], "size_kb", probs).collect()
    breaks = sorted({r["quantile"] for r in found})
    size_bin = _bin_of(F.col("size_kb"), breaks, left_closed=False)
    counted = sized.groupBy(group, size_bin.alias("size_bin"))
    return counted.agg(F.count(F.lit(1)).alias("n_files")).orderBy("size_bin", group)


def fixed_bins(
    inventory: DataFrame, group: str = "facility", breaks_mb: Sequence[float] = SIZE_BREAKS_MB
) -> DataFrame:
    """Files per group and fixed size bin; bins are left-closed."""
    sized = inventory.filter(F.col("size") > 0)
    size_bin = _bin_of(F.col("size") / _MB, breaks_mb, left_closed=True)
    edges = ["-inf", *[str(b) for b in breaks_mb], "inf"]
    labels = F.array(*[F.lit(f"[{a}, {b})") for a, b in zip(edges, edges[1:])])
    return (
        sized.groupBy(group, size_bin.alias("size_bin"))
        .agg(F.count(F.lit(1)).alias("n_files"))
        .withColumn("label", F.get(labels, F.col("size_bin")))
        .orderBy("size_bin", group)
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), column)


def describe_by_group(
    df: DataFrame, group: str, value: str, method: str = "nearest"
) -> DataFrame:
    """Count, nulls, mean, deviation, extremes and exact quartiles of a column per group."""
    basics = df.groupBy(group).agg(
        F.count(value).alias("n"),
        F.count_if(F.col(value).isNull()).alias("n_null"),
        F.avg(value).alias("mean"),
        F.stddev(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    marks = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    parts = quantiles(df, [group], value, list(marks), method).groupBy(
        F.col(group).alias("_group")
    )
    wide = parts.agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in marks.items()]
    )
    same = F.col(group).eqNullSafe(F.col("_group"))
    return basics.join(wide, same, "left").drop("_group")


def field_coverage(df: DataFrame, fields: Sequence[str], group: str = "facility") -> DataFrame:
    """Percentage of rows that have each field, in all and per group, as long rows.

    One pass with grouping sets; ``scope`` tells the overall rows from those of a null group.
    """
    wide = (
        df.select(group, *[F.col(f).isNotNull().alias(f"_has_{f}") for f in fields])
        .groupingSets([[], [group]], group)
        .agg(
            F.grouping(group).alias("_all"),
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(F.col(f"_has_{f}")).alias(f) for f in fields],
        )
    )
    cells = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).alias("n_present")) for f in fields]
    )
    scope = F.when(F.col("_all") == 1, "global").otherwise("facility")
    return wide.select(scope.alias("scope"), group, "n_rows", F.inline(cells)).withColumn(
        "coverage_pct", F.col("n_present") * 100.0 / F.col("n_rows")
    )


def facility_success(
    inventory: DataFrame, indexed: DataFrame, per_facility: int, identity: str = "uri"
) -> DataFrame:
    """Distinct indexed objects per facility against the number that was sampled."""
    asked = inventory.groupBy("facility").agg(F.count(F.lit(1)).alias("n_inventory"))
    got = indexed.groupBy("facility").agg(F.count_distinct(identity).alias("n_indexed"))
    base = F.least(F.col("n_inventory"), F.lit(per_facility).cast("bigint"))
    done = F.coalesce("n_indexed", F.lit(0).cast("bigint"))
    return asked.join(got, "facility", "left").select(
        "facility",
        "n_inventory",
        base.alias("n_sampled"),
        done.alias("n_indexed"),
        (done * 100.0 / base).alias("success_pct"),
    )
