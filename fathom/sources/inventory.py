"""Inventory scans: what exists, what is new, and a per-facility sample."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fathom.functions.identity import derive_facility, object_hash
from fathom.operators.store import as_of
from fathom.schema import IDENTITY_FIELDS, OBJECT_REFERENCE
from fathom.session import materialize

# Default scan projection, indexed facilities, sample size per facility.
DEFAULT_FIELDS = ("bucket", "key", "version_id", "size", "sequence_number", "is_delete_marker")
INDEXED_PREFIXES = (
    "IMOS/SOOP/",
    "IMOS/AATAMS/",
    "IMOS/ANMN/",
    "IMOS/FAIMMS/",
    "IMOS/OceanCurrent/",
    "IMOS/DWM/",
    "IMOS/AUV/",
    "IMOS/COASTAL-WAVE-BUOYS/",
    "IMOS/NTP/",
    "IMOS/ANFOG/",
    "IMOS/eMII/",
)
SUBSET_PER_FACILITY = 10_000
# End of fixed values.


@dataclass(frozen=True)
class Scan:
    """Options of one table scan; every one of them is optional."""

    row_filter: str | Column | None = None
    fields: Sequence[str] | None = None
    limit: int | None = None
    snapshot: int | None = None
    drop_delete_markers: bool = False

    def apply(self, table: DataFrame) -> DataFrame:
        """Filter first, so that the predicate may use columns the projection leaves out."""
        df = as_of(table, self.snapshot) if self.snapshot is not None else table
        if self.row_filter is not None:
            predicate = self.row_filter
            df = df.filter(F.expr(predicate) if isinstance(predicate, str) else predicate)
        if self.drop_delete_markers and "is_delete_marker" in df.columns:
            df = df.filter(~F.coalesce("is_delete_marker", F.lit(False)))
        if self.fields is not None:
            df = df.select(*self.fields)
        return df if self.limit is None else df.limit(self.limit)


def scan_parquet(spark: SparkSession, path: str, scan: Scan = Scan()) -> DataFrame:
    """Scan a Parquet folder. Filter and columns reach the files."""
    return scan.apply(spark.read.parquet(path))


def scan_table(spark: SparkSession, name: str, scan: Scan = Scan()) -> DataFrame:
    """Scan a table of the session's catalogue."""
    return scan.apply(spark.table(name))


def case_sensitive(spark: SparkSession, on: bool = True) -> None:
    """Whether column names in filters and projections are matched by case."""
    spark.conf.set("spark.sql.caseSensitive", str(on).lower())


def empty_inventory(spark: SparkSession, schema: T.StructType = OBJECT_REFERENCE) -> DataFrame:
    return spark.createDataFrame([], schema)


def starts_with_any(key: Column, prefixes: Sequence[str] = INDEXED_PREFIXES) -> Column:
    """Any of the prefixes; reaches the files as a disjunction of prefix tests."""
    return reduce(lambda a, b: a | b, (key.startswith(p) for p in prefixes))


def key_like(pattern: str | None = None, row_filter: str | None = None) -> Column:
    """Key pattern and an optional extra predicate, both of which must hold."""
    tests = [F.col("key").like(pattern)] if pattern else []
    tests += [F.expr(row_filter)] if row_filter else []
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def list_prefix(inventory: DataFrame, prefix: str, bucket: str | None = None) -> DataFrame:
    """Objects below a key prefix."""
    df = inventory.filter(F.col("key").startswith(prefix))
    return df if bucket is None else df.filter(F.col("bucket") == bucket)


def lookback_start(
    now: dt.datetime, days: int = 0, hours: int = 0, floor: str = "hour"
) -> dt.datetime:
    """Start of the lookback: ``now`` floored to the hour or the day, less the offset."""
    zero = {"minute": 0, "second": 0, "microsecond": 0}
    if floor == "day":
        zero["hour"] = 0
    return now.replace(tzinfo=None, **zero) - dt.timedelta(days=days, hours=hours)


def lookback(
    now: dt.datetime,
    days: int = 0,
    hours: int = 0,
    column: str = "last_modified_date",
    floor: str = "hour",
    existing: str | None = None,
) -> Column:
    """``column >= start``, joined by AND to an existing filter.

    The bound is a literal of the column's own kind (time without zone), so the test is
    pushed to the files and does not depend on the session's time zone.
    """
    start = lookback_start(now, days, hours, floor).strftime("%Y-%m-%dT%H:%M:%S")
    recent = F.col(column) >= F.lit(start).cast("timestamp_ntz")
    return recent if existing is None else F.expr(f"({existing})") & recent


def delta_inventory(
    source: DataFrame,
    sinks: Sequence[DataFrame],
    left_on: Sequence[str] = IDENTITY_FIELDS,
    right_on: Sequence[str] = IDENTITY_FIELDS,
) -> DataFrame:
    """Source rows found in none of the sinks.

    Rows with a null key match nothing and stay. The sinks are cut to their key columns;
    whether one is small enough to broadcast is left to the optimizer's size statistics.
    A sink's hot key is harmless: copies of a key do not multiply rows in an anti-join.
    """
    if not sinks:
        raise ValueError("a delta needs at least one sink")
    if len(left_on) != len(right_on):
        raise ValueError("left_on and right_on differ in length")
    names = [f"_sink_{i}" for i in range(len(right_on))]
    keys = reduce(
        DataFrame.unionAll,
        (s.select(*[F.col(c).alias(n) for c, n in zip(right_on, names)]) for s in sinks),
    )
    same = reduce(
        lambda a, b: a & b, (source[c] == keys[n] for c, n in zip(left_on, names))
    )
    return source.join(keys, same, "left_anti")


#: Buckets of a draw whose rows are counted per facility.
DRAW_BUCKETS = 4096


def facility_subset(
    inventory: DataFrame,
    per_facility: int = SUBSET_PER_FACILITY,
    seed: str = "0",
    buckets: int = DRAW_BUCKETS,
) -> DataFrame:
    """Seeded random sample of at most ``per_facility`` rows of each facility.

    Every row has a draw, and a facility's sample are its rows of least draw. How many rows fall
    into each of ``buckets`` equal ranges of draws is counted first, with at most that many
    numbers a facility in a task; it tells the range that holds the last row of the sample. Rows
    beyond it are left out by a filter, and only the rest is ranked: the sample and at most one
    range more, which is a facility's rows over ``buckets``.
    """
    if per_facility < 1:
        raise ValueError("per_facility must be at least 1")
    df = inventory
    if "facility" not in inventory.columns:
        df = df.withColumn("facility", derive_facility(F.col("key")))
    identity = object_hash(*[F.col(c) for c in IDENTITY_FIELDS])
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), identity), 256)
    # The draw's first 32 bits, cut into ranges in the order of the draws.
    head = F.conv(F.substring("_draw", 1, 8), 16, 10).cast("bigint")
    drawn = df.filter(F.col("facility").isNotNull()).withColumn("_draw", draw).withColumn(
        "_range", F.floor(head * buckets / F.lit(1 << 32)).cast("int")
    )
    counts = drawn.groupBy("facility", "_range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(
        Window.partitionBy("facility").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    needed = counts.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < per_facility)
    # A row a facility; its stored size decides whether it is broadcast.
    bounds = materialize(needed.groupBy(F.col("facility").alias("_of")).agg(F.max("_range").alias("_last")))
    within = drawn.join(bounds, (F.col("facility") == F.col("_of")) & (F.col("_range") <= F.col("_last")))
    rank = F.row_number().over(Window.partitionBy("facility").orderBy("_draw", "size"))
    ranked = within.withColumn("_rank", rank).filter(F.col("_rank") <= per_facility)
    return ranked.drop("_draw", "_range", "_of", "_last", "_rank")
