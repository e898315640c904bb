"""Files below a folder, and profiles of CSV files of any layouts.

Every CSV file tells its own layout: the names in its first record, read from the first block of
the file alone. All files are then parsed in one scan as rows of cells, whatever their layouts,
and a file's roles and types are found by the places of its cells.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import materialize

# Column names by role, names of column types, and cells that stand for nothing.
LATITUDE_NAMES = ("latitude", "lat")
LONGITUDE_NAMES = ("longitude", "lon")
TIME_NAMES = ("time", "date")
INTEGER_TYPE, FLOAT_TYPE, BOOLEAN_TYPE, OTHER_TYPE = "int64", "float64", "bool", "object"
NO_VALUE = ("", "NA", "N/A", "NaN", "nan", "NULL", "null", "None")
# End of fixed values.

#: Bytes of a file that are read for its first record; more only while the record goes on.
FIRST_BLOCK = 1 << 16

LAYOUT = "file_path string, size bigint, names array<string>"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of all files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def first_record(text: str, whole: bool) -> list[str] | None:
    """Fields of the first CSV record of a text; None if it may go on behind a text not ``whole``."""
    quoted = False
    for at, character in enumerate(text):
        if character == '"':
            quoted = not quoted
        elif character in "\r\n" and not quoted:
            return next(csv.reader(io.StringIO(text[:at], newline="")), [])
    return next(csv.reader(io.StringIO(text, newline="")), []) if whole else None


def _names(uri: str) -> list[str]:
    files, path = pyarrow.fs.FileSystem.from_uri(uri)
    with files.open_input_file(path) as file:
        size, block = file.size(), FIRST_BLOCK
        while True:
            text = file.read_at(min(block, size), 0).decode("utf-8-sig", "replace")
            names = first_record(text, block >= size)
            if names is not None:
                return names
            block *= 2


def csv_layouts(spark: SparkSession, path: str | Sequence[str], block_tasks: int = 200) -> DataFrame:
    """``file_path, size, names``: each file below ``path`` and the names in its first record.

    Files are listed, and of each only the first block is read, by its range; files are dealt to
    ``block_tasks`` tasks, as reading a block takes a round trip rather than bytes. The paths must
    be ones that ``pyarrow.fs`` can open. Names may hold quoted commas and line ends. Spark
    does not list files without a byte.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = listed.select(F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("size"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [_names(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.list_(pa.string()))], names=["file_path", "size", "names"]
            )

    return materialize(listed.filter(F.col("file_path").rlike(r"(?i)\.csv$")).repartition(block_tasks).mapInArrow(read, LAYOUT))


def csv_cells(spark: SparkSession, path: str | Sequence[str], layouts: DataFrame) -> DataFrame:
    """``file_path, cells``: the records of all files below ``path`` as arrays of text, null for nothing.

    One scan for all layouts, as wide as the widest; cells that a file does not have are null.
    """
    width = layouts.agg(F.max(F.size("names"))).first()[0] or 1
    columns = [f"c{i}" for i in range(width)]
    reader = spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    reader = reader.option("escape", '"').schema(", ".join(f"{c} string" for c in columns))
    rows = reader.csv([path] if isinstance(path, str) else list(path))
    cells = [F.when(~F.trim(c).isin(*NO_VALUE), F.col(c)) for c in columns]
    return rows.select(F.col("_metadata.file_path").alias("file_path"), F.array(*cells).alias("cells"))


def named_columns(layouts: DataFrame) -> DataFrame:
    """``file_path, pos, name``: a row per column of each file."""
    return layouts.select("file_path", F.posexplode("names").alias("pos", "name"))


def column_roles(columns: DataFrame, keys: Sequence[str] = ("file_path",)) -> DataFrame:
    """Latitude, longitude and time column per file from rows ``(file, pos, name)``.

    An exact name (case aside) wins, the last one if there are several. Only a file without
    an exact time name falls back to the first name that contains one. ``error`` tells a
    missing time column; a missing latitude or longitude leaves the box unknown.
    """
    name = F.lower("name")

    def last(test: Column) -> Column:
        return F.max_by(F.when(test, F.col("name")), F.when(test, F.col("pos")))

    def first(test: Column) -> Column:
        return F.min_by(F.when(test, F.col("name")), F.when(test, F.col("pos")))

    is_lat, is_lon = name.isin(*LATITUDE_NAMES), name.isin(*LONGITUDE_NAMES)
    exact = name.isin(*TIME_NAMES)
    holds = F.lit(False)
    for part in TIME_NAMES:
        holds = holds | name.contains(part)
    roles = columns.groupBy(*keys).agg(
        last(is_lat).alias("latitude"),
        last(is_lon).alias("longitude"),
        F.coalesce(last(exact), first(holds & ~is_lat & ~is_lon)).alias("time"),
    )
    return roles.withColumn("error", F.when(F.col("time").isNull(), "Time column not found"))


def csv_extents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Per file the columns' roles, the box and the time range, or why there is none.

    Equal ends of time become one instant. A file without a time column has an ``error`` and no
    extent; one without latitude or longitude has no box. Files are read once.
    """
    layouts = csv_layouts(spark, path)
    roles = column_roles(named_columns(layouts)).join(layouts.select("file_path", "names"), "file_path")

    def place(role: str) -> Column:
        return F.nullif(F.array_position("names", F.col(role)), F.lit(0).cast("bigint")).cast("int") - 1

    sides = ("latitude", "longitude", "time")
    placed = materialize(roles.select("file_path", *sides, "error", *[place(r).alias(f"{r}_at") for r in sides]))
    rows = csv_cells(spark, path, layouts).join(placed.select("file_path", *[f"{r}_at" for r in sides]), "file_path")
    located = F.col("latitude_at").isNotNull() & F.col("longitude_at").isNotNull()

    def number(role: str) -> Column:
        return F.when(located, F.get("cells", F.col(f"{role}_at")).try_cast("double"))

    moment = F.get("cells", F.col("time_at")).try_cast("timestamp_ntz")
    ends = rows.groupBy("file_path").agg(
        F.min(number("longitude")).alias("west"), F.min(number("latitude")).alias("south"),
        F.max(number("longitude")).alias("east"), F.max(number("latitude")).alias("north"),
        F.min(moment).alias("_start"), F.max(moment).alias("_end"),
    )
    single, timed = F.col("_start") == F.col("_end"), F.col("error").isNull()
    box = [F.when(timed, F.col(c)).alias(c) for c in ("west", "south", "east", "north")]
    return placed.join(ends, "file_path", "left").select(
        "file_path", *sides, "error", *box,
        F.when(single, F.col("_start")).alias("datetime"),
        F.when(~single, F.col("_start")).alias("start_datetime"),
        F.when(~single, F.col("_end")).alias("end_datetime"),
    )


def csv_table_profile(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file_path, row_count, pos, column_name, col_type``: a row per file and column.

    Types are of the file's own values: whole numbers, numbers (also whole ones with gaps),
    truth values, or anything else. Each file's cells are looked at once, for all columns.
    """
    layouts = csv_layouts(spark, path)
    cells = csv_cells(spark, path, layouts)
    width = layouts.agg(F.max(F.size("names"))).first()[0] or 1
    tests = []
    for i in range(width):
        cell = F.trim(F.get("cells", F.lit(i)))
        whole = cell.rlike(r"^[+-]?[0-9]{1,18}$")
        parts = (
            F.count(cell).alias("there"), F.count_if(whole).alias("whole"),
            F.count_if(cell.try_cast("double").isNotNull()).alias("numbers"),
            F.count_if(F.lower(cell).isin("true", "false")).alias("truths"),
        )
        tests.append(F.struct(*parts))
    counted = cells.groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count"), F.array(*tests).alias("_seen"))
    seen = F.get("_seen", F.col("pos"))
    full = seen["there"] == F.col("row_count")
    kind = (
        F.when(full & (seen["whole"] == seen["there"]) & (F.col("row_count") > 0), INTEGER_TYPE)
        .when(full & (seen["truths"] == seen["there"]) & (F.col("row_count") > 0), BOOLEAN_TYPE)
        .when((seen["numbers"] == seen["there"]) & (F.col("row_count") > 0), FLOAT_TYPE)
        .otherwise(OTHER_TYPE)
    )
    joined = named_columns(layouts).join(counted, "file_path", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))
    return joined.select("file_path", "row_count", "pos", F.col("name").alias("column_name"), F.coalesce(kind, F.lit(OTHER_TYPE)).alias("col_type"))
