"""An inventory table as a data source of its own: pushed filters, a column list, a row limit.

``spark.read.format("inventory_table").option("path", ...)`` reads a folder of Parquet files in
``columns`` only, leaves out by their statistics the row groups that no pushed filter can match,
and evaluates the pushed filters while it reads, so other rows never reach Spark. ``scan_source``
is the way to use it with a ``Scan``.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from fathom.sources.inventory import Scan

FORMAT = "inventory_table"
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
CASE_CONF = "spark.sql.caseSensitive"


def _open(path: str) -> ds.Dataset:
    """The files below a local path or a URI that ``pyarrow.fs`` knows; folders named ``key=value`` are columns."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        files, root = pyarrow.fs.FileSystem.from_uri(path if "://" in path else path.replace(":", "://", 1))
    else:
        files, root = pyarrow.fs.LocalFileSystem(), path
    return ds.dataset(root, filesystem=files, format="parquet", partitioning="hive")


def resolve(names: Sequence[str], fields: Sequence[str], case_sensitive: bool) -> list[str]:
    """The table's own names for ``fields``; a field that none or several of them match is an error."""
    found = []
    for field in fields:
        same = [n for n in names if n == field] if case_sensitive else [n for n in names if n.lower() == field.lower()]
        if len(same) != 1:
            raise ValueError(f"column {field} is {'ambiguous' if same else 'not'} among {', '.join(names)}")
        found += same
    return found


def _plain(value: object) -> object:
    """A pushed value as its column holds it: times without zone come with one, of no meaning."""
    return value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value


def _expression(pushed: D.Filter, types: dict[str, pa.DataType]) -> pc.Expression | None:
    """The pushed filter for pyarrow, true for the same rows as in Spark; None if there is none."""
    if isinstance(pushed, D.Not):
        inner = None if isinstance(pushed.child, D.Not) else _expression(pushed.child, types)
        if inner is None or isinstance(pushed.child, (D.IsNull, D.IsNotNull)):
            return None if inner is None else ~inner
        # Where the test is unknown its opposite is too; pyarrow's lists never are.
        return ~inner & ds.field(pushed.child.attribute[0]).is_valid()
    if len(pushed.attribute) != 1:
        return None
    field, kind = ds.field(pushed.attribute[0]), types[pushed.attribute[0]]
    if isinstance(pushed, D.IsNull):
        return field.is_null()
    if isinstance(pushed, D.IsNotNull):
        return field.is_valid()
    if isinstance(pushed, D.In):
        # Beside a null in the list, what is not found is unknown; left to Spark.
        return None if any(_odd(v, kind) for v in pushed.value) else field.isin([_plain(v) for v in pushed.value])
    if _odd(pushed.value, kind):
        return None
    value = _plain(pushed.value)
    if isinstance(pushed, D.EqualTo):
        return field == value
    if isinstance(pushed, D.GreaterThan):
        return field > value
    if isinstance(pushed, D.GreaterThanOrEqual):
        return field >= value
    if isinstance(pushed, D.LessThan):
        return field < value
    if isinstance(pushed, D.LessThanOrEqual):
        return field <= value
    if isinstance(pushed, D.StringStartsWith):
        return pc.starts_with(field, value)
    if isinstance(pushed, D.StringEndsWith):
        return pc.ends_with(field, value)
    if isinstance(pushed, D.StringContains):
        return pc.match_substring(field, value)
    return None


def _may_hold(pushed: D.Filter, statistics: dict[str, dict]) -> bool:
    """Whether a row group of these statistics can hold a row that passes."""
    bounds = statistics.get(".".join(getattr(pushed, "attribute", ())))
    if not bounds or bounds.get("min") is None or not hasattr(pushed, "value"):
        return True
    low, high = bounds["min"], bounds["max"]
    wanted = [_plain(v) for v in (pushed.value if isinstance(pushed, D.In) else (pushed.value,))]
    if any(type(v) is not type(low) for v in wanted) or getattr(low, "tzinfo", None) is not None:
        return True  # not to be compared as they stand
    value = wanted[0]
    if isinstance(pushed, (D.EqualTo, D.In)):
        return any(low <= v <= high for v in wanted)
    if isinstance(pushed, (D.GreaterThan, D.GreaterThanOrEqual)):
        return high > value or high == value and isinstance(pushed, D.GreaterThanOrEqual)
    if isinstance(pushed, (D.LessThan, D.LessThanOrEqual)):
        return low < value or low == value and isinstance(pushed, D.LessThanOrEqual)
    if isinstance(pushed, D.StringStartsWith):
        return low[: len(value)] <= value <= high[: len(value)]
    return True


def _odd(value: object, kind: pa.DataType) -> bool:
    """Left to Spark: nulls, floating numbers, whose NaN has another order there, times with a zone."""
    return value is None or isinstance(value, float) or pa.types.is_timestamp(kind) and kind.tz is not None


@dataclass
class RowGroups(D.InputPartition):
    """Some row groups of one file."""

    path: str
    groups: list[int]


class InventoryTable(D.DataSource):
    """Options: ``path``; ``columns`` (a JSON list, default all); ``limit``, rows of a task at most;
    ``caseSensitive`` for the column list; ``groupsPerTask``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _columns(self) -> list[str]:
        table = _open(self.options["path"]).schema
        asked = self.options.get("columns")
        exact = self.options.get("caseSensitive", "true").lower() == "true"
        return resolve(table.names, json.loads(asked), exact) if asked else table.names

    def schema(self) -> T.StructType:
        table = _open(self.options["path"]).schema
        return from_arrow_schema(pa.schema([table.field(c) for c in self._columns()]))

    def reader(self, schema: T.StructType) -> D.DataSourceReader:
        limit = self.options.get("limit")
        return TableReader(self.options["path"], schema, int(limit) if limit else None, int(self.options.get("groupsPerTask", "8")))


class TableReader(D.DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, limit: int | None, groups_per_task: int) -> None:
        self.path, self.columns = path, schema.names
        self.arrow = to_arrow_schema(schema)
        self.types = dict(zip(self.columns, _open(path).schema.empty_table().select(self.columns).schema.types))
        self.limit, self.groups_per_task = limit, groups_per_task
        self.pushed: list[D.Filter] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        for one in filters:
            if _expression(one, self.types) is None:
                self.limit = None  # Spark filters once more: the rows it needs are not known here
                yield one
            else:
                self.pushed.append(one)

    def _filter(self) -> pc.Expression | None:
        whole = None
        for one in self.pushed:
            test = _expression(one, self.types)
            whole = test if whole is None else whole & test
        return whole

    def partitions(self) -> Sequence[D.InputPartition]:
        """Row groups that may hold a wanted row, by their statistics."""
        found, wanted = [], self._filter()
        for file in _open(self.path).get_fragments(filter=wanted):
            groups = [g.id for g in file.row_groups if all(_may_hold(f, g.statistics or {}) for f in self.pushed)]
            for at in range(0, len(groups), self.groups_per_task):
                found.append(RowGroups(file.path, groups[at : at + self.groups_per_task]))
        return found or [RowGroups("", [])]

    def read(self, partition: RowGroups) -> Iterator[pa.RecordBatch]:
        if not partition.groups:
            return
        table, left = _open(self.path), self.limit
        file = next(f for f in table.get_fragments() if f.path == partition.path)
        part = file.subset(row_group_ids=partition.groups)
        for batch in part.to_batches(schema=table.schema, columns=self.columns, filter=self._filter()):
            if left is not None:
                batch, left = batch.slice(0, left), left - batch.num_rows
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(batch.columns, self.arrow.types)], schema=self.arrow)
            if left is not None and left <= 0:
                return


@contextmanager
def _names_matched(spark: SparkSession, case_sensitive: bool) -> Iterator[None]:
    before = spark.conf.get(CASE_CONF)
    spark.conf.set(CASE_CONF, str(case_sensitive).lower())
    try:
        yield
    finally:
        spark.conf.set(CASE_CONF, before)


def scan_source(spark: SparkSession, path: str, scan: Scan = Scan(), case_sensitive: bool = True) -> DataFrame:
    """``scan`` of the Parquet table at ``path`` through the source.

    Only the scan's fields and the columns that its filter names are read; filters go to the
    source as far as it can evaluate them. Names in both are matched by case if ``case_sensitive``,
    and the result has the table's own names. Without a filter each task stops at the limit.
    """
    spark.dataSource.register(InventoryTable)
    spark.conf.set(PUSHDOWN_CONF, "true")
    reader = spark.read.format(FORMAT).option("path", path).option("caseSensitive", str(case_sensitive).lower())
    fields = scan.fields
    if fields is not None:
        names = _open(path).schema.names
        fields = resolve(names, fields, case_sensitive)
        text = str(scan.row_filter) if scan.row_filter is not None else ""
        flags = 0 if case_sensitive else re.IGNORECASE
        named = [n for n in names if re.search(rf"(?<!\w){re.escape(n)}(?!\w)", text, flags)]
        if scan.drop_delete_markers and "is_delete_marker" in names:
            named.append("is_delete_marker")
        reader = reader.option("columns", json.dumps(list(dict.fromkeys([*fields, *named]))))
    if scan.limit is not None and scan.row_filter is None and not scan.drop_delete_markers:
        reader = reader.option("limit", str(scan.limit))
    with _names_matched(spark, case_sensitive):
        return replace(scan, fields=fields).apply(reader.load())
