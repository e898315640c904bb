"""Paths of JSON payloads, counted in one pass by trees that tasks grow and Spark merges.

Each task keeps one tree of the object keys it has seen; a node counts the values at its path by
kind. Trees are written out as rows of counts when they have many nodes and at the end, and the
rows are added up, so what is shuffled follows the number of different paths, not of payloads.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.session import materialize

#: Nodes of a task's tree before its counts are handed on.
MOST_NODES = 200_000
KINDS = ("object", "array", "string", "boolean", "null", "integer", "number")
OBJECT = KINDS.index("object")
_KIND_OF = {dict: OBJECT, list: 1, str: 2, bool: 3, type(None): 4, int: 5, float: 6}
_LARGEST = 1 << 63

COUNTS = "path string, parent string, kind string, n_rows bigint"


def _no_constant(name: str) -> None:
    raise ValueError(f"not JSON: {name}")


class PathTree:
    """Counts by kind of the values at each path; nodes are ``[counts, children]``."""

    def __init__(self) -> None:
        self.root: list = [[0] * len(KINDS), {}]
        self.nodes = 1

    def add(self, value: object) -> None:
        todo = [(self.root, value)]
        while todo:
            node, value = todo.pop()
            kind = _KIND_OF[type(value)]
            if kind == 5 and not -_LARGEST <= value < _LARGEST:
                kind = 6
            node[0][kind] += 1
            if kind == OBJECT:
                below = node[1]
                for key, child in value.items():
                    at = below.get(key)
                    if at is None:
                        at = below[key] = [[0] * len(KINDS), {}]
                        self.nodes += 1
                    todo.append((at, child))

    def rows(self) -> Iterator[tuple[str | None, str | None, str, int]]:
        """``path, parent, kind, count``; the payloads themselves have no path."""
        todo: list[tuple[str | None, str | None, list]] = [(None, None, self.root)]
        while todo:
            path, parent, (counts, below) = todo.pop()
            for kind, n in zip(KINDS, counts):
                if n:
                    yield path, parent, kind, n
            todo += [(key if path is None else f"{path}.{key}", path, child) for key, child in below.items()]


def _batch(tree: PathTree) -> pa.RecordBatch:
    columns = list(zip(*tree.rows())) or [[], [], [], []]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["path", "parent", "kind", "n_rows"])


def path_counts(payloads: DataFrame, column: str = "metadata") -> DataFrame:
    """``path, parent, kind, n_rows``: how many values of a kind stand at each path.

    Each payload is parsed once. Keys of objects make paths, however deep; elements of arrays
    have no key. The payload itself has a null path, its keys a null parent. Null payloads are
    passed over; one that is not JSON fails the job. Whole numbers beyond 64 bits are numbers.
    """

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = PathTree()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text is not None:
                    tree.add(json.loads(text, parse_constant=_no_constant))
                if tree.nodes > MOST_NODES:
                    yield _batch(tree)
                    tree = PathTree()
        yield _batch(tree)

    grown = payloads.select(F.col(column).cast("string")).mapInArrow(grow, COUNTS)
    return grown.groupBy("path", "parent", "kind").agg(F.sum("n_rows").alias("n_rows"))


def payload_paths(payloads: DataFrame, column: str = "metadata") -> DataFrame:
    """Every path of the payloads, with value type and row count."""
    counted = path_counts(payloads, column).filter(F.col("path").isNotNull())
    return counted.groupBy("path", "kind").agg(F.sum("n_rows").alias("n_rows"))


def infer_json_schema(payloads: DataFrame, column: str = "metadata") -> DataFrame:
    """The merged schema of all payloads: ``path, kind, n_rows, required``, a row per path and kind.

    A path is required if it is there in every object that its parent is (for a path without
    parent: in every payload that is an object). The payloads are read once; the rest works on
    the merged counts, a table, since the number of paths follows the names that occur.
    """
    counted = materialize(path_counts(payloads, column))
    there = counted.groupBy("path", "parent").agg(F.sum("n_rows").alias("n_there"))
    holders = counted.filter(F.col("kind") == "object").groupBy(F.col("path").alias("holder")).agg(
        F.sum("n_rows").alias("n_holders")
    )
    known = there.join(holders, F.col("parent").eqNullSafe(F.col("holder"))).select(
        F.col("path").alias("of"), F.col("parent").alias("above"), (F.col("n_there") == F.col("n_holders")).alias("required")
    )
    same = (F.col("path") == F.col("of")) & F.col("parent").eqNullSafe(F.col("above"))
    return counted.filter(F.col("path").isNotNull()).join(known, same).select("path", "kind", "n_rows", "required")
