"""What the operators of this package share: tables, Arrow batches, scratch tables, row keys."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import materialize

ARROW_ROWS = 512

__all__ = [
    "ARROW_ROWS", "arrow_rows", "ascii_lower", "bind", "join_keys", "map_rows", "materialize", "row_key", "table",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_rows(df: DataFrame, rows: int = ARROW_ROWS) -> DataFrame:
    """``df``; its session hands workers at most ``rows`` rows at once from now on.

    Long texts are common here, and Spark bounds a batch by rows only: the default of 10,000
    would let one batch of them outgrow a worker.
    """
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(key, "10000"))
    if now <= 0 or now > rows:
        conf.set(key, str(rows))
    return df


def map_rows(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """``make()`` once a task, its result on each batch; for work that keeps something warm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return arrow_rows(df).mapInArrow(run, schema)


def row_key(id_col: str | Column, text_col: str | Column) -> Column:
    """A key that equal (id, text) rows share and others do not.

    Ids may repeat with another text, or be null; rows equal in both get equal results, so
    one key for all of them is enough.
    """
    one = F.col(id_col) if isinstance(id_col, str) else id_col
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.concat_ws(":", F.coalesce(one.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("\0"))))


#: Rows of a narrow table (a key and few numbers: about 100 bytes) that may be broadcast.
BROADCAST_ROWS = 500_000


def join_keys(df: DataFrame, keys: DataFrame, on: str | list[str], how: str) -> DataFrame:
    """``df`` joined to a narrow stored table, broadcast only if it has few enough rows.

    Counting a stored Parquet table reads its footers. Beyond the bound both sides are
    shuffled, and adaptive execution splits what is skewed.
    """
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return df.join(keys, on, how)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null as empty.

    ``lower`` does the same, and faster, where all characters are ASCII.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
