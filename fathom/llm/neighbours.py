"""Nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. In blocks of rows, each vector is
posted in the inverted file of each of its ``prefix`` nearest pivots, with the pivot's rank. A
query visits the files of its own pivots and adds up the footrule distance of the two orders
(a missing pivot counts as rank ``prefix``); the rows of least footrule are ranked again by the
exact distance. Queries and rows meet in blocks of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.llm.common import arrow_rows, materialize, table

#: Pivots, and how many of a vector's nearest are kept in order.
PIVOTS, PREFIX = 256, 128
#: Pivots are drawn from so many rows (by a hash of the id), to find distinct ones.
PIVOT_ROWS = 4 * PIVOTS
#: Rows and queries of a block; a block of rows takes its best by footrule on: this share of
#: its rows, and this many at least. A tenth of the share does for spread vectors (recall 0.98);
#: where a third of all vectors lie close together, their orders differ little, and a quarter
#: is needed (0.95).
BLOCK_ROWS, BLOCK_QUERIES = 4096, 512
SHARE, LEAST = 0.25, 200

INDEXED = "vec_id bigint, dim int, vector binary, nearest binary"
NEAREST = "query_id bigint, vec_id bigint, score double"


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _pivots(rows: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Pivots for each length of vectors in a bounded sample."""
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_ROWS).select("vec_id", "vector").collect()
    distinct: dict[int, dict[tuple, None]] = {}
    for r in drawn:
        distinct.setdefault(len(r.vector), {})[tuple(r.vector)] = None
    return {dim: np.array(list(own)[:count], dtype=np.float64) for dim, own in distinct.items()}


def build_index(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    pivots: int = PIVOTS, prefix: int = PREFIX,
) -> DataFrame:
    """A stored table ``vec_id, dim, vector, nearest``: packed doubles, packed ranks of pivots.

    Rows whose id is null or whose vector is null, zero, or holds a null or a number that is
    not finite take no part. Vectors are near those of their own length only, and each length
    has pivots of its own: at most ``pivots`` distinct vectors out of ``PIVOT_ROWS`` rows, a
    fixed bound; a length too rare to be among those rows has none, and is searched in full.
    Every row is indexed.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    chosen = _pivots(rows, pivots)

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            dims = np.diff(lists.offsets.to_numpy()).astype(np.int32)
            vector, nearest = [b""] * batch.num_rows, [b""] * batch.num_rows
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                x = x.astype(np.float64).reshape(len(at), dim)
                for i, row in zip(at, x.astype("<f8")):
                    vector[i] = row.tobytes()
                own = chosen.get(int(dim))
                if own is not None:
                    away = (own * own).sum(axis=1) - 2 * (x @ own.T)
                    order = np.argsort(away, axis=1, kind="stable")[:, : min(prefix, len(own))].astype("<u2")
                    for i, row in zip(at, order):
                        nearest[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dims), pa.array(vector, pa.binary()), pa.array(nearest, pa.binary())],
                names=["vec_id", "dim", "vector", "nearest"],
            )

    return materialize(arrow_rows(rows).mapInArrow(run, INDEXED))


def _unpack(column: pd.Series, dtype: str) -> np.ndarray:
    width = len(column.iloc[0]) // np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(column) or bytes(0), dtype).reshape(len(column), width)


def _inverted(nearest: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pivot: the rows posted in its file, and its rank with each."""
    n, prefix = nearest.shape
    flat = nearest.ravel()
    order = np.argsort(flat, kind="stable")
    ends = np.searchsorted(flat[order], np.arange(int(flat.max()) + 2))
    row, rank = np.divmod(order, prefix)
    return [(row[a:b], rank[a:b].astype(np.int32)) for a, b in zip(ends[:-1], ends[1:])]


def footrules(nearest: np.ndarray, files: list[tuple[np.ndarray, np.ndarray]], query: np.ndarray) -> np.ndarray:
    """Footrule distance of ``query`` (its pivots in order) to each row, from the files it visits."""
    n, prefix = nearest.shape
    # As if no pivot were shared; each shared one puts right what it counted.
    total = np.full(n, prefix * (prefix + 1), dtype=np.int32)
    for rank, pivot in enumerate(query):
        if pivot < len(files):
            rows, ranks = files[pivot]
            total[rows] += np.abs(ranks - rank) - (prefix - ranks) - (prefix - rank)
    return total


def search_block(rows: pd.DataFrame, queries: pd.DataFrame, k: int, share: float, least: int) -> pd.DataFrame:
    """The ``k`` nearest of ``rows`` for each query, as far as the footrule finds them."""
    out = []
    if len(rows) and len(queries):
        rows = rows.drop_duplicates(["vec_id", "vector"]).sort_values(["vec_id", "vector"], kind="stable")
        # More than k + 1 copies of a vector: those of larger ids are never among the k nearest.
        rows = rows[rows.groupby("vector", sort=False).cumcount() <= k]
        ids, x, nearest = rows["vec_id"].to_numpy(), _unpack(rows["vector"], "<f8"), _unpack(rows["nearest"], "<u2")
        files = _inverted(nearest) if nearest.size else []
        take = min(len(ids), max(least, math.ceil(share * len(ids)))) if nearest.size else len(ids)
        own = _unpack(queries["vector"], "<f8")
        for query_id, vector, order in zip(queries["query_id"], own, _unpack(queries["nearest"], "<u2")):
            footrule = footrules(nearest, files, order)
            best = np.lexsort((ids, footrule))[:take]
            best = best[ids[best] != query_id]
            apart = x[best] - vector
            score = np.sqrt((apart * apart).sum(axis=1))
            at = np.lexsort((ids[best], score))
            found, first = np.unique(ids[best][at], return_index=True)  # a repeated id counts once
            at = at[np.sort(first)[:k]]
            out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[best][at], "score": score[at]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"}
    )


def search(
    index: DataFrame, queries: DataFrame, k: int = 10, share: float = SHARE, least: int = LEAST,
    block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query, nearest first.

    ``index`` and ``queries`` are rows of ``build_index``. Candidates are all rows but those of
    the query's id; ties go to the smaller id; an id that stands for several vectors counts
    with its nearest. Each block of queries meets each block of rows in one group, of
    ``block_rows`` and ``block_queries`` rows on average whatever the vectors are: blocks are
    dealt by a hash of the id. Equal vectors do not crowd out others, as a block keeps only
    those copies that can be in a result.
    """
    n_rows = max(1, math.ceil(index.count() / block_rows))
    own = queries.select(F.col("vec_id").alias("query_id"), "dim", "vector", "nearest").distinct()
    n_queries = max(1, math.ceil(own.count() / block_queries))

    def block(column: str, count: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = index.withColumn("rows_of", block("vec_id", n_rows)).withColumn("queries_of", every(n_queries))
    right = own.withColumn("queries_of", block("query_id", n_queries)).withColumn("rows_of", every(n_rows))
    keys = ["dim", "rows_of", "queries_of"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        lambda a, b: search_block(a, b, k, share, least), NEAREST
    )
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "embeddings"))
    return search(index, index.filter(F.col("vec_id") % 100 == 0))
