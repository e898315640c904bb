"""Hard negatives by a multiway hyperplane tree with range tables.

At a node of the tree, split points part its rows: a row belongs to the nearest one. For every
split point and every sibling's rows the node stores the least and the greatest distance. What is
asked for is a window of scores, hence an annulus of distances around an anchor: by the triangle
inequality a sibling whose range at any split point misses the annulus holds nothing that is
wanted. What is left is compared exactly in the leaves.

The first level is laid over the whole table: its split points come from a bounded sample, every
row is assigned to a cell, and the range table is an aggregate over all rows. Cells are dealt in
chunks by a hash of the id, whatever their size; each chunk grows the levels below in its task.
Anchors travel to the chunks that are not eliminated; a look into one chunk of the own cell first
gives each of them a bound, from which on the annuli are narrow.

Scores are inner products of integers x and q, and ``|x - q|^2 = |x|^2 + |q|^2 - 2 * score``, so a
window of scores is an annulus once the norms in a subtree are known to lie between two bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathom.llm.common import arrow_rows, join_keys, materialize, table

#: Split points of the first level at most, rows they are drawn from, and rows of a cell aimed at.
MOST_SPLITS, DRAWN, CELL_ROWS = 128, 384, 2048
#: Numbers in all split points of the first level at most, for very long vectors.
SPLIT_NUMBERS = 1 << 21
#: Rows of a chunk, anchors that visit it in one task, split points below the first level, rows of a leaf.
CHUNK_ROWS, PROBES, SPLITS, LEAF_ROWS = 4096, 1024, 16, 256
#: Integers of this size and so many of them keep inner products within 63 bits.
LARGEST, LONGEST = 1 << 24, (1 << 15) - 1
OPEN = 1 << 62

CELLED = "vec_id bigint, label int, dim int, vector binary, cell int"
RANGES = "dim int, split int, cell int, low double, high double, least double, most double"
PROBE = "anchor bigint, anchor_id bigint, label int, dim int, vector binary, targets array<struct<tag:int,low:bigint,high:bigint>>"
FOUND = "anchor bigint, tag int, vec_id bigint, score bigint"


def unpack(column, dim: int) -> np.ndarray:
    """Packed integers as a matrix of doubles, which hold them exactly."""
    if not dim or not len(column):
        return np.zeros((len(column), dim))
    return np.frombuffer(b"".join(column), "<i4").reshape(len(column), dim).astype(np.float64)


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``q`` and ``x``."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if np.abs(q).max() * np.abs(x).max() * x.shape[1] < 1 << 53:
        return np.rint(q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    square = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :] - 2.0 * (q @ x.T)
    return np.sqrt(np.maximum(square, 0.0))


def far_apart(candidates: np.ndarray, count: int) -> np.ndarray:
    """``count`` distinct rows, each the farthest from those before it; the first row first."""
    chosen, away = [0], distances(candidates, candidates[:1])[:, 0]
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distances(candidates, candidates[chosen[-1:]])[:, 0])
        away[chosen] = 0
    return candidates[chosen]


@dataclass
class Node:
    """Split points, and of each sibling's rows the range of distances and of squared norms."""

    points: np.ndarray
    low: np.ndarray  # [split, sibling]
    high: np.ndarray
    least: np.ndarray  # [sibling]
    most: np.ndarray

    def alive(self, q: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which siblings may hold scores between ``low`` and ``high``, for each row of ``q``."""
        near2 = norms[:, None] + self.least[None, :] - 2.0 * high[:, None]
        far2 = norms[:, None] + self.most[None, :] - 2.0 * low[:, None]
        ok = (far2 >= -0.5) & (low <= high)[:, None]
        far = np.sqrt(np.maximum(far2, 0.0)) * (1 + 1e-9) + 1e-3
        near = np.sqrt(np.maximum(near2, 0.0)) * (1 - 1e-9) - 1e-3
        for at, low_of, high_of in zip(distances(q, self.points).T, self.low, self.high):
            at = at[:, None]
            ok &= (at - far <= high_of) & (at + far >= low_of) & (near - at <= high_of)
        return ok


def grow(x: np.ndarray) -> tuple[Node, np.ndarray] | None:
    """Split points for these rows and the sibling of each; None if all rows are equal."""
    drawn = x[np.linspace(0, len(x) - 1, min(len(x), 3 * SPLITS)).astype(np.int64)]
    points = far_apart(drawn, SPLITS)
    away = distances(x, points)
    of = away.argmin(axis=1)
    m = len(points)
    if m < 2 or (of == of[0]).all():
        return None
    norms = (x * x).sum(axis=1)
    node = Node(points, np.full((m, m), np.inf), np.full((m, m), -np.inf), np.full(m, np.inf), np.full(m, -np.inf))
    for j in range(m):
        mine = of == j
        if mine.any():
            node.low[:, j], node.high[:, j] = away[mine].min(axis=0), away[mine].max(axis=0)
            node.least[j], node.most[j] = norms[mine].min(), norms[mine].max()
    return node, of


class Search:
    """The best ``k`` rows of each query's window, gathered leaf by leaf.

    Once a query has ``k`` rows its window begins at the last of them.
    """

    def __init__(self, queries: dict[str, np.ndarray], same: bool, k: int) -> None:
        self.q, self.own, self.label = queries["vector"], queries["own"], queries["label"]
        self.low, self.high = queries["low"].copy(), queries["high"]
        self.norms = (self.q * self.q).sum(axis=1)
        self.same, self.k = same, k
        self.score = np.full((len(self.q), k), -OPEN, np.int64)
        self.id = np.full((len(self.q), k), np.iinfo(np.int64).max, np.int64)

    def visit(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, active: np.ndarray) -> None:
        split = grow(x) if len(x) > LEAF_ROWS else None
        if split is None:
            for at in range(0, len(x), LEAF_ROWS):
                part = slice(at, at + LEAF_ROWS)
                self.leaf(x[part], ids[part], labels[part], active)
            return
        node, of = split
        for j in range(len(node.points)):
            rows = np.flatnonzero(of == j)
            if len(rows):
                ok = node.alive(self.q[active], self.norms[active], self.low[active], self.high[active])[:, j]
                if ok.any():
                    self.visit(x[rows], ids[rows], labels[rows], active[ok])

    def leaf(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, active: np.ndarray) -> None:
        score = inner(self.q[active], x)
        wanted = (labels[None, :] == self.label[active, None]) == self.same
        wanted &= ids[None, :] != self.own[active, None]
        wanted &= (score >= self.low[active, None]) & (score <= self.high[active, None])
        hit = wanted.any(axis=1)
        if not hit.any():
            return
        at = active[hit]
        score = np.concatenate([self.score[at], np.where(wanted[hit], score[hit], -OPEN)], axis=1)
        found = np.broadcast_to(ids, (len(at), len(ids)))
        found = np.concatenate([self.id[at], np.where(wanted[hit], found, np.iinfo(np.int64).max)], axis=1)
        best = np.lexsort((found, -score), axis=-1)[:, : self.k]
        self.score[at] = np.take_along_axis(score, best, axis=1)
        self.id[at] = np.take_along_axis(found, best, axis=1)
        self.low[at] = np.maximum(self.low[at], self.score[at, -1])


def search_chunk(rows: pd.DataFrame, probes: pd.DataFrame, same: bool, k: int) -> pd.DataFrame:
    """``FOUND`` of one chunk of rows for the anchors that visit it."""
    out = pd.DataFrame({"anchor": [], "tag": [], "vec_id": [], "score": []}).astype("int64")
    if not len(rows) or not len(probes):
        return out
    rows = rows.drop_duplicates(["vec_id", "label", "vector"]).sort_values("vec_id", kind="stable")
    dim = int(rows["dim"].iloc[0])
    targets = [(i, t["tag"], t["low"], t["high"]) for i, of in enumerate(probes["targets"]) for t in of]
    if not targets:
        return out
    at, tag, low, high = (np.array(c, np.int64) for c in zip(*targets))
    search = Search(
        {"vector": unpack(probes["vector"], dim)[at], "own": probes["anchor_id"].to_numpy()[at],
         "label": probes["label"].to_numpy()[at], "low": low, "high": high}, same, k,
    )
    search.visit(unpack(rows["vector"], dim), rows["vec_id"].to_numpy(), rows["label"].to_numpy(), np.arange(len(at)))
    query, place = np.nonzero(search.score > -OPEN)
    return pd.DataFrame({
        "anchor": probes["anchor"].to_numpy()[at[query]], "tag": tag[query],
        "vec_id": search.id[query, place], "score": search.score[query, place],
    })


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, dim, numbers``: usable rows, components as ``floor(256 * x)``."""
    bound = F.lit(float(LARGEST))
    floor = F.transform(vector_col, lambda x: F.floor(256 * x.cast("double")))
    usable = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(256 * x.cast("double")) < bound))
    known = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
    return vectors.filter(known & usable & (F.size(vector_col) <= LONGEST)).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("int").alias("label"),
        F.size(vector_col).alias("dim"), F.transform(floor, lambda x: x.cast("int")).alias("numbers"),
    )


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield int(dim), np.flatnonzero(dims == dim)


def _splits(rows: DataFrame) -> dict[int, np.ndarray]:
    """Split points of the first level for each length of vectors in a bounded sample."""
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(DRAWN).select("dim", "numbers").collect()
    total = rows.count()
    chosen = {}
    for dim in {r.dim for r in drawn if r.dim}:
        sample = np.array([r.numbers for r in drawn if r.dim == dim], dtype=np.float64)
        aim = math.ceil(total * len(sample) / len(drawn) / CELL_ROWS)
        points = far_apart(sample, min(MOST_SPLITS, aim, max(1, SPLIT_NUMBERS // dim)))
        if len(points) > 1:
            chosen[dim] = points
    return chosen


@dataclass
class Index:
    """``rows``: vec_id, label, dim, vector, cell, chunk; ``sizes``: dim, cell, chunks, both stored."""

    rows: DataFrame
    sizes: DataFrame
    nodes: dict[int, Node]


def build_index(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    chunk_rows: int = CHUNK_ROWS,
) -> Index:
    """The stored index of all usable rows.

    Rows without id, label or vector, with a null or non-finite component, a component beyond
    65,536 or more than 32,767 of them take no part. Vectors are compared with those of their own
    length only, each length with a first level of its own (one cell, if the sample has none).
    """
    rows = quantised(vectors, id_col, vector_col, label_col)
    points = _splits(rows)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, packed = np.zeros(batch.num_rows, np.int32), [b""] * batch.num_rows
            lists = batch.column("numbers")
            for dim, at in _by_length(batch):
                x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                if dim in points:
                    cells[at] = distances(x.astype(np.float64), points[dim]).argmin(axis=1)
                for i, row in zip(at, x.astype("<i4")):
                    packed[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("dim"), pa.array(packed, pa.binary()),
                 pa.array(cells, pa.int32())], names=["vec_id", "label", "dim", "vector", "cell"],
            )

    stored = materialize(arrow_rows(rows).mapInArrow(celled, CELLED))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Node] = {}
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            vectors_of = batch.column("vector").to_pylist()
            for dim, at in _by_length(batch):
                if dim not in points:
                    continue
                m = len(points[dim])
                node = seen.setdefault(dim, Node(
                    points[dim], np.full((m, m), np.inf), np.full((m, m), -np.inf), np.full(m, np.inf), np.full(m, -np.inf)
                ))
                x = unpack([vectors_of[i] for i in at], dim)
                away, norms, of = distances(x, node.points), (x * x).sum(axis=1), cells[at]
                np.minimum.at(node.low.T, of, away)
                np.maximum.at(node.high.T, of, away)
                np.minimum.at(node.least, of, norms)
                np.maximum.at(node.most, of, norms)
        for dim, node in seen.items():
            m = len(node.points)
            split, cell = np.divmod(np.arange(m * m), m)
            there = np.isfinite(node.least[cell])
            columns = [np.full(m * m, dim), split, cell, node.low.ravel(), node.high.ravel(), node.least[cell], node.most[cell]]
            kinds = [pa.int32()] * 3 + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[there], t) for c, t in zip(columns, kinds)],
                names=["dim", "split", "cell", "low", "high", "least", "most"],
            )

    nodes = {}
    if points:
        merged = stored.select("dim", "vector", "cell").mapInArrow(ranges, RANGES).groupBy("dim", "split", "cell").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"), F.max("most").alias("most")
        )
        # At most the square of the split points, whatever the table.
        nodes = {
            dim: Node(p, np.full((len(p), len(p)), np.inf), np.full((len(p), len(p)), -np.inf),
                      np.full(len(p), np.inf), np.full(len(p), -np.inf))
            for dim, p in points.items()
        }
        for r in merged.collect():
            node = nodes[r.dim]
            node.low[r.split, r.cell], node.high[r.split, r.cell] = r.low, r.high
            node.least[r.cell], node.most[r.cell] = r.least, r.most
    sizes = stored.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias("chunks"))
    sizes = materialize(sizes)
    chunk = F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")
    rows = join_keys(stored, sizes, ["dim", "cell"], "inner").withColumn("chunk", chunk).drop("chunks")
    return Index(materialize(rows), sizes, nodes)


def _visits(index: Index, probes: DataFrame, home: bool) -> DataFrame:
    """``probes`` with each cell and chunk to visit: one of the own cell, or all not eliminated."""
    nodes = index.nodes

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, of = [], []
            vectors_of = batch.column("vector").to_pylist()
            for dim, at in _by_length(batch):
                if dim not in nodes:
                    rows.append(at)
                    of.append(np.zeros(len(at), np.int64))
                    continue
                node, q = nodes[dim], unpack([vectors_of[i] for i in at], dim)
                if home:
                    rows.append(at)
                    of.append(distances(q, node.points).argmin(axis=1))
                    continue
                targets = batch.column("targets").take(pa.array(at)).to_pylist()
                which = np.repeat(np.arange(len(at)), [len(t) for t in targets])
                low, high = (np.array([t[c] for ts in targets for t in ts], np.int64) for c in ("low", "high"))
                ok = node.alive(q[which], (q * q).sum(axis=1)[which], low, high)
                any_of = np.zeros((len(at), ok.shape[1]), bool)
                np.logical_or.at(any_of, which, ok)
                one, cell = np.nonzero(any_of)
                rows.append(at[one])
                of.append(cell)
            taken = batch.take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(np.concatenate(of), pa.int32())], names=[*taken.schema.names, "cell"]
            )

    names = [c.strip().split(" ")[0] for c in PROBE.split(", ")]
    spread = arrow_rows(probes.select(*names)).mapInArrow(cells, f"{PROBE}, cell int")
    spread = join_keys(spread, index.sizes, ["dim", "cell"], "inner")
    if home:
        chunk = F.pmod(F.xxhash64("anchor"), F.col("chunks")).cast("int")
    else:
        chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    return spread.withColumn("chunk", chunk).drop("chunks")


def search(index: Index, probes: DataFrame, same: bool, k: int, home: bool = False, block: int = PROBES) -> DataFrame:
    """``FOUND``: the best ``k`` rows of each target of ``probes``, a row ``PROBE`` an anchor.

    ``same``: rows of the anchor's label, or of other labels. At most about ``block`` anchors meet
    a chunk in one task; the chunk is repeated for more.
    """
    keys = ["dim", "cell", "chunk", "block"]
    visits = materialize(_visits(index, probes, home))
    met = visits.groupBy("dim", "cell", "chunk").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    met = materialize(met)
    chunk_of = ["dim", "cell", "chunk"]
    asked = join_keys(visits, met, chunk_of, "inner").withColumn(
        "block", F.pmod(F.xxhash64("anchor"), F.col("blocks")).cast("int")
    ).drop("blocks")
    rows = join_keys(index.rows, met, chunk_of, "inner").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).drop("blocks")
    found = rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        lambda a, b: search_chunk(a, b, same, k), FOUND
    )
    best = Window.partitionBy("anchor", "tag").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return materialize(ranked)


def best_of(index: Index, probes: DataFrame, same: bool, k: int) -> DataFrame:
    """``FOUND`` and ``rank``, exactly: a look into the own cell, then all that it leaves open."""
    probes = materialize(probes)
    first = search(index, probes, same, k, home=True)
    bounds = first.filter(F.col("rank") == k).groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", "score"))).alias("bounds")
    )
    known = join_keys(probes, materialize(bounds), "anchor", "left")

    def narrowed(t: Column) -> Column:
        bound = F.coalesce(F.try_element_at("bounds", t["tag"]), t["low"])
        return F.struct(t["tag"].alias("tag"), F.greatest(t["low"], bound).alias("low"), t["high"].alias("high"))

    return search(index, known.withColumn("targets", F.transform("targets", narrowed)).drop("bounds"), same, k)


def _floor_of(score: Column, percent: int) -> Column:
    """``floor(percent * score / 100)`` without rounding."""
    whole = percent * score.cast("decimal(38,0)")
    return ((whole - F.pmod(whole, F.lit(100).cast("decimal(38,0)"))) / 100).cast("bigint")


def mine(
    vectors: DataFrame, anchors: Column | None = None, positives: int = 5, negatives: int = 10,
    low_pct: int = 30, high_pct: int = 90, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the usable rows (``build_index``) for which ``anchors``, a condition on vec_id,
    holds; all by default. Scores are inner products of ``floor(256 * x)``; higher come first,
    ties by the smaller id. An anchor's positives are the first ``positives`` rows of its label
    under other ids; a positive's negatives are the first ``negatives`` rows of other labels
    whose score is between ``low_pct`` and ``high_pct`` per cent of the positive's, none if that
    score is below zero. Rows equal in id, label and vector are one row; one id with different
    contents is as many rows. An empty table gives no rows; other columns are not read.
    """
    index = build_index(vectors, id_col, vector_col, label_col, chunk_rows)
    asked = index.rows if anchors is None else index.rows.filter(anchors)
    asked = materialize(asked.select("vec_id", "label", "dim", "vector").distinct())
    whole = F.array(F.struct(F.lit(0).alias("tag"), F.lit(-OPEN).alias("low"), F.lit(OPEN - 1).alias("high")))
    probes = materialize(
        asked.select(
            F.monotonically_increasing_id().alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "dim",
            "vector", whole.alias("targets"),
        )
    )
    near = best_of(index, probes, True, positives)
    near = materialize(
        near.select("anchor", F.col("rank").alias("tag"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    )
    window = F.struct(
        "tag", (-_floor_of(-F.col("positive_score"), low_pct)).alias("low"),
        _floor_of(F.col("positive_score"), high_pct).alias("high"),
    )
    targets = near.filter("positive_score >= 0").groupBy("anchor").agg(F.collect_list(window).alias("targets"))
    probes = probes.drop("targets").join(targets, "anchor")
    hard = best_of(index, probes, False, negatives)
    named = join_keys(near, probes.select("anchor", "anchor_id"), "anchor", "inner")
    return hard.join(named, ["anchor", "tag"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM ranked WHERE rank <= 10
"""
