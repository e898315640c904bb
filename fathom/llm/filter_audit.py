"""How filters interact: what each would remove at each place of every order.

Every document is a failure mask, one bit a filter. The masks of a part are counted on Spark and
become a decision diagram: a level for each filter, the pass branch and the fail branch of a node
below it, equal branches stored once, and with every node the weight (documents, and how many of
them are marked) of all that lies below it. An order of filters is an order of levels. Orders are
visited so that each differs from the one before by one swap of neighbouring levels, which
rewrites the nodes of those two levels only. The path on which all filters pass gives the steps of
an order: what its fail branches weigh is removed, what its pass branches weigh is kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import bind, join_keys, materialize, table

#: All orders are visited, so the number of filters is bounded: 7 have 5,040.
MOST_FILTERS = 7

STEPS = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)

Weight = tuple[int, ...]


class Diagram:
    """A weighted decision diagram of failure masks over ``n`` filters, in any order of levels.

    Every path goes through all levels, so a weight is the plain sum over the masks below. Nodes
    of a level are distinct as functions; empty branches are one node a level.
    """

    def __init__(self, n: int, weights: dict[int, Weight]) -> None:
        self.order = list(range(n))
        self.weight: list[Weight] = []
        self.below: list[tuple[int, int] | None] = []
        self.unique: list[dict[tuple[int, int], int]] = [{} for _ in range(n)]
        width = len(next(iter(weights.values())))
        ends: dict[Weight, int] = {}

        def end(mask: int) -> int:
            weight = weights.get(mask, (0,) * width)
            if weight not in ends:
                ends[weight] = self._new(weight, None)
            return ends[weight]

        def build(level: int, mask: int) -> int:
            if level == n:
                return end(mask)
            return self._node(level, build(level + 1, mask), build(level + 1, mask | 1 << level))

        self.root = build(0, 0)

    def _new(self, weight: Weight, below: tuple[int, int] | None) -> int:
        self.weight.append(weight)
        self.below.append(below)
        return len(self.weight) - 1

    def _node(self, level: int, passed: int, failed: int) -> int:
        key = (passed, failed)
        if key not in self.unique[level]:
            weight = tuple(a + b for a, b in zip(self.weight[passed], self.weight[failed]))
            self.unique[level][key] = self._new(weight, key)
        return self.unique[level][key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below; nodes above keep their children."""
        above = self.unique[level]
        self.unique[level], self.unique[level + 1] = {}, {}
        for (passed, failed), node in above.items():
            (pp, pf), (fp, ff) = self.below[passed], self.below[failed]
            key = (self._node(level + 1, pp, fp), self._node(level + 1, pf, ff))
            self.below[node] = key
            self.unique[level][key] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, Weight, Weight]]:
        """``filter, kept, removed`` along the path on which all filters of the order pass."""
        node, found = self.root, []
        for which in self.order:
            passed, failed = self.below[node]
            found.append((which, self.weight[passed], self.weight[failed]))
            node = passed
        return found


def neighbouring_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the next one, one after another, to visit every order of ``n`` once."""
    if n < 2:
        return
    inner = list(neighbouring_swaps(n - 1))
    down = True
    for turn in range(len(inner) + 1):
        # The last filter walks from one end to the other, between two orders of the rest.
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if turn < len(inner):
            yield inner[turn] + (1 if down else 0)
        down = not down


def part_steps(names: Sequence[str], weights: dict[int, Weight]) -> list[tuple]:
    """All orders' steps of one part; ``weights``: mask to (documents, good ones, toxic ones)."""
    n = len(names)
    diagram = Diagram(n, weights)
    orders = [("".join(names[i] for i in diagram.order), diagram.steps())]
    for level in neighbouring_swaps(n):
        diagram.swap(level)
        orders.append(("".join(names[i] for i in diagram.order), diagram.steps()))
    fails, alone, shapley = [0] * n, [0] * n, [0] * n
    for _, steps in orders:
        fails[steps[0][0]] = steps[0][2][0]  # as the first filter it removes all that fail it
        alone[steps[-1][0]] = steps[-1][2][0]  # as the last one what fails nothing else
        for which, _, removed in steps:
            shapley[which] += removed[0]
    return [
        (order, at, kept[0], removed[0], fails[which] - removed[0], alone[which], removed[1], removed[2], shapley[which])
        for order, steps in orders
        for at, (which, kept, removed) in enumerate(steps, 1)
    ]


def _all_steps(names: Sequence[str]):
    schema = pa.schema(
        [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
        + [(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                weights = {m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks}
                rows = [(part, *row) for row in part_steps(names, weights)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
                )

    return run


def interactions(counted: DataFrame, names: Sequence[str]) -> DataFrame:
    """``STEPS`` for each part of ``counted`` (part, mask, n, good, toxic): a row a part and mask.

    A part has two to the number of filters masks at most, so its rows are a bounded group.
    """
    if not 1 <= len(names) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters have all their orders visited")
    masks = F.collect_list(F.struct("mask", "n", "good", "toxic"))
    return counted.groupBy("part").agg(masks.alias("masks")).mapInArrow(_all_steps(names), STEPS)


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on a text that is not null, by letter.

    A: under 200 words; B: fewer than half of the words distinct; C: more than three in a
    hundred characters are A-Z; D: holds one of ``#$%&*|``.
    """
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    counts = bind(words, lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("own")))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": bind(counts, lambda c: c["all"] < 200),
        "B": bind(counts, lambda c: 100 * c["own"].cast("bigint") < 50 * c["all"].cast("bigint")),
        "C": 100 * capitals.cast("bigint") > 3 * F.length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, repeat: str = "E") -> tuple[DataFrame, list[str]]:
    """``doc_id, part, mask`` for each row of ``docs``, stored, and the filters' names in order of bits.

    The last bit is ``repeat``: another row with the same text has a smaller id. Texts are
    compared by SHA-256; the smallest ids come from a partial aggregate, and only digests that
    repeat meet the rows again, so a third of all rows may hold one text.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    conditions = text_filters(F.col("text"))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(conditions.values())]
    mask = sum(bits[1:], bits[0])
    stored = materialize(
        rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    )
    first = stored.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.filter("n > 1").select("digest", "first_id"))
    again = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    full = F.col("mask") + F.when(again, 1 << len(bits)).otherwise(0)
    return join_keys(stored, first, "digest", "left").select("doc_id", "part", full.alias("mask")), [*conditions, repeat]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What filters A to E remove in every order, a row per part, order and step.

    ``docs`` has doc_id, text, lang; ``labels`` has doc_id, quality, toxic. Null texts are empty
    texts (which fail A), a null lang is the part of the empty string; a null id neither makes a
    row a repeat nor is one, and has no label. Repeated rows count each; a row that equals
    another in id and text is not its repeat. A document is good or toxic if any label row of
    its id says so. Null labels say nothing. Parts come from the rows, so an empty table gives
    no rows; other columns are not read.
    """
    masks, names = failure_masks(docs)
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.bool_or(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.bool_or(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marks = materialize(marks.filter("good OR toxic"))
    counted = join_keys(masks, marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    return interactions(counted, names)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
failed AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END AS mask
  FROM words),
masks AS (
  SELECT part, mask, count(*) AS n,
         count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS good,
         count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS toxic
  FROM failed GROUP BY part, mask),
letter(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, bits[s] AS bit,
         CAST(list_sum(list_append(bits[1:s - 1], 0)) AS INTEGER) AS earlier
  FROM orders, range(1, 6) AS r(s)),
counted AS (
  SELECT part, filter_order, step, any_value(bit) AS bit,
    sum(CASE WHEN mask & (earlier + bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""
