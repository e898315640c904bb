"""Near-duplicates by bottom-k sketches.

One hash function orders all shingles; the k smallest values of a document's set are its sketch.
Inverted lists of the retained values bring documents together, the sketch of the union of two
documents estimates their similarity, and what passes is compared on full sets.

A list may hold a third of all documents, so its pairs are never all written out:

1. Documents with equal sets are one class, and only classes go on. A class that shares too few
   retained values with others to be alike any of them is left out.
2. In each list every class is compared with one hub, the one that shares most, if their sizes
   allow a link. A class looks for hubs in its shortest lists only: two alike ones have as many
   values in common as leave one of them there. Links found give first components.
3. Short lists: all pairs whose classes are not yet in one component.
4. Long lists: a prefix-filtered join on full sets, of the classes that long lists alone could
   link. Rarest shingles come first, so classes with own content have no common prefix.

Steps 3 and 4 test every pair that could still be linked, so no link is lost but by chance: that
sketches of two sets at the threshold agree in less than a quarter (with 32 values 3e-15 a pair at
85 per cent, 3e-12 at 80), or that the union sketch holds so few common values that the binomial
tail gives less than ``MISSED`` for it (at most 1e-12 a pair).
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.llm.common import bind, join_keys, map_rows, materialize, row_key, table
from fathom.llm.components import components

#: Values of a sketch, and the share of them that two alike documents have in common at least.
SKETCH = 32
LEAST_SHARED = 4
#: Members of a list whose pairs are all compared.
SHORT_LIST = 32
#: Chance with which the estimate may rule out a pair at the threshold.
MISSED = 1e-12
KEPT_WORDS = 500_000

SKETCHED = "doc_id bigint, key string, n_shingles bigint, set_key binary, sketch array<bigint>"
SETS = "node bigint, hashes array<bigint>"

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class _Words(dict):
    """Hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: str, size: int, words: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words; all words if fewer.

    Bytes are split at ASCII white space and lower-cased in A-Z, which is what a word is here.
    """
    cut = text.encode("utf-8").lower().split()
    if not cut:
        return np.empty(0, np.int64)
    each = np.fromiter(map(words.__getitem__, cut), np.uint64, len(cut))
    span = min(size, len(each))
    n = len(each) - span + 1
    mixed = np.full(n, span, np.uint64)
    for k in range(span):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(_ODD[k % len(_ODD)]) + each[k : k + n]
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(odd)
    return np.unique((mixed ^ (mixed >> np.uint64(31))).view(np.int64))


def _sketcher(size: int, k: int) -> Callable[[], Callable]:
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        import hashlib

        words = _Words()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, keys, sketches = [], [], []
            for text in batch.column(2):
                hashes = shingle_hashes(text.as_py() or "", size, words)
                counts.append(len(hashes))
                keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                sketches.append(hashes[:k])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "key", "n_shingles", "set_key", "sketch"],
            )

        return step

    return make


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node, hashes``: full sets of the classes in ``nodes`` (node, key), from one text each."""
    texts = join_keys(docs, nodes, "key", "inner").select("node", "text").dropDuplicates(["node"])

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        words = _Words()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_hashes(t.as_py(), size, words) for t in batch.column(1)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"]
            )

        return step

    return materialize(map_rows(texts, make, SETS))


class Threshold:
    """Links at ``100 * shared >= percent * union``."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def linked(self, shared: Column, union: Column) -> Column:
        return 100 * shared >= self.percent * union

    def sizes_fit(self, n: Column, m: Column) -> Column:
        """Whether sets of n and m shingles can be linked at all."""
        return self.linked(F.least(n, m), F.greatest(n, m))

    def least_shared(self, n: Column, m: Column) -> Column:
        """Smallest overlap with which sets of n and m shingles can be linked."""
        return F.ceil(self.percent * (n + m) / (100.0 + self.percent) - 1e-9)

    def prefix(self, n: Column) -> Column:
        """Rarest shingles of n of which a linked set must hold one."""
        return (n - F.ceil(self.percent * n / 100.0 - 1e-9) + 1).cast("int")

    def least_common(self, k: int) -> int:
        """Common values in a union sketch of k below which a pair at the threshold is hardly ever.

        Values are drawn alike, so their number is binomial; this is its exact tail.
        """
        t, tail = self.percent / 100.0, 0.0
        for common in range(k + 1):
            tail += math.comb(k, common) * t**common * (1 - t) ** (k - common)
            if tail > MISSED:
                return common
        return k

    def likely(self, common: Column, k: Column, sketch: int) -> Column:
        """Whether ``common`` of ``k`` values in a union sketch leave a link possible."""
        least = F.array(*[F.lit(self.least_common(i)) for i in range(1, sketch + 1)])
        return common >= F.get(least, k - 1)


def _estimated(pairs: DataFrame, sketches: DataFrame, k: int, threshold: Threshold) -> DataFrame:
    """Pairs whose union sketch does not rule out a link."""
    a = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("of_a"))
    b = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("of_b"))
    both = pairs.join(b, "b").join(a, "a")

    def passes(union: Column) -> Column:
        shared = F.size(F.array_intersect(F.array_intersect("of_a", "of_b"), union))
        return threshold.likely(shared, F.size(union), k)

    union = F.slice(F.array_sort(F.array_union("of_a", "of_b")), 1, k)
    return both.filter(bind(union, passes)).select("a", "b")


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int, threshold: Threshold) -> DataFrame:
    """Pairs that are linked on full sets. The sets of ``b`` travel to those of ``a``."""
    pairs = materialize(pairs)
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets(docs, materialize(classes.join(nodes, "node").select("node", "key")), size)
    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    linked = bind(shared, lambda s: threshold.linked(s, F.size("of_a") + F.size("of_b") - s))
    return materialize(pairs.join(b, "b").join(a, "a").filter(linked).select("a", "b"))


def _postings(classes: DataFrame) -> DataFrame:
    """``v, node, need, n, cen, members``: retained values that classes share, of those that share enough.

    ``need``: values that the class shares with any class like it; ``n``: its shingles; ``cen``:
    values it shares; ``members``: classes of the list.
    """
    need = F.greatest(F.lit(1), F.floor(F.size("sketch") / LEAST_SHARED)).cast("int")
    posted = classes.select(F.explode("sketch").alias("v"), "node", need.alias("need"), "n")
    shared = posted.groupBy("v").count().filter("count > 1").select("v")
    lists = materialize(posted.join(shared, "v"))
    for _ in range(2):  # leaving some out shortens the lists of the others
        enough = lists.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("cen"), F.first("need").alias("least"))
        enough = enough.filter(F.col("cen") >= F.col("least")).select("node", "cen")
        left = lists.select("v", "node", "need", "n").join(enough, "node")
        shared = left.groupBy("v").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        lists = materialize(left.join(shared, "v").select("v", "node", "need", "n", "cen", "members"))
    return lists


def _shortest_lists(lists: DataFrame) -> DataFrame:
    """Of each class's lists as many of the shortest as hold a value of any class like it.

    Two classes that have ``need`` values in common have one among all but the ``need - 1`` in
    the longest lists, in an order that is the same for all; a class is in few lists.
    """
    mine = Window.partitionBy("node")
    place = F.row_number().over(mine.orderBy("members", "v"))
    placed = lists.select("*", place.alias("place"), F.count(F.lit(1)).over(mine).alias("n_lists"))
    return placed.filter(F.col("place") <= F.col("n_lists") - F.col("need") + 1).drop("place", "n_lists")


def _spokes(lists: DataFrame, threshold: Threshold) -> DataFrame:
    """Each class of a list with the list's hub, of sizes that allow a link."""
    near = _shortest_lists(lists)
    hub = F.max(F.struct("cen", F.xxhash64("node", "v").alias("chance"), "node", "n")).alias("hub")
    hubs = near.groupBy("v").agg(hub).select("v", F.col("hub.node").alias("b"), F.col("hub.n").alias("n_b"))
    met = near.select("v", F.col("node").alias("a"), F.col("n").alias("n_a")).join(hubs, "v").filter("a <> b")
    return met.filter(threshold.sizes_fit(F.col("n_a"), F.col("n_b"))).select("a", "b").distinct()


def _long_list_pairs(
    docs: DataFrame, nodes: DataFrame, roots: DataFrame, size: int, threshold: Threshold
) -> DataFrame:
    """Pairs of ``nodes`` (node, key) of different roots that prefix, length and place allow."""
    sets = _sets(docs, nodes, size)
    each = sets.select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    common = materialize(each.groupBy("h").count().filter("count > 1"))
    known = each.select("node", "h").join(common, "h")
    # Shingles of one class alone come first; they only shift the places of the others.
    rest = known.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("count", "h"))).alias("rest"))
    sized = sets.select("node", F.size("hashes").alias("n")).join(rest, "node")
    own = F.col("n") - F.size("rest")
    room = threshold.prefix(F.col("n")) - own
    prefix = sized.filter(room > 0).select(
        "node", "n", own.alias("own"), F.posexplode(F.slice("rest", 1, room))
    ).select("node", "n", (F.col("own") + F.col("pos")).alias("at"), F.col("col.h").alias("h"))
    rows = prefix.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = materialize(rows)
    # Within a shingle's rows, the members of its largest component need not look for each other.
    most = rows.groupBy("h", "root").count().groupBy("h").agg(F.max(F.struct("count", "root")).alias("m"))
    most = most.select("h", F.col("m.root").alias("most"))
    a = rows.join(most, "h").filter(F.col("root") != F.col("most")).select(
        "h", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"),
        F.col("root").alias("root_a"), "most",
    )
    b = rows.select("h", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("root").alias("root_b"))
    still = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    fits = (
        (F.col("root_a") != F.col("root_b"))
        & ((F.col("root_b") == F.col("most")) | (F.col("a") < F.col("b")))
        & threshold.sizes_fit(F.col("n_a"), F.col("n_b"))
        & (still >= threshold.least_shared(F.col("n_a"), F.col("n_b")))
    )
    return a.join(b, "h").filter(fits).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80,
    sketch: int = SKETCH, short_list: int = SHORT_LIST,
) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, kept`` for each row of ``docs``.

    Rows are linked if their sets of ``shingle``-word shingles have ``percent`` per cent of
    their union in common. ``component_id``: the smallest id reachable, itself included;
    ``kept``: the row has that id. Null, empty and blank texts have an empty set, are linked
    with nothing and kept. Rows with equal sets are always linked; a repeated id stands for
    each of its texts; a null id is never a component's id unless there is no other; an empty
    table gives no rows; other columns are not read. ``key`` is that of ``common.row_key``.
    """
    threshold = Threshold(percent)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("key", row_key("doc_id", "text"))
    sketched = materialize(map_rows(rows.select("doc_id", "key", "text"), _sketcher(shingle, sketch), SKETCHED))
    classes = sketched.filter("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("least_id"), F.min("key").alias("key"), F.first("sketch").alias("sketch"),
        F.first("n_shingles").alias("n"),
    )
    classes = materialize(classes)
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()))
    sketches = classes.select("node", "sketch")
    lists = _postings(classes)

    # Sizes and shortest lists leave the estimate little to rule out here.
    first = _verified(rows, _spokes(lists, threshold), classes, shingle, threshold)
    roots = components(first)

    placed = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    is_long = F.col("members") > short_list
    long_values = lists.groupBy("node").agg(
        F.sum(is_long.cast("int")).alias("n_long"), F.first("need").alias("need")
    )
    # A list of one component has no pair to offer.
    mixed = placed.filter(~is_long).groupBy("v").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = mixed.filter("low < high").select("v")
    short = materialize(placed.filter(~is_long).join(mixed, "v").join(long_values.select("node", "n_long"), "node"))
    names = ("node", "root", "need", "n", "n_long")
    a = short.select("v", *(F.col(c).alias(f"{c}_a") for c in names))
    b = short.select("v", *(F.col(c).alias(f"{c}_b") for c in names))
    met = a.join(b, "v").filter((F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")))
    met = met.filter(threshold.sizes_fit(F.col("n_a"), F.col("n_b")))
    overlap = met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(
        F.count(F.lit(1)).alias("shared"),
        F.least(F.first("n_long_a"), F.first("n_long_b")).alias("more"),
        F.greatest(F.first("need_a"), F.first("need_b")).alias("need"),
    )
    short_pairs = overlap.filter(F.col("shared") + F.col("more") >= F.col("need")).select("a", "b")
    short_pairs = _estimated(short_pairs, sketches, sketch, threshold)

    crowded = long_values.filter(F.col("n_long") >= F.col("need")).select("node")
    crowded = materialize(classes.join(crowded, "node").select("node", "key"))
    long_pairs = _long_list_pairs(rows, crowded, roots, shingle, threshold)
    second = _verified(rows, short_pairs.unionByName(long_pairs).distinct(), classes, shingle, threshold)

    # The second links run between roots; few are left.
    of = roots.select("node", "root")
    bridged = second.join(of.withColumnsRenamed({"node": "a", "root": "root_a"}), "a", "left").join(
        of.withColumnsRenamed({"node": "b", "root": "root_b"}), "b", "left"
    ).select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    bridges = components(bridged).select(F.col("root").alias("top"), F.col("node").alias("root"))
    placed = classes.select("node", "set_key", "least_id").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node")).join(bridges, "root", "left")
    placed = placed.withColumn("top", F.coalesce("top", "root"))
    ids = placed.groupBy("top").agg(F.min("least_id").alias("component"))
    placed = materialize(placed.join(ids, "top").select("set_key", "component"))
    done = sketched.select("doc_id", "key", "n_shingles", "set_key").join(placed, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return done.select(
        "doc_id", "key", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text and others) that are kept, a repeated row once."""
    found = materialize(found.select("key", "n_shingles", "kept"))
    dropped = materialize(found.filter(~F.col("kept")).select("key").distinct())
    repeated = materialize(found.filter("kept AND n_shingles > 0").groupBy("key").count().filter("count > 1").select("key"))
    name = "__row_key"
    rows = docs.withColumn(name, row_key("doc_id", "text"))
    dropped, repeated = dropped.withColumnRenamed("key", name), repeated.withColumnRenamed("key", name)
    kept = join_keys(rows, dropped, name, "left_anti")
    once = join_keys(kept, repeated, name, "left_semi").dropDuplicates([name])
    return join_keys(kept, repeated, name, "left_anti").unionByName(once).drop(name)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
