"""N-gram Jaccard join on prefix trees.

A text is its set of word n-grams, and sets are linked at a Jaccard similarity of ``percent``.

1. Texts with equal sets are one class. In the order of their hashes the first n-grams of a set
   (as many as a linked set can lack, and half as many again) are posted; a class that shares too
   few of them with others to be linked to any is left out. This loses no link.
2. The n-grams of the remaining classes get their global order, rarest first. Linked sets share
   one of their first n-grams in that order, so these deal the classes: each goes to the class
   that has one of its n-grams earliest, in chunks of bounded size.
3. A chunk stores its sets in a prefix tree, the frequent n-grams at the top, so that sets which
   have much in common share a path and its overlap with a probe is counted once. A subtree is
   left as soon as the overlap so far and the shorter of both remainders cannot reach the least
   overlap, when its sizes do not fit, or when all its classes are known to be linked already.
4. Classes of different components that share one of their first n-grams but not the chunk: they
   probe the trees of the chunks in question, found by a join on (n-gram, chunk, component), not
   on pairs.

Steps 2 to 4 are exact. Pairs inside a component are not all written out or compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import join_keys, map_rows, materialize, row_key, table
from fathom.llm.components import components
from fathom.llm.near_duplicates import _Words, shingle_hashes

#: Classes and n-grams of a chunk, on average, and classes that probe it in one task.
CHUNK_SETS, CHUNK_GRAMS = 256, 500_000

SCREENED = "doc_id bigint, key string, n bigint, set_key binary, first array<bigint>"
SETS = "node bigint, grams array<bigint>"
LINKS = "a bigint, b bigint"


class Jaccard:
    """Whole-number bounds of ``100 * shared >= percent * union``; on numbers of Python and columns."""

    def __init__(self, percent: int) -> None:
        if not 50 < percent <= 100:
            raise ValueError("percent must lie between 51 and 100")
        self.percent = percent

    def linked(self, shared, n, m):
        return 100 * shared >= self.percent * (n + m - shared)

    def spare(self, n: int) -> int:
        """N-grams of a set of n that a linked set can lack at most."""
        return (100 - self.percent) * n // 100

    def extra(self, n: int) -> int:
        return max(1, self.spare(n) // 2)

    def screen(self, n: int) -> int:
        """First n-grams by hash that are posted."""
        return min(n, self.spare(n) + self.extra(n))

    def least_screened(self, n: int) -> int:
        """Posted n-grams that a set of n shares with the posted ones of any linked set."""
        return self.extra(-(-self.percent * n // 100))

    def least_shared(self, n: int, m: int) -> int:
        return -(-self.percent * (n + m) // (100 + self.percent))

    def spare_column(self, n: Column) -> Column:
        return F.floor((100 - self.percent) * n / 100.0 + 1e-9)

    def least_screened_column(self, n: Column) -> Column:
        other = F.ceil(self.percent * n / 100.0 - 1e-9)
        return F.greatest(F.lit(1), F.floor(self.spare_column(other) / 2))

    def least_shared_column(self, n: Column, m: Column) -> Column:
        return F.ceil(self.percent * (n + m) / (100.0 + self.percent) - 1e-9)

    def sizes_fit(self, n: Column, least: Column, most: Column) -> Column:
        """A size between ``least`` and ``most`` may be linked to one of n."""
        return (100 * most >= self.percent * n) & (self.percent * least <= 100 * n)


class Trie:
    """Sets of numbers in a compressed prefix tree; each set ascending in one order of all numbers.

    Nodes are held in preorder: the numbers on the edge above, the range of sets below (sets are
    in lexicographic order), the node to go on with when the subtree is left, and bounds.
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        self.n = np.array([len(s) for s in sets], np.int64)
        common = [0] + [_common(a, b) for a, b in zip(sets, sets[1:])]
        self.parent: list[int] = []
        self.edge: list[np.ndarray] = []
        self.range: list[tuple[int, int]] = []
        self.left: list[int] = []  # longest rest of a set below the node
        self.sizes: list[tuple[int, int]] = []
        todo = [(0, len(sets), 0, -1)] if sets else []
        while todo:
            low, high, depth, parent = todo.pop()
            end = len(sets[low]) if high - low == 1 else min(common[low + 1 : high])
            node = len(self.parent)
            sizes = self.n[low:high]
            self.parent.append(parent)
            self.edge.append(sets[low][depth:end])
            self.range.append((low, high))
            self.left.append(int(sizes.max()) - end)
            self.sizes.append((int(sizes.min()), int(sizes.max())))
            if high - low > 1:
                cuts = [low, *(i for i in range(low + 1, high) if common[i] == end), high]
                todo += [(a, b, end, node) for a, b in reversed(list(zip(cuts, cuts[1:])))]
        self.skip = [0] * len(self.parent)
        for node in range(len(self.parent) - 1, -1, -1):
            self.skip[node] = max(self.skip[node], node + 1)
            if self.parent[node] >= 0:
                self.skip[self.parent[node]] = max(self.skip[self.parent[node]], self.skip[node])

    def probe(
        self, mine: np.ndarray, n: int, held: np.ndarray, rule: Jaccard, closed: Callable[[int, int], bool]
    ) -> Iterator[int]:
        """Sets linked to a probe of ``n`` numbers, of which the tree knows ``mine``, flagged in ``held``.

        ``closed(low, high)``: the sets of that range are of no interest (any more).
        """
        overlap, last = [0] * len(self.parent), [-1] * len(self.parent)
        node = 0
        while node < len(self.parent):
            low, high = self.range[node]
            least, most = self.sizes[node]
            if 100 * most < rule.percent * n or rule.percent * least > 100 * n or closed(low, high):
                node = self.skip[node]
                continue
            above, edge = self.parent[node], self.edge[node]
            shared = overlap[above] if above >= 0 else 0
            if len(edge):
                shared += int(np.count_nonzero(held[edge]))
                last[node] = int(edge[-1])
            elif above >= 0:
                last[node] = last[above]
            overlap[node] = shared
            rest = min(len(mine) - int(np.searchsorted(mine, last[node], "right")), self.left[node])
            if shared + rest < rule.least_shared(n, least):
                node = self.skip[node]
                continue
            if high - low == 1 and rule.linked(shared, n, most):
                yield low
            node += 1


def _common(a: np.ndarray, b: np.ndarray) -> int:
    m = min(len(a), len(b))
    apart = np.flatnonzero(a[:m] != b[:m])
    return int(apart[0]) if len(apart) else m


class _Chunk:
    """The prefix tree of a chunk's sets, most frequent numbers first, and where each set stands."""

    def __init__(self, nodes: np.ndarray, sets: list[np.ndarray]) -> None:
        self.grams, number, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.empty(len(often), np.int64)
        place[np.lexsort((self.grams, -often))] = np.arange(len(often))
        self.place = place
        ordered = np.split(place[number], np.cumsum([len(s) for s in sets])[:-1])
        for one in ordered:
            one.sort()
        # Lexicographic order of whole sets, as of their big-endian bytes.
        by = sorted(range(len(sets)), key=lambda i: ordered[i].astype(">u4").tobytes())
        self.nodes = nodes[by]
        self.trie = Trie([ordered[i] for i in by])
        self.held = np.zeros(len(often), bool)

    def known(self, grams: np.ndarray) -> np.ndarray:
        """Places of those of ``grams`` that stand in the tree."""
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        return np.sort(self.place[at[self.grams[at] == grams]])

    def links(self, mine: np.ndarray, n: int, rule: Jaccard, closed: Callable[[int, int], bool]) -> Iterator[int]:
        self.held[mine] = True
        yield from self.trie.probe(mine, n, self.held, rule, closed)
        self.held[mine] = False


def self_links(rows: pd.DataFrame, rule: Jaccard) -> pd.DataFrame:
    """Links (a, b) that make the components of one chunk (node, grams)."""
    rows = rows.drop_duplicates("node")
    found = []
    if len(rows) > 1:
        chunk = _Chunk(rows["node"].to_numpy(), list(rows["grams"]))
        root = np.arange(len(rows))
        for i, mine in enumerate(chunk.trie.sets):
            def closed(low: int, high: int, i: int = i) -> bool:
                low = max(low, i + 1)  # what stands before has probed itself
                return low >= high or bool((root[low:high] == root[i]).all())

            for j in chunk.links(mine, len(mine), rule, closed):
                found.append((chunk.nodes[i], chunk.nodes[j]))
                root[root == root[j]] = root[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def cross_links(rows: pd.DataFrame, probes: pd.DataFrame, rule: Jaccard) -> pd.DataFrame:
    """Links between ``probes`` and a chunk's ``rows`` (node, root, grams) of other components,
    one at least for each pair of components that has any."""
    found = []
    rows = rows.drop_duplicates("node")
    if len(rows) and len(probes):
        chunk = _Chunk(rows["node"].to_numpy(), list(rows["grams"]))
        of = dict(zip(rows["node"], rows["root"]))
        root = np.array([of[node] for node in chunk.nodes])
        renamed: dict[int, int] = {}
        for node, own, grams in zip(probes["node"], probes["root"], probes["grams"]):
            while own in renamed:
                own = renamed[own]

            def closed(low: int, high: int, own: int = own) -> bool:
                return bool((root[low:high] == own).all())

            for j in chunk.links(chunk.known(grams), len(grams), rule, closed):
                if root[j] != own:
                    found.append((node, chunk.nodes[j]))
                    renamed[int(root[j])] = own
                    root[root == root[j]] = own
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _screener(size: int, rule: Jaccard) -> Callable[[], Callable]:
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        import hashlib

        words = _Words()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, keys, first = [], [], []
            for text in batch.column(2):
                grams = shingle_hashes(text.as_py() or "", size, words)
                counts.append(len(grams))
                keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                first.append(grams[: rule.screen(len(grams))])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(first, pa.list_(pa.int64()))],
                names=["doc_id", "key", "n", "set_key", "first"],
            )

        return step

    return make


def _possible(classes: DataFrame, rule: Jaccard) -> DataFrame:
    """``node`` of the classes that share enough of their first n-grams to be linked to some other."""
    posted = classes.select(F.explode("first").alias("h"), "node")
    shared = posted.groupBy("h").count().filter("count > 1").select("h")
    lists = materialize(posted.join(shared, "h"))
    needs = materialize(classes.select("node", rule.least_screened_column(F.col("n")).alias("need")))
    enough = None
    for again in range(2):  # leaving some out leaves others alone
        counted = materialize(lists.groupBy("node").agg(F.count(F.lit(1)).alias("has")))
        enough = materialize(join_keys(needs, counted, "node", "inner").filter(F.col("has") >= F.col("need")).select("node"))
        if not again:
            left = join_keys(lists, enough, "node", "inner")
            shared = left.groupBy("h").count().filter("count > 1").select("h")
            lists = materialize(left.join(shared, "h"))
    return enough


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node, grams``: full sets of the classes in ``nodes`` (node, key, rows), from one text each.

    Only where a class has several rows two of them can have its key.
    """
    texts = join_keys(docs, nodes, "key", "inner").select("node", "text", "rows")
    texts = texts.filter("rows = 1").unionByName(texts.filter("rows > 1").dropDuplicates(["node"]))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        words = _Words()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_hashes(t.as_py(), size, words) for t in batch.column(1)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "grams"]
            )

        return step

    return materialize(map_rows(texts.select("node", "text"), make, SETS))


def _first_grams(sets: DataFrame, rule: Jaccard) -> DataFrame:
    """``h, node, n, at``: shared n-grams among the first of each set, one of which linked sets share.

    ``at`` counts the set's rarer ones. N-grams of one set alone come first and are not returned.
    """
    each = sets.select("node", F.explode("grams").alias("h"))
    common = materialize(each.groupBy("h").agg(F.count(F.lit(1)).cast("int").alias("often")).filter("often > 1"))
    ranked = each.join(common, "h").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("often", "h")))["h"].alias("rest"))
    known = sets.select("node", F.size("grams").alias("n")).join(ranked, "node").withColumn("own", F.col("n") - F.size("rest"))
    room = (rule.spare_column(F.col("n")) + 1 - F.col("own")).cast("int")
    placed = known.filter(room > 0).select("node", "n", "own", F.posexplode(F.slice("rest", 1, room)).alias("pos", "h"))
    rows = materialize(placed.select("h", "node", "n", (F.col("own") + F.col("pos")).alias("at")))
    met = rows.groupBy("h").count().filter("count > 1").select("h")
    return materialize(rows.join(met, "h"))


def _chunked(rows: DataFrame, chunk_sets: int, chunk_grams: int) -> DataFrame:
    """``node, n, hub, salt``: the chunk of each class that has a partner.

    The hub has one of the class's first n-grams at the earliest place, as an unedited copy has;
    ties go by a hash of the hub alone, so that alike classes choose alike.
    """
    hub = F.min(F.struct("at", F.xxhash64("node").alias("chance"), F.col("node").alias("hub"))).alias("best")
    best = rows.groupBy("h").agg(hub)
    chosen = rows.join(best, "h").groupBy("node").agg(F.first("n").alias("n"), F.min("best").alias("best"))
    chosen = materialize(chosen.select("node", "n", F.col("best.hub").alias("hub")))
    salts = chosen.groupBy("hub").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / chunk_sets), F.ceil(F.sum("n") / chunk_grams)).cast("int").alias("salts")
    )
    salted = join_keys(chosen, materialize(salts), "hub", "inner")
    return materialize(salted.select("node", "n", "hub", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt")))


def _first_links(sets: DataFrame, chunks: DataFrame, rule: Jaccard) -> DataFrame:
    """Links found inside chunks, the hub taking part in each."""
    hubs = chunks.select(F.col("hub").alias("node"), "hub", "salt").distinct()
    members = materialize(chunks.select("node", "hub", "salt").unionByName(hubs))
    grouped = join_keys(sets, members, "node", "inner").groupBy("hub", "salt")
    return materialize(grouped.applyInPandas(lambda rows: self_links(rows, rule), LINKS))


def _other_links(
    sets: DataFrame, rows: DataFrame, placed: DataFrame, rule: Jaccard, chunk_sets: int
) -> DataFrame:
    """Links between components that have a first n-gram in common. ``placed``: node, n, hub, salt, root."""
    known = rows.join(placed.select("node", "root", "hub", "salt"), "node")
    mixed = known.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("h")
    known = materialize(known.join(mixed, "h"))
    trees = known.groupBy("h", "root", "hub", "salt").agg(
        F.count(F.lit(1)).alias("count"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.max(F.col("n") - F.col("at")).alias("left"),
    )
    trees = materialize(trees)
    # The largest component of an n-gram's list need not look for the others; they look for it.
    largest = trees.groupBy("h", "root").agg(F.sum("count").alias("count"))
    largest = largest.groupBy("h").agg(F.max(F.struct("count", "root")).alias("top")).select("h", F.col("top.root").alias("top"))
    probes = known.join(largest, "h").filter(F.col("root") != F.col("top")).select(
        "h", "top", F.col("node").alias("probe"), F.col("root").alias("own"), F.col("n"), (F.col("n") - F.col("at")).alias("rest")
    )
    fits = (
        (F.col("root") != F.col("own"))
        & ((F.col("root") == F.col("top")) | (F.col("own") < F.col("root")))
        & rule.sizes_fit(F.col("n"), F.col("least"), F.col("most"))
        & (F.least("rest", "left") >= rule.least_shared_column(F.col("n"), F.col("least")))
    )
    visits = probes.join(trees, "h").filter(fits).select("probe", "hub", "salt").distinct()
    visits = materialize(visits)
    blocks = visits.groupBy("hub", "salt").agg(F.ceil(F.count(F.lit(1)) / chunk_sets).cast("int").alias("blocks"))
    blocks = materialize(blocks)
    keys = ["hub", "salt", "block"]
    asked = join_keys(visits, blocks, ["hub", "salt"], "inner").select(
        "hub", "salt", F.pmod(F.xxhash64("probe"), F.col("blocks")).cast("int").alias("block"), F.col("probe").alias("node")
    )
    asked = materialize(join_keys(asked, placed.select("node", "root"), "node", "inner"))
    stored = join_keys(placed, blocks, ["hub", "salt"], "inner").select(
        "hub", "salt", "node", "root", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    asked, stored = (
        join_keys(sets, narrow, "node", "inner").select(*keys, "node", "root", "grams")
        for narrow in (asked, materialize(stored))
    )
    asked = asked.toDF(*asked.columns)  # columns of its own: both sides come from the same tables
    found = stored.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        lambda a, b: cross_links(a, b, rule), LINKS
    )
    return materialize(found)


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 90,
    chunk_sets: int = CHUNK_SETS, chunk_grams: int = CHUNK_GRAMS,
) -> DataFrame:
    """``doc_id, key, n_shingles, component_id`` for each row of ``docs``.

    Rows are linked if their sets of ``size``-word n-grams have ``percent`` per cent of their union
    in common; texts of fewer words are one n-gram. ``component_id``: the smallest id reachable,
    itself included. Null, empty and blank texts have an empty set and are linked with nothing.
    Rows with equal sets are always linked; a repeated id stands for each of its texts; a null id
    is never a component's id unless there is no other; an empty table gives no rows; other columns
    are not read. ``key`` is that of ``common.row_key``.
    """
    rule = Jaccard(percent)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("key", row_key("doc_id", "text"))
    screened = materialize(map_rows(rows.select("doc_id", "key", "text"), _screener(size, rule), SCREENED))
    classes = screened.filter("n > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("least_id"), F.min("key").alias("key"), F.count(F.lit(1)).alias("rows"),
        F.first("n").alias("n"), F.first("first").alias("first"),
    )
    classes = materialize(materialize(classes).withColumn("node", F.monotonically_increasing_id()))
    possible = join_keys(classes.select("node", "key", "rows"), _possible(classes, rule), "node", "inner")
    sets = _sets(rows, materialize(possible), size)

    first = _first_grams(sets, rule)
    chunks = _chunked(first, chunk_sets, chunk_grams)
    roots = components(_first_links(sets, chunks, rule))
    placed = materialize(chunks.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    second = _other_links(sets, first, placed, rule, chunk_sets)

    of = placed.select("node", "root")
    bridged = second.join(of.withColumnsRenamed({"node": "a", "root": "root_a"}), "a").join(
        of.withColumnsRenamed({"node": "b", "root": "root_b"}), "b"
    ).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    bridges = components(bridged).select(F.col("node").alias("root"), F.col("root").alias("top"))
    tops = join_keys(of, bridges, "root", "left").select("node", F.coalesce("top", "root").alias("top"))
    known = classes.select("node", "set_key", "least_id").join(tops, "node", "left")
    known = materialize(known.select("set_key", "least_id", F.coalesce("top", "node").alias("top")))
    ids = known.groupBy("top").agg(F.min("least_id").alias("component"))
    known = materialize(known.join(ids, "top").select("set_key", "component"))
    done = screened.select("doc_id", "key", F.col("n").alias("n_shingles"), "set_key").join(known, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return done.select("doc_id", "key", "n_shingles", component.alias("component_id"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join(table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")
