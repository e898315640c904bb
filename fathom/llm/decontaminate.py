"""Benchmark decontamination by a prefix-filtered set join; DataFrame functions only.

An item is cut into windows of 13 words (a shorter one is one window), a window is a set of
two-word shingles with their places. A document holds a window only if it holds all of its
shingles, so the rarest one is a sufficient prefix: documents and windows are joined on that
one alone. The place of the shingle gives where the window would begin; it must lie inside the
document. What is left is compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import ascii_lower, bind, join_keys, materialize, row_key, table

WINDOW = 13
#: A document is contaminated if so many of its words, as a share, are hit: 1 in 20.
LEAST_SHARE = 20
#: Shingles looked for in one pass over the documents. They are literals of the plan; a
#: benchmark with more of them takes a pass for each part.
SHINGLES_A_PASS = 200_000

#: What separates words, once A-Z are lower-case.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), _GAPS), lambda w: w != "")


def _shingles(ws: Column, size: int) -> Column:
    """``(pos, h)`` of each shingle of ``size`` words (1 or 2)."""
    if size == 1:
        return F.transform(ws, lambda w, i: F.struct(i.alias("pos"), F.xxhash64(w).alias("h")))
    pair = F.transform(ws, lambda w, i: F.struct(i.alias("pos"), F.xxhash64(w, F.get(ws, i + 1)).alias("h")))
    return F.slice(pair, 1, F.greatest(F.size(pair) - 1, F.lit(0)))


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = WINDOW) -> DataFrame:
    """``item_id, window``: the words of each window joined by a space (no word holds one)."""
    cut = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("ws")).filter(F.size("ws") > 0)
    last = F.greatest(F.size("ws") - length, F.lit(0))
    starts = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(F.col("ws"), i + 1, length), " "))
    return cut.select("item_id", F.explode(F.array_distinct(starts)).alias("window"))


def _window_shingles(wins: DataFrame) -> DataFrame:
    """``window, n, size, offset, h`` of all shingles of all different windows."""
    split = wins.select("window").distinct().withColumn("ws", F.split("window", " "))
    shingle = F.when(F.size("ws") == 1, _shingles(F.col("ws"), 1)).otherwise(_shingles(F.col("ws"), 2))
    size = F.when(F.size("ws") == 1, 1).otherwise(2)
    return split.select("window", F.size("ws").alias("n"), size.alias("size"), F.explode(shingle).alias("s")).select(
        "window", "n", "size", F.col("s.pos").alias("offset"), F.col("s.h").alias("h")
    )


def _found_shingles(docs: DataFrame, wanted: dict[int, list[int]]) -> DataFrame:
    """``key, doc_id, n_words, found``: places in each document of the wanted shingles."""

    def found(ws: Column) -> Column:
        parts = [_wanted(_shingles(ws, size), size, hashes) for size, hashes in wanted.items()]
        return F.struct(F.size(ws).alias("n_words"), F.concat(*parts).alias("found"))

    both = docs.select("doc_id", "key", bind(words(F.col("text")), found).alias("r"))
    return materialize(both.select("doc_id", "key", "r.n_words", "r.found"))


def _wanted(shingles: Column, size: int, hashes: list[int]) -> Column:
    kept = F.filter(shingles, lambda s: s["h"].isin(hashes))
    return F.transform(kept, lambda s: F.struct(F.lit(size).alias("size"), s["pos"].alias("pos"), s["h"].alias("h")))


def _occurrences(docs: DataFrame, shingles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents (``doc_id, key, n_words``), and ``key, hits`` of those that hold windows."""
    wanted: dict[int, list[int]] = {}
    for row in shingles.select("size", "h").distinct().collect():
        wanted.setdefault(row["size"], []).append(row.h)
    found = _found_shingles(docs, wanted or {2: [0]})
    places = found.select("key", "n_words", F.explode("found").alias("f")).select(
        "key", "n_words", F.col("f.size").alias("size"), F.col("f.pos").alias("pos"), F.col("f.h").alias("h")
    )
    # How often each shingle occurs in all documents; a window with one that does not is out.
    counts = places.groupBy("size", "h").count()
    total = F.count(F.lit(1)).alias("shingles")
    rarest = F.min(F.struct("count", "h", "offset")).alias("r")
    prefixes = shingles.join(counts, ["size", "h"], "left").groupBy("window", "n", "size").agg(
        rarest, total, F.count("count").alias("known")
    ).filter(F.col("known") == F.col("shingles"))
    prefixes = materialize(prefixes.select("window", "n", "size", "r.h", "r.offset"))
    start = F.col("pos") - F.col("offset")
    inside = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    # At most one prefix of each window, so as few rows as ``SHINGLES_A_PASS`` allows.
    candidates = places.join(F.broadcast(prefixes), ["size", "h"]).filter(inside)
    at = F.struct(start.alias("start"), "n", "window")
    candidates = materialize(candidates.groupBy("key").agg(F.collect_set(at).alias("at")))

    held = join_keys(docs.select("key", "text"), candidates.select("key"), "key", "left_semi")
    held = held.dropDuplicates(["key"]).join(candidates, "key")

    def hits(ws: Column) -> Column:
        return F.filter("at", lambda a: F.array_join(F.slice(ws, a["start"] + 1, a["n"]), " ") == a["window"])

    verified = held.select("key", bind(words(F.col("text")), hits).alias("hits")).filter(F.size("hits") > 0)
    return found.select("doc_id", "key", "n_words"), verified


def _covered(hits: Column) -> Column:
    """Words inside any of the hits, each counted once."""
    spans = F.array_sort(F.transform(hits, lambda a: F.struct(a["start"].alias("low"), (a["start"] + a["n"]).alias("high"))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(seen: Column, span: Column) -> Column:
        fresh = F.greatest(span["high"] - F.greatest(seen["end"], span["low"]), F.lit(0))
        return F.struct(F.greatest(seen["end"], span["high"]).alias("end"), (seen["n"] + fresh).alias("n"))

    return F.aggregate(spans, zero, add, lambda seen: seen["n"])


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", length: int = WINDOW,
    shingles_a_pass: int = SHINGLES_A_PASS,
) -> DataFrame:
    """``doc_id, key, n_words, n_hit, item_ids`` for each row of ``docs``.

    ``n_hit``: words inside an occurrence of a window; ``item_ids``: sorted texts of the ids of
    items with occurring windows. Null, empty and wordless texts of either side have nothing;
    items may repeat, with the same id or another; rows equal in id and text share a ``key``
    and have equal results; an empty table on either side gives no hits; other columns are not
    read. The documents are cut into words once, and those with candidates once more.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("key", row_key("doc_id", "text"))
    wins = materialize(windows(items, item_id_col, item_text_col, length))
    shingles = materialize(_window_shingles(wins))
    different = shingles.select("size", "h").distinct().count()
    passes = max(1, -(-different // shingles_a_pass))
    everyone, hits = None, None
    for k in range(passes):
        # A window is in one part, with all its shingles.
        part = shingles.filter(F.pmod(F.xxhash64("window"), F.lit(passes)) == k) if passes > 1 else shingles
        found, verified = _occurrences(rows, part)
        everyone = everyone or found
        hits = verified if hits is None else hits.unionByName(verified)
    if passes > 1:
        hits = hits.groupBy("key").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    hits = materialize(hits)
    covered = hits.select("key", _covered(F.col("hits")).alias("n_hit"))
    held = hits.select("key", F.explode(F.array_distinct(F.transform("hits", lambda a: a["window"]))).alias("window"))
    named = held.join(wins, "window").select("key", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    result = materialize(covered.join(named, "key", "left"))
    none = F.array().cast("array<string>")
    return everyone.join(result, "key", "left").select(
        "doc_id", "key", F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"),
    )


def contaminated(least_share: int = LEAST_SHARE) -> Column:
    return (F.col("n_hit") > 0) & (least_share * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) without the contaminated rows."""
    name = "__row_key"
    found = contamination(docs, items).filter(contaminated())
    keys = materialize(found.select(F.col("key").alias(name)).distinct())
    return join_keys(docs.withColumn(name, row_key("doc_id", "text")), keys, name, "left_anti").drop(name)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


#: Occurrences by an equality join of all 13-word windows; shorter items are compared in text.
ORACLE_SQL = rf"""
WITH cut AS (
    SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
worded AS (
    SELECT side, id, list_filter(
        regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
        lambda w: w <> '') AS ws
    FROM cut),
items AS (
    SELECT id AS item_id, least(len(ws), {WINDOW}) AS n,
           unnest(list_transform(range(1, greatest(len(ws) - {WINDOW}, 0) + 2),
                                 lambda i: array_to_string(ws[i : i + {WINDOW} - 1], ' '))) AS win
    FROM worded WHERE side = 'b' AND len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM items),
places AS (
    SELECT id AS doc_id, n, unnest(range(1, len(ws) - n + 2)) AS start, ws
    FROM worded, sizes WHERE side = 'd' AND len(ws) >= n),
hits AS (
    SELECT doc_id, start, p.n, item_id FROM places p
    JOIN items i ON i.n = p.n AND i.win = array_to_string(ws[start : start + p.n - 1], ' ')),
covered AS (
    SELECT doc_id, count(DISTINCT spot) AS n_hit
    FROM (SELECT doc_id, unnest(range(start, start + n)) AS spot FROM hits) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {LEAST_SHARE} * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM worded w LEFT JOIN covered c ON c.doc_id = w.id LEFT JOIN named n ON n.doc_id = w.id
WHERE side = 'd'
"""
