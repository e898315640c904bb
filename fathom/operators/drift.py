"""Attribute drift: what keys the payloads use, which look alike, and how fields map."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.functions.attributes import MAPPED_FIELDS, normalize_name, to_number
from fathom.functions.similarity import natural_sort_key
from fathom.operators import alike
from fathom.operators.extract import readable
from fathom.operators.ranking import with_position
from fathom.session import materialize

# Likeness from which names are alike, likeness of a suggestion, and the two
# bounds of a flagged field.
ALIKE = 80
SUGGESTION = 90
FLAG_PRESENT_PCT = 20.0
FLAG_POPULATED_PCT = 5.0
# End of fixed values.

#: Names of a block, which one task settles together with their matches before them.
BLOCK_NAMES = 8_192

#: Rows of places (a number or two each) up to which a join may send them to all tasks.
FEW_PLACES = 200_000


def global_attribute_names(column: str = "metadata") -> Column:
    return F.json_object_keys(F.get_json_object(column, "$.global_attrs"))


def attribute_keys(payloads: DataFrame, column: str = "metadata") -> DataFrame:
    """Global attribute names with their file counts, in natural order."""
    names = payloads.select(F.explode(global_attribute_names(column)).alias("attribute"))
    counted = names.groupBy("attribute").agg(F.count(F.lit(1)).alias("n_files"))
    return counted.orderBy(natural_sort_key(F.col("attribute")), "attribute")


def similar_pairs(names: DataFrame, cutoff: int = ALIKE, column: str = "attribute") -> DataFrame:
    """Pairs ``(a, b, score)`` of distinct names whose score reaches the cutoff."""
    return alike.similar_pairs(names, cutoff, column)


def attribute_clusters(
    names: DataFrame,
    cutoff: int = ALIKE,
    limit: int | None = None,
    column: str = "attribute",
) -> DataFrame:
    """Clusters of alike names as rows ``(leader, member)``.

    In natural order a name that no earlier leader took becomes a leader and takes its still
    free matches (with ``limit`` its best ones only, itself included). The names are cut into blocks
    of that order, each the work of a task, and the rule is applied in rounds: a task goes through
    its block, and a name is a leader once all earlier names matching it are known to be members,
    and a member once one of them is a leader. A block is settled the round after those before it at
    the latest, so there are no more rounds than blocks, however long a chain of names is.
    """
    pairs = similar_pairs(names, cutoff, column)
    distinct = names.select(F.col(column).alias("name")).distinct()
    placed = materialize(with_position(distinct, [natural_sort_key(F.col("name")), F.col("name")]).select("name", "idx"))
    edges = pairs.join(placed.toDF("a", "place_a").hint("merge"), "a").join(placed.toDF("b", "place_b").hint("merge"), "b")
    if limit is not None:
        # The best matches per name, ties by order; the name itself is one of them.
        best = Window.partitionBy("a").orderBy(F.desc("score"), "place_b")
        edges = edges.withColumn("_rank", F.row_number().over(best)).filter(
            F.col("_rank") <= limit - 1
        )
    edges = materialize(
        edges.filter("place_a < place_b").select(F.col("place_a").alias("a"), F.col("place_b").alias("b"))
    )
    roles = _roles(placed.select("idx"), edges)
    leaders = roles.filter("leads").select(F.col("idx").alias("a"))
    # All that a leader matches are members.
    taken = edges.join(_few(leaders), "a").groupBy("b").agg(F.min("a").alias("a"))
    pairs_taken = taken.unionByName(leaders.withColumn("b", F.col("a")))
    leader, member = placed.toDF("leader", "a").hint("merge"), placed.toDF("member", "b").hint("merge")
    return pairs_taken.join(leader, "a").join(member, "b").select("leader", "member")


def _few(places: DataFrame) -> DataFrame:
    """``places`` as the smaller side of a join: by their number and not by the size of their files."""
    few = places.limit(FEW_PLACES + 1).count() <= FEW_PLACES
    return places.hint("broadcast" if few else "merge")


def _roles(places: DataFrame, edges: DataFrame) -> DataFrame:
    """``idx, leads`` for each place; ``edges`` (a, b) from earlier to later places."""
    block_names = BLOCK_NAMES

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        """Roles of a block's names that can be told; a row without ``a`` stands for the name itself."""
        rows = rows.sort_values("b")
        a, b = rows["a"].fillna(-1).to_numpy().astype("int64"), rows["b"].to_numpy()
        led = rows["leads"].to_numpy().astype(bool)
        first = int(b[0]) // block_names * block_names
        known = np.zeros(block_names, dtype="int8")  # 1 for leaders, 2 for members
        cuts = np.flatnonzero(np.diff(b, prepend=-1))
        for low, high in zip(cuts, [*cuts[1:], len(b)]):
            before = a[low:high]
            inside = known[np.maximum(before - first, 0)] * (before >= first)
            if led[low:high].any() or (inside == 1).any():
                known[b[low] - first] = 2
            elif ((inside == 2) | (before < 0)).all():
                known[b[low] - first] = 1
        told = np.flatnonzero(known)
        return pd.DataFrame({"idx": told + first, "leads": known[told] == 1})

    free, done = places, []
    edges = edges.withColumn("leads", F.lit(False))
    n_blocks = places.count() // block_names + 1
    for _ in range(n_blocks):
        own = free.select(F.lit(None).cast("bigint").alias("a"), F.col("idx").alias("b"), F.lit(False).alias("leads"))
        block = F.floor(F.col("b") / block_names)
        told = materialize(
            edges.select("a", "b", "leads").unionByName(own).groupBy(block.alias("_block")).applyInPandas(settle, "idx bigint, leads boolean")
        )
        done.append(told)
        free = materialize(free.join(_few(told), "idx", "left_anti"))
        if free.isEmpty():
            return reduce(DataFrame.unionByName, done)
        # What is between names still free, or from a leader to one.
        role = _few(told.toDF("a", "_leads"))
        edges = materialize(
            edges.join(_few(told.select(F.col("idx").alias("b"))), "b", "left_anti").join(role, "a", "left")
            .filter("_leads is null or _leads")
            .select("a", "b", (F.col("leads") | F.coalesce("_leads", F.lit(False))).alias("leads"))
        )
    raise RuntimeError("attribute_clusters: a round settled no block")


def _number_of(numbers: dict[str, int]):
    """Function from a name to its number, -1 for names without one."""
    table = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    return lambda name: F.coalesce(F.element_at(table, name), F.lit(-1))


def _flags_of(names: Column) -> list[tuple[Column, Column]]:
    """Per mapped field whether its name is among ``names``, and whether only spelled otherwise.

    Names become numbers of the fields they belong to, once exactly and once without case.
    """
    exact_of = _number_of({a: i for i, f in enumerate(MAPPED_FIELDS) for a in f.aliases})
    loose_of = _number_of({a.lower(): i for i, f in enumerate(MAPPED_FIELDS) for a in f.aliases})
    exact = F.transform(names, exact_of)
    loose = F.transform(names, lambda n: loose_of(F.lower(n)))
    return [
        (F.array_contains(exact, i), F.array_contains(loose, i) & ~F.array_contains(exact, i))
        for i in range(len(MAPPED_FIELDS))
    ]


def _field_sums(files: DataFrame, names: Column, populated: list[Column]) -> DataFrame:
    """Per facility and mapped field the counts of ``mapping_correctness``, and those over all.

    Files are read once and only added up, map-side first; the sums over all facilities come
    from those of each.
    """
    tests = [
        F.struct(key.alias("key"), filled.alias("populated"), (key & ~filled if f.numeric else F.lit(False)).alias("lost"),
                 case_only.alias("case_only")).alias(f"_{f.name}")
        for f, (key, case_only), filled in zip(MAPPED_FIELDS, _flags_of(names), populated)
    ]
    parts = ("key", "populated", "lost", "case_only")
    flagged = files.select("facility", *tests)
    sums = [F.struct(*[F.count_if(f"_{f.name}.{p}").alias(p) for p in parts]).alias(f"_{f.name}") for f in MAPPED_FIELDS]
    wide = materialize(flagged.groupBy("facility").agg(F.count(F.lit(1)).alias("n_files"), *sums))
    totals = [F.struct(*[F.sum(f"_{f.name}.{p}").alias(p) for p in parts]).alias(f"_{f.name}") for f in MAPPED_FIELDS]
    whole = wide.agg(F.sum("n_files").alias("n_files"), *totals).filter("n_files > 0")
    every = wide.unionByName(whole.withColumn("facility", F.lit(None).cast("string")))
    cells = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("field"), F.col(f"_{f.name}.key").alias("n_key"),
                F.col(f"_{f.name}.populated").alias("n_populated"), F.col(f"_{f.name}.lost").alias("n_cast_failed"),
                F.col(f"_{f.name}.case_only").alias("n_case_only"),
            )
            for f in MAPPED_FIELDS
        ]
    )
    return every.select("facility", "n_files", F.inline(cells)).select(
        "*",
        (F.col("n_key") * 100.0 / F.col("n_files")).alias("key_pct"),
        (F.col("n_populated") * 100.0 / F.col("n_files")).alias("populated_pct"),
    )


def mapping_correctness(headers: DataFrame) -> DataFrame:
    """Per facility and mapped field, how often the source key is there and the field filled.

    ``n_key`` counts files with one of the field's names, ``n_populated`` filled fields,
    ``n_cast_failed`` files with the name but, for a number, no value, and ``n_case_only``
    files in which only a differently written name is found. The row with the null facility
    sums over all. Counted where headers are extracted: nothing is parsed again or joined.
    """
    files = readable(headers)
    filled = [
        (to_number(F.col(f"raw.{f.name}")) if f.numeric else F.col(f"raw.{f.name}")).isNotNull() for f in MAPPED_FIELDS
    ]
    return _field_sums(files, F.col("global_attrs.name"), filled)


def mapping_correctness_of_tables(
    structured: DataFrame, unstructured: DataFrame, column: str = "metadata"
) -> DataFrame:
    """``mapping_correctness`` of index tables, where the headers are no longer at hand.

    Names and filled fields of a file are in two tables; only names and flags meet.
    """
    filled = structured.select(
        "hash", "facility", *[F.col(f.name).isNotNull().alias(f"_p_{f.name}") for f in MAPPED_FIELDS]
    )
    listed = unstructured.select("hash", global_attribute_names(column).alias("_names"))
    joined = filled.join(listed, "hash")
    return _field_sums(joined, F.col("_names"), [F.col(f"_p_{f.name}") for f in MAPPED_FIELDS])


def mapping_flags(correctness: DataFrame) -> DataFrame:
    """Fields whose key is often there while the field is hardly ever filled."""
    return correctness.filter(
        (F.col("key_pct") >= FLAG_PRESENT_PCT) & (F.col("populated_pct") <= FLAG_POPULATED_PCT)
    )


def mapping_suggestions(names: DataFrame, column: str = "attribute") -> DataFrame:
    """Payload keys that look like a mapped field's name but are none of its names."""
    spark = names.sparkSession
    known = spark.createDataFrame(
        [(f.name, a) for f in MAPPED_FIELDS for a in f.aliases], "field string, alias string"
    )
    every = names.select(F.col(column).alias("name")).unionAll(known.select("alias"))
    pairs = similar_pairs(every, SUGGESTION, "name")
    same_spelling = names.select(F.col(column).alias("key")).distinct()
    hits = pairs.join(F.broadcast(known), pairs["a"] == known["alias"]).select(
        "field", "alias", F.col("b").alias("key"), "score"
    )
    hits = hits.join(same_spelling, "key", "left_semi")
    mapped = known.select("field", F.col("alias").alias("key"))
    return hits.join(F.broadcast(mapped), ["field", "key"], "left_anti").select(
        "field", "key", "score",
        (normalize_name(F.col("key")) == normalize_name(F.col("alias"))).alias("same_normalized"),
    )
