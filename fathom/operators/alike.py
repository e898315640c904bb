"""Pairs of alike names, by an index of the letter groups of every text.

The score of two texts follows from their longest common subsequence, so a cutoff says how many
letters of either may be missing in the other at most: ``lost`` of the shorter, ``gained`` of the
longer one. Let a text's letters be ordered by rarity in all texts, equal ones by place. Among
the first ``lost + g`` of the shorter text's letters at least ``g`` are common ones, among the
first ``gained + g`` of the longer text's too, and the first ``g`` common letters are the same in
both: equal letters in the same order of places, each moved by no more than the missing letters.
So each text names all groups of ``g`` of its first letters, and two alike texts have a group in
common, near the same places. Groups of rare letters bring few texts together.

Texts that are short for what they may lack name what is left of them instead: the shorter one
without any ``lost`` of its letters, the longer one without any ``gained``. Two texts have such a
rest in common exactly if they have letters enough in common in order, so no others meet. In short
texts the rare letters may be the ones that most of them end in (``html`` among numbers).

Files of names are small for what they unfold to, so the optimizer, which goes by the size of files,
would send the driver tables that grow with the names. All joins of names are merge joins by hint.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.similarity import numbered_letters, sorted_ratio, token_sorted
from fathom.session import materialize

#: Letters of a group, and up to how many missing letters so many are taken: a text with more
#: of them would name too many groups.
GROUPS = ((3, 6), (2, 18))

#: Missing letters, and the most letters of a text that names its rests without so many of them.
RESTS = ((1, 200), (2, 20), (3, 11))


@dataclass(frozen=True)
class Bounds:
    """What two texts of ``short`` and ``long`` letters may lack, with the least likeness given."""

    short: Column
    long: Column
    least: float

    @property
    def common(self) -> Column:
        """Letters that the two have in common in order at least, for a score of ``least``."""
        return F.ceil(self.least * (self.short + self.long) / 2 - 1e-9)

    @property
    def lost(self) -> Column:
        return self.short - self.common

    @property
    def gained(self) -> Column:
        return self.long - self.common

    @property
    def by_rests(self) -> Column:
        """Whether texts of these lengths meet by their rests: the longer one has few."""
        return reduce(lambda a, b: a | b, ((self.gained <= missing) & (self.long <= most) for missing, most in RESTS))

    @property
    def letters(self) -> Column:
        """How many letters make a group: never more than are common."""
        chosen = F.lit(1)
        for letters, most in reversed(GROUPS):
            chosen = F.when(self.gained <= most, letters).otherwise(chosen)
        return F.least(chosen, self.common)


def _groups(letters: Column, size: Column) -> Column:
    """All groups of ``size`` of ``letters`` (at, letter), as ``(name, places)``, in order of places."""
    def behind(i: Column) -> Column:
        return F.slice(letters, i + 2, F.size(letters))

    def group(*chosen: Column) -> Column:
        return F.struct(F.concat(*[c["letter"] for c in chosen]).alias("name"), F.array(*[c["at"] for c in chosen]).alias("places"))

    ones = F.transform(letters, lambda x: group(x))
    twos = F.flatten(F.transform(letters, lambda x, i: F.transform(behind(i), lambda y: group(x, y))))
    threes = F.flatten(F.flatten(F.transform(
        letters,
        lambda x, i: F.transform(behind(i), lambda y, j: F.transform(F.slice(letters, i + j + 3, F.size(letters)), lambda z: group(x, y, z))),
    )))
    return F.when(size == 3, threes).when(size == 2, twos).otherwise(ones)


def _rests(text: Column, missing: Column) -> Column:
    """All different texts that are left of ``text`` without ``missing`` of its letters."""
    def one_less(texts: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(texts, lambda t: F.transform(
            F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t)))
        ))))

    left = [F.array(text)]
    for _ in RESTS:
        left.append(one_less(left[-1]))
    chosen = left[0]
    for n, texts in enumerate(left[1:], 1):
        chosen = F.when(missing == n, texts).otherwise(chosen)
    return chosen


def letter_index(texts: DataFrame) -> DataFrame:
    """``text, len, counted, letters``: a row per text with its letters, the rarest first.

    ``letters`` has ``(n, letter, at)``: how often it occurs in all texts, itself, its place.
    ``counted`` has every letter with a number, so that equal letters differ.
    """
    placed = texts.select("text", F.posexplode(F.split("text", "")).alias("at", "letter"))
    often = placed.groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
    # The letters of all texts are few; by letter the places would go to as few tasks.
    ranked = placed.join(F.broadcast(often), "letter").groupBy("text").agg(
        F.array_sort(F.collect_list(F.struct("n", "letter", "at"))).alias("letters")
    )
    return ranked.select("text", F.length("text").alias("len"), numbered_letters(F.col("text")).alias("counted"), "letters")


def _met_by_both(index: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """``short, long``: different texts that have a rest in common, and those with a group in common.

    All that may be alike are among them; the first have letters enough in common in order.
    """
    most = F.floor(F.col("len") * (2.0 - least) / least + 1e-9)
    fewest = F.greatest(F.ceil(F.col("len") * least / (2.0 - least) - 1e-9), F.lit(1))
    length = F.col("len").cast("bigint")
    keys = ["short_len", "long_len"]
    bounds = Bounds(F.col("short_len"), F.col("long_len"), least)
    different = (F.col("short_len") < F.col("long_len")) | (F.col("short") < F.col("long"))
    # Without a missing letter only equal texts are alike.
    apart = bounds.lost + bounds.gained > 0

    def rest(side: DataFrame, role: str, missing: Column) -> DataFrame:
        side = side.filter(apart & bounds.by_rests)
        return side.select(*keys, F.col("text").alias(role), F.explode(_rests(F.col("text"), missing)).alias("rest"))

    def named(side: DataFrame, role: str, missing: Column) -> DataFrame:
        side = side.filter(apart & ~bounds.by_rests)
        first = F.slice("letters", 1, (missing + bounds.letters).cast("int"))
        by_place = F.array_sort(F.transform(first, lambda x: F.struct(x["at"].alias("at"), x["letter"].alias("letter"))))
        side = side.select(*keys, F.col("text").alias(role), bounds.letters.alias("size"), by_place.alias("first"))
        groups = side.select(*keys, role, F.explode(_groups(F.col("first"), F.col("size"))).alias("g"))
        return groups.select(*keys, role, F.col("g.name").alias("name"), F.col("g.places").alias(f"{role}_at"))

    shorter = index.select("text", "letters", length.alias("short_len"), F.explode(F.sequence(length, most)).alias("long_len"))
    longer = index.select("text", "letters", length.alias("long_len"), F.explode(F.sequence(fewest, length)).alias("short_len"))
    left_over = rest(longer, "long", bounds.gained).hint("merge")
    by_rests = rest(shorter, "short", bounds.lost).join(left_over, [*keys, "rest"]).filter(different)
    moved = F.zip_with("long_at", "short_at", lambda a, b: a - b)
    fits = F.forall(moved, lambda m: (m >= -bounds.lost) & (m <= bounds.gained)) & different
    met = named(shorter, "short", bounds.lost).join(named(longer, "long", bounds.gained).hint("merge"), [*keys, "name"])
    return by_rests.select("short", "long").distinct(), met.filter(fits).select("short", "long").distinct()


def met_pairs(index: DataFrame, least: float) -> DataFrame:
    """``short, long``: different texts that meet; all that may be alike are among them."""
    by_rests, by_groups = _met_by_both(index, least)
    return by_rests.unionByName(by_groups)


def likely(pairs: DataFrame, index: DataFrame, least: float) -> DataFrame:
    """Of ``pairs`` (short, long) those with letters enough in common, whatever their order."""
    of_short = index.select(F.col("text").alias("short"), F.col("counted").alias("of_short")).hint("merge")
    of_long = index.select(F.col("text").alias("long"), F.col("counted").alias("of_long")).hint("merge")
    both = pairs.join(of_short, "short").join(of_long, "long")
    common = F.size(F.array_intersect("of_short", "of_long"))
    total = F.size("of_short") + F.size("of_long")
    return both.filter(2 * common >= least * total - 1e-9).select("short", "long")


def similar_pairs(names: DataFrame, cutoff: int, column: str = "attribute") -> DataFrame:
    """Pairs ``(a, b, score)`` of distinct names whose score reaches the cutoff, in both directions.

    Names are compared by their words in order (``token_sorted``); names without letter or digit
    have no pair. Texts of a rest or a group meet in an equi-join on both lengths and that; of those
    that meet by a group only the ones with letters enough in common are scored. No rule loses a pair.
    """
    least = (cutoff - 0.5) / 100.0
    if not 0.5 < least <= 1.0:
        raise ValueError("cutoff must lie between 51 and 100")
    distinct = names.select(column).distinct().withColumn("sorted", token_sorted(F.col(column)))
    distinct = materialize(distinct.filter(F.col("sorted") != ""))
    index = letter_index(distinct.select(F.col("sorted").alias("text")).distinct())
    # A text of some bytes names some hundred groups: its rows are the work of all cores.
    index = materialize(index.repartition(index.sparkSession.sparkContext.defaultParallelism))
    by_rests, by_groups = _met_by_both(index, least)
    scored = (
        by_rests.unionByName(likely(by_groups, index, least))
        .withColumn("score", sorted_ratio("short", "long"))
        .filter(F.col("score") >= cutoff)
    )
    scored = materialize(scored)
    left = distinct.select(F.col(column).alias("a"), F.col("sorted").alias("short")).hint("merge")
    right = distinct.select(F.col(column).alias("b"), F.col("sorted").alias("long")).hint("merge")
    # A pair of texts is there once; its names are looked up once for both directions.
    found = scored.join(left, "short").join(right, "long")
    there, back = F.struct("a", "b", "score"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "score")
    equal = left.join(right, F.col("short") == F.col("long")).filter(F.col("a") != F.col("b"))
    return found.select(F.inline(F.array(there, back))).unionByName(
        equal.select("a", "b", F.lit(100).cast("bigint").alias("score"))
    )
