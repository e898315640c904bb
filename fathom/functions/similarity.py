"""Likeness of attribute names, and their natural order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def natural_sort_key(text: Column) -> Column:
    """Key under which text orders as people order it: case aside, numbers by value.

    Runs of digits lose leading zeros and get their length in front, so that longer (larger)
    numbers follow shorter ones.
    """
    lowered = F.lower(text)
    runs = F.regexp_extract_all(lowered, F.lit(r"(\d+|\D+)"), 1)
    return F.transform(
        runs,
        lambda r: F.when(
            r.rlike(r"^\d"),
            F.concat(
                F.lit("0"),
                F.lpad(F.length(F.ltrim(r, F.lit("0"))).cast("string"), 10, "0"),
                F.ltrim(r, F.lit("0")),
            ),
        ).otherwise(F.concat(F.lit("1"), r)),
    )


def token_sorted(text: Column) -> Column:
    """Lower-cased words in order; everything that is not a letter or digit parts words."""
    words = F.split(F.lower(F.regexp_replace(text, r"(?U)[^\p{L}\p{N}]", " ")), r"\s+")
    return F.array_join(F.array_sort(F.filter(words, lambda w: w != "")), " ")


def numbered_letters(text: Column) -> Column:
    """Its letters in order, each with the number of equal ones up to it: no two are the same."""
    ordered = F.array_sort(F.split(text, ""))
    return F.transform(ordered, lambda c, i: F.concat(c, (i + 2 - F.array_position(ordered, c)).cast("string")))


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits per character of ``b``."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(T.LongType())
def sorted_ratio(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Score 0-100 of two token-sorted texts: twice the common subsequence over both lengths."""
    for left, right in columns:
        yield pd.Series(
            [
                round(200 * _common_subsequence(a, b) / (len(a) + len(b))) if a and b else 0
                for a, b in zip(left, right)
            ],
            dtype="int64",
        )
