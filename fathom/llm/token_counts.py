"""Token counts by rank-synchronous merging of ragged arrays.

The pre-tokens that a batch has not seen before lie in one flat array of symbols. Each round
finds the lowest-rank pair of every pre-token and merges all its occurrences in all pre-tokens
at once, until no pair is left; what counts is the number of symbols that survive.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import map_rows, table
from fathom.llm.word_pieces import byte_characters

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Pre-tokens whose counts are kept at most; beyond it the store starts anew.
KEPT_WORDS = 1_000_000
#: Symbols merged in one call at most (a longer pre-token is merged on its own).
SYMBOLS = 2_000_000

COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint"

_NONE = np.iinfo(np.int64).max
#: Characters that are a letter, a digit, white space or neither by a later Unicode version
#: only; a text with others than these ranges is cut by the library itself.
_NEWER = re.compile("[՘-᷿ἀ-῿⁰-₟℀-\U0010ffff]")


class RankMerges:
    """The merges of a byte-level vocabulary as sorted arrays."""

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        path = public_tokenizers.path(vocabulary)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.base = len(vocab) + 1
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        keys = left * self.base + right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.first = np.array([vocab[c] for c in byte_characters()], dtype=np.int64)
        self.library = Tokenizer.from_file(path)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))))
        self.marks = tuple(special)
        self.split = regex.compile(public_tokenizers.PATTERN).findall

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each word when no pair can be merged any more."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out = lengths.copy()
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        while len(symbols) > 1:
            pair = symbols[:-1] * self.base + symbols[1:]
            at = np.searchsorted(self.keys, pair)
            at[at == len(self.keys)] = 0
            known = (self.keys[at] == pair) & (owner[:-1] == owner[1:])
            rank = np.where(known, self.ranks[at], _NONE)
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(np.append(rank, _NONE), start)
            size = np.diff(np.append(start, len(owner)))
            out[owner[start]] = size
            mine = np.repeat(lowest, size)
            hit = np.flatnonzero((rank == mine[:-1]) & known)
            if not len(hit):
                break
            # Of overlapping occurrences (a a a) the first, third, ... are merged.
            run = np.flatnonzero(np.r_[True, np.diff(hit) != 1])
            nth = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
            hit = hit[nth % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            keep = mine != _NONE
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if len(symbols):
            last, left = np.unique(owner, return_counts=True)
            out[last] = left
        return out


class TokenCounter:
    def __init__(self, vocabulary: str, kept: int = KEPT_WORDS) -> None:
        self._merges = RankMerges(vocabulary)
        self._kept = kept
        self._known: dict[str, int] = {}

    def _cut(self, text: str) -> list[str]:
        if not text.isascii() and _NEWER.search(text):
            return [text[a:b] for _, (a, b) in self._merges.library.pre_tokenizer.pre_tokenize_str(text)]
        return self._merges.split(text)

    def _learn(self, words: list[str]) -> None:
        known, some, size = self._known, [], 0
        for word in words:
            some.append(word)
            size += len(word)
            if size >= SYMBOLS:
                known.update(zip(some, self._merges.counts([w.encode() for w in some]).tolist()))
                some, size = [], 0
        if some:
            known.update(zip(some, self._merges.counts([w.encode() for w in some]).tolist()))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a special string inside a text is one token."""
        if len(self._known) > self._kept:
            self._known.clear()
        special, known = self._merges.special, self._known
        out, pending, size = [], [], 0
        fresh: set[str] = set()

        def settle() -> None:
            self._learn(sorted(fresh))
            out.extend([n + sum(map(known.__getitem__, words)) for n, words in pending])
            pending.clear()
            fresh.clear()

        for text in texts:
            marks, parts = 0, [text]
            if any([m in text for m in self._merges.marks]):
                parts = special.split(text)
                marks = len(parts) - 1
            words = self._cut(parts[0]) if len(parts) == 1 else [w for p in parts for w in self._cut(p)]
            fresh.update(set(words).difference(known))
            pending.append((marks, words))
            size += len(text)
            if size >= SYMBOLS:
                settle()
                size = 0
        settle()
        return out


def _counter(vocabulary: str) -> Callable[[], Callable]:
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        counter = TokenCounter(vocabulary)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(counter.counts(texts), pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

        return step

    return make


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, one row for each row of ``docs``.

    Null and empty texts have no tokens; repeated rows are counted each; an empty table gives
    no rows; other columns are not read. One row-local pass without a shuffle: no source or
    group of copies can make a task longer than its split of the input.
    """
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return map_rows(rows, _counter(vocabulary), COUNTS).withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
