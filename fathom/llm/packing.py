"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two of n: as many of
``max_len`` as fit, then one for each set bit below, longest first. Every piece is a sequence
of its own, so none crosses documents and none is padded; batches are made of one bucket of
equal lengths (``write_buckets``).
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import map_rows, table
from fathom.llm.word_pieces import WordPieces

MAX_LEN = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"

PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"


def decompose(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Lengths of the pieces of n tokens, longest first; they add up to n."""
    lengths = [max_len] * (n // max_len)
    rest, bit = n % max_len, max_len >> 1
    while rest:
        if rest & bit:
            lengths.append(bit)
            rest -= bit
        bit >>= 1
    return lengths


def _packer(vocabulary: str, max_len: int, end_id: int) -> Callable[[], Callable]:
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        words = WordPieces(vocabulary)
        end = struct.pack("<I", end_id)
        shapes: dict[int, list[int]] = {}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, starts, lengths, totals, buffers = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = words.pieces(text.as_py() or "") + end
                n = len(raw) // 4
                shape = shapes.get(n)
                if shape is None:
                    shape = shapes[n] = decompose(n, max_len)
                at = 0
                for length in shape:
                    starts.append(at)
                    buffers.append(raw[4 * at : 4 * (at + length)])
                    at += length
                ids += [doc_id] * len(shape)
                lengths += shape
                totals += [n] * len(shape)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(buffers, pa.binary()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids"],
            )

        return step

    return make


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_len: int = MAX_LEN,
    end_id: int = END_ID,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit token ids. A null or empty text is the end id
    alone, so every row of ``docs`` has at least one piece; a repeated row is packed again; an
    empty table gives no piece; other columns are not read. ``max_len`` must be a power of two.
    ``sequence_id`` is unique and counts within a partition of the input; one row-local pass,
    without a shuffle, whatever the lengths or sources are.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError(f"not a power of two: {max_len}")
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    pieces = map_rows(rows, _packer(vocabulary, max_len, end_id), PIECES)
    return pieces.withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")}
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Pieces as Parquet, a folder for each length: a batch is read from one folder.

    The rebalance hint lets Spark split the frequent lengths over many tasks.
    """
    bucketed = pieces.withColumn("bucket", F.col("length"))
    bucketed.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(path)


def digest(pieces: DataFrame) -> DataFrame:
    """One row per piece, its ids as a checksum."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))
