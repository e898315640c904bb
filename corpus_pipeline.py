"""The training-data pipeline over ``documents``; each stage calls one operator of fathom.llm.

Each stage's rows are written as Parquet to the shared folder and read again as the next one's
documents, so a lost executor never replays an earlier stage. A stage works on all that its
predecessor kept and keeps the columns of ``documents``; the last returns packed pieces. Rows
with a null or empty text pass all filters and pack to the end id alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathom.llm import decontaminate, near_duplicates, packing, personal_data, toxicity
from fathom.llm.common import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not reject."""
    labels = toxicity.training_labels(table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of alike ones: five-word shingles, similarity 0.8 or more."""
    return near_duplicates.one_of_each(docs, near_duplicates.near_duplicates(docs, shingle=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked and what gives it away generalised or removed."""
    return personal_data.sanitise(docs, personal_data.personal_data(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, as op1 returns them."""
    return packing.digest(packing.pack(docs))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", sanitise),
    ("packing", pack),
]

#: Training a classifier and tokenizing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
