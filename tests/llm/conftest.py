"""Small tables for the operators: nulls, empty and long texts, repeated rows, clashing names."""

import pytest


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text, and columns whose names operators use themselves)."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, 1, "x", 0.5) for i, t in rows],
            "doc_id bigint, text string, length int, kind string, score double",
        ).repartition(3)

    return make
