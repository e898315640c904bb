import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.llm.common import table
from fathom.llm.neighbours import _inverted, build_index, footrules, op7_neighbours, search

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, score double, rank int"


def brute(rows, k=10):
    """{query: [(vec_id, distance)]} by all distances."""
    good = [(i, np.array(v, dtype=float)) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for i, v in good:
        if i % 100 == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in good if j != i)
            out[i] = [(j, d) for d, j in near[:k]]
    return out


def test_footrule_from_inverted_files():
    rng = np.random.default_rng(3)
    nearest = np.array([rng.permutation(20)[:7] for _ in range(30)]).astype("<u2")
    files = _inverted(nearest)

    def rank(order, pivot):
        return list(order).index(pivot) if pivot in order else 7

    for query in nearest[:5]:
        want = [sum(abs(rank(query, p) - rank(row, p)) for p in range(20)) for row in nearest]
        assert footrules(nearest, files, query).tolist() == want


def test_recall_on_given_vectors(spark):
    got = {}
    for r in op7_neighbours(spark, SF_DIR).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    rows = [(r.vec_id, list(r.embedding)) for r in table(spark, SF_DIR, "embeddings").collect()]
    want = brute(rows)
    assert got.keys() == want.keys()
    hits = 0
    for q, near in want.items():
        assert sorted(got[q]) == list(range(1, 11))
        found = [got[q][k] for k in range(1, 11)]
        assert [d for _, d in found] == sorted(d for _, d in found)
        hits += len({i for i, _ in found} & {i for i, _ in near})
    assert hits >= 0.9 * 10 * len(want)


def test_recall_over_many_blocks(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16))
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], SCHEMA)
    index = build_index(df, pivots=64, prefix=32)
    got = search(index, index.filter("vec_id % 100 = 0"), least=20, share=0.1, block_rows=500, block_queries=7).collect()
    want = brute([(i, np.float32(v).tolist()) for i, v in rows])
    hits = len({(r.query_id, r.vec_id) for r in got} & {(q, i) for q, near in want.items() for i, _ in near})
    assert len(got) == 300 and hits >= 270


def test_odd_vectors_copies_and_ties(spark):
    one, far = [1.0, 0.0, 2.0], [-5.0, 1.0, 1.0]
    rows = [(i, one) for i in range(0, 300)] + [(300, far), (301, None), (302, [0.0, 0.0, 0.0]), (303, [1.0, None, 2.0]),
            (304, [1.0, float("nan"), 2.0]), (305, [float("inf"), 0.0, 1.0]), (None, one), (400, None), (306, [1.0]),
            (307, [1.0, 0.0, 3.0]), (307, [1.0, 0.0, 3.0]), (300, far)]
    df = spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], SCHEMA).repartition(5)
    index = build_index(df)
    got = search(index, index.filter("vec_id % 100 = 0"), block_rows=50, block_queries=1, least=5, share=0.01).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by.keys() == {0, 100, 200, 300}
    for q in (0, 100, 200):  # all at distance 0: the smallest ids
        assert by[q] == [(i, 0.0) for i in range(12) if i != q][:10]
    assert [i for i, _ in by[300]] == list(range(10))
    few = df.filter(F.col("vec_id").isin(100, 300, 307))
    index = build_index(few)
    got = search(index, index.filter("vec_id % 100 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [
        (100, 1, 307), (100, 2, 300), (300, 1, 100), (300, 2, 307)]
    assert next(r.score for r in got if r.query_id == 100 and r.rank == 1) == pytest.approx(1.0)


def test_empty(spark):
    index = build_index(spark.createDataFrame([], SCHEMA))
    assert search(index, index).count() == 0


def test_a_repeated_row_crowds_no_other_out(spark):
    """Twelve copies of one row, and another row of the same vector."""
    rows = [(0, [1.0, 1.0])] + [(5, [1.0, 2.0])] * 12 + [(6, [1.0, 2.0]), (7, [9.0, 9.0])]
    index = build_index(spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], SCHEMA))
    got = search(index, index.filter("vec_id = 0"), k=2).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(5, 1.0), (6, 1.0)]


def test_each_length_by_itself(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a) for a in rng.normal(size=3)]) for i in range(80)]
    rows += [(100 + i, [float(a) for a in rng.normal(size=5)]) for i in range(15)]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    index = build_index(spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], SCHEMA).repartition(4))
    got = search(index, index.filter("vec_id IN (0, 100)"), k=10)
    for q, low, high in ((0, 0, 100), (100, 100, 200)):
        want = brute([(i, v) for i, v in rows if low <= i < high])[q]
        assert [r.vec_id for r in got.filter(f"query_id = {q}").orderBy("rank").collect()] == [i for i, _ in want]


def test_a_length_without_pivots(spark, monkeypatch):
    """A length that the sample does not hold is searched in full."""
    from fathom.llm import neighbours

    monkeypatch.setattr(neighbours, "PIVOT_ROWS", 1)
    rows = [(i, [float(i + 1), 1.0] if i % 9 else [float(i + 1), 1.0, 2.0]) for i in range(40)]
    index = build_index(spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], SCHEMA))
    assert index.filter("length(nearest) = 0").count()
    got = search(index, index.filter("vec_id IN (0, 1)"), k=3, least=1, share=0.01).orderBy("query_id", "rank").collect()
    lone = index.filter("length(nearest) = 0").first().dim
    own = [r.vec_id for r in got if r.query_id == (0 if lone == 3 else 1)]
    assert own == ([9, 18, 27] if lone == 3 else [2, 3, 4])
