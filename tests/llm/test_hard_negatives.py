import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import suite.check as check
from fathom.llm import hard_negatives as H

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, anchor=lambda i: True, positives=5, negatives=10):
    """Rows (vec_id, vector, label), each other row compared by plain loops."""
    usable = set()
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.add((i, tuple(math.floor(256 * x) for x in v), label))
    out = []
    for i, v, label in usable:
        if not anchor(i):
            continue
        others = [(-sum(a * b for a, b in zip(v, w)), j, lab) for j, w, lab in usable if j != i and len(w) == len(v)]
        others.sort()
        for p, positive, _ in [o for o in others if o[2] == label][:positives]:
            found = [o for o in others if o[2] != label and 30 * -p <= 100 * -o[0] <= 90 * -p][:negatives]
            out += [(i, positive, rank, j, -p, -s) for rank, (s, j, _) in enumerate(found, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, 7, "y") for r in rows], "vec_id bigint, embedding array<float>, label int, score int, cell string"
    ).repartition(3)


def run(spark, rows, **options):
    return sorted(tuple(r[c] for c in COLUMNS) for r in H.mine(frame(spark, rows), **options).collect())


def vectors(seed, n, dim, groups=5):
    """Groups around centres, in eighths so that scores tie."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    rows = np.round((centres[rng.integers(0, groups, n)] + 0.4 * rng.normal(size=(n, dim))) * 8) / 8
    return [(int(i), [float(x) for x in row], int(rng.integers(0, 4))) for i, row in zip(rng.permutation(n), rows)]


@pytest.mark.parametrize("dim", [2, 5])
def test_against_brute_force(spark, monkeypatch, dim):
    for name, value in (("CELL_ROWS", 40), ("LEAF_ROWS", 8), ("SPLITS", 4)):
        monkeypatch.setattr(H, name, value)
    rows = vectors(dim, 400, dim)
    got = run(spark, rows, anchors=F.col("vec_id") % 7 == 0, chunk_rows=32)
    assert got == brute(rows, lambda i: i % 7 == 0) and len(got) > 500


def test_levels_of_a_chunk():
    """Every level of the tree, against all scores, for windows wide and narrow."""
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.normal(size=(3000, 4)) * rng.choice([0.2, 1.0], size=(3000, 1)))
    ids, labels = np.arange(3000), rng.integers(0, 3, 3000)
    q = x[:40]
    scores = H.inner(q, x)
    for low, high in ((-H.OPEN, H.OPEN - 1), (20_000, 40_000), (-5_000, 5_000)):
        search = H.Search({"vector": q, "own": ids[:40], "label": labels[:40], "low": np.full(40, low), "high": np.full(40, high)}, False, 10)
        search.visit(x, ids, labels, np.arange(40))
        for i in range(40):
            want = sorted((-s, j) for j, s in enumerate(scores[i]) if labels[j] != labels[i] and low <= s <= high)[:10]
            assert [(-s, j) for s, j in zip(search.score[i], search.id[i]) if s > -H.OPEN] == want


def test_siblings_are_eliminated():
    """Far apart groups: a narrow window leaves few siblings."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(16, 8)) * 1000
    x = np.floor(centres[np.arange(1600) % 16] + rng.normal(size=(1600, 8)))
    node, of = H.grow(x)
    norms = (x[:50] ** 2).sum(axis=1)
    alive = node.alive(x[:50], norms, (norms * 0.99).astype(np.int64), np.full(50, H.OPEN - 1))
    assert alive[np.arange(50), of[:50]].all() and alive.sum() < 50 * 4


def test_many_equal_rows(spark):
    """A third of the table is one vector; all of it is found, in order of ids."""
    rows = vectors(8, 200, 4) + [(1000 + i, [1.0, 0.5, 0.25, 0.0], i % 2) for i in range(100)]
    assert run(spark, rows, anchors=F.col("vec_id") % 50 == 0, chunk_rows=16) == brute(rows, lambda i: i % 50 == 0)


def test_odd_rows(spark):
    """Nulls, numbers that are not finite, repeated rows and ids, zero and empty vectors, other lengths."""
    nan, inf = float("nan"), float("inf")
    rng = random.Random(2)
    rows = vectors(5, 60, 3) + [(100 + i, [rng.uniform(-1, 1) for _ in range(5)], i % 3) for i in range(12)]
    rows += [(200, None, 1), (201, [1.0, None, 0.0], 1), (202, [nan, 0.0, 0.0], 1), (203, [inf, 0.0, 0.0], 2), (204, [1.0, 1.0, 1.0], None),
             (None, [1.0, 1.0, 1.0], 1), (205, [0.0, 0.0, 0.0], 1), (206, [], 0), (207, [], 1), (208, [], 0), (7, [0.5, 0.5, -2.0], 3)]
    rows += rows[:20]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, [(1, [1.0], 1)]) == []
    assert H.mine(frame(spark, [(1, [1.0], 1)]).filter("vec_id > 1")).collect() == []


def test_query_and_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    cursor = check.connect(sf_dir).execute(H.ORACLE_SQL)
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(r[names.index(c)] for c in COLUMNS) for r in cursor.fetchall())
    assert sorted(tuple(r[c] for c in COLUMNS) for r in H.op12_hard_negatives(spark, sf_dir).collect()) == want
