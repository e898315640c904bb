import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import profile as P
from fathom.operators.ranking import quantiles, with_position, with_running_total


def test_position_and_running_total(spark):
    values = random.Random(3).choices(range(50), k=700)
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v bigint, i bigint").repartition(5)
    order = [F.col("v"), F.col("i")]
    placed = with_position(df, order).orderBy("idx").collect()
    assert [r.idx for r in placed] == list(range(700))
    assert [(r.v, r.i) for r in placed] == sorted((v, i) for i, v in enumerate(values))
    runs = with_running_total(df, order, "v").orderBy("v", "i").collect()
    assert [r.upto for r in runs] == np.cumsum(sorted(values)).tolist()
    assert with_position(df.filter("v < 0"), order).count() == 0


@pytest.mark.parametrize("method", ["linear", "nearest"])
def test_quantiles_are_exact(spark, method):
    rng = random.Random(5)
    rows = [("hot", 7.0)] * 400 + [("a", rng.choice([1.0, 2.5, 100.0])) for _ in range(37)]
    rows += [(None, float(i)) for i in range(11)] + [("one", 5.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.prob): r.quantile for r in quantiles(df, ["g"], "v", probs, method).collect()}
    assert len(got) == 4 * len(probs)
    for g in ("hot", "a", None, "one"):
        values = sorted(v for h, v in rows if h == g and v is not None)
        for p in probs:
            if method == "linear":
                want = float(np.quantile(values, p))
            else:
                want = values[int((len(values) - 1) * p + 0.5)]
            assert got[g, p] == pytest.approx(want)


def test_quantile_bins_are_right_closed(spark):
    df = spark.createDataFrame([("f", s * 1024) for s in range(1, 101)], "facility string, size bigint")
    got = {r.size_bin: r.n_files for r in P.quantile_bins(df, bins=4).collect()}
    assert got == {0: 25, 1: 25, 2: 25, 3: 25}
    equal = spark.createDataFrame([("f", 1024)] * 9 + [("f", 0)], "facility string, size bigint")
    assert [tuple(r) for r in P.quantile_bins(equal).collect()] == [("f", 0, 9)]


def test_fixed_bins_are_left_closed(spark):
    mb = 1024**2
    df = spark.createDataFrame(
        [("f", s) for s in (0, 1, mb - 1, mb, 10 * mb, 6000 * mb)], "facility string, size bigint"
    )
    got = {r.label: r.n_files for r in P.fixed_bins(df).collect()}
    assert got == {"[-inf, 1)": 2, "[1, 10)": 1, "[10, 50)": 1, "[5000, inf)": 1}


def test_sums_do_not_overflow(spark):
    df = spark.createDataFrame([("f", "k.nc", 2**62)] * 4, "facility string, key string, size bigint")
    assert int(P.corpus_totals(df).first().total_bytes) == 2**64
    assert P.collection_sizes(df).first().n_files == 4
