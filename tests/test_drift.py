import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from fathom.functions.similarity import _common_subsequence, natural_sort_key
from fathom.operators import drift as R
from fathom.operators import paths as P


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b):
            previous, row[j + 1] = row[j + 1], previous + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def ratio(a, b):
    a, b = (" ".join(sorted(re.sub(r"[\W_]", " ", x.lower()).split())) for x in (a, b))
    return round(200 * lcs(a, b) / (len(a) + len(b))) if a and b else 0


def names_of(seed, n):
    rng = random.Random(seed)
    stems = ["geospatial", "lat", "min", "max", "time", "coverage", "Serial", "number", "x", "qc2"]
    out = {"", "--", "Conventions", "conventions", "a"}
    while len(out) < n:
        name = rng.choice("_- ").join(rng.sample(stems, rng.randint(1, 3)))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(name) + 1)
            name = name[:i] + rng.choice(["", "z", "é"]) + name[i + rng.randint(0, 1):]
        out.add(name)
    return sorted(out)


def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 70))) for _ in range(2))
        assert _common_subsequence(a, b) == lcs(a, b)


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "attribute string")


@pytest.mark.parametrize("seed, cutoff", [(1, 80), (2, 90), (3, 60)])
def test_pairs_equal_brute_force(spark, seed, cutoff):
    names = names_of(seed, 120)
    want = {
        (a, b): ratio(a, b)
        for a, b in itertools.permutations(names, 2)
        if ratio(a, b) >= cutoff
    }
    got = R.similar_pairs(frame(spark, names), cutoff).collect()
    assert len(got) == len({(r.a, r.b) for r in got})
    assert {(r.a, r.b): r.score for r in got} == want and want
    plan = R.similar_pairs(frame(spark, names), cutoff)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def natural(name):
    return [(0, int(p), "") if p.isdigit() else (1, 0, p) for p in re.findall(r"\d+|\D+", name.lower())]


def clusters(names, cutoff, limit):
    ordered = sorted(names, key=lambda n: (natural(n), n))
    place = {n: i for i, n in enumerate(ordered)}
    leader = {}
    for name in ordered:
        if name in leader:
            continue
        others = [m for m in ordered if m != name and ratio(name, m) >= cutoff]
        best = sorted(others, key=lambda m: (-ratio(name, m), place[m]))
        for member in [name, *(best if limit is None else best[: limit - 1])]:
            leader.setdefault(member, name)
    return leader


@pytest.mark.parametrize("seed, limit", [(1, 5), (4, None)])
def test_clusters_equal_one_pass(spark, seed, limit):
    names = names_of(seed, 90)
    got = {r.member: r.leader for r in R.attribute_clusters(frame(spark, names), 80, limit).collect()}
    assert got == clusters(names, 80, limit)
    assert len(set(got.values())) < len(names)


def test_natural_order(spark):
    names = ["b", "A10", "a9", "a09b", "10", "9", "a"]
    got = frame(spark, names).orderBy(natural_sort_key(F.col("attribute")), "attribute").collect()
    assert [r.attribute for r in got] == sorted(names, key=lambda n: (natural(n), n))


PAYLOADS = [
    '{"global_attrs":{"title":"x","n":1},"variables":{"T":{"attrs":{"u":1.5},"dims":["a"]}},"coordinates":{}}',
    '{"global_attrs":{"title":null,"n":true},"variables":{},"coordinates":{}}',
]


def test_payload_paths(spark):
    df = spark.createDataFrame([(p,) for p in PAYLOADS], "metadata string")
    got = {(r.path, r.kind): r.n_rows for r in P.payload_paths(df).collect()}
    assert got == {
        ("global_attrs", "object"): 2, ("variables", "object"): 2, ("coordinates", "object"): 2,
        ("global_attrs.title", "string"): 1, ("global_attrs.title", "null"): 1,
        ("global_attrs.n", "integer"): 1, ("global_attrs.n", "boolean"): 1,
        ("variables.T", "object"): 1, ("variables.T.attrs", "object"): 1,
        ("variables.T.dims", "array"): 1, ("variables.T.attrs.u", "number"): 1,
    }
    merged = {(r.path, r.kind): r.required for r in P.infer_json_schema(df).collect()}
    assert merged.keys() == got.keys()
    assert {p for (p, _), required in merged.items() if not required} == {"variables.T"}
    keys = [(r.attribute, r.n_files) for r in R.attribute_keys(df).collect()]
    assert keys == [("n", 2), ("title", 2)]


def test_suggestions(spark):
    names = ["featuretype", "Conventions", "conventionss", "site_code", "Site_Code", "zzz"]
    got = {(r.field, r.key): r.same_normalized for r in R.mapping_suggestions(frame(spark, names)).collect()}
    assert got[("conventions", "conventionss")] is False
    assert got[("site_code", "Site_Code")] is True
    assert ("site_code", "site_code") not in got and ("conventions", "Conventions") not in got


def test_deep_payload_paths(spark, monkeypatch):
    """Any depth, one parse of a payload, whatever the size of a task's tree."""
    deep = '{"a":{"b":{"c":{"d":{"e":{"f":{"g":{"h":{"i":1}}}},"x":{}}}}}}'
    payloads = [(deep,), ('{"a":{"b":2}}',), ("[1]",), (None,), ('{"a":%d,"n":NULL}'.replace("NULL", "1e400") % 2**70,)]
    df = spark.createDataFrame(payloads, "metadata string")
    path = "a.b.c.d.e.f.g.h.i"
    want = {(path[: 2 * i + 1], "object"): 1 for i in range(8)} | {("a", "object"): 2, (path, "integer"): 1}
    want |= {("a.b", "integer"): 1, ("a.b.c.d.x", "object"): 1, ("a", "number"): 1, ("n", "number"): 1}
    for nodes in (200_000, 3):
        monkeypatch.setattr(P, "MOST_NODES", nodes)
        assert {(r.path, r.kind): r.n_rows for r in P.payload_paths(df).collect()} == want
    required = {r.path: r.required for r in P.infer_json_schema(df).collect()}
    assert required["a"] and required["a.b"] and required["a.b.c"] and required[path] and not required["n"]
    plan = P.payload_paths(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "variant" not in plan
    chain = 900
    one = spark.createDataFrame([('{"k":' * chain + "0" + "}" * chain,)], "metadata string")
    assert P.payload_paths(one).count() == chain
    assert P.payload_paths(df.limit(0)).collect() == P.infer_json_schema(df.limit(0)).collect() == []


def test_payload_that_is_not_json(spark):
    for bad in ('{"a":NaN}', "{", ""):
        with pytest.raises(Exception, match="JSON|Expecting"):
            P.payload_paths(spark.createDataFrame([(bad,)], "metadata string")).collect()


def test_few_pairs_meet(spark):
    """Below a twentieth of all pairs meet in the join, fewer are scored, and none is lost."""
    from fathom.functions.similarity import sorted_ratio, token_sorted
    from fathom.operators import alike
    from suite.q_profile import _vocabulary

    names = _vocabulary(spark, "/root/testdata/sf0.01")
    texts = names.select(token_sorted(F.col("attribute")).alias("text")).filter("text <> ''").distinct()
    index = alike.letter_index(texts).cache()
    met = alike.met_pairs(index, 0.795).cache()
    left = alike.likely(met, index, 0.795)
    n = index.count()
    assert left.count() <= met.count() < 0.05 * n * (n + 1) / 2
    some = index.filter("crc32(text) % 8 = 0").select("text", "len")
    a, b = some.toDF("short", "m"), some.toDF("long", "n")
    every = a.join(b, (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("short") < F.col("long"))))
    alike_ones = lambda df: {tuple(r) for r in df.withColumn("s", sorted_ratio("short", "long")).filter("s >= 80").select("short", "long").collect()}
    want = alike_ones(every)
    assert len(want) > 10 and want == alike_ones(left.join(a.select("short"), "short").join(b.select("long"), "long"))


def test_short_texts_and_wide_cutoffs(spark):
    """Texts of a letter or two, and cutoffs at which nearly all letters may be missing."""
    rng = random.Random(7)
    names = sorted({"".join(rng.choices("abé0", k=rng.randint(1, 7))) for _ in range(150)} | {"a", "A", "aa", "a a", "é"})
    for cutoff in (51, 67, 100):
        want = {(a, b): ratio(a, b) for a, b in itertools.permutations(names, 2) if ratio(a, b) >= cutoff}
        got = R.similar_pairs(frame(spark, names), cutoff).collect()
        assert {(r.a, r.b): r.score for r in got} == want and len(got) == len(want)


def test_numbers_with_a_common_ending_meet_by_their_digits(spark):
    """Among many plain numbers the letters of ``html`` are the rare ones, but no pair meets by them."""
    from fathom.functions.similarity import sorted_ratio
    from fathom.operators import alike

    rng = random.Random(3)
    texts = {f"{n} html" for n in rng.sample(range(10_000, 100_000), 300)} | {str(n) for n in rng.sample(range(10_000, 100_000), 1_200)}
    index = alike.letter_index(frame(spark, texts).withColumnRenamed("attribute", "text"))
    met = alike.met_pairs(index, 0.795).cache()
    assert 0 < met.count() == met.filter(sorted_ratio("short", "long") >= 80).count()


@pytest.mark.parametrize("block", [1_000, 7])
def test_a_chain_of_names_takes_no_more_rounds_than_blocks(spark, monkeypatch, block):
    """Each name is like the next one only, so every role depends on the one before."""
    names = ["".join(chr(0x4E00 + i + j) for j in range(10)) for i in range(40)]
    written = []
    monkeypatch.setattr(R, "BLOCK_NAMES", block)
    monkeypatch.setattr(R, "materialize", lambda df, real=R.materialize: written.append(df) or real(df))
    got = {r.member: r.leader for r in R.attribute_clusters(frame(spark, names), 90).collect()}
    assert got == {n: names[i - i % 2] for i, n in enumerate(names)}
    assert len(written) <= 2 + 3 * (len(names) // block + 1)


def test_joins_of_names_do_not_go_by_the_size_of_files(spark):
    """Files of names are small for what they unfold to: with stored names nothing but the letters is broadcast."""
    from fathom.operators import alike
    from fathom.session import materialize

    names = materialize(frame(spark, names_of(5, 60)).union(frame(spark, ["a-b", "a_b", "A b", "b a"])))
    index = materialize(alike.letter_index(names.toDF("text")))
    pairs = materialize(index.select(F.col("text").alias("short"), F.col("text").alias("long")))
    for joined in (alike.met_pairs(index, 0.795), alike.likely(pairs, index, 0.795), R.similar_pairs(names, 80)):
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    letters = alike.letter_index(names.toDF("text"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in letters and "BuildRight" in letters
    got = {(r.a, r.b): r.score for r in R.similar_pairs(names, 80).collect()}
    assert {k for k in got if set(k) <= {"a-b", "a_b", "A b", "b a"}} == set(itertools.permutations(["a-b", "a_b", "A b", "b a"], 2))


def test_places_are_broadcast_by_their_number(spark, monkeypatch):
    """Clusters are the same however few places a join may send to all tasks, and beyond that none is sent."""
    names = names_of(6, 80)
    got = []
    for few in (R.FEW_PLACES, 3):
        monkeypatch.setattr(R, "FEW_PLACES", few)
        found = R.attribute_clusters(frame(spark, names), 80)
        got.append(sorted(found.collect()))
        assert ("Broadcast" in found._jdf.queryExecution().executedPlan().toString()) == (few > 3)
    assert got[0] == got[1] and {r.member: r.leader for r in got[0]} == clusters(names, 80, None)
