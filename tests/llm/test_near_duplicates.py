import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fathom.llm import near_duplicates as module
from fathom.llm.common import table
from fathom.llm.components import components
from fathom.llm.near_duplicates import _Words, near_duplicates, one_of_each, op5_near_duplicates, shingle_hashes

SPACE = " \t\n\x0b\x0c\r"


def shingles(text, size):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in "".join(" " if c in SPACE else c for c in low).split(" ") if w]
    if not words:
        return frozenset()
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for k, (d, _) in enumerate(rows) if find(k) == find(i) and d is not None]
        comp = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), comp, comp == doc_id))
    return sorted(out, key=str)


def run(df, **options):
    got = near_duplicates(df, **options).collect()
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got], key=str)


def corpus(seed, groups=6, copies=12, length=80):
    """Groups of copies with few to many edits, around a passage that all share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    passage = [word() for _ in range(12)]
    rows = []
    for _ in range(groups):
        base = passage + [word() for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 10])):
                k = rng.randrange(len(text))
                text[k : k + rng.choice([0, 1, 1, 2])] = [word()] * rng.choice([0, 1, 1])
            rows.append((rng.randrange(10**6), " ".join(text)))
    rows += [(rng.randrange(10**6), " ".join(passage + [word() for _ in range(length)])) for _ in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, percent, short_list", [(3, 85, 32), (5, 80, 2), (3, 85, 1)])
def test_against_brute_force(spark, documents, size, percent, short_list):
    rows = corpus(size + short_list)
    want = brute(rows, size, percent)
    assert 3 < sum(not r[3] for r in want) < len(rows) - 3
    assert run(documents(rows), shingle=size, percent=percent, short_list=short_list) == want


def test_one_large_group(spark, documents):
    rows = corpus(9, groups=1, copies=150, length=60)
    assert run(documents(rows), shingle=3, percent=85, short_list=8) == brute(rows, 3, 85)


def test_odd_rows(spark, documents):
    long = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one\ttwo "), (8, "É a b"), (9, "é a b"),
            (10, long), (11, long + " end"), (12, long), (12, long), (None, long), (None, "alone here now"), (None, None),
            (4, "the same id with another text"), (20, "a b c"), (20, "a b c"), (13, "one\xa0two"), (2, "")]
    df = documents(rows)
    want = brute(rows, 3, 85)
    assert run(df, shingle=3, percent=85) == want
    kept = one_of_each(df, near_duplicates(df, shingle=3, percent=85))
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, None), (2, ""), (2, ""), (3, " \n\t"), (4, "one"), (6, "one two"), (8, "É a b"), (9, "é a b"), (10, long),
                          (None, "alone here now"), (None, None), (4, "the same id with another text"), (20, "a b c"),
                          (13, "one\xa0two")], key=str)


def test_empty_table(documents):
    assert run(documents([])) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "É", "é", " ", "\n", "\xa0", "\x1c", "日", "\x0b", " ", "ab"])).map("".join), st.integers(1, 6))
def test_shingles(text, size):
    assert len(shingle_hashes(text, size, _Words())) == len(shingles(text, size))


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(500, 400 + i) for i in range(50)]
    rng.shuffle(links)
    root = {n: n for link in links for n in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: find(n) for n in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_given_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = sorted(map(tuple, op5_near_duplicates(spark, sf_dir).collect()), key=str)
    assert got == brute(rows, 3, 85)


def test_estimate_follows_the_binomial_tail():
    from math import comb

    from fathom.llm.near_duplicates import MISSED, Threshold

    for percent in (80, 85, 95):
        for k in (1, 7, 32):
            least, t = Threshold(percent).least_common(k), percent / 100
            below = [sum(comb(k, c) * t**c * (1 - t) ** (k - c) for c in range(n)) for n in (least, least + 1)]
            assert below[0] <= MISSED < below[1]


def test_only_sizes_that_fit_are_compared(spark, monkeypatch):
    """Texts with one long passage in common and ends of many lengths: a class meets few hubs."""
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join(passage + [f"own{d}x{i}" for i in range(d % 60)]) for d in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    compared, verified = [], module._verified

    def watched(rows, pairs, classes, *args):
        n = {r["node"]: r["n"] for r in classes.select("node", "n").collect()}
        compared.extend((n[r["a"]], n[r["b"]]) for r in pairs.collect())
        return verified(rows, pairs, classes, *args)

    monkeypatch.setattr(module, "_verified", watched)
    found = near_duplicates(docs, shingle=5, percent=80)
    got = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert compared and all(100 * min(p) >= 80 * max(p) for p in compared)
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    least = list(range(len(sets)))
    links = [(a, b) for a, one in enumerate(sets) for b, other in enumerate(sets) if 100 * len(one & other) >= 80 * len(one | other)]
    for _ in sets:
        for a, b in links:
            least[a] = min(least[a], least[b])
    assert [got[d] for d in range(len(sets))] == least
