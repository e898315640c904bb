import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fathom.llm.ngram_join import Jaccard, Trie, ngram_join, op11_ngram_join
from fathom.llm.common import table

SPACE = " \t\n\x0b\x0c\r"


def grams(text, size):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in "".join(" " if c in SPACE else c for c in low).split(" ") if w]
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(rows, size, percent):
    sets = [grams(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for k, (d, _) in enumerate(rows) if find(k) == find(i) and d is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id))
    return sorted(out, key=str)


def run(df, **options):
    got = ngram_join(df, **options).collect()
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str)


def corpus(seed, groups, copies, length):
    """Groups of copies with no to many edits, around a passage that all share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    passage = [word() for _ in range(12)]
    rows = []
    for _ in range(groups):
        base = passage + [word() for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6])):
                k = rng.randrange(len(text))
                text[k : k + rng.choice([0, 1, 1, 2])] = [word()] * rng.choice([0, 1, 1])
            rows.append((rng.randrange(10**6), " ".join(text)))
    rows += [(rng.randrange(10**6), " ".join(passage + [word() for _ in range(length)])) for _ in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, percent, chunk_sets", [(3, 90, 256), (3, 90, 4), (2, 80, 2)])
def test_against_brute_force(spark, documents, size, percent, chunk_sets):
    rows = corpus(size + chunk_sets, groups=7, copies=14, length=140)
    want = brute(rows, size, percent)
    assert 10 < len({r[2] for r in want}) < len(rows) - 20
    assert run(documents(rows), size=size, percent=percent, chunk_sets=chunk_sets) == want


def test_one_large_group(spark, documents):
    """Near copies in many small chunks: what is linked across chunks is found."""
    rows = corpus(5, groups=1, copies=260, length=90)
    assert run(documents(rows), chunk_sets=8) == brute(rows, 3, 90)


def test_odd_rows(spark, documents):
    long = " ".join(f"w{i % 7919}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  two three four"),
            (8, "one two three\tFOUR"), (None, "a b c d"), (9, "a b c d"), (None, None), (10, long), (11, long + " end"),
            (12, long), (4, "one"), (13, "Été x y z"), (14, "été x y z")]
    assert run(documents(rows)) == brute(rows, 3, 90)


def test_empty(spark, documents):
    assert run(documents([(1, "x")]).filter("doc_id > 1")) == []
    assert run(documents([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]


sets_of = st.lists(st.sets(st.integers(0, 14), min_size=1), min_size=1, max_size=12, unique_by=frozenset)


@settings(max_examples=200, deadline=None)
@given(sets_of, st.sets(st.integers(0, 18), min_size=1), st.sampled_from([51, 70, 90, 100]))
def test_tree_finds_what_is_linked(sets, probe, percent):
    ordered = sorted(sorted(s) for s in sets)
    trie = Trie([np.array(s) for s in ordered])
    held = np.zeros(15, bool)
    mine = np.array(sorted(x for x in probe if x < 15), dtype=np.int64)
    held[mine] = True
    found = list(trie.probe(mine, len(probe), held, Jaccard(percent), lambda low, high: False))
    assert found == [
        i for i, s in enumerate(ordered) if 100 * len(probe & set(s)) >= percent * len(probe | set(s))
    ]


def test_tree_leaves_subtrees():
    """Paths that cannot reach the overlap, or are closed, are not walked."""
    sets = [np.array([0, 1, 2, 10 + i]) for i in range(20)] + [np.array([5, 30 + i, 60 + i, 90 + i]) for i in range(20)]
    trie, held, seen = Trie(sets), np.zeros(120, bool), []
    mine = np.array([0, 1, 2, 13])
    held[mine] = True
    assert list(trie.probe(mine, 4, held, Jaccard(90), lambda low, high: seen.append((low, high)))) == [3]
    assert len(seen) < 25
    assert list(trie.probe(mine, 4, held, Jaccard(90), lambda low, high: True)) == []


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 400), st.integers(1, 400), st.integers(51, 100), st.data())
def test_bounds(n, m, percent, data):
    """Sets at the least overlap share their first elements as far as the bounds promise."""
    rule = Jaccard(percent)
    shared = rule.least_shared(n, m)
    if shared > min(n, m):
        return
    assert rule.linked(shared, n, m) and not rule.linked(shared - 1, n, m)
    rng = random.Random(data.draw(st.integers(0, 10**6)))
    order = rng.sample(range(10**6), n + m - shared)
    a, b = sorted(order[:n]), sorted(order[n - shared :])
    assert len(set(a[: rule.screen(n)]) & set(b[: rule.screen(m)])) >= rule.least_screened(n)
    assert set(a[: rule.spare(n) + 1]) & set(b[: rule.spare(m) + 1])


def test_query_on_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    got = op11_ngram_join(spark, sf_dir)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows, 3, 90)
