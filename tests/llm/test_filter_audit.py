import random
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import suite.check as check
from fathom.llm.filter_audit import Diagram, ORACLE_SQL, audit, neighbouring_swaps, op13_filter_audit, part_steps

SPACE = " \t\n\x0b\x0c\r"


def letters_failed(rows):
    """``(part, doc_id, letters)`` of rows (doc_id, text, lang), by plain loops."""
    out = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = [w for w in "".join(" " if c in SPACE else c for c in text).split(" ") if w]
        failed = "A" if len(words) < 200 else ""
        failed += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        failed += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else ""
        failed += "D" if set(text) & set("#$%&*|") else ""
        before = [o for o, t, _ in rows if (t or "") == text and None not in (o, doc_id) and o < doc_id]
        out.append((lang or "", doc_id, failed + ("E" if before else "")))
    return out


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    failed = letters_failed(rows)
    out = {}
    for part in {p for p, _, _ in failed}:
        own = [(d, f) for p, d, f in failed if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(d, f) for d, f in left if name in f]
                left = [(d, f) for d, f in left if name not in f]
                shapley[name] += len(gone)
                fails = sum(name in f for _, f in own)
                out[part, "".join(order), step] = [
                    len(left), len(gone), fails - len(gone), sum(f == name for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), name,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, lang string, mask int, part string")
    return docs.repartition(3), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def run(spark, rows, labels):
    got = audit(*frames(spark, rows, labels)).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}
    assert len(found) == len(got)
    return found


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        words = rng.choices("ab cd ef gh ij kl mn op qr st uv wx yz".split(), k=rng.choice([3, 190, 210, 260]))
        words = words if rng.random() < 0.3 else [f"{w}{n}" for n, w in enumerate(words)]
        text = " ".join(words) + rng.choice(["", "", " 100%", " | "])
        text = text.upper() if rng.random() < 0.2 else text
        rows.append((i, rows[rng.randrange(i)][1] if i and rng.random() < 0.3 else text, rng.choice(["en", "de", None])))
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 120, 2)] + [(2, 1, 1), (None, 1, 1)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows and ids, an id without label."""
    long = "word " * 300_000
    rows = [(1, None, "en"), (2, "", "en"), (2, "", "en"), (3, None, None), (None, "", "en"), (None, None, ""),
            (4, long, "en"), (5, long, "de"), (5, "Xé ééé", "fr"), (6, " \t\x0b", "fr")]
    labels = [(1, None, None), (2, 1, 0), (2, 0, 1), (None, 1, 1)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    docs, labels = frames(spark, [(1, "a", "en")], [(1, 1, 1)])
    assert audit(docs.filter("doc_id > 1"), labels).collect() == []
    without = audit(docs, labels.filter("doc_id > 1")).collect()
    assert len(without) == 600 and not any(r.good_lost or r.toxic_lost for r in without)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_every_order_once(n):
    order, seen = list(range(n)), [tuple(range(n))]
    for level in neighbouring_swaps(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.append(tuple(order))
    assert sorted(seen) == sorted(permutations(range(n)))


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(0, 15), st.tuples(st.integers(1, 3), st.integers(0, 1), st.integers(0, 1)), min_size=1),
       st.lists(st.integers(0, 2), max_size=12))
def test_swaps_keep_the_diagram_whole(weights, swaps):
    """After any swaps the diagram has the nodes of one that was built in that order."""
    diagram = Diagram(4, weights)
    for level in swaps:
        diagram.swap(level)
    moved = {sum((m >> v & 1) << at for at, v in enumerate(diagram.order)): w for m, w in weights.items()}
    fresh = Diagram(4, moved)
    assert [len(u) for u in diagram.unique] == [len(u) for u in fresh.unique]
    assert [s[1:] for s in diagram.steps()] == [s[1:] for s in fresh.steps()]


def test_shared_branches():
    """Equal branches are one node: masks whose bits do not matter to each other need a node a level."""
    diagram = Diagram(5, {m: (1, 0, 0) for m in range(32)})
    assert [len(u) for u in diagram.unique] == [1] * 5
    assert len(part_steps("ABCDE", {0: (1, 1, 1)})) == 600


def test_query_and_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    cursor = check.connect(sf_dir).execute(ORACLE_SQL)
    names = [d[0] for d in cursor.description]
    want = sorted(dict(zip(names, r)).items() for r in cursor.fetchall())
    got = sorted(r.asDict().items() for r in op13_filter_audit(spark, sf_dir).collect())
    assert [sorted(r) for r in got] == [sorted(r) for r in want]
