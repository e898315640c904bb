import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from fathom.llm.common import table
from fathom.llm.decontaminate import contaminated, contamination, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        ws = cut(text)
        for i in range(max(len(ws) - 13, 0) + 1 if ws else 0):
            windows.setdefault(tuple(ws[i : i + 13]), set()).add(str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        ws, hit, ids = cut(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                found = windows.get(tuple(ws[i : i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    ids |= found
        out.append((doc_id, len(ws), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


def run(spark, documents, docs, items, **options):
    bench = spark.createDataFrame([(i, t, 1, "k") for i, t in items], "item_id bigint, text string, n int, key string")
    got = contamination(documents(docs), bench, **options).withColumn("c", contaminated())
    return sorted([(r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.c) for r in got.collect()], key=str)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog, and THEN it sleeps for nine hours; or so."), (2, "Alpha beta."),
         (3, "einzig"), (4, None), (5, " ... "), (6, "a a a a a a a a a a a a a a a"), (7, "Alpha-beta"), (8, "É é"),
         (1, "a second text with the very same id, which has more than thirteen words in it.")]


def test_cases(spark, documents):
    passage = ITEMS[0][1]
    docs = [(1, f"Before {passage.upper()} after"), (2, passage.replace("lazy", "busy")), (3, None), (4, ""), (5, "!!!"),
            (6, "alpha beta alpha beta x einzig"), (7, "a " * 40), (8, "a " * 12), (9, "w " * 1000 + passage + " v" * 1000),
            (9, "the same id, another text: einzig"), (6, "alpha beta alpha beta x einzig"), (None, "é É é alpha"),
            (10, "fox jumps over the lazy dog and then it sleeps for nine hours or"), (11, "É é beta alpha"), (12, "beta")]
    want = brute(docs, ITEMS)
    assert sum(r[2] > 0 for r in want) >= 8 and any(r[4] for r in want)
    assert run(spark, documents, docs, ITEMS) == want
    assert run(spark, documents, docs, ITEMS, shingles_a_pass=3) == want


def test_random_words_with_ties(spark, documents):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choices("abc", k=n))
    items = [(i, text(rng.choice([1, 2, 5, 12, 13, 14, 20]))) for i in range(12) if i not in (3,)]
    items = [(i, t if len(t.split()) > 1 else "zz") for i, t in items]
    docs = [(i, text(rng.randint(0, 300))) for i in range(40)]
    docs += [(100 + i, f"{text(5)} {t} {text(30)}") for i, t in items]
    assert run(spark, documents, docs, items) == brute(docs, items)


def test_words(spark):
    texts = ["a\x00b", "Ab9\x7fc", "é_É", "x y z", "日本 語", "", None, " lead"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(words(F.col("t")).alias("w"))
    assert [r.w for r in df.collect()] == [cut(t) for t in texts]


@pytest.mark.parametrize("docs, items", [([], ITEMS), ([(1, "a b")], []), ([], [])])
def test_empty_tables(spark, documents, docs, items):
    assert run(spark, documents, docs, items) == brute(docs, items)


def test_only_native_operators(spark, documents):
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    plan = contamination(documents([(1, "a b")]), bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    from fathom.llm.decontaminate import op10_decontaminate

    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in op10_decontaminate(spark, sf_dir).collect()]
    digest = lambda ids: hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert sorted(got, key=str) == sorted([(d, n, h, len(ids), digest(ids), c) for d, n, h, ids, c in want], key=str)
    assert any(r[-1] for r in got)
