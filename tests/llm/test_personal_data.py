import hashlib
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fathom.llm.common import table
from fathom.llm.personal_data import KINDS, digest, op4_personal_data, personal_data, sanitise

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in CONTRACT.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(int(p) for p in m[0].split(".")) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def base(df):
    got = {}
    for r in personal_data(df).collect():
        got.setdefault(r.doc_id, []).append([(s.kind, s.start, s.stop) for s in r.spans if s.kind in KINDS])
    return got


PARTS = ["a", "é", "@", ".", "b.c", "x@y.z", "_", "-", " ", "1", "255", "256", "4111 1111 1111 1111", "4111-1111-1111-1112",
         "+1 (555) 123-4567", "+", "00", "1.2.3.4", "%", "\n", "日", "(", "007.1.1.1", "12345678901234567"]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), min_size=100, max_size=150))
def test_base_spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert base(df) == {i: [brute(t)] for i, t in enumerate(texts)}


def test_odd_and_long_texts(spark, documents):
    texts = [None, "", "a@b.c_d@e.f", "1" * 4_000, "a" * 4_000, "a." * 3_000 + "@", "a@b" + ".c" * 20_000, "+1" + " " * 50_000 + "2",
             "1 " * 30_000, "0000000000000000000000000000000000000000001.2.3.4", "1.2.3.4.5.6.7.8",
             " ".join(f"u{i}@h{i}.org" for i in range(4000))]
    rows = list(enumerate(texts))
    assert base(documents(rows)) == {i: [brute(t)] for i, t in rows}


def corpus():
    """A name next to one address in many contexts, and nowhere else; a common word there too."""
    rows = [(i, f"note{chr(97 + i)} says Zebulon, owner of boss@corp.example, agreed again with the plan.") for i in range(8)]
    rows += [(100 + i, f"the plan number {i} says again it was agreed with the owner of something else") for i in range(200)]
    rows += [(400 + i, "wholly equal text by Quentin at same@copy.example today") for i in range(6)]
    return rows


def test_terms_that_disclose(spark, documents):
    rows = corpus()
    got = {r.doc_id: r.spans for r in personal_data(documents(rows)).collect()}
    texts = dict(rows)
    for i in range(8):
        found = {texts[i][s.start : s.stop]: s.act for s in got[i] if s.kind == "term"}
        assert found["Zebulon"] == "remove"
        assert not {"the", "with", "plan", "owner", "agreed", "note" + chr(97 + i)} & found.keys()
    # Copies are one context only, and documents without an entity are left alone.
    assert all(s.kind != "term" for i in range(400, 406) for s in got[i])
    assert all(got[100 + i] == [] for i in range(200))
    # The figures behind it, by hand.
    n, n_e, n_t, n_te = len(rows), 8, 8, 8
    assert math.log(n_te * n / (n_e * n_t)) / math.log(n / n_e) == pytest.approx(1.0)
    low = {r.doc_id: r.spans for r in personal_data(documents(rows), least_contexts=1, generalise=0.5).collect()}
    assert any(texts[400][s.start : s.stop] == "Quentin" for s in low[400])


def test_terms_of_rare_entities(spark, documents):
    """Two contexts are enough, far from the entity too, and addresses seen once count for their domain."""
    far = "the plan was agreed again " * 20
    rows = [(i, f"note{chr(97 + i)} to boss@corp.example {far} says Zebulon, owner") for i in range(2)]
    rows += [(10 + i, f"memo{chr(97 + i)} to u{i}@once{'.org'} {far} says Ottoline, owner") for i in range(4)]
    rows += [(20, f"alone to x@single.example {far} says Hapax, owner")]
    rows += [(100 + i, f"the plan number {i} says again it was agreed with the owner to do it {far}") for i in range(200)]
    texts = dict(rows)
    got = {r.doc_id: {(texts[r.doc_id][s.start : s.stop], s.act) for s in r.spans if s.kind == "term"}
           for r in personal_data(documents(rows)).collect()}
    assert got[0] == got[1] == {("Zebulon", "generalise")}  # 1 - 1/4
    assert all(got[10 + i] == {("Ottoline", "generalise")} for i in range(4))  # 1 - 1/16
    assert got[20] == set() and all(got[100 + i] == set() for i in range(200))


def test_sanitised_rows(spark, documents):
    rows = [*corpus(), (900, None), (901, ""), (902, "é 4111 1111 1111 1111, +1 (555) 123-4567!"), (902, "é 4111 1111 1111 1111, +1 (555) 123-4567!"),
            (None, "x@y.zz"), (903, "+4111111111111111")]
    df = documents(rows).withColumn("n_chars", F.length("text"))
    out = sanitise(df, personal_data(df))
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    texts = {}
    for d, t, n in got:
        assert n == (None if t is None else len(t))
        texts.setdefault(d, []).append(t)
    assert len(got) == len(rows)
    assert texts[0] == ["notea says , owner of [EMAIL], agreed again with the plan."]
    assert texts[900] == [None] and texts[901] == [""] and texts[None] == ["[EMAIL]"]
    assert texts[902] == ["é [CARD], [PHONE]!"] * 2
    assert texts[150] == [dict(rows)[150]]
    assert texts[903] == ["+[CARD]"]


def test_digest_and_empty(spark, documents):
    rows = [(1, "b@c.de 1.2.3.4 a@b.cd"), (2, None)]
    got = sorted(map(tuple, digest(personal_data(documents(rows))).collect()))
    text = "email:0:6,email:15:21,ip:7:14"
    assert got[0] == (1, 2, 1, 0, 0, hashlib.sha256(text.encode()).hexdigest(), text)
    assert got[1] == (2, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    assert personal_data(documents([])).count() == 0
    assert sanitise(documents([]), personal_data(documents([]))).count() == 0


def test_only_native_operators(documents):
    plan = personal_data(documents([(1, "a@b.cd")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_given_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    want = {}
    for r in table(spark, sf_dir, "documents").collect():
        found = brute(r.text)
        counts = [sum(k == kind for k, _, _ in found) for kind in KINDS]
        want[r.doc_id] = (*counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest())
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in op4_personal_data(spark, sf_dir).collect()}
    assert got == want
