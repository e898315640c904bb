"""Each stage on what its predecessor kept, against a brute-force version of it."""

import struct
import sys
import zlib

import corpus_pipeline
from fathom.llm import toxicity
from fathom.llm.common import materialize, table
from fathom.llm.packing import decompose

sys.path.insert(0, __file__.rpartition("/")[0])

import test_decontaminate  # noqa: E402
import test_near_duplicates  # noqa: E402
import test_packing  # noqa: E402
import test_personal_data  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def check_toxicity(spark, before, after):
    docs = table(spark, SF_DIR, "documents")
    model = toxicity.train(docs, toxicity.training_labels(table(spark, SF_DIR, "labels")))
    score = lambda t: toxicity.document_score([p for _, _, p in toxicity.sentence_scores(t or "", model)])
    assert after == [r for r in before if score(r[1]) < 0.5]


def check_near_duplicates(spark, before, after):
    brute = test_near_duplicates.brute(before, 5, 80)
    assert after == sorted([(d, dict(before)[d]) for d, _, _, kept in brute if kept], key=str)


def check_decontamination(spark, before, after):
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    bad = {r[0] for r in test_decontaminate.brute(before, items) if r[-1]}
    assert after == [r for r in before if r[0] not in bad]


def check_personal_data(spark, before, after):
    assert [d for d, _ in after] == [d for d, _ in before]
    for (_, old), (_, new) in zip(before, after):
        found = test_personal_data.brute(old)
        assert test_personal_data.brute(new) == [] and (found or old == new)
        assert sum(new.count(f"[{k.upper()}]") - old.count(f"[{k.upper()}]") for k in test_personal_data.KINDS) <= len(found)


CHECKS = {"toxicity": check_toxicity, "near_duplicates": check_near_duplicates, "decontamination": check_decontamination,
          "personal_data": check_personal_data}


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialize(stage(spark, docs, SF_DIR))
        assert kept.columns == columns
        CHECKS[name](spark, rows(docs), rows(kept))
        docs = kept
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] > 0
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    library, want = test_packing.library(), []
    for doc_id, text in rows(docs):
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 1], 0
        for n in decompose(len(ids)):
            want.append((doc_id, at, n, zlib.crc32(struct.pack(f"<{n}I", *ids[at : at + n])), len(ids), 0))
            at += n
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.offset) for r in pieces) == sorted(want)
    again = corpus_pipeline.run(spark, SF_DIR).drop("sequence_id").collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.offset) for r in again) == sorted(want)


def test_odd_documents(spark, tmp_path):
    """Null, empty, repeated and long texts, and an empty table, pass through all stages."""
    for name in ("labels", "benchmark"):
        table(spark, SF_DIR, name).write.parquet(f"{tmp_path}/{name}.parquet")
    schema = table(spark, SF_DIR, "documents").schema
    odd = [(1, None, "en", None, None), (2, "", "en", "s", 0), (3, "word " * 40_000, "en", "s", 200_000), (4, "a b", None, "s", 3),
           (4, "a b", None, "s", 3), (None, "c d", "en", "s", 3)]
    for data, want in ((odd, {"1", "2", "3", "4", "None"}), ([], set())):
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
        assert {str(r.doc_id) for r in got} == want
        assert sum(r.length for r in got if r.doc_id == 4) == (3 if data else 0)
