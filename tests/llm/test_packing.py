import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fathom.llm.packing import decompose, digest, pack, write_buckets
from fathom.llm.word_pieces import WordPieces

LONG = "Lorem ipsum, dolor 42 sit's amet: ÉTÉ straße 日本 " * 900


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@given(st.integers(1, 20_000))
def test_decompose(n):
    lengths = decompose(n)
    assert sum(lengths) == n
    assert all(x & (x - 1) == 0 and x <= 2048 for x in lengths)
    assert lengths == sorted(lengths, reverse=True)
    below = [x for x in lengths if x < 2048]
    assert len(set(below)) == len(below)


WORDS, LIBRARY = WordPieces("word_bpe_49k.json", kept=50), library()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["Hello", "x'LL", "<|endoftext|>", "<|startoftext|>", "É", "é", "\x1c", "\xa0", "̈", "ΑΣ", "İ", "ſ",
     "12", " ", "\n", ",", "...", "日本", "×", "_", "​", "K", "A<|ENDOFTEXT|>", "ab"])).map("".join))
def test_ids_are_those_of_the_library(text):
    assert WORDS.ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_pack(spark, documents, tmp_path):
    rows = [(1, "one two"), (2, None), (3, ""), (4, LONG), (4, LONG), (None, "a b"), (5, "x" * 30_000)]
    pieces = pack(documents(rows))
    got = pieces.collect()
    assert len({r.sequence_id for r in got}) == len(got) and all(r.offset == 0 for r in got)
    want = []
    for doc_id, text in rows:
        ids, at = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], 0
        for length in decompose(len(ids)):
            want.append((doc_id, at, length, len(ids), struct.pack(f"<{length}I", *ids[at : at + length])))
            at += length
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.doc_id, r.start, r.length, r.doc_tokens, bytes(r.ids)) for r in got), key=key) == sorted(want, key=key)
    import zlib

    assert {(r.doc_id, r.start, r.ids_crc32) for r in digest(pieces).collect()} == {
        (d, s, zlib.crc32(raw)) for d, s, _, _, raw in want}
    write_buckets(pieces, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(want) and back.filter("bucket <> length").count() == 0


def test_pack_empty_table_and_bad_length(documents):
    assert pack(documents([])).count() == 0
    with pytest.raises(ValueError):
        pack(documents([]), max_len=1000)
