import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fathom.llm.token_counts import RankMerges, TokenCounter, count_tokens


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


COUNTER, LIBRARY = TokenCounter("byte_bpe_50k.json", kept=100), library()


def truth(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(
    ["<|endoftext|>", "aaaa", "  ", "\n\n", " the", "'ll", "\x1c", "\x85", "\xa0", "日本語", "é", "12345", "Ჱ", "𐵀"])), max_size=12))
def test_counts_are_those_of_the_library(parts):
    texts = ["".join(parts), " ".join(parts)]
    assert COUNTER.counts(texts) == [truth(t) for t in texts]


def test_every_character():
    """A sample of every block, cut as the library cuts it."""
    for low in range(0, 0x110000, 4096):
        texts = [f"a{chr(c)}1{chr(c)}. {chr(c)}" for c in range(low, low + 4096, 37) if not 0xD800 <= c < 0xE000]
        assert COUNTER.counts(texts) == [truth(t) for t in texts]


def test_overlapping_pairs_and_order():
    merges = RankMerges("byte_bpe_50k.json")
    words = [b"a" * n for n in range(1, 40)] + [b"abababab", b"hello", b" hello", b"z"]
    assert merges.counts(words).tolist() == [truth(w.decode()) for w in words]
    assert merges.counts(words[::-1]).tolist() == merges.counts(words).tolist()[::-1]
    assert merges.counts([]).tolist() == [] and merges.counts([b"x"]).tolist() == [1]
    assert isinstance(merges.ranks, np.ndarray)


def test_table(documents):
    rows = [(1, "one two"), (2, None), (3, ""), (4, "lorem ipsum " * 20_000), (4, "lorem ipsum " * 20_000),
            (None, "a"), (5, "x" * 100_000)]
    got = count_tokens(documents(rows), limit=10_000).collect()
    want = [(d, len((t or "").encode()), truth(t or ""), truth(t or "") > 10_000) for d, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert count_tokens(documents([])).count() == 0
