"""Token ids of a lower-casing word vocabulary, with the pieces of a word kept for the next one.

Such a vocabulary drops white space, so the ids of a text are those of its words in order; the
library is asked only for words not yet seen in this task.
"""

from __future__ import annotations

import re
import struct

#: Words kept at most; beyond it the store starts anew, so memory stays bounded.
KEPT_WORDS = 1_000_000

_SPACED = re.compile(r"[^ \t\n\r]+")
#: Characters whose class, case and composition are the same in every Unicode version.
_PLAIN = re.compile("[!-~À-įı-ɏ]+")


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b if b in printable else next(shifted)) for b in range(256)]


class WordPieces:
    """``pieces(text)``: the ids of ``text`` as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: str, kept: int = KEPT_WORDS) -> None:
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self._model = self._library.model
        self._split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self._bytes = byte_characters()
        self._kept = kept
        self._chunks: dict[str, bytes] = {}

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        """One word as the library's rules cut it, in lower case."""
        found = self._chunks.get(word)
        if found is None:
            text = word if word.isascii() else "".join([self._bytes[b] for b in word.encode()])
            found = self._packed([t.id for t in self._model.tokenize(text)])
            self._chunks[word] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        low = chunk.lower()
        if low.isascii():
            if low.isalpha():
                return self._word(low)
            if low[-1] in ".,;:!?" and low[:-1].isalpha():
                return self._word(low[:-1]) + self._word(low[-1])
        # Special strings and rare characters are left to the library as a whole.
        if "<|" in chunk or not _PLAIN.fullmatch(chunk):
            return self._packed(self._library.encode(chunk, add_special_tokens=False).ids)
        return b"".join([self._word(w) for w in self._split(low)])

    def pieces(self, text: str) -> bytes:
        chunks = self._chunks
        if len(chunks) > self._kept:
            chunks.clear()
        if text.isascii() and "<|" not in text:
            text = text.lower()
        # Python also splits at four separators that are symbols for the library.
        odd = any([c in text for c in "\x1c\x1d\x1e\x1f"])
        words = _SPACED.findall(text) if odd else text.split()
        for word in set(words).difference(chunks):
            chunks[word] = self._chunk(word)
        return b"".join(map(chunks.__getitem__, words))

    def ids(self, text: str) -> list[int]:
        raw = self.pieces(text)
        return list(struct.unpack(f"<{len(raw) // 4}I", raw))
