"""Secret scanning through nested encodings.

A worklist holds the layers of a text: the text itself, and whatever a layer unwraps to by
URL escapes, Unicode escapes, base64, or compressed bytes. Every layer is scanned with the same
patterns and unwrapped again until no new layer turns up; layers already seen (by digest and
the span of the text they come from) are not taken twice, so encodings that lead back to themselves end. Every layer knows which span of
the text each of its characters comes from, so a finding is reported where it stands there.
"""

from __future__ import annotations

import base64
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from bz2 import BZ2Decompressor
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import map_rows, table

#: Fixed patterns of the base kinds, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

_ESCAPE = re.compile(r"%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}")
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+")
#: Runs that may be base64 (either alphabet), also joined over line breaks; shorter ones cannot
#: hold a secret.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_NOT_BASE64 = re.compile(r"[^A-Za-z0-9+/_-]+")
#: The shortest finding has 12 characters ("token=" and six more), and what it is wrapped in is
#: no shorter: bytes without such a run, plain or in UTF-16, hold none.
_PLAIN = re.compile(rb"[\t\r\n\x20-\x7e]{12}")
_WIDE = re.compile(rb"((?:[\t\r\n\x20-\x7e]\0){11,}+)|((?:\0[\t\r\n\x20-\x7e]){11,}+)")
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")

#: Bytes of a compressed layer that are scanned at once, and bytes of the piece before that the
#: next one begins with: a larger layer is read in such pieces, so memory is bounded, and what is
#: no longer than the overlap stands whole in one of them.
PIECE_BYTES, OVERLAP_BYTES = 1 << 24, 1 << 20


class Finding(NamedTuple):
    kind: str  # a base kind, or path.kind for one found below the text itself
    start: int
    end: int


class _Same:
    """A list of any length that holds one number."""

    def __init__(self, value: int) -> None:
        self.value = value

    def __getitem__(self, part: slice) -> list[int]:
        return [self.value] * (part.stop - part.start)


class Layer(NamedTuple):
    text: str
    path: str  # how it was unwrapped: "url.base64"; empty for the text itself
    #: Where character i comes from: spans of the text; None: character i is there itself.
    starts: list[int] | _Same | None
    ends: list[int] | _Same | None

    @property
    def depth(self) -> int:
        return self.path.count(".") + 1 if self.path else 0

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        if isinstance(self.starts, _Same):
            return self.starts.value, self.ends.value
        return min(self.starts[start:end]), max(self.ends[start:end])


def base_findings(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost matches of each kind; those that fail the kind's length are dropped."""
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST_ASSIGN:
            yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _replaced(layer: Layer, name: str, parts: list[tuple[int, int, str, list[int] | None]]) -> Layer:
    """``layer`` with [start, end) of each part replaced; ``widths``: characters of the layer
    that each new character stands for, None if it stands for the whole part."""
    text, starts, ends, at = [], [], [], 0

    def copy(low: int, high: int) -> None:
        text.append(layer.text[low:high])
        if layer.starts is None:
            starts.extend(range(low, high))
            ends.extend(range(low + 1, high + 1))
        else:
            starts.extend(layer.starts[low:high])
            ends.extend(layer.ends[low:high])

    for low, high, new, widths in parts:
        copy(at, low)
        text.append(new)
        place = low
        for k in range(len(new)):
            a, b = (low, high) if widths is None else (place, place + widths[k])
            place = b
            a, b = layer.span(a, b)
            starts.append(a)
            ends.append(b)
        at = high
    copy(at, len(layer.text))
    return Layer("".join(text), f"{layer.path}.{name}".lstrip("."), starts, ends)


def _url_layer(layer: Layer) -> Layer | None:
    parts = []
    for m in _URL.finditer(layer.text):
        raw = bytes.fromhex(m[0].replace("%", ""))
        new = raw.decode("utf-8", "replace")
        valid = "�" not in new
        widths = [3 * len(c.encode()) for c in new] if valid else None
        parts.append((m.start(), m.end(), new, widths))
    return _replaced(layer, "url", parts) if parts else None


def _unicode_layer(layer: Layer) -> Layer | None:
    parts = []
    for m in _UNICODE.finditer(layer.text):
        units = b"".join(bytes.fromhex(x) for x in m[0].split("\\u")[1:])
        new = units.decode("utf-16-be", "replace")
        exact = "�" not in new
        parts.append((m.start(), m.end(), new, [12 if ord(c) > 0xFFFF else 6 for c in new] if exact else None))
    return _replaced(layer, "unicode", parts) if parts else None


_PACKED = {
    b"\x1f\x8b": ("gzip", lambda: zlib.decompressobj(31)),
    b"\x78": ("zlib", zlib.decompressobj),
    b"BZh": ("bzip2", BZ2Decompressor),
    b"\xfd7zXZ\0": ("xz", lzma.LZMADecompressor),
}
#: How compressed bytes begin; zlib's second byte makes the first two a multiple of 31.
_MAGIC = re.compile(rb"(\x1f\x8b)|(\x78)[\x01\x5e\x9c\xda]|(BZh)[1-9]|(\xfd7zXZ\0)")


def _pieces(packed, data: bytes, out: bytearray, size: int, overlap: int) -> Iterator[bytes]:
    """What ``packed`` makes of ``data``, appended to ``out``; full pieces are cut off it."""
    while not packed.eof:
        new = packed.decompress(data, size - len(out))
        data = getattr(packed, "unconsumed_tail", b"")
        out += new
        if len(out) >= size:
            yield bytes(out)
            del out[: size - overlap]
        elif not new and not data:
            return  # the rest is missing


def _unpack(raw: bytes, size: int, overlap: int) -> Iterator[tuple[str, bytes, tuple[int, int]]]:
    """Name of the compression, a piece of the bytes inside, and the span in ``raw`` of the complete
    members it ends (empty before the last piece), wherever they begin; members that follow one
    another are one."""
    at = 0
    while m := _MAGIC.search(raw, at):
        magic = m[m.lastindex]
        name, make = _PACKED[magic]
        out, end = bytearray(), m.start()
        whole, cut = True, False
        while whole and raw.startswith(magic, end):
            packed = make()
            try:
                for piece in _pieces(packed, raw[end:], out, size, overlap):
                    cut = True
                    yield name, piece, (m.start(), m.start())
                whole = packed.eof
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                whole = False
            if whole:
                end = len(raw) - len(packed.unused_data)
        if out or cut:
            yield name, bytes(out), (m.start(), end)
        at = max(end, m.start() + 1)


def _texts(raw: bytes) -> Iterator[tuple[str, list[int]]]:
    """Readings of ``raw`` that can hold a finding: a character and the place of its first byte.

    The patterns are ASCII, so a byte is a character; UTF-16 is read as its runs stand.
    """
    if _PLAIN.search(raw):
        yield raw.decode("latin-1"), list(range(len(raw) + 1))
    for codec, first in sorted({(m.lastindex, m.start() % 2) for m in _WIDE.finditer(raw)}):
        text, places = raw[first:].decode("utf-16-le" if codec == 1 else "utf-16-be", "replace"), [first]
        for c in text:
            places.append(min(len(raw), places[-1] + (4 if ord(c) > 0xFFFF else 2)))
        yield text, places


def _inside(raw: bytes, path: str, place: tuple[int, int], size: int, overlap: int) -> Iterator[tuple[str, bytes]]:
    """``path, bytes`` of ``raw`` and of all that is compressed in it, however deep.

    Complete members, which come by themselves, are blanked in the bytes around them. A stack
    holds what is still to be read on; the digests above a layer keep it from leading back.
    """
    start = bytearray(raw)
    todo = [(path, raw, start, _unpack(raw, size, overlap), frozenset([hashlib.sha1(raw).digest()]))]
    while todo:
        own_path, own, rest, packed, above = todo[-1]
        for name, inner, (low, high) in packed:
            rest[low:high] = bytes(high - low)
            digest = hashlib.sha1(inner).digest()
            if digest not in above:
                below = f"{own_path}.{name}"
                todo.append((below, inner, bytearray(inner), _unpack(inner, size, overlap), above | {digest}))
                break
        else:
            todo.pop()
            yield own_path, bytes(rest)


def _base64_layers(layer: Layer, size: int, overlap: int) -> Iterator[Layer]:
    path = f"{layer.path}.base64".lstrip(".")
    for pattern in (_BASE64, _WRAPPED):
        for m in pattern.finditer(layer.text):
            whole = _NOT_BASE64.sub("", m[0])
            if len(whole) < 16 or _HEX_ONLY.fullmatch(whole):
                continue
            whole = whole.replace("-", "+").replace("_", "/")
            at = None
            for skip in range(4):  # what is glued to the front moves the alignment
                run = whole[skip:]
                if len(run) % 4 == 1:
                    run = run[:-1]
                raw = base64.b64decode(run + "=" * (-len(run) % 4))
                if not (_MAGIC.search(raw) or _PLAIN.search(raw) or _WIDE.search(raw)):
                    continue
                if at is None:
                    at = [i for i, c in enumerate(m[0], m.start()) if c not in "= \t\r\n"]
                place = layer.span(at[skip], m.end())
                rest = raw
                for deeper, inner in _inside(raw, path, place, size, overlap):
                    if deeper == path:
                        rest = inner
                        continue
                    for text, _ in _texts(inner):
                        yield Layer(text, deeper, _Same(place[0]), _Same(place[1]))
                texts = list(_texts(rest))
                if texts:
                    # Byte k comes from the characters that hold its bits.
                    n = len(run)
                    spans = [
                        layer.span(at[skip + 8 * k // 6], at[skip + min(n, (8 * k + 7) // 6 + 1) - 1] + 1)
                        for k in range(len(raw))
                    ]
                for text, places in texts:
                    last = len(raw) - 1
                    starts = [spans[min(p, last)][0] for p in places[:-1]]
                    ends = [spans[max(0, min(p, len(raw)) - 1)][1] for p in places[1:]]
                    yield Layer(text, path, starts, ends)


class _Base:
    """Base findings of a text, to ask whether one of them covers a span."""

    def __init__(self, found: list[Finding]) -> None:
        # Those of a kind do not overlap, so the last one that begins in time decides.
        self.of = {kind: sorted((f.start, f.end) for f in found if f.kind == kind) for kind in KINDS}

    def covers(self, kind: str, start: int, end: int) -> bool:
        spans = self.of[kind]
        at = bisect_right(spans, start, key=lambda s: s[0]) - 1
        return at >= 0 and end <= spans[at][1]


def _unwrapped(layer: Layer, size: int, overlap: int) -> Iterator[Layer]:
    if ("%" in layer.text or "\\u" in layer.text) and _ESCAPE.search(layer.text):
        for unwrap in (_url_layer, _unicode_layer):
            inner = unwrap(layer)
            if inner is not None:
                yield inner
    yield from _base64_layers(layer, size, overlap)


def scan(text: str, size: int = PIECE_BYTES, overlap: int = OVERLAP_BYTES) -> tuple[list[Finding], list[Finding]]:
    """Base findings of ``text`` itself, and those below it that no base finding covers.

    Layers are worked off as they are unwrapped, the deepest first, so few are held at once.
    """
    base = [Finding(*f) for f in base_findings(text)]
    known = _Base(base)
    below: dict[tuple[str, int, int], tuple[int, Finding]] = {}
    seen: dict[tuple, int] = {}
    work = [iter([Layer(text, "", None, None)])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text:
            continue
        # Equal layers at other places are not the same layer: their findings stand there. A
        # layer that is met again on a shorter way is taken once more, for that way's name.
        digest = hashlib.sha1(layer.text.encode("utf-8", "surrogatepass")).digest()
        key = (digest, *layer.span(0, len(layer.text)))
        if layer.depth >= seen.get(key, layer.depth + 1):
            continue
        seen[key] = layer.depth
        if layer.path:
            for kind, start, end in base_findings(layer.text):
                low, high = layer.span(start, end)
                # Escapes elsewhere leave a base finding where it was. One finding for each place
                # and kind: that of the shortest path.
                if not known.covers(kind, low, high) and layer.depth < below.get((kind, low, high), (layer.depth + 1,))[0]:
                    below[kind, low, high] = layer.depth, Finding(f"{layer.path}.{kind}", low, high)
        work.append(_unwrapped(layer, size, overlap))
    return base, [f for _, f in below.values()]


def _order(finding: Finding) -> tuple:
    kind = finding.kind
    return finding.start, KINDS.index(kind) if kind in KINDS else len(KINDS), kind, finding.end


FOUND = "doc_id bigint, findings array<struct<kind:string,start:bigint,stop:bigint>>"


def _scanner(size: int, overlap: int) -> Callable[[], Callable]:
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in batch.column(1):
                base, below = scan(text.as_py() or "", size, overlap)
                rows.append([{"kind": f.kind, "start": f.start, "stop": f.end} for f in sorted(base + below, key=_order)])
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(rows, kind_type)], names=["doc_id", "findings"]
            )

        return step

    return make


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", piece_bytes: int = PIECE_BYTES,
    overlap_bytes: int = OVERLAP_BYTES,
) -> DataFrame:
    """``doc_id, findings`` for each row of ``docs``: kind, start, stop (code points, end excluded).

    Null and empty texts have an empty list; repeated rows are scanned each; an empty table
    gives no rows; other columns are not read. A kind with a dot was found below the text: the
    part before the last dot is how it was unwrapped. Compressed layers are scanned in pieces of
    ``piece_bytes`` that overlap. Row-local, without a shuffle.
    """
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return map_rows(rows, _scanner(piece_bytes, overlap_bytes), FOUND)


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a checksum of the base spans, and all spans as text."""

    def joined(spans):
        text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
        return F.array_join(F.transform(spans, text), ",")

    def count(kind):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("findings", lambda s: s["kind"].isin(*KINDS))
    counts = [count(kind) for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans")
    )


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(table(spark, sf_dir, "documents")))
