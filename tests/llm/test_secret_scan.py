import base64
import bz2
import gzip
import hashlib
import lzma
import re
import zlib
from urllib.parse import quote

from hypothesis import given, settings
from hypothesis import strategies as st

from fathom.llm.secret_scan import digest, find_secrets, scan

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["password", "Token", "ſecret", "API_KEY", "apikey", "=", ": ", '"', "abc123", "AKIA", "ABCDEFGH12345678", "é",
     "deadbeef" * 3, "deadbee", " ", "\n", "%3D", "\\u0041", "Zm9v", "日"])).map("".join))
def test_base_spans(text):
    assert sorted(scan(text)[0], key=lambda f: (f.start, ("assign", "access", "hex").index(f.kind))) == brute(text)


KEY = "AKIA" + "Q7W2E9R4T6Y1U3I8"


def b64(raw):
    return base64.b64encode(raw).decode()


def test_layers_are_found_where_they_stand():
    cases = {
        "base64.access": b64(f"see {KEY} there".encode()),
        "base64.gzip.access": b64(gzip.compress(KEY.encode())),
        "base64.zlib.access": b64(zlib.compress(KEY.encode())),
        "base64.bzip2.access": b64(bz2.compress(KEY.encode())),
        "base64.xz.access": b64(lzma.compress(KEY.encode())),
        "base64.base64.access": b64(b64(KEY.encode()).encode()),
        "url.access": "".join(f"%{ord(c):02X}" for c in KEY),
        "unicode.access": "".join(f"\\u{ord(c):04x}" for c in KEY),
        "url.base64.access": "".join(c if i % 5 else f"%{ord(c):02X}" for i, c in enumerate(b64(f"é {KEY} ~~".encode()))),
        "base64.gzip.base64.access": b64(gzip.compress(b64(KEY.encode()).encode())),
        "url.unicode.access": quote("".join(f"\\u{ord(c):04x}" for c in KEY)),
    }
    for path, wrapped in cases.items():
        text = f"día {wrapped} end"
        base, below = scan(text)
        assert base == [], path
        assert [f.kind for f in below] == [path], (path, below)
        assert 4 <= below[0].start < below[0].end <= 4 + len(wrapped), path


def test_span_of_plain_base64_is_tight():
    wrapped = b64(f"xxxxxxxxxxxx{KEY}yyyyyyyyyyyy".encode())
    (f,) = scan(f"é{wrapped}")[1]
    assert f[1:] == (1 + 16, 1 + 16 + -(-20 * 8 // 6))


def test_fixpoint_and_cycles():
    assert scan("%25" * 5 + "25252541")[1] == []  # each layer is shorter, the last has no escape
    text = "Zm9v" * 8
    assert scan(text)[1] == []
    deep = KEY
    for _ in range(9):
        deep = b64(deep.encode())
    (f,) = scan(deep)[1]
    assert f.kind == "base64." * 9 + "access"
    # An escape elsewhere does not report a base finding again.
    assert scan(f"{KEY} %41 password=abcdef1")[1] == []


def test_equal_layers_at_two_places():
    for wrapped in (b64(KEY.encode()), b64(gzip.compress(KEY.encode(), mtime=0))):
        text = f"one {wrapped} two\n{wrapped} end"
        below = scan(text)[1]
        assert len(below) == 2 and {f.start for f in below} == {4, text.rindex(wrapped)}


def test_longer_finding_below_a_base_finding():
    base, below = scan("password=abc123%2Bdef456")
    assert [f[:] for f in base] == [("assign", 0, 15)]
    assert [f[:] for f in below] == [("url.assign", 0, 24)]


def test_base64_that_is_not_clean():
    cases = [
        b64(b"\xef\xbb\xbf" + f"see {KEY} there".encode()), b64(f"a\u00a0b\u200b {KEY}\f".encode()),
        b64(f"x\x1b[0m\0 {KEY} \xff".encode("latin-1")), b64(f"see {KEY} there".encode("utf-16")),
        b64(f"see {KEY} there".encode("utf-16-be")), b64(b"." + f"see {KEY}".encode("utf-16-le")),
        *(f"{'com/path/x'[:n]}/" + b64(f"see {KEY} there".encode()) for n in range(3, 11)),
        "com/path/" + b64(gzip.compress(KEY.encode())), "key_" + b64(f"see {KEY} there".encode()),
    ]
    for wrapped in cases:
        below = scan(f"día {wrapped} end")[1]
        assert [f.kind.rpartition(".")[2] for f in below] == ["access"], wrapped
        assert 4 <= below[0].start < below[0].end <= 4 + len(wrapped), wrapped
    half, rest = KEY[:9].encode(), KEY[9:].encode()
    for pack in (gzip.compress, bz2.compress, lzma.compress):
        assert [f.kind.rpartition(".")[2] for f in scan(b64(pack(half) + pack(rest)))[1]] == ["access"]
    text = gzip.compress(("".join(chr(33 + i * i % 90) for i in range(300)) + f" {KEY}").encode())
    for raw in (text, b"x" * 40 + b" " + KEY.encode()):
        lines = base64.encodebytes(raw).decode()
        for wrapped in (lines, lines.replace("\n", "\r\n")):
            found = scan(f"a:\n\n{wrapped}\n.")[1]
            assert any(f.kind.endswith("access") and f.start >= 4 for f in found), wrapped


def test_large_layers_are_read_in_pieces():
    """A secret behind, across and in front of the pieces' ends, in layers beyond a piece."""
    noise = "".join(chr(33 + i * i % 60) for i in range(997))
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
        for before in (0, 990, 1900, 5000):
            raw = (noise * 10)[:before].encode() + b" " + KEY.encode() + b" " + noise.encode()
            below = scan(b64(pack(raw)), 1000, 200)[1]
            assert [f.kind.rpartition(".")[2] for f in below] == ["access"], (pack, before)
    big = b64(gzip.compress(b"0 " * 9_500_000 + KEY.encode()))
    assert len(big) < 60_000 and [f.kind for f in scan(big)[1]] == ["base64.gzip.access"]
    assert scan(b64(b"\x1f\x8b" + b"broken gzip data....")) == ([], [])
    half = gzip.compress((noise * 3 + KEY).encode())
    assert scan(b64(half[: len(half) // 2]), 1000, 100)[1] == []


def test_deep_nesting():
    raw = f"see {KEY} there".encode()
    for _ in range(1100):
        raw = gzip.compress(raw, 1, mtime=0)
    (f,) = scan(b64(raw))[1]
    assert f.kind == "base64." + "gzip." * 1100 + "access"


def test_many_findings_take_no_square_of_time():
    import time

    text = " ".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(8_000)) + " %41"
    start = time.process_time()
    base, below = scan(text)
    assert len(base) == 8_000 and below == [] and time.process_time() - start < 3


def recursive(text, size=10**9, path="", seen=frozenset()):
    """Kinds and secrets in a text and all that it wraps, by plain recursion; no places."""
    out = {(path, kind, text[a:b]) for kind, a, b in brute(text)}
    steps = [("url", re.sub(r"(%[0-9A-Fa-f]{2})+", lambda m: bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "replace"), text)),
             ("unicode", re.sub(r"\\u[0-9A-Fa-f]{4}", lambda m: chr(int(m[0][2:], 16)), text))]
    for m in re.finditer(r"[A-Za-z0-9+/]{16,}={0,2}", text):
        try:
            raw = base64.b64decode(m[0], validate=True)
        except ValueError:
            continue
        for name, unpack in (("", bytes), (".gzip", gzip.decompress), (".zlib", zlib.decompress), (".bzip2", bz2.decompress)):
            try:
                steps.append((f"base64{name}", unpack(raw).decode("latin-1")))
            except (OSError, EOFError, zlib.error, ValueError):
                pass
    for name, inner in steps:
        if inner != text and inner not in seen:
            out |= recursive(inner, size, f"{path}.{name}".lstrip("."), seen | {text})
    return out


WRAPS = {
    "url": lambda t: "".join(f"%{b:02X}" for b in t.encode()),
    "unicode": lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
    "base64": lambda t: b64(t.encode()),
    "gzip": lambda t: b64(gzip.compress(t.encode())),
    "bzip2": lambda t: b64(bz2.compress(t.encode())),
}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from([KEY, "token=abc123", "0f" * 13, "plain words here"]), st.lists(st.sampled_from(sorted(WRAPS)), max_size=4)
), max_size=4))
def test_decoded_layers_against_plain_recursion(parts):
    text = ""
    for secret, wraps in parts:
        for name in wraps:
            secret = WRAPS[name](f"<{secret}>")
        text += f" {secret} ;"
    base, below = scan(text)
    got = {(f.kind.rpartition(".")[2]) for f in below}
    # What stands in the text itself is base; of a place and kind the shortest path is kept.
    want = {(path, kind) for path, kind, _ in recursive(text)}
    own = {kind for path, kind in want if not path}
    assert {f.kind for f in base} == own
    assert got <= {kind for path, kind in want if path}
    assert {kind for path, kind in want if path} - own <= got
    paths = {f.kind for f in below}
    assert paths <= {f"{path}.{kind}" for path, kind in want}
    for f in below:
        assert 0 <= f.start < f.end <= len(text)


def test_table(documents):
    rows = [(1, f"a {KEY} password: 'hunter22' {'0f' * 12}"), (2, None), (3, ""), (4, "word " * 50_000 + KEY),
            (1, f"a {KEY} password: 'hunter22' {'0f' * 12}"), (None, b64(KEY.encode())), (5, "a" * 200_000)]
    got = sorted(map(tuple, digest(find_secrets(documents(rows))).collect()), key=str)
    want = []
    for d, t in rows:
        base = brute(t or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        n = [sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex")]
        spans = text if d is not None else "base64.access:0:27"
        want.append((d, *n, hashlib.sha256(text.encode()).hexdigest(), spans))
    assert got == sorted(want, key=str)
    assert digest(find_secrets(documents([]))).count() == 0
