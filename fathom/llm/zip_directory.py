"""Directory of a ZIP archive, read by ranges: what is stored where, without extraction."""

from __future__ import annotations

import struct
from collections.abc import Callable
from typing import NamedTuple

#: read(offset, size) -> bytes
Read = Callable[[int, int], bytes]

_END = "<4s4H2LH"
_END64_LOCATOR = "<4sLQL"
_END64 = "<4sQ2H2L4Q"
_ENTRY = "<4s6H3L5H2L"
_LOCAL = "<4s5H3L2H"
_END_SIGN, _LOCATOR_SIGN, _END64_SIGN = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06"
_ENTRY_SIGN, _LOCAL_SIGN = b"PK\x01\x02", b"PK\x03\x04"
_ZIP64_EXTRA = 1
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
STORED = 0


class BadArchive(ValueError):
    pass


class Member(NamedTuple):
    name: str
    method: int
    size: int  # of its bytes in the archive
    header: int  # offset of its local header
    crc32: int


def _fields(layout: str, sign: bytes, raw: bytes, what: str) -> tuple:
    if len(raw) < struct.calcsize(layout) or raw[:4] != sign:
        raise BadArchive(f"no {what}")
    return struct.unpack(layout, raw[: struct.calcsize(layout)])


def _directory(read: Read, size: int) -> tuple[int, int, int, int]:
    """Entries, size and start of the central directory, and how far offsets are shifted."""
    tail_at = max(0, size - struct.calcsize(_END) - _FULL16)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END_SIGN)
    while at >= 0:
        if len(tail) - at >= struct.calcsize(_END):
            end = struct.unpack(_END, tail[at : at + struct.calcsize(_END)])
            if at + struct.calcsize(_END) + end[-1] == len(tail):
                break
        at = tail.rfind(_END_SIGN, 0, at)
    else:
        raise BadArchive("no end of central directory")
    end_at = tail_at + at
    disk, first_disk, _, count, length, start = end[1:7]
    locator_at = end_at - struct.calcsize(_END64_LOCATOR)
    locator = read(locator_at, struct.calcsize(_END64_LOCATOR)) if locator_at >= 0 else b""
    if locator[:4] == _LOCATOR_SIGN:
        stated = struct.unpack(_END64_LOCATOR, locator)[2]
        # Bytes before the archive shift it; it then stands right before its locator.
        for place in (stated, locator_at - struct.calcsize(_END64)):
            raw = read(place, struct.calcsize(_END64)) if 0 <= place < locator_at else b""
            if raw[:4] == _END64_SIGN:
                break
        end64 = _fields(_END64, _END64_SIGN, raw, "ZIP64 end of central directory")
        disk, first_disk, _, count, length, start = end64[4:10]
        end_at = place
    elif count == _FULL16 and start == _FULL32:
        raise BadArchive("no ZIP64 locator")
    if disk != first_disk:
        raise BadArchive("archive of several files")
    shift = end_at - length - start
    if shift < 0:
        raise BadArchive("central directory out of place")
    return count, length, start + shift, shift


def members(read: Read, size: int) -> list[Member]:
    """All members, in the order of the central directory."""
    count, length, start, shift = _directory(read, size)
    raw, at, out = read(start, length), 0, []
    for _ in range(count):
        entry = _fields(_ENTRY, _ENTRY_SIGN, raw[at : at + struct.calcsize(_ENTRY)], "directory entry")
        flags, method, crc = entry[3], entry[4], entry[7]
        stored, plain, n_name, n_extra, n_comment = entry[8:13]
        offset = entry[16]
        at += struct.calcsize(_ENTRY)
        name = raw[at : at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[at + n_name : at + n_name + n_extra]
        at += n_name + n_extra + n_comment
        while len(extra) >= 4:
            kind, n = struct.unpack("<2H", extra[:4])
            if kind == _ZIP64_EXTRA:
                wide = [x[0] for x in struct.iter_unpack("<Q", extra[4 : 4 + n // 8 * 8])]
                if plain == _FULL32:
                    plain = wide.pop(0)
                if stored == _FULL32:
                    stored = wide.pop(0)
                if offset == _FULL32:
                    offset = wide.pop(0)
            extra = extra[4 + n :]
        out.append(Member(name, method, stored, offset + shift, crc))
    return out


def data_start(read: Read, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != STORED:
        raise BadArchive(f"{member.name} is compressed; only stored members are read by ranges")
    local = _fields(_LOCAL, _LOCAL_SIGN, read(member.header, struct.calcsize(_LOCAL)), f"local header of {member.name}")
    return member.header + struct.calcsize(_LOCAL) + local[-2] + local[-1]
