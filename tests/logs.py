"""A few lines of plain Python that write log bytes, independent of the library."""

import struct

HEADER = b"WPILOG\x00\x01\x00\x00\x00\x00"


def text(s):
    raw = s.encode() if isinstance(s, str) else s
    return struct.pack("<I", len(raw)) + raw


def rec(entry, ts, payload):
    return struct.pack("<BIIQ", 0x7F, entry, len(payload), ts) + payload


def start(entry, name, kind, ts=0, metadata=""):
    return rec(0, ts, b"\x00" + struct.pack("<I", entry) + text(name) + text(kind) + text(metadata))


def finish(entry, ts=0):
    return rec(0, ts, b"\x01" + struct.pack("<I", entry))


def note(entry, metadata, ts=0):
    return rec(0, ts, b"\x02" + struct.pack("<I", entry) + text(metadata))


def log(*parts):
    return HEADER + b"".join(parts)


def f64(x):
    return struct.pack("<d", x)


def i64(x):
    return struct.pack("<q", x)
