"""The information dictionary of a PDF, read from its bytes without any other library.

Objects are found where they are written, in the file or in its compressed object streams; the last trailer that names
an information dictionary counts. Encrypted strings, and what is no PDF, give no entries.
"""

from __future__ import annotations

import re
import zlib

from vellumine.sources.providers import BatchProvider

_TRAILER = re.compile(rb"/Info\s+(\d+)\s+(\d+)\s+R")
_STREAM = re.compile(rb"<<((?:[^<>]|<<[^<>]*>>|<[^<>]*>)*/Type\s*/ObjStm(?:[^<>]|<<[^<>]*>>|<[^<>]*>)*)>>\s*stream\r?\n", re.S)
_ENTRY = re.compile(rb"/((?:[^\s/()<>\[\]{}%])+)\s*(\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|/[^\s/()<>\[\]{}%]+|-?[\d.]+)", re.S)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r\n|.)", re.S)
_LETTERS = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b"", b"\r": b"", b"\r\n": b""}


def _decoded(value: bytes) -> str:
    """The text of a literal, hexadecimal or name value."""
    if value[:1] == b"<":
        raw = re.sub(rb"\s", b"", value[1:-1])
        value = bytes.fromhex((raw + b"0" * (len(raw) % 2)).decode())
    elif value[:1] == b"(":
        octal = lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() and m[1][:1] < b"8" else _LETTERS.get(m[1], m[1])
        value = _ESCAPE.sub(octal, value[1:-1])
    else:
        value = value.lstrip(b"/")
    if value[:2] in (b"\xfe\xff", b"\xff\xfe"):
        return value.decode("utf-16", "replace")
    return value.decode("utf-8") if value[:3] == b"\xef\xbb\xbf" else value.decode("latin-1")


def _objects(content: bytes, number: int) -> list[bytes]:
    """The bodies of an object of this number, in the file's order, those in compressed object streams included."""
    found = [m[1] for m in re.finditer(rb"(?<!\d)%d\s+\d+\s+obj\b(.*?)\bendobj" % number, content, re.S)]
    for m in _STREAM.finditer(content):
        first, count = re.search(rb"/First\s+(\d+)", m[1]), re.search(rb"/N\s+(\d+)", m[1])
        if not first or not count:
            continue
        try:
            data = zlib.decompressobj().decompress(content[m.end() :]) if b"/FlateDecode" in m[1] else content[m.end() :]
            places = list(map(int, data[: int(first[1])].split()[: 2 * int(count[1])]))
        except (zlib.error, ValueError):
            continue
        ends = [*places[3::2], None]
        for own, at, end in zip(places[::2], places[1::2], ends):
            if own == number:
                found.append(data[int(first[1]) + at : None if end is None else int(first[1]) + end])
    return found


def information(content: bytes) -> dict[str, str]:
    """The entries of the information dictionary; a name keeps its blanks, which are written #20 in the file."""
    named = [m for part in (content, *_streams(content)) for m in _TRAILER.finditer(part)]
    for m in reversed(named):
        for body in reversed(_objects(content, int(m[1]))):
            entries = {re.sub(rb"#([0-9A-Fa-f]{2})", lambda h: bytes([int(h[1], 16)]), k).decode("latin-1"): _decoded(v) for k, v in _ENTRY.findall(body)}
            if entries:
                return entries
    return {}


def _streams(content: bytes) -> list[bytes]:
    """The dictionaries of cross-reference streams, which stand in for a trailer."""
    return [m[0] for m in re.finditer(rb"<<(?:[^<>]|<[^<>]*>)*/Type\s*/XRef(?:[^<>]|<[^<>]*>)*>>", content, re.S)]


# Fixed value: the entry under which a publisher writes its article number.
ARTICLE = "IEEE Article ID"


def article_id(content: bytes) -> str | None:
    """The article number in a PDF's information dictionary; null where there is none or the bytes are no PDF."""
    return information(content or b"").get(ARTICLE) or None


def article_ids(doc_type: str = "string") -> BatchProvider:
    """``article_id`` of each document."""
    return BatchProvider(lambda: lambda content: {"article_id": article_id(content)}, "article_id string", doc_type)
