"""Text and equations of binary word-processor files: the records of their body streams.

A body stream is a run of records, each with a head of 32 bits (kind in 10, level in 10, length in 12; a
length of 4,095 is followed by the real one), deflated without a header if the file's head says so.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

from corpusloom.convert.hwpx import ConversionError

#: Kinds of records, and the control characters that take one place; other ones take eight.
PARAGRAPH_TEXT, EQUATION = 67, 88
SINGLE = frozenset((0, 10, 13, *range(24, 32)))
WIDE = 8


def records(stream: bytes) -> Iterator[tuple[int, bytes]]:
    """(kind, payload) of the records of a stream, as far as they are whole."""
    at = 0
    while at + 4 <= len(stream):
        head = int.from_bytes(stream[at : at + 4], "little")
        size, at = head >> 20, at + 4
        if size == 0xFFF:
            size, at = int.from_bytes(stream[at : at + 4], "little"), at + 4
        if at + size > len(stream):
            return
        yield head & 0x3FF, stream[at : at + size]
        at += size


def paragraph(payload: bytes) -> str:
    """The text of a paragraph's record: tabs and line breaks stay, other controls go."""
    units = [int.from_bytes(payload[i : i + 2], "little") for i in range(0, len(payload) - 1, 2)]
    kept, at = bytearray(), 0
    while at < len(units):
        unit = units[at]
        if unit >= 32 or unit in (9, 10):
            kept += unit.to_bytes(2, "little")
        at += 1 if unit >= 32 or unit in SINGLE else WIDE
    return kept.decode("utf-16le", "replace").strip()


def stream_text(stream: bytes) -> str:
    """The paragraphs of a body stream, a line each."""
    return "\n".join(text for kind, payload in records(stream) if kind == PARAGRAPH_TEXT and (text := paragraph(payload)))


def stream_equations(stream: bytes) -> list[bytes]:
    """The payloads of a body stream's equations."""
    return [payload for kind, payload in records(stream) if kind == EQUATION]


def inflated(stream: bytes) -> bytes:
    """A deflated stream, as far as it is whole."""
    return zlib.decompressobj(-15).decompress(stream)


def body_streams(data: bytes) -> tuple[list[bytes], bytes]:
    """The body streams of a file, in their order, and its preview; needs a library for compound files."""
    try:
        import olefile
    except ImportError as error:
        raise ConversionError("no HWP library is installed") from error
    with olefile.OleFileIO(io.BytesIO(data)) as file:
        read = lambda name: file.openstream(name).read() if file.exists(name) else b""
        names = sorted((int(n[1][7:]), "/".join(n)) for n in file.listdir() if len(n) == 2 and n[0] == "BodyText" and n[1][:7] == "Section" and n[1][7:].isdigit())
        packed = bool(read("FileHeader")[36:37][:1] and read("FileHeader")[36] & 1)
        return [inflated(read(name)) if packed else read(name) for _, name in names], read("PrvText")


def preview_text(raw: bytes) -> str:
    """The preview in the first encoding that can mostly be read, else as UTF-16."""
    for encoding in ("utf-16le", "utf-16", "cp949", "utf-8"):
        text = raw.decode(encoding, "replace")
        useful, bad = sum(map(str.isalnum, text)), text.count("�") + text.count("\0")
        if useful / max(1, useful + bad) > 0.5:
            return text
    return raw.decode("utf-16le", "replace")


def hwp_parts(streams: list[bytes], preview: bytes) -> tuple[str, list[bytes]]:
    """The text of body streams, or the preview if they have none, and the payloads of the equations."""
    text = "\n\n".join(t for t in map(stream_text, streams) if t)
    return text or preview_text(preview), [payload for stream in streams for payload in stream_equations(stream)]
