"""Media columns: an 8-bit WAV form, signature sniffing, corrected types and carving.

An Aho-Corasick automaton locates magic bytes in one pass; a validator for each format confirms structure and length, so
bytes that only look like a beginning count as nothing. A declared type is corrected by what stands at the beginning of a
value, and media within it are carved.

Null and empty text is a payload of 64 zero bytes; very long texts are stored whole; equal texts give equal values, so do
repeated rows; ids, nulls among them, are passed through; other columns, whatever their names, are not read; an empty
table gives no rows.
"""
import hashlib
import re
import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame

# Magic bytes and their types.
MAGIC = {b"RIFF": "audio/wav", b"\x89PNG\r\n\x1a\n": "image/png", b"GIF87a": "image/gif", b"GIF89a": "image/gif", b"%PDF-": "application/pdf", b"PK\x03\x04": "application/zip"}
RATE = 8000


def store(payload: bytes) -> bytes:
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8)
    return struct.pack("<4sI4s", b"RIFF", 36 + len(payload), b"WAVE") + fmt + struct.pack("<4sI", b"data", len(payload)) + payload


def wav_end(b: bytes, at: int = 0):
    """(end, payload) of a confirmed PCM WAV at this place: whole chunks up to the RIFF length, a format before its data."""
    if len(b) < at + 12 or b[at + 8 : at + 12] != b"WAVE":
        return None
    end, p, fmt, data = at + 8 + struct.unpack_from("<I", b, at + 4)[0], at + 12, None, None
    while p + 8 <= end <= len(b):
        kind, n = struct.unpack_from("<4sI", b, p)
        if p + 8 + n > end:
            return None
        if kind == b"fmt " and n >= 16:
            fmt = struct.unpack_from("<HHIIHH", b, p + 8)
        elif kind == b"data":
            data = b[p + 8 : p + 8 + n]
        p += 8 + n + (n & 1 if p + 8 + n < end else 0)
    if p != end or data is None or fmt is None or fmt[0] != 1 or fmt[4] != fmt[1] * fmt[5] // 8 or fmt[3] != fmt[2] * fmt[4]:
        return None
    return end, data


def png_end(b: bytes, at: int = 0):
    p = at + 8
    while p + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, p)
        if p + 12 + n > len(b) or zlib.crc32(b[p + 4 : p + 8 + n]) != struct.unpack_from(">I", b, p + 8 + n)[0]:
            return None
        p += 12 + n
        if kind == b"IEND":
            return p, b[at:p]
    return None


def gif_end(b: bytes, at: int = 0):
    """Colour tables and blocks up to the trailer, with one image at least."""
    if len(b) < at + 13:
        return None
    table = lambda flags: 3 << ((flags & 7) + 1) if flags & 128 else 0
    p, images = at + 13 + table(b[at + 10]), 0
    while p < len(b):
        if b[p] == 0x3B:
            return (p + 1, b[at : p + 1]) if images else None
        if b[p] == 0x2C and p + 10 < len(b):
            images += 1
            p += 11 + table(b[p + 9])
        elif b[p] == 0x21:
            p += 2
        else:
            return None
        while p < len(b) and b[p]:
            p += b[p] + 1
        p += 1
    return None


PDF_END = re.compile(rb"startxref\s+([0-9]+)\s+%%EOF\r?\n?")


def pdf_end(b: bytes, at: int = 0):
    """Up to the last end mark before another PDF begins, whose cross-reference offset lies within and names one."""
    if not re.match(rb"%PDF-[0-9]\.[0-9]", b[at : at + 8]):
        return None
    stop = b.find(b"%PDF-", at + 5)
    for m in reversed(list(PDF_END.finditer(b, at, len(b) if stop < 0 else stop))):
        x = at + int(m[1])
        if x < m.start() and re.match(rb"xref|[0-9]+\s+[0-9]+\s+obj", b[x : x + 30]):
            return m.end(), b[at : m.end()]
    return None


def zip_end(b: bytes, at: int = 0):
    """Up to the end record whose directory lies just before it and begins this archive's entries here."""
    p = b.find(b"PK\x05\x06", at)
    while p >= 0 and p + 22 <= len(b):
        size, offset, note = struct.unpack_from("<IIH", b, p + 12)
        if at + offset + size == p and p + 22 + note <= len(b) and (not size or b[at + offset : at + offset + 4] == b"PK\x01\x02"):
            return p + 22 + note, b[at : p + 22 + note]
        p = b.find(b"PK\x05\x06", p + 4)
    return None


VALID = {"audio/wav": wav_end, "image/png": png_end, "image/gif": gif_end, "application/pdf": pdf_end, "application/zip": zip_end}


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for m, kind in MAGIC.items():
        a.add_word(m.decode("latin-1"), (len(m), kind))
    a.make_automaton()
    return a


def sniff(b: bytes, a) -> list[tuple[int, int, str]]:
    """Confirmed media as (start, end, type), outermost first; what lies within a confirmed one is listed after it, but not the entries of a ZIP or the parts of a PDF."""
    found, until = [], {}
    for last, (n, kind) in a.iter(b.decode("latin-1")):
        start = last + 1 - n
        if start < until.get(kind, 0):
            continue
        if ok := VALID[kind](b, start):
            found.append((start, ok[0], kind))
            until[kind] = ok[0]
    return sorted(found, key=lambda x: (x[0], -x[1]))


def carve(rows: DataFrame, key: str, content: str, declared: str) -> DataFrame:
    """rows(key, content binary, declared type): per row the key, declared, corrected (what stands at the beginning, else the declared type unless a validator denies it, else null) and carved (start, end, type, bytes of what stands elsewhere)."""

    def run(batches):
        a = automaton()
        for b in batches:
            right, parts = [], []
            for c, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                found = sniff(c or b"", a)
                right.append(next((k for s, _, k in found if s == 0), None if t in VALID else t))
                parts.append([{"start": s, "end": e, "type": k, "bytes": c[s:e]} for s, e, k in found if s or k != right[-1]])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("type", pa.string()), ("bytes", pa.binary())]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(right, pa.string()), pa.array(parts, kind)], [key, "declared", "corrected", "carved"])

    k = rows.schema[key].dataType.simpleString()
    return rows.select(key, content, declared).mapInArrow(run, f"`{key}` {k}, declared string, corrected string, carved array<struct<start:long,end:long,type:string,bytes:binary>>")


def media_digest(docs: DataFrame) -> DataFrame:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches):
        a = automaton()
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = (t or "").encode()
                media = store(raw + bytes(-len(raw) % 64 if raw else 64))
                found = sniff(media, a)
                start, _, kind = found[0]
                back = VALID[kind](media, start)[1]
                rows.append((i, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), f"{kind};rate={RATE};samples={len(back)};embedded={len(found) - 1}"))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if isinstance(c[0], str) else pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.string() if n in ("payload_sha256", "media_sha256", "feature") else pa.int64()) for n in names], names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
