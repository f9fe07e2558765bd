"""WARC archives: one gzip member per record, read back in sequence with lengths and digests verified.

Archives of bounded size are rows of a table in the folder of spark.checkpoint.dir; they go when the driver ends. Of equal
payloads of at least LEAST bytes the smallest page_id is the response, others are revisits of it without a body. The
reader inflates at most STEP bytes at once, frames records by Content-Length and hashes as it goes, so a record needs no
more memory however long it is.

Null html is an empty payload, and so is an empty one; null page ids rank last; repeated rows of the smallest id are all
responses, and share a record id; long pages are written whole; other columns, whatever their names, are not read; an
empty table gives no rows. Damage (a cut member, a wrong length, a wrong digest) raises ValueError.
"""
import base64
import hashlib
import io
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.shared import stored

LEAST, ARCHIVE, STEP = 100, 4 << 20, 1 << 16
# The profile of revisits by equal digest; a date, as pages have none.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"


def _b32(digest: bytes) -> str:
    return f"sha256:{base64.b32encode(digest).decode()}"


def record_id(page_id, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}:'.encode() + digest).digest()[:16], version=5)}>"


def record(page_id, url, body: bytes, refers_to, date: str = DATE) -> bytes:
    kind, digest = ("response" if refers_to is None else "revisit"), hashlib.sha256(body).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http + (body if refers_to is None else b"")
    uri = (url or "").replace("\r", "").replace("\n", "")
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id(page_id, digest), "WARC-Date": date, "WARC-Target-URI": uri, "Content-Type": "application/http; msgtype=response"}
    head |= {"WARC-Payload-Digest": _b32(digest), "WARC-Block-Digest": _b32(hashlib.sha256(block).digest()), "X-Page-ID": "" if page_id is None else str(page_id)}
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page-ID": str(refers_to)}
    raw = ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + f"Content-Length: {len(block)}\r\n\r\n").encode() + block + END
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


class _Member:
    """What one gzip member inflates to, piece by piece. source gives compressed bytes; left is what the member before did not use."""

    def __init__(self, source, left: bytes):
        self.source, self.left, self.out, self.zip = source, left, b"", zlib.decompressobj(31)

    def more(self) -> bool:
        if self.zip.eof:
            return False
        data = self.left or self.source.read(STEP)
        if not data:
            raise ValueError("an archive ends within a record")
        try:
            self.out += self.zip.decompress(data, STEP)
        except zlib.error as e:
            raise ValueError(f"a member cannot be inflated: {e}") from e
        self.left = self.zip.unused_data if self.zip.eof else self.zip.unconsumed_tail
        return True

    def upto(self, mark: bytes) -> bytes:
        while mark not in self.out:
            if not self.more():
                raise ValueError("a record has no end of its head")
        head, _, self.out = self.out.partition(mark)
        return head

    def pieces(self, n: int):
        while n:
            if not self.out and not self.more():
                raise ValueError("a record is shorter than its length")
            piece, self.out = self.out[:n], self.out[n:]
            n -= len(piece)
            yield piece


def read(archive):
    """(page_id, payload bytes, digest, type, refers_to) of each record of an archive, bytes or a binary file, in sequence."""
    source, left = io.BytesIO(archive) if isinstance(archive, bytes) else archive, b""
    while left or (left := source.read(STEP)):
        m = _Member(source, left)
        h = dict(x.split(": ", 1) for x in m.upto(END).decode().split("\r\n")[1:])
        block, payload, head, size = hashlib.sha256(), hashlib.sha256(), b"", None
        for piece in m.pieces(int(h["Content-Length"])):
            block.update(piece)
            if size is None:
                head += piece
                if END not in head:
                    continue
                http, _, piece = head.partition(END)
                size, got = int(http.rpartition(b": ")[2]), 0
            payload.update(piece)
            got += len(piece)
        while m.more():
            pass
        if m.out != END:
            raise ValueError("a record's length is wrong")
        if size is None or _b32(block.digest()) != h["WARC-Block-Digest"]:
            raise ValueError("a block differs from its digest")
        if h["WARC-Type"] == "response" and (got != size or _b32(payload.digest()) != h["WARC-Payload-Digest"]):
            raise ValueError("a payload differs from its digest")
        own, other = h["X-Page-ID"], h.get("X-Refers-To-Page-ID")
        yield int(own) if own else None, size, base64.b32decode(h["WARC-Payload-Digest"][7:]).hex(), h["WARC-Type"], int(other) if other else None
        left = m.left


def archives(pages: DataFrame) -> DataFrame:
    """A row per archive of about ARCHIVE bytes."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    first = p.where((F.octet_length("html") >= LEAST) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first"))
    p = p.join(first, "digest", "left").select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def run(batches):
        part, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                part.append(record(row[0], row[1], row[2].encode(), row[3]))
                size += len(part[-1])
                if size >= ARCHIVE:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(part)], pa.binary())], ["archive"])
                    part, size = [], 0
        if part:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(part)], pa.binary())], ["archive"])

    return p.mapInArrow(run, "archive binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every row, read back from the archives."""

    def run(batches):
        for b in batches:
            for a in b.column(0):
                c = list(zip(*read(a.as_py())))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return stored(archives(pages)).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
