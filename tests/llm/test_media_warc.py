import io
import os
import random
import re
import struct
import sys
import zipfile
import zlib

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()


def png():
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(b"\0\0")) + part(b"IEND", b"")


def gif():
    return b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + bytes(6) + b"\x21\xf9\x04\0\0\0\0\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02\x44\x01\0" + b"\x3b"


def pdf():
    body = b"%PDF-1.4\n1 0 obj\n<<>>\nendobj\n"
    return body + b"xref\n0 1\n0000000000 65535 f \ntrailer\n<<>>\nstartxref\n%d\n%%%%EOF\n" % len(body)


def zipped():
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        z.writestr("a", "x" * 50), z.writestr("b", "y")
    return f.getvalue()


def test_sniffing_and_carving(spark):
    from docloom.llm.media import carve, store

    whole = {"image/png": png(), "image/gif": gif(), "application/pdf": pdf(), "application/zip": zipped(), "audio/wav": store(b"abc" * 7)}
    rows = [(i, v, "text/plain") for i, v in enumerate(whole.values())]
    rows += [(10 + i, v[:-3], k) for i, (k, v) in enumerate(whole.items())]  # cut: of no type
    rows += [(20, b"..".join([b"", *whole.values(), b"GIF89a %PDF-1.4 PK\x03\x04 RIFF"]), "image/gif"), (21, store(png() + b"x"), None), (22, None, "text/plain"), (23, b"", None), (24, b"plain", "text/plain")]
    got = {r.k: r for r in carve(spark.createDataFrame(rows, "k long, body binary, declared string"), "k", "body", "declared").collect()}
    assert [got[i].corrected for i in range(5)] == list(whole) and all(not got[i].carved for i in range(5))
    assert all(got[10 + i].corrected is None and not got[10 + i].carved for i in range(5))
    assert [(c.type, bytes(c.bytes)) for c in got[20].carved] == list(whole.items()) and got[20].corrected is None
    assert got[21].corrected == "audio/wav" and [bytes(c.bytes) for c in got[21].carved] == [png()]
    assert (got[22].corrected, got[23].corrected, got[24].corrected) == ("text/plain", None, "text/plain")


def test_media_cases(spark):
    from docloom.llm.media import media_digest

    d = spark.createDataFrame([(None, "a", 1), (1, None, 2), (1, "", 3), (2, "é" * 300_000, 4), (2, "é" * 300_000, 4)], "doc_id long, text string, feature int")
    got = sorted(map(tuple, media_digest(d).collect()), key=repr)
    assert len(got) == 5 and got[2:4][0] == got[2:4][1] and [g[1:3] for g in got] == [(0, 64), (0, 64), (600_000, 600_000), (600_000, 600_000), (1, 64)]
    assert media_digest(d.where("false")).collect() == []


def test_archives():
    from docloom.llm.warc import read, record

    r = random.Random(1)
    long = bytes(r.randrange(256) for _ in range(300_000))
    whole = [record(1, "http://a", b"x" * 200, None), record(2, "http://b\r\nX: y", b"x" * 200, 1), record(None, None, b"", None), record(3, "u", long, None), record(4, "u", b"\r\n\r\n: 7", None)]
    got = list(read(b"".join(whole)))
    assert [g[0] for g in got] == [1, 2, None, 3, 4] and [g[1] for g in got] == [200, 200, 0, 300_000, 7] and [g[3:] for g in got[:2]] == [("response", None), ("revisit", 1)]
    assert list(read(io.BytesIO(b"".join(whole)))) == got and list(read(b"")) == []
    plain = zlib.decompress(whole[0], 31)
    again = lambda b: (c := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(b) + c.flush()
    for bad in (whole[0][:-9], whole[0] + b"junk", again(plain.replace(b"xxx", b"yyy")), again(plain[:-4]), again(plain + b"z"), again(plain[:60]), again(re.sub(rb"([0-9]+)\r\n\r\nHTTP", lambda m: b"%d\r\n\r\nHTTP" % (int(m[1]) + 1), plain))):
        with pytest.raises((ValueError, KeyError)):
            list(read(bad))
    ids = {l for w in whole for l in zlib.decompress(w, 31).split(b"\r\n") if l.startswith(b"WARC-Record-ID")}
    assert len(ids) == len(whole)


def test_warc_cases(spark):
    from docloom.llm.warc import round_trip

    big = "<p>" + "z" * 500_000
    d = spark.createDataFrame([(5, "u", big, 1), (4, "u", big, 2), (4, "u", big, 3), (None, "u", big, 4), (6, None, None, 5)], "page_id long, url string, html string, digest int")
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in round_trip(d).collect()), key=repr)
    assert got == sorted([(5, "revisit", 4), (4, "response", None), (4, "response", None), (None, "revisit", 4), (6, "response", None)], key=repr)
    assert round_trip(d.where("false")).collect() == []
