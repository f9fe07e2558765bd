"""Exact removal of repeated 20-word windows, found by difference-cover anchors.

Windows of 8 words are hashed only at positions that lie in {0, 1, 3, 9} modulo 13. Every difference modulo 13 occurs in
that cover, so two equal 20-word windows share an aligned anchor. Anchors that occur once rule windows out; around the
others windows are extended to 20 words and decided by 96-bit digests, for a comparison of words in pairs would grow with
the square of a group of copies.

Documents are dealt into chunks of about CHUNK bytes by a hash of the row. A chunk sends each distinct anchor once, packed
by hash into a row per bucket, and gets one bit for each back; the same goes for the windows, with the smallest id that the
chunk has for each. So a passage that all documents share costs a chunk one entry, texts are shuffled once, and what comes
back is a bit for an anchor or window.

Null text and text of under 20 words lose nothing; a very long text is one chunk by itself. Null ids rank last; rows that
share an id do not take from each other, only from smaller ids and from themselves. Repeated rows give equal rows; other
columns, whatever their names, are not read; an empty table gives no rows.
"""
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.near_dup import Words

WINDOW, PERIOD, COVER, ANCHOR = 20, 13, (0, 1, 3, 9), 8
LAST, CHUNK, ROWS = 2**63 - 1, 4 << 20, 50_000
M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]
KEEP = np.isin(np.arange(PERIOD), COVER)
WORDS = Words()  # of a worker, across its chunks
SENT, BACK = "bucket long, chunk long, many binary, k binary, a binary, b binary", "chunk long, kind int, bucket long, bits binary"


def _mix(a, b, seed):
    x = a * M[0] ^ (b + M[1] * np.uint64(2 * seed + 1))
    x ^= x >> np.uint64(32)
    x *= M[1]
    return x ^ (x >> np.uint64(29))


def _hash8(h, seed):
    h2 = _mix(h[:-1], h[1:], seed)
    h4 = _mix(h2[:-2], h2[2:], seed)
    return h4, _mix(h4[:-4], h4[4:], seed)


def _hash20(h, seed):
    h4, h8 = _hash8(h, seed)
    return _mix(_mix(h8[:-8], h8[8:], seed)[:-4], h4[16:], seed)


def _bits(rows: dict, order: np.ndarray, ends: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """The bits that came back for each entry; order and ends tell which entries went to each bucket."""
    out = np.zeros(len(order), bool)
    for b, i, j in zip(buckets.tolist(), ends[:-1].tolist(), ends[1:].tolist()):
        out[order[i:j]] = np.unpackbits(np.frombuffer(rows[b], np.uint8), count=j - i).astype(bool)
    return out


def _dealt(bucket: np.ndarray, *rank: np.ndarray):
    """Entries in the order of bucket and rank, where each bucket's begin and end, and the buckets."""
    order = np.lexsort((*rank, bucket))
    names, start = np.unique(bucket[order], return_index=True)
    return order, np.append(start, len(order)), names


class Chunk:
    """The documents of a chunk, ordered by id, as one array of word hashes; windows across two documents are left out."""

    def __init__(self, t: pa.Table, chunks: int):
        self.chunks = np.uint64(chunks)
        k = t.column("k").to_numpy()
        self.rows = np.argsort(k, kind="stable")
        text = t.column("text").to_pylist()
        self.words = [(text[i] or "").encode().split() for i in self.rows.tolist()]
        size = np.array([len(w) for w in self.words], np.int64)
        n = int(size.sum())
        self.h = np.fromiter((WORDS[x] for w in self.words for x in w), np.uint64, n)
        self.of = np.repeat(np.arange(len(size)), size)
        self.k, self.end = k[self.rows], np.cumsum(size)
        at = np.arange(n) - np.repeat(self.end - size, size)
        self.left = np.repeat(size, size) - at
        self.at = np.flatnonzero(KEEP[at % PERIOD] & (self.left >= ANCHOR) & (np.repeat(size, size) >= WINDOW))

    def anchors(self):
        """Distinct anchors, which of them come more than once, the anchor of each place, and how they are dealt."""
        if not len(self.at):
            return None
        value, which, n = np.unique(_hash8(self.h, 0)[1][self.at], return_inverse=True, return_counts=True)
        return value, n > 1, which, _dealt((value % self.chunks).astype(np.int64))

    def windows(self, rows: dict):
        """Candidate windows in the order of digest and place: places, the group of each, and per group a, b, smallest id and how they are dealt."""
        value, _, which, dealt = self.anchors()
        flag = np.zeros(len(self.h) + 1, np.int64)
        flag[1:][self.at[_bits(rows, *dealt)[which]]] = 1
        c = np.cumsum(flag)
        p = np.flatnonzero(self.left >= WINDOW)
        p = p[c[p + PERIOD] > c[p]]
        if not len(p):
            return None
        a, b = _hash20(self.h, 0)[p], (_hash20(self.h, 1)[p] >> np.uint64(32)).astype(np.uint32)
        o = np.lexsort((b, a))  # stable: places, and so ids, rise within a group
        p, a, b = p[o], a[o], b[o]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        k = self.k[self.of[p[new]]]
        return p, np.cumsum(new) - 1, a[new], b[new], k, _dealt((a[new] % self.chunks).astype(np.int64), k)

    def kept(self, anchor_rows: dict, window_rows: dict):
        """Per document, in the order of rows: number of words, of removed ones, digest of the rest."""
        cut = np.zeros(len(self.h) + 1, np.int64)
        w = self.windows(anchor_rows) if self.anchors() else None
        if w:
            p, group, _, _, k, dealt = w
            doc = self.of[p]
            own = np.append(False, (group[1:] == group[:-1]) & (doc[1:] == doc[:-1]))
            again = p[_bits(window_rows, *dealt)[group] | (self.k[doc] > k[group]) | own]
            np.add.at(cut, again, 1)
            np.add.at(cut, again + WINDOW, -1)
        stays = np.cumsum(cut)[:-1] <= 0
        for words, end in zip(self.words, self.end.tolist()):
            s = stays[end - len(words) : end]
            n = int(s.sum())
            rest = words if n == len(words) else [words[i] for i in np.flatnonzero(s).tolist()]
            yield len(words), len(words) - n, hashlib.sha256(b" ".join(rest)).hexdigest()


def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together, so that the shuffle's compression takes those that hardly change."""
    return x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<i8")[:, 0]


def _sent(chunk: int, dealt, many=None, k=None, a=None, b=None) -> pa.Table:
    order, ends, names = dealt
    cut = lambda x, f: [f(x[order[i:j]]) for i, j in zip(ends[:-1], ends[1:])] if x is not None else [None] * len(names)
    cols = [pa.array(names, pa.int64()), pa.array([chunk] * len(names), pa.int64()), *(pa.array(cut(x, f), pa.binary()) for x, f in ((many, lambda v: np.packbits(v).tobytes()), (k, _planes), (a, lambda v: v.tobytes()), (b, lambda v: v.tobytes())))]
    return pa.table(cols, ["bucket", "chunk", "many", "k", "a", "b"])


def _empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.table({n: pa.array([], kinds[t]) for n, t in (x.split() for x in schema.split(", "))})


def _answer(t: pa.Table, kind: int, decide) -> pa.Table:
    """decide gets a row number per entry, in whose order the bits go back, a row for each that came."""
    a = [np.frombuffer(x, np.uint64) for x in t.column("a").to_pylist()]
    size = np.array([len(x) for x in a])
    yes = decide(np.concatenate(a), size)
    bits = [np.packbits(x).tobytes() for x in np.split(yes, np.cumsum(size)[:-1])]
    return pa.table([t.column("chunk"), pa.array([kind] * len(bits), pa.int32()), t.column("bucket"), pa.array(bits, pa.binary())], ["chunk", "kind", "bucket", "bits"])


def _repeated(t: pa.Table) -> pa.Table:
    """Anchors of a bucket that two chunks have, or one more than once."""

    def decide(a, size):
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(t.column("many").to_pylist(), size.tolist())])
        _, which, n = np.unique(a, return_inverse=True, return_counts=True)
        return (n + np.bincount(which, many) > 1)[which]

    return _answer(t, 0, decide)


def _earlier(t: pa.Table) -> pa.Table:
    """Windows of a bucket that have a smaller id in another chunk."""

    def decide(a, size):
        b = np.concatenate([np.frombuffer(x, np.uint32) for x in t.column("b").to_pylist()])
        k = np.concatenate([_from_planes(x) for x in t.column("k").to_pylist()])
        o = np.lexsort((k, b, a))
        new = np.append(True, (a[o][1:] != a[o][:-1]) | (b[o][1:] != b[o][:-1]))
        out = np.empty(len(o), bool)
        out[o] = k[o] > k[o][new][np.cumsum(new) - 1]
        return out

    return _answer(t, 1, decide)


def _by_bucket(t: pa.Table, kind: int) -> dict:
    return {b: x for q, b, x in zip(t.column("kind").to_pylist(), t.column("bucket").to_pylist(), t.column("bits").to_pylist()) if q == kind}


def remove_repeats(docs: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    size = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    chunks = 1 + (size[0] or 0) // chunk_bytes + size[1] // ROWS
    base = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("k"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"))

    def anchors(key, t):
        x = Chunk(t, chunks).anchors()
        return _sent(key[0].as_py(), x[3], x[1], None, x[0]) if x else _empty(SENT)

    def windows(key, t, back):
        w = Chunk(t, chunks).windows(_by_bucket(back, 0)) if back.num_rows else None
        return _sent(key[0].as_py(), w[5], None, w[4], w[2], w[3]) if w else _empty(SENT)

    def results(key, t, back):
        c = Chunk(t, chunks)
        n, gone, digest = zip(*c.kept(_by_bucket(back, 0), _by_bucket(back, 1)))
        return pa.table([t.column("doc_id").take(pa.array(c.rows)), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    known = base.groupBy("chunk").applyInArrow(anchors, SENT).groupBy("bucket").applyInArrow(_repeated, BACK)
    wins = base.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(windows, SENT)
    both = known.unionAll(wins.groupBy("bucket").applyInArrow(_earlier, BACK))
    return base.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(results, "doc_id long, n_words long, n_removed long, kept_sha256 string")
