"""Benchmark passages in documents, by CGK embeddings and bit-sampling LSH over item-sized windows.

Words are runs of letters and digits, lower-cased. An item of n words is found where at most n // 5 word edits turn it
into a stretch of the document. Steps in a task, over every window of the whole text:

1. Item-sized windows that share too few word q-grams with the item to lie within that distance are ruled out by the
   q-gram lemma (exact, no loss); q is at most 3 and shorter where the pigeonhole principle asks it.
2. The others are embedded by WALKS random walks (CGK), which turn edit distance into Hamming distance, and compared
   with the item's embedding in TABLES samples of BITS positions a walk (one less for items of LONG words or more), drawn from the steps before the item's walk
   ends; one equal sample makes a candidate. The two ends are padded by different signs, so padding never agrees. Of
   windows n // 5 edits away at least 995 in 1000 pass, of unrelated windows under 5 (measured for items of 5 to 200
   words; a test holds it).
3. Candidates are decided by exact edit distance against every stretch near the window.

The benchmark is read in blocks of about BLOCK_BYTES of text (a longer item is a block with few others), a pass over the
documents for each, so what goes to the tasks is bounded whatever its size. Documents are not shuffled. Null and empty texts and items hold nothing and match
nothing; items under 5 words match only whole; repeated items and rows give repeated results; null ids stay null; other
columns are not read; empty tables give no rows.
"""
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.near_dup import Words

EDITS, WALKS, TABLES, BITS, LONG, BLOCK_BYTES = 5, 16, 24, 3, 150, 4_000_000
WORD = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, item_id long, distance int, start_word int, n_words int"
ITEM_END, WINDOW_END = np.uint64(0), np.uint64(1)
M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]


def hashed(text: str | None, words: Words) -> np.ndarray:
    w = WORD.findall((text or "").lower())
    return np.fromiter(map(words.__getitem__, w), np.uint64, len(w))


def grams(h: np.ndarray, q: int) -> np.ndarray:
    x = np.full(max(0, len(h) - q + 1), q, np.uint64)
    for k in range(q if len(x) else 0):
        x = (x ^ h[k : len(h) - q + 1 + k]) * M[k % 2]
        x ^= x >> np.uint64(29)
    return x


def embed(windows: np.ndarray, walk: int, steps: int, end: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """CGK: the first steps of each row's walk, and at which step it reaches the row's end; a hash of step and word says whether the walk moves on."""
    c, n = windows.shape
    x = np.concatenate([windows, np.full((c, 1), end)], 1)
    at, rows, out, ends = np.zeros(c, np.int64), np.arange(c), np.empty((c, steps), np.uint64), np.full(c, steps)
    for j in range(steps):
        w = out[:, j] = x[rows, at]
        bit = ((w ^ np.uint64(walk * 1_000_003 + j + 1)) * M[1]) >> np.uint64(40)
        at = np.minimum(at + (bit & np.uint64(1)).astype(np.int64), n)
        ends = np.where((at == n) & (ends == steps), j + 1, ends)
    return out, ends


class Samples:
    """An item's embeddings and the places compared: BITS of them a sample, all before the item's walk ends."""

    def __init__(self, walks: list):
        draw, self.walks = np.random.default_rng(len(walks[0][0])), []
        for e, end in walks:
            picks = draw.integers(0, end, (TABLES, BITS - (len(e) >= 3 * LONG)))
            self.walks.append((picks, e[picks], int(picks.max()) + 1))

    @classmethod
    def of(cls, items: list[np.ndarray]) -> list["Samples"]:
        """For items of one length, which walk together."""
        walks = [embed(np.stack(items), v, 3 * len(items[0]), ITEM_END) for v in range(WALKS)]
        return [cls([(e[i], end[i]) for e, end in walks]) for i in range(len(items))]

    def alike(self, windows: np.ndarray) -> np.ndarray:
        """Which rows agree with the item in a whole sample."""
        ok = np.zeros(len(windows), bool)
        for v, (picks, own, steps) in enumerate(self.walks):
            left = np.flatnonzero(~ok)
            if not len(left):
                break
            ok[left] = (embed(windows[left], v, steps, WINDOW_END)[0][:, picks] == own).all(2).any(1)
        return ok


def nearest(item: list, region: list) -> tuple[int, int, int]:
    """Least edit distance of the item to a stretch of the region, with the stretch's start and end (leftmost end, then latest start)."""
    row = [(0, -j) for j in range(len(region) + 1)]
    for i, w in enumerate(item, 1):
        new = [(i, 0)]
        for j, v in enumerate(region, 1):
            d, s = row[j - 1]
            new.append(min((d + (w != v), s), (row[j][0] + 1, row[j][1]), (new[j - 1][0] + 1, new[j - 1][1])))
        row = new
    d, end = min((x[0], j) for j, x in enumerate(row))
    return d, -row[end][1], end


class Index:
    """The items of one block: their q-grams with offsets, and their embeddings."""

    def __init__(self, items):
        self.words, self.items, self.grams = Words(), [], {}
        for item_id, text in items:
            h = hashed(text, self.words)
            if not (n := len(h)):
                continue
            k = n // EDITS
            q = min(3, -(-(n - k) // (k + 1)))
            me = len(self.items)
            self.items.append((item_id, h, k, max(1, n - q + 1 - k * q)))
            for off, g in enumerate(grams(h, q).tolist()):
                self.grams.setdefault(q, {}).setdefault(g, []).append((me, off))
        self.samples, lengths = {}, {}
        for me, x in enumerate(self.items):
            lengths.setdefault(len(x[1]), []).append(me)
        for same in lengths.values():
            self.samples.update(zip(same, Samples.of([self.items[me][1] for me in same])))
        self.known = {q: np.array(sorted(g), np.uint64) for q, g in self.grams.items()}

    def starts(self, h):
        """Per item, window starts that pass the q-gram lemma: shared grams lie within k diagonals of the window's."""
        found = {}
        for q, known in self.known.items():
            x = grams(h, q)
            at = np.minimum(np.searchsorted(known, x), len(known) - 1)
            for p in np.flatnonzero(known[at] == x).tolist():
                for me, off in self.grams[q][int(x[p])]:
                    found.setdefault(me, []).append((p - off, p))
        for me, hits in found.items():
            _, _, k, need = self.items[me]
            diag = np.array(sorted(hits))
            lo, hi = np.searchsorted(diag[:, 0], diag[:, 0] - k), np.searchsorted(diag[:, 0], diag[:, 0] + k, "right")
            keep = np.unique(diag[hi - lo >= need, 0])
            if len(keep):
                yield me, keep

    def alike(self, me, h, starts):
        """Starts of windows that agree with the item in one sample of an embedding."""
        at = starts[:, None] + np.arange(len(self.items[me][1]))
        w = np.where((at >= 0) & (at < len(h)), h[np.clip(at, 0, len(h) - 1)], WINDOW_END)
        return starts[self.samples[me].alike(w)]

    def matches(self, text):
        h = hashed(text, self.words)
        for me, starts in self.starts(h):
            item_id, item, k = self.items[me][:3]
            starts, best, reach = self.alike(me, h, starts), None, None
            for s in starts.tolist():
                if reach is not None and s <= reach:
                    continue
                # one region for all starts within n of this one: its stretches include theirs
                reach = s + len(item)
                a, b = max(0, s - k), min(len(h), reach + len(item) + k)
                d, x, y = nearest(item.tolist(), h[a:b].tolist())
                if d <= k and (best is None or d < best[0]):
                    best = (d, a + x, y - x)
            if best:
                yield (item_id, *best)


def _pass(docs: DataFrame, items: list) -> DataFrame:
    def run(batches):
        index = Index(items)
        for b in batches:
            out = [(i, *m) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for m in index.matches(t)]
            cols = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "item_id", "distance", "start_word", "n_words"])

    return docs.where("text is not null").select("doc_id", "text").mapInArrow(run, SCHEMA)


def _blocks(benchmark: DataFrame):
    """The items of one block after the other, on the driver."""
    items = benchmark.select("item_id", "text").where("octet_length(text) > 0")
    blocks = 1 + int((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES)
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield sorted(((r[0], r[1]) for r in part.collect()), key=repr)


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for every document and item found in it: the least distance, and the stretch of words that has it."""
    found = [_pass(docs, items) for items in _blocks(benchmark)]
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs in which no item is found, whatever their ids; all columns stay, and nothing is shuffled."""
    at = docs.columns.index("text")

    def clean(items):
        def run(batches):
            index = Index(items)
            for b in batches:
                yield b.filter(pa.array([t is None or next(index.matches(t), None) is None for t in b.column(at).to_pylist()], pa.bool_()))

        return run

    for items in _blocks(benchmark):
        docs = docs.mapInArrow(clean(items), docs.schema)
    return docs
