"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact verification.

A document is its set of distinct 5-word shingles (one of the whole sequence if it is shorter; none without words), kept
as 64-bit hashes. Equal sets are folded into one row first. Bands of ROWS minima give buckets; each member is compared
with the smallest id of its buckets. Links found so make components, and only buckets that still hold several of them
are compared member by member, in blocks of bounded size and on larger sketches too, pairs inside a component being
skipped since they change no component. Signatures are compared a batch at a time: a pair is dropped once the posterior chance that its similarity
reaches the threshold is below MISS. Survivors are decided on full sets. The chance that a pair at the threshold shares
no bucket is (1 - 0.85^5)^24, below one in a million.

Null and empty texts have no shingles and link with nothing; repeated rows and ties share a component; rows with a null
id stand for themselves and link with nothing; an id that comes with several texts is one document, judged by the one of
them whose hash is largest, and all its rows get that one's result; other columns are not read; an empty table gives no rows.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.components import components
from docloom.llm.shared import small_batches, stored

SHINGLE, BANDS, ROWS, BATCH, MISS, BLOCK, SKETCH, SLACK = 5, 24, 5, 20, 1e-5, 256, 512, 2
PERMS, CACHE = BANDS * ROWS, 300_000
M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]
MULT = np.random.default_rng(7).integers(0, 2**32, (PERMS, 1), dtype=np.uint32) | np.uint32(1)
ADD = np.random.default_rng(8).integers(0, 2**32, (PERMS, 1), dtype=np.uint32)
PAIRS = "a long, b long, bands int"


def least_equal(percent: int, most: int = 0) -> np.ndarray:
    """For 0 to PERMS minima compared, or for the one number most: how many must be equal for P(similarity >= percent / 100 | data) >= MISS, prior uniform."""
    s = (np.arange(4000) + 0.5) / 4000
    high, out = s >= percent / 100, np.zeros(max(PERMS, most) + 1, np.int64)
    for n in [most] if most else range(1, PERMS + 1):
        k = np.arange(n + 1)[:, None]
        like = k * np.log(s) + (n - k) * np.log1p(-s)
        like = np.exp(like - like.max(1, keepdims=True))
        out[n] = np.argmax(like[:, high].sum(1) / like.sum(1) >= MISS)
    return out


class Words(dict):
    """64-bit hashes of words; emptied when it grows, which changes no result."""

    def __missing__(self, w):
        import xxhash

        if len(self) > CACHE:
            self.clear()
        v = self[w] = xxhash.xxh64_intdigest(w)
        return v


def shingles(text: str | None, words: Words) -> np.ndarray:
    """Sorted distinct hashes. bytes.lower and bytes.split know ASCII only, as the definition asks."""
    w = (text or "").encode().lower().split()
    h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
    n = min(SHINGLE, len(h))
    if not n:
        return h
    x = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        x = (x ^ h[k : len(h) - n + 1 + k]) * M[k % 2]
        x ^= x >> np.uint64(29)
    return np.unique(x)


def signature(s: np.ndarray) -> np.ndarray:
    low, out = (s >> np.uint64(32)).astype(np.uint32), np.full(PERMS, 2**32 - 1, np.uint32)
    for i in range(0, len(low), 2048):
        np.minimum(out, (MULT * low[i : i + 2048] + ADD).min(1), out=out)
    return out


def alike(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Indexes of the rows of two signature matrices that pass every batch."""
    on, eq = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i in range(0, PERMS, BATCH):
        eq = eq + (a[on, i : i + BATCH] == b[on, i : i + BATCH]).sum(1)
        ok = eq >= least[i + BATCH]
        on, eq = on[ok], eq[ok]
    return on


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, PERMS)


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, t (a hash of the text), n, digest of the set, sig; the last two null for empty sets."""

    def run(batches):
        import xxhash

        words = Words()
        for b in batches:
            n, dig, sig = [], [], []
            for t in b.column(1).to_pylist():
                s = shingles(t, words)
                n.append(len(s))
                dig.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(dig, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "t", "n", "digest", "sig"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, "doc_id long, t long, n long, digest binary, sig binary")


def _banded(reps: DataFrame) -> DataFrame:
    """h, k: a row per band and representative."""

    def run(batches):
        import xxhash

        for b in batches:
            m = _matrix(b.column(1))
            h = [xxhash.xxh64_intdigest(m[r, i * ROWS : (i + 1) * ROWS].tobytes(), seed=i) for r in range(len(m)) for i in range(BANDS)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), BANDS))], ["h", "k"])

    return reps.select("k", "sig").mapInArrow(run, "h long, k long")


def _pruned(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a link."""
    least = least_equal(percent)

    def run(batches):
        for b in batches:
            keep = alike(_matrix(b.column(2)), _matrix(b.column(3)), least) if b.num_rows else []
            yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    side = lambda k: reps.select(F.col("k").alias(k), F.col("n").alias(f"n_{k}"), F.col("sig").alias(f"sig_{k}"))
    p = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return p.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that are links on their full sets."""

    def run(batches):
        words, memo = Words(), {}

        def of(k, t):
            if k not in memo:
                if len(memo) > 64:
                    memo.clear()
                memo[k] = shingles(t, words)
            return memo[k]

        for b in batches:
            keep = []
            for i, (ka, kb, ta, tb) in enumerate(zip(*(c.to_pylist() for c in b.columns))):
                x, y = of(ka, ta), of(kb, tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    side = lambda k: texts.select(F.col("k").alias(k), F.col("text").alias(f"text_{k}"))
    p = pairs.join(side("a"), "a").join(side("b"), "b")
    return p.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _lowest(texts: DataFrame) -> DataFrame:
    """k, low: the SKETCH smallest 32-bit halves of the set's hashes, all of them for sets up to that size."""

    def run(batches):
        words = Words()
        for b in batches:
            low = [np.unique((shingles(t, words) >> np.uint64(32)).astype(np.uint32))[:SKETCH].tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(low, pa.binary())], ["k", "low"])

    return texts.select("k", "text").mapInArrow(run, "k long, low binary")


def may_link(x: np.ndarray, y: np.ndarray, nx: int, ny: int, percent: int, least: int) -> bool:
    """For sets that are whole in their sketches: whether they link, give or take SLACK equal 32-bit hashes; else by the posterior bound."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    if max(nx, ny) <= SKETCH:
        return 100 * (both + SLACK) >= percent * (nx + ny - both - SLACK)
    low = np.union1d(x, y)[:SKETCH]
    return len(low) < SKETCH or np.count_nonzero(np.isin(low, x, assume_unique=True) & np.isin(low, y, assume_unique=True)) >= least


def _rest(bands: DataFrame, comp: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket, compared in blocks.

    Pairs that pass the signature test are compared on set sketches within the block, so that unlike pairs of a large
    group make no rows.
    """
    least, fewest = least_equal(percent), int(least_equal(percent, SKETCH)[SKETCH])
    m = bands.join(comp, bands["k"] == comp["id"], "left").select("h", "k", F.coalesce("component", "k").alias("c"))
    open_ = m.groupBy("h").agg(F.count("*").alias("m"), F.min("c").alias("low"), F.max("c").alias("high")).where("m > 2 and low != high").select("h", "m")
    m = m.join(open_, "h").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    m = m.withColumn("mine", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    data = reps.select("k", "n", "sig").join(_lowest(texts), "k")
    m = m.join(data, "k").select("h", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "k", "c", "n", "sig", "low")

    def run(key, t):
        i, j = key[1].as_py(), key[2].as_py()
        mine, k, c, n = (t.column(x).to_numpy() for x in ("mine", "k", "c", "n"))
        sig = _matrix(t.column("sig"))
        low = [np.frombuffer(v, np.uint32) for v in t.column("low").to_pylist()]
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        out = []
        for x in left:
            y = right[(c[right] != c[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x]))]
            y = y[k[y] > k[x]] if i == j else y
            y = y[alike(np.broadcast_to(sig[x], (len(y), PERMS)), sig[y], least)]
            y = y[[may_link(low[x], low[z], int(n[x]), int(n[z]), percent, fewest) for z in y.tolist()]] if len(y) else y
            out.append(np.stack([np.minimum(k[y], k[x]), np.maximum(k[y], k[x])]))
        z = np.concatenate(out, 1) if out else np.zeros((2, 0), np.int64)
        return pa.table({"a": pa.array(z[0]), "b": pa.array(z[1])})

    return m.groupBy("h", "i", "j").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; link: 100 * intersection >= percent * union.

    All Python work is done and stored before this returns, so the session's batch size is set for its time only.
    """
    before = small_batches(docs.sparkSession)
    try:
        return _classes(docs, percent)
    finally:
        small_batches(docs.sparkSession, before)


def _classes(docs: DataFrame, percent: int) -> DataFrame:
    d = stored(sketch(docs))
    known = d.where("n > 0 and doc_id is not null")
    own = stored(known.groupBy(F.col("doc_id").alias("own")).agg(F.max(F.struct("t", "digest", F.col("n").alias("size"))).alias("x")).select("own", "x.*"))
    rep = stored(own.groupBy("digest").agg(F.min("own").alias("k"), F.count("*").alias("copies")))
    first = own.join(rep.select("k"), F.col("own") == F.col("k"), "left_semi").select("own", F.col("t").alias("own_t"))
    reps = d.join(first, (d["doc_id"] == first["own"]) & (d["t"] == first["own_t"]))
    reps = stored(reps.select(F.col("doc_id").alias("k"), "t", "n", "sig").dropDuplicates(["k"]))
    bands = stored(_banded(reps))
    lead = bands.groupBy("h").agg(F.min("k").alias("lead"), F.count("*").alias("m")).where("m > 1").select("h", "lead")
    shared = stored(bands.join(lead, "h"))
    pairs = stored(shared.where("k != lead").select(F.col("lead").alias("a"), F.col("k").alias("b")).distinct())
    ids = pairs.select("a").union(pairs.select("b")).distinct()
    ids = ids.join(reps.select("k", "t"), F.col("a") == F.col("k")).select("a", F.col("t").alias("a_t"))
    every = docs.where("text is not null").select(F.col("doc_id").alias("k"), "text")
    texts = stored(every.join(ids.hint("merge"), (F.col("k") == F.col("a")) & (F.xxhash64("text") == F.col("a_t")), "left_semi")).dropDuplicates(["k"])
    links = stored(_linked(_pruned(pairs, reps, percent), texts, percent))
    comp = components(links)
    more = stored(_linked(stored(_rest(shared, comp, reps, texts, percent)), texts, percent))
    comp = stored(components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more)))
    groups = rep.where("copies > 1").select(F.col("digest").alias("dig"), "k")
    o = own.join(groups, F.col("digest") == F.col("dig"), "left").select("own", "size", F.coalesce("k", "own").alias("k"))
    o = o.join(comp, F.col("k") == F.col("id"), "left").select("own", "size", F.coalesce("component", "k").alias("of"))
    r = d.select("doc_id", "n").join(o, F.col("doc_id") == F.col("own"), "left")
    c = F.coalesce("of", "doc_id")
    return r.select("doc_id", F.coalesce("size", "n").alias("n_shingles"), c.alias("component_id"), c.eqNullSafe(F.col("doc_id")).alias("kept"))
