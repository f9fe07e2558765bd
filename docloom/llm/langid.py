"""Nearest-centroid language identification.

Normalised TF-IDF vectors of character 1- to 3-grams are compared by cosine with several clustered centroids per language,
fitted on at most PER_LANG labelled rows of each language by smallest hash (the fit's bound). N-grams are kept exactly,
without bins to collide in, and those unseen in training add to a text's length, not to its likeness. A text far from
every centroid is marked rejected. How far is too far depends on a text's number of n-grams: cosines of training rows, cut
to 1, 2, 4, ... words and taken without the n-grams that no other row has, give a bound for each doubling of it. Null
texts and texts without a letter are `und`. Repeated rows give equal rows; rows without an id are judged, never learned
from; an empty table gives none, other columns are not read (`keep_identified` passes them on), a whole text is judged.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

PER_LANG, CENTROIDS, LOWEST, SLACK, SIZES, GROUPS = 300, 3, 0.03, 0.5, 32, (64, 8, 1)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams as numbers, 21 bits a character, and how often each comes; a run of ASCII signs other than letters, or an end of the text, is one space."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "ignore"), np.uint32).astype(np.int64)
    c = np.where((c < 97) | (c > 122) & (c < 128), 32, c)
    c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))]
    two = (c[:-1] << 21) | c[1:]
    return np.unique(np.concatenate([c, two, (two[:-1] << 21) | c[2:]]), return_counts=True)


class Model:
    """keys: n-grams of the training rows; idf and cents have a last row for all others. least: bounds by size."""

    def __init__(self, texts: list[str], langs: list[str]):
        every = [grams(t) for t in texts]
        self.keys, seen = np.unique(np.concatenate([k for k, _ in every] or [np.zeros(0, np.int64)]), return_counts=True)
        self.idf = np.log((1 + len(texts)) / (1 + np.append(seen, 0))) + 1
        self.names, cents = [], []
        x = [self.vector(*g) for g in every]
        for lang in sorted(set(langs)):
            own = [v for v, l in zip(x, langs) if l == lang]
            c = np.zeros((len(self.idf), min(CENTROIDS, len(own))))
            for k, (at, v) in enumerate(own[:: max(1, len(own) // CENTROIDS)][:CENTROIDS]):
                c[at, k] = v
            for _ in range(8):
                near, new = [int((v @ c[at]).argmax()) for at, v in own], np.zeros_like(c)
                for k, (at, v) in zip(near, own):
                    new[at, k] += v
                size = np.linalg.norm(new, axis=0)
                c = np.where(size > 0, new / np.where(size > 0, size, 1), c)
            self.names += [lang] * c.shape[1]
            cents.append(c)
        self.cents = np.concatenate(cents, 1) if cents else np.zeros((len(self.idf), 0))
        self.cents[-1] = 0
        self.least = self._bounds(texts, np.append(seen, 0) < 2)

    def vector(self, key: np.ndarray, n: np.ndarray, alone: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of cents and values, of norm 1; n-grams marked alone count as unseen."""
        at = np.searchsorted(self.keys, key)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != key] = len(self.keys)
        if alone is not None:
            at[alone[at]] = len(self.keys)
        v = np.log1p(n) * self.idf[at]
        return at, v / (np.linalg.norm(v) or 1)

    def _bounds(self, texts: list[str], alone: np.ndarray) -> np.ndarray:
        """SLACK times the cosine that 99 in 100 pieces of training rows of each size reach, never falling as texts grow."""
        found = [[] for _ in range(SIZES)]
        for t in texts:
            w, n = t.split(), 1
            while True:
                for piece in {" ".join(w[i : i + n]) for i in range(0, min(len(w), 4 * n), n)}:
                    if any(c.isalpha() for c in piece):
                        g = grams(piece)
                        at, v = self.vector(*g, alone)
                        found[size(g)].append((v @ self.cents[at]).max())
                if n >= len(w):
                    break
                n *= 2
        low = [SLACK * np.quantile(f, 0.01) if len(f) >= 20 else LOWEST for f in found]
        return np.maximum.accumulate(np.maximum(low, LOWEST))

    def judge(self, text: str) -> tuple[str, float, bool]:
        """Language, cosine, whether it is too low."""
        g = grams(text)
        at, v = self.vector(*g)
        s = v @ self.cents[at]
        k = int(s.argmax())
        return self.names[k], float(min(1, max(0, s[k]))), bool(s[k] < self.least[size(g)])


def size(g: tuple[np.ndarray, np.ndarray]) -> int:
    return min(SIZES - 1, len(g[0]).bit_length())


def fit(docs: DataFrame) -> Model:
    train = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    by = [F.xxhash64("doc_id"), "doc_id"]
    rows = train.select("doc_id", "lang")
    for groups in GROUPS:  # the first of each hashed group, then of ever fewer: no language gathers in one task
        n = F.row_number().over(Window.partitionBy("lang", F.pmod(by[0], F.lit(groups))).orderBy(*by))
        rows = rows.withColumn("n", n).where(F.col("n") <= PER_LANG).drop("n")
    # of an id that comes with several texts, the least
    rows = train.join(rows.select("doc_id", "lang").distinct(), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    rows = sorted(rows.select("lang", "text").collect())
    return Model([r.text for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame) -> DataFrame:
    model = fit(docs)

    def run(batches):
        for b in batches:
            got = [model.judge(t) if ok and model.names else ("und", 0.0, True) for t, ok in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            pred, score, far = ([g[i] for g in got] for i in range(3))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    d = docs.select("doc_id", held.alias("held_out"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("ok"))
    return d.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, whose language is identified; null, letterless and far texts go."""
    model = fit(docs)
    at = docs.columns.index("text")

    def known(t):
        return bool(model.names) and t is not None and any(c.isalpha() for c in t) and not model.judge(t)[2]

    def run(batches):
        for b in batches:
            yield b.filter(pa.array([known(t) for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
