"""Exact cosine retrieval, scored block by block as matrix products."""
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

# Numbers of a block of vectors (one of queries has a quarter), blocks at least, columns and scores of a piece, rows sent on at once.
BLOCK, BLOCKS, COLUMNS, PIECE, SENT = 1 << 22, 16, 2048, 1 << 18, 50_000
HALF = np.nextafter(0.5, 0)  # floor(x + HALF) rounds halves up and nothing below them
NAN, NONE = 2, -2  # ranked as scores: what is no number comes first, what is missing last


def l2_norm(v):
    d = F.transform(v, lambda x: x.cast("double"))
    return F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))


def _matrix(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A row for each vector, zeros where there is none, and which rows have one."""
    a = column.combine_chunks()
    length = pc.list_value_length(a)
    has = pc.fill_null(pc.greater(length, 0), False).to_numpy(zero_copy_only=False)
    lengths = pc.unique(length.drop_null()).to_pylist() or [0]
    values = a.flatten()
    if len(lengths) > 1 or values.null_count:
        raise ValueError("vectors differ in length or hold nulls")
    m = np.zeros((len(a), lengths[0]))
    m[has] = values.to_numpy(zero_copy_only=False).reshape(-1, lengths[0]) if lengths[0] else 0
    return m, has


def _best_of_cell(t: pa.Table, keys: list[str], k: int, places: int, apart: bool, undefined: bool) -> Iterator[tuple[pa.Array, list[pa.Array], pa.Array]]:
    """Query ids, keys and scores of the best k of each query, among the rows with the same first key if there are two keys."""
    asked, held = t.filter(t["asked"]), t.filter(pc.invert(t["asked"]))
    if not asked.num_rows or not held.num_rows:
        return
    held = held.take(pc.sort_indices(held, sort_keys=[(c, "ascending") for c in keys]))
    (q, q_has), (v, v_has) = _matrix(asked["vector"]), _matrix(held["vector"])
    if q_has.any() and v_has.any() and q.shape[1] != v.shape[1]:
        raise ValueError("vectors differ in length or hold nulls")
    v = v if v.shape[1] == q.shape[1] else np.zeros((len(v), q.shape[1]))  # of one side no row has a vector
    q_square, v_square = (np.einsum("ij,ij->i", m, m) for m in (q, v))
    ids, columns = asked["query_id"].combine_chunks(), [held[c].combine_chunks() for c in keys]
    scale = 10.0**places
    n, (x, y) = len(v), (c.to_numpy() if apart else None for c in (ids, columns[0]))
    starts = [0]
    if len(keys) > 1:
        group = columns[0].dictionary_encode(null_encoding="encode").indices.to_numpy()
        starts += (np.flatnonzero(np.diff(group)) + 1).tolist()

    def piece(i: slice, j: slice) -> tuple[np.ndarray, np.ndarray]:
        """Ranks, in which no two columns are equal: by rounded score, then the earlier column; and scores."""
        s = q[i] @ v[j].T
        s /= np.sqrt(np.multiply.outer(q_square[i], v_square[j]))
        np.clip(s, -1, 1, out=s)
        if not undefined:
            s[q_square[i] == 0], s[:, v_square[j] == 0] = 0, 0
        r = _rounded(s, scale)
        if np.isnan(r.sum()):
            r[np.isnan(r)] = NAN * scale
        r[~q_has[i]], r[:, ~v_has[j]] = NONE * scale, NONE * scale
        r *= n
        r += np.arange(n - 1 - j.start, n - 1 - j.stop, -1)
        if apart:
            r[x[i, None] == y[None, j]] = -np.inf
        return _largest(r, s, k)

    with np.errstate(all="ignore"):
        for start, end in zip(starts, [*starts[1:], n]):
            rows = max(1, PIECE // min(end - start, COLUMNS))
            for at in range(0, len(q), rows):
                i = slice(at, min(at + rows, len(q)))
                r, s = zip(*(piece(i, slice(c, min(c + COLUMNS, end))) for c in range(start, end, COLUMNS)))
                r, s = _largest(np.hstack(r), np.hstack(s), k)
                kept = np.nonzero(r > -np.inf)
                place, col = np.divmod(r[kept], n)
                col = pa.array((n - 1 - col).astype(np.int64))
                yield ids.take(pa.array(at + kept[0])), [c.take(col) for c in columns], pa.array(_rounded(s[kept], scale) / scale, mask=place == NONE * scale, from_pandas=False)


def _rounded(s: np.ndarray, scale: float) -> np.ndarray:
    """As whole numbers of 1 / scale; halves go away from zero."""
    y = s * scale
    r = np.abs(y)
    r += HALF
    np.floor(r, out=r)
    return np.copysign(r, y, out=r)


def _largest(r: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if r.shape[1] <= k:
        return r, s
    at = np.argpartition(r, -k, axis=1)[:, -k:]
    return np.take_along_axis(r, at, 1), np.take_along_axis(s, at, 1)


def _scored(vectors: DataFrame, queries: DataFrame, keys: list[str], k: int, places: int, apart: bool, undefined: bool) -> DataFrame:
    """query_id, keys and score of what can be among the best k of a query: each block of vectors passes on its own best k.

    Both tables are dealt by a hash into blocks of a bounded size. Each block of queries meets each block of vectors in a
    group of its own, so each query is compared with every row; within a group, small pieces are scored at once.
    """
    if not undefined:
        vectors, queries = vectors.where(F.col("embedding").isNotNull()), queries.where(F.col("query").isNotNull())
    kinds = {d.schema[c].dataType.simpleString() for d, c in ((vectors, "embedding"), (queries, "query"))}
    kind = "array<float>" if kinds == {"array<float>"} else "array<double>"

    def blocks(rows: DataFrame, vector: str, size: int, least: int) -> int:
        n, width = rows.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()
        return max(least, -(-n * max(width or 1, 1) // size))

    n_v, n_q = blocks(vectors, "embedding", BLOCK, BLOCKS), blocks(queries, "query", BLOCK // 4, 1)
    types = {"query_id": queries.schema["query_id"].dataType, **{c: vectors.schema[c].dataType for c in keys}}
    none = lambda c: F.lit(None).cast(types[c]).alias(c)
    dealt = lambda c, n: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    v = vectors.select(F.lit(False).alias("asked"), none("query_id"), *keys, F.col("embedding").cast(kind).alias("vector"), dealt([*keys, "embedding"], n_v).alias("block_v"), each(n_q).alias("block_q"))
    q = queries.select(F.lit(True).alias("asked"), "query_id", *map(none, keys), F.col("query").cast(kind).alias("vector"), each(n_v).alias("block_v"), dealt(["query_id", "query"], n_q).alias("block_q"))
    names = [*types, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = []
        for ids, columns, score in _best_of_cell(pa.Table.from_batches(list(batches)), keys, k, places, apart, undefined):
            waiting.append(pa.RecordBatch.from_arrays([ids, *columns, score], names))
            if sum(b.num_rows for b in waiting) >= SENT:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting = []
        yield from waiting

    schema = ", ".join(f"{c} {t.simpleString()}" for c, t in types.items())
    return v.unionByName(q).groupBy("block_v", "block_q").applyInArrow(run, f"{schema}, score double")


def topk_cosine(vectors: DataFrame, queries: DataFrame, k: int = 3, undefined: bool = False) -> DataFrame:
    """vectors(vec_id, embedding), queries(query_id, query): best k per query by score of four places, ties by vec_id; a query never returns itself.

    With undefined, rows without a vector score null and come last, zero vectors score NaN and come first, as in SQL;
    else the former go and the latter score 0.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    v = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    q = queries.where(F.col("query_id").isNotNull()).select(F.col("query_id").cast("long").alias("query_id"), "query")
    d = _scored(v, q, ["vec_id"], k, 4, True, undefined)
    w = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), "vec_id")
    return d.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)


def topk_per_paper(chunks: DataFrame, questions: DataFrame, k: int = 3, places: int = 9, undefined: bool = False) -> DataFrame:
    """chunks(paper_id, chunk_id, embedding), questions(question_id, embedding): of each paper, the best k chunks for each question by score of so many places, 4 to 9, ties by chunk_id.

    Columns paper_id, question_id, chunk_id, score (four places), rk. A paper with fewer chunks gives them all. undefined: as for topk_cosine.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if not 4 <= places <= 9:
        raise ValueError("places must be 4 to 9")
    q = questions.select(F.col("question_id").alias("query_id"), F.col("embedding").alias("query"))
    c = chunks.select("paper_id", F.col("chunk_id").cast("long").alias("chunk_id"), "embedding")
    d = _scored(c, q, ["paper_id", "chunk_id"], k, places, False, undefined).withColumnRenamed("query_id", "question_id")
    w = Window.partitionBy("paper_id", "question_id").orderBy(F.desc_nulls_last("score"), F.asc_nulls_last("chunk_id"))
    d = d.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)
    score = F.round("score", 4).alias("score") if places > 4 else "score"
    return d.select("paper_id", "question_id", "chunk_id", score, "rk")


def embed(rows: DataFrame, text: str, embedder: Callable[[list[str]], list], at_once: int = 8) -> DataFrame:
    """rows with a column embedding; embedder takes and gives lists, at_once texts a call, and is made once a worker if it has a method load."""
    def run(batches):
        encode = embedder.load() if hasattr(embedder, "load") else embedder
        for b in batches:
            texts, out = b.column(text).to_pylist(), []
            for i in range(0, len(texts), at_once):
                out += [list(map(float, v)) for v in encode(texts[i : i + at_once])]
            yield b.append_column("embedding", pa.array(out, pa.list_(pa.float32())))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, embedding array<float>")


def hashing_embedder(dim: int = 256) -> Callable[[list[str]], list]:
    """The offline default: counts of words in dim slots by a hash of each."""
    import zlib

    def encode(texts):
        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                out[i, zlib.crc32(w.strip(".,;:!?()[]").encode()) % dim] += 1
        return out

    return encode


def incomplete(chunks: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Per key: chunks, those with a vector, and whether none lacks one."""
    have = vectors.select(key, "chunk_id").distinct().withColumn("have", F.lit(1))
    g = chunks.join(have, [key, "chunk_id"], "left").groupBy(key).agg(F.count(F.lit(1)).alias("chunks"), F.count("have").alias("vectors"))
    return g.withColumn("complete", F.col("chunks") == F.col("vectors"))
