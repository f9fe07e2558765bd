import os
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from docloom.plans.catalog import QUERIES, SQL  # noqa: E402


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _table(path, ids, vectors, labels):
    path.mkdir()
    t = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array(labels, pa.int32())})
    pq.write_table(t, path / "embeddings.parquet")
    return str(path)


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Many blocks of the former size, with a group of copies; scores that end in a half; vectors that are zero, missing or near to nothing; three rows."""
    at, r = tmp_path_factory.mktemp("vectors"), np.random.default_rng(3)
    large = r.normal(size=(5300, 16)).astype(np.float32)
    large[r.random(len(large)) < 0.2] = large[7]
    halves = np.where(r.random((700, 64)) < 0.5, 1.0, -1.0).astype(np.float32)
    halves[:, 32:] = 0
    odd = [list(map(float, v)) for v in r.normal(size=(130, 4)).astype(np.float32)]
    odd[20], odd[33], odd[40], odd[41], odd[60] = [0.0] * 4, [0.0] * 4, None, None, [1e-30, 2e-30, 0.0, 1e-30]
    labels = [None if i % 11 == 0 else 50 + i if i % 5 == 0 else i % 3 for i in range(130)]
    few = [[1.0, 2.0], None, [-2.0, 1.0]]
    return {
        "large": _table(at / "large", range(5300), large.tolist(), r.integers(0, 6, 5300)),
        "halves": _table(at / "halves", range(700), halves.tolist(), r.integers(0, 3, 700)),
        "odd": _table(at / "odd", [None if i == 77 else i - 40 for i in range(130)], odd, labels),
        "few": _table(at / "few", [0, 1, 20], few, [1, 1, 1]),
    }


@pytest.mark.parametrize("of", ["large", "halves", "odd", "few"])
@pytest.mark.parametrize("name", ["topk_cosine", "topk_gather", "topk_per_paper"])
def test_topk_equals_sql(spark, tables, name, of):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{tables[of]}/embeddings.parquet'")
    df = QUERIES[name](spark, tables[of])
    cols = sorted(df.columns)
    want = db.sql(f"select {', '.join(cols)} from ({SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, want))


def test_vectors_of_two_lengths(spark, tmp_path):
    at = _table(tmp_path / "t", [0, 1, 2], [[1.0, 2.0], [1.0], [2.0, 1.0]], [1, 1, 1])
    with pytest.raises(Exception, match="vectors differ in length"):
        QUERIES["topk_cosine"](spark, at).collect()


def test_places_and_missing_vectors(spark):
    """Without undefined: no row for a missing vector, 0 for a zero one, and the fifth place decides; with four places the chunk_id does."""
    from docloom.operators.retrieval import topk_per_paper

    chunks = spark.createDataFrame([("p", 1, [1.0, 0.001]), ("p", 2, [1.0, 0.0]), ("p", 3, None), ("q", 1, [0.0, 0.0])], "paper_id string, chunk_id int, embedding array<double>")
    asked = spark.createDataFrame([("a", [2.0, 0.0])], "question_id string, embedding array<float>")
    got = lambda **o: sorted((r.paper_id, r.rk, r.chunk_id, r.score) for r in topk_per_paper(chunks, asked, **o).collect())
    assert got() == [("p", 1, 2, 1.0), ("p", 2, 1, 1.0), ("q", 1, 1, 0.0)]
    assert got(places=4) == [("p", 1, 1, 1.0), ("p", 2, 2, 1.0), ("q", 1, 1, 0.0)]
