import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from docloom.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()


@pytest.mark.parametrize("name", list(SQL))
def test_equal(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    want = db.sql(f"select {', '.join(df.columns)} from ({SQL[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_secret_links_equal(spark):
    """The tables hold no access identifiers, so linked candidates are compared on random texts of parts."""
    import random

    import pyarrow as pa
    from docloom.llm.secrets import scan_secrets

    r = random.Random(3)
    bits = ["AKIA" + "B7" * 9, "AKIASHORT", "k/9" * 13 + "Z", "q" * 41, "https://api.example.org", "http://x", 'Api_Key: "abc123def"', "TOKEN=short", "password = hunter2x", "0f" * 14, "é ü", "x" * 150, "word " * 40]
    texts = ["".join(r.choice(bits) + r.choice([" ", ", ", "\n"]) for _ in range(r.randrange(1, 16))) for _ in range(300)] + ["", None]
    documents = pa.table({"doc_id": list(range(len(texts))), "text": texts})
    df = scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    db = duckdb.connect()
    db.register("documents", documents)
    want = db.sql(f"select {', '.join(df.columns)} from ({SQL['op10_secret_scans']})").fetchall()
    got = sorted(map(tuple, df.collect()), key=repr)
    assert got == sorted(want, key=repr) and sum(bool(x[-1]) for x in got) > 50 and sum(x[2] for x in got) > 50
