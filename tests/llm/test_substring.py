import hashlib
import os
import random
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()


def plain(rows):
    """The contract, row by row: smaller ids and the row itself take; null ids come last."""
    firsts, out = {}, []
    key = lambda i: (i is None, i or 0)
    for i, x in sorted(rows, key=lambda r: key(r[0])):
        w = (x or "").encode().split()
        for p in range(len(w) - 19):
            firsts.setdefault(tuple(w[p : p + 20]), key(i))
    for i, x in rows:
        w, seen, gone = (x or "").encode().split(), set(), set()
        for p in range(len(w) - 19):
            g = tuple(w[p : p + 20])
            if firsts[g] < key(i) or g in seen:
                gone.update(range(p, p + 20))
            seen.add(g)
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(y for n, y in enumerate(w) if n not in gone)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_bytes", [3000, 4 << 20])
def test_repeats(spark, chunk_bytes):
    from docloom.llm.substring_dedup import remove_repeats

    r = random.Random(4)
    voc = [f"w{n}" for n in range(400)]
    passage = r.choices(voc, k=60)
    data = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(120).collect()]
    for i in range(150):
        w = r.choices(voc, k=r.randrange(0, 90))
        a = r.randrange(0, 40)
        w[r.randrange(len(w) + 1) : 0] = passage[a : a + r.randrange(10, 45)] if i % 3 else []
        data.append((r.choice([None, 900 + i // 2, 1, 2]), " ".join(w)))
    long = " ".join(f"w{n % 31}" for n in range(200))
    data += [(900, long), (901, "x " + long), (902, None), (None, long), (903, ""), (904, " \t\n"), (905, "y " * 200_000), (906, "one two"), (906, long), (906, long)]
    got = remove_repeats(spark.createDataFrame([(*x, "n") for x in data], "doc_id long, text string, chunk string"), chunk_bytes).collect()
    assert sorted(map(tuple, got), key=repr) == plain(data)


def test_none(spark):
    from docloom.llm.substring_dedup import remove_repeats

    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
