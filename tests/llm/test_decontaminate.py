import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()


@pytest.fixture(scope="module")
def voc(spark):
    return [w for d in spark.read.parquet(f"{SF}/documents.parquet").collect() for w in re.findall(r"[^\W_]+", d.text.lower())]


def edited(w, k, r, voc):
    w = list(w)
    for _ in range(k):
        p = r.randrange(len(w))
        w[p : p + r.randrange(2)] = r.choices(voc, k=r.randrange(2))
    return w


def test_lsh_tells_apart(voc):
    from docloom.llm.decontaminate import Samples, Words

    r, words = random.Random(2), Words()
    hashes = lambda w: np.array([words[x] for x in w], np.uint64)
    for n in (10, 30, 100):
        near = far = 0
        for _ in range(200):
            a, b = r.randrange(len(voc) - n), r.randrange(len(voc) - n)
            s = Samples.of([hashes(voc[a : a + n])])[0]
            near += s.alike(hashes((edited(voc[a : a + n], n // 5, r, voc) + r.choices(voc, k=n))[:n])[None, :])[0]
            far += voc[a : a + n] != voc[b : b + n] and s.alike(hashes(voc[b : b + n])[None, :])[0]
        assert near >= 0.97 * 200 and far < 0.05 * 200, (n, near, far)


def test_against_exact_edit_distance(spark, voc):
    """Every document and item, by the edit distance over all stretches of the whole document."""
    from docloom.llm.decontaminate import Words, find_items, hashed, nearest, remove_contaminated

    r, items, docs = random.Random(5), [], []
    for i in range(8):
        items.append((i, " ".join(r.choices(voc, k=r.choice([3, 5, 9, 14, 20, 33])))))
    for d in range(80):
        w = r.choices(voc, k=r.randrange(0, 60))
        if d % 4:
            i = items[r.randrange(8)][1].split()
            w[r.randrange(len(w) + 1) : 0] = edited(i, r.randrange(0, len(i) // 5 + 2), r, voc)
        docs.append((r.choice([d, None, 7]), " ".join(w)))
    words, want = Words(), []
    for i, t in docs:
        for j, x in items:
            item = hashed(x, words).tolist()
            dist = nearest(item, hashed(t, words).tolist())[0]
            if dist <= len(item) // 5:
                want.append((i, j, dist))
    frame = spark.createDataFrame([(*d, d[0]) for d in docs], f"{DOCS}, item_id long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(x.doc_id, x.item_id, x.distance) for x in find_items(frame, bench).collect()]
    left = list(want)
    for g in got:
        left.remove(g)  # nothing that exact distance does not have
    assert len(left) <= 0.03 * len(want)
    held = {t for (i, t) in docs if any(nearest(hashed(x, words).tolist(), hashed(t, words).tolist())[0] <= len(x.split()) // 5 for _, x in items)}
    kept = [(x.doc_id, x.text) for x in remove_contaminated(frame, bench).collect()]
    assert set(t for _, t in docs) - held <= {t for _, t in kept} and len([1 for _, t in kept if t in held]) <= 2


def test_long_text_and_long_item(spark, voc):
    from docloom.llm import decontaminate as D

    r = random.Random(9)
    item = " ".join(r.choices(voc, k=400))
    text = " ".join(r.choices(voc, k=150_000)) + " " + item + " " + " ".join(r.choices(voc, k=150_000))
    got = D.find_items(spark.createDataFrame([(1, text), (2, None)], DOCS), spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert [tuple(x) for x in got] == [(1, 5, 0, 150_000, 400)]
