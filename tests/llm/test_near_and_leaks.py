import os
import random
import re
import sys
from collections import defaultdict

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()


def shingle_sets(rows):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = min(5, len(w))
        out[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if n else set()
    return out


def smallest_reachable(sets, percent=85):
    to, inv = {i: i for i in sets}, defaultdict(list)

    def root(x):
        while to[x] != x:
            x = to[x]
        return x

    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in inv[s]:
                shared[j] += 1
            inv[s].append(i)
        for j, c in shared.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = sorted((root(i), root(j)))
                to[b] = a
    return {i: root(i) for i in sets}


def chained(seed=1, n=60):
    """Texts of 400 words, each with two words changed from the one before: far ends are unlike, neighbours are alike."""
    r = random.Random(seed)
    w, out = [f"w{r.randrange(9999)}" for _ in range(400)], []
    for i in range(n):
        w[r.randrange(400)] = w[r.randrange(400)] = f"v{r.randrange(9999)}"
        out.append((5000 + i, " ".join(w)))
    r.shuffle(out)
    return out


def test_near_duplicates(spark):
    from docloom.llm.near_dup import near_duplicates

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += chained() + [(9001, None), (9002, ""), (9003, "One two"), (9004, "one\ttwo"), (9005, "one three"), (9006, "long " * 90_000)]
    sets = shingle_sets(rows)
    want = smallest_reachable(sets)
    got = near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), c, c == i) for i, c in want.items()}
    odd = spark.createDataFrame([(1, "a b c", 1), (1, "a b c", 2), (None, "a b c", 3), (2, "A b c", 4)], f"{DOCS}, n long")
    assert sorted(map(tuple, near_duplicates(odd).collect()), key=repr) == sorted([(1, 1, 1, True), (1, 1, 1, True), (None, 1, None, True), (2, 1, 1, False)], key=repr)
    twice = spark.createDataFrame([(3, "a b c d e f"), (5, "a b c d e f"), (5, "u v w x y z"), (5, None), (6, None)], DOCS)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(twice).collect()}
    assert got in [{(3, 2, 3, True), (5, 2, c, c == 5), (6, 0, 6, True)} for c in (3, 5)]
    assert near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_find_items(spark):
    from docloom.llm.decontaminate import find_items

    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    flat = lambda t: f" {' '.join(re.findall(r'[^\W_]+', t.lower()))} "
    whole = {(d.doc_id, b.item_id) for d in docs.collect() for b in items.collect() if flat(b.text) in flat(d.text)}
    got = find_items(docs, items).collect()
    assert whole <= {(r.doc_id, r.item_id) for r in got} and all(r.distance == 0 for r in got if (r.doc_id, r.item_id) in whole)
    r, edited, voc = random.Random(3), [], [w for d in docs.limit(50).collect() for w in d.text.split()]
    for b in items.collect():
        w = re.findall(r"[^\W_]+", b.text.lower())
        for _ in range(len(w) // 5):
            p = r.randrange(len(w))
            w[p : p + r.randrange(2)] = r.choices(voc, k=r.randrange(2))
        edited.append((b.item_id, " ".join(r.choices(voc, k=60) + w + r.choices(voc, k=60))))
    found = {(x.doc_id, x.item_id) for x in find_items(spark.createDataFrame(edited, DOCS), items).collect()}
    assert sum((i, i) in found for i, _ in edited) >= 0.98 * len(edited)
    odd = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "a b c", 0), (3, "x A, b! c y", 0), (3, "x A, b! c y", 0)], f"{DOCS}, item_id long")
    bench = spark.createDataFrame([(7, "a b c"), (8, None), (9, ""), (7, "a b c")], "item_id long, text string")
    assert {tuple(r) for r in find_items(odd, bench).collect()} == {(None, 7, 0, 0, 3), (3, 7, 0, 1, 3)}
    assert find_items(odd, bench.where("false")).collect() == []


def test_edit_distance():
    from docloom.llm.decontaminate import nearest

    assert nearest([1, 2, 3], [9, 1, 2, 3, 9]) == (0, 1, 4)
    assert nearest([1, 2, 3, 4], [9, 1, 3, 4, 9]) == (1, 1, 4)


def test_redaction(spark):
    from docloom.llm.secrets import redact_secrets

    rows = [(1, "x password=abcdef12 y", "s"), (2, None, "s"), (3, "", None), (4, "clean ß", "s"), (5, "k " + "0123456789abcdef" * 2, "s")]
    got = {r.doc_id: r.text for r in redact_secrets(spark.createDataFrame(rows, f"{DOCS}, digest string")).collect()}
    assert got == {1: "x [SECRET] y", 2: None, 3: "", 4: "clean ß", 5: "k [SECRET]"}


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    comp = smallest_reachable(shingle_sets([(i, r.text) for i, r in rows.items()]), 80)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {i for i, r in rows.items() if comp[i] == i and not any(b in r.text for b in items)}
    out = P.run(spark, SF).collect()
    assert {r.doc_id for r in out} == want
    assert sum(r.size for r in out) > 0 and all(0 <= r.taken <= 2 * r.size for r in out)


def test_links(spark):
    """Each weak candidate and the parts in its scope, by all pairs of one text."""
    from docloom.llm.secrets import PARTS, SCOPE, redact_secrets, scan_secrets

    r, rows = random.Random(8), []
    bits = ["AKIA" + "B" * 16, "aB3/" * 10, "https://h.example", "token=abcdefgh", "0123456789abcdef" * 2, "word"]
    for i in range(120):
        rows.append((i, " ".join(x + " " + "z" * r.choice([1, 50, 390, 420]) for x in r.choices(bits, k=r.randrange(12)))))
    rows += [(500, " ".join(["token=abcdefgh https://h.example"] * 400)), (501, None), (501, ""), (None, bits[0] + " " + bits[1])]
    frame = spark.createDataFrame([(*x, 1) for x in rows], f"{DOCS}, weak int")
    kinds = [("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{6,})"), ("access", "AKIA[A-Z0-9]{16,}"), ("key", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])"), ("endpoint", r"https?://[A-Za-z0-9.-]+")]
    got = sorted(((x.doc_id, x.spans, x.links) for x in scan_secrets(frame).collect()), key=repr)
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows if t}
    for i, spans, links in got:
        found = [(k, m.start(), m.end()) for k, p in kinds for m in re.finditer(p, texts.get(i, ""))]
        want = {w for w in found if w[0] in PARTS and any(p[0] in PARTS[w[0]] and w[1] <= p[2] + SCOPE and p[1] <= w[2] + SCOPE for p in found)}
        say = lambda x: ":".join(map(str, x))
        assert {say(w) for w in want} == {x for x in spans.split(",") if x.split(":")[0] in PARTS} == {x.split(">")[0] for x in links.split(",") if x}
        for x in filter(None, links.split(",")):
            w, p = (y.split(":") for y in x.split(">"))
            assert p[0] in PARTS[w[0]] and int(w[1]) <= int(p[2]) + SCOPE and int(p[1]) <= int(w[2]) + SCOPE
    assert scan_secrets(frame.where("false")).collect() == redact_secrets(frame.where("false")).collect() == []


def test_many_matches_in_one_text(spark):
    """Four times the matches of one text take far less than sixteen times as long; and redaction is right across pieces."""
    import time
    from docloom.llm.pii import find_personal_data
    from docloom.llm.secrets import redact_secrets, scan_secrets

    leak = "token=abcdefgh é https://h.example "
    for f, unit, seen in ((scan_secrets, leak, "n_assign"), (redact_secrets, leak, None), (find_personal_data, "a@b.example 10.0.0.1 call (415) 555-2671 ", "n_email")):
        took = []
        for m in (8_000, 32_000):
            d, t = spark.createDataFrame([(1, unit * m)], DOCS), time.time()
            r = f(d).first()
            took.append(time.time() - t)
            assert r[seen] == m if seen else r.text == "[SECRET] é [SECRET] " * m
        assert took[1] < 8 * max(took[0], 1), (f.__name__, took)
