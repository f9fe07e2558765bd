import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from docloom.plans.catalog import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()


@pytest.mark.parametrize("name", list(SQL))
def test_equal(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = db.sql(f"select {', '.join(cols)} from ({SQL[name]})").fetchall()
    assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(want, key=repr)


def test_chunks(spark):
    from docloom.operators.sections import chunks, pack, paragraph_rows, sentence_rows, split_table, words

    says = lambda t: [r.sentence for r in sentence_rows(paragraph_rows(spark.createDataFrame([(1, t)], "k int, text string"), ["k"]), ["k", "par"]).orderBy("par", "sent").collect()]
    assert says("Seen by Smith et al. in 1999. See J. Doe. and on. New one!\r\n\t\r\nlower\tstart") == ["Seen by Smith et al. in 1999.", "See J. Doe. and on.", "New one!", "lower start"]
    text = [f"S{i} {'w ' * (i % 9)}end." for i in range(120)] + ["x" * 50, "long " * 90]
    out = pack(text, 40, 10)
    assert all(words(c) <= 40 for c in out) and {w for c in out for w in c.split()} == set(" ".join(text).split())
    # A blob is cut by halves, each time of the rest.
    assert pack(["a" * 120], 32, 0, len) == ["a" * n for n in (30, 22, 17, 25, 26)] and pack([]) == []
    assert pack([f"s{i} a b c d e f g h i" for i in range(9)], 40, 12) == [" ".join(f"s{i} a b c d e f g h i" for i in r) for r in (range(4), range(3, 7), range(6, 9))]
    assert pack(["a b"] * 30, 50, 0, words, 20) == ["a b " * 9 + "a b"] * 3
    assert split_table("|h|\n|-|\n|a b|\n|c d|", 4) == ["|h|\n|-|\n|a b|", "|h|\n|-|\n|c d|"]
    md = "intro\n# A\nFirst. Second.\n| x |\n|-|\n| 1 |\nThird.\n### B\ndeep\n## C\nback\n# D\n\nend"
    got = [tuple(r) for r in chunks(spark.createDataFrame([(1, md), (2, None), (3, "")], "paper_id long, text string")).orderBy("paper_id", "chunk_id").select("chunk_id", "section", "is_table", "embed_text").collect()]
    assert got == [(0, "", False, "intro"), (1, "A", False, "[A] First. Second. Third."), (2, "A", True, "[A] | x |\n|-|\n| 1 |"), (3, "A > B", False, "[A > B] deep"), (4, "A > C", False, "[A > C] back"), (5, "D", False, "[D] end")]


def test_packing_is_greedy(spark):
    """Against one item at a time, for random sentences and both kinds of count."""
    import random
    from docloom.operators.sections import ranges

    r = random.Random(1)
    for _ in range(300):
        n = [r.randrange(1, 30) for _ in range(r.randrange(1, 25))]
        budget, overlap, want, at = r.randrange(30, 60), r.randrange(0, 30), [], 0
        for i in range(1, len(n) + 1):
            if i < len(n) and sum(n[at : i + 1]) <= budget:
                continue
            want.append((at, i))
            fit = [s for s in range(at, i) if sum(n[s:i]) <= overlap and sum(n[s : i + 1]) <= budget]
            longest = [s for s in range(at, i) if sum(n[s:i]) <= overlap]
            at = longest[0] if longest and longest[0] in fit else i
        assert list(ranges(len(n), lambda a, b: sum(n[a:b]), budget, overlap)) == want


def test_replies(spark):
    from pyspark.sql import functions as F
    from docloom.operators.choices import answer

    ids = ["F00-F99: Mental", "G00: Nerves", "1000-10000", "Unknown from this paper"]
    want = [('["F"]', "choices", [ids[0]]), ("['Unknown from this paper']", "choices", [ids[3]]), ('["C", "g", "zz"]', "choices", [ids[2], ids[1]]), ("It is 1000-10000, I think", "choices", [ids[2]]), ("no idea", "abstain", []), (None, "error", None)]
    # An abstention wins over the choice of that name, a list decides alone, a bare letter is no choice in prose, JSON comes before mentions.
    want += [("Unknown from this paper.", "abstain", []), ('["zz"] G00: Nerves', "abstain", []), ("A", "abstain", []), ('Not G00: Nerves\n```json\n{"id": "1000-10000"}\n```', "choices", [ids[2]]), ('"1000-10000"', "choices", [ids[2]]), ("It is G00.", "choices", [ids[1]]), ('{"answers": ["G00"]}', "choices", [ids[1]]), ("[true] 1000-10000", "choices", [ids[2]]), (r"['G00: Nerves',]", "choices", [ids[1]]), ("[]", "abstain", []), ("\u00a0unknown FROM this paper..\n", "abstain", [])]
    df = spark.createDataFrame([(i, w[0]) for i, w in enumerate(want)], "i int, reply string")
    got = [(r.reply, r.a.kind, r.a.ids) for r in df.select("i", "reply", answer(F.col("reply"), F.array(*map(F.lit, ids))).alias("a")).orderBy("i").collect()]
    assert got == want


def test_files(spark, tmp_path):
    import json
    from docloom.operators.prompts import ask
    from docloom.sources.files import answers, files, parse, questions, sheet, write_answers
    from docloom.streaming.ingest import ingest

    for n, content in (("a.pdf", b"one\ftwo"), ("b.pdf", b""), ("c.txt", b"no")):
        (tmp_path / n).write_bytes(content)
    (tmp_path / "q.json").write_text(json.dumps({"questions": [{"id": "Q1", "text": "t", "choices": ["x", "y"]}, {"id": "Q2", "text": "u"}]}, indent=1))
    (tmp_path / "s.csv").write_bytes(b"\xef\xbb\xbfpaper;q\np1;a; \n".replace(b"a; ", b'"a; b"'))
    assert [tuple(r) for r in questions(spark, str(tmp_path / "q.json")).orderBy("pos").collect()] == [(0, "Q1", "t", ["x", "y"]), (1, "Q2", "u", None)]
    assert [tuple(r) for r in sheet(spark, str(tmp_path / "s.csv")).collect()] == [("p1", "a; b")]
    cut = lambda f: parse(f, lambda b: b.decode().split("\f"), lambda b: 1 // 0)
    assert sorted(r.text for r in cut(files(spark, str(tmp_path))).collect()) == ["one", "two"]
    for _ in range(2):
        ingest(spark, str(tmp_path), str(tmp_path / "table"), str(tmp_path / "cp"), cut).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2
    p = spark.createDataFrame([("p-1", 0, "a"), ("p-1", 1, "b")], "paper string, pos int, prompt string")
    replies = ask(p, lambda x: [v.upper() for v in x])
    write_answers(replies, str(tmp_path / "out"))
    assert [a.reply for a in answers(spark, str(tmp_path / "out")).first().answers] == ["A", "B"]
    assert [r.reply for r in ask(p, lambda x: 1 // 0).collect()] == [None, None]


def test_query_set_grows(spark):
    import __spark_entry__ as E

    per = {q: [r[0] for r in spark.read.parquet(f"/root/testdata/{q}/embeddings.parquet").where("vec_id % 20 = 0").select("vec_id").collect()] for q in ("sf0.001", "sf0.01")}
    assert len(per["sf0.01"]) > 10
    for sf, ids in per.items():
        df = E.entry(spark) if sf == "sf0.001" else E.queries()["topk_cosine"](spark, f"/root/testdata/{sf}")
        assert sorted((r.query_id, r.rk) for r in df.collect()) == sorted((i, k) for i in ids for k in (1, 2, 3))


def test_range_names_are_unique(spark):
    from docloom.operators.store import range_names

    texts, used, want = ["a", "a", "a_1", "a", "a_1", "b", "b_1", "b", "9", "Q_9", "a_1_1", None], set(), []
    for t in texts:
        base = t if t is None or not t[0].isdigit() else f"Q_{t}"
        name, i = base, 1
        while t is not None and name in used:
            name, i = f"{base}_{i}", i + 1
        used.add(name)
        want.append(name)
    got = range_names(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t", "i").orderBy("i").collect()
    assert [r.range_name for r in got] == want and len(set(want)) == len(want)
