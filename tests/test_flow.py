import json
import os
import sys

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def test_files_to_answers(spark, tmp_path):
    from docloom.plans import flow
    from docloom.sources import files as S

    folder = tmp_path / "papers"
    folder.mkdir()
    html = "<html><head><title>t</title></head><body><nav>menu</nav><h1>Methods</h1><p>We trained a random forest on images of lungs. It was fast.</p><h2>Data</h2><p>The data set had nine hundred patients in total.</p></body></html>"
    (folder / "b-two.html").write_text(html)
    (folder / "a one.html").write_text(html.replace("random forest", "support vector machine").replace("nine", "two"))
    (folder / "c.html").write_text("<p> </p>")
    (tmp_path / "q.json").write_text(json.dumps({"questions": [{"id": "Q1", "text": "Was a forest trained?", "choices": [{"id": "Random Forest: trees", "label": "RF"}, {"id": "SVM: margins"}]}, {"id": "Q2", "text": "How many patients had the data set?"}]}, indent=1))
    asked = []

    def model(prompts):
        asked.extend(prompts)
        return [{"text": "The answer is Random Forest." if "random forest" in p else "no idea", "model": "m", "total_tokens": len(p)} if "ANSWERS: ['Random Forest: trees', 'SVM: margins']" in p else p.split("CHUNK 1: ")[1].split("\n")[0] for p in prompts]

    s = flow.Settings(parser="html", pattern="*.html", top_k=1, model=model)
    cache = str(tmp_path / "cache")
    rows = flow.run(spark, str(folder), str(tmp_path / "q.json"), str(tmp_path / "out"), cache, s)
    got = {(r.paper, r.id): r for r in rows.collect()}
    assert len(got) == 6
    assert (got["b-two.html", "Q1"].answer, got["b-two.html", "Q1"].answer_label) == (["Random Forest: trees"], ["RF"])
    assert got["a one.html", "Q1"].answer_kind == "abstain" and got["a one.html", "Q1"].answer_text == "Unknown from this paper"
    assert got["b-two.html", "Q2"].answer_text == "[Methods > Data] The data set had nine hundred patients in total."
    assert got["a one.html", "Q2"].chunks_section == ["Methods > Data"] and got["c.html", "Q2"].answer_kind == "no_text"
    # The same settings find the index again, others do not.
    n = spark.read.parquet(cache).count()
    flow.run(spark, str(folder), str(tmp_path / "q.json"), str(tmp_path / "out"), cache, s)
    assert spark.read.parquet(cache).count() == n
    s.chunk_tokens = 40
    flow.run(spark, str(folder), str(tmp_path / "q.json"), str(tmp_path / "out"), cache, s)
    assert spark.read.parquet(cache).select("index_key").distinct().count() == 2
    assert S.write_papers(spark.read.parquet(str(tmp_path / "out")), str(tmp_path / "json")) == 3
    one = json.loads((tmp_path / "json" / "a_one_answers.json").read_text())
    assert one["paper"] == "a one.html" and [a["id"] for a in one["answers"]] == ["Q1", "Q2"]


def test_calls_are_tried_again(spark):
    from docloom.operators.prompts import Transient, ask

    def model(prompts, state={}):
        state["n"] = state.get("n", 0) + 1
        if state["n"] < 3:
            raise Transient("busy", 0.0)
        return ["ok"] * len(prompts)

    d = spark.createDataFrame([("x",)], "prompt string").coalesce(1)
    assert [(r.reply, r.error) for r in ask(d, model, attempts=3).collect()] == [("ok", None)]
    assert [(r.reply, r.error) for r in ask(d, lambda p: 1 // 0).collect()] == [(None, "ZeroDivisionError: integer division or modulo by zero")]


def test_evaluation(spark):
    from docloom.operators import evaluation as E

    sheet = lambda a, b: spark.createDataFrame([("My paper - one.pdf", a), ("Other.pdf", b)], "paper string, Q string")
    ans = lambda a, b: spark.createDataFrame([("My_paper___one_answers.json", 0, "Q", a, None, ["x y", "z", "w"]), ("Other_answers.json", 0, "Q", None, b, ["x y", "z", "w"])], "file string, pos int, question string, answer_ids array<string>, answer_text string, choices array<string>")
    kappas, scores = E.evaluate(ans(["x y", "w"], "Unknown"), ans(["z"], "Unknown"), E.sheet(sheet("X Y; z", "z"), "paper"), E.sheet(sheet("x y", "z"), "paper"))
    assert {(r.rater1, r.rater2): r.agreement for r in kappas.collect()} == {("model1", "rater1"): 0.5, ("model1", "rater2"): 0.666667, ("model2", "rater1"): 0.666667, ("model2", "rater2"): 0.5, ("model1", "model2"): 0.5}
    assert tuple(scores.first()) == (1, 1, 1, 0.5, 0.5)
    with pytest.raises(Exception, match="not one paper"):
        E.matched(ans(["z"], "z"), E.sheet(sheet("a", "b").where("paper = 'Other.pdf'"), "paper")).collect()


def test_cleaning_report(spark):
    from docloom.operators.cleaning import clean_papers

    page = lambda n: f"Journal of Things {n}\nThe {'abcd'[n - 1] * 3} classifi-\ncation of {'abcd'[n - 1] * 4} is what this whole line tells.\n42\n"
    rows = [("p", i, page(i)) for i in range(1, 5)] + [("p", 5, "A last line of this text, long enough to stay.\n## References\n[1] gone.")]
    r = clean_papers(spark.createDataFrame(rows, "paper_id string, page_no int, text string")).first()
    assert r.text.startswith("The aaa classification of aaaa") and "gone" not in r.text and "Journal" not in r.text and r.text.endswith("stay.\n")
    assert r.report.boilerplate_lines_removed == ["Journal of Things 1"]
    assert r.report.references_truncated and r.n_pages == 5 and r.report.chars_before_cleaning == sum(len(x[2]) for x in rows) + 8
