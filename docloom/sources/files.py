"""Readers and writers of the extraction pipeline."""
import json
import os
from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators.store import content_id, output_name

QUESTIONS = "questions array<struct<id string, text string, choices array<string>>>"


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf", required: bool = False) -> DataFrame:
    """path, content, paper_id, filename of a folder's own files; with required, none is an error."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    if required and d.select("path").isEmpty():
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return d.select("path", "content", content_id(F.col("content")).alias("paper_id"), F.regexp_extract("path", "[^/]+$", 0).alias("filename"))


def templates(spark: SparkSession, path: str) -> dict[str, str]:
    """The prompt templates of a JSON object, by name."""
    return spark.read.option("multiLine", True).json(path).first().asDict()


def secret(path: str | None, variable: str) -> str:
    """A key from a file, else from the environment; none is an error. It stays with the driver."""
    if path:
        with open(path, encoding="utf-8") as f:
            found = f.read().strip()
    else:
        found = os.environ.get(variable, "")
    if not found:
        raise ValueError(f"no key in {path or variable}")
    return found


def table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Some columns of a CSV file."""
    return spark.read.csv(path, header=True, multiLine=True).select(*columns)


def questions(spark: SparkSession, path: str) -> DataFrame:
    """pos, id, text, choices; a question without id or text is an error, a choice given as an object keeps its JSON text."""
    q = spark.read.schema(QUESTIONS).option("multiLine", True).json(path).select(F.posexplode("questions").alias("pos", "q")).select("pos", "q.*")
    need = lambda c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a question has no {c}"))).otherwise(F.col(c)).alias(c)
    return q.select("pos", need("id"), need("text"), "choices")


def sheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep=";", header=True, multiLine=True)


def answers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(folder).withColumn("file", F.col("_metadata.file_name"))


def answer_rows(read: DataFrame) -> DataFrame:
    """answers() as rows (file, pos, id, question, answer_ids, answer_text, choices): answer is a list of choices or one text, which the file's JSON tells apart by [."""
    kind = read.schema["answers"].dataType.elementType
    had = lambda c, cast: F.col(f"a.{c}").cast(cast) if c in kind.names else F.lit(None).cast(cast)
    d = read.select("file", F.posexplode("answers").alias("pos", "a"))
    raw = F.to_json(F.col("a.answer")) if kind["answer"].dataType.typeName() == "array" else F.col("a.answer")
    ids = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    return d.select("file", "pos", had("id", "string").alias("id"), F.col("a.question").alias("question"), ids.alias("answer_ids"), F.when(ids.isNull(), raw).alias("answer_text"), had("choices_ids", "array<string>").alias("choices"))


def text_pages(content: bytes) -> list[str]:
    """The offline parser of plain text: pages end at form feeds."""
    return content.decode("utf-8", "replace").replace("\u00ad", "").split("\f")


class _Html(HTMLParser):
    SKIP, BREAK = {"script", "style", "nav", "footer", "head"}, {"p", "br", "div", "li", "tr", "section", "article"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skip += 1
        elif not self.skip and tag in self.BREAK:
            self.out.append("\n")
        elif not self.skip and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            self.out.append("\n" + "#" * int(tag[1]) + " ")

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif not self.skip and (tag in self.BREAK or len(tag) == 2 and tag[0] == "h"):
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def html_pages(content: bytes) -> list[str]:
    """The offline parser of HTML: one page of Markdown with headings and paragraphs, without scripts, styles, menus and footers."""
    p = _Html()
    p.feed(content.decode("utf-8", "replace"))
    p.close()
    return ["".join(p.out).strip()]


# Name: parser, version, whether it gives Markdown, and what it lacks here (a missing library ends the run).
PARSERS: dict[str, tuple] = {"text": (text_pages, "1", False), "html": (html_pages, "1", True)}


def parsed(found: DataFrame, requested: str = "text", fallback: str = "text", parsers: dict | None = None) -> DataFrame:
    """files() as rows per page: paper_id, page_no, text, parser, version, requested, fallback_used, is_markdown and, for a file that no parser reads, page_no null and error.

    An unknown parser is an error at once, and so is an ImportError of the one requested; any other failure of it, or no text, leads to the fallback.
    """
    known = PARSERS | (parsers or {})
    if requested not in known or fallback not in known:
        raise ValueError(f"unknown parser: {requested if requested not in known else fallback}")

    def run(batches):
        for b in batches:
            rows = []
            for paper, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                why = None
                for used in dict.fromkeys((requested, fallback)):
                    read, version, md = known[used]
                    try:
                        pages = read(content)
                    except ImportError:
                        raise
                    except Exception as e:
                        why = f"{type(e).__name__}: {e}"
                        continue
                    if any(p.strip() for p in pages):
                        rows += [(paper, i, p, used, version, requested, used != requested, md, why) for i, p in enumerate(pages, 1)]
                        break
                else:
                    rows.append((paper, None, None, fallback, known[fallback][1], requested, fallback != requested, known[fallback][2], why or "no text"))
            cols = list(zip(*rows)) or [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.string()))], ["paper_id", "page_no", "text", "parser", "version", "requested", "fallback_used", "is_markdown", "error"])

    return found.select("paper_id", "content").mapInArrow(run, "paper_id string, page_no int, text string, parser string, version string, requested string, fallback_used boolean, is_markdown boolean, error string")


def parse(found: DataFrame, parser: Callable[[bytes], list[str]], fallback: Callable[[bytes], list[str]]) -> DataFrame:
    """paper_id, page_no, text, fallback_used: a file whose parser fails or finds no text goes to the fallback; one that fails there too has no pages."""
    def run(batches):
        for b in batches:
            rows = []
            for paper, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for used, f in ((False, parser), (True, fallback)):
                    try:
                        pages = f(content)
                    except Exception:
                        continue
                    if any(p.strip() for p in pages):
                        rows += [(paper, i, p, used) for i, p in enumerate(pages, 1)]
                        break
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.bool_()))], ["paper_id", "page_no", "text", "fallback_used"])

    return found.select("paper_id", "content").mapInArrow(run, "paper_id string, page_no int, text string, fallback_used boolean")


def write_answers(rows: DataFrame, path: str) -> None:
    """rows(paper, pos, …): one JSON line per paper, in a folder named after it."""
    rest = [c for c in rows.columns if c not in ("paper", "pos")]
    g = rows.groupBy("paper").agg(F.array_sort(F.collect_list(F.struct("pos", *rest))).alias("x"))
    g.select(output_name(F.col("paper")).alias("name"), "paper", F.transform("x", lambda x: F.struct(*[x[c].alias(c) for c in rest])).alias("answers")).write.partitionBy("name").mode("overwrite").json(path)


def write_papers(rows: DataFrame, folder: str, runtime: float | None = None) -> int:
    """rows(paper, pos, …): one indented JSON file per paper, named by output_name, written where the rows are; the number of files.

    folder must be one that every executor sees. A file is written under another name and then moved, so a task that runs again leaves whole files.
    """
    rest = [c for c in rows.columns if c not in ("paper", "pos")]
    g = rows.groupBy("paper").agg(F.array_sort(F.collect_list(F.struct("pos", *rest))).alias("x"))
    g = g.select(output_name(F.regexp_replace("paper", r"\.[^.]*$", "")).alias("name"), "paper", F.to_json(F.transform("x", lambda x: F.struct(*[x[c].alias(c) for c in rest])), {"ignoreNullFields": "false"}).alias("answers"))

    def run(batches):
        for b in batches:
            for name, paper, found in zip(*(c.to_pylist() for c in b.columns)):
                path = os.path.join(folder, f"{name}_answers.json")
                with open(f"{path}.{os.getpid()}.tmp", "w", encoding="utf-8") as f:
                    json.dump({"paper": paper, "answers": json.loads(found), "runtime": runtime}, f, indent=2, ensure_ascii=False)
                os.replace(f.name, path)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["files"])

    os.makedirs(folder, exist_ok=True)
    return g.mapInArrow(run, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
