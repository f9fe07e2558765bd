"""Prompts, and the model behind an interface."""
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

CLOSED = "INSTRUCTIONS: {instructions}\n\nQUESTION: {question}\n\nPAPER: {paper}\n\nANSWERS: {answers}\n\nCONTEXT: \n\n{context}\n\n"
OPEN = CLOSED.replace("ANSWERS: {answers}\n\n", "")
FAILED = "api_request_failed"
# Calls of a request, seconds added to the pause before each next one.
ATTEMPTS, PAUSE = 6, 1.5


class Transient(Exception):
    """A failure worth another call, after so many seconds if the server says."""

    def __init__(self, message: str = "", after: float | None = None):
        super().__init__(message)
        self.after = after


def context(texts: Column) -> Column:
    return F.array_join(F.transform(texts, lambda x, i: F.concat(F.lit("CHUNK "), (i + 1).cast("string"), F.lit(": "), x)), "\n\n\n")


def as_list(items: Column) -> Column:
    """Items as a list literal in single quotes, in double quotes where an item has single ones only."""
    safe = lambda x: F.replace(x, F.lit("\\"), F.lit("\\\\"))
    quoted = lambda x: F.when(x.contains("'") & ~x.contains('"'), F.concat(F.lit('"'), safe(x), F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(safe(x), F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))


def ranked(hits: DataFrame, keys: list[str], rank: str, columns: list[str]) -> DataFrame:
    """One row per key: an array of each column in the order of rank."""
    g = hits.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(rank, *columns))).alias("x"))
    return g.select(*keys, *[F.col(f"x.{c}").alias(c) for c in columns])


def prompt(question: Column, choices: Column, texts: Column, closed: str = CLOSED, opened: str = OPEN, paper: Column | None = None) -> Column:
    """A template's {question}, {answers}, {paper} and {context} filled in, each once; opened is for questions without choices."""
    parts = {"question": question, "answers": as_list(choices), "paper": paper if paper is not None else F.lit(""), "context": context(texts)}

    def fill(template: str) -> Column:
        out, rest = [], template
        while rest:
            at = min(((rest.find("{%s}" % k), k) for k in parts if "{%s}" % k in rest), default=None)
            if at is None:
                return F.concat(*out, F.lit(rest))
            out += [F.lit(rest[: at[0]]), F.coalesce(parts[at[1]], F.lit(""))]
            rest = rest[at[0] + len(at[1]) + 2 :]
        return F.concat(*out)

    return F.when(choices.isNull(), fill(opened)).otherwise(fill(closed))


def _call(model, texts, attempts, pause):
    """Replies of one call and its failure, null where there is none."""
    for n in range(attempts):
        try:
            return model(texts), None
        except Transient as e:
            why = f"{type(e).__name__}: {e}"
            if n + 1 < attempts:
                time.sleep(pause * (n + 1) if e.after is None else e.after)
        except Exception as e:  # told in the row's error, so that one request does not end the others
            return [None] * len(texts), f"{type(e).__name__}: {e}"
    return [None] * len(texts), why


def ask(prompts: DataFrame, model: Callable[[list[str]], list], at_once: int = 16, attempts: int = ATTEMPTS, pause: float = PAUSE) -> DataFrame:
    """prompts(…, prompt) with reply, error, model, finish_reason and total_tokens.

    model takes a list of texts and gives one of replies: texts, nulls or dicts with text and the last three. Transient
    failures are tried again after a pause that grows; others, and the last, leave null replies and say why in error.
    Write the result before anything else reads it: Spark may run a task again, and a paid model would be asked again.
    """
    kinds = {"reply": pa.string(), "error": pa.string(), "model": pa.string(), "finish_reason": pa.string(), "total_tokens": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts, rows = b.column("prompt").to_pylist(), []
            for i in range(0, len(texts), at_once):
                part = texts[i : i + at_once]
                got, why = _call(model, part, attempts, pause)
                for g in got:
                    d = g if isinstance(g, dict) else {"text": g}
                    rows.append((d.get("text"), why or (FAILED if d.get("text") is None else None), d.get("model"), d.get("finish_reason"), d.get("total_tokens")))
            for (name, kind), col in zip(kinds.items(), zip(*rows) if rows else [()] * len(kinds)):
                b = b.append_column(name, pa.array(col, kind))
            yield b

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema)
    return prompts.mapInArrow(run, f"{schema}, reply string, error string, model string, finish_reason string, total_tokens long")


def extractive(texts: list[str]) -> list[str]:
    """The offline model: the first sentence of the first chunk that a prompt holds."""
    return [t.partition("CHUNK 1: ")[2].split(". ")[0].split("\n\n\n")[0].strip() or None for t in texts]


def replay(replies: dict[str, str]) -> Callable[[list[str]], list]:
    """A model that gives the reply recorded for a prompt, else none."""
    return lambda texts: [replies.get(t) for t in texts]


def unanswered(papers: DataFrame, chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """A row per question for papers without chunks; the question list is small by nature and within Spark's own threshold."""
    return papers.join(chunks.select("paper_id").distinct(), "paper_id", "left_anti").select("paper_id").crossJoin(questions)
