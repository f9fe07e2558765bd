"""Sections, blocks, sentences and token-bounded chunks of Markdown or plain texts.

Lines, blocks and sentences are rows; what hangs together is found by lag and a running sum. Chunks are ranges of a
section's sentences: one Arrow pass cuts them from sizes, and the same ranges cut long sentences and tables.
"""
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

# Abbreviations after which no sentence ends; the least budget of a chunk.
ABBREVIATIONS = "al fig figs eq eqs ref refs sec no vol pp etc vs cf ca resp approx dr prof st jr inc ltd".split()
LEAST = 32
TABLE, LEVELS = r"(?U)^\s*\|.*\|\s*$", range(1, 7)
BREAKS = r"\r\n|[\r\x0B\f\x1C-\x1E\x85  ]"
OPEN_END = rf"(?:^|[^A-Za-z])(?i:{'|'.join(ABBREVIATIONS)}|[a-z])\.$"


def plain_breaks(text: Column) -> Column:
    """Every kind of line break as \\n."""
    return F.regexp_replace(text, BREAKS, "\n")


def strip(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def islands(new: Column, w) -> Column:
    """A number for each run of rows: new says where one begins."""
    return F.sum(new.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def section_lines(docs: DataFrame, markdown: str | None = None) -> DataFrame:
    """docs(paper_id, text): a row per line with its section path and number. A level's title counts while no higher level came later.

    markdown names a boolean column; texts where it is false have no headings.
    """
    md = F.col(markdown) if markdown else F.lit(True)
    d = docs.select("paper_id", md.alias("markdown"), F.posexplode(F.split(plain_breaks(F.col("text")), "\n", -1)).alias("pos", "line"))
    d = d.withColumn("level", F.when(F.col("markdown"), F.length(F.regexp_extract("line", r"^\s{0,3}(#{1,6})\s+\S", 1))).otherwise(0))
    d = d.withColumn("title", F.regexp_replace(F.regexp_replace("line", r"(?U)^\s*#+\s+|\s+$", ""), r"^[*_]+|[*_]+$", ""))
    w = Window.partitionBy("paper_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mine = lambda k, c: F.when(F.col("level") == k, F.col(c))
    d = d.withColumns({f"p{k}": F.coalesce(F.max(mine(k, "pos")).over(w), F.lit(-1)) for k in LEVELS} | {f"t{k}": F.last(mine(k, "title"), True).over(w) for k in LEVELS} | {"section_id": F.count_if(F.col("level") > 0).over(w)})
    live = lambda k: F.when(F.col(f"p{k}") > F.greatest(F.lit(-1), *[F.col(f"p{j}") for j in range(1, k)], F.lit(-1)), F.col(f"t{k}"))
    return d.select("paper_id", "pos", "line", "level", "markdown", "section_id", F.concat_ws(" > ", *map(live, LEVELS)).alias("section"))


def blocks(docs: DataFrame, markdown: str | None = None) -> DataFrame:
    """Maximal runs of table lines or of prose lines within a section; a prose block is a paragraph."""
    s = section_lines(docs, markdown)
    w = Window.partitionBy("paper_id").orderBy("pos")
    s = s.withColumn("kind", F.when(F.col("level") > 0, "heading").when(strip(F.col("line")) == "", "blank").when(F.col("markdown") & F.col("line").rlike(TABLE), "table").otherwise("prose"))
    s = s.withColumn("new", ~F.lag("kind").over(w).eqNullSafe(F.col("kind"))).withColumn("block", islands(F.col("new"), w))
    g = s.where("kind in ('table', 'prose')").groupBy("paper_id", "section_id", "section", "block", "kind").agg(F.array_sort(F.collect_list(F.struct("pos", strip(F.col("line")).alias("line")))).alias("lines"))
    text = lambda sep: F.array_join(F.col("lines.line"), sep)
    return g.select("paper_id", "section_id", "section", F.col("lines")[0]["pos"].alias("pos"), (F.col("kind") == "table").alias("is_table"), F.when(F.col("kind") == "table", text("\n")).otherwise(text(" ")).alias("text"))


def paragraph_rows(docs: DataFrame, keys: list[str]) -> DataFrame:
    """docs(keys, text): a row (keys, par, text) per paragraph that is not blank, its blanks made one space."""
    d = docs.select(*keys, F.posexplode(F.split(plain_breaks(F.col("text")), r"(?U)\n\s*\n", -1)).alias("par", "text"))
    return d.withColumn("text", F.regexp_replace(strip(F.col("text")), r"(?U)\s+", " ")).where("text <> ''")


def sentence_rows(paragraphs: DataFrame, keys: list[str]) -> DataFrame:
    """paragraphs(keys, text): a row (keys, sent, sentence) per sentence.

    Parts end after . ! ? and a blank; a part stays with the one before if that ends in an abbreviation or a single letter, or if it begins in lower case.
    """
    p = paragraphs.select(*keys, F.posexplode(F.split(F.regexp_replace(strip(F.col("text")), r"(?U)\s+", " "), r"(?<=[.!?])\s+", -1)).alias("i", "part")).where("part <> ''")
    w = Window.partitionBy(*keys).orderBy("i")
    before = F.lag("part").over(w)
    p = p.withColumn("new", before.isNull() | ~(before.rlike(OPEN_END) | F.col("part").rlike(r"^\p{Ll}"))).withColumn("sent", islands(F.col("new"), w))
    g = p.groupBy(*keys, "sent").agg(F.array_sort(F.collect_list(F.struct("i", "part"))).alias("parts"))
    return g.select(*keys, (F.col("sent") - 1).alias("sent"), F.array_join("parts.part", " ").alias("sentence"))


def words(text: str) -> int:
    return len(text.split())


def ranges(n: int, size: Callable[[int, int], int], budget: int, overlap: int = 0) -> Iterator[tuple[int, int]]:
    """Ranges (a, b) that cover 0 to n in order, each as long as size(a, b), which must not fall as it grows, stays within budget, and of one item at least.

    A range begins with as many of the items before it as fit in overlap, unless the next item would not fit then.
    """
    a = 0
    while a < n:
        b = a + 1 + bisect_right(range(a + 2, n + 1), budget, key=lambda e: size(a, e))
        yield a, b
        if b == n:
            return
        back = bisect_left(range(a, b), -overlap, key=lambda s: -size(s, b)) + a if overlap else b
        a = back if back < b and size(back, b + 1) <= budget else b


def measure(items: list[str], count: Callable[[str], int], between: str = " ", head: str = "") -> Callable[[int, int], int]:
    """Size of a range of items joined: by running sums for words, which add up, else by counting what is joined."""
    if count is words:
        total, own = [0, *accumulate(map(words, items))], words(head)
        return lambda a, b: own + total[b] - total[a]
    return lambda a, b: count(head + between.join(items[a:b]))


def fitting(sentence: str, budget: int, count: Callable[[str], int]) -> Iterator[str]:
    """A sentence in pieces of whole words; of a word too long alone, the longest of its whole, half, quarter, ... that fits, and so on with the rest."""
    if count(sentence) <= budget:
        yield sentence
        return
    w = sentence.split(" ")
    for a, b in ranges(len(w), measure(w, count), budget):
        piece = " ".join(w[a:b])
        while count(piece) > budget and len(piece) > 1:
            n = next(m for m in (len(piece) >> k for k in range(1, 64)) if m <= 1 or count(piece[:m]) <= budget)
            yield piece[: max(1, n)]
            piece = piece[max(1, n) :]
        if piece:
            yield piece


def pack(sentences: list[str], budget: int = 300, overlap: int = 50, count: Callable[[str], int] = words, most: int | None = None) -> list[str]:
    """Chunks of whole sentences; most is the embedder's own limit, less its special tokens."""
    wanted = max(LEAST, budget)
    overlap, budget = min(max(0, overlap), wanted // 2), wanted if most is None else max(1, min(wanted, most))
    units = [u for s in sentences for u in fitting(s, budget, count)]
    return [" ".join(units[a:b]) for a, b in ranges(len(units), measure(units, count), budget, overlap)]


def split_table(text: str, budget: int, count: Callable[[str], int] = words) -> list[str]:
    """Pieces of whole rows, each under the two header lines; a row over the budget stays whole."""
    lines = text.split("\n")
    if len(lines) <= 2:
        return [text]
    head, rows = "\n".join(lines[:2]) + "\n", lines[2:]
    return [head + "\n".join(rows[a:b]) for a, b in ranges(len(rows), measure(rows, count, "\n", head), budget)]


def chunks(docs: DataFrame, budget: int = 300, overlap: int = 50, count: Callable[[str], int] = words, max_tokens: int | None = None, special: int = 2, markdown: str | None = None) -> DataFrame:
    """docs(paper_id, text): paper_id, chunk_id, section, is_table, n_tokens, n_chars, over_budget, text and embed_text; within a section prose comes before tables.

    The last two levels of the path stand before the text to embed and are paid from the budget, and from max_tokens, of
    which special tokens go too for prose. A table row over the budget stays whole and is marked.
    """
    NAMES = ["paper_id", "section_id", "section", "is_table", "pos", "i", "n_tokens", "over_budget", "text", "embed_text"]

    def run(batches):
        for b in batches:
            rows = []
            for paper, sid, section, pos, table, texts in zip(*(c.to_pylist() for c in b.columns)):
                lead = f"[{' > '.join(section.split(' > ')[-2:])}] " if section else ""
                paid = count(lead) if lead else 0
                left, most = max(LEAST, budget - paid), None if max_tokens is None else max(1, max_tokens - paid)
                cap = left if most is None else min(left, most)
                for i, t in enumerate(split_table(texts[0], cap, count) if table else pack(texts, left, overlap, count, most and max(1, most - special))):
                    rows.append((paper, sid, section, table, pos, i, count(lead + t), count(t) > cap, t, lead + t))
            kinds = [b.schema.field(0).type, b.schema.field(1).type, pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(NAMES), kinds)], NAMES)

    b, keys = blocks(docs, markdown), ["paper_id", "section_id", "section", "pos"]
    s = sentence_rows(b.where("not is_table"), keys)
    prose = s.groupBy("paper_id", "section_id", "section").agg(F.array_sort(F.collect_list(F.struct("pos", "sent", "sentence"))).alias("x"))
    prose = prose.select("paper_id", "section_id", "section", F.col("x")[0]["pos"].alias("pos"), F.lit(False).alias("is_table"), F.col("x.sentence").alias("texts"))
    tables = b.where("is_table").select(*keys, "is_table", F.array("text").alias("texts"))
    kind = docs.schema["paper_id"].dataType.simpleString()
    rows = prose.unionByName(tables).mapInArrow(run, f"paper_id {kind}, section_id long, section string, is_table boolean, pos int, i int, n_tokens int, over_budget boolean, text string, embed_text string")
    w = Window.partitionBy("paper_id").orderBy("section_id", "is_table", "pos", "i")
    return rows.withColumn("chunk_id", F.row_number().over(w) - 1).select("paper_id", "chunk_id", "section", "is_table", "n_tokens", F.length("text").alias("n_chars"), "over_budget", "text", "embed_text")
