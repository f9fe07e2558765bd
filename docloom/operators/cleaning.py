"""Text cleaning in built-in expressions. Lines are array elements, so nothing is shuffled but for boilerplate counts."""
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

# What a references heading is, which line beginnings are structure, how long a repeated line may be.
REFERENCES = r"(?i)^\s*(?:[IVXLC0-9]+\.?\s*)?(?:references|bibliography|works\s+cited|literature\s+cited)\s*:?\s*$"
STRUCTURE = r"^(?:[#|*>-]|[0-9]+[.)]\s)"
LONGEST, SHARE, AFTER = 200, 0.4, 0.3
FRAGMENT = rf"(?s)^(?!{STRUCTURE[1:]})(?:[^A-Za-z]+|(?=.{{1,39}}$)\S+(?:\s+\S+){{0,2}}(?<![.!?:;,]))$"


def line_key(line: Column) -> Column:
    """Letters only, lower-case; what differs in digits and punctuation has one key."""
    return F.regexp_replace(F.replace(F.lower(line), F.lit("ß"), F.lit("ss")), "[^a-z]+", "")


@F.pandas_udf(StringType())
def nfkc(s):
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def glyphs(text: Column) -> Column:
    """Without soft hyphens, compatibility forms and runs of blanks. Only texts beyond ASCII visit Python."""
    text = F.replace(text, F.lit("\u00ad"), F.lit(""))
    text = F.when(text.rlike(r"[^\x00-\x7F]"), nfkc(text)).otherwise(text)
    return F.regexp_replace(F.replace(text, F.lit("\u00a0"), F.lit(" ")), r"[ \t]{2,}", " ")


def join_hyphens(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=[a-z])-\n(?=[a-z])", "")


def close_gaps(text: Column) -> Column:
    return F.concat(F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"^\s+|\s+$", ""), F.lit("\n"))


def is_references(line: Column) -> Column:
    head = F.nullif(F.regexp_extract(line, r"^\s{0,3}#{1,6}\s+(.+?)\s*$", 1), F.lit(""))
    bold = F.nullif(F.regexp_extract(line, r"^\s*\*\*([^*]+)\*\*\s*$", 1), F.lit(""))
    return F.regexp_replace(F.coalesce(head, bold, line), r"^[*_ ]+|[*_ ]+$", "").rlike(REFERENCES)


def cut_references(text: Column) -> Column:
    """Text before its last references heading, if that begins beyond AFTER of the text, without blanks at its end but one line break; else the text."""
    lines, least = F.split(text, "\n", -1), F.floor(F.length(text) * AFTER)
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.lit(-1).alias("cut"))
    hit = lambda a, x: is_references(x) & (a["at"] >= least)
    step = lambda a, x: F.struct((a["i"] + 1).alias("i"), (a["at"] + F.length(x) + 1).alias("at"), F.when(hit(a, x), a["i"]).otherwise(a["cut"]).alias("cut"))
    # Only texts with such a word are folded.
    cut = F.when(text.rlike(r"(?i)references|bibliography|cited"), F.aggregate(lines, start, step, lambda a: a["cut"]))
    kept = F.regexp_replace(F.array_join(F.slice(lines, F.lit(1), F.greatest(cut, F.lit(0))), "\n"), r"(?U)\s+$", "")
    return F.when(cut >= 0, F.concat(kept, F.lit("\n"))).otherwise(text)


def is_fragment(line: Column) -> Column:
    """Lines without letters, and up to 3 short words without an end; blank lines and structure are none. One pattern, one look at each line."""
    return F.regexp_replace(line, r"^\s+|\s+$", "").rlike(FRAGMENT)


def sifted(text: Column) -> Column:
    """struct(text, dropped): without fragment lines, and how many those are; each line is judged once."""
    judged = F.transform(F.split(text, "\n", -1), lambda x: F.struct(x.alias("line"), is_fragment(x).alias("drop")))
    parts = F.transform(F.array(judged), lambda j: F.struct(F.array_join(F.filter(j, lambda x: ~x["drop"])["line"], "\n").alias("text"), F.size(F.filter(j, lambda x: x["drop"])).cast("long").alias("dropped")))
    return parts[0]


def drop_fragments(text: Column) -> Column:
    return sifted(text)["text"]


def boilerplate(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """pages(paper_id, page_no, text): keys of lines on at least max(2, share) of a paper's pages, with the first such line; papers under 3 pages have none."""
    lines = pages.select("paper_id", "page_no", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).withColumn("line", F.trim("line"))
    keys = lines.where(F.length("line").between(1, LONGEST)).withColumn("key", line_key(F.col("line"))).where("key <> ''")
    n = pages.groupBy("paper_id").agg(F.count_distinct("page_no").alias("n"))
    found = keys.groupBy("paper_id", "key").agg(F.count_distinct("page_no").alias("pages"), F.min_by("line", F.struct("page_no", "pos")).alias("example"))
    return found.join(n, "paper_id").where(F.expr(f"n >= 3 and pages >= greatest(2, cast({share} * n as int))")).select("paper_id", "key", "pages", "example")


def drop_boilerplate(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """pages without the lines that boilerplate() names. A paper's keys are few: they are joined as one array, and texts are not exploded."""
    keys = boilerplate(pages, share).groupBy("paper_id").agg(F.collect_list("key").alias("keys"))
    keep = lambda x: (F.length(F.trim(x)) > LONGEST) | ~F.array_contains("keys", line_key(F.trim(x)))
    text = F.when(F.col("keys").isNull(), F.col("text")).otherwise(F.array_join(F.filter(F.split("text", "\n", -1), keep), "\n"))
    return pages.join(keys, "paper_id", "left").withColumn("text", text).drop("keys")


def clean(text: Column, references: bool = True) -> Column:
    text = join_hyphens(glyphs(text))
    return close_gaps(drop_fragments(cut_references(text) if references else text))


def clean_papers(pages: DataFrame, share: float = SHARE, references: bool = True) -> DataFrame:
    """pages(paper_id, page_no, text): paper_id, text, n_pages and a report (boilerplate_lines_removed, references_truncated, tiny_fragments_dropped, chars_before_cleaning, chars_after_cleaning).

    Repeated lines go page by page, pages are joined by a blank line, the other steps see the whole text.
    """
    joined = lambda d: d.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_pages"), F.array_join(F.array_sort(F.collect_list(F.struct("page_no", "text")))["text"], "\n\n").alias("text"))
    lines = boilerplate(pages, share).groupBy("paper_id").agg(F.array_sort(F.collect_list("example")).alias("lines"))
    before = pages.groupBy("paper_id").agg((F.sum(F.length("text")) + 2 * (F.count("text") - 1)).alias("before"))
    d = joined(drop_boilerplate(pages, share)).join(before, "paper_id").join(lines, "paper_id", "left")
    d = d.withColumn("whole", join_hyphens(glyphs(F.col("text")))).withColumn("cut", cut_references(F.col("whole")) if references else F.col("whole"))
    d = d.withColumn("sifted", sifted(F.col("cut"))).withColumn("text", close_gaps(F.col("sifted")["text"]))
    told = {"boilerplate_lines_removed": F.coalesce("lines", F.array().cast("array<string>")), "references_truncated": F.col("cut") != F.col("whole"), "tiny_fragments_dropped": F.col("sifted")["dropped"], "chars_before_cleaning": F.col("before"), "chars_after_cleaning": F.length("text").cast("long")}
    return d.select("paper_id", "text", "n_pages", F.struct(*[c.alias(n) for n, c in told.items()]).alias("report"))


def ocr(text: Column, n_pages: Column, least: float = 200) -> Column:
    """struct(chars_per_page, needs_ocr): scanned papers have little text a page."""
    rate = F.length(text) / F.greatest(n_pages, F.lit(1))
    return F.struct(F.round(rate, 1).alias("chars_per_page"), (rate < least).alias("needs_ocr"))
