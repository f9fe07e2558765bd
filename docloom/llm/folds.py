"""Column expressions over the spans of one text, in time linear in their number but for a factor of BLOCK.

An aggregate that appends to its accumulator copies it at each step. Here arrays are folded in blocks, and blocks are
joined by their totals, so a text with many matches does not cost the square of them.
"""
from collections.abc import Callable

from pyspark.sql import Column, functions as F

BLOCK, PIECE = 128, 1024
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"
NONE = -(1 << 60)


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, with x computed once even where f uses it in lambdas."""
    return F.transform(F.array(x), f)[0]


def indexes(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def running(values: Column, op: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each of an array of longs: op over all before it, beginning with zero."""

    def within(block: Column, start: Column) -> Column:
        first = F.struct(start.cast("long").alias("at"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(block, first, lambda s, x: F.struct(op(s["at"], x).cast("long").alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def split(v: Column) -> Column:
        last = lambda b: F.least((b + 1) * BLOCK, F.size(v)) - 1
        return F.transform(indexes(F.ceil(F.size(v) / BLOCK)), lambda b: F.transform(F.sequence(b * BLOCK, last(b)), lambda i: v[i]))

    def whole(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(zero).cast("long"), lambda s, x: op(s, x).cast("long")))
        return let(within(totals, F.lit(zero)), lambda heads: F.flatten(F.transform(blocks, lambda b, i: within(b, heads[i]))))

    return let(let(values, split), whole)


def matches(text: Column, pattern: str, group: int = 0, around: int = 1) -> Column:
    """Leftmost non-overlapping matches as (start, end, hit, part, lead), in code points; part is a group, lead up to around characters between the match before and this one. What lies between matches gives the places."""
    none = F.array().cast("array<struct<start:int,end:int,hit:string,part:string,lead:string>>")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(around)).alias("lead")))

    def placed(x: Column) -> Column:
        each = F.transform(x["hits"], lambda h, i: (x["gaps"][i]["n"] + F.length(h)).cast("long"))
        at = lambda p: lambda h, i: F.struct((p[i] + x["gaps"][i]["n"]).cast("int").alias("start"), (p[i] + x["gaps"][i]["n"] + F.length(h)).cast("int").alias("end"), h.alias("hit"), x["parts"][i].alias("part"), x["gaps"][i]["lead"].alias("lead"))
        return let(running(each, lambda a, b: a + b, 0), lambda p: F.transform(x["hits"], at(p)))

    return let(hits, lambda h: F.when(F.size(h) > 0, let(F.struct(h.alias("hits"), parts.alias("parts"), gaps.alias("gaps")), placed)).otherwise(none))


def pieces(text: Column) -> Column:
    """text in pieces of PIECE characters, for stretch()."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def stretch(parts: Column, start: Column, end: Column) -> Column:
    """The characters from start to end, end exclusive, of a text cut by pieces(); substr of the text itself would walk from its beginning each time."""
    inside = lambda q: parts[q.cast("int")].substr(F.greatest(start - q * PIECE, F.lit(0)).cast("int") + 1, (F.least(end - q * PIECE, F.lit(PIECE)) - F.greatest(start - q * PIECE, F.lit(0))).cast("int"))
    return F.when(end > start, F.array_join(F.transform(F.sequence(F.floor(start / PIECE), F.floor((end - 1) / PIECE)), inside), "")).otherwise("")


def span(m: Column, rank: int, kind: str) -> Column:
    return F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end"))


def clusters(spans: Column) -> Column:
    """Spans sorted by start, as an array of arrays: spans that overlap, or hang together by others that do, share one."""

    def cut(s: Column) -> Column:
        reach = running(F.transform(s, lambda x: x["end"].cast("long")), F.greatest, NONE)
        heads = lambda r: F.filter(indexes(F.size(s)), lambda i: s[i]["start"].cast("long") >= r[i])
        upto = lambda h, j: F.coalesce(F.try_element_at(h, j + 2), F.size(s)) - 1
        return let(let(reach, heads), lambda h: F.transform(h, lambda a, j: F.transform(F.sequence(a, upto(h, j)), lambda i: s[i])))

    return let(spans, cut)


def joined(items: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(items), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
