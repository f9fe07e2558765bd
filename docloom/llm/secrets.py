"""Secret scans with multipart linking, in built-in functions only.

Base spans (assign, access, hex) always stand. Weak candidates (bare 40-character keys, endpoints) are reported only if a
complementary part lies within SCOPE characters: a key near an access identifier, an endpoint near an access identifier
or an assignment. The scope is a stretch of one document, so the interval join runs within its row: parts and candidates
are sorted once, and running maxima give each candidate the part before it that reaches farthest and the next one after
it. Texts are scanned once, nothing is shuffled, and time grows with the number of matches of a text, not its square.

Null or empty text has no spans; very long texts are scanned whole; of equal spans each kind's stands; repeated rows give
equal rows; ids, nulls among them, are passed through; scan_secrets reads no other column, whatever its name, and
redact_secrets keeps them all; an empty table gives no rows.
"""
from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.folds import NONE, SPAN, joined, let, matches, pieces, running, span, stretch

# The base patterns; kinds in the order that ranks them.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [("assign", ASSIGN, 6, 1), ("access", "AKIA[A-Z0-9]+", 20, 0), ("hex", "(?<![0-9a-f])[0-9a-f]{24,}+", 24, 0)]
WEAK = [("key", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])", 1, 0), ("endpoint", r"https?://[A-Za-z0-9.-]+", 1, 0)]
PARTS = {"key": ["access"], "endpoint": ["assign", "access"]}
SCOPE, SHIFT = 400, 1 << 31
LINKS = "array<struct<weak:struct<start:int,rank:int,kind:string,end:int>,part:struct<start:int,rank:int,kind:string,end:int>>>"


def spans(text: Column, rank: int, kind: str, pattern: str, least: int, group: int) -> Column:
    return F.transform(F.filter(matches(text, pattern, group), lambda m: F.length(m["part"]) >= least), lambda m: span(m, rank, kind))


def links(weak: Column, parts: Column) -> Column:
    """(weak, part) for each weak candidate with a complementary part in scope: the one before that reaches farthest, else the next."""

    def of(kind: str):
        fits = lambda x: x["kind"].isin(*PARTS[kind])
        far = lambda x, i, v: F.when(fits(x), v.cast("long") * SHIFT + i).otherwise(F.lit(NONE))

        def join(e: Column) -> Column:
            n = F.size(e)
            before = running(F.transform(e, lambda x, i: far(x, i, x["end"])), F.greatest, NONE)
            after = running(F.transform(F.reverse(e), lambda x, i: far(x, i, -x["start"])), F.greatest, NONE)

            def pick(x, i, r):
                b, a = r["before"][i], r["after"][n - 1 - i]
                prev, then = e[(b % SHIFT).cast("int")], e[(n - 1 - F.pmod(a, F.lit(SHIFT))).cast("int")]
                part = F.when((b >= 0) & (prev["end"] + SCOPE >= x["start"]), prev).when((a > NONE) & (then["start"] <= x["end"] + SCOPE), then)
                return F.when(x["kind"] == kind, F.struct(x.alias("weak"), part.alias("part")))

            paired = let(F.struct(before.alias("before"), after.alias("after")), lambda r: F.transform(e, lambda x, i: pick(x, i, r)))
            return F.filter(paired, lambda y: y["part"].isNotNull())

        return let(F.array_sort(F.concat(F.filter(weak, lambda x: x["kind"] == kind), F.filter(parts, fits))), join)

    return F.when((F.size(weak) > 0) & (F.size(parts) > 0), F.concat(*map(of, PARTS))).otherwise(F.array().cast(LINKS))


def _found(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), doc_id, text, the base kinds' spans, own (all of those), links and every (own with the linked ones)."""
    d = docs.select(F.struct("*").alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = [spans(F.col("text"), i, *k).alias(k[0]) for i, k in enumerate(BASE)]
    weak = [spans(F.col("text"), len(BASE) + i, *k) for i, k in enumerate(WEAK)]
    d = d.select("row", "doc_id", "text", *base, F.concat(*weak).alias("weak"))
    d = d.withColumn("links", links(F.col("weak"), F.concat("assign", "access"))).withColumn("own", F.concat("assign", "access", "hex"))
    return d.withColumn("every", F.concat("own", F.col("links.weak").cast(SPAN)))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of base spans, all spans, and links as candidate>part."""
    r = _found(docs.select("doc_id", "text"))
    place = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    told = F.array_join(F.transform("links", lambda x: F.concat_ws(">", place(x["weak"]), place(x["part"]))), ",")
    return r.select("doc_id", *[F.size(k[0]).cast("long").alias(f"n_{k[0]}") for k in BASE], F.sha2(joined(F.col("own")), 256).alias("base_sha256"), joined(F.col("every")).alias("spans"), told.alias("links"))


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span in text replaced by mark, overlapping spans by one; texts without spans and nulls stay as they are.

    A column n_chars, where there is one, is counted anew for texts that change.
    """
    r = _found(docs)

    def masked(s: Column) -> Column:
        reach = running(F.transform(s, lambda x: x["end"].cast("long")), F.greatest, 0)
        gap = lambda p, r: lambda x, i: F.when(x["start"] >= r[i], F.concat(stretch(p, r[i], x["start"].cast("long")), F.lit(mark))).otherwise("")
        rest = lambda p: stretch(p, F.array_max(s["end"]).cast("long"), F.length("text").cast("long"))
        return let(pieces(F.col("text")), lambda p: F.concat(let(reach, lambda r: F.array_join(F.transform(s, gap(p, r)), "")), rest(p)))

    r = r.withColumn("clean", F.when(F.size("every") > 0, let(F.array_sort("every"), masked)))
    new = {"text": F.coalesce("clean", F.col("row")["text"]), "n_chars": F.coalesce(F.length("clean").cast("long"), F.col("row")["n_chars"]) if "n_chars" in docs.columns else None}
    return r.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])
