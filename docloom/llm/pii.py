"""Personal data by candidate gradient boosting, in built-in functions only.

Base spans (email, ip, card, phone) always stand. High-recall generators propose further spans of other formats (local
phone numbers, identity numbers, spoken e-mail addresses); boosted trees over features of format and context score them,
the scores are calibrated on held-out examples, and the threshold is the lowest that keeps PRECISION there. What remains
is added unless it overlaps a base span, or overlaps a better-scored or earlier candidate. The trees are fitted by the driver
on EXAMPLES generated spans and become one column expression: no row leaves the JVM, nothing is shuffled.

Null and empty texts have no spans; repeated rows give equal rows; ids, nulls among them, are passed through; other
columns are not read; an empty table gives no rows.
"""
import math
import random
import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.folds import SPAN, clusters, joined, matches, span

EXAMPLES, ROUNDS, RATE, PRECISION, AROUND = 4000, 24, 0.4, 0.98, 24
# The base patterns, kinds in the order that ranks them. Each begins where a leftmost match can begin:
# at the start of a run, or where the match before ended.
BASE = [
    ("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", ".", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", "", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13}(?:[\x20-]?[0-9])*+"),
    ("phone", "+", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"
WIDE = [
    ("local_phone", r"(?<![0-9+(.-])\(?[0-9]{2,4}(?:\)[\x20.-]?|[\x20.-])[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}(?![0-9]|[.-][0-9])"),
    ("identity", r"(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("spoken_email", r"(?i:\b[a-z0-9._-]{1,40} ?[\[(]at[\])] ?[a-z0-9-]{1,40} ?[\[(]dot[\])] ?[a-z]{2,12}\b)"),
]
# Words that speak for or against personal data nearby.
FOR, AGAINST = r"(?i)phone|\btel|call|mobile|\bfax\b|contact|\bssn\b|social|identity|mail|reach", r"(?i)order|invoice|version|part|serial|total|price|isbn|page|\bid\b"


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    d = F.reverse(digits(s))

    def add(acc, i):
        x = d.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + x - F.when(x > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    n = F.length(digits(hit))
    return {"email": F.lit(True), "ip": hit.rlike(OCTETS), "card": F.when(n.between(14, 19), luhn(hit)).otherwise(False), "phone": n.between(10, 15)}[kind]


def base_spans(text: Column, rank: int, kind: str, needs: str, pattern: str) -> Column:
    out = F.transform(F.filter(matches(text, pattern), lambda m: valid(kind, m["hit"])), lambda m: span(m, rank, kind))
    return F.when(text.contains(needs), out).otherwise(F.array().cast(SPAN)) if needs else out


NAMES = ["kind", "length", "digits", "parts", "bracket", "for", "against", "year"]


def features(rank: int, hit: str, around: str) -> list[float]:
    """The trainer's side of feature_columns: equal by construction, and held equal by a test."""
    n = len(re.sub("[^0-9]", "", hit))
    return [rank, len(hit), n, len(re.findall(r"[\x20.-]", hit)), float("(" in hit), float(bool(re.search(FOR, around))), float(bool(re.search(AGAINST, around))), float(bool(re.search(r"^(?:19|20)[0-9]{2}[^0-9]", hit)))]


def feature_columns(rank: int, hit: Column, around: Column) -> list[Column]:
    flag = lambda c: c.cast("int").cast("double")
    return [F.lit(float(rank)), F.length(hit), F.length(digits(hit)), F.regexp_count(hit, F.lit(r"[\x20.-]")), flag(hit.contains("(")), flag(around.rlike(FOR)), flag(around.rlike(AGAINST)), flag(hit.rlike(r"^(?:19|20)[0-9]{2}[^0-9]"))]


def examples(n: int, seed: int):
    """Generated spans with their surroundings and labels: personal numbers and addresses, and look-alikes such as order numbers and dates."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    good, bad, idle = ["phone ", "call me at ", "tel. ", "mobile: ", "contact ", "SSN ", "mail me: ", "reach us "], ["order ", "invoice no. ", "part ", "serial ", "total ", "version ", "page "], ["the ", "of ", "and ", "with "]
    for _ in range(n):
        yes = r.random() < 0.5
        lead = r.choice(good if r.random() < 0.8 else idle) if yes else r.choice(bad if r.random() < 0.6 else idle)
        rank = r.randrange(3)
        if rank == 0:
            sep = r.choice(" .-")
            year = f"{r.choice((19, 20))}{d(2)}"
            pairs = lambda k: sep.join(d(2) for _ in range(k))
            if yes:
                hit = r.choice([f"({d(3)}) {d(3)}-{d(4)}", f"({d(3)}){d(3)}-{d(4)}", f"{d(3)}{sep}{d(3)}{sep}{d(4)}", pairs(5)])
            else:
                hit = r.choice([f"{year} {d(3)} {d(3)}", f"{d(2)} {d(3)}{d(3)}", f"{d(4)}.{d(4)}{d(4)}", f"{year}{sep}{d(2)}{sep}{d(2)}", f"{d(2)}{sep}{d(2)}{sep}{year}", pairs(r.randrange(3, 6))])
        elif rank == 1:
            hit = f"{d(3)}-{d(2)}-{d(4)}"
        else:
            hit, yes = r.choice(["joe", "ann.b", "x_9"]) + r.choice([" [at] ", "(at)"]) + "mail" + r.choice([" [dot] ", "(dot)"]) + r.choice(["com", "org"]), True
        yield features(rank, hit, r.choice(["", "so ", "then "]) + lead), int(yes)


@lru_cache(1)
def model():
    """Boosted trees of depth 2 on the logistic loss: (trees, slope, offset, threshold); a tree is (f, cut, left, right), left and right being (f, cut, low, high)."""
    every = list(examples(EXAMPLES, 11))
    train, held = every[: EXAMPLES * 3 // 4], every[EXAMPLES * 3 // 4 :]
    score, trees = [0.0] * len(train), []

    def leaf(rows, g, h):
        return RATE * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + 1.0)

    def split(rows, g, h):
        best = None
        for f in range(len(NAMES)):
            sums = {}
            for i in rows:
                a, b = sums.get(train[i][0][f], (0.0, 0.0))
                sums[train[i][0][f]] = (a + g[i], b + h[i])
            tg, th = sum(x[0] for x in sums.values()), sum(x[1] for x in sums.values())
            lg = lh = 0.0
            for v in sorted(sums)[:-1]:
                lg, lh = lg + sums[v][0], lh + sums[v][1]
                gain = lg * lg / (lh + 1) + (tg - lg) ** 2 / (th - lh + 1)
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, f, v)
        f, v = best[1:] if best else (0, math.inf)
        return f, v, [i for i in rows if train[i][0][f] <= v], [i for i in rows if train[i][0][f] > v]

    for _ in range(ROUNDS):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g, h = [y - q for (_, y), q in zip(train, p)], [q * (1 - q) for q in p]
        f, v, low, high = split(range(len(train)), g, h)
        sides = []
        for part in (low, high):
            f2, v2, a, b = split(part, g, h)
            sides.append((f2, v2, leaf(a, g, h), leaf(b, g, h)))
        trees.append((f, v, *sides))
        score = [s + value(trees[-1], x) for s, (x, _) in zip(score, train)]
    # Calibration (Platt): slope and offset by gradient steps on the held-out half; the threshold on the same scores.
    raw = [(sum(value(t, x) for t in trees), y) for x, y in held]
    a, b = 1.0, 0.0
    for _ in range(400):
        e = [(1 / (1 + math.exp(-(a * s + b))) - y, s) for s, y in raw]
        a, b = a - 0.05 * sum(d * s for d, s in e) / len(e), b - 0.05 * sum(d for d, _ in e) / len(e)
    cal = sorted(((1 / (1 + math.exp(-(a * s + b))), y) for s, y in raw), reverse=True)
    cut, right = 1.0, 0
    for k, (p, y) in enumerate(cal, 1):
        right += y
        if right >= PRECISION * k and (k == len(cal) or cal[k][0] < p):
            cut = p
    return trees, a, b, max(cut, 0.5)


def value(tree, x):
    f, v, *sides = tree
    f2, v2, low, high = sides[x[f] > v]
    return high if x[f2] > v2 else low


def wide_spans(text: Column, rank: int, kind: str, pattern: str) -> Column:
    """Candidates whose calibrated score reaches the threshold; loss is 1 - score, so that the best sort first."""
    trees, a, b, cut = model()

    def scored(m):
        x = feature_columns(rank, m["hit"], m["lead"])
        return F.struct(*[c.cast("double").alias(n) for c, n in zip(x, NAMES)], m["start"].alias("start"), m["end"].alias("end"))

    def score(x):
        side = lambda t: F.when(x[NAMES[t[0]]] > t[1], t[3]).otherwise(t[2])
        s = F.lit(0.0)
        for f, v, low, high in trees:
            s = s + F.when(x[NAMES[f]] > v, side(high)).otherwise(side(low))
        return F.struct((1 - 1 / (1 + F.exp(-(a * s + b)))).alias("loss"), x["start"].alias("start"), F.lit(len(BASE) + rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end"))

    return F.filter(F.transform(F.transform(matches(text, pattern, 0, AROUND), scored), score), lambda x: 1 - x["loss"] >= cut)


def chosen(own: Column, wide: Column) -> Column:
    """Of candidates, those that overlap no base span and, best score first, no candidate taken before; decided within each cluster of overlapping spans."""
    apart = lambda x: lambda y: (y["end"] <= x["start"]) | (x["end"] <= y["start"])
    bare = lambda x: F.struct(*[x[c].alias(c) for c in ("start", "rank", "kind", "end")])
    both = lambda x, loss: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end"), loss.alias("loss"))
    every = F.array_sort(F.concat(F.transform(own, lambda x: both(x, F.lit(-1.0))), F.transform(wide, lambda x: both(x, x["loss"]))))

    def best(c: Column) -> Column:
        base = F.filter(c, lambda x: x["loss"] < 0)
        free = F.filter(c, lambda x: (x["loss"] >= 0) & F.forall(base, apart(x)))
        order = F.array_sort(F.transform(free, lambda x: F.struct(x["loss"].alias("loss"), bare(x).alias("x"))))
        return F.aggregate(order, F.array().cast(SPAN), lambda acc, y: F.when(F.forall(acc, apart(y["x"])), F.concat(acc, F.array(y["x"]))).otherwise(acc))

    return F.when(F.size(wide) > 0, F.flatten(F.transform(clusters(every), best))).otherwise(F.array().cast(SPAN))


def find_personal_data(docs: DataFrame) -> DataFrame:
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = [base_spans(F.col("text"), i, *k).alias(k[0]) for i, k in enumerate(BASE)]
    wide = [wide_spans(F.col("text"), i, *k) for i, k in enumerate(WIDE)]
    d = d.select("doc_id", *base, F.concat(*wide).alias("wide")).withColumn("own", F.concat(*[k[0] for k in BASE]))
    d = d.withColumn("added", chosen(F.col("own"), F.col("wide")))
    return d.select("doc_id", *[F.size(k[0]).cast("long").alias(f"n_{k[0]}") for k in BASE], F.sha2(joined(F.col("own")), 256).alias("base_sha256"), joined(F.concat("own", "added")).alias("spans"))
