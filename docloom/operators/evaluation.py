"""Agreement of raters and precision of answers."""
from pyspark.sql import Column, DataFrame, functions as F


def clean_key(name: Column) -> Column:
    return F.lower(F.translate(name, "_ -,", ""))


def cell_items(cell: Column, blanks: bool = False) -> Column:
    items = F.split(F.lower(F.replace(F.coalesce(cell, F.lit("")), F.lit(" "), F.lit(""))), ";")
    return items if blanks else F.filter(items, lambda x: x != "")


def sheet(df: DataFrame, key: str) -> DataFrame:
    """A wide sheet as rows (key, question, cell)."""
    rest = [c for c in df.columns if c != key]
    return df.select(key, *[F.col(f"`{c}`").cast("string").alias(c) for c in rest]).unpivot(key, [F.col(f"`{c}`") for c in rest], "question", "cell").withColumn("cell", F.coalesce("cell", F.lit("")))


def by_choice(answers: DataFrame, raters: list[str], choices: str = "choices") -> DataFrame:
    """A row per choice: whether each rater's array column has it."""
    d = answers.withColumn("choice", F.explode(choices))
    return d.withColumns({r: F.array_contains(r, F.col("choice")) for r in raters})


def kappas(rated: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Cohen's kappa and raw agreement of each pair of boolean columns, from one pass."""
    means = [F.count(F.lit(1)).alias("n")]
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        means += [F.avg((x == y).cast("double")).alias(f"po{i}"), F.avg(x).alias(f"a{i}"), F.avg(y).alias(f"b{i}")]
    rows = F.array(*[F.struct(F.lit(a).alias("rater1"), F.lit(b).alias("rater2"), *[F.col(f"{c}{i}").alias(c) for c in ("po", "a", "b")]) for i, (a, b) in enumerate(pairs)])
    m = rated.agg(*means).select("n", F.inline(rows))
    pe = F.col("a") * F.col("b") + (1 - F.col("a")) * (1 - F.col("b"))
    return m.select("rater1", "rater2", "n", F.round("po", 6).alias("agreement"), F.round((F.col("po") - pe) / F.nullif(1 - pe, F.lit(0.0)), 6).alias("kappa"))


def norm(items: Column, blanks: bool = False) -> Column:
    """Items of an array without spaces, in lower case; empty ones go unless blanks."""
    out = F.transform(items, lambda x: F.lower(F.replace(x, F.lit(" "), F.lit(""))))
    return out if blanks else F.filter(out, lambda x: x != "")


def paper_key(name: Column, chars: int = 35) -> Column:
    """What file names of answers and paper names of sheets have in common: no ending, letters and digits only, cut."""
    bare = F.regexp_replace(name, r"(?i)(?:_answers)?\.(?:json|pdf)$", "")
    return F.left(F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]", ""), F.lit(chars))


def matched(answers: DataFrame, sheet_rows: DataFrame, chars: int = 35) -> DataFrame:
    """answers(file, question, …) with the cell of sheet_rows(paper, question, cell) whose paper has the file's key; a file without exactly one such paper is an error."""
    p = sheet_rows.select("paper").distinct().groupBy(paper_key(F.col("paper"), chars).alias("k")).agg(F.count(F.lit(1)).alias("papers"), F.min("paper").alias("paper"))
    a = answers.join(p, paper_key(F.col("file"), chars) == F.col("k"), "left")
    one = F.when(F.coalesce("papers", F.lit(0)) == 1, F.col("paper")).otherwise(F.raise_error(F.concat(F.lit("not one paper of the sheet fits "), F.col("file"))))
    cells = sheet_rows.select(F.col("paper").alias("p"), F.col("question").alias("q"), "cell")
    return a.withColumn("paper", one).drop("k", "papers").join(cells, (F.col("paper") == F.col("p")) & (F.col("question") == F.col("q")), "left").drop("p", "q").withColumn("cell", F.coalesce("cell", F.lit("")))


def model_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """answer_rows() of two models, by file and question; of repeated questions of b the last counts. Choices are a's, or the sorted union where b's differ; rows without choices go."""
    last = b.groupBy("file", "question").agg(F.max_by(F.struct(F.coalesce("answer_ids", F.array("answer_text")).alias("ids"), "choices"), "pos").alias("b"))
    c1, c2 = norm(F.col("choices")), norm(F.col("b.choices"))
    differ = (F.size(c2) > 0) & (F.array_sort(F.array_distinct(c1)) != F.array_sort(F.array_distinct(c2)))
    d = a.where("choices is not null").join(last, ["file", "question"])
    return d.select("file", "question", norm(F.coalesce("answer_ids", F.array("answer_text"))).alias("model1"), norm(F.col("b.ids")).alias("model2"), F.when(differ, F.array_sort(F.array_union(c1, c2))).otherwise(c1).alias("choices"))


def scores(rated: DataFrame, model: str, raters: tuple[str, str]) -> DataFrame:
    """by_choice() rows: tp, fp, fn, precision and recall. The model is right if either rater agrees; it misses only what both have; null where nothing is to divide by."""
    m, x, y = F.col(model), F.col(raters[0]), F.col(raters[1])
    c = rated.agg(F.count_if(m & (x | y)).alias("tp"), F.count_if(m & ~(x | y)).alias("fp"), F.count_if(~m & x & y).alias("fn"))
    return c.select("tp", "fp", "fn", F.round(F.try_divide("tp", F.col("tp") + F.col("fp")), 6).alias("prec"), F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 6).alias("recall"))


def evaluate(model1: DataFrame, model2: DataFrame, sheet1: DataFrame, sheet2: DataFrame) -> tuple[DataFrame, DataFrame]:
    """answer_rows() of two models and sheet() rows of two raters: kappas of five pairs, and the scores of the first model."""
    d = model_pairs(model1, model2)
    for name, s in (("rater1", sheet1), ("rater2", sheet2)):
        d = matched(d, s).withColumn(name, cell_items(F.col("cell"))).drop("cell", "paper")
    rated = by_choice(d, ["model1", "model2", "rater1", "rater2"])
    pairs = [("model1", "rater1"), ("model1", "rater2"), ("model2", "rater1"), ("model2", "rater2"), ("model1", "model2")]
    return kappas(rated, pairs), scores(rated, "model1", ("rater1", "rater2"))
