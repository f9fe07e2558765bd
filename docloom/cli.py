"""python -m docloom.cli FOLDER QUESTIONS OUT: answers questions for a folder of files; --list shows what a cache holds."""
import argparse

from pyspark.sql import SparkSession

from docloom.operators import store as A
from docloom.plans import flow
from docloom.sources import files as S


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("folder"), p.add_argument("questions"), p.add_argument("out")
    p.add_argument("--pattern", default="*"), p.add_argument("--parser", default="text", choices=sorted(S.PARSERS))
    p.add_argument("--cache"), p.add_argument("--no-cache", action="store_true")
    for name, default in (("--top-k", 3), ("--chunk-tokens", 300), ("--chunk-overlap", 50), ("--batch", 8), ("--seed", 42)):
        p.add_argument(name, type=int, default=default)
    p.add_argument("--subset", type=int), p.add_argument("--first", type=int), p.add_argument("--max-tokens", type=int)
    p.add_argument("--templates"), p.add_argument("--json", help="also write an indented file per paper here")
    p.add_argument("--list", action="store_true", help="show the cache's papers and indexes")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    s = flow.Settings(parser=a.parser, pattern=a.pattern, top_k=a.top_k, chunk_tokens=a.chunk_tokens, overlap=a.chunk_overlap, batch=a.batch, seed=a.seed, subset=a.subset, first=a.first, max_tokens=a.max_tokens, use_cache=not a.no_cache)
    if a.templates:
        s.templates = S.templates(spark, a.templates)
    rows = flow.run(spark, a.folder, a.questions, a.out, a.cache, s)
    if a.json:
        S.write_papers(rows, a.json)
    if a.list and a.cache:
        c = spark.read.parquet(a.cache)
        A.index_summary(c, "index_key", "n_tokens", c["is_table"]).show(truncate=False)
        A.preview(c, "paper_id").show(truncate=80)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
