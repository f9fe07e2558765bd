"""Connected components of an edge table, by alternating large and small stars."""
from pyspark.sql import DataFrame, functions as F

from docloom.llm.shared import stored


def _stars(e: DataFrame) -> DataFrame:
    """Large star, then small star, over edges (a, b) with a > b. The hubs' minima are joined back, so no neighbour list is gathered."""
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    large = both.where("b > a").join(low, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
    small = large.join(least, F.col("a") == F.col("k"))
    out = small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("k").alias("a"), F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of longs: a row (id, component) for every id that has an edge, component being the smallest id reachable.

    Loops, nulls and repeated edges change nothing; no edges give no rows.
    """
    e = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, seen = stored(e), None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        e, seen = stored(_stars(e)), state
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
