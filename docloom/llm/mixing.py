"""Mixing sources to target weights by exponential keys.

Whole epochs come first; the rest of a target is filled in the order of -ln(u) / quality, u being the first 52 bits of
the MD5 of id and text, which SQL engines share, and the document at the boundary gives only the words that are left. Prefix sums run within slices of the key's range,
so no task holds a source. Null text counts no words, null sources form one source that comes last; repeated rows count
each. Quality is 1.5, 0.5 or 1 for labels 1, 0 and none. Very long texts are counted whole, other columns are not read,
and an empty table gives no rows.
"""
from pyspark.sql import DataFrame, Window, functions as F

WEIGHTS, SHARE, MOST, SLICES = (3.0, 1.0, 2.0), 1.5, 2.0, 4096


def targets(sizes: DataFrame) -> DataFrame:
    """sizes(source, source_size), a row per source: its target, by filling caps in the order of cap to weight."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    s = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1))
    s = s.withColumn("cap", MOST * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    rank = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    upto = rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumns({"total": SHARE * F.sum("source_size").over(every), "caps": F.sum("cap").over(upto), "left": F.sum("w").over(every) - F.sum("w").over(upto) + F.col("w")})
    s = s.withColumn("full", F.col("total") - F.col("caps") + F.col("cap") >= F.col("ratio") * F.col("left"))
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0))
    open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(every)
    s = s.withColumn("level", F.try_divide(F.col("total") - spent, open_w))
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * F.col("level")).alias("target"))


def mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    q = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("labelled")).agg(F.max("quality").alias("quality"))
    d = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"), F.left(F.md5(F.concat_ws(":", "doc_id", "text")), F.lit(13)).alias("tie"))
    t = targets(d.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumnRenamed("source", "s1")
    d = d.join(q, d["doc_id"] == q["labelled"], "left").drop("labelled")
    u = (F.conv("tie", 16, 10).cast("long") + 1) / float((1 << 52) + 1)
    weight = F.when(F.col("quality") == 1, 1.5).when(F.col("quality") == 0, 0.5).otherwise(1.0)
    d = d.withColumn("key", -F.log(u) / weight).withColumn("slice", F.floor(SLICES * (1 - F.exp(-F.col("key")))))
    b = d.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    b = b.select(F.col("source").alias("s2"), F.col("slice").alias("slice2"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    d = d.join(b, d["source"].eqNullSafe(b["s2"]) & (d["slice"] == b["slice2"])).join(t, F.col("source").eqNullSafe(F.col("s1")))
    w = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    rest = F.floor(F.col("target") - epochs * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before") - F.coalesce(F.sum("size").over(w), F.lit(0))))
    return d.select("doc_id", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))
