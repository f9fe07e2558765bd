"""Queries over the given tables, each with the SQL that states the same rows."""
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docloom.operators.retrieval import l2_norm, topk_cosine
from docloom.plans import extraction, literals


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def q_topk(spark, sf):
    """Every row whose id 20 divides against all rows, so the query set grows with the table."""
    v = _t(spark, sf, "embeddings").select("vec_id", "embedding")
    return topk_cosine(v, v.where("vec_id % 20 = 0").toDF("query_id", "query"), undefined=True).select("query_id", "vec_id", F.col("rk").cast("long").alias("rk"), "score")


def q_norm(spark, sf):
    return _t(spark, sf, "embeddings").select("vec_id", F.round(l2_norm(F.col("embedding")), 4).alias("norm"))


def q_content_id(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.substring(F.sha2("text", 256), 1, 16).alias("content_id"))


def q_dedup(spark, sf):
    return _t(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("content")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


def q_kappa(spark, sf):
    a, b = F.col("quality").cast("double"), F.col("toxic").cast("double")
    m = _t(spark, sf, "labels").agg(F.count(F.lit(1)).alias("n"), F.avg((a == b).cast("double")).alias("po"), F.avg(a).alias("p1"), F.avg(b).alias("p2"))
    pe = F.col("p1") * F.col("p2") + (1 - F.col("p1")) * (1 - F.col("p2"))
    return m.select("n", F.round("po", 6).alias("agreement"), F.round((F.col("po") - pe) / F.nullif(1 - pe, F.lit(0.0)), 6).alias("kappa"))


def q_pr(spark, sf):
    """Two raters against a third: true if either agrees, missed only if both do."""
    d = _t(spark, sf, "labels").select((F.col("doc_id") % 2 == 0).alias("m"), (F.col("quality") == 1).alias("a"), (F.col("toxic") == 1).alias("b"))
    m, a, b = F.col("m"), F.col("a"), F.col("b")
    c = d.agg(F.count_if(m & (a | b)).alias("tp"), F.count_if(m & ~(a | b)).alias("fp"), F.count_if(~m & a & b).alias("fn"))
    return c.select("tp", "fp", "fn", F.round(F.try_divide("tp", F.col("tp") + F.col("fp")), 6).alias("prec"), F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 6).alias("recall"))


def q_lines(spark, sf):
    """Line keys that recur on at least max(2, 4 %) of a source's documents."""
    d = _t(spark, sf, "documents")
    line = F.trim("line")
    keys = d.select("source", "doc_id", F.explode(F.split("text", "\n")).alias("line")).where((F.length(line) > 0) & (F.length(line) <= 200))
    keys = keys.select("source", "doc_id", F.regexp_replace(F.replace(F.lower(line), F.lit("ß"), F.lit("ss")), "[^a-z]+", "").alias("key")).where("key <> ''")
    n = d.groupBy("source").agg(F.count_distinct("doc_id").alias("n"))
    return keys.groupBy("source", "key").agg(F.count_distinct("doc_id").alias("pages")).join(n, "source").where("n >= 3 and pages >= greatest(2, cast(floor(0.04 * n) as int))").select("source", "key", "pages")


def q_sentences(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", r"(?<=[.!?])\s+")).alias("pos", "sentence")).withColumn("pos", F.col("pos").cast("long"))


def q_ocr(spark, sf):
    g = _t(spark, sf, "documents").groupBy("source").agg(F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("pages"))
    r = F.col("chars") / F.col("pages")
    return g.select("source", F.round(r, 1).alias("chars_per_page"), (r < 200).alias("needs_ocr"))


def q_incremental(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", "source").join(_t(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


def q_offsets(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return d.select("doc_id", F.col("pos").cast("long").alias("pos"), F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)).cast("long").alias("start"))


def q_html(spark, sf):
    return _t(spark, sf, "pages").select("page_id", F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1).alias("title"))


QUERIES = {"topk_cosine": q_topk, "l2_norm": q_norm, "content_id": q_content_id, "dedup_by_content": q_dedup, "kappa": q_kappa, "precision_recall": q_pr, "boilerplate_keys": q_lines, "sentence_split": q_sentences, "needs_ocr": q_ocr, "incremental_build": q_incremental, "line_offsets": q_offsets, "html_parse": q_html} | extraction.QUERIES | literals.QUERIES
SQL = {
    "topk_cosine": "select query_id, vec_id, rk, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) rk from (select q.vec_id query_id, v.vec_id, round(list_cosine_similarity(v.embedding::double[], q.embedding::double[]), 4) score from embeddings v join embeddings q on q.vec_id % 20 = 0 and v.vec_id <> q.vec_id)) where rk <= 3",
    "l2_norm": "select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 4) as norm from embeddings",
    "content_id": "select doc_id, substr(sha256(text), 1, 16) as content_id from documents",
    "dedup_by_content": "select sha256(text) as content, min(doc_id) as doc_id, count(*) as copies from documents group by 1",
    "kappa": "select n, round(po, 6) as agreement, round((po - pe) / nullif(1 - pe, 0), 6) as kappa from (select *, p1 * p2 + (1 - p1) * (1 - p2) pe from (select count(*) n, avg((quality = toxic)::int) po, avg(quality) p1, avg(toxic) p2 from labels))",
    "precision_recall": "select tp, fp, fn, round(tp / nullif(tp + fp, 0), 6) as prec, round(tp / nullif(tp + fn, 0), 6) as recall from (select count(*) filter (m and (a or b)) tp, count(*) filter (m and not (a or b)) fp, count(*) filter (not m and a and b) fn from (select doc_id % 2 = 0 m, quality = 1 a, toxic = 1 b from labels))",
    "boilerplate_keys": "with l as (select source, doc_id, trim(unnest(string_split(text, chr(10)))) line from documents), k as (select source, doc_id, regexp_replace(replace(lower(line), 'ß', 'ss'), '[^a-z]+', '', 'g') as key from l where length(line) between 1 and 200), n as (select source, count(distinct doc_id) n from documents group by 1) select source, key, pages from (select source, key, count(distinct doc_id) pages from k where key <> '' group by 1, 2) join n using (source) where n >= 3 and pages >= greatest(2, floor(0.04 * n)::int)",
    "sentence_split": "select doc_id, generate_subscripts(s, 1) - 1 as pos, unnest(s) as sentence from (select doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) s from documents)",
    "needs_ocr": "select source, round(sum(length(text)) / count(*), 1) as chars_per_page, sum(length(text)) / count(*) < 200 as needs_ocr from documents group by 1",
    "incremental_build": "select doc_id, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)",
    "line_offsets": "select doc_id, pos, coalesce(sum(length(line) + 1) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0)::bigint as start from (select doc_id, generate_subscripts(s, 1) - 1 as pos, unnest(s) as line from (select doc_id, string_split(text, chr(10)) s from documents))",
    "html_parse": "select page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) as title from pages",
} | extraction.SQL | literals.SQL
