"""Content-addressed incremental storage: names, keys, listings, samples."""
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def content_id(content: Column) -> Column:
    return F.left(F.sha2(content, 256), F.lit(16))


def slug(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, "[^A-Za-z0-9.-]+", "-"), "^-+|-+$", "")


def index_key(parser: Column, version: Column, tokens: int, overlap: int, embedder: Column) -> Column:
    return F.concat(slug(parser), F.lit("-"), slug(version), F.lit(f"_t{tokens}_o{overlap}_"), slug(embedder))


def output_name(stem: Column) -> Column:
    name = F.regexp_replace(F.regexp_replace(stem, "[ -]", "_"), r"[^\p{L}\p{N}._-]", "")
    return F.when(F.length(name) > 50, F.concat(F.left(name, F.lit(50)), F.lit("_"), F.left(F.sha1(name), F.lit(8)))).otherwise(name)


def range_names(df: DataFrame, text: str, order: str) -> DataFrame:
    """A column range_name that a spreadsheet allows; a name already given gets the first free of _1, _2 in the given order, so none is given twice.

    Only names that are equal without their ends of _ and digits can meet; rows are named one after another within such a group, which goes to one task. Null texts have no name.
    """
    base = F.regexp_replace(text, "[^A-Za-z0-9_]", "_")
    base = F.left(F.when(base.rlike("^[A-Za-z_]"), base).otherwise(F.concat(F.lit("Q_"), base)), F.lit(240))

    def run(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t, sort_keys=[(order, "ascending")], null_placement="at_start"))
        used, tried, names = set(), {}, []
        for b in t.column("base").to_pylist():
            name, i = b, tried.get(b, 0)
            while b is not None and name in used:
                i += 1
                name = f"{b}_{i}"
            tried[b] = i
            used.add(name)
            names.append(name)
        return t.drop_columns(["base", "root"]).append_column("range_name", pa.array(names, pa.string()))

    d = df.withColumn("base", base).withColumn("root", F.regexp_replace("base", "(_[0-9]+)+$", ""))
    return d.groupBy("root").applyInArrow(run, StructType(df.schema.fields + [StructField("range_name", StringType())]))


def index_summary(chunks: DataFrame, key: str, size: str, table: Column) -> DataFrame:
    """Counts and sizes per key; the median is the upper one of an even number."""
    rank, n = F.row_number().over(Window.partitionBy(key).orderBy(size)), F.count(F.lit(1)).over(Window.partitionBy(key))
    d = chunks.select(key, size, table.alias("is_table")).withColumns({"rank": rank, "n": n})
    m = F.max(F.when(F.col("rank") == F.floor(F.col("n") / 2) + 1, F.col(size)))
    return d.groupBy(key).agg(F.count(F.lit(1)).alias("chunks"), F.count_if("is_table").alias("tables"), F.min(size).alias("least"), m.alias("median"), F.max(size).alias("most"))


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by a hash of seed and key, in the order of key; all rows if there are no more."""
    if n <= 0:
        raise ValueError("n must be at least 1")
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))).limit(n).orderBy(key)


def head(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The first n rows in the order of key; all of them for a null n."""
    return df.orderBy(key) if n is None else df.orderBy(key).limit(n)


def listing(papers: DataFrame, chunks: DataFrame) -> DataFrame:
    """papers(paper_id, filename, parser, n_pages), chunks(paper_id, index_key, …): per paper its parsers, pages, number of indexes and file."""
    n = chunks.groupBy("paper_id").agg(F.count_distinct("index_key").alias("indexes"))
    g = papers.groupBy("paper_id").agg(F.array_join(F.array_sort(F.collect_set("parser")), ", ").alias("parsers"), F.max("n_pages").alias("n_pages"), F.min("filename").alias("filename"))
    return g.join(n, "paper_id", "left").select("paper_id", "parsers", "n_pages", F.coalesce("indexes", F.lit(0)).alias("indexes"), "filename")


def preview(chunks: DataFrame, key: str, n: int = 3, chars: int = 200) -> DataFrame:
    """The first n chunks per key, their texts cut to chars."""
    w = Window.partitionBy(key).orderBy("chunk_id")
    return chunks.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n).select(key, "chunk_id", F.left("text", F.lit(chars)).alias("text"))


def upsert_names(have: DataFrame, new: DataFrame) -> DataFrame:
    """Named ranges (name, target): those of have whose name, in any case, new does not bring, and all of new."""
    return have.join(new.select(F.lower("name").alias("n")).distinct(), F.lower(have["name"]) == F.col("n"), "left_anti").unionByName(new)


def grid(papers: DataFrame, questions: DataFrame) -> DataFrame:
    """A cell per paper and question; the question list is small by nature and within Spark's own threshold."""
    return papers.crossJoin(questions)


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def build_incremental(inputs: DataFrame, path: str, key: str | list[str], compute: Callable[[DataFrame], DataFrame], use_cache: bool = True) -> DataFrame:
    """Computes what the table at path lacks, appends it, and gives the rows of inputs' keys.

    key names all that a row's content depends on, such as paper_id and index_key: other settings are other keys and do
    not find each other's rows. use_cache=False computes all of inputs anew in place of the rows that the table has.
    """
    spark, keys = inputs.sparkSession, [key] if isinstance(key, str) else key
    asked = inputs.select(*keys).distinct()
    if not _exists(spark, path):
        compute(inputs).write.parquet(path)
    elif use_cache:
        compute(inputs.join(spark.read.parquet(path).select(*keys).distinct(), keys, "left_anti")).write.mode("append").parquet(path)
    else:
        have = spark.read.parquet(path)
        compute(inputs).unionByName(have.join(asked, keys, "left_anti"), allowMissingColumns=True).write.parquet(f"{path}.new")
        old, new = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, f"{path}.new"))
        fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(old, True)
        fs.rename(new, old)
        spark.catalog.refreshByPath(path)
    return spark.read.parquet(path).join(asked, keys, "left_semi")
