"""From files to answers: parse, clean, chunk, embed, retrieve, ask, resolve, write."""
from dataclasses import dataclass, field
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators import choices as C, cleaning as T, prompts as L, retrieval as R, sections as K, store as A
from docloom.sources import files as S


@dataclass
class Settings:
    """Every choice of a run. Parsers, embedder, token count and model are functions; the defaults need no network."""

    parser: str = "text"
    parsers: dict = field(default_factory=dict)
    pattern: str = "*"
    top_k: int = 3
    chunk_tokens: int = 300
    overlap: int = 50
    max_tokens: int | None = None
    count: Callable[[str], int] = K.words
    embedder: Callable = field(default_factory=R.hashing_embedder)
    embedder_name: str = "hashing-256"
    batch: int = 8
    model: Callable[[list[str]], list] = L.extractive
    at_once: int = 16
    templates: dict = field(default_factory=lambda: {"user": "Return a list of the fitting ANSWERS only.", "user_open": "Answer from the CONTEXT only."})
    references: bool = True
    use_cache: bool = True
    subset: int | None = None
    seed: int = 42
    first: int | None = None


def papers(spark: SparkSession, folder: str, s: Settings) -> DataFrame:
    """The files of a run: all, or a seeded sample, and of those the first."""
    d = S.files(spark, folder, s.pattern, required=True)
    d = A.sample(d, "filename", s.subset, s.seed) if s.subset is not None else d
    return A.head(d, "filename", s.first)


def index(found: DataFrame, s: Settings) -> DataFrame:
    """Chunks with embeddings: paper_id, index_key, filename, chunk_id, section, …, parser, needs_ocr. A paper without text has no rows."""
    rows = S.parsed(found, s.parser, parsers=s.parsers)
    about = rows.groupBy("paper_id").agg(F.first("parser").alias("parser"), F.first("version").alias("version"), F.first("is_markdown").alias("is_markdown"))
    text = T.clean_papers(rows.where("page_no is not null").select("paper_id", "page_no", "text"), references=s.references).join(about, "paper_id")
    text = text.withColumn("needs_ocr", T.ocr(F.col("text"), F.col("n_pages"))["needs_ocr"])
    c = K.chunks(text, s.chunk_tokens, s.overlap, s.count, s.max_tokens, markdown="is_markdown")
    c = R.embed(c, "embed_text", s.embedder, s.batch)
    keyed = found.select("paper_id", "filename", "index_key").dropDuplicates(["paper_id"])
    return c.join(text.select("paper_id", "parser", "needs_ocr"), "paper_id").join(keyed, "paper_id")


def stored_index(found: DataFrame, cache: str | None, s: Settings) -> DataFrame:
    """index(), of which the table at cache keeps what the same file and settings gave before."""
    parser = (S.PARSERS | s.parsers)[s.parser]
    d = found.withColumn("index_key", A.index_key(F.lit(s.parser), F.lit(parser[1]), s.chunk_tokens, s.overlap, F.lit(s.embedder_name)))
    return A.build_incremental(d, cache, ["paper_id", "index_key"], lambda new: index(new, s), s.use_cache) if cache else index(d, s)


def answers(found: DataFrame, chunks: DataFrame, questions: DataFrame, s: Settings) -> DataFrame:
    """questions as S.questions gives them. A row per paper and question: paper, pos, id, question, answer_kind, answer, answer_label, raw_answer, error and what was retrieved.

    The model's replies are not stored here: write the result before anything else reads it.
    """
    q = questions.withColumn("pairs", C.normalize(F.col("choices"))).withColumn("ids", F.col("pairs.id"))
    asked = R.embed(q.select(F.col("id").alias("question_id"), "text"), "text", s.embedder, s.batch).select("question_id", "embedding")
    best = R.topk_per_paper(chunks, asked, s.top_k)
    best = best.join(chunks.select("paper_id", F.col("chunk_id").cast("long").alias("chunk_id"), "section", "embed_text", "parser"), ["paper_id", "chunk_id"])
    hits = L.ranked(best, ["paper_id", "question_id"], "rk", ["chunk_id", "embed_text", "section", "score", "parser"])
    names = found.groupBy("paper_id").agg(F.min("filename").alias("paper"))
    d = hits.join(names, "paper_id").join(q.withColumnRenamed("id", "question_id"), "question_id")
    fill = lambda t, k: t.replace("{instructions}", s.templates[k])
    d = d.withColumn("prompt", L.prompt(F.col("text"), F.col("ids"), F.col("embed_text"), fill(L.CLOSED, "user"), fill(L.OPEN, "user_open"), F.col("paper")))
    d = L.ask(d, s.model, s.at_once)
    got = C.answer(F.col("reply"), F.col("ids"))
    d = d.withColumn("kind", got["kind"]).withColumn("chosen", got["ids"])
    text = F.when(F.col("kind") == "open", F.col("reply")).when(F.col("kind") != "choices", F.lit(C.UNKNOWN))
    told = d.select("paper", "pos", F.col("question_id").alias("id"), F.col("text").alias("question"), F.col("kind").alias("answer_kind"), F.when(F.col("kind") == "choices", F.col("chosen")).alias("answer"), text.alias("answer_text"), F.when(F.col("kind") == "choices", C.labels(F.col("chosen"), F.col("pairs"))).alias("answer_label"), F.col("reply").alias("raw_answer"), "error", F.col("ids").alias("choices_ids"), F.col("chunk_id").alias("chunks_id"), F.col("embed_text").alias("chunks_str"), F.col("section").alias("chunks_section"), F.col("score").alias("chunks_score"), "paper_id", F.col("parser")[0].alias("parser"), F.lit(s.embedder_name).alias("sent_transformer"), F.col("model").alias("LLM"), "finish_reason", F.col("total_tokens").alias("total_len"))
    none = L.unanswered(names, chunks, q.select("pos", "id", F.col("text").alias("question"))).join(names, "paper_id")
    none = none.select("paper", "pos", "id", "question", F.lit("no_text").alias("answer_kind"), F.lit(C.UNKNOWN).alias("answer_text"), "paper_id")
    return told.unionByName(none, allowMissingColumns=True)


def run(spark: SparkSession, folder: str, questions: str, out: str, cache: str | None = None, s: Settings | None = None) -> DataFrame:
    """Answers every question for every file of a folder, and writes them as a table at out, which is read back."""
    s = s or Settings()
    found = papers(spark, folder, s)
    answers(found, stored_index(found, cache, s), S.questions(spark, questions), s).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)
