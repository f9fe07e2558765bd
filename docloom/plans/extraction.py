"""Queries of the extraction operators over the given tables, with their SQL where it can state the rows."""
from pyspark.sql import functions as F

from docloom.operators import choices as C, cleaning as T, evaluation as E, prompts as L, sections as K, store as A

LANGS = ["en: English", "de: Deutsch", "fr: Français", "es: Español"]
PAIRS = [("quality", "toxic"), ("quality", "odd"), ("toxic", "odd")]


def _t(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _papers(spark, sf):
    """A conversation as one Markdown paper: turns are sections of three levels."""
    line = F.concat(F.repeat(F.lit("#"), (F.col("turn") % 3 + 1).cast("int")), F.lit(" "), F.col("role"), F.lit(" "), F.col("turn"), F.lit("\n"), F.col("text"))
    t = _t(spark, sf, "conversations").select("conv_id", "turn", line.alias("line"))
    return t.groupBy(F.col("conv_id").alias("paper_id")).agg(F.array_join(F.array_sort(F.collect_list(F.struct("turn", "line")))["line"], "\n").alias("text"))


PAPERS = "papers as (select conv_id as paper_id, string_agg(repeat('#', (turn % 3 + 1)::int) || ' ' || role || ' ' || turn || chr(10) || text, chr(10) order by turn) as text from conversations group by 1)"


def q_glyphs(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", T.join_hyphens(T.glyphs(F.col("text"))).alias("text"))


def q_references(spark, sf):
    cut = T.cut_references(F.concat("text", F.lit("\n## References\n[1] A paper.")))
    return _t(spark, sf, "documents").select("doc_id", F.length(cut).cast("long").alias("n_chars"), F.sha2(cut, 256).alias("digest"))


def q_fragments(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", T.sifted(F.col("text")).alias("x"))
    return d.select("doc_id", F.col("x.dropped").alias("dropped"), F.sha2("x.text", 256).alias("digest"))


def q_boilerplate(spark, sf):
    pages = _t(spark, sf, "documents").select(F.col("source").alias("paper_id"), F.col("doc_id").alias("page_no"), "text")
    d = T.drop_boilerplate(pages, 0.04)
    return d.select("paper_id", "page_no", F.length("text").cast("long").alias("n_chars"))


def q_sections(spark, sf):
    s = K.section_lines(_papers(spark, sf))
    return s.select("paper_id", F.col("pos").cast("long").alias("pos"), F.col("section_id").cast("long").alias("section_id"), "section")


def q_blocks(spark, sf):
    b = K.blocks(_papers(spark, sf))
    return b.select("paper_id", F.col("pos").cast("long").alias("pos"), "section", "is_table", F.sha2("text", 256).alias("digest"))


def q_chunks(spark, sf):
    return K.chunks(_papers(spark, sf))


def q_tokens(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.size(F.filter(F.split("text", r"\s+"), lambda x: x != "")).cast("long").alias("n_tokens"))


def q_resolve(spark, sf):
    ids = F.array(*map(F.lit, LANGS))
    form = F.expr("case doc_id % 5 when 0 then lang when 1 then upper(lang) when 2 then concat('[\"', lang, '\", ''xx'']') when 3 then chr(65 + int(doc_id % 7)) else concat('It is ', lang, '.') end")
    d = _t(spark, sf, "documents").select("doc_id", form.alias("reply"))
    return d.select("doc_id", F.array_join(C.resolve_many(F.coalesce(C.listed(F.col("reply")), F.array("reply")), ids), "; ").alias("answer"))


def q_answer(spark, sf):
    reply = F.expr("case doc_id % 4 when 0 then concat('Surely ', lang, ': here') when 1 then 'Unknown from this paper.' when 2 then concat('[''', lang, ''']') end")
    got = C.answer(reply, F.array(*map(F.lit, ["en", "de", "fr", "es"])))
    return _t(spark, sf, "documents").select("doc_id", got["kind"].alias("kind"), F.coalesce(F.array_join(got["ids"], "; "), F.lit("")).alias("answer"))


def q_context(spark, sf):
    r = L.ranked(_t(spark, sf, "conversations"), ["conv_id"], "turn", ["text"])
    p = L.prompt(F.lit("Who speaks?"), F.array(F.lit("user"), F.lit("assistant")), F.col("text"), "{question}\n{answers}\n{context}", "{question}\n{context}")
    return r.select("conv_id", p.alias("prompt"))


def q_unanswered(spark, sf):
    papers, held = (_t(spark, sf, t).select(F.col("doc_id").alias("paper_id")) for t in ("documents", "labels"))
    return L.unanswered(papers, held, spark.createDataFrame([("Q1",), ("Q2",)], "question string"))


def q_sheet(spark, sf):
    return E.sheet(_t(spark, sf, "labels"), "doc_id")


def q_kappas(spark, sf):
    d = _t(spark, sf, "labels").select((F.col("quality") == 1).alias("quality"), (F.col("toxic") == 1).alias("toxic"), (F.col("doc_id") % 2 == 1).alias("odd"))
    return E.kappas(d, PAIRS)


def q_by_choice(spark, sf):
    cell = F.concat_ws("; ", "lang", "source", F.upper("lang"))
    d = _t(spark, sf, "documents").select("doc_id", E.cell_items(cell).alias("r1"), F.array(F.lower("source")).alias("r2"))
    d = d.withColumn("choices", F.array_sort(F.array_union("r1", "r2")))
    return E.by_choice(d, ["r1", "r2"]).select("doc_id", "choice", "r1", "r2")


def q_names(spark, sf):
    k = F.concat("url", F.lit(" - a long name, with more than enough signs"))
    d = _t(spark, sf, "pages").select("page_id", E.clean_key(F.col("url")).alias("name_key"), A.output_name(k).alias("output_name"), A.index_key(F.lit("a b"), F.lit("1.0"), 300, 50, F.col("url")).alias("index_key"))
    return d


def q_ranges(spark, sf):
    """Names of whole urls."""
    return A.range_names(_t(spark, sf, "pages").select("page_id", "url"), "url", "page_id").select("page_id", "range_name")


def q_summary(spark, sf):
    d = _t(spark, sf, "documents")
    return A.index_summary(d, "source", "n_chars", F.col("text").contains("|"))


def q_sample(spark, sf):
    return A.sample(_t(spark, sf, "documents").select("doc_id", "source"), "doc_id", 50)


QUERIES = {"clean_glyphs": q_glyphs, "cut_references": q_references, "drop_fragments": q_fragments, "drop_boilerplate": q_boilerplate, "section_paths": q_sections, "blocks": q_blocks, "chunks": q_chunks, "token_count": q_tokens, "resolve_choices": q_resolve, "answer_kinds": q_answer, "prompt_context": q_context, "unanswered": q_unanswered, "rater_sheet": q_sheet, "pairwise_kappa": q_kappas, "by_choice": q_by_choice, "names_and_keys": q_names, "range_names": q_ranges, "index_summary": q_summary, "seeded_sample": q_sample}

_KEY = "regexp_replace(replace(lower({0}), 'ß', 'ss'), '[^a-z]+', '', 'g')"
_FRAGMENT = r"(s <> '' and not regexp_matches(s, '^([#|*>-]|[0-9]+[.)]\s)') and (not regexp_matches(s, '[A-Za-z]') or (len(regexp_split_to_array(s, '\s+')) <= 3 and not regexp_matches(s, '[.!?:;,]$') and length(s) < 40)))"
_LINES = r"lines as (select paper_id, generate_subscripts(l, 1) - 1 as pos, unnest(l) as line from (select paper_id, string_split(text, chr(10)) as l from papers))"
_LEVEL = r"lev as (select *, length(regexp_extract(line, '^\s{0,3}(#{1,6})\s+\S', 1)) as level, regexp_replace(line, '^\s*#+\s+', '') as title from lines)"
_RUN = "over (partition by paper_id order by pos rows unbounded preceding)"
_STACK = "st as (select *, " + ", ".join(f"coalesce(max(case when level = {k} then pos end) {_RUN}, -1) as p{k}, arg_max(title, case when level = {k} then pos end) {_RUN} as t{k}" for k in range(1, 7)) + f", sum((level > 0)::int) {_RUN} as section_id from lev)"
_PATH = "concat_ws(' > ', " + ", ".join(f"case when p{k} > greatest({', '.join(['-1'] + [f'p{j}' for j in range(1, k)])}) then t{k} end" for k in range(1, 7)) + ")"
_SECTIONS = f"{PAPERS}, {_LINES}, {_LEVEL}, {_STACK}, sec as (select paper_id, pos, line, level, section_id, {_PATH} as section from st)"
_KAPPA = " union all ".join(f"select '{a}' as rater1, '{b}' as rater2, count(*) as n, avg(({a} = {b})::int) as po, avg({a}::int) as a, avg({b}::int) as b from r" for a, b in PAIRS)
SQL = {
    "clean_glyphs": r"select doc_id, regexp_replace(regexp_replace(regexp_replace(replace(nfc_normalize(replace(text, chr(173), '')), chr(160), ' '), '[ \t]{2,}', ' ', 'g'), '([a-z])-\n([a-z])', '\1\2', 'g'), '([a-z])-\n([a-z])', '\1\2', 'g') as text from documents",
    "cut_references": "select doc_id, length(x) as n_chars, sha256(x) as digest from (select doc_id, case when length(text) + 1 >= floor((length(text) + 27) * 0.3) then regexp_replace(text, '\\s+$', '') || chr(10) else text || chr(10) || '## References' || chr(10) || '[1] A paper.' end as x from documents)",
    "drop_fragments": f"select doc_id, count(*) filter ({_FRAGMENT}) as dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not {_FRAGMENT}), '')) as digest from (select *, regexp_replace(line, '^\\s+|\\s+$', '', 'g') as s from (select doc_id, generate_subscripts(l, 1) as pos, unnest(l) as line from (select doc_id, string_split(text, chr(10)) as l from documents))) group by 1",
    "drop_boilerplate": f"with l as (select source, doc_id, generate_subscripts(l, 1) as pos, unnest(l) as line from (select source, doc_id, string_split(text, chr(10)) as l from documents)), k as (select *, {_KEY.format('trim(line)')} as key from l), n as (select source, count(distinct doc_id) as n from documents group by 1), f as (select source, key from (select source, key, count(distinct doc_id) as pages from k where key <> '' and length(trim(line)) between 1 and 200 group by 1, 2) join n using (source) where n >= 3 and pages >= greatest(2, floor(0.04 * n)::int)) select source as paper_id, doc_id as page_no, coalesce(sum(length(line) + 1) filter (length(trim(line)) > 200 or not exists (select 1 from f where f.source = k.source and f.key = k.key)) - 1, 0)::bigint as n_chars from k group by 1, 2",
    "section_paths": f"with {_SECTIONS} select paper_id, pos, section_id::bigint as section_id, section from sec",
    "blocks": f"with {_SECTIONS}, kd as (select *, case when level > 0 then 'heading' when trim(line) = '' then 'blank' when regexp_matches(line, '^\\s*\\|.*\\|\\s*$') then 'table' else 'prose' end as kind from sec), nw as (select *, (lag(kind) over (partition by paper_id order by pos) is distinct from kind)::int as new from kd), bl as (select *, sum(new) {_RUN} as block from nw) select paper_id, min(pos) as pos, section, kind = 'table' as is_table, sha256(case when kind = 'table' then string_agg(trim(line), chr(10) order by pos) else string_agg(trim(line), ' ' order by pos) end) as digest from bl where kind in ('table', 'prose') group by paper_id, section_id, section, block, kind",
    "token_count": r"select doc_id, len(regexp_extract_all(text, '[^ \t\n\v\f\r]+')) as n_tokens from documents",
    "resolve_choices": "select doc_id, case when doc_id % 5 in (0, 1, 2) then v.name when doc_id % 5 = 3 then w.name else '' end as answer from documents join (values ('en', 'en: English'), ('de', 'de: Deutsch'), ('fr', 'fr: Français'), ('es', 'es: Español')) v(l, name) on l = lang join (values (0, 'en: English'), (1, 'de: Deutsch'), (2, 'fr: Français'), (3, 'de: Deutsch'), (4, ''), (5, 'fr: Français'), (6, '')) w(i, name) on i = doc_id % 7",
    "answer_kinds": "select doc_id, case doc_id % 4 when 1 then 'abstain' when 3 then 'error' else 'choices' end as kind, case when doc_id % 4 in (0, 2) then lang else '' end as answer from documents",
    "prompt_context": "select conv_id, 'Who speaks?' || chr(10) || '[''user'', ''assistant'']' || chr(10) || string_agg('CHUNK ' || rk || ': ' || text, repeat(chr(10), 3) order by turn) as prompt from (select *, row_number() over (partition by conv_id order by turn) as rk from conversations) group by 1",
    "unanswered": "select doc_id as paper_id, question from documents d, (values ('Q1'), ('Q2')) q(question) where not exists (select 1 from labels l where l.doc_id = d.doc_id)",
    "rater_sheet": "select doc_id, 'quality' as question, coalesce(quality::varchar, '') as cell from labels union all select doc_id, 'toxic', coalesce(toxic::varchar, '') from labels",
    "pairwise_kappa": f"with r as (select quality = 1 as quality, toxic = 1 as toxic, doc_id % 2 = 1 as odd from labels) select rater1, rater2, n, round(po, 6) as agreement, round((po - pe) / nullif(1 - pe, 0), 6) as kappa from (select *, a * b + (1 - a) * (1 - b) as pe from ({_KAPPA}))",
    "by_choice": "select doc_id, lower(lang) as choice, true as r1, false as r2 from documents union all select doc_id, lower(source), true, true from documents",
    "names_and_keys": r"select page_id, lower(translate(url, '_ -,', '')) as name_key, case when length(n) > 50 then left(n, 50) || '_' || left(sha1(n), 8) else n end as output_name, 'a-b-1.0_t300_o50_' || regexp_replace(regexp_replace(url, '[^A-Za-z0-9.-]+', '-', 'g'), '^-+|-+$', '', 'g') as index_key from (select *, regexp_replace(regexp_replace(url || ' - a long name, with more than enough signs', '[ -]', '_', 'g'), '[^\p{L}\p{N}._-]', '', 'g') as n from pages)",
    "range_names": "select page_id, case when rk = 1 then base else base || '_' || (rk - 1) end as range_name from (select *, row_number() over (partition by base order by page_id) as rk from (select page_id, regexp_replace(url, '[^A-Za-z0-9_]', '_', 'g') as base from pages))",
    "index_summary": "select source, count(*) as chunks, count(*) filter (contains(text, '|')) as tables, min(n_chars) as least, list_sort(list(n_chars))[count(*) // 2 + 1] as median, max(n_chars) as most from documents group by 1",
    "seeded_sample": "select doc_id, source from documents order by md5('42:' || doc_id) limit 50",
}
