"""Queries over literal rows, for rules that the given tables cannot show, and of packing, retrieval by paper, joins and listings; each with SQL of its own."""
from pyspark.sql import functions as F

from docloom.operators import choices as C, cleaning as T, evaluation as E, retrieval as R, sections as K, store as A

CHOICES = ["Audio: speech or sound", "Automatic review", "Image: x-ray", "Image: photo", "Tabular data", "Text: notes", "Unknown from this paper"]
CANDIDATES = ["Tabular data", "tabular DATA", " Text ", "text: notes", "image", "Ima", "Aud", "au", "B", "g", "Z", "", "  ", "Automatic review.", "Image: photo", "unknown from this paper", "c", "Tex", "zz", "1"]
LISTS = ['["B", "Text"]', "['Image: photo', 'Audio']", 'I say ["Tabular data"] or ["B"]', "[]", "[1, 2]", '{"answers": ["Text: notes", "B"]}', "[not quoted]", "none here", '["a", ]', '["a" "b"]', '["Text: notes"', "[ 'x' , \"y\" ]"]
PROSE = ["It is Tabular data.", "Not Image: photo but Text: notes", '"Text: notes"', '{"id": "Automatic review"}', 'See:\n```json\n{"id": "Image: x-ray"}\n``` not Tabular data', "xTabular data", "The answer is Audio, surely", "Image, perhaps", "Text: notes", "", "Tabular data1", "Automatic review or Tabular data", '{"id": "nope", "why": "Tabular data"}', "B", "I mean Text or Audio"]
REPLIES = LISTS + PROSE + [None, "Unknown from this paper", "unknown from this paper..", '["zz"] Text: notes', '["Unknown from this paper"]', '["B", "b", "Text: notes"]']
LABELLED = [["a", "b"], ['{"id": "1", "label": "One"}', '{"id": "2"}', '{"id": 3, "label": "Three"}'], [], None, ["x: y"]]
PAPERS = ["alpha classifi-\ncation beta", "Non-\nword and a-\nb-\nc", "no break", "end-\n", "3-\n4 mixed-\nCase"]


def _t(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _rows(spark, values, kind="string"):
    return spark.createDataFrame(list(enumerate(values)), f"i long, x {kind}")


def _ids():
    return F.array(*map(F.lit, CHOICES))


def q_choices_normalize(spark, sf):
    n = C.normalize(F.col("x"))
    return _rows(spark, LABELLED, "array<string>").select("i", *[F.coalesce(F.array_join(n[c], "|"), F.lit("")).alias(f"{c}s") for c in ("id", "label")])


def q_choices_resolve(spark, sf):
    return _rows(spark, CANDIDATES).select("i", F.coalesce(C.resolve(F.col("x"), _ids()), F.lit("")).alias("answer"))


def q_choices_parse_list(spark, sf):
    return _rows(spark, LISTS).select("i", F.coalesce(F.array_join(C.listed(F.col("x")), "|"), F.lit("(none)")).alias("items"))


def q_choices_extract_prose(spark, sf):
    x = F.col("x")
    return _rows(spark, PROSE).select("i", F.coalesce(C.extract(x, _ids()), C.extract_base(x, _ids()), F.lit("")).alias("answer"))


def q_answer_finalize(spark, sf):
    """Each reply to a closed and to an open question."""
    d = _rows(spark, REPLIES).select("i", "x", F.explode(F.array(F.lit(True), F.lit(False))).alias("closed"))
    got = C.answer(F.col("x"), F.when(F.col("closed"), _ids()))
    return d.select("i", "closed", got["kind"].alias("kind"), F.coalesce(F.array_join(F.array_sort(got["ids"]), "; "), F.lit("")).alias("answer"))


def q_dehyphenate(spark, sf):
    return _rows(spark, PAPERS).select("i", T.join_hyphens(F.col("x")).alias("text"))


def q_table_split(spark, sf):
    """Tables of i * 7 rows of five words under a head of six, between two paragraphs."""
    row = F.transform(F.sequence(F.lit(1), F.col("i").cast("int") * 7), lambda n: F.concat(F.lit("| r"), n, F.lit(" a b |")))
    text = F.concat(F.lit("Before it.\n\n| name x y |\n|---|---|---|\n"), F.array_join(row, "\n"), F.lit("\n\nAfter it."))
    c = K.chunks(spark.range(1, 9).select(F.col("id").alias("paper_id"), F.col("id").alias("i")).select("paper_id", text.alias("text")), 32, 0)
    return c.select("paper_id", F.col("chunk_id").cast("long").alias("chunk_id"), "is_table", F.col("n_tokens").cast("long").alias("n_tokens"), "text")


def q_sentence_repair(spark, sf):
    s = K.sentence_rows(K.paragraph_rows(_t(spark, sf, "documents"), ["doc_id"]), ["doc_id", "par"])
    return s.select("doc_id", F.col("par").cast("long").alias("par"), F.col("sent").cast("long").alias("sent"), F.sha2("sentence", 256).alias("digest"))


def _packed(overlap):
    def query(spark, sf):
        d = _t(spark, sf, "documents").select(F.col("doc_id").alias("paper_id"), "text", F.lit(False).alias("markdown"))
        c = K.chunks(d, 300, overlap, markdown="markdown")
        return c.select(F.col("paper_id").alias("doc_id"), F.col("chunk_id").cast("long").alias("chunk_id"), F.col("n_tokens").cast("long").alias("n_tokens"), F.sha2("text", 256).alias("digest"))

    return query


def q_boilerplate_examples(spark, sf):
    pages = _t(spark, sf, "documents").select(F.col("source").alias("paper_id"), F.col("doc_id").alias("page_no"), "text")
    return T.boilerplate(pages, 0.04)


def _vectors(spark, sf):
    v = _t(spark, sf, "embeddings")
    return v, v.where("vec_id % 20 = 0")


def q_topk_gather(spark, sf):
    v, q = _vectors(spark, sf)
    d = R.topk_cosine(v.select("vec_id", "embedding"), q.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), undefined=True)
    return d.groupBy("query_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("rk", "vec_id")))["vec_id"], ",").alias("chunks"))


def q_topk_per_paper(spark, sf):
    """A label is a paper: its three nearest vectors for each query."""
    v, q = _vectors(spark, sf)
    d = R.topk_per_paper(v.select(F.col("label").cast("long").alias("paper_id"), F.col("vec_id").alias("chunk_id"), "embedding"), q.select(F.col("vec_id").alias("question_id"), "embedding"), places=4, undefined=True)
    return d.withColumn("rk", F.col("rk").cast("long"))


def q_embedding_completeness(spark, sf):
    d = _t(spark, sf, "documents").select("source", F.col("doc_id").alias("chunk_id"))
    return R.incomplete(d, d.join(_t(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id")), "chunk_id"), "source")


def q_paper_key_join(spark, sf):
    """A file of answers per source, and a sheet that writes the sources in other ways."""
    g = _t(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).cast("string").alias("cell"))
    files = g.select(F.concat("source", F.lit("_answers.json")).alias("file"), F.explode(F.array(F.lit("size"), F.lit("other"))).alias("question"))
    cells = g.select(F.concat(F.upper("source"), F.lit(" -.pdf")).alias("paper"), F.lit("size").alias("question"), "cell")
    return E.matched(files, cells)


def q_model_pair_join(spark, sf):
    d = _t(spark, sf, "documents")
    every = F.array(*map(F.lit, ["en", "de", "F R", "es"]))
    a = d.select(F.col("source").alias("file"), F.col("doc_id").cast("string").alias("question"), F.lit(0).alias("pos"), F.array("lang", F.lit("X y"), F.lit(" ")).alias("answer_ids"), F.lit(None).cast("string").alias("answer_text"), F.when(F.col("doc_id") % 7 != 0, every).alias("choices"))
    text = F.when(F.col("pos") == 1, F.upper("lang")).otherwise("first")
    b = d.where("doc_id % 5 <> 0").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"))
    b = b.select(F.col("source").alias("file"), F.col("doc_id").cast("string").alias("question"), "pos", F.lit(None).cast("array<string>").alias("answer_ids"), text.alias("answer_text"), F.when(F.col("doc_id") % 2 == 0, every).otherwise(F.array("lang", F.lit("Other one"))).alias("choices"))
    m = E.model_pairs(a, b)
    return m.select("file", "question", *[F.array_join(c, "|").alias(c) for c in ("model1", "model2", "choices")])


def q_cache_listing(spark, sf):
    d = _t(spark, sf, "documents")
    papers = d.select(F.col("source").alias("paper_id"), F.concat("source", F.lit(".pdf")).alias("filename"), F.col("lang").alias("parser"), F.col("n_chars").alias("n_pages"))
    chunks = d.where("doc_id % 3 = 0").select(F.col("source").alias("paper_id"), F.concat_ws("-", "lang", F.col("doc_id") % 2).alias("index_key"))
    l = A.listing(papers, chunks)
    return l.withColumn("indexes", F.col("indexes").cast("long"))


QUERIES = {"choices_normalize": q_choices_normalize, "choices_resolve": q_choices_resolve, "choices_parse_list": q_choices_parse_list, "choices_extract_prose": q_choices_extract_prose, "answer_finalize": q_answer_finalize, "dehyphenate": q_dehyphenate, "table_split": q_table_split, "sentence_repair": q_sentence_repair, "greedy_pack": _packed(0), "greedy_pack_overlap": _packed(50), "boilerplate_examples": q_boilerplate_examples, "topk_gather": q_topk_gather, "topk_per_paper": q_topk_per_paper, "embedding_completeness": q_embedding_completeness, "paper_key_join": q_paper_key_join, "model_pair_join": q_model_pair_join, "cache_listing": q_cache_listing}


def _q(v):
    if v is None:
        return "null"
    return f"[{', '.join(map(_q, v))}]::varchar[]" if isinstance(v, list) else "'" + v.replace("'", "''") + "'"


def _values(values):
    return "v(i, x) as (values " + ", ".join(f"({i}, {_q(v)})" for i, v in enumerate(values)) + ")"


def _fold(x):
    return f"replace(lower({x}), 'ß', 'ss')"


def _pick(ids, condition):
    return f"list_filter({ids}, lambda x: {condition})"


def _only(items):
    return f"case when len({items}) = 1 then ({items})[1] end"


def _resolve(r, ids):
    by_base = _pick(ids, f"{_fold(chr(115) + 'plit_part(x, chr(58), 1)')} = {_fold(r)}")
    prefix = _pick(ids, f"starts_with({_fold('x')}, {_fold(r)})")
    equal = f"({_pick(ids, f'x = {r}')})[1], ({_pick(ids, _fold('x') + ' = ' + _fold(r))})[1]"
    return f"case when {r} <> '' then coalesce({equal}, case when not contains({r}, ':') then {_only(by_base)} end, {_only(prefix)}, case when regexp_matches({r}, '^[A-Za-z]$') then {ids}[ascii(upper({r})) - 64] end) end"


def _extract(r, ids):
    held = lambda x: f"case when list_contains({ids}, {x}) then {x} end"
    json = lambda j: f"case when json_valid({j}) and {j}[1] = '{{' then json_extract_string({j}, '$.id') when json_valid({j}) and {j}[1] = '\"' then json_extract_string({j}, '$') end"
    word = "'[A-Za-z0-9_]'"
    here = f"substr({r}, p, length(x)) = x and (p = 1 or not regexp_matches(substr({r}, p - 1, 1), {word})) and not regexp_matches(substr({r}, p + length(x), 1), {word})"
    said = f"(flatten(list_transform(range(1, length({r}) + 1), lambda p: list_sort(list_transform({_pick(ids, here)}, lambda y: {{'n': -length(y), 'y': y}})))))[1].y"
    fenced = f"regexp_extract({r}, '(?s)```json\\s*(\\{{.*?\\}}|\".*?\")\\s*```', 1)"
    return f"case when {r} <> '' then coalesce({held(json(fenced))}, {held(json(r))}, {held(r)}, {said}) end"


_IDS = _q(CHOICES)
_D = f"d as (select *, regexp_replace(x, '^\\s+|\\s+$', '', 'g') as r, {_IDS} as ids from v), e as (select *, list_transform(ids, lambda x: trim(split_part(x, ':', 1))) as bases from d), f as (select *, list_filter(bases, lambda b: b <> '' and len(list_filter(bases, lambda c: c = b)) = 1) as alone from e)"
_ONE = f"g as (select *, coalesce({_extract('r', 'ids')}, ids[list_position(bases, {_extract('r', 'alone')})]) as one from f)"
_LIST = r"""h as (select *, case when json_valid(j) then json_extract_string(j, '$[*]') end as items from (select *, regexp_replace(replace(regexp_extract(x, '\[[^\]]*\]'), '''', '"'), ',\s*\]$', ']') as j from {}))"""
_ENDS = "(?:^|[^A-Za-z])(?i:" + "|".join(K.ABBREVIATIONS) + r"|[a-z])\.$"


def _sentences(keys):
    """CTEs from par(keys, text) to sen(keys, sent, sentence)."""
    return rf"""
parts as (select {keys}, generate_subscripts(p, 1) as i, unnest(p) as part from (select {keys}, string_split(regexp_replace(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^ | $', '', 'g'), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) as p from par)),
rep as (select *, lag(part) over (partition by {keys} order by i) as before from parts where part <> ''),
nw as (select *, sum(case when before is null or not (regexp_matches(before, '{_ENDS}') or regexp_matches(part, '^\p{{Ll}}')) then 1 else 0 end) over (partition by {keys} order by i) as sent from rep),
sen as (select {keys}, sent, string_agg(part, ' ' order by i) as sentence from nw group by all)"""


def _pack(overlap, budget=300):
    return rf"""with recursive
l as (select doc_id, generate_subscripts(s, 1) as pos, regexp_replace(unnest(s), '^\s+|\s+$', '', 'g') as s from (select doc_id, string_split(text, chr(10)) as s from documents)),
b as (select *, sum((s = '')::int) over (partition by doc_id order by pos) as block from l),
par as (select doc_id, block, string_agg(s, ' ' order by pos) as text from b where s <> '' group by all), {_sentences('doc_id, block')},
cut as (select *, unnest(range(0, (len(w) + {budget} - 1) // {budget})) as piece from (select *, string_split(sentence, ' ') as w from sen)),
un as (select doc_id, row_number() over (partition by doc_id order by block, sent, piece) - 1 as i, w[piece * {budget} + 1:piece * {budget} + {budget}] as w from cut),
u as (select doc_id, i, len(w) as n, array_to_string(w, ' ') as unit, (sum(len(w)) over (partition by doc_id order by i))::bigint as cum from un),
o as materialized (select *, i - count(*) over (partition by doc_id order by cum range between {overlap} preceding and current row) + 2 - (cum <= {overlap})::int as back from u),
r as (select doc_id, i, i as st, 0::bigint as k from o where i = 0
  union all
  select c.doc_id, c.i, case when c.cum - s.cum + s.n <= {budget} then r.st when a.i < c.i and c.cum - a.cum + a.n <= {budget} then a.i else c.i end, r.k + (c.cum - s.cum + s.n > {budget})::int
  from r join o c on c.doc_id = r.doc_id and c.i = r.i + 1 join o s on s.doc_id = r.doc_id and s.i = r.st join o p on p.doc_id = r.doc_id and p.i = r.i left join o a on a.doc_id = r.doc_id and a.i = greatest(r.st, p.back)),
ch as (select doc_id, k, min(st) as st, max(i) as en from r group by all)
select ch.doc_id, k as chunk_id, sum(n)::bigint as n_tokens, sha256(string_agg(unit, ' ' order by o.i)) as digest from ch join o on o.doc_id = ch.doc_id and o.i between st and en group by 1, 2"""


_PAPER_KEY = r"left(regexp_replace(lower(regexp_replace({0}, '(?i)(?:_answers)?\.(?:json|pdf)$', '')), '[^\p{{L}}\p{{N}}]', '', 'g'), 35)"
_SCORE = "round(list_cosine_similarity(v.embedding::double[], q.embedding::double[]), 4)"
_NORM = "list_filter(list_transform({0}, lambda x: replace(lower(x), ' ', '')), lambda x: x <> '')"
SQL = {
    "choices_normalize": f"with {_values(LABELLED)} select i::bigint as i, " + ", ".join(f"case when len(x) > 0 then array_to_string(list_transform(x, lambda y: case when x[1][1] = '{{' then {c} else y end), '|') else '' end as {n}" for c, n in (("json_extract_string(y, '$.id')", "ids"), ("coalesce(json_extract_string(y, '$.label'), json_extract_string(y, '$.id'))", "labels"))) + " from v",
    "choices_resolve": f"with {_values(CANDIDATES)}, {_D} select i::bigint as i, coalesce({_resolve('r', 'ids')}, '') as answer from d",
    "choices_parse_list": f"with {_values(LISTS)}, {_LIST.format('v')} select i::bigint as i, coalesce(array_to_string(items, '|'), '(none)') as items from h",
    "choices_extract_prose": f"with {_values(PROSE)}, {_D}, {_ONE} select i::bigint as i, coalesce(one, '') as answer from g",
    "answer_finalize": f"with {_values(REPLIES)}, {_D}, {_ONE}, {_LIST.format('g')}, k as (select *, case when regexp_replace(lower(r), '[.]+$', '') = 'unknown from this paper' then [] when items is not null then list_distinct(list_filter(list_transform(items, lambda t: {_resolve('trim(t)', 'ids')}), lambda z: z is not null)) when one is not null then [one] else [] end as got from h) select i::bigint as i, closed, case when x is null then 'error' when not closed then 'open' when len(got) > 0 then 'choices' else 'abstain' end as kind, case when closed and x is not null then coalesce(array_to_string(list_sort(got), '; '), '') else '' end as answer from k, (values (true), (false)) c(closed)",
    "dehyphenate": rf"with {_values(PAPERS)} select i::bigint as i, regexp_replace(regexp_replace(x, '([a-z])-\n([a-z])', '\1\2', 'g'), '([a-z])-\n([a-z])', '\1\2', 'g') as text from v",
    "table_split": "with p as (select i::bigint as paper_id, unnest(range(1, 7 * i + 1)) as n from range(1, 9) r(i)), t as (select paper_id, (n - 1) // 5 as piece, '| name x y |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| r' || n || ' a b |', chr(10) order by n) as text, 6 + 5 * count(*) as n_tokens from p group by 1, 2) select paper_id, piece + 1 as chunk_id, true as is_table, n_tokens, text from t union all select distinct paper_id, 0, false, 4, 'Before it. After it.' from p",
    "sentence_repair": rf"with par as (select doc_id, generate_subscripts(p, 1) - 1 as par, unnest(p) as text from (select doc_id, regexp_split_to_array(text, '\n\s*\n') as p from documents)), {_sentences('doc_id, par')} select doc_id, par, (sent - 1)::bigint as sent, sha256(sentence) as digest from sen",
    "greedy_pack": _pack(0),
    "greedy_pack_overlap": _pack(50),
    "boilerplate_examples": "with l as (select source, doc_id, generate_subscripts(s, 1) as pos, trim(unnest(s)) as line from (select source, doc_id, string_split(text, chr(10)) as s from documents)), k as (select *, regexp_replace(replace(lower(line), 'ß', 'ss'), '[^a-z]+', '', 'g') as key from l where length(line) between 1 and 200), n as (select source, count(distinct doc_id) as n from documents group by 1), e as (select source, key, line from k qualify row_number() over (partition by source, key order by doc_id, pos) = 1) select source as paper_id, key, pages, line as example from (select source, key, count(distinct doc_id) as pages from k where key <> '' group by 1, 2) join n using (source) join e using (source, key) where n >= 3 and pages >= greatest(2, floor(0.04 * n)::int)",
    "topk_gather": f"select query_id, string_agg(vec_id, ',' order by rk) as chunks from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rk from (select q.vec_id as query_id, v.vec_id, {_SCORE} as score from embeddings v join embeddings q on q.vec_id % 20 = 0 and v.vec_id <> q.vec_id)) where rk <= 3 group by 1",
    "topk_per_paper": f"select * from (select *, row_number() over (partition by paper_id, question_id order by score desc, chunk_id) as rk from (select v.label::bigint as paper_id, q.vec_id as question_id, v.vec_id as chunk_id, {_SCORE} as score from embeddings v join embeddings q on q.vec_id % 20 = 0)) where rk <= 3",
    "embedding_completeness": "select source, count(*) as chunks, count(vec_id) as vectors, count(*) = count(vec_id) as complete from documents left join embeddings on vec_id = doc_id group by 1",
    "paper_key_join": f"with g as (select source, count(*)::varchar as cell from documents group by 1), f as (select source || '_answers.json' as file, question from g, (values ('size'), ('other')) q(question)), p as (select upper(source) || ' -.pdf' as paper, cell from g) select file, question, paper, case when question = 'size' then cell else '' end as cell from f join p on {_PAPER_KEY.format('file')} = {_PAPER_KEY.format('paper')}",
    "model_pair_join": f"select source as file, doc_id::varchar as question, array_to_string({_NORM.format(chr(91) + 'lang, chr(88) || chr(32) || chr(121)]')}, '|') as model1, lower(lang) as model2, case when doc_id % 2 = 0 then 'en|de|fr|es' else array_to_string(list_sort(list_distinct(['en', 'de', 'fr', 'es', 'otherone', lang])), '|') end as choices from documents where doc_id % 5 <> 0 and doc_id % 7 <> 0",
    "cache_listing": "select source as paper_id, string_agg(distinct lang, ', ' order by lang) as parsers, max(n_chars) as n_pages, count(distinct case when doc_id % 3 = 0 then lang || '-' || doc_id % 2 end) as indexes, source || '.pdf' as filename from documents group by source",
}
