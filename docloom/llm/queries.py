"""The registered queries of this subpackage."""
from docloom.llm.decontaminate import find_items
from docloom.llm.langid import identify
from docloom.llm.media import media_digest
from docloom.llm.mixing import mix
from docloom.llm.near_dup import near_duplicates
from docloom.llm.pii import find_personal_data
from docloom.llm.secrets import scan_secrets
from docloom.llm.substring_dedup import remove_repeats
from docloom.llm.token_counts import count_tokens
from docloom.llm.warc import round_trip


def _docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def op3(spark, sf):
    return media_digest(_docs(spark, sf))


def op5(spark, sf):
    import public_tokenizers

    return count_tokens(_docs(spark, sf), public_tokenizers.path("word_bpe_49k.json"))


def op10(spark, sf):
    return scan_secrets(_docs(spark, sf))


def op1(spark, sf):
    return remove_repeats(_docs(spark, sf))


def op2(spark, sf):
    return mix(_docs(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


def op8(spark, sf):
    return round_trip(spark.read.parquet(f"{sf}/pages.parquet"))


def op9(spark, sf):
    return identify(_docs(spark, sf))


def op4(spark, sf):
    return near_duplicates(_docs(spark, sf))


def op6(spark, sf):
    return find_items(_docs(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op7(spark, sf):
    return find_personal_data(_docs(spark, sf))


QUERIES = {"op7_pii": op7, "op4_near_dup": op4, "op6_decontamination": op6, "op9_language_id": op9, "op8_warc": op8, "op2_mixing": op2, "op1_substring_dedup": op1, "op3_media": op3, "op5_token_counts": op5, "op10_secret_scans": op10}
# Words are runs of anything but the six ASCII blanks.
WORDS = r"coalesce(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'), [])"
# Kinds of spans with their ranks, RE2 patterns and what a match must be; matches are set between two private signs, so that lengths give places.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))"""
KINDS = [("assign", ASSIGN, f"length(regexp_extract(hit, '{ASSIGN}', 2)) >= 6"), ("access", "AKIA[A-Z0-9]+", "length(hit) >= 20"), ("hex", "[0-9a-f]+", "length(hit) >= 24"), ("key", "[A-Za-z0-9+/]+", "length(hit) = 40"), ("endpoint", "https?://[A-Za-z0-9.-]+", "true")]


def _spans(rank, kind, pattern, condition):
    return f"""
{kind}_x as (select doc_id, generate_subscripts(p, 1) as j, unnest(p) as x from (select doc_id, string_split(regexp_replace(text, '{pattern}', chr(57344) || '\\0' || chr(57345), 'g'), chr(57344)) as p from d)),
{kind}_y as (select doc_id, j, split_part(x, chr(57345), 1) as hit, length(split_part(x, chr(57345), 2)) as rest, sum(length(x) - (j > 1)::int) over (partition by doc_id order by j) as upto from {kind}_x),
{kind} as (select doc_id, {rank} as rank, '{kind}' as kind, upto - rest - length(hit) as a, upto - rest as b from {kind}_y where j > 1 and {condition})"""


SQL = {
    "op10_secret_scans": f"""
with d as (select doc_id, coalesce(text, '') as text from documents), {','.join(_spans(i, *k) for i, k in enumerate(KINDS))},
sp as ({' union all '.join(f'from {k[0]}' for k in KINDS)}),
near as (select w.doc_id, w.rank, w.kind, w.a, w.b, p.kind as part, p.rank as prank, p.a as pa, p.b as pb, (p.a, p.rank) < (w.a, w.rank) as before
  from sp w join sp p on p.doc_id = w.doc_id and (w.rank = 3 and p.rank = 1 or w.rank = 4 and p.rank < 2)),
best as (select * from near qualify row_number() over (partition by doc_id, rank, a, before order by case when before then -pb else pa end, case when before then -pa else prank end, -prank) = 1),
linked as (select * from best where case when before then pb + 400 >= a else pa <= b + 400 end qualify row_number() over (partition by doc_id, rank, a order by before desc) = 1),
every as (select doc_id, rank, kind, a, b from sp where rank < 3 union all select doc_id, rank, kind, a, b from linked),
g as (select doc_id, {', '.join(f"count(*) filter (rank = {i}) as n_{k[0]}" for i, k in enumerate(KINDS[:3]))}, string_agg(kind || ':' || a || ':' || b, ',' order by a, rank, b) filter (rank < 3) as base, string_agg(kind || ':' || a || ':' || b, ',' order by a, rank, b) as spans from every group by 1),
l as (select doc_id, string_agg(kind || ':' || a || ':' || b || '>' || part || ':' || pa || ':' || pb, ',' order by rank, a) as links from linked group by 1)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(links, '') as links
from d left join g using (doc_id) left join l using (doc_id)""",
    "op1_substring_dedup": f"""
with w as (select doc_id, {WORDS.format('text')} as ws from documents),
p as (select doc_id, generate_subscripts(g, 1) as s, unnest(g) as g from (select doc_id, list_transform(range(1, len(ws) - 18), lambda i: md5(array_to_string(ws[i:i + 19], ' '))) as g from w where len(ws) >= 20)),
g as (select doc_id, s, row_number() over (partition by g order by doc_id, s) as nth from p),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as i from g where nth > 1),
every as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i from w),
kept as (select e.doc_id, count(*) as n, string_agg(e.word, ' ' order by e.i) as words from every e anti join gone x on e.doc_id = x.doc_id and e.i = x.i group by 1)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(words, '')) as kept_sha256 from w left join kept using (doc_id)""",
    "op2_mixing": f"""
with d as (select doc_id, source, len({WORDS.format('text')})::bigint as size, left(md5(concat_ws(':', doc_id, text)), 13) as tie from documents),
q as (select doc_id as labelled, max(quality) as quality from labels where doc_id is not null group by 1),
s as (select source, sum(size)::bigint as source_size, 2 * sum(size)::double as cap, ([3, 1, 2]::double[])[(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from d group by 1),
r as (select *, 1.5 * sum(source_size) over ()::double as total, sum(cap) over o as caps, sum(w) over () - sum(w) over o + w as open_w from s window o as (order by cap / w, source nulls last rows unbounded preceding)),
f as (select *, total - caps + cap >= cap / w * open_w as reached from r),
l as (select *, (total - coalesce(sum(cap) filter (reached) over (), 0)) / nullif(sum(w) filter (not reached) over (), 0) as level from f),
t as (select source as s1, source_size, case when reached then cap else w * level end as target from l),
k as (select *, -ln((('0x' || tie)::bigint + 1) / 4503599627370497::double) / case quality when 1 then 1.5 when 0 then 0.5 else 1 end as key, coalesce(floor(target / nullif(source_size, 0)), 0) as epochs
  from d join t on source is not distinct from s1 left join q on doc_id = labelled),
b as (select *, coalesce(sum(size) over (partition by source order by key, doc_id nulls first, tie rows between unbounded preceding and 1 preceding), 0)::double as before from k)
select doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, floor(target - epochs * source_size) - before)))::bigint as taken from b""",
    "op3_media": """
with crc as (select list(list_reduce(list_prepend(n, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as crc from range(256) r(n)),
d as (select doc_id, encode(coalesce(text, '')) as raw from documents),
s as (select *, octet_length(raw)::bigint as n_bytes, greatest(64, (octet_length(raw) + 63) // 64 * 64)::bigint as n from d),
p as (select *, hex(raw) || repeat('00', (n - n_bytes)::int) as h from s),
t as (select *, list_transform(range(64), lambda i: ('0x' || right(h, 128)[2 * i + 1:2 * i + 2])::bigint) as tail from p),
m as (select *, list_transform([n + 36, n], lambda v: printf('%02X%02X%02X%02X', v & 255, (v >> 8) & 255, (v >> 16) & 255, (v >> 24) & 255)) as size from t)
select doc_id, n_bytes, n as payload_bytes, sha256(unhex(h)) as payload_sha256,
  xor(list_reduce(list_prepend(4294967295, tail), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)::bigint as tail_crc32,
  n + 44 as media_bytes, sha256(unhex('52494646' || size[1] || '57415645666D7420100000000100010040' || '1F0000401F00000100080064617461' || size[2] || h)) as media_sha256,
  'audio/wav;rate=8000;samples=' || n || ';embedded=0' as feature
from m, crc""",
    "op4_near_dup": f"""
with recursive w as (select doc_id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws from documents),
sh as (select distinct doc_id, unnest(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' '))) as s from w where len(ws) > 0),
n as (select doc_id, count(*) as n from sh group by 1),
pair as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
link as (select a, b from pair join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
way as (select a, b from link union all select b, a from link),
reach as (select doc_id as a, doc_id as b from n union select r.a, way.b from reach r join way on way.a = r.b)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(m, d.doc_id) as component_id, coalesce(m, d.doc_id) = d.doc_id as kept
from documents d left join n using (doc_id) left join (select a, min(b) as m from reach group by 1) r on r.a = d.doc_id""",
    "op8_warc": """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
f as (select *, min(page_id) over (partition by body) as first from p)
select page_id, octet_length(body)::bigint as payload_bytes, sha256(body) as payload_digest,
  case when octet_length(body) >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when octet_length(body) >= 100 and page_id <> first then first end as refers_to from f""",
}
