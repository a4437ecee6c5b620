"""One query for each operator, with the SQL that it is checked against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import bpe, chat, crf, hardneg, kneser, licenses, mixing, multiset, neardup, secrets, trie, vafile, warc
from linkloom.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.languages(table(spark, sf_dir, "documents"))


#: Conversation -7: both turns say a control string of the template.
CONTROL = "\\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    return chat.digests(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more), VOCABULARY)


OP3 = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select * from (values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v(conv_id, turn, role, text)),
t as (select *, role = 'assistant' as learned, length('<turn>### ' || role || text || '</turn>') + 3
  + length(regexp_replace(role, '[^\\<#:]', '', 'g')) + length(regexp_replace(text, '[^\\<#]', '', 'g')) as n from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (learned), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (learned), '')) as loss_sha256,
  sum(n)::bigint as formatted_chars
from t group by conv_id
"""


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


#: The base rules, said again.
BASE_RULES = (
    secrets.Rule("assign", r"""(?i:password|passwd|secret|token|api_key|apikey)["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    secrets.Rule("access", "AKIA[A-Z0-9]{16,}"),
    secrets.Rule("hex", "[a-f0-9]{24,}"),
)


def _spans_sql(no: int, rule: secrets.Rule) -> str:
    p = rule.pattern.replace("'", "''")
    return f"""
  select r, {no} as no, '{rule.kind}' as kind, g, a, a + n as b from (
    select r, unnest(range(1, len(m) + 1)) as i, list_sum(list_transform(gaps[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda s: length(s))), 0) as a, length(m[i]) as n, length(v[i]) as g
    from (select r, string_split_regex(text, '{p}') as gaps, regexp_extract_all(text, '{p}') as m, regexp_extract_all(text, '{p}', {rule.group}) as v from d where regexp_matches(text, '{p}')))
  where g >= {rule.least}"""


def op6_sql() -> str:
    base = len(BASE_RULES)
    rules = BASE_RULES + secrets.RULES[base:]
    counts = ", ".join(f"count(*) filter (no = {k}) as n_{r.kind}" for k, r in enumerate(BASE_RULES))
    own = ", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE_RULES)
    joined = lambda which: f"string_agg(kind || ':' || a::bigint || ':' || b::bigint, ',' order by a, no) {which}"
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
s as ({" union all ".join(_spans_sql(k, r) for k, r in enumerate(rules))}),
f as (select r, {counts}, {joined(f"filter (no < {base})")} as base, {joined("")} as spans from s group by r)
select doc_id, {own}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join f using (r)
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=("doc_id", "lang"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.edits(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=5, percent=85)


OP9 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as materialized (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
  else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from w),
n as materialized (select doc_id, len(s) as n from s),
x as materialized (select doc_id, hash(unnest(s)) as g from s),
p as materialized (select a.doc_id as a, b.doc_id as b, count(*) as c from x a join x b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
h as materialized (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 85 * (na.n + nb.n - c)),
e as materialized (select a, b from h union all select b, a from h),
r(doc_id, other) as (select doc_id, doc_id from n union select r.doc_id, e.b from r join e on e.a = r.other)
select n.doc_id, n.n::bigint as n_shingles, c as component_id, n.doc_id = c as kept
from n join (select doc_id, min(other) as c from r group by 1) using (doc_id)
"""


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


OP10 = """
with data as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, d.vec_id, list_inner_product(q.v, d.v)::bigint as score
  from (select * from data where vec_id % 50 = 0) q join data d on d.vec_id <> q.vec_id and len(d.v) = len(q.v)),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 5
"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hardneg.hard_negatives(rows)


OP11 = """
with data as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as materialized (
  select a.vec_id as anchor_id, d.vec_id, d.label = a.label as same, list_inner_product(a.v, d.v)::bigint as score
  from (select * from data where vec_id % 100 = 0) a join data d on d.vec_id <> a.vec_id and len(d.v) = len(a.v)),
positives as (select anchor_id, vec_id as positive_id, score as positive_score from pairs where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::integer as rank, vec_id as negative_id, positive_score, score as negative_score
from positives join pairs using (anchor_id) where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5
"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


#: CRC-32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_transform(string_split({0}::varchar, ''), lambda c: ascii(c)::bigint),
  lambda a, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295::bigint))"""

OP12 = f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
o as (select conv_id, list(struct_pack(role := role, text := text) order by turn nulls first, sha256(strlen(role) || ':' || role || text)) as w from t group by conv_id),
h as (select conv_id, w, {_CRC.format("conv_id")} % 6 as h, conv_id - conv_id % 100 as base from o),
r as (select h.conv_id, list_concat(case when b.w is null then [] else b.w[1:h.h] end, h.w[h.h + 1:]) as w from h left join o b on b.conv_id = h.base),
p as (select conv_id, d, w[1:d] as p, d = len(w) as ended from (select *, unnest(range(0, len(w) + 1)) as d from r)),
n as materialized (select p, d as depth, min(conv_id) as conv_id, count(*) as n_convs, coalesce(length(p[d].text), 0) as chars, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256 from p group by p, d),
c as (select p[1:depth - 1] as p, depth - 1 as depth, count(*) as n_children from n where depth > 0 group by all),
k as materialized (select n.*, coalesce(n_children, 0) as n_children from n left join c using (p, depth)),
u as (select p[1:d] as p, d as depth, sum((n_children = 0)::int)::bigint as n_leaves, sum((n_convs - 1) * chars)::bigint as saved_tokens from (select *, unnest(range(0, depth + 1)) as d from k) group by all)
select k.conv_id, k.depth, a.conv_id as parent_conv_id, k.n_convs, k.n_children, u.n_leaves, u.saved_tokens, k.ends_sha256
from k join u using (p, depth) left join n a on k.depth > 0 and a.depth = k.depth - 1 and a.p = k.p[1:k.depth - 1]
"""


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digests(table(spark, sf_dir, "pages"))


OP13 = r"""
with p as (
  select page_id, encode(coalesce(html, '')) as body, regexp_replace(lower(coalesce(url, '')), '#.*$', '', 's') as u,
    strftime(make_timestamp((946684800 + ((coalesce(page_id, 0) % 1000000000) + 1000000000) % 1000000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as captured_at from pages),
k as (
  select page_id, octet_length(body) as payload_bytes, sha1(body) as payload_digest, captured_at, max(page_id) over (partition by body) as last,
    array_to_string(list_reverse(string_split(regexp_extract(u, '^[^:/?#]*://([^/?#]*)', 1), '.')), ',') || ')' || regexp_replace(u, '^[^:/?#]*://[^/?#]*', '') as url_key from p),
r as (select *, payload_bytes >= 1000 and last is not null and page_id is distinct from last as again from k)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type, case when again then last end as refers_to,
  row_number() over (order by url_key, captured_at, page_id nulls first, payload_digest) as position,
  row_number() over (partition by url_key order by captured_at, page_id nulls first, payload_digest) as nth, url_key, captured_at
from r
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_languages, op3_chat, op4_mixing, op5_licences, op6_secrets, op7_quality, op8_fingerprints, op9_near_duplicates, op10_top_k, op11_hard_negatives, op12_prefix_trie, op13_warc)}


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": OP3, "op6_secrets": op6_sql(), "op9_near_duplicates": OP9, "op10_top_k": OP10, "op11_hard_negatives": OP11, "op12_prefix_trie": OP12, "op13_warc": OP13}
