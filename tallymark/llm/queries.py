"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.alignment import align_tokens
from tallymark.llm.chat import read_chats, write_chats
from tallymark.llm.exact_dedup import exact_dedup
from tallymark.llm.filter_audit import filter_audit
from tallymark.llm.language import identify_language
from tallymark.llm.licenses import scan_licenses
from tallymark.llm.mixing import mix_sources
from tallymark.llm.packing import pack_sequences
from tallymark.llm.pieces import decode_pieces, encode_pieces
from tallymark.llm.simhash import simhash_near_dedup
from tallymark.llm.token_files import read_token_files, write_token_files
from tallymark.llm.topk import top_k
from tallymark.llm.warc import read_archives, write_archives

#: A conversation whose texts look like the template of a chat format.
CONTROL_ID = -7
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(CONTROL_ID, 0, "user", CONTROL_TEXT), (CONTROL_ID, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    return read_chats(write_chats(turns.unionByName(control)))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(write_archives(_table(spark, sf_dir, "pages")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    found = decode_pieces(encode_pieces(_table(spark, sf_dir, "documents"), model), model)
    ids = F.concat_ws(",", F.col("piece_ids").cast("array<string>"))
    return found.select("doc_id", F.size("piece_ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = align_tokens(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), keep=lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256)))
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_exact_dedup, op2_packing, op3_language_id, op4_token_files, op5_top_k, op6_mixing, op7_chat, op8_warc, op9_simhash, op10_license_scan, op11_pieces, op12_alignment, op13_filter_audit,
    )
    return {f.__name__: f for f in found}


_OP1 = r"""
with d as (select doc_id, coalesce(text, '') as raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
k as (select norm, first(doc_id order by length(raw) desc, doc_id) as keep_id, count(*) as group_size from d group by norm)
select d.doc_id, k.keep_id, k.group_size, d.doc_id = k.keep_id as kept, sha256(d.norm) as text_sha256 from d join k using (norm)
"""

_OP5 = r"""
with v as (select vec_id, [floor(1024 * x::double)::bigint for x in embedding] as e from embeddings
  where vec_id is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x::double)]) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e::double[], c.e::double[])::bigint as score from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
r as (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""

_OP7 = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
f as (select *, length('<turn role="' || replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '"', '&quot;') || '">' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '"', '&quot;') || '</turn>' || chr(10)) as chars from t),
p as (select *, sum(chars) over (partition by conv_id order by turn, role, text rows unbounded preceding) as prefix,
  row_number() over (partition by conv_id order by turn desc, role desc, text desc) = 1 as is_last from f)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(case when role = 'assistant' or is_last then prefix else 0 end)::bigint as formatted_chars
from p group by conv_id
"""

_OP8 = r"""
with p as (select page_id, coalesce(html, '') as payload from pages),
d as (select page_id, octet_length(encode(payload))::bigint as payload_bytes, sha1(payload) as h, max(page_id) over (partition by payload) as original from p),
b as (select *, [('0x' || substr(h, 5 * k + 1, 5))::int for k in range(8)] as words from d)
select page_id, payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((words[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31)::int + 1, 1) for k in range(32)], 'string_agg', '') as payload_digest,
  case when page_id = original or original is null then 'response' else 'revisit' end as record_type,
  case when page_id = original then null else original end as refers_to
from b
"""

_OP13 = r"""
with l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as bad from labels where doc_id is not null group by doc_id),
w as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
m as (select w.part, coalesce(l.good, 0) as good, coalesce(l.bad, 0) as bad,
  [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t),
   regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > min(w.doc_id) over (partition by t), min(w.doc_id) over (partition by t) is not null)] as f
  from w left join l using (doc_id)),
k as (select part, f, count(*) as n, sum(good) as good, sum(bad) as bad from m group by part, f),
o as (select [a.x, b.x, c.x, d.x, e.x] as p from range(1, 6) a(x), range(1, 6) b(x), range(1, 6) c(x), range(1, 6) d(x), range(1, 6) e(x) where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select p, list_aggregate([substr('ABCDE', x::int, 1) for x in p], 'string_agg', '') as filter_order, step, p[step] as own, p[1:step - 1] as earlier from o, range(1, 6) r(step)),
c as (select part, filter_order, step, own,
  sum(n) filter (not f[own] and not list_bool_or([f[x] for x in earlier] || [false])) as kept,
  sum(n) filter (f[own] and not list_bool_or([f[x] for x in earlier] || [false])) as removed,
  sum(n) filter (f[own] and list_bool_or([f[x] for x in earlier] || [false])) as redundant,
  sum(n) filter (f[own] and len([x for x in f if x]) = 1) as unique_fails,
  sum(good) filter (f[own] and not list_bool_or([f[x] for x in earlier] || [false])) as good_lost,
  sum(bad) filter (f[own] and not list_bool_or([f[x] for x in earlier] || [false])) as toxic_lost
  from k, s group by part, filter_order, step, own)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
  coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  (sum(coalesce(removed, 0)) over (partition by part, own))::bigint as shapley
from c
"""


def oracle_sql() -> dict[str, str]:
    """For the others SQL gives no result: the tests hold them against brute force and exact round trips."""
    return {"op1_exact_dedup": _OP1, "op5_top_k": _OP5, "op7_chat": _OP7, "op8_warc": _OP8, "op13_filter_audit": _OP13}
