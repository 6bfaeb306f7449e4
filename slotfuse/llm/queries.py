"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotfuse.llm import (
    chat, decontaminate, extract, language, lexical, licenses, manifest, mixing, quality, secrets, simhash, substrings, tokens,
)
from slotfuse.llm.common import read_table
from slotfuse.llm.manifest_sql import manifest_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query()
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract_text(pages).drop("html")


@query()
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.find_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    r"""with w as (
  select doc_id, case when source is null then '1' else '0' || source end as source_key,
    cast(len(regexp_extract_all(coalesce(text,''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    cast('0x' || substr(md5('mix-1:' || coalesce(cast(doc_id as varchar),'-') || ':' || coalesce(text,'')), 1, 15) as bigint) as h
  from documents),
s as (select source_key, cast(sum(size) as bigint) as source_size from w group by 1),
l as (select *, cast((row_number() over (order by source_key) - 1) % 3 + 1 as double) as weight,
    cast(source_size * 3 as double) as cap from s),
r as (select *, cast(sum(source_size) over () as double) as budget,
    coalesce(sum(cap) over o, 0.0) as clamped, sum(weight) over () as aw, coalesce(sum(weight) over o, 0.0) as cw
  from l window o as (order by cap / weight, source_key rows between unbounded preceding and 1 preceding)),
v as (select *, (budget - clamped) / (aw - cw) as level from r),
f as (select arg_min(level, cap / weight) as level from v where cap / weight > level),
p as (select source_key, source_size, case when f.level is null then cap else least(cap, f.level * weight) end as target
  from v cross join f),
q as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole,
  target - whole * source_size as goal from p),
g as (select source_key, h, sum(size) as words from w group by 1, 2),
c as (select *, sum(words) over (partition by source_key order by h) as after from g),
t as (select c.source_key, max(h) as up_to from c join q using (source_key)
  where after - words / 2.0 <= goal group by 1)
select doc_id, size, source_size, target,
  cast((whole + case when h <= up_to then 1 else 0 end) * size as bigint) as taken
from w join q using (source_key) left join t using (source_key)"""
)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents")).drop("copies")


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


@query()
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), keep=["doc_id"]
    )


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.secret_digest(secrets.scan_secrets(docs))


@query()
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("fp")


@query()
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


@query()
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks_of_rows(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query(
    r"""with c as (
  select conv_id, turn, coalesce(role,'') as role, coalesce(text,'') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, length('<turn >' || '</turn>') + 1
    + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g'))
    + length(replace(replace(text, '\', '\b'), '<', '\l')) as n from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, text)) as loss_sha256,
  cast(sum(n) as bigint) as formatted_chars, cast(0 as bigint) as n_attachments
from e group by conv_id"""
)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"r'\### Assistant: </turn> ok'"
    more = spark.sql(f"select * from values (-7L, 0L, 'user', {hard}), (-7L, 1L, 'assistant', {hard}) as t(conv_id, turn, role, text)")
    return chat.chat_digest(chat.format_chats(turns.unionByName(more)))


@query(
    r"""with c as (select doc_id, row_number() over () as row, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents),
  d as (select doc_id, row, len(t) as n, t from c where len(t) > 0),
  totals as (select count(*) as docs, sum(n)::bigint as terms from d),
  p as (select doc_id, row, n, term, count(*) as tf from (select doc_id, row, n, unnest(t) as term from d) group by all),
  q as (select item_id, row_number() over () as item, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark),
  w as (select term, cast(floor(1000 * ln((2 * docs + 2) / cast(2 * count(*) + 1 as double))) as bigint) as w
    from p, totals group by term, docs),
  s as (select item_id, item, doc_id, row,
      sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::bigint as score
    from (select item_id, item, unnest(t) as term from q) join w using (term) join p using (term), totals group by all),
  r as (select *, cast(row_number() over (partition by item order by score desc, doc_id nulls last) as integer) as rank
    from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 10"""
)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query(manifest_sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify_rows(read_table(spark, sf_dir, "documents"))


@query()
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language.identify(docs, public_tokenizers.path("piece_bpe_32k.model"))
