"""Queries over the given tables, one for each operator, and the SQL that some can be checked with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from txmill.llm import (
    decontaminate,
    exact_dedup,
    fim,
    importance,
    licenses,
    near_dedup,
    packing,
    pattern_packing,
    quality,
    secrets,
    token_files,
    url_filter,
    warc,
)
from txmill.llm.common import table
from txmill.llm.url_filter import Rule
from txmill.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the URL query.
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]
TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    known = url_filter.labelled(url_filter.parsed(pages, "page_id", "url", RULES))
    return url_filter.judge(pages, RULES, url_filter.train(known))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.resolved(warc.read(spark, path))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenizer = import_module("public_tokenizers").path(TOKENIZER)
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer)
    return token_files.read(spark, path)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.transform(table(spark, sf_dir, "documents")).drop("output")


def op13_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = import_module("public_tokenizers").path(WORD_TOKENIZER)
    return pattern_packing.pack(table(spark, sf_dir, "documents"), tokenizer)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_quality_classifier,
        op2_license_scan,
        op3_benchmark_decontamination,
        op4_packing,
        op5_url_filter,
        op6_exact_dedup,
        op7_warc_revisits,
        op8_token_files,
        op9_simhash_near_dedup,
        op10_secret_scan,
        op11_importance_resampling,
        op12_fim,
        op13_pattern_packing,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLE = {
    "op6_exact_dedup": r"""
with d as (
  select doc_id,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as content
  from documents
)
select doc_id,
       min(doc_id) over (partition by content) as keep_id,
       count(*) over (partition by content) as group_size,
       coalesce(row_number() over (partition by content order by doc_id) = 1, false) as kept,
       sha256(content) as text_sha256
from d
""",
    "op7_warc_revisits": r"""
with p as (
  select page_id, encode(coalesce(html, '')) as payload, coalesce(html, '') as html from pages
), g as (
  select page_id, octet_length(payload) as payload_bytes, sha1(html) as h,
         min(page_id) over (partition by html) as first
  from p
)
select page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int, 1)),
         'string_agg', '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from g
""",
    "op11_importance_resampling": r"""
with crc_table as (
  select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), texts as (
  select doc_id, 'source' as side, coalesce(text, '') as text from documents
  union all
  select null, 'target', coalesce(text, '') from benchmark
), numbered as (
  select row_number() over () as row, doc_id, side,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from texts
), found as (
  select row, side, unnest(list_concat(words, list_transform(range(1, len(words)),
           lambda i: words[i] || ' ' || words[i + 1]))) as feature
  from numbered
), tally as (
  select row, side, feature, count(*) as n from found group by all
), hashed as (
  select feature, xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode(feature))),
           lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::bigint)),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket
  from (select distinct feature from tally), crc_table
), counts as (
  select bucket, sum(n) filter (side = 'source') as s, sum(n) filter (side = 'target') as t
  from tally join hashed using (feature) group by bucket
), totals as (
  select coalesce(sum(s), 0)::double as s_all, coalesce(sum(t), 0)::double as t_all from counts
), gains as (
  select bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * (s_all + 10000)
                / ((coalesce(s, 0)::double + 1) * (t_all + 10000))))::bigint as gain
  from counts, totals
), weights as (
  select row, sum(n) as n_features, floor(sum(n * gain)::double / sum(n)::double)::bigint as weight
  from tally join hashed using (feature) join gains using (bucket) where side = 'source' group by row
), scores as (
  select row, doc_id, len(words) as n_words, coalesce(n_features, 0)::bigint as n_features,
         coalesce(weight, 0) as weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint
           + 0.5::double) / 4294967296::double)))::bigint as score
  from numbered left join weights using (row) where side = 'source'
), placed as (
  select row, row_number() over (order by score desc, doc_id nulls last) as place, count(*) over () as total
  from scores where n_words >= 20
)
select doc_id, n_features, weight, score,
       case when place <= 25 * total // 100 then place end as rank
from scores left join placed using (row)
""",
    "op12_fim": r"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(doc_id::varchar, '')) as h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens
  from documents
), r as (
  select doc_id, t, tokens, len(tokens) as n, ('0x' || substr(h, 1, 8))::bigint as h1,
         ('0x' || substr(h, 9, 8))::bigint as h2, ('0x' || substr(h, 17, 8))::bigint as h3,
         ('0x' || substr(h, 25, 8))::bigint as h4
  from d
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50
              then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from r
), p as (
  select *, array_to_string(tokens[1:a], '') as prefix, array_to_string(tokens[a + 1:b], '') as middle,
         array_to_string(tokens[b + 1:n], '') as suffix
  from c
)
select doc_id, n, form,
       case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from p
""",
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
