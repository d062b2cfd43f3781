"""Registered queries of the training-data operators, each over its whole table, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), seq_len=2048, vocabulary="word_bpe_49k.json", end_id=0)


@register("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.license_scan import scan

    return scan(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
with d as (select doc_id as k, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
i as (select item_id as k, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
item as (select distinct k as item_id, least(10, len(w)) as n, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') as g
  from (select k, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as s from i where len(w) > 0)),
lens as (select distinct n from item),
hit as (select doc_id, s, n, item_id from (
    select k as doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') as g
    from (select k, w, n, unnest(range(1, len(w) - n + 2)) as s from d, lens where len(w) >= n)) join item using (n, g)),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from (select distinct doc_id, s, n from hit)) group by 1),
named as (select doc_id, count(*) as n_items, string_agg(x, ',' order by x) as items from (select distinct doc_id, cast(item_id as varchar) as x from hit) group by 1)
select d.k as doc_id, coalesce(len(w), 0) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words on words.doc_id = d.k left join named on named.doc_id = d.k"""


@register("op8_decontaminate", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.decontaminate import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP10_SQL = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as d from pages),
g as (select *, min(page_id) over (partition by d) as f from p)
select page_id, n as payload_bytes, d as payload_digest, case when n >= 100 and page_id <> f then 'revisit' else 'response' end as record_type,
  case when n >= 100 and page_id <> f then f end as refers_to from g"""


@register("op10_warc", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.warc import read_warc, records, write_warc
    from textforge.session import scratch_path

    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return records(read_warc(spark, path, with_payload=False)).drop("url")


@register("op9_order_minhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.order_minhash import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents"))


@register("op7_kneser_ney")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.kneser_ney import score_held_out

    return score_held_out(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@register("op4_language_crf")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.language_crf import identify

    return identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


# A word is removed if a window of 50 words that covers it also starts in a document with a smaller doc_id.
OP2_SQL = r"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
g as (select doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) as h from (select doc_id, w, unnest(range(1, len(w) - 48)) as s from d where len(w) >= 50)),
f as (select h, min(doc_id) as owner from g group by h),
gone as (select distinct doc_id, unnest(range(s, s + 50)) as p from g join f using (h) where owner < doc_id),
lost as (select doc_id, list(p) as ps, count(*) as n from gone group by 1)
select doc_id, len(w) as n_words, coalesce(n, 0) as n_removed,
  sha256(case when n is null then array_to_string(w, ' ') else coalesce(array_to_string(list_filter(w, lambda x, i: not list_contains(ps, i)), ' '), '') end) as kept_sha256
from d left join lost using (doc_id)"""


@register("op2_substring_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.substring_dedup import dedup

    return dedup(table(spark, sf_dir, "documents"), window=50).drop("spans")


# Two hexadecimal digits stand for a byte; s counts bytes from 0.
OP6_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents),
w as (select doc_id, s, md5(h[2 * s + 1 : 2 * s + 200]) as g from (select doc_id, h, unnest(range(0, n - 99)) as s from d where n >= 100)),
gone as (select doc_id, s from (select *, row_number() over (partition by g order by doc_id, s) as r from w) where r > 1),
runs as (select doc_id, s, sum(fresh) over (partition by doc_id order by s) as run from (
  select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 100 then 0 else 1 end as fresh from gone)),
spans as (select doc_id, min(s) as b, max(s) + 100 as e from runs group by doc_id, run),
between_ as (select doc_id, b, e, coalesce(lag(e) over (partition by doc_id order by b), 0) as before from spans),
kept as (select d.doc_id, any_value(n) as n, sum(e - b) as removed, count(*) as spans, string_agg(h[2 * before + 1 : 2 * b], '' order by b) as parts, max(e) as last
  from between_ join d using (doc_id) group by d.doc_id)
select d.doc_id, d.n as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, coalesce(spans, 0) as n_spans,
  sha256(unhex(case when removed is null then d.h else concat(parts, d.h[2 * last + 1 :]) end)) as kept_sha256
from d left join kept using (doc_id)"""


@register("op6_suffix_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.suffix_dedup import dedup

    return dedup(table(spark, sf_dir, "documents"), length=100).drop("spans")


# Links by shared shingles, then the smallest document reached.
OP1_SQL = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
g as (select distinct doc_id, md5(array_to_string(w[s : s + least(5, len(w)) - 1], ' ')) as h from (select doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as s from d where len(w) > 0)),
n as (select doc_id, count(*) as n from g group by 1),
links as (select x.doc_id as a, y.doc_id as b from g x join g y on x.h = y.h and x.doc_id <> y.doc_id join n nx on nx.doc_id = x.doc_id join n ny on ny.doc_id = y.doc_id
  group by 1, 2, nx.n, ny.n having 100 * count(*) >= 80 * (nx.n + ny.n - count(*))),
reach as (select distinct a, a as b from links union select reach.a, links.b from reach join links on links.a = reach.b)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(c.b, d.doc_id) as component_id
from d left join n using (doc_id) left join (select a, min(b) as b from reach group by 1) c on c.a = d.doc_id"""


@register("op1_ngram_jaccard_join", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.ngram_join import join_documents

    return join_documents(table(spark, sf_dir, "documents"), size=5, percent=80).drop("class_id")


# Filters fail or not once per document; each order applies the letters from left to right.
OP13_SQL = r"""
with recursive o as (select '' as p union all select p || x from o, (values ('A'), ('B'), ('C'), ('D'), ('E')) v(x) where not contains(p, x)),
step as (select p as filter_order, cast(s as integer) as step, p[s] as f, p[1 : s - 1] as before from o, range(1, 6) r(s) where len(p) = 5),
d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by t) as first from d),
l as (select doc_id, max(coalesce(quality = 1, false)) as good, max(coalesce(toxic = 1, false)) as toxic from labels group by 1),
m as (select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic, concat(case when len(w) < 50 then 'A' else '' end,
    case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end,
    case when 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t) then 'C' else '' end,
    case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end, case when doc_id > first then 'E' else '' end) as fails
  from w left join l using (doc_id)),
cell as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from m group by 1, 2),
x as (select *, contains(fails, f) as bad, len(translate(before, fails, '')) < len(before) as gone from cell, step),
r as (select part, filter_order, step, f, sum(case when not bad and not gone then n else 0 end) as kept, sum(case when bad and not gone then n else 0 end) as removed,
    sum(case when bad and gone then n else 0 end) as redundant, sum(case when fails = f then n else 0 end) as unique_fails,
    sum(case when bad and not gone then good else 0 end) as good_lost, sum(case when bad and not gone then toxic else 0 end) as toxic_lost
  from x group by 1, 2, 3, 4)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
  cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, f) as bigint) as shapley from r"""


@register("op13_filter_audit", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = OP1_SQL.replace("least(5, len(w))", "least(3, len(w))").replace(">= 80 *", ">= 85 *").replace(
    "coalesce(c.b, d.doc_id) as component_id", "coalesce(c.b, d.doc_id) as component_id, coalesce(c.b, d.doc_id) = d.doc_id as kept")


@register("op12_minhash_dedup", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.tensor_minhash import near_dedup

    return near_dedup(table(spark, sf_dir, "documents"), size=3, percent=85).drop("class_id")


@register("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textforge.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), components=32)
