"""Queries of ranked search, the filter audit and sharding, and SQL to check them by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import audit, ranked, sharding
from demandloom.llm.common import table

#: Shards of the documents.
SHARDS = 40


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
with words as (
  select doc_id, row_number() over () as d, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), asked as (
  select distinct item_id, text from benchmark
), needed as (
  select item_id, text, term, count(*) as times
  from (select item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from asked) group by all
), docs as (
  select d, doc_id, w, len(w)::bigint as n from words where len(w) > 0
), totals as (
  select count(*)::bigint as n_docs, sum(n)::bigint as n_all from docs
), counted as (
  select d, doc_id, n, term, count(*)::bigint as tf
  from (select d, doc_id, n, unnest(w) as term from docs) group by all
), weighed as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint as weight
  from counted, totals group by term
), scored as (
  select item_id, text, d, doc_id,
    sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_all))))::bigint as score
  from needed join counted using (term) join weighed using (term), totals group by item_id, text, d, doc_id
), placed as (
  select item_id, doc_id, score,
    row_number() over (partition by item_id, text order by score desc, doc_id) as rank
  from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from placed where rank <= 20
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
with recursive base as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
), marked as (
  select b.doc_id, part,
    [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
     coalesce(b.doc_id > min(b.doc_id) over (partition by text), false)] as fails
  from base b
), labelled as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1
), tally as (
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from marked left join labelled using (doc_id) group by all
), orders(o) as (
  select '' union all
  select o || f from orders, (values ('A'), ('B'), ('C'), ('D'), ('E')) t(f) where not contains(o, f)
), steps as (
  select o as filter_order, unnest(range(1, 6))::int as step from orders where length(o) = 5
), classed as (
  select part, n, good, toxic, filter_order, step, fails[strpos('ABCDE', filter_order[step])] as own,
    len(list_filter(range(1, step), lambda k: fails[strpos('ABCDE', filter_order[k])])) > 0 as earlier,
    len(list_filter(fails, lambda x: x)) as n_failed
  from tally, steps
), counted as (
  select part, filter_order, step,
    coalesce(sum(n) filter (not own and not earlier), 0)::bigint as kept,
    coalesce(sum(n) filter (own and not earlier), 0)::bigint as removed,
    coalesce(sum(n) filter (own and earlier), 0)::bigint as redundant,
    coalesce(sum(n) filter (own and n_failed = 1), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (own and not earlier), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (own and not earlier), 0)::bigint as toxic_lost
  from classed group by all
)
select *, sum(removed) over (partition by part, filter_order[step])::bigint as shapley from counted
"""


def op13_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _op13_sql(shards: int, pieces: int) -> str:
    """The tree written out: a running sum over the units of every node, level by level."""
    sql = f"""
with crc as (
  select list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), own as (
  select doc_id, strlen(coalesce(text, ''))::bigint + 16 as size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: ('0x' || h)::bigint),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295) as text_crc32,
    ('0x' || md5(coalesce(text, ''))[1:15])::bigint as code,
    coalesce(('0x' || md5(lang)[1:2])::int, -1) as c1, coalesce(('0x' || md5(source)[1:2])::int, -1) as c2
  from documents, crc
), points as (
  select *, ('0x' || md5(concat_ws(':', doc_id, code))[1:15])::bigint as row, length(bin(size)) * 16 + ((size >> (length(bin(size)) - 5)) & 15) as v0,
    min(c1) over (partition by code) as v1, min(c2) over (partition by code) as v2,
    (sum(size) over (partition by code) * {shards * pieces} + sum(size) over () - 1) // sum(size) over () as pieces
  from own
), spread as (
  select [greatest(1, max(v0) - min(v0)), greatest(1, max(v1) - min(v1)), greatest(1, max(v2) - min(v2))] as s from points
), level0 as (
  select doc_id, size, text_crc32, code, row, row % pieces as piece, v0, v1, v2, 0 as node, {shards} as k from points
)"""
    level, left = 0, shards
    while left > 1:
        sql += f""", nodes{level} as (
  select node, sum(size) as total,
    [(max(v0) - min(v0)) / any_value(s[1]), (max(v1) - min(v1)) / any_value(s[2]), (max(v2) - min(v2)) / any_value(s[3])] as widths
  from level{level}, spread group by node
), placed{level} as (
  select l.*, total, case list_position(widths, list_max(widths)) when 1 then v0 when 2 then v1 else v2 end as own
  from level{level} l join nodes{level} using (node)
), units{level} as (
  select node, k, total, own, code, piece, sum(size) as mine,
    coalesce(sum(sum(size)) over (partition by node order by own, code, piece rows between unbounded preceding and 1 preceding), 0) as before
  from placed{level} group by node, k, total, own, code, piece
), sides{level} as (
  select node, own, code, piece, k = 1 or (2 * before + mine) * k <= 2 * total * (k // 2) as goes_left from units{level}
), level{level + 1} as (
  select doc_id, size, text_crc32, code, row, piece, v0, v1, v2,
    case when goes_left then node else node + k // 2 end as node,
    case when k = 1 then 1 when goes_left then k // 2 else k - k // 2 end as k
  from placed{level} join sides{level} using (node, own, code, piece)
)"""
        level, left = level + 1, left - left // 2
    return sql + f"""
select doc_id, size, text_crc32, 'bytes' as law, node::int as shard,
  row_number() over (partition by node order by row, code) - 1 as slot, null::int as grown_shard
from level{level}
"""


OP13_SQL = _op13_sql(SHARDS, sharding.PIECES)

QUERIES = {
    "op11_ranked_search": op11_ranked_search,
    "op12_filter_audit": op12_filter_audit,
    "op13_kd_shards": op13_kd_shards,
}
ORACLES = {"op11_ranked_search": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_kd_shards": OP13_SQL}
