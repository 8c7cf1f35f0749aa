"""Queries of the training-data operators, each over its whole table, and SQL to check them by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.llm import bpe, chat, decontamination, jaccard, langid, lines, pii, quality, search_queries, toxicity, urls
from demandloom.llm.common import table
from demandloom.llm.url_sql import OP6_SQL

Query = Callable[[SparkSession, str], DataFrame]

#: The key of the pseudonyms is the caller's secret; the queries use a fixed one.
PSEUDONYM_KEY = "demandloom check key"
#: A text is toxic from this expected severity on. On held-out labels of check_s, of 1,337 toxic
#: texts 5 lie below 0.15 and the rest above 0.54; clean ones stay below 0.01.
TOXIC_FROM = 0.5


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    place = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    nodes = turns.withColumn("node", F.row_number().over(place).cast("long")).select(
        F.col("conv_id").alias("tree"), "node", (F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )
    done = chat.format_branches(chat.branches(nodes))
    read = done.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "under_loss", chat.read_loss(F.col("formatted"), F.col("loss"))
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("under_loss").cast("long").alias("loss_chars"),
        F.sha2("under_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
  select *, '[TURN]' || role || chr(10) || regexp_replace(text,
    '([<\[])(\\*)(/?s>|/?INST\]|/?TURN\]|\|im_start\|>|\|im_end\|>|\|endoftext\|>)', '\1\\\2\3', 'g')
    || '[/TURN]' as marked
  from turns
), joined as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '') as loss,
    string_agg(marked, '' order by turn, role, text) as body
  from marked group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars,
  sha256(loss) as loss_sha256, length('<s>' || body || '</s>') as formatted_chars
from joined
"""


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_lines(docs).select("doc_id", "text", "n_lines", "n_dropped")


OP2_SQL = r"""
with recursive texts as (
  select distinct text, ('0x' || md5(text)[1:15])::bigint as body from documents where text is not null
), raw as (
  select body, unnest(string_split(text, chr(10))) as whole, generate_subscripts(string_split(text, chr(10)), 1) as line from texts
), worded as (
  select body, line, whole, list_filter(regexp_split_to_array(whole, '[\x20\x09-\x0D]+'), lambda w: w <> '') as own,
    regexp_replace(whole, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as trimmed,
    length(regexp_replace(whole, '[^\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]', '', 'g')) as letters
  from raw
), masked as (
  select body, line, whole, letters, case
    when len(own) < 3 then [regexp_replace(trimmed, '[0-9]+', '<*>', 'g')]
    else list_transform(own, lambda w: case when regexp_matches(w, '[0-9]') then '<*>' else w end) end as masked
  from worded where len(own) >= 3 or length(trimmed) >= 10 or letters >= 6
), lines as (
  select body, line, len(masked) as n, masked[1:4] as leaf, masked,
    least(5, greatest(2, 6 - greatest(len(masked), length(whole) // 5, letters // 2) // 5)) as need,
    len(list_filter(masked, lambda w: w <> '<*>')) >= 0.5 * len(masked) as solid
  from masked
), distinct_lines as (
  select n, leaf, masked, count(distinct body) as documents from lines group by all
), places as (
  select n, leaf, masked, documents, unnest(masked) as word, generate_subscripts(masked, 1) as place from distinct_lines
), constant as (
  select n, leaf, place, word from places where word <> '<*>' group by all having sum(documents) >= 5
), named as (
  select n, leaf, masked, list((place, word) order by place) as template
  from places semi join constant using (n, leaf, place, word) group by all having count(*) >= 0.5 * n
), found as (
  select body, line, (n, leaf, template, null::varchar[]) as template, 5 as need from lines join named using (n, leaf, masked)
  union all
  select body, line, (n, null, null, masked), need from lines where solid and need < 5
), often as (
  select * from found
  where template in (select template from found group by 1 having count(distinct body) >= min(need))
), phrases as (
  select distinct body, phrase
  from (select body, unnest(string_split(replace(replace(replace(replace(text, 'n ', 'n.'), chr(10), '.'), '。', '。.'), '，', '，.'), '.')) as phrase
    from texts where body in (select body from often))
  where strlen(phrase) >= 8
), sizes as (select body, count(*) as n from phrases group by 1),
ends as (
  select phrase, unnest([min(body), max(body)]) as leader from phrases group by 1 having count(*) > 1
), tried as (
  select body, leader from phrases join ends using (phrase) join sizes using (body)
  where body <> leader group by body, leader, n having 8 * count(*) >= n
), links as (
  select t.body as u, leader as v
  from tried t join phrases a on a.body = t.body join phrases b on b.body = t.leader and a.phrase = b.phrase
    join sizes m on m.body = t.body join sizes n on n.body = t.leader
  group by t.body, leader, m.n, n.n having 3 * count(*) >= m.n + n.n
), both_ways as (select u, v from links union select v, u from links),
reach as (
  select distinct u as body, u as now from both_ways
  union
  select body, v from reach join both_ways on now = u
), units as (select body, min(now) as unit from reach group by 1),
dropped as (
  select template from often left join units using (body) group by 1 having count(distinct coalesce(unit, body)) >= min(need)
), gone as (
  select text, list(distinct line) as gone
  from often join texts using (body) where template in (select template from dropped) group by 1
)
select d.doc_id,
  case when gone is null then d.text else array_to_string(
    list_filter(string_split(d.text, chr(10)), lambda l, i: not list_contains(gone, i)), chr(10)) end as text,
  coalesce(len(string_split(d.text, chr(10))), 0) as n_lines, coalesce(len(gone), 0) as n_dropped
from documents d left join gone g on d.text = g.text
"""


def severity_grades(labels: DataFrame) -> DataFrame:
    """Grade 0: not toxic; 1: toxic; 2: toxic and of low quality. One row per document."""
    grade = F.when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1)).when(F.col("toxic") == 0, 0)
    return labels.groupBy("doc_id").agg(F.max(grade).alias("grade"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, severity_grades(table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", "severity", (F.col("severity") >= TOXIC_FROM).alias("toxic"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    weights = quality.bucket_weights(docs, trusted)
    return quality.judge(docs, weights).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"
    )


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return urls.judge(pages, urls.page_links(pages)).select("page_id", "host", "path", "rule", "verdict")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.overlaps(docs, items)
    return decontamination.mark(docs, found).select("doc_id", "n_items", "first_item", "best_match", "contaminated")


OP7_SQL = r"""
with bench as (
  select item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from benchmark
), docs as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents
), masks(m, span, o) as (
  values (0, 6, [0, 1, 2, 3, 4, 5]), (1, 10, [0, 1, 3, 5, 6, 9]), (2, 10, [0, 3, 4, 6, 8, 9])
), item_seeds as (
  select item_id, i, m, list_transform(o, lambda x: w[i + x]) as seed
  from bench, masks, unnest(range(1, len(w) - span + 2)) as t(i)
), doc_seeds as (
  select doc_id, i, m, list_transform(o, lambda x: w[i + x]) as seed
  from docs, masks, unnest(range(1, len(w) - span + 2)) as t(i)
), hits as (
  select distinct d.doc_id, s.item_id, d.i - s.i as place from doc_seeds d join item_seeds s using (m, seed)
), aligned as (
  select doc_id, item_id, place, least(len(b.w), 16) as width,
    list_transform(range(1, len(b.w) + 1),
      lambda k: case when k + place between 1 and len(d.w) and d.w[k + place] = b.w[k] then 1 else 0 end) as agree
  from hits join docs d using (doc_id) join bench b using (item_id)
), counted as (
  select doc_id, item_id, width,
    list_max(list_transform(range(1, len(agree) - width + 2), lambda s: list_sum(agree[s:s + width - 1]))) as matched
  from aligned
), found as (
  select doc_id, count(distinct item_id) as n_items, min(item_id) as first_item,
    max(floor(100 * matched / width)) as best_match
  from counted where 100 * matched >= 80 * width group by doc_id
)
select d.doc_id, coalesce(n_items, 0)::bigint as n_items, first_item,
  coalesce(best_match, 0)::bigint as best_match, n_items is not null as contaminated
from documents d left join found f using (doc_id)
"""


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = langid.learn(docs.filter(~held_out(F.col("doc_id"))))
    found = langid.identify(docs, profiles)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return done.select("doc_id", "text", F.size("found").cast("long").alias("n_found"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP10_SQL = r"""
with recursive docs as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') as w
  from documents
), sets as (
  select doc_id, coalesce(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct(
    list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end, []) as own
  from docs
), shingles as (select doc_id, len(own) as n, unnest(own) as shingle from sets),
links as (
  select a.doc_id as u, b.doc_id as v
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
  where 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways as (select u, v from links union select v, u from links),
reach as (
  select doc_id as start, doc_id as now from sets
  union
  select start, v from reach join both_ways on now = u
)
select s.doc_id, len(own) as n_shingles, c.component_id
from sets s join (select start, min(now) as component_id from reach group by 1) c on s.doc_id = c.start
"""


QUERIES: dict[str, Query] = {
    "op1_chat_format": op1_chat_format,
    "op2_line_templates": op2_line_templates,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_urls": op6_urls,
    "op7_decontamination": op7_decontamination,
    "op8_bpe": op8_bpe,
    "op9_pseudonyms": op9_pseudonyms,
    "op10_jaccard": op10_jaccard,
    **search_queries.QUERIES,
}

ORACLES: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op2_line_templates": OP2_SQL,
    "op6_urls": OP6_SQL,
    "op7_decontamination": OP7_SQL,
    "op10_jaccard": OP10_SQL,
    **search_queries.ORACLES,
}
