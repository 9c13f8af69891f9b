"""The registered queries of this folder: one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from . import alignment, bpe, counts, decontaminate, editprints, extract, lines, negatives, quality, quotes, shards, simhash, suffixes
from .common import importable, table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = lambda spark, sf_dir: build(importable(configure(spark)), sf_dir)
        if sql is not None:
            _CHECKS[name] = sql
        return build
    return register


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def llm_checks() -> dict[str, str]:
    return dict(_CHECKS)


_BLANKS = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"

LINES_SQL = f"""
with pages as (select doc_id, source, text, string_split(text, chr(10)) as ls from documents),
seen as (select distinct doc_id, source, trim(x, {_BLANKS}) as line from (select doc_id, source, unnest(ls) as x from pages)),
counted as (select source, line, count(*) as n from seen where line <> '' group by source, line),
totals as (select source, count(*) as total from documents group by source),
bad as (select c.source, list(c.line) as bad from counted c join totals t on c.source is not distinct from t.source
        where c.n >= {lines.MIN_PAGES} and c.n * 1000 > t.total * {lines.RATIO_PERMILLE} group by c.source),
kept as (select doc_id, p.source, ls, case when bad is null then ls else list_filter(ls,
           lambda x: trim(x, {_BLANKS}) = '' or not list_contains(bad, trim(x, {_BLANKS}))) end as k
         from pages p left join bad b on p.source is not distinct from b.source)
select doc_id, source, coalesce(len(ls), 0) as n_lines, coalesce(len(ls) - len(k), 0) as n_dropped,
       array_to_string(k, chr(10)) as text from kept"""

_OWN = r"regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda x: not regexp_matches(x, '^[ \t]*>')), chr(10)), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"


def _normal(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[\\x20\\x09-\\x0D]+', ' ', 'g'))"


REPLIES_SQL = rf"""
with m as (select conv_id, turn, role, text, {_OWN} as own,
             row_number() over (partition by conv_id order by turn nulls first, role nulls first, {_OWN} nulls first, text) - 1 as position
           from conversations),
ordered as (select *, lag(turn) over (partition by conv_id order by position) as before from m),
one as (select distinct conv_id, turn, role, text, own from m),
signs as (select conv_id, turn, role, text, pos, line, regexp_extract(line, '^((?:[ 	]*>)+)', 1) as sign
          from (select *, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from one)),
quoted as (select *, length(regexp_replace(sign, '[^>]', '', 'g')) as level, trim(substr(line, length(sign) + 1)) as content from signs where sign <> ''),
runs as (select *, pos - row_number() over (partition by conv_id, turn, role, text, level order by pos) as run from quoted where content <> ''),
passages as (select conv_id, turn, role, text, level, min(pos) as "at", list(content order by pos) as lines
             from runs group by conv_id, turn, role, text, level, run),
wanted as (select conv_id, turn, role, text, level, "at", 0 as by_line, {_normal("array_to_string(lines, ' ')")} as said from passages
           union all select conv_id, turn, role, text, level, "at", 1, {_normal("x")} from (select *, unnest(lines) as x from passages)),
spoken as (select conv_id, turn, unnest(list_concat([own], string_split_regex(own, '
[ 	]*
'), string_split(own, chr(10)))) as x from one where own is not null),
first_said as (select conv_id, {_normal("x")} as said, min(turn) as writer from spoken group by all),
found as (select w.*, case when f.writer < w.turn then f.writer end as writer
          from wanted w left join first_said f on w.conv_id is not distinct from f.conv_id and w.said = f.said),
best as (select conv_id, turn, role, text, level, "at", arg_min(writer, by_line * 1000000000 + writer) as writer
         from found group by conv_id, turn, role, text, level, "at"),
linked as (select conv_id, turn, role, text, count(*) as n_quotes, count(writer) as n_linked,
             arg_min(writer, level * 1000000000 + "at") filter (where writer is not null) as writer
           from best group by conv_id, turn, role, text)
select o.conv_id, position, o.turn, o.role, own as text, coalesce(writer, before) as reply_to,
       coalesce(n_quotes, 0) as n_quotes, coalesce(n_linked, 0) as n_linked
from ordered o left join linked l on o.conv_id is not distinct from l.conv_id and o.turn is not distinct from l.turn
  and o.role is not distinct from l.role and o.text = l.text"""

QUALITY_SQL = rf"""
with split as (select doc_id, lang, source,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls,
    length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) as n_symbols from documents),
windows as (select doc_id, i, array_to_string(ws[i:i + {quality.WINDOW - 1}], ' ') as w
            from (select doc_id, ws, unnest(generate_series(1, len(ws) - {quality.WINDOW - 1})) as i from split)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w) as n from windows) where n > 1),
covered as (select doc_id, count(distinct j) as n from (select doc_id, unnest(generate_series(i, i + {quality.WINDOW - 1})) as j from again) group by doc_id),
base as (select s.doc_id, lang, source, len(ws) as n_words, word_chars, n_symbols, len(ls) as n_lines,
           len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words from split s left join covered c on s.doc_id = c.doc_id),
judged as (select *, n_words < {quality.MIN_WORDS} or n_repeat_words * 100 > n_words * {quality.MAX_REPEAT_PERCENT} as base_failed,
   case when word_chars > 0 then n_symbols * 1000 // word_chars else 0 end as m_symbols,
   case when n_lines > 0 then n_dup_lines * 1000 // n_lines else 0 end as m_dup_lines,
   case when n_words > 0 then word_chars * 1000 // n_words // 100 else 0 end as m_word_length from base),
long as (select lang, source, feature, v from judged unpivot (v for feature in (m_symbols, m_dup_lines, m_word_length)) where not base_failed),
buckets as (select lang, source, feature, (v::bigint >> greatest(length(bin(v::bigint)) - 10, 0)::bigint) << greatest(length(bin(v::bigint)) - 10, 0)::bigint as b from long),
sketch as (select 2 as level, lang, source, feature, b, count(*) as n from buckets group by all
  union all select 1, lang, null, feature, b, count(*) from buckets group by all
  union all select 0, null, null, feature, b, count(*) from buckets group by all),
summed as (select *, sum(n) over (partition by level, lang, source, feature order by b) as upto,
             sum(n) over (partition by level, lang, source, feature) as total from sketch),
quartiles as (select level, lang, source, feature, total, min(b) filter (where upto * 4 >= total) as q1, min(b) filter (where upto * 4 >= total * 3) as q3
              from summed group by all),
fences as (select level, lang, source, total, feature, q3 + {quality.SPREAD} * (q3 - q1) + case feature
   when 'm_symbols' then {quality.TOLERANCE["symbols"]} when 'm_dup_lines' then {quality.TOLERANCE["dup_lines"]} else {quality.TOLERANCE["word_length"]} end as fence
   from quartiles where total >= {quality.MIN_GROUP} or level = 0),
chosen as (select j.doc_id, f.feature, arg_max(f.fence, f.level) as fence from judged j join fences f on f.level = 0
   or f.level = 1 and f.lang is not distinct from j.lang or f.level = 2 and f.lang is not distinct from j.lang and f.source is not distinct from j.source
   group by j.doc_id, f.feature),
wide as (select doc_id, max(fence) filter (where feature = 'm_symbols') as f1, max(fence) filter (where feature = 'm_dup_lines') as f2,
           max(fence) filter (where feature = 'm_word_length') as f3 from chosen group by doc_id)
select j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(m_symbols <= f1 and m_dup_lines <= f2 and m_word_length <= f3, false) as kept
from judged j left join wide w on j.doc_id = w.doc_id"""

_TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

LEAKS_SQL = f"""
with d as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as p from (select doc_id, {_TOKENS} as ws from documents)),
b as (select item_id, len(ws) as n, unnest(ws) as w, generate_subscripts(ws, 1) as q from (select item_id, {_TOKENS} as ws from benchmark)
      where len(ws) > 0),
pairs as (select doc_id, item_id, n, p - q as shift, q from d join b on d.w = b.w),
counted as (select *, count(*) over (partition by doc_id, item_id, shift) as matched, least(n, {decontaminate.RUN_WORDS}) as run from pairs),
ranked as (select *, row_number() over (partition by doc_id, item_id, shift order by q) as k,
             (run * {decontaminate.SIMILARITY_PERCENT} + 99) // 100 as need from counted where matched * 100 >= run * {decontaminate.SIMILARITY_PERCENT}),
near as (select x.doc_id, x.item_id, x.n, x.matched from ranked x join ranked y on x.doc_id = y.doc_id and x.item_id = y.item_id
         and x.shift = y.shift and y.k = x.k + x.need - 1 and y.q - x.q < x.run)
select doc_id, item_id, n as n_words, max(matched) as matched_words from near group by doc_id, item_id, n"""


BPE_FILE = "byte_bpe_multi_50k.tiktoken"
PIECE_FILE = "piece_bpe_32k.model"


@query("op1_bpe_codec")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(BPE_FILE))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(encoded, ranks, public_tokenizers.PATTERN))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = counts.load_model(public_tokenizers.path(PIECE_FILE))
    return counts.token_counts(table(spark, sf_dir, "documents"), model)


@query("op2_line_dedup", LINES_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "source", "n_lines", "n_dropped", "text")


@query("op5_simhash_groups")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_quality_rules", QUALITY_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.assess(docs, [docs.doc_id])


@query("op8_decontamination", LEAKS_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


@query("op9_label_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


@query("op4_chat_replies", REPLIES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_ordered(table(spark, sf_dir, "conversations"))


@query("op10_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


@query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.remove_repeats(table(spark, sf_dir, "documents")))


A_FILE = "byte_bpe_50k.json"


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (alignment.load(public_tokenizers.path(f)) for f in (A_FILE, PIECE_FILE))
    return alignment.align(table(spark, sf_dir, "documents"), a, b, public_tokenizers.PATTERN)[0]


NEGATIVES_SQL = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, embedding,
             list_transform(embedding, lambda x: floor(256 * x::double)) as q, row_number() over () as r
           from embeddings where label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select a.r as ar, a.vec_id as anchor_id, b.r as br, b.vec_id as id, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
          from e a join e b on a.vec_id % 100 = 0 and a.r <> b.r),
positives as (select * from pairs where same qualify row_number() over (partition by ar order by score desc, id, br) <= 5)
select p.anchor_id, p.id as positive_id, row_number() over (partition by p.ar, p.br order by n.score desc, n.id, n.br)::int as rank,
       n.id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join pairs n on p.ar = n.ar and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify rank <= 10"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"), turn_every=7)


@query("op13_edit_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprints.edit_fingerprints(table(spark, sf_dir, "documents"))
