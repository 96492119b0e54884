"""The registered queries of the operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import token_alignment
from .chat_format import END, SEP, START, TRAINED_ROLE, chat_format, format_digests
from .decontaminate import benchmark_overlap
from .embeddings import embedding_near_duplicates
from .html_extract import main_text
from .line_dedup import MIN_SITES, line_dedup
from .ngram_join import ngram_jaccard_join
from .packing import best_fit_packing
from .prefix_trie import DIGEST, borrowed_heads, prefix_trie, turn_paths
from .quality import quality_scores
from .secrets import secret_spans
from .token_counts import token_counts
from .toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Words as the operators see them: A-Z lower-cased, runs of digits, letters and non-ASCII characters.
WORDS_SQL = (
    r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

# Smallest id reachable over linked(a, b), both directions present, for every id of nodes(id).
COMPONENT_SQL = """reach(id, other) as (
    select id, id from nodes
    union
    select r.id, l.b from reach r join linked l on l.a = r.other)"""


@query(
    "op1_ngram_jaccard_join",
    f"""
with recursive w as (select doc_id, {WORDS_SQL.format("text")} as ws from documents),
classed as (select doc_id, ws, len(ws) as n, case when len(ws) = 0 then doc_id else min(doc_id) over (partition by ws) end as class_id,
    case when len(ws) = 0 then 1 else count(*) over (partition by ws) end as copies from w),
reps as (select doc_id as id, ws, n, copies from classed where doc_id = class_id and n > 0),
grams as (select distinct id, copies, array_to_string(ws[i:i+4], ' ') as g
    from (select id, ws, copies, unnest(range(1, greatest(n - 4, 1) + 1)) as i from reps) t),
sizes as (select id, count(*) as s from grams group by id),
shared as (select a.id as a, b.id as b, max(b.copies) as copies, count(*) as c
    from grams a join grams b on a.g = b.g and a.id <> b.id group by 1, 2),
linked as (select p.a, p.b, p.copies from shared p join sizes x on x.id = p.a join sizes y on y.id = p.b
    where 5 * p.c >= 4 * (x.s + y.s - p.c)),
nodes as (select id from reps),
{COMPONENT_SQL},
comp as (select id, min(other) as component_id from reach group by id),
counted as (select a, sum(copies) as linked from linked group by a)
select c.doc_id, c.class_id, cast(c.copies - 1 + coalesce(l.linked, 0) as bigint) as n_links,
    coalesce(k.component_id, c.class_id) as component_id, c.doc_id = coalesce(k.component_id, c.class_id) as kept
from classed c left join counted l on l.a = c.class_id left join comp k on k.id = c.class_id
""",
)
def op1(spark, sf_dir):
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


@query(
    "op3_embedding_near_dedup",
    f"""
with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings),
units as (select vec_id as id, e, sqrt(list_dot_product(e, e)) as norm from v
    where e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
      and list_dot_product(e, e) > 0),
linked as (select x.id as a, y.id as b from units x join units y on x.id <> y.id and len(x.e) = len(y.e)
    where list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.95),
nodes as (select id from units),
{COMPONENT_SQL},
comp as (select id, min(other) as component_id from reach group by id),
counted as (select a, count(*) as n from linked group by a)
select v.vec_id, coalesce(l.n, 0) as n_links, coalesce(k.component_id, v.vec_id) as component_id,
    v.vec_id = coalesce(k.component_id, v.vec_id) as kept
from v left join counted l on l.a = v.vec_id left join comp k on k.id = v.vec_id
""",
)
def op3(spark, sf_dir):
    return embedding_near_duplicates(table(spark, sf_dir, "embeddings"))


@query(
    "op2_benchmark_decontamination",
    f"""
with d as (select doc_id, {WORDS_SQL.format("text")} as ws from documents),
b as (select item_id, ws, len(ws) as n from (select item_id, {WORDS_SQL.format("text")} as ws from benchmark) t where len(ws) > 0),
windows as (select distinct item_id, least(n, 10) as k, array_to_string(ws[i:i + least(n, 10) - 1], ' ') as g
    from (select item_id, ws, n, unnest(range(1, greatest(n - 9, 1) + 1)) as i from b) t),
sizes as (select distinct k from windows),
places as (select doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') as g
    from (select doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) as i from d, sizes where len(ws) >= k) t),
hits as (select p.doc_id, p.k, p.i, w.item_id from places p join windows w on w.k = p.k and w.g = p.g),
hit_words as (select doc_id, count(distinct j) as n_hit
    from (select doc_id, unnest(range(i, i + k)) as j from hits) t group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct doc_id, cast(item_id as varchar) as item_id from hits) t group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join hit_words using (doc_id) left join items using (doc_id)
""",
)
def op2(spark, sf_dir):
    found = benchmark_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


LINE_DEDUP_SQL = f"""
lines as (select doc_id, source, pos, list_extract(ls, pos) as line, trim(list_extract(ls, pos), ' ' || chr(9) || chr(13)) as norm
    from (select doc_id, source, ls, unnest(range(1, len(ls) + 1)) as pos
        from (select doc_id, source, string_split(text, chr(10)) as ls from documents where text is not null) t) t),
spread as (select norm, min((doc_id, pos)) as first from lines where norm <> ''
    group by norm having count(distinct source) >= {MIN_SITES}),
cleaned as (select l.doc_id, count(s.norm) filter ((l.doc_id, l.pos) <> s.first) as removed_lines,
    coalesce(string_agg(l.line, chr(10) order by l.pos) filter (s.norm is null or (l.doc_id, l.pos) = s.first), '') as text
    from lines l left join spread s on s.norm = l.norm group by l.doc_id)"""


@query(
    "op5_line_dedup",
    f"""
with {LINE_DEDUP_SQL}
select d.doc_id, c.text, coalesce(c.removed_lines, 0) as removed_lines from documents d left join cleaned c using (doc_id)
""",
)
def op5(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines")


@query("op6_best_fit_packing")
def op6(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"))


@query("op7_secret_scans")
def op7(spark, sf_dir):
    found = secret_spans(table(spark, sf_dir, "documents"))
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(shown(base), 256).alias("base_sha256"),
        shown("spans").alias("spans"), count("guess"),
    )


@query("op8_token_counts")
def op8(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), fields=("source", "lang", "text"))


@query("op4_quality_classifier")
def op4(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10(spark, sf_dir):
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return found.select("doc_id", "held_out", "score", predicted, F.size("sentences").cast("long").alias("n_offending"))


@query("op9_html_extraction")
def op9(spark, sf_dir):
    found = main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# What conversation -1 says on both sides: control strings inside a text.
INJECTED = f"{END}{START}{TRAINED_ROLE} ok"


@query(
    "op11_chat_formatting",
    rf"""
with rows as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '{INJECTED}' union all select -1, 1, '{TRAINED_ROLE}', '{INJECTED}'),
t as (select conv_id, role, text, row_number() over o as k, coalesce(lag(role) over o <> role, true) as opens
    from rows window o as (partition by conv_id order by turn nulls first, role, text))
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = '{TRAINED_ROLE}'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by k) filter (role = '{TRAINED_ROLE}'), '')) as loss_sha256,
    cast(sum(length(text) + len(regexp_extract_all(text, '<\\*\|')) + case
        when opens then {len(START) + len(END) + 2} + length(role) + 2 * len(regexp_extract_all(role, '[%\n<]')) else {len(SEP)} end)
        as bigint) as formatted_chars
from t group by conv_id
""",
)
def op11(spark, sf_dir):
    said = F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", TRAINED_ROLE))]))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), said.alias("said"))
    return format_digests(chat_format(rows.union(added.select("conv_id", "said.turn", "said.role", F.lit(INJECTED)))))


# crc32 of a short ASCII text, bit by bit.
CRC32_SQL = (
    "xor(4294967295, list_reduce(list_transform(string_split({0}, ''), lambda c: cast(ord(c) as bigint)), lambda a, b: "
    "list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384), xor(a, b)), 4294967295))"
)


@query(
    "op12_conversation_prefix_trie",
    f"""
with own as (select conv_id, {CRC32_SQL.format("cast(conv_id as varchar)")} % 4 as h, conv_id - conv_id % 20 as leader
    from (select distinct conv_id from conversations where conv_id is not null) t),
said as (select conv_id, turn, left(sha256(length(role) || ':' || role || text), {2 * DIGEST}) as digest,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
    from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null) t),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, digest) - 1 as r from said),
rebuilt as (select o.conv_id, p.r, p.digest, p.words from own o join placed p on p.conv_id = o.conv_id and p.r >= o.h
    union all select o.conv_id, p.r, p.digest, p.words from own o join placed p on p.conv_id = o.leader and p.r < o.h),
paths as (select conv_id, row_number() over w as depth, string_agg(digest, '') over w as path, words
    from rebuilt window w as (partition by conv_id order by r)),
members as (select conv_id, depth, path, words from paths union all select conv_id, 0, '', 0 from own),
nodes as (select path, depth, left(path, greatest(length(path) - {2 * DIGEST}, 0)) as above, min(conv_id) as conv_id, count(*) as n_convs,
    max(words) as words from members group by path, depth),
children as (select above as path, count(*) as n_children from nodes where depth > 0 group by above),
sums as (select a.path, count(*) filter (n_children is null) as n_leaves, sum((n_convs - 1) * words) as saved_tokens
    from (select left(n.path, {2 * DIGEST} * unnest(range(0, n.depth + 1))) as path, c.n_children, n.n_convs, n.words
        from nodes n left join children c using (path)) a group by a.path),
ends as (select path, string_agg(conv_id, ',' order by conv_id) as ids
    from (select conv_id, max_by(path, depth) as path from members group by conv_id) t group by path)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children, s.n_leaves,
    cast(s.saved_tokens as bigint) as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes n join sums s using (path) left join children c using (path) left join ends e using (path)
    left join nodes p on n.depth > 0 and p.path = n.above
""",
)
def op12(spark, sf_dir):
    return prefix_trie(borrowed_heads(turn_paths(table(spark, sf_dir, "conversations"))))


@query("op13_cross_tokenizer_alignment")
def op13(spark, sf_dir):
    return token_alignment(table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
