"""Profiling, duplicates, quantiles and statistics over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import NUM, Layers, js, query, rounded, shown_time, table
from siltstone.functions.jsontext import json_fields
from siltstone.operators import profile
from siltstone.operators.dedupe import dedupe, duplicate_detail, duplicates
from siltstone.operators.joins import mismatch_count
from siltstone.operators.stats import group_summary, quantiles
from siltstone.operators.tags import inconsistent_casing, tag_statistics
from siltstone.plans.checks import unit_ratios
from catalog import fixtures
from siltstone.sources.landing import latest_partition

# ---- columns, keys --------------------------------------------------------------------------

_PROFILED = {
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "pages": ["page_id", "url", "html"],
}
_TYPES = {
    "doc_id": "bigint", "n_chars": "bigint", "c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double",
    "page_id": "bigint",
}


def _profile_sql(source):
    parts = [
        f"""select '{c}' as column_name, '{_TYPES.get(c, "string")}' as column_type,
            count(*) - count(nullif(trim(cast({c} as varchar)), '')) as n_blank,
            100.0::double * (count(*) - count(nullif(trim(cast({c} as varchar)), ''))) / count(*) as blank_pct,
            count(distinct case when trim(cast({c} as varchar)) <> '' then {c} end) as n_distinct from {source}"""
        for c in _PROFILED[source]
    ]
    return "\nunion all ".join(parts)


for _source in _PROFILED:
    _name = "profile_columns" if _source == "documents" else f"profile_columns_{_source}"
    query(_name, _profile_sql(_source))(lambda spark, sf, s=_source: profile.profile_columns(table(spark, sf, s)))


def _examples_sql(source):
    parts = [
        f"""select '{c}' as column_name, cast(place as integer) as position,
                   v as example
            from (select v, row_number() over (order by sha256(v)) as place
                  from (select distinct cast({c} as varchar) as v from {source} where trim(cast({c} as varchar)) <> ''))
            where place <= 5"""
        for c in _PROFILED[source] if c != "c_acctbal"
    ]
    return "\nunion all ".join(parts)


@query("column_examples", _examples_sql("documents"))
def column_examples(spark, sf):
    return profile.column_examples(table(spark, sf, "documents"))


@query("check_key", """
    select count(*) - count(o_orderkey) as n_null, count(distinct o_orderkey) as n_distinct, count(*) as n_rows,
           count(distinct o_orderkey) = count(*) as is_key from orders""")
def check_key(spark, sf):
    return profile.check_key(table(spark, sf, "orders"), "o_orderkey")


@query("check_key_lineitem", """
    select count(*) - count(l_orderkey) as n_null, count(distinct l_orderkey) as n_distinct, count(*) as n_rows,
           count(distinct l_orderkey) = count(*) as is_key from lineitem""")
def check_key_lineitem(spark, sf):
    return profile.check_key(table(spark, sf, "lineitem"), "l_orderkey")


_CONSTANT = [
    "entity_id", "name", "weight_raw", "height_raw", "life_span_raw", "entity_group", "origin",
    "country_code", "description", "tags_raw", "image_url", "n_missing_fields", "loaded_at",
]


@query("constant_columns", "\nunion all ".join(
    f"select '{c}' as column_name from clean having count(distinct coalesce(cast({c} as varchar), '<null>')) = 1"
    for c in _CONSTANT))
def constant_columns(spark, sf):
    return profile.constant_columns(Layers(spark, sf).cleaned, _CONSTANT)


@query("mismatch_count", "select count(*) filter (l_returnflag is distinct from l_linestatus) as n_mismatch from lineitem")
def mismatches(spark, sf):
    return mismatch_count(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


# The measures as the documents hold them; cleaning has already made sentinels NULL.
_RAW_MEASURES = {"weight": "weight.metric", "height": "height.metric", "life_span": "life_span"}


def _sentinels_sql():
    parts = " union all ".join(
        f"select {js('id')} as id, {js('name')} as name, '{field}' as field, lower(trim({js(path)})) as v from newest"
        for field, path in _RAW_MEASURES.items()
    )
    return f"select id, name, field from ({parts}) where v in ('unknown', 'n/a', 'na', 'none', '-', '?', 'varies')"


def _raw_sentinels(spark, sf, kind):
    raw = latest_partition(Layers(spark, sf, kind).bronze)
    paths = {"id": "id", "name": "name", **_RAW_MEASURES}
    rows = raw.select(*[F.get_json_object("payload", f"$.{path}").alias(c) for c, path in paths.items()])
    return profile.sentinel_rows(rows, ["id", "name"], {c: c for c in _RAW_MEASURES})


@query("sentinel_rows", _sentinels_sql(), kind="defects")
def sentinels(spark, sf):
    return _raw_sentinels(spark, sf, "defects")


@query("sentinel_rows_scaled", _sentinels_sql())
def sentinels_scaled(spark, sf):
    return _raw_sentinels(spark, sf, "scaled")


# ---- formats, shapes ------------------------------------------------------------------------

_N = "[0-9]+(\\.[0-9]+)?"
_P = f"(male|female)\\s*:\\s*{_N}(\\s*-\\s*{_N})?"


def _variant_sql(v):
    low = f"lower({v})"
    return f"""case when {v} is null then 'null/missing' when {v} = '' then 'empty string'
        when {low} in ('unknown', 'n/a', 'na', 'none', '-', '?', 'varies') then 'sentinel string: ''' || {v} || ''''
        when regexp_full_match({low}, '{_N}\\s*-\\s*{_N}') then 'range: ''X-Y'''
        when regexp_full_match({low}, '{_N}\\s*-\\s*{_N}\\s*years?') then 'range with unit: ''X-Y years'''
        when regexp_full_match({low}, '{_N}\\s*years?') then 'single value with unit: ''X years'''
        when regexp_full_match({low}, '{_N}') then 'single value: ''X'''
        when regexp_full_match({low}, '{_P}(\\s*;\\s*{_P})*') then
            'sex-specific ' || case when regexp_matches({low}, ':\\s*{_N}\\s*-\\s*{_N}') then 'range' else 'single value' end
            || case when len(list_distinct(regexp_extract_all({low}, '(fe)?male'))) = 2 then ': ''Male: … ; Female: …'''
                    when {low}[1] = 'f' then ', one sex only: ''Female: …''' else ', one sex only: ''Male: …''' end
        else 'unrecognised: ''' || {v} || '''' end"""


def _formats_sql(fields, source):
    union = " union all ".join(f"select '{f}' as field, trim({c}) as v from {source}" for f, c in fields.items())
    return f"""
        select field, {_variant_sql("v")} as variant, count(*) as n_rows, min(v) as example
        from ({union}) group by field, variant"""


@query("format_variants", _formats_sql(
    {"weight": "weight_raw", "height": "height_raw", "life_span": "life_span_raw"}, "clean"), kind="defects")
def format_variants(spark, sf):
    rows = Layers(spark, sf, "defects").cleaned
    return profile.format_variants(
        rows, {"weight": "weight_raw", "height": "height_raw", "life_span": "life_span_raw"}
    )


@query("format_variants_documents", _formats_sql({"weight": js("weight.metric"), "life_span": js("life_span")}, "fx"))
def format_variants_documents(spark, sf):
    raw = json_fields(
        fixtures.documents(spark, sf), "payload", {"w": "weight.metric", "l": "life_span"}, ("entity_id",)
    )
    return profile.format_variants(raw, {"weight": "w", "life_span": "l"})


@query("format_report", f"""
    select field, variant, n_rows, example, cast(position as integer) as position, greatest(n_variants - 15, 0) as n_hidden
    from (select *, row_number() over (partition by field order by n_rows desc, variant) as position,
                 count(*) over (partition by field) as n_variants
          from (select 'url' as field, {_variant_sql("url")} as variant, count(*) as n_rows, min(url) as example from pages group by 2
                union all select 'source', {_variant_sql("source")}, count(*), min(source) from documents group by 2))
    where position <= 15""")
def format_report(spark, sf):
    urls = profile.format_variants(table(spark, sf, "pages"), {"url": "url"})
    sources = profile.format_variants(table(spark, sf, "documents"), {"source": "source"})
    return profile.shown_variants(urls.unionByName(sources))


@query("object_shapes", """
    select case when props is null or json_type(props) = 'NULL' then 'null/missing'
                when json_type(props) = 'OBJECT' then 'object with keys: ' || array_to_string(list_sort(json_keys(props)), ', ')
                else 'scalar' end as shape, count(*) as n_rows
    from events group by 1""")
def object_shapes(spark, sf):
    return profile.object_shapes(table(spark, sf, "events"), "props")


@query("object_shapes_nested", """
    select 'object with keys: ' || array_to_string(list_sort(json_keys(json_extract(payload, '$.weight'))), ', ') as shape,
           count(*) as n_rows from fx group by 1""")
def object_shapes_nested(spark, sf):
    docs = fixtures.documents(spark, sf).select(F.get_json_object("payload", "$.weight").alias("weight"))
    return profile.object_shapes(docs, "weight")


@query("subkey_formats", f"""
    select field, {_variant_sql("v")} as variant, count(*) as n_rows, min(v) as example
    from (select 'imperial' as field, {js('weight.imperial')} as v from fx
          union all select 'metric', {js('weight.metric')} from fx) group by field, variant""")
def subkeys(spark, sf):
    docs = fixtures.documents(spark, sf).select(F.get_json_object("payload", "$.weight").alias("weight"))
    return profile.subkey_formats(docs, "weight")


# ---- tags -----------------------------------------------------------------------------------

_RAW_TAGS = "select entity_id, [trim(t) for t in string_split(tags_raw, ',') if trim(t) <> ''] as tags from clean"


@query("tag_stats", f"""
    with r as ({_RAW_TAGS}), t as (select unnest(tags) as tag from r)
    select count(*) filter (tags is null) as n_missing, count(tags) as n_with_tags,
           round(avg(len(tags)), 6) as avg_tags, cast(min(len(tags)) as integer) as min_tags, cast(max(len(tags)) as integer) as max_tags,
           (select count(distinct tag) from t) as n_raw, (select count(distinct lower(tag)) from t) as n_folded,
           (select count(*) from (select lower(tag) from t group by 1 having count(distinct tag) > 1)) as n_inconsistent
    from r""".replace("with r as", "select * from (with r as") + ")")
def tag_stats(spark, sf):
    return rounded(tag_statistics(Layers(spark, sf).cleaned, "tags_raw"), "avg_tags")


@query("inconsistent_casing", f"""
    select lower(tag) as tag, count(distinct tag) as n_casings, count(*) as n_mentions
    from (select unnest(tags) as tag from ({_RAW_TAGS})) group by 1 having count(distinct tag) > 1""")
def casings(spark, sf):
    return inconsistent_casing(Layers(spark, sf).cleaned, "tags_raw")


# ---- duplicates -----------------------------------------------------------------------------


@query("dedupe", """
    select entity_id, name, n_missing_fields from (
      select *, row_number() over (partition by name order by n_missing_fields, entity_id) as place from clean) where place = 1""")
def dedupe_entities(spark, sf):
    kept = dedupe(Layers(spark, sf).cleaned, ["name"], ["n_missing_fields", "entity_id"])
    return kept.select("entity_id", "name", "n_missing_fields")


_LINE_ORDER = ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]


@query("dedupe_lineitem", f"""
    select l_orderkey, l_linenumber, {', '.join(_LINE_ORDER)} from (
      select *, row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(_LINE_ORDER)}) as place from lineitem)
    where place = 1""")
def dedupe_lineitem(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_LINE_ORDER)
    return dedupe(lines, ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@query("dedupe_documents", """
    select min(doc_id) as doc_id, sha256(text) as digest from documents group by text""")
def dedupe_documents(spark, sf):
    """Copies of whole texts, compared by digest so that no text is shuffled."""
    docs = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return dedupe(docs, ["digest"], ["doc_id"])


@query("duplicate_groups", """
    select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1""")
def duplicate_groups(spark, sf):
    return duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_detail", """
    select name, entity_id, origin, count(*) over (partition by name) as n_rows from clean
    qualify count(*) over (partition by name) > 1""")
def duplicate_rows(spark, sf):
    return duplicate_detail(Layers(spark, sf).cleaned, "name", ["entity_id", "origin"])


@query("duplicate_detail_part", """
    select p_name, p_partkey, p_brand, n_rows from part join (select p_name, count(*) as n_rows from part group by p_name) using (p_name)
    where n_rows > 1""")
def duplicate_parts(spark, sf):
    return duplicate_detail(table(spark, sf, "part"), "p_name", ["p_partkey", "p_brand"])


# ---- samples --------------------------------------------------------------------------------

_SAMPLED = _CONSTANT


@query("sample_records", f"""
    select * from (with shown as (select * replace (strftime(loaded_at, '%Y-%m-%d %H:%M:%S') as loaded_at) from clean),
    s as (select *, cast({' + '.join(f"(coalesce(cast({c} as varchar), '') = '')::int" for c in _SAMPLED)} as integer) as sparsity from shown),
    r as (select *, row_number() over (order by sparsity, entity_id) as up, count(*) over () as n from s),
    c as (select entity_id, case when up = 1 then 1 when up = n then 2 when up = n - 1 then 3 when up = n // 2 + 1 then 4 end as role from r
          union all select entity_id, 4 + row_number() over (order by up) from r where trim(coalesce(tags_raw, '')) <> ''),
    p as (select entity_id, min(role) as role from c where role is not null group by entity_id order by role limit 5)
    select {', '.join('s.' + c for c in _SAMPLED)}, s.sparsity,
           ['richest', 'sparsest', 'second sparsest', 'middle', 'with tags'][least(p.role, 5)] as picked_as
    from p join s using (entity_id))""")
def samples(spark, sf):
    rows = Layers(spark, sf).cleaned.select(*_SAMPLED).withColumn("loaded_at", shown_time("loaded_at"))
    return profile.sample_records(rows, _SAMPLED, "entity_id", "tags_raw")


# ---- quantiles ------------------------------------------------------------------------------

_PROBS = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]


@query("quantiles", """
    select cast(p as double) as prob, round(quantile_cont(weight_mid_kg, p), 6) as quantile
    from dim, (select unnest([0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]) as p) group by p""".replace(
        "quantile_cont(weight_mid_kg, p)",
        "list_sort(list(weight_mid_kg) filter (weight_mid_kg is not null))[floor(p * (count(weight_mid_kg) - 1))::int + 1] * (1 - (p * (count(weight_mid_kg) - 1) - floor(p * (count(weight_mid_kg) - 1)))::double) + list_sort(list(weight_mid_kg) filter (weight_mid_kg is not null))[ceil(p * (count(weight_mid_kg) - 1))::int + 1] * (p * (count(weight_mid_kg) - 1) - floor(p * (count(weight_mid_kg) - 1)))::double"))
def weight_quantiles(spark, sf):
    return rounded(quantiles(Layers(spark, sf).dim, "weight_mid_kg", _PROBS), "quantile")


@query("quantiles_by_flag", " union all ".join(
    f"select l_returnflag, {p}::double as prob, round(quantile_cont(l_extendedprice, {p}), 6) as quantile from lineitem group by l_returnflag"
    for p in _PROBS))
def price_quantiles(spark, sf):
    found = quantiles(table(spark, sf, "lineitem"), "l_extendedprice", _PROBS, ["l_returnflag"])
    return rounded(found, "quantile")


@query("median_ratio", f"""
    select metric, round(median(top / bottom), 6) as median_ratio, count(*) as n_entities from (
      select 'weight' as metric, try_cast(nullif(regexp_extract({js('weight.imperial')}, {NUM}), '') as double) as top,
             try_cast(nullif(regexp_extract({js('weight.metric')}, {NUM}), '') as double) as bottom from newest
      union all
      select 'height', try_cast(nullif(regexp_extract({js('height.metric')}, {NUM}), '') as double),
             try_cast(nullif(regexp_extract({js('height.imperial')}, {NUM}), '') as double) from newest)
    where top > 0 and bottom > 0 group by metric""")
def ratios(spark, sf):
    return rounded(unit_ratios(Layers(spark, sf).bronze), "median_ratio")


@query("summary_by_priority", """
    select o_orderpriority, count(*) as n_rows, count(o_totalprice) as n_with_value, round(avg(o_totalprice), 2) as mean_o_totalprice,
           round(median(o_totalprice), 2) as median_o_totalprice, round(stddev_samp(o_totalprice), 2) as stddev_o_totalprice,
           min(o_totalprice) as min_o_totalprice, max(o_totalprice) as max_o_totalprice
    from orders group by o_orderpriority""")
def summary_by_priority(spark, sf):
    return group_summary(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", continuous=True)
