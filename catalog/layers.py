"""Landing, silver, gold: the layers of the build."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from catalog import fixtures
from catalog.base import (
    SPEC, Layers, js, nums, query, shown_time, table,
)
from siltstone.functions.jsontext import json_fields
from siltstone.functions.numbers import envelope, first_number, numbers, sex_envelope
from siltstone.functions.shapes import shape_known
from siltstone.functions.text import missing_score, null_if, sentence_case, word_count
from siltstone.operators.bands import band_defects, bucketize, classify_bands
from siltstone.operators.joins import enrich_left, orphans, union_all
from siltstone.operators.stats import corr_matrix, pairwise_corr
from siltstone.operators.tags import share_of_class, tag_bridge, top_tags
from siltstone.plans import marts, pipeline, silver
from siltstone.plans.enrichment import EnrichmentRejected, enrichment_checks, land_enrichment
from siltstone.plans.publish import read_published
from siltstone.session import scratch_path
from siltstone.sources.files import infer_json_fields, read_variants, variant_fields
from siltstone.sources.landing import (
    bronze_table, land_partition, latest_partition, partition_history, read_bronze, read_latest, reference_count,
    to_bronze, validate_payload, verify_partition,
)
from siltstone.sources.tables import database_for, ensure_database, quoted

# ---- landing --------------------------------------------------------------------------------


@query("json_schema", """
    select k as column_name, 'BIGINT' as column_type, count(*) as n_rows
    from (select unnest(json_keys(props)) as k from events) group by k""")
def json_schema(spark, sf):
    return infer_json_fields(table(spark, sf, "events"), "props")


@query("json_schema_lines", """
    select k as column_name,
           case when k in ('weight', 'height') then 'OBJECT<imperial: STRING, metric: STRING>' else 'STRING' end as column_type,
           count(*) as n_rows
    from (select unnest(json_keys(payload)) as k from fx) group by k""")
def json_schema_lines(spark, sf):
    """The documents as files of JSON lines, read as variants: no schema is inferred before, nor a text parsed twice."""
    path = scratch_path(spark, "lines")
    fixtures.documents(spark, sf).select("payload").write.text(path)
    return variant_fields(read_variants(spark, path))


@query("json_schema_documents", """
    select k as column_name,
           case when k in ('weight', 'height') then 'OBJECT<imperial: STRING, metric: STRING>' else 'STRING' end as column_type,
           count(*) as n_rows
    from (select unnest(json_keys(payload)) as k from fx) group by k""")
def json_schema_documents(spark, sf):
    return infer_json_fields(fixtures.documents(spark, sf), "payload")


@query("bronze_payload", """
    select entity_id, payload, strftime(run_date, '%Y-%m-%d') as run_date,
           strftime(loaded_at, '%Y-%m-%d %H:%M:%S') as loaded_at
    from bronze where run_date = date '2024-01-02'""")
def bronze_payload(spark, sf):
    landed = to_bronze(fixtures.documents(spark, sf), date(2024, 1, 2), datetime(2024, 1, 2, 2))
    return landed.withColumn("run_date", F.col("run_date").cast("string")).withColumn(
        "loaded_at", shown_time("loaded_at")
    )


_VALIDATION = """
    select count(*) as n_records, count(*) filter (json_type(payload) <> 'OBJECT') as n_not_objects,
           count(*) - count({id}) as n_null_ids, count(distinct {id}) as n_distinct_ids,
           cast(floor(({ref}) * 0.9) as bigint) as floor,
           case when count({id}) < count(*) then 'records without an id'
                when count({id}) > count(distinct {id}) then 'ids that occur more than once'
                when count(*) < floor(({ref}) * 0.9) then 'fewer records than the floor' end as reason
    from {src}"""


@query("payload_validation", _VALIDATION.format(
    id=js("id"), ref="select count(*) from bronze where run_date = date '2024-01-01'", src="newest"))
def payload_validation(spark, sf):
    bronze = Layers(spark, sf).bronze
    wanted = reference_count(bronze, "2024-01-02").select("reference").scalar()
    return validate_payload(latest_partition(bronze), wanted)


@query("payload_rejected", _VALIDATION.format(
    id="json_extract_string(payload, '$.k')", ref="628",
    src="(select props as payload from events) e"))
def payload_rejected(spark, sf):
    events = table(spark, sf, "events").select(F.col("props").alias("payload"))
    return validate_payload(events, 628, id_path="$.k")


@query("reference_count", """
    select count(*) as reference, 'partition ' || strftime(max(run_date), '%Y-%m-%d') as source
    from bronze where run_date = date '2024-01-01'""")
def reference(spark, sf):
    return reference_count(Layers(spark, sf).bronze, "2024-01-02")


@query("reference_baseline", """
    select d.day, coalesce(n, 628) as reference, coalesce('partition ' || strftime(e.run_date, '%Y-%m-%d'), 'baseline') as source
    from (values ('2024-01-01'), ('2024-01-02'), ('2024-01-03')) d(day)
    left join (select run_date, count(*) as n from bronze group by run_date) e
      on e.run_date = cast(d.day as date) - interval 1 day""")
def reference_baseline(spark, sf):
    """What each of three runs is held against: the first has nothing before it, the others the day before."""
    bronze = Layers(spark, sf).bronze
    days = [reference_count(bronze, d).select(F.lit(d).alias("day"), "*") for d in ("2024-01-01", "2024-01-02", "2024-01-03")]
    return days[0].union(days[1]).union(days[2])


@query("verify_partition", """
    select count(*) as n_rows, count(distinct entity_id) as n_keys, count(*) as expected,
           count(*) = count(distinct entity_id) as ok
    from bronze where run_date = date '2024-01-01'""")
def verify(spark, sf):
    bronze = Layers(spark, sf).bronze
    expected = bronze.where("run_date = date '2024-01-01'").agg(F.count(F.lit(1))).scalar()
    return verify_partition(bronze, "2024-01-01", expected)


_HISTORY = """
    select strftime(run_date, '%Y-%m-%d') as run_date, count(*) as n_rows,
           strftime(max(loaded_at), '%Y-%m-%d %H:%M:%S') as loaded_at
    from bronze group by run_date"""


def _history(df):
    return partition_history(df).withColumn("run_date", F.col("run_date").cast("string")).withColumn(
        "loaded_at", shown_time("loaded_at")
    )


@query("partition_history", _HISTORY)
def history(spark, sf):
    return _history(Layers(spark, sf).bronze)


@query("land_idempotent", _HISTORY)
def land_idempotent(spark, sf):
    """Two days landed, the second one twice: the day is replaced and not doubled."""
    base = scratch_path(spark, "bronze")
    documents = fixtures.documents(spark, sf)
    first_day = documents.where(F.col("entity_id") % 10 != 0).select("payload")
    land_partition(first_day, base, date(2024, 1, 1), datetime(2024, 1, 1, 2), baseline=0)
    for _ in range(2):
        land_partition(documents.select("payload"), base, date(2024, 1, 2), datetime(2024, 1, 2, 2))
    return _history(read_bronze(spark, base))


@query("latest_partition", """
    select entity_id, strftime(run_date, '%Y-%m-%d') as run_date from newest""")
def latest(spark, sf):
    """Both days stand in the landed table; the newest is known from its partitions, so only its files are read."""
    base = scratch_path(spark, "bronze")
    days = Layers(spark, sf).bronze.select("entity_id", "payload", "loaded_at", "run_date")
    days.write.insertInto(quoted(bronze_table(spark, base)), overwrite=True)
    return read_latest(spark, base).select("entity_id", F.col("run_date").cast("string").alias("run_date"))


@query("latest_partition_computed", """
    select entity_id, strftime(run_date, '%Y-%m-%d') as run_date from newest""")
def latest_computed(spark, sf):
    """The general form, over rows that lie in no table."""
    return latest_partition(Layers(spark, sf).bronze).select(
        "entity_id", F.col("run_date").cast("string").alias("run_date")
    )


@query("seed_bands", """
    select label, min_kg, max_kg, count(c_custkey) as n_customers
    from bands left join customer on c_acctbal >= min_kg and c_acctbal < max_kg group by all""")
def seed_bands(spark, sf):
    """The band seed with the customers whose balance falls into each band."""
    bands = Layers(spark, sf).bands
    counted = classify_bands(table(spark, sf, "customer"), "c_acctbal", bands).groupBy("size_class").agg(
        F.count(F.lit(1)).alias("n")
    )
    return bands.join(counted, bands["label"] == counted["size_class"], "left").select(
        "label", "min_kg", "max_kg", F.coalesce("n", F.lit(0)).alias("n_customers")
    )


@query("published_gold", "select * from summary", kind="sound")
def published_gold(spark, sf):
    """A whole run under its own name, checked and published, then read through the views."""
    run = pipeline.Run(scratch_path(spark, "run"), spec=SPEC, run_date=date(2024, 1, 2))
    report = pipeline.run(spark, run, Layers(spark, sf, "sound").bronze)
    if not report.published:
        raise RuntimeError(f"not published: {[r for r in report.results if r['status'] in ('fail', 'error')]}")
    return read_published(spark, run.gold, "class_summary")


@query("dev_gold", "select * from shares", kind="sound")
def dev_gold(spark, sf):
    """A run in dev builds straight into what its readers see."""
    run = pipeline.Run(scratch_path(spark, "run"), target="dev", spec=SPEC, run_date=date(2024, 1, 2))
    pipeline.run(spark, run, Layers(spark, sf, "sound").bronze)
    return read_published(spark, run.gold, "class_tags")


# ---- scalar functions -----------------------------------------------------------------------


@query("json_extract", """
    select event_id, event_type, json_extract_string(props, '$.k') as k,
           json_extract_string(props, '$.missing.child') as absent from events""")
def json_extract(spark, sf):
    return json_fields(
        table(spark, sf, "events"), "props", {"k": "k", "absent": "missing.child"}, ("event_id", "event_type")
    )


@query("json_extract_documents", f"""
    select entity_id, {js('name')} as name, {js('weight.metric')} as metric, {js('weight.imperial')} as imperial,
           {js('height.metric')} as height, {js('life_span')} as life_span, {js('image.url')} as image_url from fx""")
def json_extract_documents(spark, sf):
    return json_fields(
        fixtures.documents(spark, sf), "payload",
        {"name": "name", "metric": "weight.metric", "imperial": "weight.imperial", "height": "height.metric",
         "life_span": "life_span", "image_url": "image.url"},
        ("entity_id",),
    )


@query("stg_entities", """
    select * exclude (loaded_at), strftime(loaded_at, '%Y-%m-%d %H:%M:%S') as loaded_at from silver""")
def stg_entities(spark, sf):
    return Layers(spark, sf).silver.withColumn("loaded_at", shown_time("loaded_at"))


@query("stg_entities_defects", """
    select * exclude (loaded_at), strftime(loaded_at, '%Y-%m-%d %H:%M:%S') as loaded_at from silver""", kind="defects")
def stg_entities_defects(spark, sf):
    return Layers(spark, sf, "defects").silver.withColumn("loaded_at", shown_time("loaded_at"))


@query("sentinel_null", f"""
    select entity_id, nullif(lower(trim({js('weight.metric')})), 'unknown') as weight_raw,
           nullif(trim({js('origin')}), '') as origin from fx""")
def sentinel_null(spark, sf):
    raw = json_fields(fixtures.documents(spark, sf), "payload", {"w": "weight.metric", "o": "origin"}, ("entity_id",))
    return raw.select(
        "entity_id", null_if("w", ["unknown"]).alias("weight_raw"), null_if("o", fold=False).alias("origin")
    )


@query("missing_score", "select entity_id, n_missing_fields from clean")
def missing(spark, sf):
    return Layers(spark, sf).cleaned.select("entity_id", "n_missing_fields")


@query("missing_score_customers", """
    select c_custkey, cast((trim(coalesce(c_name, '')) = '')::int + (trim(coalesce(c_mktsegment, '')) = '')::int as integer) as n_missing
    from customer""")
def missing_customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", missing_score(["c_name", "c_mktsegment"]).alias("n_missing")
    )


def _number_facts(df, key, column):
    found = df.select(key, numbers(column).alias("found"))
    low, high = envelope("found")
    return found.select(
        key, F.size("found").cast("long").alias("n_numbers"), low.alias("smallest"), high.alias("largest"),
        F.get("found", F.lit(0)).alias("first"), F.size(F.array_distinct("found")).cast("long").alias("n_distinct"),
    )


def _number_sql(key, column, source):
    return f"""
        select {key}, len(found) as n_numbers, list_min(found) as smallest, list_max(found) as largest,
               found[1] as first, len(list_distinct(found)) as n_distinct
        from (select {key}, {nums(column)} as found from {source})"""


@query("extract_numbers", _number_sql("page_id", "url", "pages"))
def extract_numbers(spark, sf):
    return _number_facts(table(spark, sf, "pages"), "page_id", "url")


@query("extract_numbers_documents", _number_sql("doc_id", "text", "documents"))
def extract_numbers_documents(spark, sf):
    return _number_facts(table(spark, sf, "documents"), "doc_id", "text")


@query("range_envelope", """
    select entity_id, weight_raw, weight_min_kg, weight_max_kg, height_min_cm, height_max_cm from silver""")
def range_envelope(spark, sf):
    return Layers(spark, sf).silver.select(
        "entity_id", "weight_raw", "weight_min_kg", "weight_max_kg", "height_min_cm", "height_max_cm"
    )


@query("range_envelope_int", f"""
    select page_id, cast(list_min(n) as integer) as smallest, cast(list_max(n) as integer) as largest
    from (select page_id, [x / 8 for x in {nums('url')}] as n from pages)""")
def range_envelope_int(spark, sf):
    """Eighths, so that halves occur and the half-to-even rule shows."""
    eighths = table(spark, sf, "pages").select(
        "page_id", F.transform(numbers("url"), lambda x: x / F.lit(8.0)).alias("n")
    )
    low, high = envelope("n", as_int=True)
    return eighths.select("page_id", low.alias("smallest"), high.alias("largest"))


@query("midpoints", """
    select entity_id, weight_mid_kg, height_mid_cm, life_span_mid_years, life_span_range_years from mids""")
def midpoints(spark, sf):
    return Layers(spark, sf).dim.select(
        "entity_id", "weight_mid_kg", "height_mid_cm", "life_span_mid_years", "life_span_range_years"
    )


@query("sex_envelope", f"""
    select entity_id, list_min(m) as male_min, list_max(m) as male_max, list_min(f) as female_min, list_max(f) as female_max
    from (select entity_id,
                 {nums("regexp_extract(weight_raw, '(^|[^e])male: ([^;]*)', 2)")} as m,
                 {nums("regexp_extract(weight_raw, 'female: ([^;]*)', 1)")} as f from silver)""")
def sexes(spark, sf):
    (m_lo, m_hi), (f_lo, f_hi) = sex_envelope("weight_raw", "male"), sex_envelope("weight_raw", "female")
    return Layers(spark, sf).silver.select(
        "entity_id", m_lo.alias("male_min"), m_hi.alias("male_max"), f_lo.alias("female_min"), f_hi.alias("female_max")
    )


@query("band_classify", "select entity_id, weight_mid_kg, size_class from dim")
def band_classify(spark, sf):
    return Layers(spark, sf).dim.select("entity_id", "weight_mid_kg", "size_class")


@query("band_classify_defects", "select entity_id, weight_mid_kg, size_class from dim", kind="defects")
def band_classify_defects(spark, sf):
    return Layers(spark, sf, "defects").dim.select("entity_id", "weight_mid_kg", "size_class")


@query("sentence_case", """
    select p_partkey, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) as shown from part""")
def sentence(spark, sf):
    return table(spark, sf, "part").select("p_partkey", sentence_case("p_name").alias("shown"))


@query("first_number", f"""
    select page_id, try_cast(nullif(regexp_extract(url, {"'[0-9]+([.][0-9]+)?'"}), '') as double) as first_number from pages""")
def first_numbers(spark, sf):
    return table(spark, sf, "pages").select("page_id", first_number("url").alias("first_number"))


_SPAN = "[0-9]+(\\.[0-9]+)?"
_PART = f"(male|female)\\s*:\\s*{_SPAN}(\\s*-\\s*{_SPAN})?"
KNOWN_SQL = f"'^\\s*({_SPAN}\\s*-\\s*{_SPAN}|{_SPAN}|{_PART}(\\s*;\\s*{_PART})*)\\s*[a-z]*\\s*$'"


@query("shape_known", f"""
    select entity_id, regexp_matches(weight_raw, {KNOWN_SQL}) as weight_known,
           regexp_matches(height_raw, {KNOWN_SQL}) as height_known,
           regexp_matches(life_span_raw, {KNOWN_SQL}) as life_span_known from silver""", kind="defects")
def shapes_known(spark, sf):
    return Layers(spark, sf, "defects").silver.select(
        "entity_id", shape_known("weight_raw").alias("weight_known"),
        shape_known("height_raw").alias("height_known"), shape_known("life_span_raw").alias("life_span_known"),
    )


@query("long_tags", """
    select entity_id, tag, len(string_split(tag, ' ')) as n_words from bridge where len(string_split(tag, ' ')) > 3""",
    kind="defects")
def long_tags(spark, sf):
    rows = Layers(spark, sf, "defects").bridge.select("entity_id", "tag", word_count("tag").cast("long").alias("n_words"))
    return rows.where("n_words > 3")


@query("word_count", """
    select doc_id, length(text) - length(replace(text, ' ', '')) + 1 as n_words from documents""")
def words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", word_count("text").cast("long").alias("n_words"))


_PART_BANDS = "select p_type as label, cast(min(p_size) as integer) as min_kg, cast(min(p_size) + count(*) % 50 as integer) as max_kg from part group by p_type"


def part_bands(spark, sf):
    """A band table that grows out of the data, gaps and overlaps included."""
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("label")).agg(
        F.min("p_size").cast("int").alias("min_kg"),
        (F.min("p_size") + F.count(F.lit(1)) % 50).cast("int").alias("max_kg"),
    )


@query("bands_cover", f"""
    with b as ({_PART_BANDS}),
    seen as (select *, lead(label) over o as next_label, lead(min_kg) over o as next_low from b
             window o as (order by min_kg nulls last, label nulls last))
    select label, min_kg, max_kg, 'min_kg >= max_kg' as problem from seen where min_kg >= max_kg
    union all
    select label, min_kg, max_kg, 'max_kg (' || max_kg || ') <> start of ' || next_label || ' (' || next_low || ')'
    from seen where max_kg <> next_low""")
def bands_cover(spark, sf):
    return band_defects(part_bands(spark, sf))


@query("metric_unparsed", """
    select entity_id, name, 'weight' as metric, weight_raw as raw_value from silver where weight_raw is not null and weight_min_kg is null
    union all by name
    select entity_id, name, 'height' as metric, height_raw as raw_value from silver where height_raw is not null and height_min_cm is null
    union all by name
    select entity_id, name, 'life_span' as metric, life_span_raw as raw_value from silver where life_span_raw is not null and life_span_min_years is null""",
    kind="defects")
def metric_unparsed(spark, sf):
    from siltstone.plans.checks import violations

    return violations("metric_parsed", {"silver": Layers(spark, sf, "defects").silver})


@query("bucketize", "select entity_id, size_class from explorer")
def bucketized(spark, sf):
    return Layers(spark, sf).explorer.select("entity_id", "size_class")


@query("bucketize_balance", """
    select c_custkey, case when c_acctbal < 0 then null when c_acctbal < 1000 then 'low' when c_acctbal < 5000 then 'middle'
           when c_acctbal is not null then 'high' end as bucket from customer""")
def bucketize_balance(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", bucketize("c_acctbal", [5000, 1000], ["low", "middle", "high"]).alias("bucket")
    )


# ---- gold -----------------------------------------------------------------------------------


@query("dimension", "select * exclude (loaded_at), strftime(loaded_at, '%Y-%m-%d %H:%M:%S') as loaded_at from dim")
def dimension(spark, sf):
    return Layers(spark, sf).dim.withColumn("loaded_at", shown_time("loaded_at"))


@query("tag_bridge", "select entity_id, tag, tag_display from bridge")
def bridge(spark, sf):
    return Layers(spark, sf).bridge


@query("tag_bridge_defects", "select entity_id, tag, tag_display from bridge", kind="defects")
def bridge_defects(spark, sf):
    return Layers(spark, sf, "defects").bridge


@query("tags_part_name", """
    select p_partkey, lower(w) as tag, upper(lower(w)[1]) || lower(w)[2:] as tag_display
    from (select p_partkey, unnest(string_split(p_name, ' ')) as w from part) where w <> '' group by all""")
def tags_part_name(spark, sf):
    return tag_bridge(table(spark, sf, "part"), "p_partkey", "p_name", " ")


@query("class_summary", "select * from summary")
def class_summary(spark, sf):
    return Layers(spark, sf).summary


@query("class_summary_defects", "select * from summary", kind="defects")
def class_summary_defects(spark, sf):
    return Layers(spark, sf, "defects").summary


@query("share_of_class", "select * from shares")
def shares(spark, sf):
    return Layers(spark, sf).shares


@query("share_of_class_joined", "select * from shares")
def shares_joined(spark, sf):
    """The general form: any bridge joined to any dimension."""
    x = Layers(spark, sf)
    return share_of_class(x.bridge, x.dim)


@query("share_of_class_defects", "select * from shares where size_class is not null", kind="defects")
def shares_defects(spark, sf):
    """Weights above all bands have a NULL class, which no class size matches."""
    return Layers(spark, sf, "defects").shares


@query("share_of_class_joined_defects", "select * from shares where size_class is not null", kind="defects")
def shares_joined_defects(spark, sf):
    x = Layers(spark, sf, "defects")
    return share_of_class(x.bridge, x.dim)


@query("scatter_rows", "select * from scatter")
def scatter(spark, sf):
    return Layers(spark, sf).scatter


@query("pairwise_corr", "select * from correlations")
def correlations(spark, sf):
    return Layers(spark, sf).correlations


@query("listwise_corr", """
    select metric_a, metric_b, round(corr(a, b), 3) as correlation, count(*) as n_entities
    from (select unnest([
            {'metric_a': 'weight_mid_kg', 'metric_b': 'life_span_mid_years', 'a': weight_mid_kg, 'b': life_span_mid_years},
            {'metric_a': 'height_mid_cm', 'metric_b': 'life_span_mid_years', 'a': height_mid_cm, 'b': life_span_mid_years},
            {'metric_a': 'height_mid_cm', 'metric_b': 'weight_mid_kg', 'a': height_mid_cm, 'b': weight_mid_kg}], recursive := true)
          from dim where weight_mid_kg + height_mid_cm + life_span_mid_years is not null)
    group by metric_a, metric_b""")
def listwise(spark, sf):
    return pairwise_corr(Layers(spark, sf).dim, marts.CORRELATION_PAIRS, listwise=True)


@query("corr_by_class", """
    select size_class, 'weight_mid_kg' as metric_a, 'life_span_mid_years' as metric_b,
           round(case when isnan(corr(weight_mid_kg, life_span_mid_years)) then null else corr(weight_mid_kg, life_span_mid_years) end, 3) as correlation,
           count(weight_mid_kg + life_span_mid_years) as n_entities
    from dim group by size_class""")
def corr_by_class(spark, sf):
    return pairwise_corr(Layers(spark, sf).dim, marts.CORRELATION_PAIRS[:1], by=["size_class"])


@query("corr_matrix", """
    with m as (select unnest(['weight_mid_kg', 'height_mid_cm', 'life_span_mid_years']) as n),
    long as (select entity_id, n, case n when 'weight_mid_kg' then weight_mid_kg when 'height_mid_cm' then height_mid_cm else life_span_mid_years end as v from dim, m)
    select a.n as metric_a, b.n as metric_b, round(corr(a.v, b.v), 3) as correlation
    from long a join long b using (entity_id) group by all""".replace("with m as", "select * from (with m as") + ")")
def matrix(spark, sf):
    return corr_matrix(Layers(spark, sf).dim, ["weight_mid_kg", "height_mid_cm", "life_span_mid_years"])


@query("corr_lineitem", """
    select * from (
      select 'l_quantity' as metric_a, 'l_extendedprice' as metric_b, round(corr(l_quantity, l_extendedprice), 3) as correlation, count(*) as n_entities from lineitem
      union all select 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 3), count(*) from lineitem)""")
def corr_lineitem(spark, sf):
    return pairwise_corr(table(spark, sf, "lineitem"), [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")])


_COVERAGE = """
    select * exclude (last_refreshed_at), strftime(last_refreshed_at, '%Y-%m-%d %H:%M:%S') as last_refreshed_at from coverage"""


@query("coverage", _COVERAGE)
def coverage(spark, sf):
    return Layers(spark, sf).coverage.withColumn("last_refreshed_at", shown_time("last_refreshed_at"))


@query("coverage_defects", _COVERAGE, kind="defects")
def coverage_defects(spark, sf):
    return Layers(spark, sf, "defects").coverage.withColumn("last_refreshed_at", shown_time("last_refreshed_at"))


@query("coverage_joined", _COVERAGE)
def coverage_joined(spark, sf):
    """The general form: dimension, bridge and silver as three tables."""
    x = Layers(spark, sf)
    return marts.coverage(x.dim, x.bridge, x.silver).withColumn("last_refreshed_at", shown_time("last_refreshed_at"))


@query("coverage_long", """
    select unnest(['total entities', 'with a weight', 'with a life span', 'with both', 'with tags', 'plotted', 'excluded']) as measure,
           unnest([n_total, n_with_weight, n_with_life_span, n_with_both, n_with_tags, n_plotted, n_excluded]) as n_entities
    from coverage""")
def coverage_long(spark, sf):
    return marts.coverage_long(Layers(spark, sf).coverage)


@query("population_consistency", """
    select n_with_both, n_plotted, n_entities as n_correlated, n_with_both = n_plotted and n_plotted = n_entities as consistent
    from coverage, correlations where metric_a = 'weight_mid_kg' and metric_b = 'life_span_mid_years'""")
def population(spark, sf):
    x = Layers(spark, sf)
    return marts.population_consistency(x.coverage, x.correlations)


@query("coverage_documents_labels", """
    select count(*) as n_documents, count(l.doc_id) as n_labelled, count(*) - count(l.doc_id) as n_unlabelled
    from documents left join labels l using (doc_id)""")
def coverage_documents(spark, sf):
    labelled = table(spark, sf, "labels").withColumn("labelled", F.lit(1))
    joined = enrich_left(table(spark, sf, "documents").select("doc_id"), labelled, "doc_id")
    return joined.agg(
        F.count(F.lit(1)).alias("n_documents"), F.count("labelled").alias("n_labelled"),
        F.count_if(F.col("labelled").isNull()).alias("n_unlabelled"),
    )


@query("enrich_left", """
    select d.doc_id, d.lang, d.source, l.quality, l.toxic from documents d left join labels l using (doc_id)""")
def enriched(spark, sf):
    return enrich_left(table(spark, sf, "documents").select("doc_id", "lang", "source"), table(spark, sf, "labels"), "doc_id")


# The labels as an enrichment of the documents, with every kind of defect spread over them.
_LABELS_OFF = """
    select doc_id, quality, toxic from labels
    union all select doc_id, quality, toxic from labels where doc_id % 7 = 0
    union all select null, quality, toxic from labels where doc_id % 5 = 0
    union all select doc_id + 1000000000, 7, toxic from labels where doc_id % 3 = 0
    union all select -1 - doc_id, quality, null from labels where doc_id % 11 = 0"""


def _labels_off(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    at = F.col("doc_id")
    parts = [
        labels.where(at % 7 == 0), labels.where(at % 5 == 0).withColumn("doc_id", F.lit(None).cast("long")),
        labels.where(at % 3 == 0).select((at + 1_000_000_000).alias("doc_id"), F.lit(7).alias("quality"), "toxic"),
        labels.where(at % 11 == 0).select((-1 - at).alias("doc_id"), "quality", F.lit(None).cast("int").alias("toxic")),
    ]
    return union_all(labels, *parts)


_ENUMS = {"quality": (0, 1), "toxic": (0, 1)}


def _enrichment_sql(source):
    return f"""
    with e as ({source})
    select 'doc_id_not_null' as "check", count(*) filter (doc_id is null) as failures from e
    union all select 'doc_id_unique', count(*) from (select doc_id from e where doc_id is not null group by doc_id having count(*) > 1)
    union all select 'doc_id_in_dimension', count(*) from e where doc_id is not null and doc_id not in (select doc_id from documents)
    union all select 'quality_accepted', count(*) from e where quality not in (0, 1)
    union all select 'toxic_accepted', count(*) from e where toxic not in (0, 1)"""


@query("enrichment_checks", _enrichment_sql("select * from labels"), kind=None)
def enrichment_sound(spark, sf):
    return enrichment_checks(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id", _ENUMS)


@query("enrichment_checks_defects", _enrichment_sql(_LABELS_OFF), kind=None)
def enrichment_defects(spark, sf):
    return enrichment_checks(_labels_off(spark, sf), table(spark, sf, "documents"), "doc_id", _ENUMS)


@query("enrichment_kept", "select d.doc_id, d.lang, l.quality, l.toxic from documents d left join labels l using (doc_id)")
def enrichment_kept(spark, sf):
    """A sound enrichment is landed and shown; the next one is refused and leaves it in place."""
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    folder = scratch_path(spark, "enrichment")
    database = database_for(folder, "enrichment")
    ensure_database(spark, database, folder)
    land_enrichment(table(spark, sf, "labels"), documents, database, "labels", "r1", "doc_id", _ENUMS)
    try:
        land_enrichment(_labels_off(spark, sf), documents, database, "labels", "r2", "doc_id", _ENUMS)
    except EnrichmentRejected:
        return enrich_left(documents, spark.table(quoted(f"{database}.labels")), "doc_id")
    raise RuntimeError("a defective enrichment was landed")


@query("top_tags", "select tag, count(*) as n_entities from bridge group by tag")
def tag_ranking(spark, sf):
    return top_tags(Layers(spark, sf).bridge)


@query("relationships", """
    select l_suppkey, l_orderkey from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey)
    and l_orderkey is not null""")
def relationships(spark, sf):
    return orphans(
        table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey"), table(spark, sf, "orders"), "l_orderkey", "o_orderkey"
    )


@query("relationships_unlabelled", "select doc_id, source from documents where doc_id not in (select doc_id from labels)")
def relationships_unlabelled(spark, sf):
    return orphans(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


# ---- bands on given tables ------------------------------------------------------------------


def _banded_counts(df, measure, bands):
    return classify_bands(df.select(measure), measure, bands).groupBy("size_class").agg(F.count(F.lit(1)).alias("n_rows"))


def _banded_sql(measure, source):
    return f"""
        select case when {measure} is null then 'unknown' else label end as size_class, count(*) as n_rows
        from {source} left join bands on {measure} >= min_kg and {measure} < max_kg group by 1"""


for _name, _table, _measure in (
    ("bands_part_size", "part", "p_size"),
    ("bands_balance", "customer", "c_acctbal"),
    ("bands_quantity", "lineitem", "l_quantity"),
):
    query(_name, _banded_sql(_measure, _table))(
        lambda spark, sf, t=_table, m=_measure: _banded_counts(table(spark, sf, t), m, Layers(spark, sf).bands)
    )


# A hundred thousand bands of four currency units with a gap of one behind each: far past one expression.
_FINE = "select 'p' || k as label, 5.0 * k as min_kg, 5.0 * k + 4 as max_kg from (select unnest(range(100000)) as k) t"


@query("band_classify_fine", f"""
    with fine as ({_FINE})
    select l_orderkey, l_linenumber, l_extendedprice, case when l_extendedprice < f.max_kg then f.label end as price_band
    from lineitem asof left join fine f on l_extendedprice >= f.min_kg""")
def band_classify_fine(spark, sf):
    fine = spark.range(100_000).select(
        F.concat(F.lit("p"), "id").alias("label"), (F.col("id") * 5.0).alias("min_kg"), (F.col("id") * 5.0 + 4).alias("max_kg")
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return classify_bands(lines, "l_extendedprice", fine, out="price_band")
