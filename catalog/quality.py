"""Checks, their suite and history, freshness, reconciliation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.base import NUM, SPEC, Layers, js, query, shown_time, table, with_blocks
from catalog.layers import KNOWN_SQL, part_bands
from siltstone.operators.joins import union_all
from siltstone.operators.tags import share_of_class
from siltstone.plans import checks, marts, observe, silver
from siltstone.plans.contracts import CONTRACTS, ContractBroken, conformed, enforce
from siltstone.session import scratch_path, write_scratch

# ---- one query per check, over documents with every kind of defect ---------------------------


def _first(path):
    return f"try_cast(nullif(regexp_extract({js(path)}, {NUM}), '') as double)"


def _uniq(relation, column):
    return f"select {column} from {relation} where {column} is not null group by {column} having count(*) > 1"


def _null(relation, column):
    return f"select 1 from {relation} where {column} is null"


_METRICS = (("weight_raw", "weight_min_kg"), ("height_raw", "height_min_cm"), ("life_span_raw", "life_span_min_years"))

# The band and curated-tag seeds are given tables' groups here, so that the seed checks have
# something to find: bands from part sizes, curated tags from part names.
_PART_BANDS = """select p_type as label, cast(min(p_size) as integer) as min_kg,
    cast(min(p_size) + count(*) % 50 as integer) as max_kg from part group by p_type"""
_PART_TAGS = """select lower(p_name) as tag, cast(case when min(p_size) > 1 then min(p_size) end as integer) as sort_order
    from part group by p_name"""

VIOLATIONS = {
    "weight_min_le_max": "select 1 from silver where weight_min_kg > weight_max_kg",
    "height_min_le_max": "select 1 from silver where height_min_cm > height_max_cm",
    "lifespan_min_le_max": "select 1 from silver where life_span_min_years > life_span_max_years",
    "metric_parsed": " union all ".join(
        f"select 1 from silver where {raw} is not null and {low} is null" for raw, low in _METRICS),
    "metric_shape_known": " union all ".join(
        f"select 1 from silver where not regexp_matches({raw}, {KNOWN_SQL})" for raw, _ in _METRICS),
    "weight_mid_plausible": "select 1 from dim where weight_mid_kg not between 0.5 and 100",
    "lifespan_plausible": "select 1 from dim where life_span_mid_years not between 4 and 25",
    "unit_ratio_plausible": f"""
        select 1 from (select median({_first('weight.imperial')} / {_first('weight.metric')}) as m from newest
                       where {_first('weight.imperial')} > 0 and {_first('weight.metric')} > 0) where m not between 2.095 and 2.315
        union all
        select 1 from (select median({_first('height.metric')} / {_first('height.imperial')}) as m from newest
                       where {_first('height.imperial')} > 0 and {_first('height.metric')} > 0) where m not between 2.413 and 2.667""",
    "no_entity_unbanded": "select 1 from dim where weight_mid_kg is not null and size_class = 'unknown'",
    "no_entity_lost": f"""
        select 1 from (select count(distinct {js('name')}) as e from newest), (select count(*) as a from dim) x where a <> e""",
    "pct_of_class_sane": "select 1 from shares where n_entities > n_in_class or pct_of_class <= 0 or pct_of_class > 100",
    "tag_lowercased": "select 1 from bridge where tag <> lower(tag) or tag <> trim(tag)",
    "tag_unique_per_entity": "select 1 from bridge group by entity_id, tag having count(*) > 1",
    "source_tag_not_duplicated": """
        select 1 from pieces where trim(piece) <> '' group by entity_id, lower(trim(piece)) having count(*) > 1""",
    "tag_not_freetext": "select 1 from bridge where len(string_split(tag, ' ')) > 3",
    "unknown_bucket_small": """
        select 1 from (select avg((coalesce(size_class, '') = 'unknown')::int) * 100 as pct from dim) where pct > 1""",
    "lifespan_null_rate_stable": "select 1 from (select avg((life_span_mid_years is null)::int) * 100 as pct from dim) where pct > 10",
    "silver_id_unique": _uniq("silver", "entity_id"),
    "silver_id_not_null": _null("silver", "entity_id"),
    "silver_name_unique": _uniq("silver", "name"),
    "silver_name_not_null": _null("silver", "name"),
    "dim_id_unique": _uniq("dim", "entity_id"),
    "dim_id_not_null": _null("dim", "entity_id"),
    "dim_name_unique": _uniq("dim", "name"),
    "dim_name_not_null": _null("dim", "name"),
    "dim_class_not_null": _null("dim", "size_class"),
    "dim_class_accepted": "select 1 from dim where size_class not in ('toy', 'small', 'medium', 'large', 'giant', 'unknown')",
    "tags_in_dim": "select 1 from bridge where entity_id not in (select entity_id from dim)",
    "scatter_id_unique": _uniq("scatter", "entity_id"),
    "correlation_not_null": _null("correlations", "correlation"),
}
SEED_VIOLATIONS = {
    "bands_cover": """
        select 1 from (select *, lead(min_kg) over (order by min_kg nulls last, label nulls last) as nxt from {bands}),
             (values (1), (2)) v(kind)
        where (kind = 1 and min_kg >= max_kg) or (kind = 2 and max_kg <> nxt)""",
    "bands_label_unique": _uniq("{bands}", "label"),
    "bands_label_not_null": _null("{bands}", "label"),
    "bands_min_not_null": _null("{bands}", "min_kg"),
    "bands_max_not_null": _null("{bands}", "max_kg"),
    "curated_tag_unique": _uniq("{curated}", "tag"),
    "curated_tag_in_tags": "select 1 from {curated} where tag not in (select tag from {tags})",
    "curated_order_not_null": _null("{curated}", "sort_order"),
    "curated_order_unique": _uniq("{curated}", "sort_order"),
}
_DERIVED = {"bands": f"({_PART_BANDS}) pb", "curated": f"({_PART_TAGS}) pt", "tags": "bridge"}
_SEEDS = {"bands": "bands", "curated": "curated", "tags": "bridge"}


def _inputs(x: Layers, names):
    """Only the tables a check reads."""
    made = {
        "raw": lambda: x.bronze,
        "silver": lambda: x.silver,
        "silver_tags": lambda: x.bridge,
        "dim": lambda: x.dim,
        "tags": lambda: x.bridge,
        "scatter": lambda: x.scatter,
        "correlations": lambda: x.correlations,
        "class_tags": lambda: x.shares,
        "bands": lambda: part_bands(x.spark, x.sf_dir),
        "curated": lambda: table(x.spark, x.sf_dir, "part").groupBy(F.lower("p_name").alias("tag")).agg(
            F.min("p_size").alias("low")
        ).select("tag", F.when(F.col("low") > 1, F.col("low")).alias("sort_order")),
    }
    return {n: made[n]() for n in names}


def _one_check(name):
    def build(spark, sf):
        check = checks.BY_NAME[name]
        return checks.count_check(name, _inputs(Layers(spark, sf, "defects"), check.inputs))

    return build


for _name in checks.BY_NAME:
    _body = VIOLATIONS.get(_name) or SEED_VIOLATIONS[_name].format(**_DERIVED)
    query(f"chk_{_name}", f"select '{_name}' as \"check\", count(*) as failures from ({_body})", kind="defects")(
        _one_check(_name)
    )


@query("unbanded_strict", """
    select entity_id, name, weight_mid_kg, size_class from dim
    where weight_mid_kg is not null and (size_class is null or size_class = 'unknown')""", kind="defects")
def unbanded_strict(spark, sf):
    """The weights that fall into no band: the class is NULL and not 'unknown'."""
    return checks.unbanded_rows(Layers(spark, sf, "defects").dim, strict=True)


# ---- the whole suite ------------------------------------------------------------------------


def _suite_sql(run_id):
    parts = []
    for c in checks.CHECKS:
        body = VIOLATIONS.get(c.name) or SEED_VIOLATIONS[c.name].format(**_SEEDS)
        parts.append(f"select '{c.name}' as \"check\", '{c.severity}' as severity, count(*) as failures from ({body})")
    union = " union all ".join(parts)
    return f"""
        select '{run_id}' as run_id, "check", severity, failures,
               case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status
        from ({union})"""


def stored_tables(spark, sf, kind):
    """Every table written once, as a run does, so that the checks read stored tables."""
    x = Layers(spark, sf, kind)
    t = {"raw": x.bronze, "bands": x.bands, "curated": x.curated}
    t["silver"] = write_scratch(x.silver, f"silver-{kind}")
    t["silver_tags"] = write_scratch(silver.bridge(t["silver"], SPEC), f"silver-tags-{kind}")
    t["tags"] = t["silver_tags"]
    t["dim"] = write_scratch(marts.dimension(t["silver"], t["bands"]), f"dim-{kind}")
    t["class_summary"] = marts.class_summary(t["dim"])
    t["scatter"] = marts.scatter_rows(t["dim"])
    t["correlations"] = marts.correlations(t["dim"])
    t["class_tags"] = share_of_class(t["tags"], t["dim"])
    t["coverage"] = marts.coverage(t["dim"], t["tags"], t["silver"])
    return t


def _suite(spark, sf, kind, run_id):
    results = checks.run_suite(stored_tables(spark, sf, kind), run_id)
    return results.select("run_id", "check", "severity", "failures", "status")


@query("check_suite", _suite_sql("r1"))
def check_suite(spark, sf):
    return _suite(spark, sf, "scaled", "r1")


@query("check_suite_defects", _suite_sql("r2"), kind="defects")
def check_suite_defects(spark, sf):
    return _suite(spark, sf, "defects", "r2")


@query("result_summary", f"select status, count(*) as n from ({_suite_sql('r1')}) group by status")
def result_summary(spark, sf):
    return observe.status_counts(_suite(spark, sf, "scaled", "r1"))


@query("severity_accounting", f"""
    select severity, count(*) as n_checks, count(*) filter (status = 'pass') as n_passed, sum(failures) as n_violations
    from ({_suite_sql('r1')}) group by severity""")
def severity_accounting(spark, sf):
    """How many checks of each severity a run holds: 33 that stop it and 6 that warn."""
    results = checks.run_suite(stored_tables(spark, sf, "scaled"), "r1")
    return results.groupBy("severity").agg(
        F.count(F.lit(1)).alias("n_checks"), F.count_if(F.col("status") == "pass").alias("n_passed"), F.sum("failures").alias("n_violations")
    )


@query("fired_warnings", f"""
    select "check", failures, failures || ' violating rows' as message from ({_suite_sql('r2')}) where status = 'warn'""",
    kind="defects")
def fired_warnings(spark, sf):
    results = checks.run_suite(stored_tables(spark, sf, "defects"), "r2")
    return observe.fired_warnings(results)


@query("blocking_results", f"""select "check", severity, status from ({_suite_sql('r2')}) where status = 'fail'""", kind="defects")
def blocking_results(spark, sf):
    """What stops a publish: failures, and never a warning."""
    return checks.blocking(checks.run_suite(stored_tables(spark, sf, "defects"), "r2")).select("check", "severity", "status")


@query("second_limits", f"""
    select "check", failures, case when failures = 0 then 'pass' when severity = 'warn' and failures <= 5 then 'warn' else 'fail' end as status
    from ({_suite_sql('r2')})""", kind="defects")
def second_limits(spark, sf):
    """Warnings with a second limit of five violations, past which they fail."""
    limits = {c.name: 5 for c in checks.CHECKS if c.severity == "warn"}
    results = checks.run_suite(stored_tables(spark, sf, "defects"), "r2", error_above=limits)
    return results.select("check", "failures", "status")


@query("drills", f"""
    select "check", status from ({_suite_sql('r1')})
    union all select * from (values ('forced_failure', 'fail'), ('forced_warning', 'warn')) d""")
def drills(spark, sf):
    """The suite with both drills on: the two checks that always fire stand beside the others."""
    results = checks.run_suite(stored_tables(spark, sf, "scaled"), "r1", force_failure=True, force_warning=True)
    return results.select("check", "status")


@query("contract_class_tags", "select * from shares")
def contract_class_tags(spark, sf):
    return enforce("class_tags", Layers(spark, sf).shares)


def _declared(spark, sf, name, df):
    """A table with its columns in another order, written under its contract and read back."""
    path = scratch_path(spark, f"contract-{name}")
    conformed(name, df.select(*reversed(df.columns))).write.parquet(path)
    read = spark.read.parquet(path)
    if read.columns != CONTRACTS[name].fieldNames():
        raise ContractBroken(f"{name}: written as {read.columns}")
    return read


@query("contract_tags", "select entity_id, tag, tag_display from bridge")
def contract_tags(spark, sf):
    return _declared(spark, sf, "tags", Layers(spark, sf).bridge)


@query("contract_class_summary", "select * from summary")
def contract_class_summary(spark, sf):
    return _declared(spark, sf, "class_summary", Layers(spark, sf).summary)


@query("contract_scatter", "select * from scatter")
def contract_scatter(spark, sf):
    return _declared(spark, sf, "scatter", Layers(spark, sf).scatter)


@query("contract_correlations", "select * from correlations")
def contract_correlations(spark, sf):
    return _declared(spark, sf, "correlations", Layers(spark, sf).correlations)


@query("contract_class_tags_written", "select * from shares")
def contract_class_tags_written(spark, sf):
    return _declared(spark, sf, "class_tags", Layers(spark, sf).shares)


@query("contract_coverage", """
    select * exclude (last_refreshed_at), strftime(last_refreshed_at, '%Y-%m-%d %H:%M:%S') as last_refreshed_at from coverage""")
def contract_coverage(spark, sf):
    written = _declared(spark, sf, "coverage", Layers(spark, sf).coverage)
    return written.withColumn("last_refreshed_at", shown_time("last_refreshed_at"))


# By table: where its rows stand in the SQL, its first column, and its last one with its type.
_LAST = (
    ("tags", "bridge", "entity_id", "tag_display", "string"), ("class_summary", "summary", "size_class", "mean_height_cm", "double"),
    ("scatter", "scatter", "entity_id", "life_span_mid_years", "double"), ("correlations", "correlations", "metric_a", "n_entities", "bigint"),
    ("class_tags", "shares", "size_class", "pct_of_class", "double"), ("coverage", "coverage", "n_total", "last_refreshed_at", "timestamp"),
)


@query("contract_refusals", " union all ".join(f"""
    select '{name}' as table_name, unnest(['{first} is missing', 'surplus is not declared', '{last} is binary, declared {kind}']) as problem,
           (select count(*) from {source}) as n_rows""" for name, source, first, last, kind in _LAST))
def contract_refusals(spark, sf):
    """Every table without its first column, with a surplus one and with its last one as bytes: what the write says
    when it refuses them, beside the rows that were not written."""
    x = Layers(spark, sf)
    made = {"tags": x.bridge, "class_summary": x.summary, "scatter": x.scatter, "correlations": x.correlations, "class_tags": x.shares, "coverage": x.coverage}
    refused = []
    for name, df in made.items():
        first, last = CONTRACTS[name].fieldNames()[0], CONTRACTS[name].fieldNames()[-1]
        broken = df.drop(first).withColumn(last, F.col(last).cast("string").cast("binary")).withColumn("surplus", F.lit(1))
        try:
            conformed(name, broken).write.parquet(scratch_path(spark, f"contract-{name}"))
        except ContractBroken as refusal:
            problems = F.split(F.lit(str(refusal).removeprefix(f"{name}: ")), "; ")
            counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
            refused.append(counted.select(F.lit(name).alias("table_name"), F.explode(problems).alias("problem"), "n_rows"))
    return union_all(*refused)


# ---- history --------------------------------------------------------------------------------

# Three runs, each a suite over stored tables: the sound documents, those with defects, the sound ones again. Their
# ids sort against their order in time.
RUNS = (("r3", "scaled"), ("r2", "defects"), ("r1", "scaled"))


def _run_sql(kind):
    return with_blocks(_suite_sql("run"), kind)


def run_history(spark, sf):
    """The results of the three runs, appended to the store and read back."""
    path = scratch_path(spark, "history")
    tables = {kind: stored_tables(spark, sf, kind) for kind in ("scaled", "defects")}
    for day, (run_id, kind) in enumerate(RUNS, 2):
        observe.append_results(checks.run_suite(tables[kind], run_id), path, date(2024, 1, day))
    return spark.read.parquet(path)


@query("check_transitions", f"""
    with sound as ({_run_sql("scaled")}), defects as ({_run_sql("defects")}),
    moved as (select "check", d.status as later, s.status as earlier from sound s join defects d using ("check") where s.status <> d.status)
    select "check", 'r2' as run_id, later as status, earlier as previous_status from moved
    union all select "check", 'r1', earlier, later from moved""", kind=None)
def check_transitions(spark, sf):
    return observe.transitions(run_history(spark, sf)).drop("started_at")


@query("check_history", f"""
    with sound as ({_run_sql("scaled")}), defects as ({_run_sql("defects")})
    select "check", status, day as run_date, true as timed from sound, (values ('2024-01-02'), ('2024-01-04')) d(day)
    union all select "check", status, '2024-01-03', true from defects""", kind=None)
def check_history(spark, sf):
    timed = F.col("started_at").isNotNull() & (F.col("seconds") >= 0)
    return run_history(spark, sf).select("check", "status", F.col("run_date").cast("string").alias("run_date"), timed.alias("timed"))


@query("freshness", """
    select strftime(max(loaded_at), '%Y-%m-%d %H:%M:%S') as loaded_at,
           date_diff('second', max(loaded_at), timestamp '2024-01-04 00:00:00') / 3600.0::double as age_hours,
           case when date_diff('second', max(loaded_at), timestamp '2024-01-04 00:00:00') <= 36 * 3600 then 'pass' else 'warn' end as status
    from bronze""")
def freshness(spark, sf):
    found = observe.freshness(Layers(spark, sf).bronze, "2024-01-04 00:00:00")
    return found.withColumn("loaded_at", shown_time("loaded_at"))


def _event_freshness_sql(as_of):
    age = f"date_diff('second', date_trunc('second', max(ts)), timestamp '{as_of}')"
    return f"""
    select strftime(max(ts), '%Y-%m-%d %H:%M:%S') as loaded_at, {age} / 3600.0::double as age_hours,
           case when {age} <= 36 * 3600 then 'pass' else 'warn' end as status
    from events"""


def _event_freshness(spark, sf, as_of):
    events = table(spark, sf, "events").select(F.date_trunc("second", "ts").cast("timestamp").alias("loaded_at"))
    return observe.freshness(events, as_of).withColumn("loaded_at", shown_time("loaded_at"))


@query("freshness_events", _event_freshness_sql("2024-01-31 00:00:00"))
def freshness_events(spark, sf):
    return _event_freshness(spark, sf, "2024-01-31 00:00:00")


@query("freshness_events_stale", _event_freshness_sql("2024-02-15 00:00:00"))
def freshness_events_stale(spark, sf):
    """The same load two weeks later: a warning."""
    return _event_freshness(spark, sf, "2024-02-15 00:00:00")


# ---- reconciliation -------------------------------------------------------------------------


# What the stored tables are called in the SQL.
_STORED = {
    "raw": "bronze", "bands": "bands", "curated": "curated", "silver": "silver", "silver_tags": "bridge", "tags": "bridge",
    "dim": "dim", "class_summary": "summary", "scatter": "scatter", "correlations": "correlations", "class_tags": "shares",
    "coverage": "coverage",
}


def _metrics_sql(kind):
    parts = [f"select '{name}.rows' as metric, cast(count(*) as double) as value from {block}" for name, block in _STORED.items()]
    for name, keys in observe.FIGURES.items():
        label = " || '.' || ".join([f"'{name}'", *keys])
        numbers = [f.name for f in CONTRACTS[name].fields if isinstance(f.dataType, T.NumericType)]
        parts += [f"select {label} || '.{c}', cast({c} as double) from {_STORED[name]}" for c in numbers]
    return with_blocks(f"select * from ({' union all '.join(parts)}) where value is not null", kind)


@query("reconcile_metrics", f"""
    with now as ({_metrics_sql("scaled")}), earlier as ({_metrics_sql("earlier")})
    select coalesce(a.metric, e.metric) as metric, a.value as actual, e.value as expected,
           case when e.value is null then 'unexpected' when a.value is null then 'missing'
                when abs(a.value - e.value) <= 1e-9 then 'ok' else 'differs' end as state
    from now a full join earlier e on a.metric = e.metric""", kind=None)
def reconcile_metrics(spark, sf):
    """The figures of this run against those that an earlier run, with fewer documents, has stored."""
    path = scratch_path(spark, "figures")
    observe.watched_metrics(stored_tables(spark, sf, "earlier")).write.parquet(path)
    return observe.reconcile_metrics(observe.watched_metrics(stored_tables(spark, sf, "scaled")), spark.read.parquet(path))
