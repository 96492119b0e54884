"""Every check passes on clean tables and fires on one mutation of them."""

import pytest
from pyspark.sql import functions as F

from catalog.base import SPEC
from siltstone.plans import checks, marts, observe, silver
from siltstone.operators.tags import share_of_class
from catalog import fixtures
from siltstone.sources.files import curated_tags, size_bands


@pytest.fixture(scope="module")
def tables(spark, sf):
    raw = fixtures.bronze(spark, sf, "sound").where("entity_id < 400").cache()
    s = silver.entities(raw, SPEC).cache()
    t = {"raw": raw, "silver": s, "bands": size_bands(spark), "curated": curated_tags(spark)}
    t["silver_tags"] = t["tags"] = silver.bridge(s, SPEC).cache()
    t["dim"] = marts.dimension(s, t["bands"]).cache()
    t["class_summary"] = marts.class_summary(t["dim"]).cache()
    t["scatter"] = marts.scatter_rows(t["dim"])
    t["correlations"] = marts.correlations(t["dim"]).cache()
    t["class_tags"] = share_of_class(t["tags"], t["dim"]).cache()
    t["coverage"] = marts.coverage(t["dim"], t["tags"], s).cache()
    return t


def first(df, **values):
    """The table with some columns of one complete entity replaced."""
    one = F.col("entity_id") == 3
    assert df.where(one).count() == 1
    new = {c: F.when(one, F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()}
    return df.withColumns(new)


def again(df, n=1):
    return df.unionByName(df.orderBy(df.columns[0]).limit(n))


def every(df, column, value):
    return df.withColumn(column, value)


def _renamed(raw):
    return raw.withColumn("payload", F.regexp_replace("payload", '"imperial":"', '"imperial":"9'))


MUTATIONS = {
    "weight_min_le_max": lambda t: {"silver": first(t["silver"], weight_min_kg=9999.0)},
    "height_min_le_max": lambda t: {"silver": first(t["silver"], height_min_cm=9999.0)},
    "lifespan_min_le_max": lambda t: {"silver": first(t["silver"], life_span_min_years=99)},
    "metric_parsed": lambda t: {"silver": first(t["silver"], weight_raw="n/a", weight_min_kg=None)},
    "metric_shape_known": lambda t: {"silver": first(t["silver"], weight_raw="3.5 kg (7.7 lb)")},
    "weight_mid_plausible": lambda t: {"dim": first(t["dim"], weight_mid_kg=101.0)},
    "lifespan_plausible": lambda t: {"dim": first(t["dim"], life_span_mid_years=150.0)},
    "unit_ratio_plausible": lambda t: {"raw": _renamed(t["raw"])},
    "bands_cover": lambda t: {"bands": t["bands"].where("label <> 'medium'")},
    "no_entity_unbanded": lambda t: {"dim": first(t["dim"], size_class="unknown", weight_mid_kg=7.0)},
    "no_entity_lost": lambda t: {"dim": t["dim"].where("entity_id > 100")},
    "pct_of_class_sane": lambda t: {"class_tags": every(t["class_tags"], "pct_of_class", F.lit(100.1))},
    "tag_lowercased": lambda t: {"silver_tags": every(t["silver_tags"], "tag", F.initcap("tag"))},
    "tag_unique_per_entity": lambda t: {"silver_tags": again(t["silver_tags"])},
    "source_tag_not_duplicated": lambda t: {"silver": first(t["silver"], tags_raw="Loyal, loyal,")},
    "tag_not_freetext": lambda t: {"silver_tags": every(t["silver_tags"], "tag", F.lit("one two three four"))},
    "unknown_bucket_small": lambda t: {"dim": every(t["dim"], "size_class", F.when(F.col("entity_id") % 50 == 0, "unknown").otherwise("toy"))},
    "lifespan_null_rate_stable": lambda t: {"dim": every(t["dim"], marts.LIFE, F.when(F.col("entity_id") % 8 != 0, 9.0))},
    "silver_id_unique": lambda t: {"silver": again(t["silver"])},
    "silver_id_not_null": lambda t: {"silver": first(t["silver"], entity_id=None)},
    "silver_name_unique": lambda t: {"silver": every(t["silver"], "name", F.lit("same"))},
    "silver_name_not_null": lambda t: {"silver": first(t["silver"], name=None)},
    "dim_id_unique": lambda t: {"dim": again(t["dim"])},
    "dim_id_not_null": lambda t: {"dim": first(t["dim"], entity_id=None)},
    "dim_name_unique": lambda t: {"dim": again(t["dim"])},
    "dim_name_not_null": lambda t: {"dim": first(t["dim"], name=None)},
    "dim_class_not_null": lambda t: {"dim": first(t["dim"], size_class=None)},
    "dim_class_accepted": lambda t: {"dim": first(t["dim"], size_class="colossal")},
    "tags_in_dim": lambda t: {"dim": t["dim"].where("entity_id > 100")},
    "scatter_id_unique": lambda t: {"scatter": again(t["scatter"])},
    "correlation_not_null": lambda t: {"correlations": every(t["correlations"], "correlation", F.lit(None).cast("double"))},
    "bands_label_unique": lambda t: {"bands": again(t["bands"])},
    "bands_label_not_null": lambda t: {"bands": every(t["bands"], "label", F.lit(None).cast("string"))},
    "bands_min_not_null": lambda t: {"bands": every(t["bands"], "min_kg", F.lit(None).cast("int"))},
    "bands_max_not_null": lambda t: {"bands": every(t["bands"], "max_kg", F.lit(None).cast("int"))},
    "curated_tag_unique": lambda t: {"curated": again(t["curated"])},
    "curated_tag_in_tags": lambda t: {"curated": every(t["curated"], "tag", F.initcap("tag"))},
    "curated_order_not_null": lambda t: {"curated": every(t["curated"], "sort_order", F.lit(None).cast("int"))},
    "curated_order_unique": lambda t: {"curated": every(t["curated"], "sort_order", F.lit(1))},
}


def test_every_check_has_a_mutation():
    assert set(MUTATIONS) == set(checks.BY_NAME)


def test_clean_tables_pass(tables):
    results = checks.run_suite(tables, "clean").collect()
    assert len(results) == 39
    assert {r["check"]: r["status"] for r in results if r["status"] != "pass"} == {}


@pytest.mark.parametrize("name", sorted(MUTATIONS))
def test_mutation_fires(tables, name):
    check = checks.BY_NAME[name]
    mutated = {**tables, **MUTATIONS[name](tables)}
    rows = checks.violations(name, mutated).count()
    assert rows > 0
    result = checks.run_suite(mutated, "m", checks=[check]).first()
    assert result["failures"] == rows
    assert result["status"] == ("warn" if check.severity == "warn" else "fail")


def test_missing_table_is_an_error_and_not_left_out(tables):
    partial = {k: v for k, v in tables.items() if k != "dim"}
    results = {r["check"]: r for r in checks.run_suite(partial, "p").collect()}
    assert len(results) == 39
    assert results["dim_id_unique"]["status"] == "error" and "dim" in results["dim_id_unique"]["message"]
    assert results["no_entity_lost"]["status"] == "error"


def test_second_threshold_turns_a_warning_into_a_failure(tables):
    mutated = {**tables, **MUTATIONS["tag_not_freetext"](tables)}
    check = [checks.BY_NAME["tag_not_freetext"]]
    assert checks.run_suite(mutated, "x", checks=check, error_above={"tag_not_freetext": 10**6}).first()["status"] == "warn"
    assert checks.run_suite(mutated, "x", checks=check, error_above={"tag_not_freetext": 1}).first()["status"] == "fail"


def test_limits_are_parameters(tables):
    check = [checks.BY_NAME["lifespan_null_rate_stable"]]
    strict = checks.Limits(max_null_pct=1)
    assert checks.run_suite(tables, "x", strict, check).first()["status"] == "warn"


def test_untrimmed_names_count_as_lost(spark):
    """Names are deduplicated trimmed and counted untrimmed; a NULL name survives uncounted."""
    payloads = ['{"id":"1","name":"A"}', '{"id":"2","name":"A "}']
    for texts, lost in ((payloads, -1), (['{"id":"1","name":"A"}', '{"id":"2"}'], 1)):
        raw = spark.createDataFrame([(i, p) for i, p in enumerate(texts)], "entity_id int, payload string").select(
            "*", F.lit("2024-01-01").cast("date").alias("run_date"), F.lit("2024-01-01").cast("timestamp").alias("loaded_at")
        )
        dim = marts.dimension(silver.entities(raw), size_bands(spark))
        assert checks.violations("no_entity_lost", {"raw": raw, "dim": dim}).first()["lost"] == lost


def test_unbanded_strict_sees_a_gap(spark):
    dim = spark.createDataFrame([(1, "a", 5.5, None), (2, "b", None, "unknown")], "entity_id int, name string, weight_mid_kg double, size_class string")
    assert checks.unbanded_rows(dim).count() == 0
    assert checks.unbanded_rows(dim, strict=True).count() == 1


def test_reconciliation_states(spark, tables):
    actual = observe.watched_metrics(tables)
    names = [r["metric"] for r in actual.collect()]
    assert len(names) == len(set(names)) and {f"{t}.rows" for t in tables} <= set(names)
    assert "class_summary.toy.n_entities" in names and "coverage.n_total" in names
    expected = spark.createDataFrame([("dim.rows", -1.0), ("gone", 2.0)], "metric string, value double")
    states = {r["metric"]: r["state"] for r in observe.reconcile_metrics(actual, expected).collect()}
    assert states["dim.rows"] == "differs" and states["gone"] == "missing" and states["raw.rows"] == "unexpected"
    assert set(observe.reconcile_metrics(actual, actual).select("state").distinct().collect()[0]) == {"ok"}


def test_result_summary_and_transitions(spark):
    """Runs follow each other by time, whatever their ids."""
    rows = [("z", 1, "a", "pass"), ("c", 2, "a", "fail"), ("m", 3, "a", "fail"), ("z", 1, "b", "warn"), ("c", 2, "b", "skipped")]
    history = spark.createDataFrame(rows, "run_id string, started_at long, check string, status string")
    history = history.withColumn("started_at", F.timestamp_seconds("started_at"))
    moved = observe.transitions(history).collect()
    assert {(r["check"], r["run_id"], r["previous_status"], r["status"]) for r in moved} == {
        ("a", "c", "pass", "fail"), ("b", "c", "warn", "skipped")
    }
    assert observe.test_total(history).first()[0] == 4
    assert {r["status"]: r["n"] for r in observe.status_counts(history).collect()} == {"pass": 1, "fail": 2, "warn": 1, "skipped": 1}


def test_freshness_limit(spark):
    bronze = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("loaded_at"))
    assert observe.freshness(bronze, "2024-01-02 12:00:00").first()["status"] == "pass"
    assert observe.freshness(bronze, "2024-01-02 12:00:01").first()["status"] == "warn"
