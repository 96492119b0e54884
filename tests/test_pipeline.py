"""The whole run: publish all or nothing, skip after a failure, keep the history."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone.plans import checks, pipeline
from siltstone.plans.checks import CHECKS
from siltstone.plans.contracts import CONTRACTS, ContractBroken, conformed, differences, enforce
from siltstone.plans.pipeline import GOLD, Run, run
from siltstone.plans.publish import NothingToPublish, Superseded, live_runs, materialize, publish, read_published
from siltstone.plans.silver import SilverSpec
from catalog import fixtures
from siltstone.sources.tables import ensure_database, shown_run, tables_of

SPEC = SilverSpec(tag_sentinels=(fixtures.FREE_TEXT_TAG,))


def go(spark, sf, base, kind="sound", **options):
    settings = Run(str(base), spec=SPEC, run_date=date(2024, 1, 2), **options)
    return settings, run(spark, settings, fixtures.bronze(spark, sf, kind))


def statuses(report):
    return {r["check"]: r["status"] for r in report.results}


def test_prod_run_publishes_then_a_failing_run_changes_nothing(spark, sf, tmp_path):
    settings, report = go(spark, sf, tmp_path, run_id="r1")
    assert report.published and sorted(report.tables) == sorted(GOLD)
    found = statuses(report)
    assert len(found) == 39 and set(found.values()) <= {"pass", "warn"}
    before = read_published(spark, settings.gold, "coverage").collect()
    for name, contract in CONTRACTS.items():
        assert not differences(read_published(spark, settings.gold, name), contract)

    _, failed = go(spark, sf, tmp_path, kind="defects", run_id="r2")
    assert not failed.published
    found = statuses(failed)
    assert found["metric_parsed"] == "fail" and found["dim_id_unique"] == "skipped"
    assert found["table coverage"] == "skipped"
    assert read_published(spark, settings.gold, "coverage").collect() == before
    assert set(live_runs(spark, settings.gold, GOLD).values()) == {"r1"}

    history = pipeline.check_history(spark, settings)
    runs = {r["run_id"] for r in history.select("run_id").distinct().collect()}
    assert runs == {"r1", "r2"}


def test_drills(spark, sf, tmp_path):
    _, report = go(spark, sf, tmp_path, run_id="f", force_failure=True)
    assert not report.published and statuses(report)["forced_failure"] == "fail"
    _, report = go(spark, sf, tmp_path, run_id="w", force_warning=True, silver_as="view")
    assert report.published and statuses(report)["forced_warning"] == "warn"


def test_dev_builds_straight_into_what_is_read(spark, sf, tmp_path):
    settings, report = go(spark, sf, tmp_path, kind="sound", run_id="d1", target="dev")
    assert report.published
    assert read_published(spark, settings.gold, "dim").count() > 0
    settings, report = go(spark, sf, tmp_path, kind="defects", run_id="d2", target="dev")
    assert not report.published and shown_run(spark, settings.gold, "dim") == "d1"
    settings, report = go(spark, sf, tmp_path, kind="sound", run_id="d3", target="dev")
    assert set(live_runs(spark, settings.gold, GOLD).values()) == {"d3"}


def test_build_error_is_recorded_and_nothing_is_published(spark, sf, tmp_path, monkeypatch):
    def broken(_dim):
        raise ContractBroken("scatter: lost a column")

    monkeypatch.setattr(pipeline.marts, "scatter_rows", broken)
    with pytest.raises(ContractBroken):
        go(spark, sf, tmp_path, run_id="x")
    settings = Run(str(tmp_path), run_id="x")
    rows = pipeline.check_history(spark, settings).where("check = 'build'").collect()
    assert rows[0]["status"] == "error"
    assert set(live_runs(spark, settings.gold, GOLD).values()) == {None}


def test_publish_needs_finished_tables(spark, tmp_path):
    ensure_database(spark, "gold_a", str(tmp_path / "gold"))
    with pytest.raises(NothingToPublish):
        publish(spark, "gold_a", "v1")
    materialize(spark.range(3), "a", "table", "gold_a", "v1")
    with pytest.raises(NothingToPublish):
        read_published(spark, "gold_a", "a")
    with pytest.raises(NothingToPublish, match="b"):
        publish(spark, "gold_a", "v1", ["a", "b"])
    assert publish(spark, "gold_a", "v1", ["a"]) == ["a"]
    materialize(spark.range(5), "a", "table", "gold_a", "v2")
    assert read_published(spark, "gold_a", "a").count() == 3
    publish(spark, "gold_a", "v2", drop_old=True)
    assert read_published(spark, "gold_a", "a").count() == 5
    assert tables_of(spark, "gold_a", "v1") == [] and not (tmp_path / "gold" / "a__v1").exists()


def test_publish_refuses_to_undo_another_writer(spark, tmp_path):
    ensure_database(spark, "gold_b", str(tmp_path / "gold"))
    before = live_runs(spark, "gold_b", ["a"])
    for run_id in ("v1", "v2"):
        materialize(spark.range(3), "a", "table", "gold_b", run_id)
    publish(spark, "gold_b", "v1", seen=before)
    live = live_runs(spark, "gold_b", ["a"])
    with pytest.raises(Superseded):
        publish(spark, "gold_b", "v2", seen=before)
    assert live_runs(spark, "gold_b", ["a"]) == live == {"a": "v1"}
    publish(spark, "gold_b", "v2", seen=live)
    assert live_runs(spark, "gold_b", ["a"]) == {"a": "v2"}


def test_a_publish_that_died_between_two_views_is_completed(spark, tmp_path, monkeypatch):
    from siltstone.plans import publish as module

    ensure_database(spark, "gold_c", str(tmp_path / "gold"))
    for run_id in ("v1", "v2"):
        for name in ("a", "b"):
            materialize(spark.range(3), name, "table", "gold_c", run_id)
    publish(spark, "gold_c", "v1")
    seen, whole = live_runs(spark, "gold_c", ["a", "b"]), module.show_run

    def dies(spark, database, names, run_id):
        whole(spark, database, names[:1], run_id)
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "show_run", dies)
    with pytest.raises(RuntimeError, match="lost"):
        publish(spark, "gold_c", "v2", seen=seen)
    monkeypatch.undo()
    assert live_runs(spark, "gold_c", ["a", "b"]) == {"a": "v2", "b": "v1"}
    publish(spark, "gold_c", "v2", seen=seen)
    assert live_runs(spark, "gold_c", ["a", "b"]) == {"a": "v2", "b": "v2"}


def test_run_ids_are_lower_case_words(spark):
    with pytest.raises(ValueError, match="run id"):
        materialize(spark.range(1), "a", "table", "gold_d", "R-1")


def test_contract_differences():
    contract = CONTRACTS["correlations"]
    assert "correlation" in contract.fieldNames()


def test_contract_enforcement(spark):
    good = spark.createDataFrame([], CONTRACTS["correlations"])
    assert enforce("correlations", good) is good
    with pytest.raises(ContractBroken, match="n_entities is int, declared bigint"):
        enforce("correlations", good.withColumn("n_entities", F.col("n_entities").cast("int")))
    with pytest.raises(ContractBroken, match="metric_a is missing; x is not declared"):
        enforce("correlations", good.withColumnRenamed("metric_a", "x"))


def test_what_is_written_has_the_contract_in_order(spark):
    turned = spark.createDataFrame([(1, 0.5, "b", "a")], "n_entities bigint, correlation double, metric_b string, metric_a string")
    assert conformed("correlations", turned).columns == CONTRACTS["correlations"].fieldNames()
    assert tuple(conformed("correlations", turned).first()) == ("a", "b", 0.5, 1)
    for broken in (turned.drop("metric_a"), turned.withColumn("x", F.lit(1)), turned.withColumn("n_entities", F.lit(1))):
        with pytest.raises(ContractBroken):
            conformed("correlations", broken)
    assert conformed("dim", turned) is turned


def test_severities_and_roles():
    errors = [c for c in CHECKS if c.severity == "error"]
    assert (len(CHECKS), len(errors)) == (39, 33)
    roles = {r: sum(c.role == r for c in CHECKS) for r in {c.role for c in CHECKS}}
    assert roles == {"error": 18, "warn": 6, "regression guard": 8, "seed integrity": 7}


def test_run_from_landed_days(spark, sf, tmp_path):
    from datetime import datetime

    from siltstone.sources.landing import land_partition

    documents = fixtures.documents(spark, sf, "sound").select("payload")
    for day in (date(2024, 1, 1), date(2024, 1, 2)):
        land_partition(documents, str(tmp_path / "bronze"), day, datetime(2024, 1, 2, 2), baseline=1)
    settings = Run(str(tmp_path), spec=SPEC, run_date=date(2024, 1, 2))
    report = run(spark, settings)
    assert report.published
    want = documents.select(F.get_json_object("payload", "$.name")).distinct().count()
    assert read_published(spark, settings.gold, "coverage").first()["n_total"] == want


def test_seed_is_typed_and_ordered(spark):
    from siltstone.sources.files import CURATED_SCHEMA, SEED_DIR, read_seed

    seed = read_seed(spark, (SEED_DIR / "curated_tags.csv").as_uri(), CURATED_SCHEMA, "sort_order")
    assert [r["tag"] for r in seed.collect()] == ["playful", "alert", "energetic", "protective", "calm"]


def test_packaged_seeds(spark):
    from siltstone.sources.files import BAND_SCHEMA, curated_tags, size_bands

    bands = size_bands(spark)
    assert [f.dataType for f in bands.schema] == [f.dataType for f in BAND_SCHEMA]
    assert [tuple(r) for r in bands.orderBy("min_kg").collect()][-1] == ("giant", 45, 999)
    assert curated_tags(spark).count() == 5


def test_a_check_whose_input_no_stage_builds_blocks(spark, sf, tmp_path, monkeypatch):
    extra = checks.Check("orphan", "error", "drill", ("never_built",), lambda t, limits: t["never_built"])
    monkeypatch.setattr(pipeline, "CHECKS", (*CHECKS, extra))
    _, report = go(spark, sf, tmp_path, run_id="o")
    assert not report.published and statuses(report)["orphan"] == "error"


def test_a_second_limit_stops_a_run(spark, sf, tmp_path):
    _, report = go(spark, sf, tmp_path, kind="scaled", run_id="l1")
    warned = [r for r in report.results if r["status"] == "warn"]
    assert all(r["started_at"] is not None and r["seconds"] >= 0 for r in report.results)
    if warned:
        _, report = go(spark, sf, tmp_path, kind="scaled", run_id="l2", error_above={warned[0]["check"]: 0})
        assert not report.published and statuses(report)[warned[0]["check"]] == "fail"
