"""Landing: validation, idempotence, crash safety, latest day, the stream."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest

from siltstone.sources import landing
from siltstone.sources.files import describe, read_documents, read_json
from siltstone.sources.landing import (
    PayloadRejected, bronze_table, land_partition, latest_partition, live_days, partition_history, read_bronze, read_latest,
    reference_count, validate_payload, verify_partition,
)
from siltstone.sources.tables import quoted
from siltstone.streaming.landing import land_arrivals

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)
T = datetime(2024, 1, 2, 2)


def docs(spark, ids, extra=()):
    texts = [json.dumps({"id": str(i), "name": f"n{i}"}, separators=(",", ":")) for i in ids] + list(extra)
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def state(spark, base):
    return {str(r["run_date"]): r["n_rows"] for r in partition_history(read_bronze(spark, base)).collect()}


@pytest.mark.parametrize(
    "ids,extra,reference,reason",
    [
        (range(10), ["[1]", "5"], 10, "records that are no JSON objects"),
        (range(10), ['{"id":null}', '{"name":"x"}'], 10, "records without an id"),
        ([1, 2, 2], [], 3, "ids that occur more than once"),
        (range(564), [], 628, "fewer records than the floor"),
        (range(565), [], 628, None),
        (range(9), [], 10, None),
    ],
)
def test_validation_reasons(spark, ids, extra, reference, reason):
    row = validate_payload(docs(spark, ids, extra), reference).first()
    assert row["reason"] == reason
    assert row["floor"] == int(reference * 0.9)


def test_landing_replaces_its_own_day_only(spark, tmp_path):
    base = str(tmp_path / "bronze")
    assert land_partition(docs(spark, range(10)), base, D1, T, baseline=10) == 10
    assert land_partition(docs(spark, range(12)), base, D2, T) == 12
    assert land_partition(docs(spark, range(11)), base, D2, T) == 11
    assert state(spark, base) == {"2024-01-01": 10, "2024-01-02": 11}


def test_rejected_payload_leaves_the_day(spark, tmp_path):
    base = str(tmp_path / "bronze")
    land_partition(docs(spark, range(100)), base, D1, T, baseline=100)
    land_partition(docs(spark, range(100)), base, D2, T)
    with pytest.raises(PayloadRejected, match="fewer records"):
        land_partition(docs(spark, range(89)), base, D2, T)
    assert state(spark, base) == {"2024-01-01": 100, "2024-01-02": 100}


@pytest.mark.parametrize("where", ["verify_partition", "insertInto"])
def test_crash_before_the_replacement_leaves_the_day(spark, tmp_path, monkeypatch, where):
    from pyspark.sql.readwriter import DataFrameWriter

    base = str(tmp_path / "bronze")
    land_partition(docs(spark, range(10)), base, D1, T, baseline=10)

    def crash(*_args, **_kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(*((DataFrameWriter, where) if where == "insertInto" else (landing, where)), crash)
    with pytest.raises(RuntimeError, match="lost"):
        land_partition(docs(spark, range(20)), base, D1, T, baseline=10)
    monkeypatch.undo()
    assert state(spark, base) == {"2024-01-01": 10}
    land_partition(docs(spark, range(20)), base, D1, T, baseline=10)
    assert state(spark, base) == {"2024-01-01": 20}
    assert [t.name for t in spark.catalog.listTables(bronze_table(spark, base).split(".")[0])] == ["bronze"]


def test_reference_is_the_newest_earlier_day(spark, tmp_path):
    base = str(tmp_path / "bronze")
    assert reference_count(read_bronze(spark, base), D2).first()["reference"] == 628
    land_partition(docs(spark, range(10)), base, D1, T, baseline=10)
    land_partition(docs(spark, range(20)), base, D2, T)
    bronze = read_bronze(spark, base)
    assert reference_count(bronze, D2).first()["reference"] == 10
    assert reference_count(bronze, date(2024, 2, 1)).first()["reference"] == 20
    assert reference_count(bronze, D1).first()["source"] == "baseline"


def test_verify_sees_doubles_and_losses(spark):
    bronze = spark.createDataFrame([(1, D1), (1, D1), (2, D2)], "entity_id int, run_date date")
    assert not verify_partition(bronze, D1, 2).first()["ok"]
    assert not verify_partition(bronze, D2, 2).first()["ok"]
    assert verify_partition(bronze, D2, 1).first()["ok"]


def test_latest_day_reads_only_its_files(spark, tmp_path):
    base = str(tmp_path / "bronze")
    land_partition(docs(spark, range(10)), base, D1, T, baseline=10)
    land_partition(docs(spark, range(20)), base, D2, T)
    day = latest_partition(read_bronze(spark, base))
    assert day.count() == 20
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan and "Subquery" in plan


def test_the_newest_day_is_known_without_reading_rows(spark, tmp_path):
    base = str(tmp_path / "bronze")
    assert read_latest(spark, base).count() == 0
    land_partition(docs(spark, range(10)), base, D1, T, baseline=10)
    land_partition(docs(spark, range(20)), base, D2, T)
    day = read_latest(spark, base)
    assert day.count() == 20
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [" in plan and "Subquery" not in plan
    assert {f.split("run_date=")[1][:10] for f in day.inputFiles()} == {"2024-01-02"} or "2024-01-02" in plan


def test_landed_days_are_found_by_a_catalog_that_did_not_see_them_land(spark, tmp_path):
    base = str(tmp_path / "bronze")
    land_partition(docs(spark, range(10)), base, D1, T, baseline=10)
    land_partition(docs(spark, range(10)), base, D2, T)
    spark.sql(f"DROP TABLE {quoted(bronze_table(spark, base))}")
    assert live_days(spark, base) == ["2024-01-01", "2024-01-02"]
    assert state(spark, base) == {"2024-01-01": 10, "2024-01-02": 10}


def test_a_payload_without_records_is_rejected(spark, tmp_path):
    base = str(tmp_path / "bronze")
    land_partition(docs(spark, range(10)), base, D1, T, baseline=0)
    with pytest.raises(PayloadRejected, match="no records"):
        land_partition(docs(spark, []), base, D1, T, baseline=0)
    assert state(spark, base) == {"2024-01-01": 10}


def test_array_files_keep_documents_as_they_came(spark, tmp_path):
    record = {"id": "7", "b": {"z": 1, "a": [1, 2]}, "a": "x,y"}
    path = tmp_path / "payload.json"
    path.write_text(json.dumps([record, {"id": "8"}], indent=2))
    rows = [r[0] for r in read_documents(spark, str(path), array_files=True).collect()]
    assert rows == [json.dumps(record, separators=(",", ":")), '{"id":"8"}']
    inferred = describe(read_json(spark, str(path), multiline=True))
    assert [r["column_name"] for r in inferred.collect()] == ["a", "b", "id"]


def test_stream_lands_each_day_once(spark, tmp_path):
    arrivals, base, marks = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "marks")

    def arrive(day, name, ids):
        folder = arrivals / f"run_date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join(json.dumps({"id": str(i)}) for i in ids))

    def go():
        query = land_arrivals(spark, str(arrivals), base, marks, T, baseline=1)
        query.awaitTermination(120)
        assert query.exception() is None

    arrive("2024-01-01", "a.json", range(5))
    arrive("2024-01-02", "a.json", range(6))
    go()
    assert state(spark, base) == {"2024-01-01": 5, "2024-01-02": 6}
    arrive("2024-01-02", "b.json", range(6, 9))
    go()
    assert state(spark, base) == {"2024-01-01": 5, "2024-01-02": 9}


def test_keys_past_32_bits_land_exactly(spark, tmp_path):
    base = str(tmp_path / "bronze")
    ids = [3_000_000_000, 2**53 + 1, 2**53 + 2, 7]
    assert land_partition(docs(spark, ids), base, D1, T, baseline=1) == 4
    assert sorted(r["entity_id"] for r in read_bronze(spark, base).collect()) == sorted(ids)


@pytest.mark.parametrize("extra,reason", [(['{"id":"abc"}'], "without an id"), (['{"id":"01"}'], "more than once")])
def test_ids_are_judged_as_the_keys_they_land_as(spark, tmp_path, extra, reason):
    with pytest.raises(PayloadRejected, match=reason):
        land_partition(docs(spark, [1, 2, 3], extra), str(tmp_path / "bronze"), D1, T, baseline=1)


def test_days_landed_at_once_are_all_there(spark, tmp_path):
    base = str(tmp_path / "bronze")
    days = [date(2024, 1, d) for d in range(1, 7)]
    with ThreadPoolExecutor(6) as pool:
        assert list(pool.map(lambda d: land_partition(docs(spark, range(5)), base, d, T, baseline=5), days)) == [5] * 6
    assert state(spark, base) == {d.isoformat(): 5 for d in days}


def test_the_stream_goes_on_past_a_rejected_day(spark, tmp_path):
    arrivals = tmp_path / "in"
    for day, ids in (("2024-01-01", ["x"]), ("2024-01-02", [1, 2, 3])):
        folder = arrivals / f"run_date={day}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text("\n".join(json.dumps({"id": str(i)}) for i in ids))
    land_arrivals(spark, str(arrivals), str(tmp_path / "b"), str(tmp_path / "c"), T, baseline=1).awaitTermination()
    assert state(spark, str(tmp_path / "b")) == {"2024-01-02": 3}
