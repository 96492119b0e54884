import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltstone.plans import history
from siltstone.plans.changes import changed_rows, digests_of, rebuild_changed, remember, seen_before
from siltstone.plans.history import apply_snapshot, first_versions, history_table, store_snapshot
from siltstone.sources.tables import ensure_database, quoted, tables_of


def test_versions_only_where_a_value_changed(spark):
    schema = "id int, v string"
    day1 = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "gone")], schema)
    day2 = spark.createDataFrame([(1, "a"), (2, "B"), (3, ""), (5, "new")], schema)
    hist = first_versions(day1, "id", ["v"], "2024-01-01")
    after = apply_snapshot(hist, day2, "id", ["v"], "2024-01-02")
    rows = {(r["id"], r["v"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"]) for r in after.collect()}
    assert rows == {
        (1, "a", "2024-01-01", "None", True), (2, "b", "2024-01-01", "2024-01-02", False),
        (2, "B", "2024-01-02", "None", True), (3, None, "2024-01-01", "2024-01-02", False),
        (3, "", "2024-01-02", "None", True), (4, "gone", "2024-01-01", "None", True), (5, "new", "2024-01-02", "None", True),
    }
    again = apply_snapshot(after, day2, "id", ["v"], "2024-01-03")
    assert again.count() == after.count()
    closed = apply_snapshot(after, day2, "id", ["v"], "2024-01-03", close_missing=True)
    assert closed.where("id = 4 and not is_current").count() == 1
    back = apply_snapshot(again, day1, "id", ["v"], "2024-01-04")
    assert back.where("id = 2").count() == 3 and back.where("id = 2 and is_current").first()["v"] == "b"


def test_changed_rows_and_rebuild(spark):
    old = spark.createDataFrame([(1, 1), (2, 2)], "id int, v int")
    new = spark.createDataFrame([(1, 1), (2, 3), (4, 4)], "id int, v int")
    changed = changed_rows(new, digests_of(old, "id", ["v"]), "id", ["v"])
    assert sorted(r["id"] for r in changed.collect()) == [2, 4]
    live = old.select("id", (F.col("v") * 10).alias("w"))
    built = rebuild_changed(live, changed, "id", lambda d: d.select("id", (F.col("v") * 10).alias("w")))
    assert sorted(tuple(r) for r in built.collect()) == [(1, 10), (2, 30), (4, 40)]


def test_suggested_bands_separate_clusters(spark):
    df = spark.createDataFrame([(float(v),) for c in (1, 50, 100) for v in range(c, c + 5)], "w double")
    bands = history.suggest_bands(df, "w", k=3).orderBy("band").collect()
    assert [b["n_rows"] for b in bands] == [5, 5, 5]
    assert bands[0]["low"] is None and bands[0]["high"] == bands[1]["low"]


@pytest.mark.parametrize("rows", [[(None, "a")], [(1, "a"), (1, "b")]])
def test_snapshots_with_bad_keys_are_refused(spark, rows):
    good = spark.createDataFrame([(1, "a")], "id int, v string")
    bad = spark.createDataFrame(rows, "id int, v string")
    hist = first_versions(good, "id", ["v"], "2024-01-01")
    with pytest.raises(Exception, match="snapshot: (a row without|more than one row of) id"):
        apply_snapshot(hist, bad, "id", ["v"], "2024-01-02").collect()


def test_deleted_keys_leave_the_live_table(spark):
    old = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, v int")
    new = spark.createDataFrame([(1, 1), (2, 5)], "id int, v int")
    changed = changed_rows(new, digests_of(old, "id", ["v"]), "id", ["v"])
    built = rebuild_changed(old, changed, "id", lambda d: d.select("id", "v"), new)
    assert sorted(tuple(r) for r in built.collect()) == [(1, 1), (2, 5)]


# ---- Digests and what was seen ---------------------------------------------------------------

NAN = float("nan")


@pytest.mark.parametrize(
    "kind,before,after,changed",
    [
        ("timestamp", datetime(2024, 1, 1, 0, 0, 0, 123456), datetime(2024, 1, 1, 0, 0, 0, 123457), True),
        ("timestamp_ntz", datetime(2024, 1, 1, 0, 0, 0, 123456), datetime(2024, 1, 1, 0, 0, 0, 123999), True),
        ("double", NAN, NAN, False), ("double", NAN, None, True), ("double", -0.0, 0.0, False), ("double", 0.1, 0.1 + 2**-55, True),
        ("string", "", None, True), ("string", "-", None, True), ("string", "a", "a ", True), ("binary", b"\x00", b"", True),
        ("decimal(20,6)", Decimal("1.000001"), Decimal("1.000002"), True),
        ("array<string>", ["a", "b"], ["ab"], True), ("array<string>", ["1:a", None], ["1:a", "-"], True), ("array<int>", [], None, True),
        ("struct<a:string,b:string>", ("x", None), ("x", ""), True), ("struct<a:string,b:string>", ("x1:", "y"), ("x", "1:y"), True),
        ("map<string,int>", {"a": 1, "b": 2}, {"b": 2, "a": 1}, False), ("map<string,int>", {"a": 1}, {"a": None}, True),
        ("array<struct<t:timestamp,v:double>>", [(datetime(2024, 1, 1, 0, 0, 0, 1), NAN)], [(datetime(2024, 1, 1, 0, 0, 0, 2), NAN)], True),
        ("array<struct<t:timestamp,v:double>>", [(datetime(2024, 1, 1), -0.0)], [(datetime(2024, 1, 1), 0.0)], False),
        ("date", date(2024, 1, 1), date(2024, 1, 2), True), ("bigint", 2**53, 2**53 + 1, True), ("boolean", False, None, True),
    ],
)
def test_digests_tell_values_as_spark_does(spark, kind, before, after, changed):
    old = spark.createDataFrame([(1, before), (2, before)], f"id int, v {kind}")
    new = spark.createDataFrame([(1, after), (2, before)], f"id int, v {kind}")
    found = changed_rows(new, digests_of(old, "id", ["v"]), "id", ["v"]).collect()
    assert [(r["id"], r["changed_columns"]) for r in found] == ([(1, ["v"])] if changed else [])


def test_a_digest_keeps_over_widening_and_time_zones_but_not_over_text(spark):
    old = digests_of(spark.createDataFrame([(1, 7, datetime(2024, 3, 31, 1, 30))], "id int, v int, t timestamp"), "id", ["v", "t"])
    old = spark.createDataFrame(old.collect(), old.schema)
    wide = spark.createDataFrame([(1, 7, datetime(2024, 3, 31, 1, 30))], "id int, v bigint, t timestamp")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert changed_rows(wide, old, "id", ["v", "t"]).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert changed_rows(wide.withColumn("v", F.col("v").cast("string")), old, "id", ["v"]).count() == 1


def test_new_null_and_untracked_keys_count_as_changed(spark):
    old = digests_of(spark.createDataFrame([(1, 1)], "id int, v int"), "id", ["v"])
    new = spark.createDataFrame([(1, 1, "x"), (2, 2, "x"), (None, 3, "x")], "id int, v int, w string")
    assert sorted((r["v"], r["changed_columns"]) for r in changed_rows(new, old, "id", ["v"]).collect()) == [(2, []), (3, [])]
    assert changed_rows(new, old, "id", ["v", "w"]).where("id = 1").first()["changed_columns"] == ["w"]


def test_what_was_seen_is_not_shuffled_again(spark, tmp_path):
    ensure_database(spark, "seen_db", str(tmp_path / "seen"))
    first = spark.range(1000).select(F.col("id"), (F.col("id") * 3).alias("v"))
    remember(first, "seen_db", "seen", "id", ["v"], "r1", buckets=6)
    second = first.withColumn("v", F.when(F.col("id") % 100 == 0, F.col("v") + 1).otherwise(F.col("v")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changed = changed_rows(second, seen_before(spark, "seen_db", "seen"), "id", ["v"])
        assert changed.count() == 10
        plan = changed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    remember(second, "seen_db", "seen", "id", ["v"], "r2", buckets=6)
    assert tables_of(spark, "seen_db", "r1") == [] and tables_of(spark, "seen_db", "r2") == ["seen"]
    assert changed_rows(second, seen_before(spark, "seen_db", "seen"), "id", ["v"]).count() == 0


# ---- A kept history --------------------------------------------------------------------------


def files_below(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def versions(spark, table):
    rows = spark.table(quoted(table)).collect()
    return sorted((r["id"], r["v"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"]) for r in rows)


def test_closed_versions_are_not_written_again(spark, tmp_path):
    ensure_database(spark, "kept_db", str(tmp_path / "db"))
    days = [[(1, "a"), (2, "b"), (3, "c")], [(1, "a"), (2, "B"), (3, "c")], [(1, "A"), (2, "B"), (4, "d")], [(1, "A"), (2, "B"), (4, "d")]]
    snapshots = [spark.createDataFrame(d, "id int, v string") for d in days]
    folder = str(tmp_path / "kept")
    table = history_table(snapshots[0], "kept_db", "kept", folder, "id", ["v"])
    plain = None
    for day, snapshot in enumerate(snapshots, 1):
        closed = {p: t for p, t in files_below(folder).items() if "is_current=false" in p}
        store_snapshot(snapshot, table, "id", ["v"], date(2024, 1, day))
        after = files_below(folder)
        assert {p: after.get(p) for p in closed} == closed
        plain = first_versions(snapshot, "id", ["v"], date(2024, 1, 1)) if plain is None else apply_snapshot(plain, snapshot, "id", ["v"], date(2024, 1, day))
        want = sorted((r["id"], r["v"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"]) for r in plain.collect())
        assert versions(spark, table) == want
    read = spark.table(quoted(table)).where("is_current")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in read


def test_a_day_can_be_run_again_after_a_crash_and_corrected(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    ensure_database(spark, "again_db", str(tmp_path / "db"))
    make = lambda rows: spark.createDataFrame(rows, "id int, v string")
    table = history_table(make([(1, "a")]), "again_db", "kept", str(tmp_path / "kept"), "id", ["v"])
    store_snapshot(make([(1, "a"), (2, "b")]), table, "id", ["v"], date(2024, 1, 1))
    insert, calls = DataFrameWriter.insertInto, []

    def crash_at_second(self, *args, **options):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return insert(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "insertInto", crash_at_second)
    with pytest.raises(RuntimeError, match="lost"):
        store_snapshot(make([(1, "A"), (2, "b")]), table, "id", ["v"], date(2024, 1, 2))
    monkeypatch.undo()
    for _ in range(2):
        store_snapshot(make([(1, "A"), (2, "b")]), table, "id", ["v"], date(2024, 1, 2))
    want = [(1, "A", "2024-01-02", "None", True), (1, "a", "2024-01-01", "2024-01-02", False), (2, "b", "2024-01-01", "None", True)]
    assert versions(spark, table) == want
    store_snapshot(make([(1, "AA"), (2, "B")]), table, "id", ["v"], date(2024, 1, 2))
    assert versions(spark, table) == [
        (1, "AA", "2024-01-02", "None", True), (1, "a", "2024-01-01", "2024-01-02", False),
        (2, "B", "2024-01-02", "None", True), (2, "b", "2024-01-01", "2024-01-02", False),
    ]
    with pytest.raises(ValueError, match="already has versions"):
        store_snapshot(make([(1, "x")]), table, "id", ["v"], date(2024, 1, 1))
    with pytest.raises(Exception, match="more than one row of id"):
        store_snapshot(make([(1, "x"), (1, "y")]), table, "id", ["v"], date(2024, 1, 3))
    with pytest.raises(ValueError, match="empty snapshot"):
        store_snapshot(make([]), table, "id", ["v"], date(2024, 1, 3), close_missing=True)
    assert [t.name for t in spark.catalog.listTables("again_db")] == ["kept"]
