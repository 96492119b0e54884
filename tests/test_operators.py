"""Operators against brute force on small, skewed inputs."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.operators import profile, stats, tags
from siltstone.operators.bands import band_defects, bucketize, classify_bands
from siltstone.operators.dedupe import dedupe, duplicate_detail
from siltstone.operators.joins import complete_grid, enrich_left, mismatch_count, orphans
from siltstone.plans.enrichment import EnrichmentRejected, enrichment_checks, land_enrichment
from siltstone.sources.files import read_variants, size_bands, variant_fields
from siltstone.sources.tables import ensure_database, shown_run, tables_of

EDGES = [
    (5.0, "small"), (12.0, "medium"), (25.0, "large"), (45.0, "giant"), (4.999, "toy"),
    (None, "unknown"), (-1.0, None), (999.0, None), (0.0, "toy"),
]


def test_band_edges(spark):
    df = spark.createDataFrame([(x,) for x, _ in EDGES], "w double")
    found = classify_bands(df, "w", size_bands(spark))
    assert {r["w"]: r["size_class"] for r in found.collect()} == dict(EDGES)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_overlapping_bands_fail_and_never_double_rows(spark):
    bands = spark.createDataFrame([("a", 0, 12), ("b", 5, 20), ("c", 20, 30)], "label string, min_kg int, max_kg int")
    ok = spark.createDataFrame([(1.0,), (25.0,), (15.0,)], "w double")
    assert sorted(r["size_class"] for r in classify_bands(ok, "w", bands).collect()) == ["a", "b", "c"]
    with pytest.raises(PySparkException):
        classify_bands(spark.createDataFrame([(6.0,)], "w double"), "w", bands).collect()


def test_many_bands_with_gaps_are_one_expression(spark):
    rows = [(f"b{i}", float(3 * i), float(3 * i + 2)) for i in range(300)]
    bands = spark.createDataFrame([*rows, ("inverted", 9.0, 4.0), ("open", 5.0, None)], "label string, min_kg double, max_kg double")
    df = spark.range(-10, 1900).selectExpr("id / 2 as w").union(spark.sql("select double('nan')"))
    found = classify_bands(df, "w", bands)
    for r in found.collect():
        assert r["size_class"] == next((b for b, low, high in rows if low <= r["w"] < high), None)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def wide_bands(spark, n, label="label"):
    return spark.range(n).selectExpr(f"concat('b', id) as {label}", "double(id * 3) as min_kg", "double(id * 3 + 2) as max_kg")


def test_a_hundred_thousand_bands_are_joined_by_ranges(spark):
    bands = wide_bands(spark, 100_000)
    odd = spark.createDataFrame([("inverted", 9.0, 4.0), ("open", 5.0, None), (None, 400_000.0, 400_001.0)], "label string, min_kg double, max_kg double")
    df = spark.range(-10, 700_000, 7).selectExpr("id / 2 as w", "'x' as label", "1 as low").union(spark.sql("select double('nan'), 'y', 2 union all select null, 'z', 3"))
    found = classify_bands(df, "w", bands.union(odd), out="b")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "LocalTableScan" not in plan.split("BroadcastExchange")[0] and found.columns == ["w", "label", "low", "b"]
    rows = found.collect()
    assert len(rows) == df.count()
    for r in rows:
        w = r["w"]
        if w is None:
            assert r["b"] == "unknown"
        else:
            inside = w == w and 0 <= w < 300_000 and w % 3 < 2
            assert r["b"] == (f"b{int(w // 3)}" if inside else None)


def test_joined_bands_agree_with_the_expression_also_where_they_overlap(spark, monkeypatch):
    rows = [("a", 0, 100), ("b", 100, 101), ("c", 500, 900), ("d", 600, 700), ("e", 950, 950), ("f", 960, 2000), ("g", 1000, 1001)]
    bands = spark.createDataFrame(rows, "label string, min_kg int, max_kg int")
    free = spark.range(-5, 2100).where("not (id >= 600 and id < 700) and id <> 1000").selectExpr("double(id) as w")
    one = {r["w"]: r["size_class"] for r in classify_bands(free, "w", bands).collect()}
    monkeypatch.setattr("siltstone.operators.bands.MAX_BANDS", 2)
    monkeypatch.setattr("siltstone.operators.bands.RANGES", 4)
    assert {r["w"]: r["size_class"] for r in classify_bands(free, "w", bands).collect()} == one
    for value in (600.0, 1000.0):
        with pytest.raises(PySparkException, match="more than one band"):
            classify_bands(spark.createDataFrame([(value,)], "w double"), "w", bands).collect()


def test_joined_bands_of_dates_and_of_none(spark, monkeypatch):
    monkeypatch.setattr("siltstone.operators.bands.MAX_BANDS", 2)
    days = spark.sql("select explode(sequence(date '2024-01-01', date '2024-03-31')) as d")
    weeks = spark.range(13).selectExpr("concat('w', id) as label", "date_add(date '2024-01-01', int(id * 7)) as min_kg", "date_add(date '2024-01-01', int(id * 7 + 7)) as max_kg")
    got = {r["d"].toordinal(): r["size_class"] for r in classify_bands(days, "d", weeks).collect()}
    first = min(got)
    assert got == {d: f"w{(d - first) // 7}" for d in got}
    empty = spark.createDataFrame([("a", 5.0, 1.0), ("b", None, 2.0), ("c", 1.0, None)], "label string, min_kg double, max_kg double")
    assert [r["size_class"] for r in classify_bands(spark.createDataFrame([(1.0,), (None,)], "w double"), "w", empty).collect()] == [None, "unknown"]


def test_gap_is_null(spark):
    bands = spark.createDataFrame([("a", 0, 5), ("b", 6, 9)], "label string, min_kg int, max_kg int")
    df = spark.createDataFrame([(5.5,)], "w double")
    assert classify_bands(df, "w", bands).first()["size_class"] is None


def test_band_defects(spark):
    bands = spark.createDataFrame(
        [("a", 0, 5), ("b", 6, 9), ("c", 8, 8), ("d", 8, 3), ("e", None, None)], "label string, min_kg int, max_kg int"
    )
    found = Counter(r["label"] for r in band_defects(bands).collect())
    # a leaves a gap to b, b overlaps c, c is empty, d is inverted
    assert found == Counter({"a": 1, "b": 1, "c": 1, "d": 1})


def test_bucketize_sorts_its_cuts(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 4.9, 5.0, 12.0, 100.0, None)], "x double")
    got = [r[0] for r in df.select(bucketize("x", [12, 5], ["s", "m", "l"])).collect()]
    assert got == [None, "s", "s", "m", "l", "l", None]


def test_dedupe_with_a_hot_key(spark):
    rows = [("hot", i % 5, 1000 - i) for i in range(3000)] + [(f"k{i}", 1, i) for i in range(50)] + [(None, 0, 7), (None, 0, 3)]
    df = spark.createDataFrame(rows, "name string, score int, id int").repartition(6)
    kept = dedupe(df, ["name"], ["score", "id"])
    got = {r["name"]: (r["score"], r["id"]) for r in kept.collect()}
    assert got["hot"] == (0, min(1000 - i for i in range(0, 3000, 5)))
    assert got[None] == (0, 3) and len(got) == 52
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_duplicate_detail_keeps_every_row(spark):
    df = spark.createDataFrame([("a", i) for i in range(500)] + [("b", 1), (None, 2), (None, 3)], "name string, id int")
    assert duplicate_detail(df, "name", ["id"]).count() == 500


@pytest.mark.parametrize("kind", ["uniform", "hot", "ties", "tiny", "huge numbers"])
def test_quantiles_equal_numpy(spark, kind):
    rng = random.Random(5)
    values = {
        "uniform": [rng.random() for _ in range(4000)],
        "hot": [3.0] * 3000 + [rng.random() * 1e6 for _ in range(1000)],
        "ties": [float(rng.randrange(4)) for _ in range(999)],
        "tiny": [2.0],
        "huge numbers": [1e15 + rng.randrange(5000) for _ in range(2500)],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]
    got = {r["prob"]: r["quantile"] for r in stats.quantiles(df, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_quantiles_by_group_with_null_keys(spark):
    rows = [(g, float(i)) for g, n in (("a", 1000), ("b", 7), (None, 12)) for i in range(n)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["median"] for r in stats.median(df, "v", ["g"]).collect()}
    assert got == {"a": 499.5, "b": 3.0, None: 5.5}


def test_buckets_stay_small_in_groups_of_any_size(spark, monkeypatch):
    monkeypatch.setattr("siltstone.operators.stats.CUT_EVERY", 32)
    df = spark.range(40000).select(F.when(F.col("id") < 100, "small").otherwise("fine").alias("g"), F.sqrt("id").alias("v"))
    buckets = stats._bucketed(df.select("g", F.col("v").alias("__v"), F.lit(1).alias("__n")), ["g"]).groupBy("g", "__b").count()
    largest = {r["g"]: (r["n"], r["size"]) for r in buckets.groupBy("g").agg(F.count("*").alias("n"), F.max("count").alias("size")).collect()}
    assert largest["fine"][0] > 1000 and largest["fine"][1] < 32 * 15
    got = {(r["g"], r["prob"]): r["quantile"] for r in stats.quantiles(df, "v", [0.3, 1], ["g"]).collect()}
    for g, low, high in (("small", 0, 100), ("fine", 100, 40000)):
        for p in (0.3, 1):
            assert got[g, p] == pytest.approx(float(np.quantile(np.sqrt(np.arange(low, high)), p)), rel=1e-12)


def test_quantiles_count_once(spark):
    df = spark.range(10000).select((F.col("id") % 977).cast("double").alias("v"))
    result = stats.quantiles(df, "v", [0.5])
    result.collect()
    assert "ReusedExchange" in result._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("continuous", [False, True])
def test_group_summary(spark, continuous):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else "cold", rng.choice([None, *range(20)]), rng.random()) for i in range(900)] + [("empty", None, 1.0), ("one", 4, None)]
    df = spark.createDataFrame([(g, None if v is None else v / 2, w) for g, v, w in rows], "g string, v double, w double")
    got = {r["g"]: r for r in stats.group_summary(df, "g", "v", ["w"], places=6, continuous=continuous).collect()}
    for g in ("hot", "cold", "one", "empty"):
        vs = [v / 2 for k, v, _ in rows if k == g and v is not None]
        assert got[g]["n_rows"] == sum(k == g for k, _, _ in rows) and got[g]["n_with_value"] == len(vs)
        if vs:
            assert got[g]["median_v"] == pytest.approx(float(np.median(vs)))
            assert got[g]["mean_v"] == pytest.approx(float(np.mean(vs)), abs=1e-6)
            assert (got[g]["min_v"], got[g]["max_v"]) == (min(vs), max(vs))
        if len(vs) > 1:
            assert got[g]["stddev_v"] == pytest.approx(float(np.std(vs, ddof=1)), abs=1e-6)
        else:
            assert got[g]["stddev_v"] is None


def test_correlation_of_degenerate_columns_is_null(spark):
    one = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    for df in (one, flat):
        assert stats.pairwise_corr(df, [("a", "b")]).first()["correlation"] is None
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "a double, b double")
    assert stats.pairwise_corr(line, [("a", "b")], places=None).first()["correlation"] == pytest.approx(
        np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1]
    )


def _lift_by_hand(rows, classes, support, k):
    sizes = Counter(c for c, _ in rows if c in classes)
    pairs = Counter((c, p) for c, ts in rows if c in classes for p in combinations(sorted(set(ts)), 2))
    total = sum(sizes.values())
    out = {}
    for c in classes:
        found = []
        for (cls, p), n in pairs.items():
            other = sum(m for (o, q), m in pairs.items() if q == p and o != c)
            if cls == c and other and n / sizes[c] >= support:
                found.append((-(n / sizes[c]) / (other / (total - sizes[c])), " + ".join(p)))
        out[c] = [p for _, p in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("support", [0.25, 0.1, 0.0])
def test_pair_lift_equals_brute_force(spark, support):
    rng = random.Random(11)
    words = [f"t{i}" for i in range(12)]
    rows = []
    for i in range(400):
        cls = "a" if i % 3 == 0 else rng.choice(["b", "c", None])
        rows.append((cls, [w for j, w in enumerate(words) if rng.random() < (0.7 if (j + i) % 4 == 0 else 0.2)] * (1 + i % 2)))
    df = spark.createDataFrame(rows, "size_class string, tags array<string>")
    got = {c: [] for c in "abc"}
    for r in tags.pair_lift(df, ["a", "b", "c"], support, 4).orderBy("band", "rank").collect():
        got[r["band"]].append(r["pair"])
    assert got == _lift_by_hand(rows, ["a", "b", "c"], support, 4)


def test_null_entries_of_a_list_are_no_tags_and_no_rows(spark):
    rows = [("a", ["x", None]), ("a", [None, None]), ("a", None), ("b", ["x", "y", None, "x"]), (None, ["x", None])]
    df = spark.createDataFrame(rows, "size_class string, tags array<string>")
    sizes = tags.class_sizes(tags.class_tag_counts(df), "size_class")
    assert sorted(tuple(r) for r in sizes.where("size_class is not null").collect()) == [("a", 3), ("b", 1)]
    shares = {(r["size_class"], r["tag"]): (r["n_entities"], r["n_in_class"], r["pct_of_class"]) for r in tags.share_of_class_by_row(df, F.array_distinct("tags")).collect()}
    assert shares == {("a", "x"): (1, 3, 33.3), ("b", "x"): (1, 1, 100.0), ("b", "y"): (1, 1, 100.0)}
    pivot = {r["tag"]: (r["a"], r["b"]) for r in tags.tag_class_pivot(df, ["a", "b"]).collect()}
    assert pivot == {"x": (33.0, 200.0), "y": (0.0, 100.0)}
    pairs = spark.createDataFrame([("a", ["x", None, "y"]), ("b", ["x", "y"]), ("b", [None, "x"])], "size_class string, tags array<string>")
    got = {r["band"]: (r["pair"], r["in_band_pct"], r["other_bands_pct"]) for r in tags.pair_lift(pairs, k=3).collect()}
    assert got == {"a": ("x + y", 100, 50), "b": ("x + y", 50, 100)}


def test_pair_lift_gathers_no_set_and_takes_a_wide_vocabulary(spark):
    """60,000 rare tags beside three frequent ones: only the three reach the pairs."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("size_class"),
        F.concat(
            F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit("rare"), (F.col("id") * 10 + i).cast("string"))),
            F.array(F.lit("f1"), F.lit("f2")), F.when(F.col("id") % 4 == 0, F.array(F.lit("f3"))).otherwise(F.array()),
        ).alias("tags"),
    )
    found = tags.pair_lift(rows)
    assert {(r["band"], r["pair"], r["lift"]) for r in found.collect()} == {("a", "f1 + f2", 1.0), ("b", "f1 + f2", 1.0)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "LeftSemi" in plan


def test_bridge_folds_repeats_and_drops_sentinels(spark):
    df = spark.createDataFrame(
        [(1, "Loyal, loyal,"), (2, "Varies a lot"), (3, None), (4, " , "), (1, "LOYAL, quick to learn")], "id int, t string"
    )
    rows = tags.tag_bridge(df, "id", "t", ",", ["varies a lot"]).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "loyal", "Loyal"), (1, "quick to learn", "Quick to learn")]


def test_bridge_with_a_unique_key_needs_no_shuffle(spark):
    df = spark.createDataFrame([(1, "a, b")], "id int, t string")
    plan = tags.tag_bridge(df, "id", "t", key_is_unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "p int")
    assert [r[0] for r in orphans(child, parent, "k", "p").collect()] == [2]


def test_enrichment_never_changes_the_row_count(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "id int, n string")
    extra = spark.createDataFrame([(1, "x")], "id int, e string")
    assert sorted((r["id"], r["e"]) for r in enrich_left(dim, extra, "id").collect()) == [(1, "x"), (2, None)]
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "id int, e string")
    with pytest.raises(PySparkException):
        enrich_left(dim, twice, "id").collect()


def test_grid_fills_absent_pairs(spark):
    facts = spark.createDataFrame([("a", "x", 3)], "t string, c string, n int")
    rows = spark.createDataFrame([("a",), ("b",)], "t string")
    got = complete_grid(facts, rows, ["x", "y"], "t", "c", {"n": 0})
    assert sorted((r["t"], r["c"], r["n"]) for r in got.collect()) == [("a", "x", 3), ("a", "y", 0), ("b", "x", 0), ("b", "y", 0)]


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "a", None, (1, "z")), (2, " ", None, (1, "z")), (3, "b" * 200, None, None)],
        "id int, t string, empty string, s struct<x:int,y:string>",
    )
    got = {r["column_name"]: (r["n_blank"], r["n_distinct"]) for r in profile.profile_columns(df).collect()}
    assert got == {"id": (0, 3), "t": (1, 2), "empty": (3, 0), "s": (1, 1)}
    assert [r[0] for r in profile.constant_columns(df).collect()] == ["empty"]
    examples = profile.column_examples(df, ["t"]).collect()
    assert sorted(r["example"] for r in examples) == ["a", "b" * 200]
    key = profile.check_key(df, "id").first()
    assert key["is_key"] and key["n_rows"] == 3


def test_samples_of_a_tiny_table_are_the_table(spark):
    df = spark.createDataFrame([(i, "t" if i else None) for i in range(4)], "id int, t string")
    assert profile.sample_records(df, ["id", "t"], "id", "t").count() == 4


def test_samples(spark):
    rows = [(i, "x" if i % 4 else None, "y" if i % 3 else "", "tag" if i > 50 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, a string, b string, t string")
    got = {r["picked_as"]: r["id"] for r in profile.sample_records(df, ["a", "b", "t"], "id", "t").collect()}
    ranked = sorted(rows, key=lambda r: (sum(v in (None, "") for v in r[1:]), r[0]))
    ids = [r[0] for r in ranked]
    want = {"richest": ids[0], "sparsest": ids[-1], "second sparsest": ids[-2], "middle": ids[50]}
    want["with tags"] = next(r[0] for r in ranked if r[3] and r[0] not in want.values())
    assert got == want


def test_mismatch_is_null_safe(spark):
    df = spark.createDataFrame([("a", "a"), (None, None), ("a", None), ("a", "b")], "x string, y string")
    assert mismatch_count(df, "x", "y").first()[0] == 2


def test_quantiles_without_broadcasts_and_with_a_hot_group(spark):
    """The joins by shuffle, as with very many groups: a third of the rows in one group."""
    rng = random.Random(9)
    rows = [("hot" if i % 3 == 0 else f"g{i % 40}", rng.random()) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, v double")
    threshold, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        spark.conf.set(adaptive, "-1")
        found = stats.quantiles(df, "v", [0.25, 0.5], ["g"])
        got = {(r["g"], r["prob"]): r["quantile"] for r in found.collect()}
        assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
        spark.conf.unset(adaptive)
    for g in {g for g, _ in rows}:
        values = [v for k, v in rows if k == g]
        for p in (0.25, 0.5):
            assert got[g, p] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_share_of_class_forms_agree_on_a_hot_class(spark):
    rng = random.Random(2)
    rows = [(i, "big" if i % 3 else rng.choice(["s", None]), ", ".join(rng.sample(["A", "b", "c", "B"], rng.randrange(4)))) for i in range(900)]
    dim = spark.createDataFrame(rows, "entity_id int, size_class string, tags_raw string")
    by_join = tags.share_of_class(tags.tag_bridge(dim, "entity_id", "tags_raw"), dim)
    by_row = tags.share_of_class_by_row(dim, tags.distinct_tags("tags_raw"))
    assert sorted(map(tuple, by_join.collect())) == sorted(map(tuple, by_row.select(by_join.columns).collect()))


def test_a_text_and_its_digest_are_two_values(spark):
    df = spark.createDataFrame([("x" * 100,)], "t string").select(F.explode(F.array("t", F.sha2("t", 256))).alias("t"))
    assert profile.profile_columns(df).first()["n_distinct"] == 2


def test_enrichment_checks_count_every_kind_of_defect(spark):
    dim = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    rows = [(1, "a", 5), (2, "b", None), (2, "a", 5), (None, "a", 9), (None, None, 5), (7, "x", 5), (7, "x", 5)]
    found = enrichment_checks(spark.createDataFrame(rows, "id int, kind string, n int"), dim, "id", {"kind": ["a", "b"], "n": [5]})
    assert {r["check"]: r["failures"] for r in found.collect()} == {
        "id_not_null": 2, "id_unique": 2, "id_in_dimension": 2, "kind_accepted": 2, "n_accepted": 1
    }
    empty = enrichment_checks(spark.createDataFrame([], "id int, kind string"), dim, "id", {"kind": ["a"]})
    assert {r["failures"] for r in empty.collect()} == {0}


def test_a_refused_enrichment_leaves_the_earlier_one(spark, tmp_path):
    ensure_database(spark, "enriching", str(tmp_path / "e"))
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    make = lambda rows: spark.createDataFrame(rows, "id int, kind string")
    with pytest.raises(EnrichmentRejected, match="kind_accepted 1"):
        land_enrichment(make([(1, "z")]), dim, "enriching", "kinds", "r0", "id", {"kind": ["a"]})
    assert shown_run(spark, "enriching", "kinds") is None
    land_enrichment(make([(1, "a")]), dim, "enriching", "kinds", "r1", "id", {"kind": ["a"]})
    with pytest.raises(EnrichmentRejected, match="id_unique 1"):
        land_enrichment(make([(1, "a"), (1, "a")]), dim, "enriching", "kinds", "r2", "id", {"kind": ["a"]})
    joined = enrich_left(dim, spark.table("enriching.kinds"), "id")
    assert sorted(tuple(r) for r in joined.collect()) == [(1, "a"), (2, None)]
    assert shown_run(spark, "enriching", "kinds") == "r1" and tables_of(spark, "enriching", "r2") == []


def test_variants_are_read_line_by_line(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"id":1,"b":{"x":1.5}}\n{"id":"2","c":[1]}\n\n[3]\n')
    docs = read_variants(spark, str(path))
    assert {(r["column_name"], r["column_type"], r["n_rows"]) for r in variant_fields(docs).collect()} == {
        ("id", "VARIANT", 2), ("b", "OBJECT<x: DECIMAL(2,1)>", 1), ("c", "ARRAY<BIGINT>", 1)
    }
    path.write_text('{"id":1}\n{"id":')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_variants(spark, str(path)).collect()
