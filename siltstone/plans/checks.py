"""Data checks: every check yields its violating rows, the suite counts them with few scans."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.numbers import first_number, round_to, share
from siltstone.functions.shapes import shape_known
from siltstone.functions.text import total, word_count
from siltstone.operators.bands import band_defects
from siltstone.operators.dedupe import duplicates
from siltstone.operators.joins import melt, orphans
from siltstone.operators.stats import median_ratio
from siltstone.operators.tags import each_tag
from siltstone.plans.marts import LIFE, WEIGHT
from siltstone.sources.landing import latest_partition

Tables = Mapping[str, DataFrame]

# Thresholds and plausible ranges.
MAX_UNKNOWN_PCT = 1
MAX_NULL_PCT = 10
WEIGHT_RANGE = (0.5, 100.0)
LIFE_RANGE = (4.0, 25.0)
RATIO_RANGES = {"weight": (2.095, 2.315), "height": (2.413, 2.667)}
CLASS_LABELS = ("toy", "small", "medium", "large", "giant", "unknown")
MAX_TAG_WORDS = 3

METRICS = {
    "weight": ("weight_raw", "weight_min_kg"),
    "height": ("height_raw", "height_min_cm"),
    "life_span": ("life_span_raw", "life_span_min_years"),
}


RESULT_SCHEMA = (
    "run_id string, check string, severity string, role string, status string, failures long, message string, "
    "started_at timestamp, seconds double"
)


@dataclass(frozen=True)
class Limits:
    max_unknown_pct: float = MAX_UNKNOWN_PCT
    max_null_pct: float = MAX_NULL_PCT


@dataclass(frozen=True)
class Check:
    """``rows`` gives the violating rows from the tables named in ``inputs``.

    Two kinds of check can share a scan with others on their table: ``failures`` is an aggregate
    that counts the violations, ``key`` is a column whose repeated values are the violations.
    """

    name: str
    severity: str
    role: str
    inputs: tuple[str, ...]
    rows: Callable[[Tables, Limits], DataFrame]
    failures: Callable[[Limits], Column] | None = None
    key: str | None = None


# ---- builders -------------------------------------------------------------------------------


def _row_level(name, severity, role, table, test: Callable[[], Column], show: Sequence[str]) -> Check:
    return Check(
        name, severity, role, (table,),
        rows=lambda t, _: t[table].where(test()).select(*show),
        failures=lambda _: F.count_if(test()),
    )


def not_null(name, table, column, role="error", severity="error") -> Check:
    return _row_level(name, severity, role, table, lambda: F.col(column).isNull(), [column])


def accepted_values(name, table, column, values, role, severity="error") -> Check:
    return _row_level(name, severity, role, table, lambda: ~F.col(column).isin(*values), [column])


def unique(name, table, column, role="error", severity="error") -> Check:
    def rows(t: Tables, _: Limits) -> DataFrame:
        return duplicates(t[table].where(F.col(column).isNotNull()), [column])

    return Check(name, severity, role, (table,), rows, key=column)


def relationship(name, child, column, parent, parent_column, role, severity="error") -> Check:
    def rows(t: Tables, _: Limits) -> DataFrame:
        return orphans(t[child].select(column), t[parent], column, parent_column)

    return Check(name, severity, role, (child, parent), rows)


# ---- predicates and queries -----------------------------------------------------------------


def _outside(column: str, bounds: tuple[float, float]) -> Column:
    return (F.col(column) < bounds[0]) | (F.col(column) > bounds[1])


def _per_metric(table: str, test: Callable[[str, str], Column]):
    """A check made of one test per metric: violations add up, rows name the metric."""

    def rows(t: Tables, _: Limits) -> DataFrame:
        items = {m: [F.col(raw), test(raw, low)] for m, (raw, low) in METRICS.items()}
        long = melt(t[table], ["entity_id", "name"], items, ["metric", "raw_value", "bad"])
        return long.where("bad").drop("bad")

    def failures(_: Limits) -> Column:
        return total(F.count_if(test(raw, low)) for raw, low in METRICS.values())

    return rows, failures


_PARSED = _per_metric("silver", lambda raw, low: F.col(raw).isNotNull() & F.col(low).isNull())
_SHAPES = _per_metric("silver", lambda raw, low: ~shape_known(raw))


def unit_ratios(raw: DataFrame) -> DataFrame:
    """Median ratio of the two unit systems per metric, read from the newest raw documents and
    not from silver, so that it does not share the parser it guards."""
    day = latest_partition(raw)

    def first(path: str) -> Column:
        return first_number(F.get_json_object("payload", path))

    items = {
        "weight": [first("$.weight.imperial"), first("$.weight.metric")],
        "height": [first("$.height.metric"), first("$.height.imperial")],
    }
    return median_ratio(melt(day, [], items, ["metric", "numerator", "denominator"]), "metric", "n_entities")


def _ratio_off(t: Tables, _: Limits) -> DataFrame:
    off = F.lit(False)
    for metric, bounds in RATIO_RANGES.items():
        off = off | ((F.col("metric") == metric) & _outside("median_ratio", bounds))
    return unit_ratios(t["raw"]).where(off)


def _entity_lost(t: Tables, _: Limits) -> DataFrame:
    names = latest_partition(t["raw"]).agg(F.count_distinct(F.get_json_object("payload", "$.name"))).scalar()
    gold = t["dim"].agg(F.count(F.lit(1)).alias("n_actual")).withColumn("n_expected", names)
    return gold.where("n_actual <> n_expected").withColumn("lost", F.col("n_actual") - F.col("n_expected"))


def _source_tag_repeated(t: Tables, _: Limits) -> DataFrame:
    """Splits the source text again, because the bridge no longer shows a repeat. A key that is itself
    repeated may hold a tag in several rows, so tags are counted per key and not in their row."""
    parts = F.split("tags_raw", ",")
    tags = each_tag(t["silver"], ["entity_id"], parts, "part")
    folded = tags.select("entity_id", F.lower(F.trim("part")).alias("tag")).where("tag <> ''")
    return duplicates(folded, ["entity_id", "tag"], "n_occurrences")


def _share_above(bad: Callable[[], Column], limit: Callable[[Limits], float], bad_name: str, pct_name: str):
    """One violating row when the bad rows exceed a percentage of all rows."""

    def rows(t: Tables, limits: Limits) -> DataFrame:
        counts = t["dim"].agg(F.count_if(bad()).alias(bad_name), F.count(F.lit(1)).alias("n_total"))
        pct = share(bad_name, "n_total")
        return counts.where(pct > limit(limits)).select(
            bad_name, "n_total", round_to(pct, 2).alias(pct_name), F.lit(limit(limits)).alias("max_allowed_pct")
        )

    def failures(limits: Limits) -> Column:
        pct = share(F.count_if(bad()), F.count(F.lit(1)))
        return F.when(pct > limit(limits), F.lit(1)).otherwise(F.lit(0)).cast("long")

    return rows, failures


def _unbanded(strict: bool) -> Column:
    """A measured entity labelled 'unknown'. A gap in the bands gives NULL and not 'unknown';
    the strict form reports that too."""
    cls = F.col("size_class")
    bad = (cls == "unknown") | cls.isNull() if strict else cls == "unknown"
    return F.col(WEIGHT).isNotNull() & bad


def unbanded_rows(dim: DataFrame, strict: bool = False) -> DataFrame:
    return dim.where(_unbanded(strict)).select("entity_id", "name", WEIGHT, "size_class")


# ---- the suite ------------------------------------------------------------------------------

_ID = ["entity_id", "name"]

CHECKS: tuple[Check, ...] = (
    # invariants
    _row_level("weight_min_le_max", "error", "error", "silver",
               lambda: F.col("weight_min_kg") > F.col("weight_max_kg"),
               [*_ID, "weight_raw", "weight_min_kg", "weight_max_kg"]),
    _row_level("height_min_le_max", "error", "error", "silver",
               lambda: F.col("height_min_cm") > F.col("height_max_cm"),
               [*_ID, "height_raw", "height_min_cm", "height_max_cm"]),
    _row_level("lifespan_min_le_max", "error", "error", "silver",
               lambda: F.col("life_span_min_years") > F.col("life_span_max_years"),
               [*_ID, "life_span_raw", "life_span_min_years", "life_span_max_years"]),
    Check("metric_parsed", "error", "error", ("silver",), _PARSED[0], _PARSED[1]),
    Check("metric_shape_known", "warn", "warn", ("silver",), _SHAPES[0], _SHAPES[1]),
    _row_level("weight_mid_plausible", "error", "error", "dim",
               lambda: _outside(WEIGHT, WEIGHT_RANGE), [*_ID, "weight_raw", WEIGHT]),
    _row_level("lifespan_plausible", "error", "error", "dim",
               lambda: _outside(LIFE, LIFE_RANGE), [*_ID, "life_span_raw", LIFE]),
    Check("unit_ratio_plausible", "error", "error", ("raw",), _ratio_off),
    Check("bands_cover", "error", "error", ("bands",), lambda t, _: band_defects(t["bands"])),
    _row_level("no_entity_unbanded", "error", "error", "dim",
               lambda: _unbanded(False), [*_ID, WEIGHT, "size_class"]),
    Check("no_entity_lost", "error", "error", ("raw", "dim"), _entity_lost),
    _row_level("pct_of_class_sane", "error", "error", "class_tags",
               lambda: (F.col("n_entities") > F.col("n_in_class"))
               | (F.col("pct_of_class") <= 0) | (F.col("pct_of_class") > 100),
               ["size_class", "tag", "n_entities", "n_in_class", "pct_of_class"]),
    _row_level("tag_lowercased", "error", "error", "silver_tags",
               lambda: (F.col("tag") != F.lower("tag")) | (F.col("tag") != F.trim("tag")),
               ["entity_id", "tag"]),
    Check("tag_unique_per_entity", "error", "error", ("silver_tags",),
          lambda t, _: duplicates(t["silver_tags"], ["entity_id", "tag"])),
    Check("source_tag_not_duplicated", "warn", "warn", ("silver",), _source_tag_repeated),
    _row_level("tag_not_freetext", "warn", "warn", "silver_tags",
               lambda: word_count("tag") > MAX_TAG_WORDS, ["entity_id", "tag"]),
    Check("unknown_bucket_small", "warn", "warn", ("dim",),
          *_share_above(lambda: F.col("size_class") == "unknown", lambda x: x.max_unknown_pct,
                       "n_unknown", "unknown_pct")),
    Check("lifespan_null_rate_stable", "warn", "warn", ("dim",),
          *_share_above(lambda: F.col(LIFE).isNull(), lambda x: x.max_null_pct, "n_null", "null_pct")),
    # keys and domains
    unique("silver_id_unique", "silver", "entity_id"),
    not_null("silver_id_not_null", "silver", "entity_id"),
    unique("silver_name_unique", "silver", "name"),
    not_null("silver_name_not_null", "silver", "name"),
    unique("dim_id_unique", "dim", "entity_id", "regression guard"),
    not_null("dim_id_not_null", "dim", "entity_id", "regression guard"),
    unique("dim_name_unique", "dim", "name", "regression guard"),
    not_null("dim_name_not_null", "dim", "name", "regression guard"),
    not_null("dim_class_not_null", "dim", "size_class", "regression guard"),
    accepted_values("dim_class_accepted", "dim", "size_class", CLASS_LABELS, "regression guard"),
    relationship("tags_in_dim", "tags", "entity_id", "dim", "entity_id", "regression guard"),
    unique("scatter_id_unique", "scatter", "entity_id", "regression guard"),
    not_null("correlation_not_null", "correlations", "correlation"),
    # seeds
    unique("bands_label_unique", "bands", "label", "seed integrity"),
    not_null("bands_label_not_null", "bands", "label", "seed integrity"),
    not_null("bands_min_not_null", "bands", "min_kg", "seed integrity"),
    not_null("bands_max_not_null", "bands", "max_kg", "seed integrity"),
    unique("curated_tag_unique", "curated", "tag", "seed integrity"),
    relationship("curated_tag_in_tags", "curated", "tag", "tags", "tag", "warn", "warn"),
    not_null("curated_order_not_null", "curated", "sort_order", "seed integrity"),
    unique("curated_order_unique", "curated", "sort_order", "seed integrity"),
)

BY_NAME = {c.name: c for c in CHECKS}


def violations(name: str, tables: Tables, limits: Limits = Limits()) -> DataFrame:
    """The violating rows of one check."""
    return BY_NAME[name].rows(tables, limits)


def count_check(name: str, tables: Tables, limits: Limits = Limits()) -> DataFrame:
    """(check, failures) of one check."""
    check = BY_NAME[name]
    if check.failures is not None:
        return _as_rows(tables[check.inputs[0]].agg(check.failures(limits).alias(name)))
    return _as_rows(_count_rows(check, tables, limits))


def _count_rows(check: Check, tables: Tables, limits: Limits) -> DataFrame:
    return check.rows(tables, limits).agg(F.count(F.lit(1)).alias(check.name))


def _as_rows(counts: DataFrame) -> DataFrame:
    items = [F.struct(F.lit(c).alias("check"), F.col(c).alias("failures")) for c in counts.columns]
    return counts.select(F.inline(F.array(*items)))


def _key_counts(df: DataFrame, group: Sequence[Check]) -> DataFrame:
    """Repeated keys of several key columns from one scan and one shuffle."""
    keys = melt(df, [], {c.name: F.col(c.key).cast("string") for c in group}, ["check", "key"])
    repeated = keys.groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))
    hit = (F.col("n") > 1) & F.col("key").isNotNull()
    return repeated.agg(*[F.count_if(hit & (F.col("check") == c.name)).alias(c.name) for c in group])


def _jobs(tables: Tables, limits: Limits, checks: Sequence[Check]):
    """(checks, function that builds their one-row count): per table, all counting checks share
    one aggregate and all key checks one shuffle; the rest are queries of their own."""
    counting: dict[str, list[Check]] = {}
    keyed: dict[str, list[Check]] = {}
    jobs = []
    for check in checks:
        if check.failures is not None:
            counting.setdefault(check.inputs[0], []).append(check)
        elif check.key is not None:
            keyed.setdefault(check.inputs[0], []).append(check)
        else:
            jobs.append(([check], lambda c=check: _count_rows(c, tables, limits)))
    for table, group in counting.items():
        jobs.append(
            (group, lambda t=table, g=group: tables[t].agg(*[c.failures(limits).alias(c.name) for c in g]))
        )
    for table, group in keyed.items():
        jobs.append((group, lambda t=table, g=group: _key_counts(tables[t], g)))
    return jobs


def _verdict(check: Check, failures: int, error_above: Mapping[str, int]) -> str:
    if failures == 0:
        return "pass"
    limit = error_above.get(check.name)
    if check.severity == "warn" and (limit is None or failures <= limit):
        return "warn"
    return "fail"


def run_suite(
    tables: Tables,
    run_id: str,
    limits: Limits = Limits(),
    checks: Sequence[Check] = CHECKS,
    error_above: Mapping[str, int] | None = None,
    force_failure: bool = False,
    force_warning: bool = False,
    spark: SparkSession | None = None,
    parallel: int = 4,
) -> DataFrame:
    """One row per check: status pass, warn, fail or error, number of violations, a message, when the
    count began and how long it took (checks that share a scan share these).

    Runs the counts as a handful of Spark jobs, a few at a time; what comes back is one number per
    check. A check whose table is missing or whose query fails is an error and never left out.
    ``error_above`` turns a warning into a failure past a second limit on its violations. The
    force switches add a check that always fires, to exercise the failure and warning paths.
    """
    spark = spark or next(iter(tables.values())).sparkSession
    found: dict[str, tuple] = {}
    begun = datetime.now(timezone.utc)
    ready = []
    for check in checks:
        absent = [i for i in check.inputs if i not in tables]
        if absent:
            found[check.name] = ("error", None, f"input missing: {', '.join(absent)}", begun, 0.0)
        else:
            ready.append(check)

    def work(job) -> None:
        group, build = job
        start = datetime.now(timezone.utc)
        took = lambda: (datetime.now(timezone.utc) - start).total_seconds()
        try:
            counts = build().first().asDict()
        except Exception as problem:  # noqa: BLE001 - a broken check is a result of the suite
            if len(group) > 1:
                for check in group:
                    work(([check], lambda c=check: _count_rows(c, tables, limits)))
                return
            found[group[0].name] = ("error", None, str(problem), start, took())
            return
        for check in group:
            n = counts[check.name]
            message = f"{n} violating rows" if n else None
            found[check.name] = (_verdict(check, n, error_above or {}), n, message, start, took())

    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(inheritable_thread_target(spark)(work), _jobs(tables, limits, ready)))
    rows = [(run_id, c.name, c.severity, c.role, *found[c.name]) for c in checks]
    if force_failure:
        rows.append((run_id, "forced_failure", "error", "drill", "fail", 1, "1 violating rows", begun, 0.0))
    if force_warning:
        rows.append((run_id, "forced_warning", "warn", "drill", "warn", 1, "1 violating rows", begun, 0.0))
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def blocking(results: DataFrame) -> DataFrame:
    """The results that must stop a publish."""
    return results.where(F.col("status").isin("fail", "error"))
