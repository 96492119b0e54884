"""One run: silver, checks, gold in a shadow, checks, publish."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.tags import distinct_tags, share_of_class_by_row
from siltstone.plans import marts
from siltstone.plans.checks import CHECKS, RESULT_SCHEMA, Limits, blocking, run_suite
from siltstone.plans.contracts import conformed
from siltstone.plans.observe import append_results
from siltstone.plans.publish import live_runs, materialize, publish
from siltstone.plans.silver import DEFAULT, SilverSpec, bridge, entities
from siltstone.sources.files import curated_tags, size_bands
from siltstone.sources.landing import read_latest
from siltstone.sources.tables import database_for, ensure_database, show_run

# Each stage's tables, and the checks that become possible once they stand.
STAGES = (("silver", "silver_tags"), ("dim", "tags"), ("class_summary", "scatter", "correlations", "class_tags", "coverage"))
GOLD = STAGES[1] + STAGES[2]


@dataclass(frozen=True)
class Run:
    """Where and how to run. ``prod`` publishes after the checks, ``dev`` builds straight into
    what its readers see. Tables lie below ``base``; in the catalog their databases carry ``database``, a name
    after the base folder unless given, with the target behind it."""

    base: str
    target: str = "prod"
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    run_date: date = field(default_factory=date.today)
    spec: SilverSpec = DEFAULT
    limits: Limits = Limits()
    silver_as: str = "table"
    force_failure: bool = False
    force_warning: bool = False
    # A second limit on a warning's violations, by check; past it the warning stops the run.
    error_above: Mapping[str, int] = field(default_factory=dict)
    database: str = ""

    @property
    def root(self) -> str:
        return f"{self.base.rstrip('/')}/{self.target}"

    @property
    def gold(self) -> str:
        """The database of the published views and of the runs' tables behind them."""
        return f"{self.database or database_for(self.base, 'gold')}_{self.target}"

    @property
    def silver(self) -> str:
        return f"{self.gold}_silver"

    @property
    def history(self) -> str:
        return f"{self.root}/check_results"


@dataclass(frozen=True)
class Report:
    published: bool
    results: list
    tables: list[str]


def _checks_ready(have: set[str], done: set[str]):
    return [c for c in CHECKS if set(c.inputs) <= have and c.name not in done]


def run(spark: SparkSession, run: Run, bronze: DataFrame | None = None) -> Report:
    """Build and check in stages; a failing check stops the stages after it, whose tables and
    checks are reported as skipped. Results are stored in every case. A run that another one has overtaken
    raises instead of publishing over it."""
    if run.target not in ("prod", "dev"):
        raise ValueError(f"unknown target: {run.target}")
    if bronze is None:
        bronze = read_latest(spark, f"{run.base.rstrip('/')}/bronze")
    tables: dict[str, DataFrame] = {"raw": bronze, "bands": size_bands(spark), "curated": curated_tags(spark)}
    ensure_database(spark, run.gold, f"{run.root}/gold")
    ensure_database(spark, run.silver, f"{run.root}/silver")
    before = live_runs(spark, run.gold, GOLD)
    results: list = []
    done: set[str] = set()
    stopped = False
    try:
        for stage, names in enumerate(STAGES):
            if stopped:
                break
            for name in names:
                tables[name] = _build(name, tables, run)
            ready = _checks_ready(set(tables), done)
            forced = stage == 0
            outcome = run_suite(
                tables, run.run_id, run.limits, ready, run.error_above, spark=spark,
                force_failure=forced and run.force_failure, force_warning=forced and run.force_warning,
            ).collect()
            done |= {c.name for c in ready}
            results += outcome
            stopped = any(r["status"] in ("fail", "error") for r in outcome)
    except Exception as problem:
        results.append(_row(run.run_id, "build", "error", "build", "error", None, str(problem)))
        _store(spark, run, results)
        raise
    left = [c for c in CHECKS if c.name not in done]
    if stopped:
        results += [_row(run.run_id, c.name, c.severity, c.role, "skipped", None, "an earlier check failed") for c in left]
    elif left:
        # Nothing failed, so a check that is left has an input that no stage builds: an error, which blocks.
        results += run_suite(tables, run.run_id, run.limits, left, run.error_above, spark=spark).collect()
    results += [
        _row(run.run_id, f"table {name}", "error", "build", "skipped", None, "an earlier check failed")
        for names in STAGES
        for name in names
        if name not in tables
    ]
    stored = _store(spark, run, results)
    if run.target == "dev" or blocking(stored).limit(1).count():
        return Report(run.target == "dev" and not stopped, stored.collect(), [])
    live = publish(spark, run.gold, run.run_id, GOLD, seen=before)
    return Report(True, stored.collect(), live)


def _build(name: str, t: dict[str, DataFrame], run: Run) -> DataFrame:
    """The fixed call order of the layers: what each table is made of."""
    tags = distinct_tags("tags_raw", ",", run.spec.tag_sentinels)
    made = {
        "silver": lambda: entities(t["raw"], run.spec),
        "silver_tags": lambda: bridge(t["silver"], run.spec),
        "dim": lambda: marts.dimension(t["silver"], t["bands"]),
        "tags": lambda: t["silver_tags"].select("entity_id", "tag", "tag_display"),
        "class_summary": lambda: marts.class_summary(t["dim"]),
        "scatter": lambda: marts.scatter_rows(t["dim"]),
        "correlations": lambda: marts.correlations(t["dim"]),
        # the dimension still carries each row's tag text: no join back to the bridge is needed
        "class_tags": lambda: share_of_class_by_row(t["dim"], tags),
        "coverage": lambda: marts.coverage_by_row(t["dim"], tags),
    }[name]()
    gold = name in GOLD
    database = run.gold if gold else run.silver
    stored = materialize(conformed(name, made), name, "table" if gold else run.silver_as, database, run.run_id)
    if gold and run.target == "dev":
        show_run(made.sparkSession, database, [name], run.run_id)
    return stored


def _row(*values):
    return (*values, datetime.now(timezone.utc), 0.0)


def _store(spark: SparkSession, run: Run, results: list) -> DataFrame:
    """A run's results are a few dozen rows; they are kept even when the run fails."""
    stored = spark.createDataFrame([tuple(r) for r in results], RESULT_SCHEMA)
    append_results(stored, run.history, run.run_date)
    return stored


def check_history(spark: SparkSession, run: Run) -> DataFrame:
    return spark.read.parquet(run.history).withColumn("run_date", F.col("run_date").cast("date"))
