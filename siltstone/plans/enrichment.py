"""Enrichment from outside: untrusted rows are checked against the dimension before readers see them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.joins import melt
from siltstone.sources.tables import quoted, run_table, show_run, write_table


class EnrichmentRejected(ValueError):
    """The enrichment must not replace the one that is shown."""


def enrichment_checks(
    enrichment: DataFrame, dim: DataFrame, key: str, accepted: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """(check, failures): keys that are NULL, keys that come twice, rows whose key the dimension lacks, and per
    column of ``accepted`` the rows with another value; a NULL value is none.

    One aggregate by key, which combines a hot or NULL key before the shuffle, and one join with the
    dimension's keys.
    """
    accepted = accepted or {}
    bad = {c: F.col(c).isNotNull() & ~F.col(c).isin(list(values)) for c, values in accepted.items()}
    per_key = enrichment.groupBy(F.col(key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(test).alias(f"__bad_{i}") for i, test in enumerate(bad.values())]
    )
    known = dim.select(F.col(key).alias("__key"), F.lit(True).alias("__known")).distinct()
    keyed, none = per_key.join(known, "__key", "left"), F.col("__key").isNull()
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))
    counts = keyed.agg(
        total(F.when(none, F.col("__n"))).alias("not_null"),
        F.count_if(~none & (F.col("__n") > 1)).alias("unique"),
        total(F.when(~none & F.col("__known").isNull(), F.col("__n"))).alias("known"),
        *[total(f"__bad_{i}").alias(f"accepted_{i}") for i in range(len(bad))],
    )
    items = {f"{key}_not_null": F.col("not_null"), f"{key}_unique": F.col("unique"), f"{key}_in_dimension": F.col("known")}
    items |= {f"{c}_accepted": F.col(f"accepted_{i}") for i, c in enumerate(bad)}
    return melt(counts, [], items, ["check", "failures"])


def land_enrichment(
    enrichment: DataFrame,
    dim: DataFrame,
    database: str,
    name: str,
    run_id: str,
    key: str,
    accepted: Mapping[str, Sequence] | None = None,
) -> None:
    """Write the enrichment as the run's table, check what was written, then let the view show it.

    With a violation the run's table goes, the earlier enrichment stays in view and the report is raised.
    """
    spark = enrichment.sparkSession
    written = write_table(enrichment, database, name, run_id)
    failed = enrichment_checks(written, dim, key, accepted).where("failures > 0").collect()
    if failed:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(f'{database}.{run_table(name, run_id)}')}")
        raise EnrichmentRejected(f"{name} of {run_id}: " + ", ".join(f"{r['check']} {r['failures']}" for r in failed))
    show_run(spark, database, [name], run_id)
