"""The gold layer: the dimension and five marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.numbers import midpoint, width
from siltstone.operators.bands import classify_bands
from siltstone.operators.joins import melt
from siltstone.operators.stats import group_summary, pairwise_corr

WEIGHT, HEIGHT, LIFE = "weight_mid_kg", "height_mid_cm", "life_span_mid_years"

# The metric pairs of the correlation mart.
CORRELATION_PAIRS = [(WEIGHT, LIFE), (HEIGHT, LIFE), (HEIGHT, WEIGHT)]


def dimension(silver: DataFrame, bands: DataFrame) -> DataFrame:
    """Silver plus midpoints, life span width and size class."""
    derived = silver.select(
        "*",
        midpoint("weight_min_kg", "weight_max_kg").alias(WEIGHT),
        midpoint("height_min_cm", "height_max_cm").alias(HEIGHT),
        midpoint("life_span_min_years", "life_span_max_years").alias(LIFE),
        width("life_span_min_years", "life_span_max_years").alias("life_span_range_years"),
    )
    return classify_bands(derived, WEIGHT, bands)


def class_summary(dim: DataFrame) -> DataFrame:
    return group_summary(
        dim, "size_class", LIFE, [WEIGHT, HEIGHT],
        names={
            "count": "n_entities", "with_value": "n_with_life_span",
            "mean": "mean_life_span_years", "median": "median_life_span_years",
            "stddev": "stddev_life_span_years", "min": "min_life_span_years", "max": "max_life_span_years",
            f"mean_{WEIGHT}": "mean_weight_kg", f"mean_{HEIGHT}": "mean_height_cm",
        },
        continuous=False,  # years, in halves
    )


def scatter_rows(dim: DataFrame) -> DataFrame:
    return dim.select(
        "entity_id", "name", "size_class", WEIGHT, "life_span_min_years", "life_span_max_years", LIFE
    )


def correlations(dim: DataFrame) -> DataFrame:
    return pairwise_corr(dim, CORRELATION_PAIRS)


def coverage(dim: DataFrame, bridge: DataFrame, silver: DataFrame) -> DataFrame:
    """One row. Entities with a tag are counted in the bridge and the load time in silver; both
    come in as scalar subqueries."""
    a, b = F.col(WEIGHT), F.col(LIFE)
    both = F.count_if(a.isNotNull() & b.isNotNull())
    counts = dim.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(a).alias("n_with_weight"),
        F.count(b).alias("n_with_life_span"),
        both.alias("n_with_both"),
        both.alias("n_plotted"),
        F.count_if(a.isNull() | b.isNull()).alias("n_excluded"),
    )
    tagged = bridge.agg(F.count_distinct("entity_id")).scalar()
    loaded = silver.agg(F.max("loaded_at")).scalar()
    return counts.select(
        "n_total", "n_with_weight", "n_with_life_span", "n_with_both",
        tagged.alias("n_with_tags"), "n_plotted", "n_excluded", loaded.alias("last_refreshed_at"),
    )


def coverage_by_row(dim: DataFrame, tags: Column) -> DataFrame:
    """The same row from one scan of the dimension, where each row still has its tag list: an
    entity is in the bridge if its distinct tags are not empty."""
    a, b = F.col(WEIGHT), F.col(LIFE)
    both = F.count_if(a.isNotNull() & b.isNotNull())
    return dim.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(a).alias("n_with_weight"),
        F.count(b).alias("n_with_life_span"),
        both.alias("n_with_both"),
        F.count_if(F.coalesce(F.size(tags) > 0, F.lit(False))).alias("n_with_tags"),
        both.alias("n_plotted"),
        F.count_if(a.isNull() | b.isNull()).alias("n_excluded"),
        F.max("loaded_at").alias("last_refreshed_at"),
    )


# The rows of the long coverage table.
COVERAGE_MEASURES = {
    "total entities": "n_total",
    "with a weight": "n_with_weight",
    "with a life span": "n_with_life_span",
    "with both": "n_with_both",
    "with tags": "n_with_tags",
    "plotted": "n_plotted",
    "excluded": "n_excluded",
}


def coverage_long(cov: DataFrame) -> DataFrame:
    return melt(cov, [], {m: F.col(c) for m, c in COVERAGE_MEASURES.items()}, ["measure", "n_entities"])


def population_consistency(cov: DataFrame, corr: DataFrame) -> DataFrame:
    """Do coverage, scatter and correlation speak of the same population?"""
    n = corr.where((F.col("metric_a") == WEIGHT) & (F.col("metric_b") == LIFE)).select("n_entities").scalar()
    return cov.select(
        "n_with_both", "n_plotted", n.alias("n_correlated"),
        ((F.col("n_with_both") == F.col("n_plotted")) & (F.col("n_plotted") == n)).alias("consistent"),
    )
