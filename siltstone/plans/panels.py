"""Reader queries over the gold layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.labels import band_label, denominator, fixed, range_label, signed
from siltstone.functions.text import map_label
from siltstone.operators.bands import in_band_order
from siltstone.operators.joins import complete_grid
from siltstone.plans.marts import HEIGHT, LIFE, WEIGHT

# Display names of the metrics.
METRIC_LABELS = {WEIGHT: "weight", HEIGHT: "height", LIFE: "life span"}


def ordered_summary(summary: DataFrame, bands: DataFrame) -> DataFrame:
    """Band order taken from the seed; 'unknown' is not in the seed and drops out."""
    return in_band_order(summary, bands)


def band_labels(summary: DataFrame, bands: DataFrame) -> DataFrame:
    named = bands.select(F.col("label").alias("size_class"), band_label("min_kg", "max_kg").alias("band"))
    return summary.join(named, "size_class").select(
        "size_class", "band", F.concat_ws("|", "size_class", "band").alias("axis_label"), "n_entities"
    )


def plotted(scatter: DataFrame) -> DataFrame:
    return scatter.where(F.col(WEIGHT).isNotNull() & F.col(LIFE).isNotNull())


def axis_window(df: DataFrame, low: str = LIFE, high: str | None = None) -> DataFrame:
    """Ten percent of room below the smallest and above the largest value."""
    return df.agg(
        (F.min(low) * F.lit(0.9)).alias("axis_min"), (F.max(high or low) * F.lit(1.1)).alias("axis_max")
    )


def mean_sd_band(summary: DataFrame) -> DataFrame:
    mean, sd = F.col("mean_life_span_years"), F.col("stddev_life_span_years")
    return summary.select(
        "size_class", mean, sd, (mean - sd).alias("low"), (mean + sd).alias("high")
    )


def longest_lived(scatter: DataFrame, k: int = 5) -> DataFrame:
    """The k highest midpoints, ties by name then id, listed by name; ``all_tied`` when they all
    share one published range. Spark keeps k rows per task, so nothing is sorted as a whole."""
    rows = plotted(scatter).orderBy(F.desc(LIFE), "name", "entity_id").limit(k)
    ranges = rows.agg(
        F.count_distinct(F.struct("life_span_min_years", "life_span_max_years"))
    ).scalar()
    return rows.select(
        "name", "size_class",
        fixed(WEIGHT, 1).alias("weight_kg"),
        range_label("life_span_min_years", "life_span_max_years").alias("published_range"),
        (ranges == 1).alias("all_tied"),
    ).orderBy("name")


def denominators(summary: DataFrame) -> DataFrame:
    return summary.select(
        "size_class", denominator("size_class", "n_with_life_span", "n_entities").alias("text")
    )


def corr_table(corr: DataFrame) -> DataFrame:
    pair = F.concat(map_label("metric_a", METRIC_LABELS), F.lit(" ↔ "), map_label("metric_b", METRIC_LABELS))
    return corr.select(pair.alias("pair"), signed("correlation", 2).alias("correlation"), "n_entities")


def narrowest_spread(summary: DataFrame, low: str = "toy", high: str = "giant") -> DataFrame:
    """The class with the smallest deviation, and how far two class means lie apart."""

    def mean_of(label: str):
        return F.max(F.when(F.col("size_class") == label, F.col("mean_life_span_years")))

    key = F.struct("stddev_life_span_years", "size_class")
    known = F.col("stddev_life_span_years").isNotNull()
    return summary.agg(
        F.min_by("size_class", F.when(known, key)).alias("narrowest_class"),
        F.min("stddev_life_span_years").alias("stddev_life_span_years"),
        (mean_of(low) - mean_of(high)).alias("mean_gap"),
    )


def heatmap_grid(shares: DataFrame, summary: DataFrame, curated: DataFrame, classes: list[str]) -> DataFrame:
    """Curated tags by class, pairs that do not occur as 0, class sizes and labels re-attached."""
    facts = shares.where(F.col("size_class").isin(classes)).select(
        "tag", "size_class", "n_entities", "pct_of_class", "tag_display"
    )
    grid = complete_grid(
        facts, curated, classes, "tag", "size_class", {"n_entities": 0, "pct_of_class": 0.0}
    )
    sizes = summary.select("size_class", F.col("n_entities").alias("n_in_class"))
    label = F.max("tag_display").over(Window.partitionBy("tag"))
    return (
        grid.withColumn("tag_display", label)
        .join(sizes, "size_class", "left")
        .join(curated, "tag")
        .select("tag", "tag_display", "sort_order", "size_class", "n_entities", "n_in_class", "pct_of_class")
    )
