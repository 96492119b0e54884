"""Exploratory frames over one row per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.numbers import round_to
from siltstone.operators.bands import bucketize
from siltstone.operators.stats import build_index, pearson
from siltstone.operators.tags import (
    class_tag_counts, entity_groups, pivot_classes, split_tags, tag_index, with_class_size,
)
from siltstone.plans.marts import HEIGHT, LIFE, WEIGHT

# The default cuts and class labels.
CUTS = [5.0, 12.0, 25.0, 45.0]
CLASSES = ["toy", "small", "medium", "large", "giant"]

# Tags that belong to each trait group.
TRAIT_GROUPS = {
    "guardian": ["protective", "courageous", "alert", "confident", "fearless",
                 "determined", "tenacious", "reserved", "aloof"],
    "affectionate": ["affectionate", "friendly", "gentle", "loyal", "devoted", "outgoing",
                     "good-natured", "amiable", "charming", "merry", "cheerful",
                     "sensitive", "optimistic", "happy"],
    "energetic": ["energetic", "playful", "lively", "spirited", "athletic", "agile",
                  "curious", "mischievous", "hardy"],
    "calm": ["calm", "docile", "even-tempered", "easygoing", "patient", "dignified"],
    "clever": ["intelligent", "smart", "work-focused", "eager to please", "adaptable",
               "independent"],
}

# The two sides of the energy index.
ENERGETIC_TAGS = ["energetic", "playful", "lively", "spirited", "athletic", "agile", "curious", "mischievous"]
CALM_TAGS = ["calm", "docile", "even-tempered", "easygoing", "patient", "dignified", "gentle", "reserved", "aloof"]


def explorer_rows(dim: DataFrame, cuts: Sequence[float] = CUTS, labels: Sequence[str] = CLASSES) -> DataFrame:
    """Measures, a class from free cuts (NULL without a weight), and the tags with their repeats."""
    return dim.select(
        "entity_id", "name", WEIGHT, HEIGHT, LIFE,
        bucketize(WEIGHT, cuts, labels).alias("size_class"),
        F.coalesce(split_tags("tags_raw"), F.array().cast("array<string>")).alias("tags"),
    )


def class_counts(rows: DataFrame, labels: Sequence[str] = CLASSES) -> DataFrame:
    """Every label in order, 0 for a class without rows; one aggregate, no join."""
    sums = rows.agg(*[F.count_if(F.col("size_class") == c).alias(c) for c in labels])
    items = [F.struct(F.lit(c).alias("size_class"), F.lit(i).alias("class_rank"), F.col(c).alias("n_entities"))
             for i, c in enumerate(labels, 1)]
    return sums.select(F.inline(F.array(*items)))


def class_means(rows: DataFrame, labels: Sequence[str] = CLASSES) -> DataFrame:
    """Means per class rounded to one place, mean build index, in class order."""
    sized = F.when(F.col(HEIGHT).isNotNull() & F.col(WEIGHT).isNotNull(), build_index(HEIGHT, WEIGHT))
    rank = F.array_position(F.array(*[F.lit(c) for c in labels]), F.col("size_class")).cast("int")
    return (
        rows.where(F.col("size_class").isNotNull())
        .groupBy("size_class")
        .agg(
            round_to(F.avg(LIFE), 1).alias("mean_life"),
            round_to(F.avg(WEIGHT), 1).alias("mean_kg"),
            round_to(F.avg(HEIGHT), 1).alias("mean_cm"),
            F.count("name").alias("n"),
            F.avg(sized).alias("mean_build_index"),
        )
        .withColumn("class_rank", rank)
        .orderBy("class_rank")
    )


def _class_group_counts(rows: DataFrame, mapping) -> DataFrame:
    """(size_class, grp, n, n_class): entities of a class that mention the group."""
    banded = rows.where(F.col("size_class").isNotNull()).select(
        "size_class", entity_groups(mapping or TRAIT_GROUPS).alias("groups")
    )
    return with_class_size(class_tag_counts(banded, "size_class", "groups", "grp"), "size_class", "grp")


def group_prevalence(rows: DataFrame, labels: Sequence[str] = CLASSES, mapping=None) -> DataFrame:
    """Percent of a class with at least one tag of the group, one column per class."""
    counted = _class_group_counts(rows, mapping).withColumn("pct", F.col("n") / F.col("n_class") * 100)
    return pivot_classes(counted, "grp", "size_class", labels, "pct")


def mention_share(rows: DataFrame, mapping=None) -> DataFrame:
    """The mix of groups within a class: sums to 100 per class."""
    whole = F.sum("n").over(Window.partitionBy("size_class"))
    return _class_group_counts(rows, mapping).select(
        "size_class", "grp", F.col("n").alias("n_mentions"), (F.col("n") / whole * 100).alias("pct_of_mentions")
    )


def energy_by_class(rows: DataFrame) -> DataFrame:
    """Mean of (energetic less calm tags) per class, with its correlation to weight overall."""
    scored = rows.select("size_class", WEIGHT, tag_index("tags", ENERGETIC_TAGS, CALM_TAGS).alias("energy"))
    overall = scored.agg(pearson(WEIGHT, "energy")).scalar()
    return (
        scored.where(F.col("size_class").isNotNull())
        .groupBy("size_class")
        .agg(F.avg("energy").alias("mean_energy"))
        .withColumn("corr_with_weight", overall)
    )
