"""Bronze to silver: newest day, JSON fields, folded text, number envelopes, one row per name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.jsontext import json_fields
from siltstone.functions.numbers import envelope, numbers
from siltstone.functions.text import missing_score, null_if, to_id
from siltstone.operators.dedupe import dedupe
from siltstone.operators.tags import tag_bridge
from siltstone.sources.landing import latest_partition

# Where the source payload keeps its fields.
PATHS = {
    "id": "id",
    "name": "name",
    "weight": "weight.metric",
    "height": "height.metric",
    "life_span": "life_span",
    "entity_group": "breed_group",
    "origin": "origin",
    "country_code": "country_code",
    "description": "description",
    "history": "history",
    "purpose": "bred_for",
    "tags": "temperament",
    "image_id": "reference_image_id",
    "image_url": "image.url",
}

# The fields whose blanks make up the missing score.
SCORED = (
    "description", "history", "origin", "country_code", "entity_group", "tags",
    "life_span", "purpose", "image_id", "weight", "height",
)

# Fixed value: a free text that stands where a tag list should be.
TAG_SENTINELS = ("variable depending on ancestry and individual traits",)


@dataclass(frozen=True)
class SilverSpec:
    """What differs between sources: field paths and the literals that mean "no value"."""

    paths: dict[str, str] = field(default_factory=lambda: dict(PATHS))
    scored: tuple[str, ...] = SCORED
    metric_sentinels: tuple[str, ...] = ("unknown",)
    tag_sentinels: tuple[str, ...] = TAG_SENTINELS


DEFAULT = SilverSpec()


def cleaned(bronze: DataFrame, spec: SilverSpec = DEFAULT) -> DataFrame:
    """The newest day with typed text columns, before numbers are read and names deduplicated."""
    raw = json_fields(latest_partition(bronze), "payload", spec.paths, keep=("loaded_at",))
    text = {c: null_if(c, fold=False) for c in ("entity_group", "origin", "country_code", "description")}
    return raw.select(
        to_id("id").alias("entity_id"),
        F.trim("name").alias("name"),
        null_if("weight", spec.metric_sentinels).alias("weight_raw"),
        null_if("height", spec.metric_sentinels).alias("height_raw"),
        null_if("life_span", fold=False).alias("life_span_raw"),
        *[c.alias(n) for n, c in text.items()],
        null_if("tags", fold=False).alias("tags_raw"),
        "image_url",
        missing_score(spec.scored).alias("n_missing_fields"),
        "loaded_at",
    )


def entities(bronze: DataFrame, spec: SilverSpec = DEFAULT) -> DataFrame:
    """One row per trimmed name: the most complete record, then the lowest id.

    Names are deduplicated on the raw text columns, and numbers are read from the survivors only.
    """
    kept = dedupe(cleaned(bronze, spec), ["name"], ["n_missing_fields", "entity_id"])
    lists = kept.select(
        "*",
        numbers("weight_raw").alias("__w"),
        numbers("height_raw").alias("__h"),
        numbers("life_span_raw").alias("__l"),
    )
    (w_lo, w_hi), (h_lo, h_hi) = envelope("__w"), envelope("__h")
    l_lo, l_hi = envelope("__l", as_int=True)
    return lists.select(
        "entity_id", "name", "weight_raw", "height_raw", "life_span_raw",
        w_lo.alias("weight_min_kg"), w_hi.alias("weight_max_kg"),
        h_lo.alias("height_min_cm"), h_hi.alias("height_max_cm"),
        l_lo.alias("life_span_min_years"), l_hi.alias("life_span_max_years"),
        "entity_group", "origin", "country_code", "description", "tags_raw", "image_url",
        "n_missing_fields", "loaded_at",
    )


def bridge(silver: DataFrame, spec: SilverSpec = DEFAULT, key_is_unique: bool = False) -> DataFrame:
    """Distinct (entity_id, tag, tag_display)."""
    return tag_bridge(silver, "entity_id", "tags_raw", ",", spec.tag_sentinels, key_is_unique)
