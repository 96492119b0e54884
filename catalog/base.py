"""Registry, shared inputs, and the SQL building blocks of the comparison side."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures
from catalog.fixtures import FREE_TEXT_TAG, KINDS, SCALED_DOCUMENTS
from siltstone.operators.tags import distinct_tags, share_of_class_by_row
from siltstone.plans import marts, silver
from siltstone.plans.explore import explorer_rows
from siltstone.session import write_scratch
from siltstone.sources import files

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}

SPEC = silver.SilverSpec(tag_sentinels=(FREE_TEXT_TAG,))


def query(name: str, sql: str | None = None, kind: str | None = "scaled"):
    """Register a query; ``sql`` may use the blocks below as tables, unless ``kind`` is None."""

    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = with_blocks(sql, kind) if kind else sql.strip()
        return build

    return register


@dataclass
class Layers:
    """The layers over the scaled documents, built when asked for."""

    spark: SparkSession
    sf_dir: str
    kind: str = "scaled"
    stored_dim: DataFrame | None = None

    def stored(self) -> Layers:
        """The same layers over a dimension that is written once and read by all that follows."""
        return replace(self, stored_dim=write_scratch(self.dim, "dim"))

    @property
    def bronze(self) -> DataFrame:
        return fixtures.bronze(self.spark, self.sf_dir, self.kind)

    @property
    def bands(self) -> DataFrame:
        return files.size_bands(self.spark)

    @property
    def curated(self) -> DataFrame:
        return files.curated_tags(self.spark)

    @property
    def cleaned(self) -> DataFrame:
        return silver.cleaned(self.bronze, SPEC)

    @property
    def silver(self) -> DataFrame:
        return silver.entities(self.bronze, SPEC)

    @property
    def bridge(self) -> DataFrame:
        return silver.bridge(self.silver, SPEC)

    @property
    def dim(self) -> DataFrame:
        return self.stored_dim if self.stored_dim is not None else marts.dimension(self.silver, self.bands)

    @property
    def summary(self) -> DataFrame:
        return marts.class_summary(self.dim)

    @property
    def shares(self) -> DataFrame:
        return share_of_class_by_row(self.dim, distinct_tags("tags_raw", ",", SPEC.tag_sentinels))

    @property
    def scatter(self) -> DataFrame:
        return marts.scatter_rows(self.dim)

    @property
    def correlations(self) -> DataFrame:
        return marts.correlations(self.dim)

    @property
    def coverage(self) -> DataFrame:
        return marts.coverage_by_row(self.dim, distinct_tags("tags_raw", ",", SPEC.tag_sentinels))

    @property
    def explorer(self) -> DataFrame:
        return explorer_rows(self.dim)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shown_time(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last digits; compare to six places."""
    return df.withColumns({c: F.round(c, places) for c in columns})


# ---- SQL blocks -----------------------------------------------------------------------------

NUM = "'[0-9]+(\\.[0-9]+)?'"


def js(path: str) -> str:
    return f"json_extract_string(payload, '$.{path}')"


def r2(expr: str, places: int = 2) -> str:
    return f"round({expr}, {places})"


BANDS_SQL = "select * from (values ('toy',0,5),('small',5,12),('medium',12,25),('large',25,45),('giant',45,999)) v(label, min_kg, max_kg)"
CURATED_SQL = "select * from (values ('playful',1),('alert',2),('energetic',3),('protective',4),('calm',5)) v(tag, sort_order)"

_SCORED_PATHS = [
    "description", "history", "origin", "country_code", "breed_group", "temperament", "life_span",
    "bred_for", "reference_image_id", "weight.metric", "height.metric",
]


def nums(column: str) -> str:
    return f"[cast(piece as double) for piece in regexp_extract_all({column}, {NUM})]"


def blank_to_null(path: str) -> str:
    return f"case when trim({js(path)}) <> '' then trim({js(path)}) end"


BLOCKS: dict[str, str] = {
    "fx": SCALED_DOCUMENTS,
    "bands": BANDS_SQL,
    "curated": CURATED_SQL,
    "bronze": """
        select cast(fx.entity_id as bigint) as entity_id, fx.payload, days.d as run_date,
               cast(days.d as timestamp) + interval 2 hour as loaded_at
        from fx, (values (date '2024-01-01'), (date '2024-01-02')) days(d)
        where days.d > date '2024-01-01' or fx.entity_id % 10 > 0""",
    "newest": "select b.* from bronze b, (select max(run_date) as top from bronze) m where b.run_date = m.top",
    "clean": f"""
        select cast({js('id')} as bigint) as entity_id,
               trim({js('name')}) as name,
               nullif(lower(trim({js('weight.metric')})), 'unknown') as weight_raw,
               nullif(lower(trim({js('height.metric')})), 'unknown') as height_raw,
               {blank_to_null('life_span')} as life_span_raw,
               {blank_to_null('breed_group')} as entity_group,
               {blank_to_null('origin')} as origin,
               {blank_to_null('country_code')} as country_code,
               {blank_to_null('description')} as description,
               {blank_to_null('temperament')} as tags_raw,
               {js('image.url')} as image_url,
               cast(len([f for f in [{', '.join(f"coalesce({js(p)}, '')" for p in _SCORED_PATHS)}] if trim(f) = '']) as integer) as n_missing_fields,
               loaded_at
        from newest""",
    "silver": f"""
        select entity_id, name, weight_raw, height_raw, life_span_raw,
               list_min(w) as weight_min_kg, list_max(w) as weight_max_kg,
               list_min(h) as height_min_cm, list_max(h) as height_max_cm,
               cast(list_min(l) as integer) as life_span_min_years, cast(list_max(l) as integer) as life_span_max_years,
               entity_group, origin, country_code, description, tags_raw, image_url, n_missing_fields, loaded_at
        from (select *, {nums('weight_raw')} as w, {nums('height_raw')} as h, {nums('life_span_raw')} as l,
                     row_number() over (partition by name order by n_missing_fields nulls last, entity_id nulls last) as place
              from clean)
        where place = 1""",
    "mids": """
        select *, (weight_min_kg + weight_max_kg) / 2 as weight_mid_kg, (height_min_cm + height_max_cm) / 2 as height_mid_cm,
               (life_span_min_years + life_span_max_years) / 2 as life_span_mid_years,
               life_span_max_years - life_span_min_years as life_span_range_years
        from silver""",
    "dim": """
        select m.*, case when m.weight_mid_kg is null then 'unknown' else b.label end as size_class
        from mids m left join bands b on m.weight_mid_kg >= b.min_kg and m.weight_mid_kg < b.max_kg""",
    "pieces": "select entity_id, unnest(string_split(tags_raw, ',')) as piece from silver",
    "bridge": f"""
        select entity_id, tag, upper(tag[1]) || tag[2:] as tag_display
        from (select entity_id, lower(trim(piece)) as tag from pieces group by all)
        where tag not in ('', '{FREE_TEXT_TAG}')""",
    "summary": """
        select size_class, count(*) as n_entities, count(life_span_mid_years) as n_with_life_span,
               round(avg(life_span_mid_years), 2) as mean_life_span_years,
               round(median(life_span_mid_years), 2) as median_life_span_years,
               round(stddev_samp(life_span_mid_years), 2) as stddev_life_span_years,
               min(life_span_mid_years) as min_life_span_years, max(life_span_mid_years) as max_life_span_years,
               round(avg(weight_mid_kg), 2) as mean_weight_kg, round(avg(height_mid_cm), 2) as mean_height_cm
        from dim group by size_class""",
    "shares": """
        select x.size_class, x.tag, x.tag_display, x.n_entities, s.n_entities as n_in_class,
               round(100.0::double * x.n_entities / s.n_entities, 1) as pct_of_class
        from (select size_class, tag, tag_display, count(distinct entity_id) as n_entities
              from bridge natural join (select entity_id, size_class from dim) group by all) x
        join summary s using (size_class)""",
    "scatter": "select entity_id, name, size_class, weight_mid_kg, life_span_min_years, life_span_max_years, life_span_mid_years from dim",
    "correlations": """
        select metric_a, metric_b, round(corr(a, b), 3) as correlation, count(a + b) as n_entities
        from (select unnest([
                {'metric_a': 'weight_mid_kg', 'metric_b': 'life_span_mid_years', 'a': weight_mid_kg, 'b': life_span_mid_years},
                {'metric_a': 'height_mid_cm', 'metric_b': 'life_span_mid_years', 'a': height_mid_cm, 'b': life_span_mid_years},
                {'metric_a': 'height_mid_cm', 'metric_b': 'weight_mid_kg', 'a': height_mid_cm, 'b': weight_mid_kg}], recursive := true)
              from dim)
        group by metric_a, metric_b""",
    "coverage": """
        select count(*) as n_total, count(weight_mid_kg) as n_with_weight, count(life_span_mid_years) as n_with_life_span,
               count(weight_mid_kg + life_span_mid_years) as n_with_both,
               (select count(distinct entity_id) from bridge) as n_with_tags,
               count(weight_mid_kg + life_span_mid_years) as n_plotted,
               count(*) - count(weight_mid_kg + life_span_mid_years) as n_excluded,
               (select max(loaded_at) from silver) as last_refreshed_at
        from dim""",
    "explorer": """
        select entity_id, name, weight_mid_kg, height_mid_cm, life_span_mid_years,
               case when weight_mid_kg < 0 then null when weight_mid_kg < 5 then 'toy' when weight_mid_kg < 12 then 'small'
                    when weight_mid_kg < 25 then 'medium' when weight_mid_kg < 45 then 'large'
                    when weight_mid_kg is not null then 'giant' end as size_class,
               [lower(trim(t)) for t in string_split(coalesce(tags_raw, ''), ',') if trim(t) <> ''] as tags
        from dim""",
    "class_n": "select size_class, count(*) as n_class from explorer where size_class is not null group by size_class",
    "mentions": "select entity_id, size_class, unnest(tags) as tag from explorer",
}


def with_blocks(sql: str, kind: str = "scaled") -> str:
    """Prefix the blocks a statement uses, with the blocks those use in turn."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"(?:from|join|,)\s+([a-z_0-9]+)", text))
        for name in BLOCKS:
            if name in words and name not in needed:
                visit(BLOCKS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    body = {**BLOCKS, "fx": KINDS[kind]}
    return "with " + ",\n".join(f"{n} as ({body[n].strip()})" for n in needed) + "\n" + sql.strip()
