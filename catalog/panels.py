"""Reader panels over the gold layer."""

from __future__ import annotations

from catalog.base import Layers, query, rounded
from siltstone.plans import panels
from siltstone.plans.explore import CLASSES


@query("ordered_summary", """
    select s.*, cast(b.place as integer) as class_rank
    from summary s join (select label, row_number() over (order by min_kg) as place from bands) b on b.label = s.size_class""")
def ordered_summary(spark, sf):
    x = Layers(spark, sf)
    return panels.ordered_summary(x.summary, x.bands)


@query("band_labels", """
    select size_class, case when max_kg >= 999 then '≥' || min_kg || ' kg' else min_kg || '–' || max_kg || ' kg' end as band,
           size_class || '|' || case when max_kg >= 999 then '≥' || min_kg || ' kg' else min_kg || '–' || max_kg || ' kg' end as axis_label,
           n_entities
    from summary join bands on label = size_class""")
def band_labels(spark, sf):
    x = Layers(spark, sf)
    return panels.band_labels(x.summary, x.bands)


@query("scatter_plotted", "select * from scatter where weight_mid_kg + life_span_mid_years is not null")
def scatter_plotted(spark, sf):
    return panels.plotted(Layers(spark, sf).scatter)


@query("axis_window", """
    select round(min(life_span_mid_years) * 0.9::double, 6) as axis_min, round(max(life_span_mid_years) * 1.1::double, 6) as axis_max
    from scatter where weight_mid_kg + life_span_mid_years is not null""")
def axis_window(spark, sf):
    return rounded(panels.axis_window(panels.plotted(Layers(spark, sf).scatter)), "axis_min", "axis_max")


@query("axis_window_band", """
    select round(min(mean_life_span_years - stddev_life_span_years) * 0.9::double, 6) as axis_min,
           round(max(mean_life_span_years + stddev_life_span_years) * 1.1::double, 6) as axis_max
    from summary where size_class <> 'unknown'""")
def axis_window_band(spark, sf):
    spread = panels.mean_sd_band(Layers(spark, sf).summary.where("size_class <> 'unknown'"))
    return rounded(panels.axis_window(spread, "low", "high"), "axis_min", "axis_max")


@query("mean_sd_band", """
    select size_class, mean_life_span_years, stddev_life_span_years,
           round(mean_life_span_years - stddev_life_span_years, 6) as low,
           round(mean_life_span_years + stddev_life_span_years, 6) as high from summary""")
def mean_sd_band(spark, sf):
    return rounded(panels.mean_sd_band(Layers(spark, sf).summary), "low", "high")


@query("longest_lived", """
    with best as (select * from scatter where weight_mid_kg + life_span_mid_years is not null
                  order by life_span_mid_years desc, name, entity_id limit 5)
    select name, size_class, printf('%.1f', weight_mid_kg) as weight_kg,
           life_span_min_years || '–' || life_span_max_years as published_range,
           (select count(distinct (life_span_min_years, life_span_max_years)) from best) = 1 as all_tied
    from best""".replace("with best as (select", "select * from (with best as (select") + ")")
def longest_lived(spark, sf):
    return panels.longest_lived(Layers(spark, sf).scatter)


@query("denominators", """
    select size_class, size_class || ' ' || n_with_life_span || '/' || n_entities as text from summary""")
def denominators(spark, sf):
    return panels.denominators(Layers(spark, sf).summary)


@query("corr_table", """
    select replace(replace(replace(metric_a || ' ↔ ' || metric_b, 'weight_mid_kg', 'weight'), 'height_mid_cm', 'height'), 'life_span_mid_years', 'life span') as pair,
           printf('%+.2f', correlation) as correlation, n_entities
    from correlations""")
def corr_table(spark, sf):
    return panels.corr_table(Layers(spark, sf).correlations)


@query("narrowest_spread", """
    select (select size_class from summary where size_class <> 'unknown' order by stddev_life_span_years, size_class limit 1) as narrowest_class,
           min(stddev_life_span_years) as stddev_life_span_years,
           round(max(mean_life_span_years) filter (size_class = 'toy') - max(mean_life_span_years) filter (size_class = 'giant'), 6) as mean_gap
    from summary where size_class <> 'unknown'""")
def narrowest_spread(spark, sf):
    return rounded(panels.narrowest_spread(Layers(spark, sf).summary.where("size_class <> 'unknown'")), "mean_gap")


@query("heatmap_grid", """
    select c.tag, n.tag_display, c.sort_order, b.label as size_class,
           coalesce(s.n_entities, 0) as n_entities, z.n_entities as n_in_class, coalesce(s.pct_of_class, 0) as pct_of_class
    from curated c, bands b
    left join shares s on s.tag = c.tag and s.size_class = b.label
    left join summary z on z.size_class = b.label
    left join (select tag, min(tag_display) as tag_display from shares where size_class <> 'unknown' group by tag) n on n.tag = c.tag""")
def heatmap_grid(spark, sf):
    x = Layers(spark, sf).stored()
    return panels.heatmap_grid(x.shares, x.summary, x.curated, CLASSES)
