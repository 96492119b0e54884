"""Exploratory statistics over one row per entity."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Layers, query, rounded, table
from siltstone.operators import stats, tags
from siltstone.plans import explore
from siltstone.plans.marts import HEIGHT, WEIGHT

_GROUP_ROWS = ", ".join(f"('{t}', '{g}')" for g, ts in explore.TRAIT_GROUPS.items() for t in ts)
_GROUPS = f"(values {_GROUP_ROWS}) g(tag, grp)"
_FITTED = "select entity_id, name, height_mid_cm as x, weight_mid_kg as y from dim where height_mid_cm > 0 and weight_mid_kg > 0"


def _in(words):
    return ", ".join(f"'{w}'" for w in words)


@query("loglog_fit", f"""
    select round(regr_slope(ln(y), ln(x)), 6) as exponent, round(regr_intercept(ln(y), ln(x)), 6) as intercept,
           round(regr_r2(ln(y), ln(x)), 6) as r2, count(*) as n_rows from ({_FITTED})""")
def loglog(spark, sf):
    return rounded(stats.loglog_fit(Layers(spark, sf).dim, HEIGHT, WEIGHT), "exponent", "intercept", "r2")


@query("loglog_fit_lineitem", """
    select round(regr_slope(ln(l_extendedprice), ln(l_quantity)), 6) as exponent,
           round(regr_intercept(ln(l_extendedprice), ln(l_quantity)), 6) as intercept,
           round(regr_r2(ln(l_extendedprice), ln(l_quantity)), 6) as r2, count(*) as n_rows
    from lineitem where l_quantity > 0 and l_extendedprice > 0""")
def loglog_lineitem(spark, sf):
    found = stats.loglog_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(found, "exponent", "intercept", "r2")


@query("reference_row", f"""
    select entity_id, name, x as height_mid_cm, y as weight_mid_kg from ({_FITTED}) f, (select median(x) as mid from ({_FITTED}) d) m
    order by abs(x - mid), entity_id limit 1""")
def reference_row(spark, sf):
    rows = Layers(spark, sf).dim.where(f"{HEIGHT} > 0 and {WEIGHT} > 0")
    return stats.reference_row(rows, HEIGHT, "entity_id").select("entity_id", "name", HEIGHT, WEIGHT)


@query("power_curve", f"""
    select cast(point as integer) as point, round(lo + (hi - lo) * point / 59, 6) as height_mid_cm,
           round(ry * pow((lo + (hi - lo) * point / 59) / rx, 3), 6) as cube_law,
           round(ry * pow((lo + (hi - lo) * point / 59) / rx, k), 6) as fitted
    from range(60) t(point),
         (select min(x) as lo, max(x) as hi, regr_slope(ln(y), ln(x)) as k from ({_FITTED}) e) w,
         (select x as rx, y as ry from ({_FITTED}) f, (select median(x) as mid from ({_FITTED}) d) m order by abs(x - mid), entity_id limit 1) a""")
def power_curve(spark, sf):
    rows = Layers(spark, sf).stored().dim
    return rounded(stats.power_curve(rows, HEIGHT, WEIGHT, "entity_id"), HEIGHT, "cube_law", "fitted")


@query("scaled_up", f"""
    select entity_id, x as height_mid_cm, y as weight_mid_kg, round(tx / x, 6) as factor, round(y * pow(tx / x, 3), 4) as by_cube_law,
           round(ty, 6) as real_mean
    from (select * from ({_FITTED}) order by x, entity_id limit 1) s, (select avg(x) as tx, avg(y) as ty from ({_FITTED}) f where x > 70) t""")
def scaled_up(spark, sf):
    found = stats.scaled_up(Layers(spark, sf).dim, HEIGHT, WEIGHT, "entity_id", 70.0)
    return rounded(rounded(found, "factor", "real_mean"), "by_cube_law", places=4)


@query("build_index", f"select entity_id, round(y / pow(x, 3) * 1000, 6) as build_index from ({_FITTED})")
def build_index(spark, sf):
    rows = Layers(spark, sf).dim.where(f"{HEIGHT} > 0 and {WEIGHT} > 0")
    return rounded(rows.select("entity_id", stats.build_index(HEIGHT, WEIGHT).alias("build_index")), "build_index")


@query("class_counts", """
    select l.label as size_class, cast(l.place as integer) as class_rank, count(e.size_class) as n_entities
    from (select label, row_number() over (order by min_kg) as place from bands) l left join explorer e on e.size_class = l.label
    group by all""")
def class_counts(spark, sf):
    return explore.class_counts(Layers(spark, sf).explorer)


@query("class_means", """
    select size_class, round(avg(life_span_mid_years), 1) as mean_life, round(avg(weight_mid_kg), 1) as mean_kg,
           round(avg(height_mid_cm), 1) as mean_cm, count(name) as n,
           round(avg(weight_mid_kg / pow(height_mid_cm, 3) * 1000), 6) as mean_build_index,
           cast(list_position(['toy', 'small', 'medium', 'large', 'giant'], size_class) as integer) as class_rank
    from explorer where size_class is not null group by size_class""")
def class_means(spark, sf):
    return rounded(explore.class_means(Layers(spark, sf).explorer), "mean_build_index")


_PIVOT = ", ".join(f"round(coalesce(max(pct) filter (size_class = '{c}'), 0), 6) as {c}" for c in explore.CLASSES)


@query("group_prevalence", f"""
    select grp, {_PIVOT} from (
      select grp, m.size_class, 100.0::double * count(distinct entity_id) / max(n_class) as pct
      from mentions m join class_n c on c.size_class = m.size_class join {_GROUPS} on g.tag = m.tag group by grp, m.size_class)
    group by grp""")
def group_prevalence(spark, sf):
    return rounded(explore.group_prevalence(Layers(spark, sf).explorer), *explore.CLASSES)


@query("mention_share", f"""
    select size_class, grp, n as n_mentions, round(100.0::double * n / sum(n) over (partition by size_class), 6) as pct_of_mentions
    from (select size_class, grp, count(distinct entity_id) as n
          from mentions m join {_GROUPS} on g.tag = m.tag where size_class is not null group by size_class, grp)""")
def mention_share(spark, sf):
    return rounded(explore.mention_share(Layers(spark, sf).explorer), "pct_of_mentions")


@query("energy_index", f"""
    with e as (select size_class, weight_mid_kg,
                 len([t for t in tags if t in ({_in(explore.ENERGETIC_TAGS)})]) - len([t for t in tags if t in ({_in(explore.CALM_TAGS)})]) as energy
               from explorer)
    select size_class, round(avg(energy), 6) as mean_energy, round((select corr(weight_mid_kg, energy) from e), 6) as corr_with_weight
    from e where size_class is not null group by size_class""".replace("with e as", "select * from (with e as") + ")")
def energy_index(spark, sf):
    return rounded(explore.energy_by_class(Layers(spark, sf).explorer), "mean_energy", "corr_with_weight")


@query("trait_groups", f"""
    select b.tag, g.grp, count(*) as n_entities from bridge b left join {_GROUPS} on g.tag = b.tag group by all""")
def trait_groups(spark, sf):
    ranked = tags.top_tags(Layers(spark, sf).bridge)
    return tags.map_groups(ranked, explore.TRAIT_GROUPS).select("tag", "grp", "n_entities")


@query("unmapped_tags", f"""
    select distinct tag from bridge where tag not in (select tag from {_GROUPS})""")
def unmapped_tags(spark, sf):
    return tags.unmapped_tags(Layers(spark, sf).bridge, explore.TRAIT_GROUPS)


@query("unmapped_words", f"""
    select distinct lower(w) as tag from (select unnest(string_split(p_name, ' ')) as w from part)
    where lower(w) not in (select tag from {_GROUPS})""")
def unmapped_words(spark, sf):
    words = tags.tag_bridge(table(spark, sf, "part"), "p_partkey", "p_name", " ")
    return tags.unmapped_tags(words, explore.TRAIT_GROUPS)


def _lift_sql(rows, support, k):
    """Every pair is made and counted here; the support cut comes last."""
    return f"""
        select * from (with d as (select id, cls, list_sort(list_distinct(tags)) as tags from ({rows}) where cls is not null),
        n as (select cls, count(*) as n_class from d group by cls),
        t as (select id, cls, unnest(tags) as tag from d),
        p as (select a.cls, a.tag || ' + ' || b.tag as pair, count(*) as n_in from t a join t b on a.id = b.id and a.tag < b.tag group by all),
        q as (select p.*, sum(n_in) over (partition by pair) - n_in as n_out, n_class, (select sum(n_class) from n) - n_class as n_rest
              from p join n using (cls)),
        l as (select cls as band, pair, n_in / n_class as inside, n_out / n_rest as outside, (n_in / n_class) / (n_out / n_rest) as lift
              from q where n_out > 0 and n_in / n_class >= {support}),
        r as (select *, row_number() over (partition by band order by lift desc, pair) as place from l)
        select band, pair, cast(place as integer) as rank, cast(round_even(inside * 100, 0) as bigint) as in_band_pct,
               cast(round_even(outside * 100, 0) as bigint) as other_bands_pct, round(lift, 1) as lift
        from r where place <= {k})"""


@query("pair_lift", _lift_sql("select entity_id as id, size_class as cls, tags from explorer", 0.25, 3))
def pair_lift(spark, sf):
    return tags.pair_lift(Layers(spark, sf).explorer, explore.CLASSES)


@query("pair_lift_sound", _lift_sql("select entity_id as id, size_class as cls, tags from explorer", 0.25, 3), kind="sound")
def pair_lift_sound(spark, sf):
    return tags.pair_lift(Layers(spark, sf, "sound").explorer, explore.CLASSES)


@query("pair_lift_parts", _lift_sql(
    "select p_partkey as id, p_type as cls, string_split(lower(p_name || ' ' || p_brand || ' ' || (p_size % 3)), ' ') as tags from part", 0.02, 5))
def pair_lift_parts(spark, sf):
    words = F.lower(F.concat_ws(" ", "p_name", "p_brand", (F.col("p_size") % 3).cast("string")))
    rows = table(spark, sf, "part").select(F.col("p_type").alias("size_class"), F.split(words, " ").alias("tags"))
    return tags.pair_lift(rows, min_support=0.02, k=5)


# Lists with NULL entries: words of a part's name, of which those of five letters are NULL, beside its brand.
_HOLED = """select p_partkey as id, p_type as cls,
    list_concat([case when length(w) <> 5 then w end for w in string_split(p_name, ' ')], [p_brand]) as tags from part"""
_HOLED_MENTIONS = f"select id, cls, unnest(tags) as tag from ({_HOLED})"


def _holed(spark, sf):
    words = F.transform(F.split("p_name", " "), lambda w: F.when(F.length(w) != 5, w))
    return table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("size_class"), F.concat(words, F.array("p_brand")).alias("tags"))


@query("share_of_class_null_entries", f"""
    with n as (select p_type as cls, count(*) as n_class from part group by p_type),
    m as (select cls, tag, count(distinct id) as n from ({_HOLED_MENTIONS}) where tag is not null group by all)
    select cls as size_class, tag, upper(tag[1]) || lower(tag[2:]) as tag_display, n as n_entities, n_class as n_in_class,
           round(100.0::double * n / n_class, 1) as pct_of_class
    from m join n using (cls)""", kind=None)
def share_of_class_null_entries(spark, sf):
    return tags.share_of_class_by_row(_holed(spark, sf), F.array_distinct("tags"))


@query("pair_lift_null_entries", _lift_sql(f"select id, cls, [t for t in tags if t is not null] as tags from ({_HOLED})", 0.001, 5), kind=None)
def pair_lift_null_entries(spark, sf):
    return tags.pair_lift(_holed(spark, sf), min_support=0.001, k=5)


@query("tag_class_pivot_null_entries", f"""
    with m as ({_HOLED_MENTIONS}), n as (select p_type as cls, count(*) as n_class from part group by p_type),
    top as (select tag from m where tag is not null group by tag order by count(*) desc, tag limit 18),
    pct as (select m.tag, m.cls, round_even(100.0::double * count(*) / max(n_class), 0) as pct
            from m join n using (cls) join top using (tag) group by all)
    select tag, coalesce(max(pct) filter (cls = 'ECONOMY'), 0) as "ECONOMY", coalesce(max(pct) filter (cls = 'SMALL'), 0) as "SMALL"
    from pct group by tag having count(*) filter (cls in ('ECONOMY', 'SMALL')) > 0""", kind=None)
def tag_class_pivot_null_entries(spark, sf):
    return tags.tag_class_pivot(_holed(spark, sf), ["ECONOMY", "SMALL"])


@query("tag_class_pivot", f"""
    with top as (select tag from mentions group by tag order by count(*) desc, tag limit 18)
    select tag, {_PIVOT} from (
      select m.tag, m.size_class, round_even(100.0::double * count(*) / max(n_class), 0) as pct
      from mentions m join class_n c on c.size_class = m.size_class join top on top.tag = m.tag group by m.tag, m.size_class)
    group by tag""".replace("with top as", "select * from (with top as") + ")")
def tag_class_pivot(spark, sf):
    return rounded(tags.tag_class_pivot(Layers(spark, sf).explorer, explore.CLASSES), *explore.CLASSES)
