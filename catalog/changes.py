"""Change history over order and document snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.base import Layers, query, table
from siltstone.plans import changes, history
from siltstone.session import scratch_path
from siltstone.sources.tables import database_for, ensure_database, quoted

# Two states of the order table: the first lacks every tenth order and has other prices for
# every seventh.
_DAY1 = """select o_orderkey as id, case when o_orderkey % 7 = 0 then o_totalprice + 1 else o_totalprice end as price,
    case when o_orderkey % 11 = 0 then null else o_orderstatus end as status from orders where o_orderkey % 10 <> 0"""
_DAY2 = "select o_orderkey as id, o_totalprice as price, o_orderstatus as status from orders"


def _days(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status")
    )
    first = orders.where("id % 10 <> 0").select(
        "id", F.when(F.col("id") % 7 == 0, F.col("price") + 1).otherwise(F.col("price")).alias("price"),
        F.when(F.col("id") % 11 != 0, F.col("status")).alias("status"),
    )
    return first, orders


@query("scd2", f"""
    select n.id, n.price, n.status,
           case when o.id is not null and o.price = n.price and o.status is not distinct from n.status then '2024-01-01' else '2024-01-02' end as valid_from,
           cast(null as varchar) as valid_to, true as is_current
    from ({_DAY2}) n left join ({_DAY1}) o using (id)
    union all
    select o.id, o.price, o.status, '2024-01-01', '2024-01-02', false
    from ({_DAY1}) o join ({_DAY2}) n using (id) where o.price <> n.price or o.status is distinct from n.status""")
def scd2(spark, sf):
    first, second = _days(spark, sf)
    start = history.first_versions(first, "id", ["price", "status"], "2024-01-01")
    versions = history.apply_snapshot(start, second, "id", ["price", "status"], "2024-01-02")
    return versions.select(
        "id", "price", "status", F.col("valid_from").cast("string").alias("valid_from"),
        F.col("valid_to").cast("string").alias("valid_to"), "is_current",
    )


@query("changed_rows", f"""
    select n.id, n.price, n.status from ({_DAY2}) n left join ({_DAY1}) o using (id)
    where o.id is null or o.price <> n.price or o.status is distinct from n.status""")
def changed_rows(spark, sf):
    first, second = _days(spark, sf)
    seen = changes.digests_of(first, "id", ["price", "status"])
    return changes.changed_rows(second, seen, "id", ["price", "status"]).select("id", "price", "status")


@query("rebuild_changed", f"""
    select id, price, status, round(price * 2, 4) as doubled from ({_DAY2}) where id % 13 <> 0""")
def rebuild_changed(spark, sf):
    """Only changed keys go through the build again, and keys that are gone leave; the result equals a full rebuild."""
    first, second = _days(spark, sf)
    second = second.where("id % 13 <> 0")

    def build(rows):
        return rows.select("id", "price", "status", F.round(F.col("price") * 2, 4).alias("doubled"))

    seen = changes.digests_of(first, "id", ["price", "status"])
    changed = changes.changed_rows(second, seen, "id", ["price", "status"])
    return changes.rebuild_changed(build(first), changed, "id", build, second)


# Two states of the event table: the first lacks every tenth event, has every seventh a microsecond earlier, every
# eleventh without a value, and its properties written otherwise for every thirteenth.
_EVENTS1 = """select event_id, case when event_id % 7 = 0 then ts - interval 1 microsecond else ts end as ts,
    case when event_id % 11 = 0 then null else value end as value,
    case when event_id % 13 = 0 then replace(props, ' ', '') else props end as props from events where event_id % 10 <> 0"""
_EVENT_CHANGES = f"""
    select n.event_id, strftime(n.ts, '%Y-%m-%d %H:%M:%S.%f') as ts, n.value, n.props,
           case when o.event_id is null then '' else array_to_string(list_filter([
               case when o.ts <> n.ts then 'ts' end, case when o.value is distinct from n.value then 'value' end,
               case when o.props is distinct from n.props then 'props' end], lambda c: c is not null), ',') end as changed_columns
    from events n left join ({_EVENTS1}) o using (event_id)
    where o.event_id is null or o.ts <> n.ts or o.value is distinct from n.value or o.props is distinct from n.props"""
_TRACKED = ["ts", "value", "props"]


def _event_days(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "value", "props")
    at = F.col("event_id")
    first = events.where("event_id % 10 <> 0").select(
        "event_id", F.when(at % 7 == 0, F.col("ts") - F.expr("interval 1 microsecond")).otherwise(F.col("ts")).alias("ts"),
        F.when(at % 11 != 0, F.col("value")).alias("value"),
        F.when(at % 13 == 0, F.replace("props", F.lit(" "), F.lit(""))).otherwise(F.col("props")).alias("props"),
    )
    return first, events


def _scratch_database(spark, label):
    folder = scratch_path(spark, label)
    database = database_for(folder, label)
    ensure_database(spark, database, folder)
    return database, folder


def _shown_micros(df, column="ts"):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _remembered(spark, first):
    database, _ = _scratch_database(spark, "changes")
    changes.remember(first, database, "seen", "event_id", _TRACKED, "day1", buckets=8)
    return changes.seen_before(spark, database, "seen")


@query("changed_rows_events", _EVENT_CHANGES)
def changed_rows_events(spark, sf):
    """Events that changed since they were remembered in a table bucketed by key, and in which columns."""
    first, second = _event_days(spark, sf)
    found = changes.changed_rows(second, _remembered(spark, first), "event_id", _TRACKED)
    return _shown_micros(found.withColumn("changed_columns", F.array_join("changed_columns", ",")))


@query("rebuild_changed_events", """
    select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, epoch_us(ts) % 1000000 as micros, round(value * 2, 4) as doubled
    from events where event_id % 17 <> 0""")
def rebuild_changed_events(spark, sf):
    """The live table kept up by rebuilding what the remembered digests show as changed."""
    first, second = _event_days(spark, sf)
    second = second.where("event_id % 17 <> 0")

    def build(rows):
        micros = (F.unix_micros(F.col("ts").cast("timestamp")) % 1_000_000).alias("micros")
        return rows.select("event_id", "ts", micros, F.round(F.col("value") * 2, 4).alias("doubled"))

    changed = changes.changed_rows(second, _remembered(spark, first), "event_id", _TRACKED)
    return _shown_micros(changes.rebuild_changed(build(first), changed, "event_id", build, second))


@query("scd2_stored", f"""
    with d1 as ({_DAY1}), d2 as ({_DAY2}),
    d3 as (select id, case when id % 7 = 1 then price - 1 else price end as price, status from d2 where id % 17 <> 0),
    v as (select id, price, status, 1 as day from d1 union all select id, price, status, 2 from d2 union all select id, price, status, 3 from d3),
    marked as (select *, coalesce(lag(price) over w = price and lag(status) over w is not distinct from status and lag(day) over w is not null, false) as same,
        max(day) over (partition by id) as last from v window w as (partition by id order by day)),
    starts as (select *, lead(day) over (partition by id order by day) as next from marked where not same)
    select id, price, status, '2024-01-0' || day as valid_from,
           case when next is not null then '2024-01-0' || next when last < 3 then '2024-01-03' end as valid_to,
           next is null and last = 3 as is_current
    from starts""")
def scd2_stored(spark, sf):
    """A kept history after three snapshots, the last one applied twice; keys that it lacks are closed."""
    first, second = _days(spark, sf)
    third = second.where("id % 17 <> 0").withColumn("price", F.when(F.col("id") % 7 == 1, F.col("price") - 1).otherwise(F.col("price")))
    database, folder = _scratch_database(spark, "versions")
    kept = history.history_table(first, database, "orders", f"{folder}/orders", "id", ["price", "status"])
    for day, snapshot in ((1, first), (2, second), (3, third), (3, third)):
        history.store_snapshot(snapshot, kept, "id", ["price", "status"], date(2024, 1, day), close_missing=day == 3)
    found = spark.table(quoted(kept))
    shown = {c: F.col(c).cast("string") for c in ("valid_from", "valid_to")}
    return found.withColumns(shown).select("id", "price", "status", "valid_from", "valid_to", "is_current")


@query("suggest_bands")
def suggest_bands(spark, sf):
    return history.suggest_bands(Layers(spark, sf).dim, "weight_mid_kg")


@query("suggest_bands_hold", "select 5::bigint as n_bands, count(weight_mid_kg) as n_rows, true as ordered from dim")
def suggest_bands_hold(spark, sf):
    """Whatever the centres are: each lies inside its band, the bands meet, and every measured row is in one."""
    bands = history.suggest_bands(Layers(spark, sf).dim, "weight_mid_kg")
    inside = (F.coalesce("low", F.col("centre")) <= F.col("centre")) & (F.coalesce("high", F.col("centre")) >= F.col("centre"))
    meets = F.col("low").eqNullSafe(F.lag("high").over(Window.orderBy("band")))
    seen = bands.select("n_rows", (inside & meets).alias("holds"))
    return seen.agg(F.count(F.lit(1)).alias("n_bands"), F.sum("n_rows").alias("n_rows"), F.bool_and("holds").alias("ordered"))
