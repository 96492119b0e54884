"""Delimited tag lists: arrays per row, bridges, groups, indexes, pairs."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.numbers import round_to, share
from siltstone.functions.text import as_col, sentence_case
from siltstone.session import write_scratch


def each_tag(df: DataFrame, keep: Sequence[str], tags: Column | str, out: str = "tag") -> DataFrame:
    """One row per entry of the list.

    The outer form with a test behind it: for a plain explode Spark adds a filter on the list's
    size below the generator, which splits and folds every text a second time.
    """
    return df.select(*keep, F.explode_outer(tags).alias(out)).where(F.col(out).isNotNull())


def split_tags(column: Column | str, sep: str = ",", fold: bool = True) -> Column:
    """The trimmed non-empty parts, repeats kept, lower-cased when folded."""
    parts = F.transform(F.split(as_col(column), F.lit(f"\\Q{sep}\\E")), lambda t: F.trim(t))
    kept = F.filter(parts, lambda t: t != "")
    return F.transform(kept, lambda t: F.lower(t)) if fold else kept


def distinct_tags(column: Column | str, sep: str = ",", sentinels: Sequence[str] = ()) -> Column:
    """The folded tags without repeats and without the sentinel texts."""
    tags = F.array_distinct(split_tags(column, sep))
    return F.filter(tags, lambda t: ~t.isin(list(sentinels))) if sentinels else tags


def tag_bridge(
    df: DataFrame,
    key: str,
    column: str,
    sep: str = ",",
    sentinels: Sequence[str] = (),
    key_is_unique: bool = False,
) -> DataFrame:
    """Distinct (key, tag, tag_display).

    Repeats inside a row are removed in the row. Only a key that may span rows needs the
    distinct shuffle; with a unique key there is none.
    """
    rows = each_tag(df, [key], distinct_tags(column, sep, sentinels))
    if not key_is_unique:
        rows = rows.distinct()
    return rows.withColumn("tag_display", sentence_case("tag"))


def share_of_class(
    bridge: DataFrame, dim: DataFrame, key: str = "entity_id", cls: str = "size_class"
) -> DataFrame:
    """Per (class, tag): entities with the tag, class size and percent; every pair is kept.

    Bridge and dimension both grow with the entities, whatever Spark makes of their size before it has read
    them; a merge join is asked for, so neither is gathered on the driver and sent to all.
    """
    sizes = dim.groupBy(cls).agg(F.count(F.lit(1)).alias("n_in_class"))
    tagged = (
        bridge.select(key, "tag", "tag_display")
        .join(dim.select(key, cls).hint("merge"), key)
        .groupBy(cls, "tag", "tag_display")
        .agg(F.count_distinct(key).alias("n_entities"))
    )
    return tagged.join(sizes, cls).select(
        cls, "tag", "tag_display", "n_entities", "n_in_class",
        round_to(share("n_entities", "n_in_class"), 1).alias("pct_of_class"),
    )


def class_tag_counts(rows: DataFrame, cls: str = "size_class", tags: str = "tags", tag: str = "tag") -> DataFrame:
    """(class, tag, n) over one row per entity, with the class size in the row whose tag is NULL.

    Every list loses its own NULL entries, which are no tags, and gets one, so class sizes and tag counts
    come from the same scan and the same partial sums, and all that follows works on this small table.
    """
    own = F.array_compact(F.coalesce(tags, F.array().cast("array<string>")))
    entries = F.concat(F.array(F.lit(None).cast("string")), own)
    return rows.select(cls, F.explode(entries).alias(tag)).groupBy(cls, tag).agg(F.count(F.lit(1)).alias("n"))


def class_sizes(counts: DataFrame, cls: str, tag: str = "tag") -> DataFrame:
    """(class, n_class) out of the rows without a tag.

    The test also reads the count, which keeps it above the aggregate: pushed below, it would make
    this a second scan, where Spark otherwise reuses the shuffled counts.
    """
    n_class = F.when(F.col(tag).isNull(), F.col("n"))
    return counts.select(cls, n_class.alias("n_class")).where(F.col("n_class") > 0)


def with_class_size(counts: DataFrame, cls: str, tag: str = "tag") -> DataFrame:
    """The tag rows with their class size joined on; classes are few, tags may be many, so the
    sizes travel to the tags. A NULL class has no size and drops out."""
    tagged = counts.where(F.when(F.col(tag).isNotNull(), F.col("n")) > 0)
    return tagged.join(class_sizes(counts, cls, tag), cls)


def share_of_class_by_row(dim: DataFrame, tags: Column, cls: str = "size_class") -> DataFrame:
    """The same table straight from one row per entity with its distinct tags.

    No join to the dimension and no distinct count: a row is an entity, so counting rows is
    counting entities, and one partial sum per (class, tag) is all that is shuffled.
    """
    counts = class_tag_counts(dim.select(cls, tags.alias("tags")), cls)
    return with_class_size(counts, cls).select(
        cls, "tag", sentence_case("tag").alias("tag_display"),
        F.col("n").alias("n_entities"), F.col("n_class").alias("n_in_class"),
        round_to(share("n", "n_class"), 1).alias("pct_of_class"),
    )


def top_tags(bridge: DataFrame, n: int | None = None) -> DataFrame:
    """Tags by number of entities, ties by name."""
    ranked = bridge.groupBy("tag").agg(F.count(F.lit(1)).alias("n_entities"))
    ranked = ranked.orderBy(F.desc("n_entities"), "tag")
    return ranked if n is None else ranked.limit(n)


def tag_statistics(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """One row over a tag column: missing rows, tags per row, distinct raw and folded tags."""
    raw = F.filter(
        F.transform(
            F.split(F.col(column), F.lit(f"\\Q{sep}\\E")),
            lambda t: F.regexp_replace(t, r"^\s+|\s+$", ""),
        ),
        lambda t: t != "",
    )
    blank = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"^\s+|\s+$", "") == ""
    rows = df.select(blank.alias("blank"), F.when(~blank, raw).alias("tags"))
    sizes = rows.agg(
        F.count_if("blank").alias("n_missing"),
        F.count_if(~F.col("blank")).alias("n_with_tags"),
        F.coalesce(F.avg(F.size("tags")), F.lit(0.0)).alias("avg_tags"),
        F.coalesce(F.min(F.size("tags")), F.lit(0)).alias("min_tags"),
        F.coalesce(F.max(F.size("tags")), F.lit(0)).alias("max_tags"),
    )
    casings = _casings(rows).agg(
        F.struct(
            F.coalesce(F.sum("n_casings"), F.lit(0)).alias("n_raw"),
            F.count(F.lit(1)).alias("n_folded"),
            F.count_if(F.col("n_casings") > 1).alias("n_inconsistent"),
        )
    )
    return sizes.withColumn("__c", casings.scalar()).select(*sizes.columns, "__c.*")


def _casings(rows: DataFrame) -> DataFrame:
    """Per folded tag, in how many casings it occurs; raw tags are reduced to distinct first."""
    raw = each_tag(rows, [], "tags", "raw").groupBy("raw").count()
    return raw.groupBy(F.lower("raw").alias("tag")).agg(
        F.count(F.lit(1)).alias("n_casings"), F.sum("count").alias("n_mentions")
    )


def inconsistent_casing(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """Folded tags that occur in more than one casing."""
    rows = df.select(split_tags(column, sep, fold=False).alias("tags"))
    return _casings(rows).where("n_casings > 1")


def tag_index(tags: Column | str, plus: Collection[str], minus: Collection[str]) -> Column:
    """Tags in one set less tags in the other, repeats counted."""
    listed = as_col(tags)
    pos = F.size(F.filter(listed, lambda t: t.isin(sorted(plus))))
    neg = F.size(F.filter(listed, lambda t: t.isin(sorted(minus))))
    return pos - neg


def map_groups(tags: DataFrame, mapping: Mapping[str, Sequence[str]], column: str = "tag") -> DataFrame:
    """Tag -> group through a literal map (the mapping is configuration); NULL = unmapped."""
    return tags.withColumn("grp", _group_of(mapping)[F.col(column)])


def _group_of(mapping: Mapping[str, Sequence[str]]) -> Column:
    flat = [F.lit(x) for group, names in mapping.items() for name in names for x in (name, group)]
    return F.create_map(*flat)


def unmapped_tags(tags: DataFrame, mapping: Mapping[str, Sequence[str]], column: str = "tag") -> DataFrame:
    """Observed tags that no group lists."""
    seen = tags.select(column).distinct()
    return map_groups(seen, mapping, column).where(F.col("grp").isNull()).select(column)


def entity_groups(mapping: Mapping[str, Sequence[str]], tags: Column | str = "tags") -> Column:
    """The distinct trait groups an entity's tags belong to."""
    groups = _group_of(mapping)
    return F.array_distinct(F.array_compact(F.transform(tags, lambda t: groups[t])))


def pair_lift(
    rows: DataFrame, classes: Sequence[str] | None = None, min_support: float = 0.25, k: int = 3, cls: str = "size_class"
) -> DataFrame:
    """Most distinctive tag pairs per class: share inside over share in all other classes.

    ``classes`` limits the classes compared (default: all that are not NULL). ``rows`` has one row per
    entity with its ``tags``; NULL entries are no tags. A pair can only reach ``min_support`` in a class
    if both its tags do, so tags that reach it in no class leave every row before pairs are made; this
    loses no result. The counts this takes are written once, when the query is built. The tags that stay
    are a table, met by a semi join; a row comes out of it with at most (tags per entity / min_support)
    of them for each class, which bounds the pairs a long row can give. Pairs are made inside the row,
    without a self-join.
    """
    known = F.col(cls).isNotNull() if classes is None else F.col(cls).isin(list(classes))
    banded = rows.where(known).select(
        cls, F.array_sort(F.array_distinct(F.array_compact("tags"))).alias("tags")
    )
    counts = write_scratch(class_tag_counts(banded, cls), "tag-counts")
    sizes = class_sizes(counts, cls)
    n_rows = sizes.agg(F.sum("n_class")).scalar()
    if min_support > 0:
        reaching = with_class_size(counts, cls).where(F.col("n") / F.col("n_class") >= min_support).select("tag").distinct()
        entries = each_tag(banded.withColumn("__row", F.monotonically_increasing_id()), ["__row", cls], "tags")
        banded = (
            entries.join(reaching, "tag", "left_semi").groupBy("__row", cls).agg(F.array_sort(F.collect_list("tag")).alias("tags"))
        )
    pairs = F.flatten(
        F.transform(
            "tags",
            lambda a, i: F.transform(
                F.slice("tags", i + 2, F.greatest(F.size("tags") - i - 1, F.lit(0))),
                lambda b: F.struct(a.alias("a"), b.alias("b")),
            ),
        )
    )
    counted = (
        each_tag(banded, [cls], pairs, "pair")
        .groupBy(cls, "pair")
        .agg(F.count(F.lit(1)).alias("n_in"))
        .withColumn("n_all", F.sum("n_in").over(Window.partitionBy("pair")))
    )
    inside = F.col("n_in") / F.col("n_class")
    outside = F.try_divide(F.col("n_all") - F.col("n_in"), n_rows - F.col("n_class"))
    lifts = (
        counted.where("n_all > n_in")
        .join(sizes, cls)
        .select(
            F.col(cls).alias("band"),
            F.concat_ws(" + ", "pair.a", "pair.b").alias("pair"),
            inside.alias("inside"), outside.alias("outside"),
            (inside / outside).alias("lift"),
        )
        .where(F.col("inside") >= min_support)
    )
    best = Window.partitionBy("band").orderBy(F.desc("lift"), "pair")
    return (
        lifts.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(
            "band", "pair", "rank",
            F.bround(F.col("inside") * 100).cast("long").alias("in_band_pct"),
            F.bround(F.col("outside") * 100).cast("long").alias("other_bands_pct"),
            round_to("lift", 1).alias("lift"),
        )
    )


def tag_class_pivot(
    rows: DataFrame, classes: Sequence[str], n: int = 18, cls: str = "size_class"
) -> DataFrame:
    """Percent of a class per mention of the ``n`` most frequent tags, one column per class.

    The frequency ranking runs over all rows, the percentages over the listed classes; repeats
    of a tag within a row count, as in a mention count.
    """
    counts = class_tag_counts(rows, cls)
    mentions = counts.where(F.when(F.col("tag").isNotNull(), F.col("n")) > 0)
    ranked = mentions.groupBy("tag").agg(F.sum("n").alias("n_all"))
    top = ranked.orderBy(F.desc("n_all"), "tag").limit(n).select("tag")
    sized = mentions.join(class_sizes(counts, cls), cls)
    pct = sized.join(top, "tag").select("tag", cls, F.bround(share("n", "n_class")).alias("pct"))
    return pivot_classes(pct, "tag", cls, classes, "pct")


def pivot_classes(df: DataFrame, row: str, cls: str, classes: Sequence[str], value: str) -> DataFrame:
    """One column per listed class, absent cells 0; rows that occur in no listed class drop out."""
    cells = df.groupBy(row).agg(*[F.max(F.when(F.col(cls) == c, F.col(value))).alias(c) for c in classes])
    return cells.where(F.coalesce(*classes).isNotNull()).fillna(0.0, subset=list(classes))
