"""Source profiling: columns, keys, formats, shapes, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.jsontext import json_keys, json_shape
from siltstone.functions.shapes import SENTINELS, classify_format
from siltstone.functions.text import strip_space, total
from siltstone.operators.joins import melt
from siltstone.operators.stats import values_at_ranks
from siltstone.session import write_scratch

_NESTED = (T.StructType, T.MapType, T.ArrayType)


def _as_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    column = F.col(f"`{name}`")
    return F.to_json(column) if isinstance(kind, _NESTED) else column.cast("string")


def _present(df: DataFrame, name: str) -> Column:
    """The value as text; NULL for blank scalars."""
    text = _as_text(df, name)
    if isinstance(df.schema[name].dataType, _NESTED):
        return text
    return F.when(F.trim(text) != "", text)


def _digest(text: Column) -> Column:
    """Values are counted by their digest, whatever their length, so the shuffle carries no texts."""
    return F.sha2(text, 256)


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value key, rows) for all columns from one scan and one shuffle."""
    items = {c: _digest(_present(df, c)) for c in columns}
    long = melt(df, [], items, ["column_name", "value"])
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, blank count and rate, distinct non-blank values."""
    columns = list(columns or df.columns)
    kinds = {c: df.schema[c].dataType.simpleString() for c in columns}
    types = F.create_map(*[F.lit(x) for item in kinds.items() for x in item])
    blank = F.col("value").isNull()
    counted = _value_counts(df, columns).groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("n_blank"),
        F.count("value").alias("n_distinct"),
    )
    return counted.select(
        "column_name", types[F.col("column_name")].alias("column_type"), "n_blank",
        (F.lit(100.0) * F.col("n_blank") / F.col("n_rows")).alias("blank_pct"), "n_distinct",
    )


def column_examples(df: DataFrame, columns: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """Up to ``n`` distinct example values per column, whole.

    The examples are the values with the smallest digests, so they are the same on every run and
    look random. Only digests are compared; the texts behind the chosen few are fetched by a
    semi-join on at most n x columns digests.
    """
    columns = list(columns or df.columns)
    items = {c: _present(df, c) for c in columns}
    long = melt(df, [], items, ["column_name", "example"]).where(F.col("example").isNotNull())
    keyed = long.withColumn("digest", F.sha2("example", 256))
    distinct = keyed.select("column_name", "digest").distinct()
    first = Window.partitionBy("column_name").orderBy("digest")
    chosen = distinct.withColumn("position", F.row_number().over(first)).where(F.col("position") <= n)
    found = keyed.join(F.broadcast(chosen), ["column_name", "digest"])
    return found.groupBy("column_name", "position").agg(F.min("example").alias("example"))


def check_key(df: DataFrame, key: str) -> DataFrame:
    counts = df.agg(
        F.count_if(F.col(key).isNull()).alias("n_null"),
        F.count_distinct(key).alias("n_distinct"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return counts.withColumn("is_key", (F.col("n_null") == 0) & (F.col("n_distinct") == F.col("n_rows")))


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with exactly one distinct value, NULL counted as a value.

    Smallest equals largest and no NULLs, or NULLs only: needs no distinct count.
    """
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        text = _as_text(df, c)
        aggs += [F.min(text).alias(f"lo{i}"), F.max(text).alias(f"hi{i}"), F.count(text).alias(f"n{i}")]
    wide = df.agg(*aggs)
    flags = [
        F.struct(
            F.lit(c).alias("column_name"),
            (
                (F.col("__rows") > 0)
                & (
                    (F.col(f"n{i}") == 0)
                    | ((F.col(f"n{i}") == F.col("__rows")) & (F.col(f"lo{i}") == F.col(f"hi{i}")))
                )
            ).alias("constant"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*flags))).where("constant").select("column_name")


def format_variants(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """(field, variant, n_rows, example): the shape of every value, one scan for all fields.

    Values are counted before they are classified, so each distinct text runs through the
    patterns once.
    """
    items = {name: F.col(c) if isinstance(c, str) else c for name, c in columns.items()}
    return _count_variants(melt(df, [], items, ["field", "value"]))


def _count_variants(rows: DataFrame) -> DataFrame:
    values = rows.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("field", classify_format("value").alias("variant")).agg(
        F.sum("n").alias("n_rows"), F.min("value").alias("example")
    )


def shown_variants(variants: DataFrame, cap: int = 15) -> DataFrame:
    """The most frequent variants per field and how many are not shown (a report, not a result)."""
    order = Window.partitionBy("field").orderBy(F.desc("n_rows"), "variant")
    hidden = variants.groupBy("field").agg(
        F.greatest(F.count(F.lit(1)) - cap, F.lit(0)).cast("long").alias("n_hidden")
    )
    top = variants.withColumn("position", F.row_number().over(order)).where(F.col("position") <= cap)
    return top.join(hidden, "field")


def object_shapes(df: DataFrame, column: str) -> DataFrame:
    """How often the JSON column is missing, a scalar, or an object with which keys."""
    return df.groupBy(json_shape(column).alias("shape")).agg(F.count(F.lit(1)).alias("n_rows"))


def subkey_formats(df: DataFrame, column: str) -> DataFrame:
    """The format variants of every key of the objects in a JSON column."""
    doc = F.from_json(F.col(column), "map<string,string>", {"mode": "PERMISSIVE"})
    rows = df.where(json_keys(column).isNotNull()).select(F.explode(doc).alias("field", "value"))
    shown = rows.withColumn("value", F.coalesce("value", F.lit("None")))
    return _count_variants(shown)


def sentinel_rows(df: DataFrame, keep: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Rows whose folded value is a sentinel text, one per field."""
    items = {field: F.col(c) for field, c in columns.items()}
    long = melt(df, keep, items, ["field", "value"])
    return long.where(F.lower(strip_space("value")).isin(*SENTINELS)).select(*keep, "field")


def sparsity(df: DataFrame, fields: Sequence[str]) -> Column:
    """How many of the fields are absent, empty text, empty object or empty list."""
    return total(F.coalesce(_as_text(df, f).isin("", "{}", "[]"), F.lit(True)).cast("int") for f in fields)


def sample_records(df: DataFrame, fields: Sequence[str], key: str, tagged: str, n: int = 5) -> DataFrame:
    """Up to five telling records: richest, the two sparsest, the middle one, first with tags.

    Order is (sparsity, key). Rows are read and judged once: key, sparsity and whether there are tags
    are written when the query is built, and all ranking reads those few bytes a row. Both ends and the
    first tagged rows come from one ranked pass, of which each task keeps five rows per end. The middle
    record is found by counting per sparsity level and then by its rank inside one level, so the table
    is never sorted as a whole. The records themselves are fetched by the keys picked, in one scan.
    """
    has_tags = F.trim(F.coalesce(F.col(tagged), F.lit(""))) != ""
    slim = write_scratch(df.select(key, sparsity(df, fields).alias("sparsity"), has_tags.alias("__tagged")), "sparsity")

    ends = F.array_compact(F.array(F.lit("low"), F.lit("high"), F.when(F.col("__tagged"), F.lit("tagged"))))
    rows = slim.select(key, "sparsity", F.explode(ends).alias("__end"))
    down = F.col("__end") == "high"
    order = Window.partitionBy("__end").orderBy(
        F.when(down, -F.col("sparsity")).otherwise(F.col("sparsity")),
        F.when(~down, F.col(key)).asc(),
        F.when(down, F.col(key)).desc(),
    )
    best = rows.withColumn("__at", F.row_number().over(order)).where(F.col("__at") <= 5)
    at = F.col("__at")
    role = (
        F.when((F.col("__end") == "low") & (at == 1), F.lit(1))
        .when((F.col("__end") == "high") & (at <= 2), at + 1)
        .when(F.col("__end") == "tagged", at + 4)
        # only in a table of five rows or fewer, where every row is picked, do these come in
        .otherwise(at + 20)
    )
    outer = best.select(key, "sparsity", role.alias("role"))

    levels = slim.groupBy("sparsity").agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy(F.lit(1))
    upto = levels.select(
        "sparsity", "c", F.sum("c").over(whole.orderBy("sparsity")).alias("end"),
        F.sum("c").over(whole).alias("total"),
    )
    mid = F.floor(F.col("total") / 2)
    level = upto.where((F.col("end") - F.col("c") <= mid) & (mid < F.col("end")))
    spot = level.select(F.struct("sparsity", (mid - (F.col("end") - F.col("c"))).alias("offset"), "total")).scalar()
    at_mid = F.array_compact(
        F.array(F.when(F.col("sparsity") == spot["sparsity"], F.struct(spot["offset"].alias("rank"))))
    )
    middle = values_at_ranks(slim, key, ["sparsity"], lambda _: at_mid)

    middle = middle.select(key, spot["sparsity"].alias("sparsity"), F.lit(4).alias("role"))
    roles = outer.union(middle).groupBy(key).agg(F.min("role").alias("role"), F.min("sparsity").alias("sparsity"))
    known = roles.where((F.col("role") < 20) | (spot["total"] <= n)).orderBy("role").limit(n)
    names = F.array(*[F.lit(x) for x in ("richest", "sparsest", "second sparsest", "middle", "with tags")])
    label = F.when(F.col("role") < 20, F.element_at(names, F.least(F.col("role"), F.lit(5)))).otherwise("other")
    return df.join(F.broadcast(known.select(key, "sparsity", label.alias("picked_as"))), key)
