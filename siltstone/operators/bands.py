"""Half-open bands: ``min <= x < max``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to so many bands are one expression over the rows, small enough to be compiled; more are joined to them.
MAX_BANDS = 384
# How many ranges of the measure a joined band table is dealt into.
RANGES = 1024

_SEVERAL = object()


def _segments(bands: Sequence[tuple]) -> tuple[list, list]:
    """The edges of all (label, low, high) in order, and what holds below the first and from each one on:
    a label, None, or the mark for several bands."""
    starts: dict = {}
    ends: dict = {}
    for i, (_, low, high) in enumerate(bands):
        if low is not None and high is not None and low < high:
            starts.setdefault(low, []).append(i)
            ends.setdefault(high, []).append(i)
    edges = sorted({*starts, *ends})
    held: dict = {}
    values: list = [None]
    for edge in edges:
        for i in ends.get(edge, ()):
            del held[i]
        held.update((i, bands[i][0]) for i in starts.get(edge, ()))
        values.append(_SEVERAL if len(held) > 1 else next(iter(held.values()), None))
    return edges, values


def _several(x: Column) -> Column:
    return F.raise_error(F.concat(F.lit("more than one band holds the value "), x.cast("string"))).cast("string")


def _by_halving(x: Column, edges: list, values: list) -> Column:
    """Nested CASE that halves the edges, so a row takes as many tests as the logarithm of their number."""
    if not edges:
        return _several(x) if values[0] is _SEVERAL else F.lit(values[0]).cast("string")
    middle = len(edges) // 2
    below = _by_halving(x, edges[:middle], values[: middle + 1])
    return F.when(x < edges[middle], below).otherwise(_by_halving(x, edges[middle + 1 :], values[middle + 1 :]))


def _by_range(df: DataFrame, x: Column, bands: DataFrame, out: str, unknown: str, ranges: int) -> DataFrame:
    """Join rows and bands on ranges of the measure, cut so that bands begin in each about equally often.

    Only the cuts are gathered. A band stands in every range it reaches into: bands that do not overlap
    give at most one row for each band and each cut. A range's bands lie in one row, in order of their
    beginning, and a row's band is found among them by halving where they do not overlap, else by a look
    at each. The joined side has a row a range; which strategy joins it is Spark's choice by its size.
    """
    known = bands.where("low < high")
    shares = [i / ranges for i in range(1, ranges)]
    cuts = known.agg(F.percentile_approx("low", F.array(*map(F.lit, shares)), 10 * ranges).alias("cuts")).first()["cuts"]
    edges = sorted(set(cuts or ()))
    listed = F.array(*map(F.lit, edges)) if edges else F.array().cast("array<double>")
    powers = F.array(*[F.lit(2**i) for i in range(len(edges).bit_length(), -1, -1)])
    place = lambda v: _last_at(listed, F.lit(len(edges)), powers, lambda e: e <= v) + 1
    reached = F.sequence(place(F.col("low")), place(F.col("high")))
    held = (
        known.select("label", "low", "high", F.explode(reached).alias("__range"))
        .groupBy("__range")
        .agg(F.array_sort(F.collect_list(F.struct("low", "high", "label"))).alias("__bands"))
    )
    size = F.size("__bands")
    apart = F.forall(F.sequence(F.lit(1), F.greatest(size, F.lit(2)) - 1), lambda i: (i >= size) | (
        F.get("__bands", i - 1)["high"] <= F.get("__bands", i)["low"]))
    held = held.withColumn("__apart", apart).withColumn("__steps", _halves(size))

    holds = lambda b: (b["low"] <= x) & (x < b["high"])
    last = F.get("__bands", _last_at(F.col("__bands"), size, F.col("__steps"), lambda b: b["low"] <= x))
    among = F.filter("__bands", holds)
    found = (
        F.when(F.col("__apart"), F.when(holds(last), last["label"]))
        .when(F.size(among) > 1, _several(x))
        .otherwise(F.get(among, F.lit(0))["label"])
    )
    # Rows without a measure meet no range; they stay apart by where they were read.
    at = F.when(x.isNotNull(), place(x)).otherwise(-1 - F.spark_partition_id())
    joined = df.withColumn("__range", at).join(held, "__range", "left")
    label = F.when(x.isNull(), F.lit(unknown)).when(F.col("__bands").isNotNull(), found)
    return joined.withColumn(out, label).select(*df.columns, *([out] if out not in df.columns else []))


def _halves(size: Column) -> Column:
    """Powers of two, the largest first, that add up to the size at least."""
    top = F.greatest(F.ceil(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("int"), F.lit(0))
    return F.transform(F.sequence(top, F.lit(0)), lambda i: F.pow(F.lit(2), i).cast("int"))


def _last_at(items: Column, size: Column, steps: Column, holds: Callable[[Column], Column]) -> Column:
    """The place of the last item for which a test holds that holds for a head of the list; -1 for none."""
    further = lambda at, step: F.when((at + step < size) & holds(F.get(items, at + step)), at + step).otherwise(at)
    return F.aggregate(steps, F.lit(-1), further)


def classify_bands(
    df: DataFrame,
    measure: str,
    bands: DataFrame,
    out: str = "size_class",
    unknown: str = "unknown",
    low: str = "min_kg",
    high: str = "max_kg",
    label: str = "label",
) -> DataFrame:
    """Label each row with the one band that holds its measure.

    NULL measure -> ``unknown``; no band -> NULL; two bands -> the query fails. A table of up to
    ``MAX_BANDS`` rows is read when the query is built and becomes one expression in the code-generated
    stage of the rows, without a join. A larger one stays a table: rows and bands meet by ranges of the
    measure, numbers, dates or times, and nothing but the cuts between ranges is gathered.
    """
    rows = bands.select(label, low, high).limit(MAX_BANDS + 1).collect()
    x = F.col(measure)
    if len(rows) > MAX_BANDS:
        named = bands.select(F.col(label).cast("string").alias("label"), F.col(low).alias("low"), F.col(high).alias("high"))
        return _by_range(df, x, named, out, unknown, RANGES)
    return df.withColumn(out, F.when(x.isNull(), F.lit(unknown)).otherwise(_by_halving(x, *_segments(rows))))


def bucketize(column: Column | str, cuts: Sequence[float], labels: Sequence[str], floor: float = 0.0) -> Column:
    """Half-open classes between cuts given in any order; the last one is open at the top and
    anything below ``floor`` is NULL."""
    x = F.col(column) if isinstance(column, str) else column
    edges = sorted(cuts)
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than cuts is needed")
    result = F.when(x < floor, F.lit(None).cast("string"))
    for edge, name in zip(edges, labels):
        result = result.when(x < edge, F.lit(name))
    return result.when(x.isNotNull(), F.lit(labels[-1]))


def band_defects(
    bands: DataFrame, low: str = "min_kg", high: str = "max_kg", label: str = "label"
) -> DataFrame:
    """Bands that are inverted or empty, and bands whose end is not the start of the next.

    The window has no partition because band tables are configuration: tens of rows.
    """
    following = Window.orderBy(F.col(low).asc_nulls_last(), F.col(label).asc_nulls_last())
    seen = bands.select(
        label, low, high,
        F.lead(label).over(following).alias("next_label"),
        F.lead(low).over(following).alias("next_low"),
    )
    empty = F.when(F.col(low) >= F.col(high), F.concat(F.lit(low), F.lit(" >= "), F.lit(high)))
    broken = F.when(
        F.col("next_low").isNotNull() & (F.col(high) != F.col("next_low")),
        F.concat(
            F.lit(f"{high} ("), F.col(high).cast("string"), F.lit(") <> start of "),
            F.col("next_label"), F.lit(" ("), F.col("next_low").cast("string"), F.lit(")"),
        ),
    )
    problems = seen.withColumn("problem", F.explode(F.array_compact(F.array(empty, broken))))
    return problems.select(label, low, high, "problem")


def in_band_order(df: DataFrame, bands: DataFrame, column: str = "size_class", low: str = "min_kg") -> DataFrame:
    """Attach ``class_rank`` (1 = lowest band) and order by it; labels outside the bands drop out."""
    ranked = bands.select(
        F.col("label").alias(column),
        F.row_number().over(Window.orderBy(F.col(low).asc_nulls_last())).cast("int").alias("class_rank"),
    )
    return df.join(ranked, column).orderBy("class_rank")
