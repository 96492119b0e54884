"""Exact quantiles, correlations, fits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.numbers import round_to

# Sample slots of each group; any number gives the same result. They cut a group of any size into some
# buckets, so that its distinct values are spread over tasks.
SLOTS = 63

# Beyond the slots one distinct value in so many is a cut, which holds buckets near this size in groups
# of any number of values.
CUT_EVERY = 1 << 20

# Tests by which a value finds its bucket: enough for 2 ** STEPS - 1 cuts.
STEPS = 20

# Copies of a group's cut points, so that a group with very many values is met by several tasks
# where its cuts are joined to its values.
SALTS = 8


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also pairs NULL keys, keeping the left key columns."""
    if not keys:
        raise ValueError("keys are needed")
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    test = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    return left.join(renamed, test, how).drop(*[f"__r_{k}" for k in keys])


def values_at_ranks(df: DataFrame, value: str, by: Sequence[str], wanted) -> DataFrame:
    """Exact order statistics without sorting a group in one task.

    ``wanted(total)`` gives an array of structs whose field ``rank`` counts from 0 among the
    non-null values of the group; it may look at the group's key columns too.
    Result: (*by, want, value).

    1. values are counted per (group, value), so a hot group is split by its values;
    2. a sample of each group's distinct values, which grows with them, cuts them into buckets of
       bounded size. It only spreads the work: any cuts give the exact result. The sample is a function of the values alone, so that a
       task that is run again after a loss puts every value in the same bucket;
    3. bucket sizes are summed up per group, which tells the one bucket that holds each wanted
       rank;
    4. only those buckets are ordered, each by itself.
    """
    by = list(by)
    # the test on the count drops NULL values after the count: a test on the value itself would be
    # pushed below it and compute the value's expression twice. Being in front of every use, it
    # also keeps their plans equal up to the shuffle, so Spark counts once and reuses the exchange.
    counts = (
        df.groupBy(*by, F.col(value).alias("__v")).agg(F.count(F.col(value)).alias("__n")).where(F.col("__n") > 0)
    )
    bucketed = _bucketed(counts, by)
    sums = bucketed.groupBy(*by, "__b").agg(F.sum("__n").alias("__bn"))
    upto = Window.partitionBy(*by).orderBy("__b")
    sums = sums.withColumn("__end", F.sum("__bn").over(upto)).withColumn(
        "__total", F.sum("__bn").over(Window.partitionBy(*by))
    )
    asked = sums.select(*by, "__b", "__end", "__bn", F.explode(wanted(F.col("__total"))).alias("want"))
    held = asked.where(
        (F.col("want.rank") < F.col("__end")) & (F.col("want.rank") >= F.col("__end") - F.col("__bn"))
    )
    targets = held.groupBy(*by, "__b").agg(
        F.max(F.col("__end") - F.col("__bn")).alias("__start"), F.collect_list("want").alias("__wants")
    )
    inside = _match(bucketed, targets, [*by, "__b"])
    running = Window.partitionBy(*by, "__b").orderBy("__v")
    placed = inside.withColumn("__end", F.col("__start") + F.sum("__n").over(running))
    hits = F.filter(
        "__wants",
        lambda w: (w["rank"] < F.col("__end")) & (w["rank"] >= F.col("__end") - F.col("__n")),
    )
    return placed.select(*by, F.explode(hits).alias("want"), F.col("__v").alias(value))


def _bucketed(counts: DataFrame, by: list[str]) -> DataFrame:
    """(*by, __v, __n, __b): ``__b`` is the number of the group's cuts that lie below the value."""
    drawn = F.xxhash64("__v", F.lit(2))
    slot = F.when(F.pmod(drawn, F.lit(CUT_EVERY)) == 0, drawn).otherwise(F.pmod(F.xxhash64("__v"), F.lit(SLOTS)))
    sample = counts.groupBy(*by, slot.alias("__slot")).agg(
        F.min_by("__v", F.xxhash64("__v", F.lit(1))).alias("__cut")
    )
    cuts = sample.groupBy(*by).agg(F.array_sort(F.collect_list("__cut")).alias("__cuts"))
    every = F.array(*[F.lit(1 << i) for i in reversed(range(STEPS))])
    cuts = cuts.withColumn("__steps", F.filter(every, lambda step: step <= F.size("__cuts")))
    if by:
        salted = cuts.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        values = counts.withColumn("__salt", F.pmod(F.hash("__v"), F.lit(SALTS)))
        cut = _match(values, salted, [*by, "__salt"])
    else:
        cut = counts.withColumn("__c", cuts.select(F.struct("__cuts", "__steps")).scalar()).select("__v", "__n", "__c.*")
    below = F.aggregate(
        "__steps", F.lit(0), lambda b, step: F.when(F.get("__cuts", b + step - 1) < F.col("__v"), b + step).otherwise(b)
    )
    return cut.select(*by, "__v", "__n", below.alias("__b"))


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    approx: bool = False,
    count: str | None = None,
) -> DataFrame:
    """Interpolated quantiles as (*by, prob, quantile), exact unless ``approx``; ``count`` adds
    the number of values of the group (exact form only)."""
    by = list(by)
    if approx and count:
        raise ValueError("counts come with exact quantiles only")
    if approx:
        pick = F.percentile_approx(value, list(probs), 10000)
        rows = df.where(F.col(value).isNotNull()).groupBy(*by).agg(pick.alias("q"))
        pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("q").alias("quantile"))
        return rows.select(*by, F.inline(pairs))

    def wanted(total: Column) -> Column:
        asked = []
        for p in probs:
            spot = F.lit(float(p)) * (total - 1)
            low, high = F.floor(spot).cast("long"), F.ceil(spot).cast("long")
            frac = spot - F.floor(spot)
            asked += [_want(p, low, F.lit(False), frac, total), _want(p, high, F.lit(True), frac, total)]
        return F.array(*asked)

    found = values_at_ranks(df, value, by, wanted)
    low = F.max(F.when(~F.col("want.upper"), F.col(value)))
    high = F.max(F.when(F.col("want.upper"), F.col(value)))
    frac = F.max("want.frac")
    sizes = [F.max("want.total").alias(count)] if count else []
    return found.groupBy(*by, F.col("want.prob").alias("prob")).agg(
        (low + (high - low) * frac).cast("double").alias("quantile"), *sizes
    )


def _want(prob: float, rank: Column, upper: Column, frac: Column, total: Column) -> Column:
    return F.struct(
        F.lit(float(prob)).alias("prob"), rank.alias("rank"), upper.alias("upper"), frac.alias("frac"),
        total.alias("total"),
    )


def median(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median", approx: bool = False) -> DataFrame:
    found = quantiles(df, value, [0.5], by, approx)
    return found.select(*by, F.col("quantile").alias(out))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Correlation over the rows where both are present; NULL for fewer than two such rows or a
    constant column (plain ``corr`` divides by zero there)."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    plain = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(F.count(a) > 1, plain)


def pairwise_corr(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    by: Sequence[str] = (),
    listwise: bool = False,
    count: str = "n_entities",
    places: int | None = 3,
) -> DataFrame:
    """(*by, metric_a, metric_b, correlation, n): all pairs from a single scan.

    Each pair has its own population, unless ``listwise`` keeps only rows complete in all.
    """
    if listwise:
        df = df.dropna(subset=sorted({c for pair in pairs for c in pair}))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        aggs += [pearson(a, b).alias(f"r{i}"), F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"n{i}")]
    wide = df.groupBy(*by).agg(*aggs)
    rows = [
        F.struct(
            F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"),
            (F.col(f"r{i}") if places is None else round_to(f"r{i}", places)).alias("correlation"),
            F.col(f"n{i}").alias(count),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def corr_matrix(df: DataFrame, columns: Sequence[str], places: int = 3) -> DataFrame:
    """Symmetric pairwise-complete matrix in long form, diagonal included; one scan."""
    pairs = [*combinations(columns, 2), *[(c, c) for c in columns]]
    upper = pairwise_corr(df, pairs, places=places).drop("n_entities")
    both = F.when(F.col("metric_a") == F.col("metric_b"), F.array(F.struct("metric_a", "metric_b"))).otherwise(
        F.array(
            F.struct("metric_a", "metric_b"),
            F.struct(F.col("metric_b").alias("metric_a"), F.col("metric_a").alias("metric_b")),
        )
    )
    return upper.select(F.explode(both).alias("pair"), "correlation").select("pair.*", "correlation")


def loglog_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares of ln(y) on ln(x) over rows with both positive: exponent, intercept, R²."""
    rows = df.where((F.col(x) > 0) & (F.col(y) > 0)).select(F.ln(x).alias("lx"), F.ln(y).alias("ly"))
    return rows.agg(
        F.regr_slope("ly", "lx").alias("exponent"),
        F.regr_intercept("ly", "lx").alias("intercept"),
        F.regr_r2("ly", "lx").alias("r2"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def median_ratio(pairs: DataFrame, by: str = "metric", count: str = "n_rows") -> DataFrame:
    """Median of numerator / denominator per metric over rows where both are positive."""
    good = pairs.where((F.col("numerator") > 0) & (F.col("denominator") > 0)).select(
        by, (F.col("numerator") / F.col("denominator")).alias("ratio")
    )
    found = quantiles(good, "ratio", [0.5], [by], count=count)
    return found.select(by, F.col("quantile").alias("median_ratio"), count)


def group_summary(
    df: DataFrame,
    by: str,
    value: str,
    others: Sequence[str] = (),
    places: int = 2,
    names: dict[str, str] | None = None,
    continuous: bool = True,
) -> DataFrame:
    """Per group: rows, non-null values, mean, exact median, sample deviation, min, max of
    ``value`` and the means of ``others``.

    The median comes from ``quantiles``, in a scan of its own that reads two columns, so that no group's
    values meet in one task. A caller who knows the measure to be on a grid of few values (years, counts)
    may say so with ``continuous=False`` and gets by with one scan: rows are summed per (group, value),
    each task sends one partial row per value, and median and deviation follow from the value counts.
    """
    names = names or {}

    def named(key: str, default: str) -> str:
        return names.get(key, default)

    if continuous:
        plain = df.groupBy(by).agg(
            F.count(F.lit(1)).alias(named("count", "n_rows")),
            F.count(value).alias(named("with_value", "n_with_value")),
            round_to(F.avg(value), places).alias(named("mean", f"mean_{value}")),
            round_to(F.stddev_samp(value), places).alias(named("stddev", f"stddev_{value}")),
            F.min(value).alias(named("min", f"min_{value}")),
            F.max(value).alias(named("max", f"max_{value}")),
            *[round_to(F.avg(c), places).alias(named(f"mean_{c}", f"mean_{c}")) for c in others],
        )
        mid = median(df, value, [by], "__median")
        result = _match(plain, mid, [by], "left")
        return result.withColumn(named("median", f"median_{value}"), round_to("__median", places)).drop("__median")

    sums = [F.sum(c).alias(f"__s_{c}") for c in others] + [F.count(c).alias(f"__c_{c}") for c in others]
    counted = df.groupBy(by, value).agg(F.count(F.lit(1)).alias("__n"), *sums)
    group = Window.partitionBy(by)
    seen = F.when(F.col(value).isNotNull(), F.col("__n")).otherwise(F.lit(0))
    running = group.orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        counted.withColumn("__k", seen)
        .withColumn("__end", F.sum("__k").over(running))
        .withColumn("__tot", F.sum("__k").over(group))
        .withColumn("__mean", F.try_divide(F.sum(F.col(value) * F.col("__k")).over(group), F.col("__tot")))
    )
    start = F.col("__end") - F.col("__k")

    def at(rank: Column) -> Column:
        return F.max(F.when((start <= rank) & (rank < F.col("__end")), F.col(value)))

    middle = (F.col("__tot") - 1) / 2
    mid = (at(F.floor(middle)) + at(F.ceil(middle))) / F.lit(2.0)
    squares = F.sum(F.col("__k") * F.pow(F.col(value) - F.col("__mean"), F.lit(2.0)))
    tot = F.max("__tot")
    deviation = F.when(tot > 1, F.sqrt(F.try_divide(squares, (tot - 1).cast("double"))))
    return placed.groupBy(by).agg(
        F.sum("__n").alias(named("count", "n_rows")),
        tot.alias(named("with_value", "n_with_value")),
        round_to(F.max("__mean"), places).alias(named("mean", f"mean_{value}")),
        round_to(mid, places).alias(named("median", f"median_{value}")),
        round_to(deviation, places).alias(named("stddev", f"stddev_{value}")),
        F.min(value).alias(named("min", f"min_{value}")),
        F.max(value).alias(named("max", f"max_{value}")),
        *[
            round_to(F.try_divide(F.sum(f"__s_{c}"), F.sum(f"__c_{c}")), places).alias(
                named(f"mean_{c}", f"mean_{c}")
            )
            for c in others
        ],
    )


def nearest_to(df: DataFrame, column: str, target: Column, key: str) -> DataFrame:
    """The one row whose value is nearest to ``target``, ties by key (top-1, no full sort)."""
    return df.where(F.col(column).isNotNull()).orderBy(F.abs(F.col(column) - target), F.col(key)).limit(1)


def reference_row(df: DataFrame, column: str, key: str) -> DataFrame:
    """The row nearest to the exact median of the column."""
    return nearest_to(df, column, median(df, column).scalar(), key)


def power_curve(df: DataFrame, x: str, y: str, key: str, points: int = 60) -> DataFrame:
    """Cube law and fitted power law on an even grid, both through the reference row."""
    good = df.where((F.col(x) > 0) & (F.col(y) > 0))
    anchor = reference_row(good, x, key).select(F.struct(F.col(x).alias("x"), F.col(y).alias("y"))).scalar()
    facts = good.agg(
        F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"),
        F.regr_slope(F.ln(y), F.ln(x)).alias("slope"),
    )
    at = (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / (points - 1)).alias(x)
    grid = facts.select(F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"), "lo", "hi", "slope")
    # One reference to the anchor, which Spark would else plan once for each use.
    grid = grid.select("point", "slope", at, anchor.alias("anchor"))
    ratio = F.col(x) / F.col("anchor.x")
    return grid.select(
        "point", x,
        (F.col("anchor.y") * F.pow(ratio, F.lit(3.0))).alias("cube_law"),
        (F.col("anchor.y") * F.pow(ratio, F.col("slope"))).alias("fitted"),
    )


def scaled_up(df: DataFrame, x: str, y: str, key: str, above: float) -> DataFrame:
    """The smallest row scaled by the cube law to the mean size of rows above a cut, beside the
    real mean there."""
    small = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).orderBy(x, key).limit(1)
    tall = df.where((F.col(x) > above) & F.col(y).isNotNull()).agg(F.struct(F.avg(x).alias("x"), F.avg(y).alias("y")))
    both = small.select(key, x, y, tall.scalar().alias("tall"))
    factor = F.col("tall.x") / F.col(x)
    return both.select(
        key, x, y, factor.alias("factor"),
        (F.col(y) * F.pow(factor, F.lit(3.0))).alias("by_cube_law"),
        F.col("tall.y").alias("real_mean"),
    )


def build_index(x: Column | str, y: Column | str) -> Column:
    """y per x cubed, times 1000; flat over size if growth is isometric."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    return F.try_divide(y, F.pow(x, F.lit(3.0))) * F.lit(1000.0)
