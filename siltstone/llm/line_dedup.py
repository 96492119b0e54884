"""Line dedup: lines spread over many sites are boilerplate. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_SITES = 6
LG_K = 12


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2) of the lines seen on at least ``min_sites`` distinct sites, from (h1, h2, site).

    One HyperLogLog sketch per line, merged map-side and over the shuffle. An estimate well off the
    threshold decides; the lines near it, by four standard errors and one site at least, are counted
    exactly.
    """
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k)))
    estimates = lines.where("site is not null").groupBy("h1", "h2").agg(estimate.alias("sites"))
    margin = max(1, round(4 * 1.04 / 2 ** (lg_k / 2) * min_sites + 0.5))
    candidates = stored(
        estimates.where(F.col("sites") >= min_sites - margin).withColumn("near", F.col("sites") <= min_sites + margin), "sketched"
    )
    near = lines.join(candidates.where("near").select("h1", "h2"), ["h1", "h2"], "left_semi")
    exact = near.where("site is not null").select("h1", "h2", "site").distinct().groupBy("h1", "h2").count()
    return candidates.where("not near").select("h1", "h2").union(
        exact.where(F.col("count") >= min_sites).select("h1", "h2")
    )


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``docs`` with boilerplate lines cut from the text, and a last column ``removed_lines``.

    Lines end at a line feed; spaces, tabs and carriage returns around a line don't count, and blank
    lines are never boilerplate. A line seen on ``min_sites`` distinct sites or more stays at its first
    place only (smallest id, then place in the text), so no content is lost. A null site is no site. A
    null text stays null, an empty one empty; a text of boilerplate only becomes empty. Rows that are
    equal in id and text are treated alike. All columns stay; ``removed_lines`` is replaced if there.
    """
    names = [c for c in docs.columns if c != "removed_lines"]
    source = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(site_col).cast("string").alias("site"),
        F.posexplode(F.split(F.col(text_col).cast("string"), "\n", -1)).alias("pos", "line"),
    )
    line = F.btrim("line", F.lit(" \t\r"))
    lines = stored(
        source.where(line != "").select(
            "id", "digest", "site", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2")
        ),
        "lines",
    )
    spread = stored(spread_lines(lines, min_sites), "spread")
    places = lines.join(spread, ["h1", "h2"]).select("h1", "h2", F.struct("id", "digest", "pos").alias("place"))
    first = places.groupBy("h1", "h2").agg(F.min("place").alias("kept"))
    cut = places.join(first, ["h1", "h2"]).where("not (place <=> kept)").select("place.*").distinct()
    cut = cut.groupBy("id", "digest").agg(F.collect_list("pos").alias("cut"))
    cut = stored(cut, "cut").toDF("__id", "__digest", "__cut")
    same = F.col(id_col).eqNullSafe(F.col("__id")) & F.xxhash64(text_col).eqNullSafe(F.col("__digest"))
    kept = F.filter(F.split(text_col, "\n", -1), lambda x, i: ~F.array_contains("__cut", i))
    text = F.when(F.col("__cut").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    # A merge join at every size: what is cut grows with the documents and is never small at scale.
    joined = docs.select(*names).join(cut.hint("merge"), same, "left")
    removed = F.coalesce(F.size("__cut"), F.lit(0))
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in names],
        F.when(F.col("__cut").isNull(), F.lit(0)).otherwise(removed).cast("long").alias("removed_lines"),
    )
