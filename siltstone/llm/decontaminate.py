"""Benchmark decontamination: winnowed k-gram fingerprints, joined and extended to exact windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, gram_hashes, signed, slices, stored, texts_of
from .filters import fixed_filter, passing

WINDOW = 10
GRAM = 5


def winnow(grams: np.ndarray, span: int) -> np.ndarray:
    """For every ``span`` grams in a row the place of the smallest hash, of equal ones the rightmost."""
    n = max(0, len(grams) - span + 1)
    best = np.arange(n) + span - 1
    least = grams[best]
    for i in range(span - 2, -1, -1):
        here = grams[i : i + n]
        lower = here < least
        least = np.where(lower, here, least)
        best = np.where(lower, np.arange(n) + i, best)
    return best


def _item_prints(window: int, gram: int):
    """Fingerprints of the items, each with the words that an extension can reach."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            ids = batch.column(0)
            item, prints, length, before, context = [], [], [], [], []
            for low, high in slices(texts):
                words = Words(texts.slice(low, high - low))
                for t in range(high - low):
                    a, b = int(words.first[t]), int(words.first[t + 1])
                    h = words.hash[a:b]
                    if 0 < len(h) < window:
                        k, places = len(h), [0]
                    else:
                        k, places = gram, np.unique(winnow(gram_hashes(h, gram), window - gram + 1))
                    grams = gram_hashes(h, k)
                    for p in places:
                        left = min(int(p), window - k) if k == gram and len(h) >= window else 0
                        right = min(len(h), int(p) + (window if len(h) >= window else k))
                        item.append(low + t)
                        prints.append(grams[p])
                        length.append(k if len(h) < window else 0)
                        before.append(left)
                        context.append([words.text(a + i).decode("utf-8", "replace") for i in range(int(p) - left, right)])
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(item, pa.int64())), pa.array(signed(np.array(prints, np.uint64))),
                    pa.array(length, pa.int32()), pa.array(before, pa.int32()), pa.array(context, pa.list_(pa.string())),
                ],
                names=["item_id", "print", "short", "before", "context"],
            )

    return run


def _maybe_hit(filter_):
    """The rows whose digest the filter knows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(passing(filter_, digest, 0)))

    return run


def _candidates(window: int, gram: int, shorts: list[int], filter_):
    """Per text: number of words, and the fingerprints that pass the filter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("pos", pa.int32()), ("short", pa.int32()), ("print", pa.int64())]))
        for batch in batches:
            texts = texts_of(batch.column(2))
            for low, high in slices(texts):
                words = Words(texts.slice(low, high - low))
                n = high - low
                found: list[list[dict]] = [[] for _ in range(n)]

                def keep(places: np.ndarray, prints: np.ndarray, short: int) -> None:
                    good = passing(filter_, prints, short)
                    places, prints = places[good], signed(prints[good])
                    text = np.searchsorted(words.first, places, side="right") - 1
                    for t, p, h in zip(text.tolist(), (places - words.first[text]).tolist(), prints.tolist()):
                        found[t].append({"pos": p, "short": short, "print": h})

                grams = gram_hashes(words.hash, gram)
                places = _winnow_texts(grams, words, window, gram)
                keep(places, grams[places], 0)
                for k in shorts:
                    h = gram_hashes(words.hash, k)
                    at = np.arange(len(h))
                    text = np.searchsorted(words.first, at, side="right") - 1
                    at = at[at + k <= words.first[text + 1]]
                    keep(at, h[at], k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, n), batch.column(1).slice(low, n),
                        pa.array(words.counts.astype(np.int64)), pa.array(found, kind),
                    ],
                    names=["id", "digest", "n_words", "prints"],
                )

    return run


def _winnow_texts(grams: np.ndarray, words: Words, window: int, gram: int) -> np.ndarray:
    """Winnowed places of all texts at once: windows that lie inside one text."""
    best = winnow(grams, window - gram + 1)
    n = len(best)
    inside = np.ones(n, bool)
    # A window that starts fewer than ``window`` words before the end of its text reaches into the next.
    for back in range(1, window):
        at = words.first[1:] - back
        at = at[(at >= 0) & (at < n)]
        inside[at] = False
    return np.unique(best[inside])


def _extend(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(2))
            hits = batch.column(3)
            n_hit, items = [], []
            for low, high in slices(texts):
                words = Words(texts.slice(low, high - low))
                for t in range(high - low):
                    a, n = int(words.first[t]), int(words.counts[t])
                    own: dict[int, str] = {}

                    def word(i: int) -> str:
                        if i not in own:
                            own[i] = words.text(a + i).decode("utf-8", "replace")
                        return own[i]

                    covered = np.zeros(n + 1, np.int64)
                    present = set()
                    for hit in hits[low + t].as_py():
                        context, before = hit["context"], hit["before"]
                        core, need = (hit["short"], hit["short"]) if hit["short"] else (hit["gram"], window)
                        at = hit["pos"]
                        if at + core > n or any(word(at + i) != context[before + i] for i in range(core)):
                            continue
                        start, stop = at, at + core
                        while start > 0 and at - start < before and word(start - 1) == context[before + start - 1 - at]:
                            start -= 1
                        while stop < n and before + stop - at < len(context) and word(stop) == context[before + stop - at]:
                            stop += 1
                        if stop - start >= need:
                            covered[start] += 1
                            covered[stop] -= 1
                            present.update(hit["items"])
                    n_hit.append(int((np.cumsum(covered) > 0).sum()))
                    items.append(sorted(present, key=str))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.int64()))],
                names=["id", "digest", "n_hit", "items"],
            )

    return run


def benchmark_overlap(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, items (sorted as strings).

    A window is ``window`` words in a row of an item; an item of fewer words, but not none, is one
    window. A word is hit when it lies in an occurrence of a window. Of every ``window - gram + 1`` grams
    in a row the smallest hash is a fingerprint, on both sides, so each shared window has one in common;
    a hit is extended word by word and counts from a whole window on. Short items are looked up by one
    hash of all their words, since winnowing promises nothing for them.

    Null and empty texts have no words and no hits; items without words are left out. Items with a null id
    count like others, all of them as one item, which is null among ``items``. Every row gives a row,
    repeated ones too, with null ids as well.
    """
    found = _overlap(docs, benchmark, id_col, text_col, item_col, item_text_col, window, gram)
    return found.select(F.col("id").alias(id_col), "n_words", "n_hit", "items")


def _overlap(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int, gram: int
) -> DataFrame:
    """``benchmark_overlap`` with the digest of each row's text."""
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    prints = items.mapInArrow(
        _item_prints(window, gram), "item_id long, print long, short int, before int, context array<string>"
    )
    # Items that share a passage share its fingerprints: one row for equal words.
    ids = F.transform(F.sort_array(F.collect_set(F.struct("item_id"))), lambda s: s["item_id"])
    prints = stored(prints.groupBy("print", "short", "before", "context").agg(ids.alias("items")), "prints")
    shared_filter = fixed_filter(prints.select("print", "short"))
    shorts = sorted(r["short"] for r in prints.where("short > 0").select("short").distinct().collect())

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    source = source.select("id", F.xxhash64("text").alias("digest"), "text")
    base = stored(
        source.mapInArrow(
            _candidates(window, gram, shorts, shared_filter),
            "id long, digest long, n_words long, prints array<struct<pos:int,short:int,print:long>>",
        ),
        "candidates",
    )
    found = base.where("size(prints) > 0").select("id", "digest", F.explode("prints").alias("p"))
    found = found.select("id", "digest", "p.*").distinct().join(prints, ["print", "short"])
    hit = F.struct("pos", "short", F.lit(gram).alias("gram"), "before", "context", "items").alias("hit")
    hits = found.select("id", "digest", hit).groupBy("id", "digest").agg(F.collect_list("hit").alias("hits"))
    hits = stored(hits, "hits")
    # Only texts that may have a hit move for the extension; the merge join holds at every size.
    may_hit = source.mapInArrow(
        _maybe_hit(fixed_filter(hits.select("digest", F.lit(0).alias("salt")))), "id long, digest long, text string"
    )
    hits = hits.withColumnsRenamed({"id": "hit_id", "digest": "hit_digest"})
    same = F.col("id").eqNullSafe(F.col("hit_id")) & F.col("digest").eqNullSafe(F.col("hit_digest"))
    extended = may_hit.join(hits.hint("merge"), same).select("id", "digest", "text", "hits").mapInArrow(
        _extend(window), "id long, digest long, n_hit long, items array<long>"
    )
    extended = extended.where("n_hit > 0").dropDuplicates(["id", "digest"])
    extended = stored(extended, "extended").withColumnsRenamed({"id": "hit_id", "digest": "hit_digest"})
    return base.join(extended, same, "left").select(
        "id",
        "digest",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit, all columns kept. Rows of one id, or of none, are told apart by their texts."""
    found = _overlap(docs, benchmark, id_col, text_col, "item_id", "text", WINDOW, GRAM)
    hit = found.where("n_hit > 0").select(F.col("id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & F.xxhash64(F.col(text_col).cast("string")).eqNullSafe(F.col("__digest"))
    return docs.join(hit, same, "left_anti")
