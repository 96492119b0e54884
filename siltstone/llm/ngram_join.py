"""N-gram Jaccard join: MinHash bands find candidates, full shingle sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buckets
from .common import Words, forest, groups, mixed, powers, shingles, signed, slices, stored, texts_of
from .components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1 << 20


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band can have, so the fewest false candidates, with the target recall.

    A pair at the threshold shares a band of r hashes with probability threshold ** r; b bands miss it
    with (1 - threshold ** r) ** b. Pairs above the threshold are missed less often.
    """
    best = None
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"{hashes} hashes cannot reach a recall of {recall} at {threshold}")
    return best


def band_keys(grams: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """MinHash band keys of each text, (texts, bands); texts without shingles get zeros."""
    n = bands * rows
    factor = mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    shift = mixed(np.arange(n + 1, 2 * n + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(first))
    keys = np.zeros((len(first) - 1, bands), np.uint64)
    if not len(full):
        return keys
    least = np.empty((n, len(full)), np.uint32)
    # In runs of texts, so that one text's shingles stay in the cache over all hashes.
    low = 0
    while low < len(full):
        high = max(low + 1, int(np.searchsorted(first[full + 1], first[full[low]] + (1 << 15), side="right")))
        part = grams[first[full[low]] : first[full[high - 1] + 1]]
        heads = first[full[low:high]] - first[full[low]]
        for i in range(n):
            value = ((part * factor[i] + shift[i]) >> np.uint64(32)).astype(np.uint32)
            least[i, low:high] = np.minimum.reduceat(value, heads)
        low = high
    step = powers(np.uint64(0x9E3779B97F4A7C15), rows)
    by_band = least.astype(np.uint64).reshape(bands, rows, len(full))
    key = mixed((by_band * step[None, :, None]).sum(axis=1, dtype=np.uint64))
    keys[full] = key.T
    return keys


def _digests(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's word sequence."""
    out = []
    counts = words.counts
    full = np.flatnonzero(counts)
    place = np.arange(len(words.hash)) - np.repeat(words.first[:-1], counts)
    table = powers(np.uint64(0x9E3779B97F4A7C15), int(counts.max(initial=0)))
    for salt in (np.uint64(1), np.uint64(2)):
        value = mixed(words.hash ^ (salt * np.uint64(0x632BE59BD9B4E019))) * table[place]
        d = np.zeros(len(counts), np.uint64)
        if len(full):
            d[full] = np.add.reduceat(value, words.first[full])
        out.append(mixed(d + counts.astype(np.uint64)))
    return out[0], out[1]


def _signatures(shingle: int, bands: int, rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for low, high in slices(texts):
                words = Words(texts.slice(low, high - low))
                one, two = _digests(words)
                grams, first = shingles(words, shingle)
                keys = band_keys(grams, first, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low),
                        pa.array(signed(one)), pa.array(signed(two)),
                        pa.array(words.counts.astype(np.int64)), pa.array(np.diff(first).astype(np.int64)),
                        pa.array([k.tobytes() for k in keys], pa.binary()),
                    ],
                    names=["id", "print", "d1", "d2", "words", "size", "keys"],
                )

    return run


def _sets(shingle: int):
    """The sorted distinct shingles of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(0))
            for low, high in slices(texts):
                words = Words(texts.slice(low, high - low))
                one, two = _digests(words)
                grams, first = shingles(words, shingle)
                sets = [np.unique(grams[a:b]).tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(one)), pa.array(signed(two)), pa.array(sets, pa.binary())], names=["d1", "d2", "grams"]
                )

    return run


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], cells: int = 1 << 23) -> np.ndarray:
    """How many shingles each left set shares with each right set."""
    every = np.concatenate(left + right)
    known, place = np.unique(every, return_inverse=True)
    shared = np.flatnonzero(np.bincount(place, minlength=len(known)) > 1)
    column = np.full(len(known), -1)
    column[shared] = np.arange(len(shared))
    at = column[place]
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    out = np.zeros((len(left), len(right)), np.float32)
    width = max(1, cells // (len(left) + len(right)))
    for low in range(0, len(shared), width):
        here = (at >= low) & (at < low + width)
        table = np.zeros((len(left) + len(right), min(width, len(shared) - low)), np.float32)
        table[row[here], at[here] - low] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out


def _verify(threshold: float):
    """Per block pair: for each text the copies it links with here, and links that connect the linked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["band", "key", "i", "j"]):
            get = lambda name: group.column(name).to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("grams").to_pylist()]
            keys = np.stack([np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()])
            band, i, j = int(get("band")[0]), int(get("i")[0]), int(get("j")[0])
            block, copies, nodes = get("block"), get("copies"), group.column("node").combine_chunks()
            a = np.arange(len(sets)) if i == j else np.flatnonzero(block == i)
            b = a if i == j else np.flatnonzero(block == j)
            if not len(a) or not len(b):
                continue
            size = np.array([len(s) for s in sets], np.float32)
            both = shared_counts([sets[x] for x in a], [sets[x] for x in b])
            # Counts are whole, so a margin far below one part in their number only undoes rounding.
            union = size[a][:, None] + size[b][None, :] - both
            linked = both.astype(np.float64) >= threshold * union.astype(np.float64) - 1e-9
            if i == j:
                linked &= np.triu(np.ones(linked.shape, bool), 1)
            x, y = np.nonzero(linked)
            x, y = a[x], b[y]
            new = np.ones(len(x), bool)
            for t in range(band):
                new &= keys[x, t] != keys[y, t]
            x, y = x[new], y[new]
            if not len(x):
                continue
            found = np.bincount(x, copies[y], len(sets)) + np.bincount(y, copies[x], len(sets))
            some = np.flatnonzero(found)
            pairs = np.array(forest(len(sets), x, y)).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    nodes.take(pa.array(np.concatenate([some, pairs[:, 0]]))),
                    nodes.take(pa.array(np.concatenate([some, pairs[:, 1]]))),
                    pa.array(np.concatenate([found[some], np.zeros(len(pairs))]).astype(np.int64)),
                ],
                names=["a", "b", "n_links"],
            )

    return run


def _linked(source: DataFrame, shingle: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """Of rows (id, text) the signatures (id, d1, d2, words, ...) and the classes of equal words among them.

    A class goes by the 128 bits of its words, ids are only carried along: (d1, d2, node, copies, linked,
    component). A node begins with the class's smallest id, nulls last, so the smallest node of a
    component names its smallest id. ``linked`` and ``component`` are null where nothing links.
    """
    bands, rows = bands_for(threshold, recall)
    source = source.withColumn("print", F.xxhash64("text"))
    id_type = source.schema["id"].dataType.simpleString()
    signatures = stored(
        source.select("id", "text", "print").mapInArrow(
            _signatures(shingle, bands, rows),
            f"id {id_type}, print long, d1 long, d2 long, words long, size long, keys binary",
        ),
        "signatures",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "print")).alias("first")
    classes = stored(
        signatures.where("words > 0").groupBy("d1", "d2").agg(
            first, F.count("*").alias("copies"), F.min("size").alias("size"), F.min("keys").alias("keys")
        ).select("d1", "d2", F.struct("first.none", "first.id", "d1", "d2").alias("node"), "first.print", "copies", "size", "keys"),
        "classes",
    )
    members = classes.selectExpr(
        "d1", "d2", "size", f"posexplode(transform(sequence(0, {bands - 1}), t -> substring(keys, 8 * t + 1, 8))) as (band, key)"
    )
    pairs = stored(buckets.dealt(members, ["d1", "d2"], BLOCK_ROWS, BLOCK_SHINGLES), "buckets")
    wanted = pairs.select("d1", "d2").distinct().join(classes, ["d1", "d2"])
    # One row of each class gives its text: found by its id and a hash of the text, which may find more, never less.
    named = wanted.select(F.col("node.id").alias("wanted_id"), F.col("print").alias("wanted_print")).distinct()
    same = F.col("id").eqNullSafe(F.col("wanted_id")) & F.col("print").eqNullSafe(F.col("wanted_print"))
    sets = source.join(named, same, "left_semi").select("text").mapInArrow(_sets(shingle), "d1 long, d2 long, grams binary")
    sets = stored(
        sets.join(wanted, ["d1", "d2"]).dropDuplicates(["d1", "d2"]).select("d1", "d2", "grams", "keys", "copies", "node"), "sets"
    )
    dealt = pairs.join(sets, ["d1", "d2"]).select("band", "key", "i", "j", "block", "node", "copies", "keys", "grams")
    dealt = dealt.repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j", "node")
    node = classes.schema["node"].dataType.simpleString()
    found = stored(dealt.mapInArrow(_verify(threshold), f"a {node}, b {node}, n_links long"), "found")
    links = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("linked"))
    components = connected_components(found.where("a != b")).select(F.col("id").alias("node"), "component")
    state = classes.select("d1", "d2", "node", "copies").join(links, "node", "left").join(components, "node", "left")
    return signatures, state


def ngram_jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """Per row: id, class_id, n_links, component_id, kept.

    Two texts are linked when the Jaccard similarity of their sets of ``shingle``-word shingles is at
    least ``threshold``. Rows of the same words are one class, named by its smallest id; only one of
    them is compared. ``n_links`` counts the other rows linked with this one, copies included,
    ``component_id`` is the smallest id reachable by links, and ``kept`` is true for the rows that have
    that id and the words of one class of the component, so a group keeps one text. A text of 1 to 4
    words is one shingle; null, empty and wordless texts link with nothing, are their own class and are
    kept. Links are between texts, so rows of different texts under one id each have their own, and rows
    without an id link as others do: a null is larger than any id, and a group without any id has the
    component null. Rows that repeat the kept row's id and words are kept with it.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signatures, state = _linked(source, shingle, threshold, recall)
    out = signatures.select("id", "d1", "d2", "words").join(state, ["d1", "d2"], "left")
    alone = F.col("words") == 0
    top = F.coalesce("component", "node")
    component = F.when(alone, F.col("id")).otherwise(top["id"])
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("node.id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        (alone | (F.col("id").eqNullSafe(component) & (top == F.col("node")))).alias("kept"),
    )


def one_of_each_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """The rows of ``docs`` without near and exact copies, all columns as they are.

    Texts are linked as ``ngram_jaccard_join`` links them, under 128-bit digests of their own instead of
    their ids, so null and repeated ids are no matter. Of each group the row with the smallest id stays, a
    null only where no row has an id. Wordless texts stay; of rows that share both id and text one stays.
    """
    text = F.col(text_col).cast("string")
    digest = F.unhex(F.md5(text))
    wordy = F.coalesce(text.rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"), F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), digest.alias("digest"), wordy.alias("wordy"), text.alias("text"))
    signatures, state = _linked(rows.where("wordy").select(F.col("digest").alias("id"), "text"), shingle, threshold, recall)
    # Equal texts have equal words, so a digest has one class and one group.
    group = signatures.groupBy("id").agg(F.first("d1").alias("d1"), F.first("d2").alias("d2")).join(state, ["d1", "d2"])
    group = group.select(F.col("id").alias("digest"), F.coalesce("component", "node").alias("group"))
    counts = stored(rows.groupBy("id", "digest", "wordy").count(), "counts")
    # One row of each text before the join, so that copies of a text don't meet in it.
    first = counts.where("wordy").groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "count")).alias("row"))
    least = F.min(F.struct("row.none", "row.id", "digest", "row.count")).alias("row")
    kept = first.join(group, "digest").groupBy("group").agg(least).select("row.id", "row.digest", "row.count")
    kept = kept.union(counts.where("not wordy").select("id", "digest", "count")).toDF("__id", "__digest", "__count")
    kept = stored(kept, "kept")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & digest.eqNullSafe(F.col("__digest"))
    once = docs.join(kept.where("__count = 1"), same, "left_semi")
    # Rows that come more than once are few; only those are compared as wholes.
    more = docs.join(kept.where("__count > 1"), same, "left_semi").withColumn("__text", digest)
    return once.union(more.dropDuplicates([id_col, "__text"]).drop("__text"))
