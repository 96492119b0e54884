"""Quality classifier: weak labellers weighed by expectation-maximisation train a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ascent import ascend
from .common import BYTE, Words, flat_bytes, hash_limit, slices, span_hashes, stored, texts_of

SAMPLE_ROWS = 20_000
DIMENSIONS = 1 << 16
ROUNDS = 60
RATE = 0.5
PENALTY = 1e-5
START_ACCURACY = 0.75

_SYMBOLS = "%*#&$|<>{}[]~^@=_\\/+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def labellers(text: Column) -> dict[str, Column]:
    """Votes on a text: 1 good, 0 bad, -1 no opinion. They overlap, and none is right by itself."""
    size = F.greatest(F.length(text), F.lit(1))
    words = F.split(F.btrim(text), r"\s+")
    n = F.size(words)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x) != "")
    n_lines = F.greatest(F.size(lines), F.lit(1))
    without = lambda chars: 1 - F.length(F.translate(text, chars, "")) / size
    symbols, capitals = without(_SYMBOLS), without(_CAPITALS)
    distinct = F.size(F.array_distinct(words)) / n
    repeated = 1 - F.size(F.array_distinct(lines)) / n_lines
    closed = F.size(F.filter(lines, lambda x: F.btrim(x).rlike(r'[.!?:"]$'))) / n_lines
    length = (F.length(text) - n + 1) / n
    marked = F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,;:!?'\")\]-](?=\s|$)")) / n
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", "")) / F.greatest(F.length(text) - n + 1, F.lit(1))
    doubled = F.regexp_count(text, F.lit(r"(?<!\S)(\S+)\s+(?=\1(?!\S))")) / n
    parts = F.filter(F.split(text, r"[.!?\n]"), lambda x: F.length(x) > 2)
    again = 1 - F.size(F.array_distinct(parts)) / F.greatest(F.size(parts), F.lit(1))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, 0).when(good, 1).otherwise(-1)

    return {
        "symbols": vote(symbols > 0.04, symbols < 0.005),
        "marked": vote(marked > 0.1, marked < 0.02),
        "letters": vote(letters < 0.85, letters > 0.92),
        "capitals": vote(capitals > 0.15, capitals < 0.05),
        "distinct": vote((n >= 40) & (distinct < 0.45), (n >= 40) & (distinct > 0.6)),
        "doubled": vote(doubled > 0.05, doubled < 0.02),
        "again": vote(again > 0.2, (F.size(parts) >= 5) & (again < 0.05)),
        "lines": vote(repeated > 0.3, (n_lines >= 3) & (repeated < 0.05)),
        "closed": vote(closed < 0.5, closed > 0.95),
        "word_length": vote((length < 3.2) | (length > 8), (length > 4) & (length < 6.5)),
        "size": vote(n < 5, n >= 40),
    }


# The ways of being bad, by the labellers that know them.
FAMILIES = (
    ("symbols", "marked", "letters", "capitals"),
    ("distinct", "doubled", "again", "lines"),
    ("closed", "word_length", "size"),
)


@dataclass
class LabelModel:
    """Shares of good texts and of each way of being bad, and for each the chances of every vote."""

    shares: np.ndarray  # good first
    chances: np.ndarray  # (labellers, class, vote)

    def classes(self, votes: np.ndarray) -> np.ndarray:
        """The chance of each class for texts with these votes; without any opinion the shares."""
        seen = np.log(self.chances[np.arange(votes.shape[1])[None, :], :, np.maximum(votes, 0)])
        # Having no opinion is a matter of the text, not of its quality.
        odds = np.where(votes[:, :, None] >= 0, seen, 0).sum(axis=1) + np.log(self.shares)
        odds = np.exp(odds - odds.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The chance that texts with these votes are good."""
        return self.classes(votes)[:, 0]


def label_model(patterns: np.ndarray, counts: np.ndarray, names: list[str], rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over the patterns of votes, each counted: accuracies without any label.

    Labellers overlap: those of a family see the same faults. Votes are independent only given the
    class, so each family has a class of bad texts of its own, which keeps a text that one family
    calls bad from being outvoted by the others, who had nothing to look for.
    """
    n, k = patterns.shape[1], 1 + len(FAMILIES)
    chances = np.empty((n, k, 2))
    for i, name in enumerate(names):
        for c in range(k):
            bad = START_ACCURACY if c and name in FAMILIES[c - 1] else 0.05
            chances[i, c] = [bad, 1 - bad]
    model = LabelModel(np.array([0.7] + [0.3 / (k - 1)] * (k - 1)), chances)
    for _ in range(rounds):
        weight = model.classes(patterns) * counts[:, None]
        chances = np.empty_like(model.chances)
        for i in range(n):
            for vote in (0, 1):
                # One vote of each kind beforehand, so that no chance becomes zero.
                chances[i, :, vote] = weight[patterns[:, i] == vote].sum(axis=0) + 1
        chances /= chances.sum(axis=2, keepdims=True)
        shares = weight.sum(axis=0) + 1
        model = LabelModel(shares / shares.sum(), chances)
    return model


# Byte classes of a word's shape: capital, small or past ASCII, digit, the rest as it is.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:], _SHAPE[48:58] = 65, 97, 97, 57
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32]] = True


def hashed(texts: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, value) of the hashed features: words, and the shapes of all that spaces part.

    Values are 1 + log of the count, scaled to unit length for each text.
    """
    words = Words(texts)
    flat, offsets = flat_bytes(texts)
    shape = _SHAPE[flat]
    run = np.ones(len(shape), bool)
    run[1:] = (shape[1:] != shape[:-1]) | _BLANK[flat[1:]]
    run[offsets[:-1][offsets[:-1] < len(flat)]] = True
    short, at = shape[run], np.flatnonzero(run)
    inside = ~_BLANK[short]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    owner = np.searchsorted(offsets, at, side="right") - 1
    first = np.ones(len(at), bool)
    first[1:] = owner[1:] != owner[:-1]
    start = np.flatnonzero(inside & (~before | first))
    ends = np.flatnonzero(~inside | first)
    ends = np.append(ends, len(short))
    end = ends[np.searchsorted(ends, start, side="right")]
    shapes = span_hashes(short, start, end)
    text = np.concatenate([np.repeat(np.arange(len(texts)), words.counts), owner[start]])
    slot = np.concatenate([words.hash >> np.uint64(8), shapes >> np.uint64(9)]) % np.uint64(dimensions)
    key, count = np.unique(text.astype(np.int64) * dimensions + slot.astype(np.int64), return_counts=True)
    text, slot, value = key // dimensions, key % dimensions, 1 + np.log(count)
    # One feature more: the tenth in which the share of distinct features lies, as heavy as a frequent word.
    share = np.bincount(text, minlength=len(texts)) / np.maximum(np.bincount(text, count, len(texts)), 1)
    full = np.unique(text)
    tenth = BYTE[np.minimum(share[full] * 10, 9).astype(np.int64)] % np.uint64(dimensions)
    text, slot = np.concatenate([text, full]), np.concatenate([slot, tenth.astype(np.int64)])
    value = np.concatenate([value, np.sqrt(np.bincount(text[: len(value)], value**2, len(texts)))[full] / 2])
    order = np.argsort(text, kind="stable")
    text, slot, value = text[order], slot[order], value[order]
    norm = np.sqrt(np.bincount(text, value**2, len(texts)))
    return text, slot, value / norm[text]


def _bags(dimensions: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for low, high in slices(texts):
                text, slot, value = hashed(texts.slice(low, high - low), dimensions)
                cut = np.searchsorted(text, np.arange(high - low + 1))
                slots = [slot[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])]
                values = [value[a:b].astype(np.float32).tobytes() for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(slots, pa.binary()), pa.array(values, pa.binary())],
                    names=["good", "slots", "values"],
                )

    return run


def _gradient(batch: pa.RecordBatch, state: np.ndarray) -> np.ndarray:
    good = batch.column(0).to_numpy(zero_copy_only=False)
    slots = [np.frombuffer(x, np.int32) for x in batch.column(1).to_pylist()]
    row = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    slot = np.concatenate([*slots, np.zeros(0, np.int32)])
    value = np.concatenate([*(np.frombuffer(x, np.float32) for x in batch.column(2).to_pylist()), np.zeros(0, np.float32)])
    logit = np.bincount(row, state[slot] * value, len(slots)) + state[-1]
    off = good - 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
    out = np.bincount(slot, off[row] * value, len(state))
    out[-1] += off.sum()
    return out


def _scored(state_):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = np.frombuffer(state_.value, np.float64)
        for batch in batches:
            texts = texts_of(batch.column(1))
            out = []
            for low, high in slices(texts):
                text, slot, value = hashed(texts.slice(low, high - low), len(state) - 1)
                logit = np.bincount(text, state[slot] * value, high - low) + state[-1]
                out.append(1 / (1 + np.exp(-np.clip(logit, -500, 500))))
            score = np.concatenate([*out, np.zeros(0)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), batch.column(2)], names=["id", "score", "digest"])

    return run


def quality_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS
) -> DataFrame:
    """Per row: id, posterior (of the label model), score (of the linear scorer), kept (score >= 0.5).

    No given label is used. Votes of all rows are counted by pattern (at most 3 ** labellers come to
    the driver); expectation-maximisation finds each labeller's accuracy, and its posteriors are the
    soft labels of a logistic regression on hashed words and word shapes. That is fitted on about
    ``sample_rows`` rows at most, chosen by a hash of id and text of which repeated rows are one, so a
    group of copies has its share of them and no more; it scores all rows. Null, empty and wordless
    texts have posteriors and scores like any other; equal texts have equal ones.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    votes = labellers(F.col("text"))
    names = list(votes)
    digest = F.xxhash64("text", F.lit(5))
    voted = stored(source.select("id", digest.alias("digest"), *[v.cast("byte").alias(k) for k, v in votes.items()]), "votes")
    rows = voted.groupBy(*names).count().collect()
    patterns = np.array([[r[k] for k in names] for r in rows], np.int64).reshape(len(rows), len(names))
    counts = np.array([r["count"] for r in rows], np.float64)
    model = label_model(patterns, counts, names)
    fields = ", ".join(f"{k} byte" for k in names)
    table = [(*map(int, p), float(q)) for p, q in zip(patterns, model.posterior(patterns) if len(rows) else [])]
    posteriors = spark.createDataFrame(table, f"{fields}, posterior double")
    labelled = voted.join(F.broadcast(posteriors), names).select("id", "digest", "posterior")
    # Equal ids and texts have equal posteriors, so the pair is key enough.
    labelled = stored(labelled.dropDuplicates(["id", "digest"]), "posteriors")
    chosen = labelled.withColumnsRenamed({"id": "p_id", "digest": "p_digest"})
    same = F.col("id").eqNullSafe(F.col("p_id")) & (F.col("digest") == F.col("p_digest"))
    share = min(1.0, sample_rows / max(labelled.count(), 1))
    picked = F.xxhash64("id", "digest", F.lit(7)) <= F.lit(hash_limit(share))
    texts = source.withColumn("digest", digest)
    sample = texts.where(picked).dropDuplicates(["id", "digest"]).join(chosen, same).select("posterior", "text")
    bags = stored(sample.mapInArrow(_bags(dimensions), "good double, slots binary, values binary"), "bags")
    n = bags.count()
    state = np.zeros(dimensions + 1)
    if n:
        state = ascend(bags, _gradient, state, n, np.append(np.full(dimensions, PENALTY), 0), ROUNDS, RATE)
    held = spark.sparkContext.broadcast(state.tobytes())
    scored = texts.select("id", "text", "digest").mapInArrow(_scored(held), "id long, score double, digest long")
    return scored.join(chosen, same).select(
        F.col("id").alias(id_col), "posterior", "score", (F.col("score") >= 0.5).alias("kept")
    )
