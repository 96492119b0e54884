"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, from document labels."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ascent import ascend
from .common import BYTE, LOWER, Words, hash_limit, signed, slices, span_hashes, stored, texts_of

PREFIXES = (4, 6, 8)
SAMPLE_ROWS = 60_000
FEATURES = 32_768
LEAST_DOCS = 5
LEAST_Z = 3.0
ROUNDS = 60
RATE = 0.3
PENALTY = 1e-3
START = -6.0
OFFENDING = 0.1

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".!?\n"]] = True


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of the distinct words: (distinct word, hash) pairs, and the distinct word of each word.

    A word counts whole, and by its first bytes if it is longer.
    """
    known, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
    start = words.start[first]
    size = words.end[first] - start
    word, out = [np.arange(len(known))], [known]
    lower = LOWER[words.flat]
    order = np.argsort(start)
    for n in PREFIXES:
        long = order[size[order] > n]
        word.append(long)
        out.append(span_hashes(lower, start[long], start[long] + n) ^ BYTE[n])
    return np.concatenate(word), np.concatenate(out), which


def found(words: Words, keys: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (group of the word, place in ``keys``) of all features that ``keys`` holds, in order."""
    word, out, which = features(words)
    at = np.minimum(np.searchsorted(keys, out), len(keys) - 1)
    hit = keys[at] == out
    word, at = word[hit], at[hit]
    order = np.argsort(word, kind="stable")
    word, at = word[order], at[order]
    first = np.searchsorted(word, np.arange(int(which.max(initial=-1)) + 2))
    size = np.diff(first)
    seen = np.flatnonzero(size[which] > 0) if len(which) else np.zeros(0, np.int64)
    times = size[which[seen]]
    place = np.repeat(first[which[seen]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    pairs = np.unique(np.repeat(group[seen], times) * len(keys) + at[place])
    return pairs // max(len(keys), 1), pairs % max(len(keys), 1)


def sentences(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The sentence of each word, numbered over all texts, and the text of each sentence.

    Sentences end at . ! ? or a line feed; those without words don't count.
    """
    breaks = np.cumsum(_BREAK[words.flat])
    at = breaks[words.start] if len(words.start) else np.zeros(0, np.int64)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    new[words.first[:-1][words.counts > 0]] = True
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    return np.cumsum(new) - 1, text[new]


@dataclass
class Model:
    """Feature hashes in ascending order, their weights, and the weight of a sentence as such."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def sentence_logits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit of each sentence, the text of each, and the sentence of each word."""
        sentence, text = sentences(words)
        logits = np.full(len(text), self.bias)
        if len(self.keys):
            # A feature counts once in a sentence.
            where, key = found(words, self.keys, sentence)
            np.add.at(logits, where, self.weights[key])
        return logits, text, sentence

    def scores(self, words: Words) -> np.ndarray:
        logits, text, _ = self.sentence_logits(words)
        return -np.expm1(-np.bincount(text, np.logaddexp(0, logits), len(words.counts)))


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, and toxic ones, summed up for each slice of texts."""
    for batch in batches:
        texts = texts_of(batch.column(1))
        toxic = batch.column(0).to_numpy(zero_copy_only=False)
        for low, high in slices(texts, 4 << 20):
            words = Words(texts.slice(low, high - low))
            word, out, which = features(words)
            text = np.repeat(np.arange(high - low), words.counts)
            every, distinct = np.unique(out, return_inverse=True)
            # Documents with a distinct word first, then those with each of its features.
            pairs = np.unique(which * (high - low) + text)
            owner, text = pairs // (high - low), pairs % (high - low)
            order = np.argsort(word, kind="stable")
            first = np.searchsorted(word[order], np.arange(int(which.max(initial=-1)) + 2))
            times = np.diff(first)[owner]
            place = np.repeat(first[owner] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            pairs = np.unique(distinct[order][place] * (high - low) + np.repeat(text, times))
            place, text = pairs // (high - low), pairs % (high - low)
            known = every
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(known)), pa.array(np.bincount(place, minlength=len(known)).astype(np.int64)),
                    pa.array(np.bincount(place, toxic[low:high][text], len(known)).astype(np.int64)),
                ],
                names=["key", "docs", "toxic"],
            )


def _bags(keys_):
    """Per document: label, number of sentences, and the chosen features by sentence."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.frombuffer(keys_.value, np.uint64)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for low, high in slices(texts):
                words = Words(texts.slice(low, high - low))
                sentence, text = sentences(words)
                where, key = found(words, keys, sentence)
                of = text[where]
                cut = np.searchsorted(of, np.arange(high - low + 1))
                bags = []
                for a, b in zip(cut, cut[1:]):
                    # Sentences without a chosen feature are all alike; the others are numbered anew.
                    marked = np.cumsum(np.diff(where[a:b], prepend=where[a] if b > a else 0) > 0)
                    bags.append(np.stack([marked, key[a:b]]).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low).cast(pa.int32()),
                        pa.array(np.bincount(text, minlength=high - low).astype(np.int32)), pa.array(bags, pa.binary()),
                    ],
                    names=["toxic", "sentences", "bag"],
                )

    return run


def gradient(toxic: np.ndarray, n_sentences: np.ndarray, bags: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    """Gradient of the log-likelihood by the weights, then by the bias.

    A text is clean if all its sentences are: log P(clean) = -sum of softplus(logit).
    """
    size = np.array([b.shape[1] for b in bags])
    doc = np.repeat(np.arange(len(bags)), size)
    every = np.concatenate(bags, axis=1) if bags else np.zeros((2, 0), np.int32)
    # Sentences with chosen features, numbered over the documents; the others all have the bias.
    marked = np.array([b[0, -1] + 1 if b.shape[1] else 0 for b in bags], np.int64)
    first = np.cumsum(marked) - marked
    place = first[doc] + every[0]
    owner = np.repeat(np.arange(len(bags)), marked)
    logits = bias + np.bincount(place, weights[every[1]], len(owner))
    plain = n_sentences - marked
    clean = np.bincount(owner, np.logaddexp(0, logits), len(bags)) + plain * np.logaddexp(0, bias)
    clean = np.maximum(clean, 1e-12)  # -log P(clean)
    pull = np.where(toxic == 1, np.exp(-clean) / -np.expm1(-clean), -1.0)
    step = pull[owner] / (1 + np.exp(-logits))
    out = np.zeros(len(weights) + 1)
    out[:-1] = np.bincount(every[1], step[place], len(weights))
    out[-1] = step.sum() + (pull * plain).sum() / (1 + np.exp(-bias))
    return out


def _gradient(batch: pa.RecordBatch, state: np.ndarray) -> np.ndarray:
    bags = [np.frombuffer(b, np.int32).reshape(2, -1) for b in batch.column(2).to_pylist()]
    toxic, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    return gradient(toxic, n, bags, state[:-1], state[-1])


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(toxic, text) of labelled documents outside the held-out quarter: crc32 of the id mod 4 is not 2.

    About ``sample_rows`` labels at most, chosen by a hash of the id, and of repeated ids one. That many
    rows are small, so they go to the texts. Of the documents of one id one is learned from, that of the
    smallest hash, so an id on any number of rows counts once.
    """
    fold = F.pmod(F.crc32(F.col("label_id").cast("string").cast("binary")), F.lit(4))
    known = labels.select(F.col(id_col).cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("label_id is not null and toxic in (0, 1)").where(fold != 2)
    share = min(1.0, sample_rows / max(known.count(), 1))
    chosen = known.where(F.xxhash64("label_id") <= F.lit(hash_limit(share)))
    chosen = stored(chosen.groupBy("label_id").agg(F.max("toxic").alias("toxic")), "labels")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    met = source.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).where("text is not null")
    one = met.groupBy("label_id").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("toxic", "text")


def fit(labelled: DataFrame, rounds: int = ROUNDS) -> Model:
    """A model from the ``training_rows`` (toxic 0 or 1, text).

    Features are kept for their z-score against the share of toxic documents, at most ``FEATURES`` of
    them. Each round of the ascent is a Spark job over the stored bags; a gradient is ``FEATURES``
    numbers per task, whatever the input. Without both labels nothing is toxic.
    """
    spark = labelled.sparkSession
    rows = stored(labelled.select("toxic", "text"), "labelled")
    n, positive = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not positive or positive == n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    rate = positive / n
    counts = rows.mapInArrow(_counts, "key long, docs long, toxic long").groupBy("key").agg(
        F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic")
    )
    z = (F.col("toxic") - F.col("docs") * rate) / F.sqrt(F.col("docs") * (rate * (1 - rate)))
    chosen = counts.where(F.col("docs") >= LEAST_DOCS).withColumn("z", F.abs(z)).where(F.col("z") >= LEAST_Z)
    keys = [r["key"] for r in chosen.orderBy(F.desc("z"), "key").limit(FEATURES).collect()]
    keys = np.unique(np.array(keys, np.int64).view(np.uint64))
    if not len(keys):
        return Model(keys, np.zeros(0), -30.0)
    bags = stored(rows.mapInArrow(_bags(spark.sparkContext.broadcast(keys.tobytes())), "toxic int, sentences int, bag binary"), "bags")
    start = np.append(np.zeros(len(keys)), START)
    penalty = np.append(np.full(len(keys), PENALTY * rate), 0)
    state = ascend(bags, _gradient, start, n, penalty, rounds, RATE)
    return Model(keys, state[:-1], float(state[-1]))


def _scored(model_):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = model_.value
        for batch in batches:
            texts = texts_of(batch.column(1))
            for low, high in slices(texts):
                words = Words(texts.slice(low, high - low))
                logits, text, sentence = model.sentence_logits(words)
                scores = -np.expm1(-np.bincount(text, np.logaddexp(0, logits), high - low))
                p = 1 / (1 + np.exp(-logits))
                spans: list[list[dict]] = [[] for _ in range(high - low)]
                hot = np.flatnonzero(p >= OFFENDING)
                if len(hot):
                    begin = words.start[np.searchsorted(sentence, hot)]
                    end = words.end[np.searchsorted(sentence, hot, side="right") - 1]
                    chars = np.concatenate([[0], np.cumsum((words.flat & 0xC0) != 0x80)])
                    base = chars[words.offsets[text[hot]]]
                    for t, s, e, q in zip(text[hot].tolist(), (chars[begin] - base).tolist(), (chars[end] - base).tolist(), p[hot].tolist()):
                        spans[t].append({"start": s, "end": e, "score": q})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(scores), pa.array(spans, kind)], names=["id", "score", "sentences"]
                )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score and the offending sentences (start, end, score), places in code points."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    found = source.mapInArrow(_scored(held), "id long, score double, sentences array<struct<start:long,end:long,score:double>>")
    return found.withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score (0 to 1) and the offending sentences.

    A document's score is the noisy-or of its sentences' scores, and only documents are labelled: the
    model finds out which sentences the label comes from. Ids choose the training rows and nothing
    else; languages and sources are not read. Null, empty and wordless texts score 0. Rows with a null
    id are scored and not held out; of repeated labels of an id one counts.
    """
    model = fit(training_rows(docs, labels, id_col, text_col))
    out = score(docs, model, id_col, text_col)
    fold = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2
    return out.select(id_col, F.coalesce(fold, F.lit(False)).alias("held_out"), "score", "sentences")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns kept."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(batch.schema.get_field_index(text_col)))
            for low, high in slices(texts):
                scores = held.value.scores(Words(texts.slice(low, high - low)))
                yield batch.slice(low, high - low).filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
