"""Cross-tokenizer alignment: pointer jumping over overlapping tokens, and how often id pairs meet in the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import slices, stored, texts_of
from .tokens import byte_coder, tokenizer_path

BYTE_TOKENIZER = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json, as ranks
PIECE_TOKENIZER = "piece_bpe_32k.model"
BROADCAST_PAIRS = 1_000_000


class PieceCoder:
    """A sentencepiece model, with the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for i in range(self.coder.get_piece_size()):
            piece = self.coder.id_to_piece(i)
            self.pieces.append(bytes([int(piece[3:5], 16)]) if self.coder.is_byte(i) else piece.replace("▁", " ").encode())
        self.size = np.array([len(p) for p in self.pieces], np.int64)

    def encode(self, text: str) -> list[int]:
        return self.coder.encode(text, num_threads=1)

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join([self.pieces[i] for i in ids])


@lru_cache(maxsize=4)
def piece_coder(path: str) -> PieceCoder:
    return PieceCoder(path)


# ---- Two tilings of the same bytes -----------------------------------------------------------


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group of each A token, group of each B token, A and B token of each link) of two tilings of one range.

    Tokens are ordered by their end, of one end A before B. Each points to the last token that it
    overlaps, itself included; doubling the steps takes every token to the last of its component, the B
    token at whose end an A token ends too. Groups count from 0 in order.
    """
    n, m, size = len(a_end), len(b_end), int(a_end[-1]) if len(a_end) else 0
    ends = np.zeros((2, size + 1), np.int32)
    ends[0, a_end] = ends[1, b_end] = 1
    here = np.flatnonzero(ends[0] | ends[1])
    before = np.cumsum(ends, axis=1, dtype=np.int32)  # ends up to each byte
    # Of the other side, the token that holds the last byte of this one.
    by_a = before[1][a_end - 1]
    by_b = before[0][b_end - 1]
    own = n + np.arange(m)
    step = np.concatenate([n + by_a, np.where(a_end[by_b] > b_end, by_b, own)]) if n else np.zeros(0, np.int64)
    while True:
        further = step[step]
        if np.array_equal(further, step):
            break
        step = further
    group = np.cumsum(step[n:] == own) - 1
    return group[step[:n] - n], group[step[n:] - n], before[0][here - 1], before[1][here - 1]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to n - 1, left-aligned, and one byte more than they take."""
    width = len(str(n - 1)) + 1
    shown = np.zeros((n, width), np.uint8)
    text = np.char.mod("%d", np.arange(n)).astype(f"S{width}")
    shown[:] = text.view(np.uint8).reshape(n, width)
    return shown, np.char.str_len(text) + 1


@lru_cache(maxsize=2)
def digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _digits(n)


def group_texts(a_ids, b_ids, a_group, b_group) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3;`` over all groups, and at which byte each group ends."""
    n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
    a_count, b_count = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    a_until, b_until = np.cumsum(a_count), np.cumsum(b_count)
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    sign = np.full(len(ids), ord(","), np.uint8)
    ids[np.arange(len(a_ids)) + (b_until - b_count)[a_group]] = a_ids
    ids[np.arange(len(b_ids)) + a_until[b_group]] = b_ids
    last = a_until + b_until
    sign[last - 1] = ord(";")
    sign[last - b_count - 1] = ord("|")
    shown, size = digits(1 << 17)
    width = size[ids]
    cells = shown[ids]
    cells[np.arange(len(ids)), width - 1] = sign
    until = np.cumsum(width)
    return cells[np.arange(shown.shape[1]) < width[:, None]], until[last - 1]


# ---- Documents -------------------------------------------------------------------------------

SCHEMA = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"


def _aligned(a_path: str, b_path: str, names: list[str]):
    names = [*names, *[c.split()[0] for c in SCHEMA.split(", ")]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_coder, b_coder = byte_coder(a_path), piece_coder(b_path)
        for batch in batches:
            texts = texts_of(batch.column(batch.num_columns - 1))
            for low, high in slices(texts):
                rows, out = batch.slice(low, high - low), _slice(texts.slice(low, high - low).to_pylist(), a_coder, b_coder)
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *out], names=names)

    return run


def _slice(texts: list[str], a_coder, b_coder) -> list[pa.Array]:
    coded = []
    for text in texts:
        whole = f" {text}".encode()
        a = a_coder.coder.encode_ordinary(f" {text}") if text else []
        b = b_coder.encode(text) if text else []
        fits = a_coder.coder.decode_bytes(a) == whole and b_coder.bytes_of(b) == whole
        coded.append((a, b) if fits else ([], []))
    flat = lambda side: np.fromiter(chain.from_iterable(x[side] for x in coded), np.int64)
    n = np.array([[len(a), len(b)] for a, b in coded], np.int64)
    a_ids, b_ids = flat(0), flat(1)
    a_end, b_end = np.cumsum(a_coder.size[a_ids]), np.cumsum(b_coder.size[b_ids])
    a_group, b_group, a_at, b_at = terminals(a_end, b_end)

    # Every document's end is a cut, so groups and links fall to documents in order.
    last_a, last_b = np.cumsum(n[:, 0]), np.cumsum(n[:, 1])
    groups = np.concatenate([[0], (np.append(a_group, -1)[last_a - 1] + 1)])
    groups = np.maximum.accumulate(np.where(np.concatenate([[0], last_a]) > 0, groups, 0))
    text, until = group_texts(a_ids, b_ids, a_group, b_group)
    edges = np.concatenate([[0], until])[groups]
    data = text.tobytes()
    digest = [hashlib.sha256(data[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    width = len(b_coder.size)
    doc = np.searchsorted(last_a, a_at, side="right")
    link = np.sort((doc << 32) | (a_ids[a_at] * width + b_ids[b_at]))
    head = np.flatnonzero(np.concatenate([[True], link[1:] != link[:-1]])) if len(link) else np.zeros(0, np.int64)
    pair = link[head]
    offsets = pa.array(np.searchsorted(pair >> 32, np.arange(len(texts) + 1)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (pair & 0xFFFFFFFF, np.diff(np.append(head, len(link))))]
    n_links = np.bincount(doc, minlength=len(texts))
    return [pa.array(n[:, 0]), pa.array(n[:, 1]), pa.array(np.diff(groups)), pa.array(n_links), pa.array(digest), *lists]


def token_alignment(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_tokenizer: str | None = None,
    piece_tokenizer: str | None = None,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A space and the text are encoded whole by a byte-level BPE (A) and a sentencepiece BPE (B) without
    special tokens. Bytes at which a token of either side ends cut both into groups; an A and a B token
    that share a byte are a link. A pair of ids counts the rows that hold it linked; ``n_best`` counts
    links whose pair is the most frequent of its A id, ties included, ``count_sum`` adds the counts of
    all links. ``groups_sha256`` digests ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and texts that
    either side's tokens do not spell byte by byte, have no tokens: zeros and ''. Repeated rows and ids
    count apiece. Other columns are left behind; a document is one task's work, about 40 bytes of
    memory for each of its own.

    Each text is encoded once. Its distinct pairs are stored beside it, counted over the corpus, and
    scored against the counts: the most frequent pairs, ``broadcast_pairs`` at most, by broadcast, the
    rare ones, which no key of holds many rows, by a shuffle.
    """
    a_path = byte_tokenizer or tokenizer_path(BYTE_TOKENIZER)
    b_path = piece_tokenizer or tokenizer_path(PIECE_TOKENIZER)
    source = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, row long, {SCHEMA}"
    found = stored(source.mapInArrow(_aligned(a_path, b_path, ["id", "row"]), schema), "alignment")

    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", "l.pairs", "l.times")
    width = F.lit(len(piece_coder(b_path).size))
    counts = links.groupBy("pairs").agg(F.count("*").alias("docs"))
    best = F.max("docs").over(Window.partitionBy(F.floor(F.col("pairs") / width)))
    counts = stored(counts.withColumn("best", F.col("docs") == best), "pair-counts")

    scored = lambda part: part.groupBy("row").agg(
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    )
    least = _least_broadcast(counts, broadcast_pairs)
    frequent = F.broadcast(counts.where(F.col("docs") >= least))
    scores = scored(links.join(frequent, "pairs"))
    if least > 1:
        rare = links.join(F.broadcast(counts.where(F.col("docs") >= least).select("pairs")), "pairs", "left_anti")
        rest = scored(rare.join(counts.where(F.col("docs") < least).hint("merge"), "pairs"))
        scores = scores.union(rest).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return found.join(scores, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", *sums, "groups_sha256"
    )


def _least_broadcast(counts: DataFrame, most: int) -> int:
    """The power of two from which on the pairs of so many documents are ``most`` at most; 1: all pairs."""
    steps = counts.groupBy(F.floor(F.log2("docs")).alias("step")).agg(F.count("*").alias("n")).collect()
    total = 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        if total + r["n"] > most:
            return 2 ** (r["step"] + 1)
        total += r["n"]
    return 1
