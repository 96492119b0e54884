"""Helpers shared by the operators: stored steps, word streams of Arrow texts, groups of sorted rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from siltstone.session import scratch_path

SLICE_BYTES = 2 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_limit(share: float) -> int:
    """The 64-bit hash up to which ``share`` of all keys lie, however small the share is."""
    return min(-(2**63) + int(share * 2**64), 2**63 - 1)


# ---- Texts of an Arrow batch ----------------------------------------------------------------


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one array of strings; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, so that work arrays stay small whatever the batch."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    low, n = 0, len(texts)
    while low < n:
        base = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield low, high
        low = high


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each text begins (one more at the end)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Word bytes: digits, letters and every byte of a character past ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_WORD_ANY = _WORD.copy()
_WORD_ANY[65:91] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """The words of a slice of texts: runs of digits, letters (A-Z lower-cased) and non-ASCII characters.

    ``start``, ``end``: places in ``flat``; ``hash``: 64 bits of each word; ``first``: index of each
    text's first word, with one more at the end.
    """

    def __init__(self, texts: pa.Array):
        self.flat, self.offsets = flat_bytes(texts)
        inside = _WORD_ANY[self.flat]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        cut = self.offsets[:-1]
        cut = cut[cut < len(inside)]
        before[cut] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[cut[cut > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self._hash = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = span_hashes(LOWER[self.flat], self.start, self.end)
        return self._hash

    def text(self, index: int) -> bytes:
        return LOWER[self.flat[self.start[index] : self.end[index]]].tobytes()


def span_hashes(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans follow each other without overlap."""
    out = np.empty(len(start), np.uint64)
    done = 0
    while done < len(start):
        stop = max(done + 1, int(np.searchsorted(end, start[done] + (1 << 19))))
        s, e = start[done:stop], end[done:stop]
        size = e - s
        head = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(head, size)
        value = BYTE[flat[np.repeat(s, size) + place]] * powers(_ODD, int(size.max()))[place]
        out[done:stop] = mixed(np.add.reduceat(value, head) + size.astype(np.uint64) * _STEP)
        done = stop
    return out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on; the caller drops places where a text ends earlier."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    step = powers(_ODD, k)
    for i in range(k):
        out += words[i : i + n] * step[i]
    return mixed(out + powers(_STEP, k + 1)[k])


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All k-word shingles of each text, repeats included, and where each text's begin.

    A text of fewer words, but not none, has one shingle of all its words.
    """
    counts = words.counts
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(first[-1], np.uint64)
    text = np.repeat(np.arange(len(n)), n)
    place = words.first[text] + np.arange(first[-1]) - first[text]
    whole = counts[text] >= k
    grams = gram_hashes(words.hash, k)
    out[whole] = grams[place[whole]]
    for t in np.flatnonzero((counts > 0) & (counts < k)):
        out[first[t]] = gram_hashes(words.hash[words.first[t] : words.first[t + 1]], int(counts[t]))[0]
    return out, first


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


# ---- Groups of rows -------------------------------------------------------------------------


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, from batches that are sorted by them."""
    pending: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        heads = np.concatenate([[0], np.flatnonzero(change), [batch.num_rows]])
        for low, high in zip(heads[:-1], heads[1:]):
            key = tuple(c[low] for c in columns)
            if key != last and pending:
                yield pa.Table.from_batches(pending)
                pending = []
            last = key
            pending.append(batch.slice(low, high - low))
    if pending:
        yield pa.Table.from_batches(pending)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of the links between n items, as few as connect the same items."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
            if len(kept) == n - 1:
                break
    return kept
