"""Public tokenizers inside tasks, loaded once per worker."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .common import LOWER, flat_bytes, span_hashes

CACHED = 600_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Bytes by how a text may be cut: between a space and anything, and between an ASCII letter or digit
# and plain ASCII punctuation. Next to any other byte (apostrophes, which begin contractions, the
# brackets of special tokens, control characters, all past ASCII) nothing is cut but at spaces.
_SPACE, _ALNUM, _PUNCT, _GLUE = range(4)
_KIND = np.full(256, _GLUE, np.uint8)
_KIND[[10, 32]] = _SPACE
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _ALNUM
_KIND[[ord(c) for c in '!"#$%&()*+,-./:;=?@[]\\^_`{}~']] = _PUNCT


class WordCoder:
    """Ids of a lower-casing tokenizer that cuts texts into words before it merges anything.

    Its ids of a text are those of the text's parts in a row, if the text is cut only where the
    tokenizer itself always cuts. So each slice of texts is cut with array operations, only its
    distinct parts are looked up, and only parts not met before go to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.tokens, self.used = np.empty(1 << 16, np.uint32), 0
        self.begin, self.size = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)

    def _learn(self, key: int, part: str) -> int:
        if part.isascii() and part.isalpha():
            ids = [t.id for t in self.coder.model.tokenize(part)]  # one word, already in lower case
        else:
            ids = self.coder.encode(part, add_special_tokens=False).ids
        index = len(self.known)
        if index == len(self.begin):
            self.begin, self.size = (np.concatenate([x, np.empty_like(x)]) for x in (self.begin, self.size))
        while self.used + len(ids) > len(self.tokens):
            self.tokens = np.concatenate([self.tokens, np.empty_like(self.tokens)])
        self.tokens[self.used : self.used + len(ids)] = ids
        self.begin[index], self.size[index] = self.used, len(ids)
        self.used += len(ids)
        self.known[key] = index
        return index

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one more at the end)."""
        flat, offsets = flat_bytes(texts)
        if len(self.known) > CACHED:
            self._forget()
        kind = _KIND[flat]
        before = np.zeros(len(flat), np.uint8)
        before[1:] = kind[:-1]
        before[offsets[:-1][offsets[:-1] < len(flat)]] = _SPACE
        cut = (before == _SPACE) | ((before == _ALNUM) & (kind == _PUNCT)) | ((before == _PUNCT) & (kind == _ALNUM))
        head = (kind != _SPACE) & cut
        start = np.flatnonzero(head)
        stops = np.flatnonzero(cut | (kind == _SPACE))
        stops = np.append(stops, len(flat))
        end = stops[np.searchsorted(stops, start, side="right")]
        wide = np.add.reduceat(flat >= 128, start) > 0 if len(start) else np.zeros(0, bool)
        plain = LOWER[flat]
        for i in np.flatnonzero(wide):
            plain[start[i] : end[i]] = flat[start[i] : end[i]]
        keys, where, part = np.unique(span_hashes(plain, start, end), return_index=True, return_inverse=True)
        index = np.fromiter((self.known.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        for i in np.flatnonzero(index < 0):
            a, b = start[where[i]], end[where[i]]
            index[i] = self._learn(int(keys[i]), plain[a:b].tobytes().decode())
        chosen = index[part]
        size = self.size[chosen]
        first = np.concatenate([[0], np.cumsum(size)])
        ids = self.tokens[np.repeat(self.begin[chosen] - first[:-1], size) + np.arange(first[-1])]
        return ids, first[np.searchsorted(start, offsets)]


@lru_cache(maxsize=4)
def word_coder(path: str) -> WordCoder:
    return WordCoder(path)


class ByteCoder:
    """A byte-level tokenizer, with the number of bytes of each id."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, rank in ranks.items():
            self.size[rank] = len(piece)

    def ends(self, text: str) -> np.ndarray:
        """The byte at which each token of the text ends."""
        return np.cumsum(self.size[np.array(self.coder.encode_ordinary(text), np.int64)])


@lru_cache(maxsize=4)
def byte_coder(path: str) -> ByteCoder:
    return ByteCoder(path)
