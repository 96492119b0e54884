"""Cross-tokenizer alignment against a plain walk over both tokenizers' own libraries."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from siltstone.llm.alignment import BYTE_TOKENIZER, PIECE_TOKENIZER, piece_coder, terminals, token_alignment
from siltstone.llm.tokens import byte_coder, tokenizer_path

DOCS = "doc_id long, text string, id long, row int, pairs int, docs string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 7, 1, 2, "x") for i, t in rows], DOCS).repartition(3)


def documents():
    rng = np.random.default_rng(4)
    words = ["the", "of", "tokenization", "straße", "日本語テキスト", "🙂🙃", "naïve", "x1y2z3", "<|endoftext|>", "<s>", "</s>", "don't", "éééé"]
    rows = [(None, None), (1, ""), (2, " "), (3, "\n\n  a\tb\r\n"), (4, "▁ lost"), (5, "a▁"), (6, "\x00\x01"), (7, "  two  spaces   "), (8, "a" * 3000)]
    rows += [(9, "copy of this"), (9, "copy of this"), (10, "copy of this"), (None, "copy of this"), (11, "‍﻿́e"), (12, "日" * 4000)]
    rows += [(100 + i, " ".join(rng.choice(words, int(rng.integers(1, 200))))) for i in range(60)]
    rows += [(900, " ".join(rng.choice(words, 30_000)))]
    return rows


def a_bytes():
    """The tokenizers library's entries, byte-level decoded."""
    from tokenizers import Tokenizer

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    coder = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    return coder, {i: bytes(byte[c] for c in t) for t, i in coder.get_vocab().items() if t != "<|endoftext|>"}


def brute(texts):
    coder, a_piece = a_bytes()
    b_coder = piece_coder(tokenizer_path(PIECE_TOKENIZER))
    out, pairs = [], []
    for text in texts:
        whole = f" {text}".encode()
        a = coder.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_coder.coder.encode(text) if text else []
        if b"".join(a_piece[i] for i in a) != whole or b_coder.bytes_of(b) != whole:
            a, b = [], []
        a_until, b_until, links, groups, i, j = 0, 0, [], [], 0, 0
        group = ([], [])
        a_end, b_end = np.cumsum([len(a_piece[x]) for x in a]), np.cumsum([len(b_coder.pieces[x]) for x in b])
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            a_until, b_until = a_end[i], b_end[j]
            if a_until <= b_until:
                group[0].append(a[i])
                i += 1
            if b_until <= a_until:
                group[1].append(b[j])
                j += 1
            if a_until == b_until:
                groups.append("|".join(",".join(map(str, side)) for side in group))
                group = ([], [])
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append([len(a), len(b), len(groups), len(links), digest])
        pairs.append(links)
    count = Counter(p for links in pairs for p in set(links))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    return [tuple(row[:4]) + (sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), row[4]) for row, links in zip(out, pairs)]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("most", [1_000_000, 40, 0])
def test_alignment_is_that_of_a_plain_walk_whatever_is_broadcast(spark, most):
    rows = documents()
    got = Counter((r["doc_id"], *[r[n] for n in NAMES]) for r in token_alignment(table(spark, rows), broadcast_pairs=most).collect())
    assert got == Counter((i, *row) for (i, _), row in zip(rows, brute([t or "" for _, t in rows])))


def test_texts_without_tokens_and_an_empty_table(spark):
    assert token_alignment(table(spark, [])).collect() == []
    for r in token_alignment(table(spark, [(1, None), (2, ""), (3, "a▁b")])).collect():
        assert [r[n] for n in NAMES] == [0, 0, 0, 0, 0, 0, ""]


def test_both_byte_level_libraries_give_the_same_ids():
    coder, _ = a_bytes()
    own = byte_coder(tokenizer_path(BYTE_TOKENIZER)).coder
    for text in [t or "" for _, t in documents()]:
        assert coder.encode(f" {text}", add_special_tokens=False).ids == own.encode_ordinary(f" {text}")


def test_pointers_reach_the_end_of_long_components():
    n = 5000
    a_end, b_end = np.arange(1, n + 1) * 2, np.append(np.arange(n) * 2 + 1, 2 * n)
    a, b, at_a, at_b = terminals(a_end, b_end)
    assert set(a) == set(b) == {0} and len(at_a) == len(at_b) == 2 * n
