"""Token counts: whole documents encoded once, tokens attributed to sections by their offsets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_bytes, slices, texts_of
from .tokens import byte_coder, tokenizer_path

TOKENIZER = "byte_bpe_50k.tiktoken"


def attributed(token_ends: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of those also reach into another section.

    Both arrays are byte places and tile the same text. Rule: a token counts for the section that holds
    most of its bytes, of equal ones for the first.
    """
    token_starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(section_ends, token_starts, side="right")
    last = np.searchsorted(section_ends, token_ends - 1, side="right")
    owner = first.copy()
    crossing = np.flatnonzero(first < last)
    for t in crossing:
        reach = np.arange(first[t], last[t] + 1)
        low = np.maximum(np.concatenate([[0], section_ends])[reach], token_starts[t])
        owner[t] = reach[np.argmax(np.minimum(section_ends[reach], token_ends[t]) - low)]
    n = len(section_ends)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def _counted(path: str, fields: list[str]):
    names = ["id", "field", "section", "start", "end", "n_tokens", "n_crossing"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_coder(path)
        for batch in batches:
            parts = [texts_of(batch.column(1 + f)) for f in range(len(fields))]
            for low, high in slices(parts[-1]):
                rows: list[list[np.ndarray]] = [[] for _ in range(7)]
                columns = [p.slice(low, high - low).to_pylist() for p in parts]
                for i, values in enumerate(zip(*columns)):
                    whole = "\n".join(values)
                    flat, _ = flat_bytes(texts_of(pa.array([whole])))
                    if not len(flat):
                        continue
                    ends = np.flatnonzero(flat == 10) + 1
                    if not len(ends) or ends[-1] != len(flat):
                        ends = np.append(ends, len(flat))
                    # The line feed that joins two fields ends the first one's last section.
                    until = np.cumsum([len(v.encode()) + 1 for v in values])
                    field = np.searchsorted(until, ends - 1, side="right")
                    n_tokens, n_crossing = attributed(coder.ends(whole), ends)
                    chars = np.cumsum((flat & 0xC0) != 0x80)
                    stop = chars[ends - 1]
                    begin = np.concatenate([[0], stop[:-1]])
                    opens = np.concatenate([[True], field[1:] != field[:-1]])
                    place = np.arange(len(ends))
                    section = place - np.maximum.accumulate(np.where(opens, place, 0))
                    for column, value in zip(rows, (np.full(len(ends), low + i), field, section, begin, stop, n_tokens, n_crossing)):
                        column.append(value)
                if not rows[0]:
                    continue
                row, field, *rest = [np.concatenate(c).astype(np.int64) for c in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(fields).take(pa.array(field)), *map(pa.array, rest)], names=names
                )

    return run


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", fields: tuple[str, ...] = ("text",), tokenizer: str | None = None
) -> DataFrame:
    """Per section: id, field, section (from 0 in its field), start, end, n_tokens, n_crossing.

    A document is its fields, joined by line feeds; a section is a line of a field, its line feed
    included. The document is encoded once, so tokens may reach over a section's end: such a token
    counts for the section that holds most of its bytes, of equal ones for the first, and
    ``n_crossing`` says how many of a section's tokens are of that kind. Sections tile the document:
    their tokens add up to the document's. Places are code points of the document, ends exclusive.
    A null field is an empty one; a document without a character gives no rows.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    source = docs.select(F.col(id_col).cast("long").alias("id"), *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)])
    schema = "id long, field string, section long, start long, end long, n_tokens long, n_crossing long"
    return source.mapInArrow(_counted(path, list(fields)), schema).withColumnRenamed("id", id_col)
