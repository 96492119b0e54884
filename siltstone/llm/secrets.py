"""Secret scans: fixed patterns, and the guess cost of values in a credential context."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, texts_of

KINDS = ("assign", "access", "hex", "guess")
GUESSES = 10.0

# The patterns of the base spans.
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

# A value in a credential context: a name, a sign between, and the value up to a space or quote.
_CONTEXT = re.compile(
    r"""(?ai:(?<![a-z0-9])(?:password|passwd|passphrase|pass|pwd|secret|token|api[_-]?key|credentials?|bearer|login|auth))"""
    r"""["']?(?:\x20*(?::=|=>|[:=])\x20*|\x20+(?ai:(is|was))\x20+|(?ai:(?<=bearer))\x20+)["']?([^\s"'<>,;]{6,})"""
)
# The same contexts for Spark's own expressions: their values are no words of the corpus.
_NO_WORDS = (
    r"""(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|credentials?|bearer|login|auth)["']?"""
    r"""(?:\x20*[:=]+>?\x20*|\x20+(?:is|was)\x20+|(?<=bearer)\x20+)["']?[^\s"'<>,;]+"""
)
# A word of the corpus: letters that stand by themselves, so that pieces of codes are none.
_WORD = r"""(?<![^\s("'])(\p{L}{3,24}+)(?=[\s.,;:!?)"']|$)"""
VOCABULARY = 1 << 15
LEAST_DOCUMENTS = 2
_ADDRESS = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*://|[~.]{0,2}/)")
_CONTEXT_NAMES = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "login", "auth")

# Words that people put into passwords, commonest first; a word's rank is its guess cost.
_WORDS = """password qwerty admin welcome letmein monkey dragon master login hello secret test user pass root love
shadow sunshine princess football baseball superman batman access flower summer winter spring autumn default guest
changeme example public private server system service database token key api access client account email home work
the and you not for are this that with none null true false your name value string required unknown hidden""".split()
_RANK = {w: math.log10(i + 2) for i, w in reversed(list(enumerate(_WORDS)))}
_LONGEST = 24
_LEET = str.maketrans("4@831!0$57", "aabeiiosst")
# Rows of a keyboard.
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_BESIDE = {a + b for row in (*_ROWS, "abcdefghijklmnopqrstuvwxyz", "0123456789") for a, b in zip(row, row[1:])}
_BESIDE |= {p[::-1] for p in _BESIDE}
_DATES = [
    re.compile(r"(?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])", re.A),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\1(?:19|20)\d\d", re.A),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\1\d\d", re.A),
    re.compile(r"(?:19|20)\d\d", re.A),
]
_UNIT = 8


def _alphabet(value: str) -> float:
    """log10 of the characters a guesser has to try at a place."""
    size = 0
    for held, n in ((r"[a-z]", 26), (r"[A-Z]", 26), (r"[0-9]", 10), (r"[!-/:-@\[-`{-~]", 33), (r"[^\x00-\x7f]", 100)):
        size += n * bool(re.search(held, value))
    return math.log10(max(size, 10))


def guess_cost(value: str, ranks: dict[str, float] = _RANK) -> float:
    """log10 of the guesses that find ``value``, by its cheapest segmentation.

    Segments are words of ``ranks`` (upper case and look-alike characters cost extra), dates, repeats, walks along a
    keyboard row, the alphabet or the digits, and single characters at brute force. Words and
    dates count from every start, walks whole or as a head or tail, repeats as long as they go from every
    start or as a head. Each further segment doubles the guesses. Dynamic programming over the places, in time linear in the value's length.
    """
    n = len(value)
    lower = value.lower() if len(value.lower()) == n else value
    plain = lower.translate(_LEET)
    brute = _alphabet(value)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # by end: (start, cost)

    for i in range(n):
        for j in range(i + 3, min(n, i + _LONGEST) + 1):
            for form, extra in ((lower[i:j], 0.0), (plain[i:j], 0.6)):
                if form in ranks:
                    upper = sum(c.isupper() for c in value[i:j])
                    case = 0.0 if not upper else 0.3 if upper == j - i or value[i].isupper() and upper == 1 else 0.3 * (j - i)
                    ends[j].append((i, ranks[form] + extra + case))
                    break
    for i in range(n):
        for m in [d.match(value, i) for d in _DATES] if value[i] in "0123" else []:
            if m:
                ends[m.end()].append((i, 4.6 if m.end() - i > 4 else 2.1))
    start = 0
    for i in range(1, n + 1):  # walks: the whole of each, and all its heads and tails of three up
        if i == n or lower[i - 1 : i + 1] not in _BESIDE:
            for j in range(start + 3, i + 1):
                ends[j].append((start, 1.7 + math.log10(j - start)))
            for j in range(start + 1, i - 2):
                ends[i].append((j, 1.7 + math.log10(i - j)))
            start = i
    for unit in range(1, min(_UNIT, n // 2) + 1):  # repeats: the longest from each start, and all heads of a whole one
        same = 0
        for i in range(n - unit - 1, -1, -1):
            same = same + 1 if value[i] == value[i + unit] else 0
            most = same // unit + 1
            whole = not i or value[i - 1] != value[i - 1 + unit]
            for times in range(2 if whole else max(most, 2), most + 1):
                if times * unit >= 3:
                    ends[i + times * unit].append((i, brute * unit + math.log10(times)))

    # best[j]: cost of the first j characters; a run of brute force pays for one segment.
    double = math.log10(2)
    other, forced = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    for j in range(1, n + 1):
        forced[j] = min(forced[j - 1], other[j - 1] + (double if j > 1 else 0.0)) + brute
        for i, cost in ends[j]:
            other[j] = min(other[j], min(other[i], forced[i]) + cost + (double if i else 0.0))
    return min(other[n], forced[n])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and without overlap per kind."""
    found = []
    folded = text.lower()
    if any(name in folded for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def word_ranks(docs: DataFrame, text_col: str = "text", words: int = VOCABULARY) -> dict[str, float]:
    """log10 of each word's rank: the fixed words, and the corpus's own by the documents that hold them.

    All documents are counted. Of the words that ``LEAST_DOCUMENTS`` hold at least the commonest are gathered,
    by whole steps of their counts (eight to a doubling) and ``words`` at most, under 1 MB whatever the
    corpus; a step that would go past that is left out whole, with all below it. Values in a credential context don't count, so a secret that many
    copies repeat does not become a word by that.
    """
    text = F.regexp_replace(F.col(text_col).cast("string"), _NO_WORDS, " ")
    found = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(1)))).alias("word"))
    counted = found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_DOCUMENTS)
    counted = stored(counted.withColumn("step", F.floor(8 * F.log2("n"))), "words")
    steps = counted.groupBy("step").count().collect()
    lowest, held = None, 0
    for r in sorted(steps, reverse=True):
        held += r["count"]
        if held > words:
            break
        lowest = r["step"]
    ranked = [] if lowest is None else sorted(counted.where(F.col("step") >= lowest).collect(), key=lambda r: (-r["n"], r["word"]))
    own = {r["word"]: math.log10(i + 2) for i, r in enumerate(ranked)}
    return own | {w: min(cost, own.get(w, cost)) for w, cost in _RANK.items()}


def value_cost(value: str, ranks: dict[str, float] = _RANK) -> float:
    """The guess cost of a value; of an address or path that of its hardest part, host and plain letters aside."""
    address = _ADDRESS.match(value)
    if not address:
        return guess_cost(value, ranks)
    rest = value[address.end() :]
    if "://" in address.group():
        host, _, path = rest.partition("/")
        user, at, _ = host.rpartition("@")
        rest = f"{user}/{path}" if at else path
    return max((guess_cost(part, ranks) for part in re.split(r"[/?&=#:@]", rest) if _several_classes(part)), default=0.0)


def _several_classes(value: str) -> bool:
    """Whether a value is more than a word: a digit, a sign, or a capital past its first letter."""
    return any(not c.isalpha() for c in value) or value[1:] not in (value[1:].lower(), value[1:].upper())


def guess_spans(
    text: str, base: list[tuple[int, int, int]], guesses: float = GUESSES, ranks: dict[str, float] = _RANK
) -> list[tuple[int, int, int]]:
    """Values in a credential context that take ``10 ** guesses`` tries or more and that no base span holds whole.

    After "is" or "was", which plain sentences have too, a value of letters in one case is not scored.
    """
    folded = text.lower()
    if not any(name in folded for name in _CONTEXT_NAMES):
        return []
    found = []
    for m in _CONTEXT.finditer(text):
        start, value = m.start(2), m.group(2).rstrip(".:!?)]}*#%$&|")
        end = start + len(value)
        if len(value) < 6 or any(s <= start and end <= e for s, _, e in base) or m.group(1) and not _several_classes(value):
            continue
        if value_cost(value, ranks) >= guesses:
            found.append((start, 3, end))
    return found


def _scan(guesses: float, ranks: Broadcast):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for low, high in slices(texts):
                out = []
                for text in texts.slice(low, high - low).to_pylist():
                    base = base_spans(text)
                    spans = sorted(base + guess_spans(text, base, guesses, ranks.value))
                    out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(out, kind)], names=["id", "spans"])

    return run


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", guesses: float = GUESSES) -> DataFrame:
    """Per row: id and spans, an array of (kind, start, end) by start, then kind.

    Places are code points, ends exclusive. ``assign``, ``access`` and ``hex`` are the fixed patterns;
    ``guess`` is a value after a credential's name whose guess cost is ``10 ** guesses`` or more and that
    no fixed pattern holds whole; it may overlap their spans. Its words are the fixed ones and those that
    ``word_ranks`` counts in ``docs``. Null and empty texts have no spans; every row gives a row.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(docs, text_col))
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = source.mapInArrow(_scan(guesses, ranks), "id long, spans array<struct<kind:string,start:long,end:long>>")
    return found.withColumnRenamed("id", id_col)


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mask``; overlapping spans count as one. All columns stay."""
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(docs, text_col))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            out = []
            for text in batch.column(at).to_pylist():
                if text is not None:
                    base, parts, done = base_spans(text), [], 0
                    for start, _, end in sorted(base + guess_spans(text, base, GUESSES, ranks.value)):
                        if start >= done:
                            parts += [text[done:start], mask]
                        done = max(done, end)
                    text = "".join([*parts, text[done:]])
                out.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
