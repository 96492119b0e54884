"""Main text of web pages: structure first, then what a suffix array finds repeated over a host's pages."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, gram_hashes, groups, mixed, signed, stored, texts_of
from .filters import fixed_filter, passing

RUN = 8
SEPARATOR = "\n\n"
LEAST_PAGES = 3
LEAST_SHARE = 0.6
SHARD_CHARS = 2_000_000

# The elements of HTML by what they do to text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes noscript template".split())
_BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead
    tr ul caption optgroup option xmp""".split()
)
_DROPPED = frozenset("head nav footer aside form button select option optgroup datalist menu dialog audio video canvas input svg".split())
# An opening tag of the key ends an open element of the value, unless a container lies between.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",),
}
_SCOPE = frozenset("table ul ol dl article section div main body html td th blockquote aside nav footer form".split())
_ENDS_P = _BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "summary"}
# Opening tags that end one element only, however many stand open.
_ENDS_ONE = frozenset("td th li dt dd option p".split())
# Elements that a name can mark as something else than the article. Headings, paragraphs, lists' items and
# tables are text whatever they are called.
_NAMED_OUTSIDE = frozenset("div section ul ol dl p span a article aside table header details figure center ins".split())
_NAMED_INSIDE = frozenset("div ul ol dl article aside details ins".split())
# Class and id names of what is not the article.
_NAMED = re.compile(
    r"""(?:site|page|main|top|bottom|left|right|global|reader|user|post)?[-_]?
    (?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:s|ed)?|promos?|promotions?|banners?|side-?bars?|notices?
    |notifications?|alerts?|cookies?|consent|gdpr|pop-?ups?|overlay|modal|newsletters?|subscribe|subscriptions?|comments?
    |discussion|replies|respond|menus?|nav|navbar|navigation|bread-?crumbs?|footer|header|masthead|shar(?:e|ing)|social|related
    |recommended|widgets?|pagination|pager|copyright|login|signup|search)
    (?:[-_]?(?:box|bar|list|section|block|area|wrap|wrapper|container|links?|item|slot|unit|banner|message|form|thread|text|\d++))*+""",
    re.X | re.I,
)
# Inside an article these may name a part of it.
_PART = re.compile(r"(?:discussion|search|header|footer|text)\b", re.I)
# A section inside an article is one of its own, but for these.
_READERS = re.compile(r"(?:reader|user|post)?[-_]?(?:comments?|replies|respond)(?:[-_]?(?:list|section|area|thread|form))*+", re.I)
_LONGEST_NAME = 80
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form toolbar".split())

_OPENING = re.compile(r"""(/?)([a-zA-Z][^\s/><]*+)((?:[^"'<>]++|"[^"]*+"|'[^']*+')*+)""")
_COMMENT = re.compile(r"!--.*?(?:-->|\Z)|[!?][^<>]*+>", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""", re.I)


def _not_article(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is a part of the page beside the article: by what it is, what it does, or its names.

    Names mark containers only; inside an article, only those that no part of a text is called, and of
    sections those of readers' comments.
    """
    if name in _DROPPED:
        return True
    if name == "header" and not in_article:
        return True
    if not attributes:
        return False
    named = name in (_NAMED_INSIDE if in_article else _NAMED_OUTSIDE)
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), unescape(value.strip("\"'")).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value in _ROLES:
            return True
        if key not in ("class", "id"):
            continue
        names = [v for v in value.split() if len(v) <= _LONGEST_NAME]
        if in_article and name == "section" and any(_READERS.fullmatch(v) for v in names):
            return True
        if named and any(_NAMED.fullmatch(v) and not (in_article and _PART.match(v)) for v in names):
            # An article may be headed or followed by elements of such names, but is none itself.
            if not (name == "article" and not re.search(r"comment|repl|\bad|sponsor|promo|related|widget", value)):
                return True
    return False


def _tag(html: str, at: int) -> tuple[int, bool, str, str] | None:
    """(end, closing, name, attributes) of the tag whose ``<`` stands at a place; None if that is text.

    A tag ends at its ``>``. One without is markup if it has a value, or is a bare name at the page's end;
    else its ``<`` is a character like others.
    """
    m = _OPENING.match(html, at + 1)
    if not m:
        return None
    stop, attributes = m.end(), m[3]
    if html[stop : stop + 1] == ">":
        return stop + 1, bool(m[1]), m[2].lower(), attributes
    if html[stop : stop + 1] in ("'", '"'):  # a quote without a partner
        close = html.find(">", stop)
        stop = close + 1 if close >= 0 else len(html)
        attributes = html[m.start(3) : close if close >= 0 else stop]
        if close >= 0:
            return stop, bool(m[1]), m[2].lower(), attributes
    if "=" in attributes or stop == len(html) and not attributes.strip():
        return stop, bool(m[1]), m[2].lower(), attributes
    return None


class _Open:
    """The open elements. Each name knows where it stands open, so a tag costs the elements it closes."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, int]] = []  # (name, dropped, place)
        self.at: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.parts: list[int] = []  # of articles, main and body

    def top(self) -> tuple[str, bool, int]:
        return self.stack[-1] if self.stack else ("", False, 0)

    def push(self, name: str, dropped: bool, place: int) -> None:
        here = len(self.stack)
        self.stack.append((name, dropped, place))
        self.at.setdefault(name, []).append(here)
        if name in _SCOPE:
            self.scopes.append(here)
        if name in ("article", "main", "body"):
            self.parts.append(here)

    def last(self, name: str) -> int:
        places = self.at.get(name)
        return places[-1] if places else -1

    def close(self, here: int) -> None:
        while len(self.stack) > here:
            name, _, _ = self.stack.pop()
            self.at[name].pop()
            if name in _SCOPE:
                self.scopes.pop()
            if name in ("article", "main", "body"):
                self.parts.pop()


def page_blocks(html: str) -> list[str]:
    """The blocks of a page's article in page order: of its ``article`` elements, of ``main`` if more text stands
    there beside them than in them, of the whole body if there is more than three times as much.

    Takes time in proportion to the page, however it is nested or broken.
    """
    blocks: list[tuple[int, str]] = []  # (0 elsewhere, 1 in main, 2 in an article)
    parts: list[str] = []
    opened = _Open()
    endless: set[str] = set()
    dropped, place = False, 0
    svg_until = html.lower().rfind("</svg") if "<svg" in html or "<SVG" in html else -1

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            blocks.append((place, text))
        parts.clear()

    at, seen, n = 0, 0, len(html)  # ``at``: where text that is not yet taken begins
    while seen < n:
        low = html.find("<", seen)
        if low < 0:
            break
        comment = _COMMENT.match(html, low + 1)
        tag = None if comment else _tag(html, low)
        if not comment and not tag:
            seen = low + 1
            continue
        if low > at and not dropped:
            parts.append(unescape(html[at:low]))
        if comment:
            at = seen = comment.end()
            continue
        at, closing, name, attributes = tag
        seen = at
        if name in _BLOCK and not dropped:
            flush()
        if closing:
            here = opened.last(name)
            # A stray end tag inside a part of the page doesn't end what holds that part.
            inside = name not in ("html", "body", "main", "article") and opened.parts and here < opened.parts[-1]
            if here >= 0 and not inside:
                opened.close(here)
                _, dropped, place = opened.top()
            continue
        if name == "br" and not dropped:
            parts.append("\n")
        if name in _RAW:
            if not attributes.endswith("/") and name not in endless:
                end = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I).search(html, at)
                if end:
                    after = html.find(">", end.end())
                    at = seen = after + 1 if after >= 0 else n
                elif name in ("script", "style"):
                    at = seen = n
                else:
                    endless.add(name)
            continue
        if name in _VOID or name == "svg" and svg_until < at:
            continue
        if name == "body" and opened.last("head") >= 0:
            opened.close(opened.last("head"))
        ends = _ENDS.get(name, ())
        if name in _ENDS_P:
            ends = (*ends, "p")
        while ends:
            here = max(opened.last(e) for e in ends)
            if here < 0 or opened.scopes and here < opened.scopes[-1]:
                break
            opened.close(here)
            if name in _ENDS_ONE or opened.stack and opened.stack[-1][0] not in ends:
                break
        _, dropped, place = opened.top()
        if attributes.endswith("/") and name not in _BLOCK:
            continue
        gone = dropped or _not_article(name, attributes, place == 2)
        where = place if gone else 2 if name == "article" else max(place, 1) if name == "main" else place
        opened.push(name, gone, where)
        dropped, place = gone, where
    if at < n and not dropped:
        parts.append(unescape(html[at:]))
    flush()
    mass = [sum(len(text) for p, text in blocks if p == k) for k in range(3)]
    least = 2 if mass[2] and mass[2] >= mass[1] else 1
    if 3 * sum(mass[least:]) < mass[0] or not sum(mass[least:]):
        least = 0
    return [text for p, text in blocks if p >= least]


def suffix_ranks(tokens: np.ndarray, length: int) -> np.ndarray:
    """Rank of each place's suffix by its first ``length`` tokens (a power of two), by prefix doubling.

    Equal ranks lie next to each other in the suffix array and mean equal runs of that length.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    size = 1
    while size < length:
        following = np.zeros(len(rank), np.int64)
        following[: max(len(rank) - size, 0)] = rank[size:] + 1
        rank = np.unique(rank * (len(rank) + 2) + following, return_inverse=True)[1].astype(np.int64)
        size *= 2
    return rank


def run_places(tokens: np.ndarray, page: np.ndarray, run: int) -> np.ndarray:
    """Where a run of ``run`` tokens begins that lies inside one page."""
    whole = max(len(tokens) - run + 1, 0)
    return np.flatnonzero(page[run - 1 :][:whole] == page[:whole])


def page_counts(rank: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ranks, and on how many distinct pages each stands."""
    pages = int(page.max(initial=0)) + 1
    return np.unique(np.unique(rank * pages + page) // pages, return_counts=True)


def spanned(n: int, places: np.ndarray, run: int) -> np.ndarray:
    """Which of ``n`` tokens lie in a run of ``run`` tokens that begins at one of the places."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, places, 1)
    np.add.at(step, places + run, -1)
    return np.cumsum(step[:-1]) > 0


def covered(tokens: np.ndarray, page: np.ndarray, run: int, least_pages: int, least_share: float) -> np.ndarray:
    """Which tokens lie in a run of ``run`` tokens or more that enough distinct pages share."""
    pages = len(np.unique(page))
    least = max(least_pages, int(np.ceil(least_share * pages)))
    if pages < least:
        return np.zeros(len(tokens), bool)
    places = run_places(tokens, page, run)
    rank = suffix_ranks(tokens, run)[places]
    known, count = page_counts(rank, page[places])
    return spanned(len(tokens), places[np.isin(rank, known[count >= least])], run)


class Stream:
    """The distinct pages of some rows as one stream of words, with a mark before each block.

    ``distinct``: the first row of each page; ``page``: the number of each token's page among them.
    The marks make short blocks a run together with their borders.
    """

    def __init__(self, pages: list[list[str]]):
        self.pages = pages
        self.flat = [b for blocks in pages for b in blocks]
        owner = np.repeat(np.arange(len(pages)), [len(blocks) for blocks in pages])
        self.distinct: dict[tuple[str, ...], int] = {}
        self.leads = np.array([self.distinct.setdefault(tuple(blocks), i) == i for i, blocks in enumerate(pages)], bool)
        self.words = Words(texts_of(pa.array(self.flat, pa.string())))
        lead = self.leads[owner]
        self.chosen = np.flatnonzero(lead)
        self.size = self.words.counts[self.chosen] + 1
        self.head = np.cumsum(self.size) - self.size
        self.tokens = np.zeros(int(self.size.sum()), np.uint64)
        rest = np.ones(len(self.tokens), bool)
        rest[self.head] = False
        self.tokens[rest] = self.words.hash[np.repeat(lead, self.words.counts)]
        self.owner = owner[self.chosen]
        self.page = np.repeat((np.cumsum(self.leads) - 1)[self.owner], self.size)

    def without(self, gone: np.ndarray) -> list[list[str]]:
        """The blocks of each row without the tokens that are gone."""
        if not gone.any():
            return self.pages
        kept: dict[int, list[str]] = {i: [] for i in np.flatnonzero(self.leads).tolist()}
        for b, o, a, k in zip(self.chosen.tolist(), self.owner.tolist(), self.head.tolist(), self.size.tolist()):
            cut = gone[a + 1 : a + k]
            if not cut.any():
                kept[o].append(self.flat[b])
            elif not cut.all():
                kept[o].append(_without(self.flat[b], self.words, b, cut))
        return [kept[self.distinct[tuple(blocks)]] for blocks in self.pages]


def run_counts(pages: list[list[str]], run: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the runs that ``least`` distinct pages of some share, and how many of these hold each.

    A word that is rarer than that is in no such run: the suffixes are those of the stream without the
    words that lie in no run of frequent ones.
    """
    stream = Stream(pages)
    _, word, often = np.unique(stream.tokens, return_inverse=True, return_counts=True)
    rare = np.concatenate([[0], np.cumsum(often[word] < least)])
    places = run_places(stream.tokens, stream.page, run)
    places = places[rare[places + run] == rare[places]]
    inside = spanned(len(stream.tokens), places, run)
    at = np.cumsum(inside)[places] - 1
    rank = suffix_ranks(stream.tokens[inside], run)[at]
    known, first = np.unique(rank, return_index=True)
    count = page_counts(rank, stream.page[places])[1]
    good = count >= least
    return run_hashes(stream.tokens, places[first[good]], run), count[good]


def run_hashes(tokens: np.ndarray, places: np.ndarray, run: int) -> np.ndarray:
    return gram_hashes(tokens, run)[places]


def known_run_counts(pages: list[list[str]], run: int, known) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the runs that a test lets through, and how many distinct pages hold each."""
    stream = Stream(pages)
    places = run_places(stream.tokens, stream.page, run)
    hashes = run_hashes(stream.tokens, places, run)
    good = known(hashes)
    runs, of = np.unique(hashes[good], return_inverse=True)
    return runs, page_counts(of, stream.page[places[good]])[1]


def without_runs(pages: list[list[str]], runs: np.ndarray, run: int) -> list[list[str]]:
    """The blocks of each page without the runs of these hashes."""
    if not len(runs):
        return pages
    stream = Stream(pages)
    places = run_places(stream.tokens, stream.page, run)
    places = places[np.isin(gram_hashes(stream.tokens, run)[places], runs)]
    return stream.without(spanned(len(stream.tokens), places, run))


def _without(block: str, words: Words, b: int, cut: np.ndarray) -> str:
    """The block without its covered words and what stands between two of them."""
    data, base, first = block.encode(), int(words.offsets[b]), int(words.first[b])
    parts, done = [], 0
    place = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
    for low, high in zip(place[::2].tolist(), place[1::2].tolist()):
        parts.append(data[done : int(words.start[first + low]) - base])
        done = int(words.start[first + high]) - base if high < len(cut) else len(data)
    parts.append(data[done:])
    return " ".join(b" ".join(parts).decode("utf-8", "replace").split())


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            html = part.column(3).to_pylist()
            # No block holds a line feed, so equal digests mean equal blocks.
            blocks = ["\n".join(page_blocks(h)).encode("utf-8", "replace") if h else b"" for h in html]
            page = [blake2b(b, digest_size=16).digest() if b else None for b in blocks]
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:3], pa.array([len(h or "") for h in html], pa.int64()), pa.array(page, pa.binary()),
                    pa.array([zlib.compress(b, 1) for b in blocks], pa.binary()),
                ],
                names=["host", "id", "url", "size", "page", "blocks"],
            )


def _blocks(packed: bytes) -> list[str]:
    text = zlib.decompress(packed).decode()
    return text.split("\n") if text else []


def _marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each shard; one row of each page that counts here is marked."""
    for group in groups(batches, ["host", "shard"]):
        held = {p for part in group.column("held").to_pylist() if part is not None for p in part}
        group = group.filter(pc.is_valid(group.column("blocks"))).drop_columns(["held"])
        marks = []
        for page in group.column("page").to_pylist():
            marks.append(page in held)
            held.discard(page)
        yield from group.drop_columns(["page"]).append_column("counted", pa.array(marks, pa.bool_())).combine_chunks().to_batches()


def _counted(run: int, filter_=None):
    """Runs and their numbers of counted pages: without a filter those that may be boilerplate, else those it knows."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["host", "shard"]):
            packed = [_blocks(b) for b in group.column("blocks").to_pylist()]
            least, pages, salt = (group.column(c)[0].as_py() for c in ("least", "pages", "salt"))
            key = lambda runs: mixed(runs ^ np.array([salt], np.int64).view(np.uint64))
            if filter_ is None:
                # A run on ``least`` of all pages is on as large a share of them in one part at least.
                runs, count = run_counts(packed, run, -(-least * len(packed) // pages))
            else:
                runs, count = known_run_counts(packed, run, lambda runs: passing(filter_, key(runs), 0))
            keys = key(runs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group.column("host")[0].as_py()] * len(runs), pa.string()), pa.array(np.full(len(runs), least)),
                    pa.array(signed(keys)), pa.array(signed(runs)), pa.array(count.astype(np.int64)),
                ],
                names=["host", "least", "key", "run", "count"],
            )

    return work


def _joined(run: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for packed, runs in zip(batch.column(2).to_pylist(), batch.column(3)):
                pages = [_blocks(packed)]
                if runs.is_valid:
                    pages = without_runs(pages, runs.values.to_numpy().view(np.uint64), run)
                texts.append(SEPARATOR.join(pages[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    return work


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    run: int = RUN,
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """Per page: id, url, text; an empty line stands between two blocks.

    Blocks come from the markup: those of the article (without one, of ``main``, then of the body)
    outside menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments.
    Then all blocks of a host's pages form a stream of words; in its suffix array, runs of ``run``
    words or more (borders of blocks count as one) that at least ``least_share`` of the host's distinct
    pages share, and ``least_pages`` of them, are boilerplate too and are cut. Passages that fewer pages
    share, and pages that are copies of each other, lose nothing.

    A large host is dealt by a hash of its rows into shards of about ``shard_chars`` characters, each
    with a suffix array of its own, so no task holds a whole host, nor all the copies of a page. One row of
    each distinct page counts, whatever shard it is in. A run on enough pages of the host has that share in
    one shard at least; runs that have are counted over all shards, and what the whole host decides is cut
    in each. A null page is empty, gives an empty text and counts as no page; a null url is a host of its
    own. Every row gives a row.
    """
    source = pages.select(
        F.coalesce(F.regexp_extract(F.lower(F.col(url_col).cast("string")), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit("")).alias("host"),
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"),
    )
    # Read twice, since the articles themselves are larger than what reading them again costs.
    parsed = source.mapInArrow(_parsed, "host string, id long, url string, size long, page binary, blocks binary")
    place = F.xxhash64("id", "url", "page")
    rows = stored(parsed.select("host", "page", "size", place.alias("place")), "rows")
    hosts = rows.groupBy("host", "page").agg(F.sum("size").alias("size")).groupBy("host").agg(
        F.greatest(F.ceil(F.sum("size") / shard_chars), F.lit(1)).cast("long").alias("shards"), F.count("page").alias("pages")
    )
    least = F.greatest(F.lit(least_pages), F.ceil(F.lit(float(least_share)) * F.col("pages"))).cast("long")
    # Read back, its size is known, and Spark decides by it whether the pages need to move for this join.
    hosts = stored(hosts.withColumn("least", least), "hosts")
    shard = lambda place: F.pmod(place, F.col("shards")).cast("long").alias("shard")
    homes = rows.where("page is not null").join(hosts, "host").groupBy("host", "page").agg(F.min(shard(F.col("place"))).alias("shard"))
    held = homes.groupBy("host", "shard").agg(F.collect_list("page").alias("held"))
    dealt = parsed.join(hosts, "host").select("host", shard(place), "least", "pages", "id", "url", "page", "blocks")
    both = dealt.unionByName(held, allowMissingColumns=True).repartition("host", "shard").sortWithinPartitions("host", "shard", "id")
    sharded = stored(
        both.mapInArrow(_marked, "host string, shard long, least long, pages long, id long, url string, blocks binary, counted boolean"), "shards"
    )
    once = sharded.where("counted").select("host", "shard", "least", "pages", F.xxhash64("host").alias("salt"), "blocks")
    kind = "host string, least long, key long, run long, count long"
    maybe = fixed_filter(once.mapInArrow(_counted(run), kind).select("key", F.lit(0).alias("salt")))
    total = once.mapInArrow(_counted(run, maybe), kind).groupBy("host", "run", "least").agg(F.sum("count").alias("count"))
    decided = stored(total.where("count >= least").groupBy("host").agg(F.collect_list("run").alias("runs")), "runs")
    # A host's decided runs are fewer than two for each word of its average page.
    found = sharded.join(decided, "host", "left").select("id", "url", "blocks", "runs").mapInArrow(
        _joined(run), "id long, url string, text string"
    )
    return found.withColumnsRenamed({"id": id_col, "url": url_col})
