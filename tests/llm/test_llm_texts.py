"""The text operators against plain versions, exact round trips and held-out labels."""

import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.llm.common import hash_limit, texts_of
from siltstone.llm.html_extract import covered, known_run_counts, main_text, page_blocks, run_counts, suffix_ranks
from siltstone.llm.packing import best_fit_packing, best_fit_plan
from siltstone.llm.quality import FAMILIES, label_model, quality_scores
from siltstone.llm import secrets
from siltstone.llm.secrets import base_spans, guess_cost, redacted, secret_spans, value_cost, word_ranks
from siltstone.llm.token_counts import attributed, token_counts
from siltstone.llm.tokens import byte_coder, tokenizer_path, word_coder
from siltstone.llm.toxicity import fit, gradient, score, toxicity, training_rows, without_toxic

DOCS = "doc_id long, text string, id string, length int"
ODD = [None, "", " \n\n ", "a", "x" * 30_000, "İstanbul Σας ﬀ 日本 😀 é", "it's WE'RE <|endoftext|>,", "1,234.5\t-\r\nend"]


def table(spark, texts, ids=None):
    ids = ids or [None, *range(1, len(texts))]
    return spark.createDataFrame([(i, t, "x", 3) for i, t in zip(ids, texts)], DOCS).repartition(3)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    return ODD + ODD[3:5] + [" ".join(rng.choices(["alpha", "Beta,", "γάμμα", "x1", "...", "\n"], k=rng.randint(1, 9000))) for _ in range(30)]


def test_word_coder_gives_the_library_ids():
    coder = word_coder(tokenizer_path("word_bpe_49k.json"))
    parts = ["a", "B", "'s", "'", "<|endoftext|>", ",", "…", "«", " ", "\n", "\t", "\r", "\x1c", " ", "́", "J̌", "7", "Σ", "K", "|", "<", ">", "re", "😀"]
    rng = random.Random(1)
    odd = [t or "" for t in ODD] + ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    ids, first = coder.encode(texts_of(pa.array(odd)))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [e.ids for e in coder.coder.encode_batch(odd, add_special_tokens=False)]


def best_fit(lengths, room):
    """Sequences that best fit takes, piece by piece and longest first."""
    free = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, f in enumerate(free) if f >= length]
        if fitting:
            free[min(fitting, key=lambda i: free[i])] -= length
        else:
            free.append(room - length)
    return len(free)


def test_plan_places_everything_once():
    rng = np.random.default_rng(1)
    for _ in range(60):
        room = int(rng.integers(1, 40))
        lengths = Counter(int(x) for x in rng.integers(1, room + 1, int(rng.integers(0, 200))))
        runs, sequences = best_fit_plan(lengths, room)
        taken, fill = set(), Counter()
        for length, rank, bins, per, sequence, offset in runs.tolist():
            for i in range(bins * per):
                for u in range(length):
                    spot = (sequence + i // per, offset + i % per * length + u)
                    assert spot not in taken and spot[1] < room
                    taken.add(spot)
                fill[sequence + i // per] += length
        assert len(taken) == sum(n * c for n, c in lengths.items()) and len(fill) == sequences
        assert all(spot < fill[s] for s, spot in taken)
        assert sequences == best_fit(lengths.elements(), room)


def test_packing_round_trip(spark, texts):
    rows = best_fit_packing(table(spark, texts)).collect()
    coder = word_coder(tokenizer_path("word_bpe_49k.json")).coder
    expected, total = [], 0
    for i, text in zip([None, *range(1, len(texts))], texts):
        ids = coder.encode(text or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        for p, a in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[a : a + 4096], "<u4")
            expected.append((str(i), p, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) == best_fit([r.length for r in rows], 4096)
    assert len(sequences) >= -(-total // 4096)
    assert best_fit_packing(table(spark, texts).limit(0)).count() == 0


def test_base_spans_are_those_of_the_patterns(spark):
    alike = ["password", "PassWD", "Secret", "TOKEN", "api_key", "apikey", "paſſwd", "toKen", '"', "'", " ", ":", "=", "AKIA", "AB12CD34EF56GH78", "deadbeef", "0123456789abcdef", "é", "/", "."]
    rng = random.Random(2)
    found = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    samples = ODD + ["".join(rng.choices(alike, k=rng.randint(1, 12))) for _ in range(2000)]
    for text in samples:
        text = text or ""
        expected = [(m.start(), 0, m.end()) for m in found.finditer(text) if len(m[2]) >= 6]
        expected += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        expected += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert base_spans(text) == sorted(expected)
    rows = secret_spans(table(spark, samples)).collect()
    assert len(rows) == len(samples) and secret_spans(table(spark, samples).limit(0)).count() == 0


def test_guess_costs_order_values():
    weak = [guess_cost(v) for v in ("password", "Passw0rd1", "qwerty123456", "20240101", "a" * 5000, "abcabcabcabc", "required")]
    strong = [guess_cost(v) for v in ("x7#Kq9!zP2", "9f86d081884c7d65", "gT5-kWq2Lm")]
    assert max(weak) < 10 <= min(strong)


def test_segments_may_begin_and_end_inside_longer_ones():
    double, brute = np.log10(2), np.log10(36)
    walk, default = 1.7 + np.log10(3), guess_cost("default")
    assert guess_cost("abcdefault") <= walk + double + default + 1e-9
    assert guess_cost("abcdefault12") <= walk + default + 2 * double + 2 * brute + 1e-9
    assert guess_cost("passworduytrewq") <= guess_cost("password") + double + 1.7 + np.log10(7) + 1e-9
    assert guess_cost("2019901231") <= 2 + double + 4.6 + 1e-9
    assert guess_cost("k7k7x9k7x9k7x9") <= 2 * brute + double + 4 * brute + np.log10(3) + 1e-9
    assert guess_cost("ab" * 50_000) < 10


def cheapest_segmentation(value, ranks):
    """Every way to cut the value, each segment at its cheapest reading."""
    brute, lower = secrets._alphabet(value), value.lower()
    leet = lower.translate(secrets._LEET)

    def cost(i, j):
        part, n = value[i:j], j - i
        found = [brute * n]
        for form, extra in ((lower[i:j], 0.0), (leet[i:j], 0.6)):
            if n >= 3 and form in ranks:
                upper = sum(c.isupper() for c in part)
                found.append(ranks[form] + extra + (0 if not upper else 0.3 if upper == n or part[0].isupper() and upper == 1 else 0.3 * n))
                break
        found += [4.6 if n > 4 else 2.1 for d in secrets._DATES if d.fullmatch(part)]
        if n >= 3:
            if all(lower[k : k + 2] in secrets._BESIDE for k in range(i, j - 1)):
                found.append(1.7 + np.log10(n))
            found += [brute * u + np.log10(n // u) for u in range(1, n // 2 + 1) if n % u == 0 and part == part[:u] * (n // u)]
        return min(found)

    best = np.inf
    for mask in range(1 << (len(value) - 1)):
        cuts = [0, *[k + 1 for k in range(len(value) - 1) if mask >> k & 1], len(value)]
        best = min(best, sum(cost(a, b) for a, b in zip(cuts, cuts[1:])) + np.log10(2) * (len(cuts) - 2))
    return best


def test_guess_cost_is_the_least_of_all_segmentations():
    rng = random.Random(1)
    pieces = ["pass", "root", "abc", "qwe", "12", "1999", "aa", "x", "K", "7#", "Test", "p@ss", "654", "poi", "abab", "the", "otter"]
    ranks = {**secrets._RANK, "otter": 3.2, "tert": 4.0}
    for _ in range(400):
        value = "".join(rng.choices(pieces, k=4))[:9]
        assert abs(guess_cost(value, ranks) - cheapest_segmentation(value, ranks)) < 1e-9, value


PROSE = ["the administrator read all documentation before christopher left", "documentation is kept by an administrator, says Christopher."]


def test_plain_words_are_no_secrets(spark):
    plain = [
        "the secret was forgotten", "My password is documentation", "pass was intercepted", "credential: administrator",
        "auth: Christopher", "login: https://example.com/account/settings", "login: /home/admin/documentation",
    ]
    strong = ["login: https://admin:x7Kq9zP2wL@example.com/", "the password is x7#Kq9!zP2", "auth: wQzjxkvbnqpt"]
    # A secret that many copies repeat does not become a word.
    docs = table(spark, [*PROSE, *plain, *strong, *strong, *strong])
    ranks = word_ranks(docs)
    assert "administrator" in ranks and "forgotten" not in ranks and "wqzjxkvbnqpt" not in ranks
    spans = {r.doc_id: [s.kind for s in r.spans] for r in secret_spans(docs).collect()}
    texts = [r.text for r in docs.collect()]
    assert len(texts) == len(PROSE) + len(plain) + 3 * len(strong)
    kinds = sorted(map(str, spans.values()))
    assert kinds == sorted([str([])] * (len(PROSE) + len(plain)) + [str(["guess"])] * (3 * len(strong)))
    assert word_ranks(docs.limit(0)) == secrets._RANK == word_ranks(docs, words=0)
    common = table(spark, ["alder birch", "alder birch", "alder birch cedar", "alder cedar larch"])  # 4, 3, 2 and 1 documents
    held = lambda n: set(word_ranks(common, words=n)) - set(secrets._RANK)
    assert [held(n) for n in (1, 2, 9)] == [{"alder"}, {"alder", "birch"}, {"alder", "birch", "cedar"}]
    assert value_cost("/home/admin", {}) < value_cost("x7Kq9zP2wL", {})


def test_planted_values_are_found_and_plain_ones_left(spark):
    rng = random.Random(4)
    names = ["login: ", "pwd = ", "auth: ", "credential: ", "the passphrase is ", "pass := "]
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(5, 11))) for _ in range(300)]
    signs = "abcdefghjkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789#!%+"
    strong = ["".join(rng.choices(signs, k=rng.randint(9, 20))) for _ in range(300)]
    weak = [rng.choice(words) + rng.choice(["", "1", "99", "2019"]) for _ in range(300)]
    prose = [" ".join(rng.sample(words, 60)) for _ in range(100)]
    texts = prose + [f"{rng.choice(prose)[:40]} {rng.choice(names)}{v} end" for v in strong + weak]
    rows = secret_spans(table(spark, texts)).collect()
    found = {r.doc_id: {s.kind for s in r.spans} for r in rows}
    ids = {r.text: r.doc_id for r in table(spark, texts).collect()}
    hit = [bool(found[ids[t]]) for t in texts]
    caught, false = sum(hit[100:400]), sum(hit[:100]) + sum(hit[400:])
    assert caught >= 294 and false <= 3, (caught, false)


def test_a_value_in_context_is_found_and_masked(spark):
    texts = ["the login: gT5#kWq2Lm! ok", "login: password1 ok", "pwd = x7#Kq9!zP2", "token = 'abcdef1234567890' end", None]
    rows = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_spans(table(spark, texts, [1, 2, 3, 4, 5])).collect()}
    assert rows[1] == [("guess", 11, 21)] and rows[2] == [] and rows[3] == [("guess", 6, 16)]
    assert rows[4] == [("assign", 0, 25)] and rows[5] == []
    masked = {r.doc_id: r.text for r in redacted(table(spark, texts, [1, 2, 3, 4, 5])).collect()}
    assert masked[1] == "the login: [secret]! ok" and masked[4] == "[secret]' end" and masked[5] is None


def test_a_value_that_a_pattern_holds_in_part_is_found_whole(spark):
    texts = ["password: gT5-kWq2Lm#x9!Zq7 ok", "secret=Zk39fQ$w8Lp2xV", "api_key = aB3dE6!kQ9zX1 end", "token=abcdef1234567890"]
    rows = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_spans(table(spark, texts, [1, 2, 3, 4])).collect()}
    assert rows[1] == [("assign", 0, 20), ("guess", 10, 27)] and rows[2] == [("assign", 0, 13), ("guess", 7, 21)]
    assert rows[3] == [("assign", 0, 16), ("guess", 10, 23)] and rows[4] == [("assign", 0, 22)]
    masked = {r.doc_id: r.text for r in redacted(table(spark, texts, [1, 2, 3, 4])).collect()}
    assert masked == {1: "[secret] ok", 2: "[secret]", 3: "[secret] end", 4: "[secret]"}


def test_tokens_are_attributed_once(spark, texts):
    coder = byte_coder(tokenizer_path("byte_bpe_50k.tiktoken"))
    rows = token_counts(table(spark, texts, list(range(len(texts)))), fields=("id", "text")).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        whole = "x\n" + (text or "")
        held = sorted(by_doc[i], key=lambda r: r.start)
        assert [r.start for r in held] == [0, *(r.end for r in held[:-1])] and held[-1].end == len(whole)
        assert [whole[r.start : r.end] for r in held] == [x for x in re.findall(r"[^\n]*\n|[^\n]+", whole)]
        assert sum(r.n_tokens for r in held) == len(coder.coder.encode_ordinary(whole))
        assert {r.field for r in held} <= {"id", "text"} and held[0].field == "id"
    assert token_counts(table(spark, texts).limit(0)).count() == 0


def test_crossing_tokens_go_where_most_of_them_lies():
    n, crossing = attributed(np.array([2, 5, 9, 10]), np.array([3, 4, 10]))
    # Token 2-5 has one byte in each of three sections: the first counts. Token 5-9 lies in the last.
    assert n.tolist() == [2, 0, 2] and crossing.tolist() == [1, 0, 0]
    n, crossing = attributed(np.array([4, 8]), np.array([3, 8]))
    assert n.tolist() == [1, 1] and crossing.tolist() == [1, 0]


def test_article_without_what_surrounds_it():
    page = """<html><head><title>x</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><a>menu</a></nav><div class="ad">buy</div><main><article class="post"><h1>A &amp; b&nbsp;c</h1><p>One<br>two <i>it</i>alic
    <p>Three &lt;3<div class="notice">cookies</div><script>var t="</p>";</script><form>f</form><aside>x</aside><footer>by</footer>
    <section id="comments"><article>nice</article></section></article></main><div id=sidebar>side</div><footer>&copy;</footer></body>"""
    assert page_blocks(page) == ["A & b c", "One two italic", "Three <3"]
    assert page_blocks("") == [] and page_blocks("3 < 4 &eacute") == ["3 < 4 é"] and page_blocks("<article>cut <scr") == ["cut"]


@pytest.mark.parametrize(
    "page,blocks",
    [
        ('<article>A<section id="discussion">We found it.</section><h2 id="search">S</h2><h2 id="related">R</h2><p class="alert">P</p></article>',
         ["A", "We found it.", "S", "R", "P"]),
        ("<main><p>The main long text.</p><article>teaser</article></main>", ["The main long text.", "teaser"]),
        ("<main><p>lead</p><article>The longer article.</article></main>", ["The longer article."]),
        ("<body><div>" + "All of the text. " * 5 + "</div><article>teaser</article></body>", [("All of the text. " * 5).strip(), "teaser"]),
        ("<article><math>a+b</math> <label>L</label> <map>M</map> <object>O</object><xmp>x y</xmp></article>", ["a+b L M O", "x y"]),
        ("<article>a <b and more text", ["a <b and more text"]),
        ("<article>a <b and more</article>", ["a <b and more"]),
        ("<article>if x<y and y<z then <i>q</i> <! so", ["if x<y and y<z then q <! so"]),
        ("<article>one <svg><path> two</article>", ["one two"]),
        ("<article>one <svg><text>no</text></svg> two</article>", ["one two"]),
        ("<article>one <textarea> two</article>", ["one two"]),
        ('<article>x<div class="ad">z</div><section id="comments">c</section><div class="header">H</div></article>', ["x", "H"]),
        ('<article><p title="a > b">one</p><p class="x"<p>two</p></article>', ["one", "two"]),
    ],
)
def test_all_text_of_an_article_is_kept(page, blocks):
    assert page_blocks(page) == blocks


@pytest.mark.parametrize(
    "page",
    [
        "<i>" * 60_000 + "</b>" * 60_000, "<a '>" * 100_000, '<a "' * 100_000, "<b " * 200_000, "<i>" * 40_000 + "<p>" * 100_000,
        "<textarea>" * 60_000, "<!--" * 100_000, "<!" * 200_000, "<svg>" * 60_000, "<div>" * 100_000 + "x", "&" * 500_000,
        "<ul><li>" * 60_000, "<table><tr><td>" * 40_000, '<div class="ads' + "1" * 500_000 + 'x">y', "<div class" + " " * 500_000 + ">x",
        "<div " + "class " * 100_000 + ">x", "<p>" * 200_000, "</p>" * 200_000, "<" * 500_000,
    ],
    ids=lambda page: page[:12],
)
def test_hostile_pages_take_time_in_proportion(page):
    import time

    start = time.process_time()
    page_blocks(page)
    assert time.process_time() - start < 2


def test_counts_of_frequent_runs_are_those_of_all_runs():
    rng = random.Random(6)
    common = [" ".join(f"c{rng.randrange(9)}" for _ in range(12)) for _ in range(3)]
    pages = []
    for i in range(40):
        blocks = [" ".join(f"w{rng.randrange(3000)}" for _ in range(30)) for _ in range(4)]
        pages.append([common[0], *blocks[:2], *(common[1:2] if i % 3 else []), *blocks[2:], *(common[2:] if i % 9 == 0 else [])])
    plain = dict(zip(*(x.tolist() for x in run_counts(pages, 8))))
    for least in (2, 5, 20, 40):
        want = {r: n for r, n in plain.items() if n >= least}
        assert dict(zip(*(x.tolist() for x in run_counts(pages, 8, least)))) == want
        known = np.array(sorted(want), np.uint64)
        assert dict(zip(*(x.tolist() for x in known_run_counts(pages, 8, lambda runs: np.isin(runs, known))))) == want


def test_suffix_ranks_tell_equal_runs():
    tokens = np.random.default_rng(0).integers(0, 3, 400)
    rank = suffix_ranks(tokens, 4)
    for a in range(0, 390, 7):
        for b in range(0, 390, 11):
            assert (rank[a] == rank[b]) == (tokens[a : a + 4].tolist() == tokens[b : b + 4].tolist())
            if rank[a] < rank[b]:
                assert tokens[a : a + 4].tolist() < tokens[b : b + 4].tolist()
    assert not covered(np.zeros(0, np.uint64), np.zeros(0, np.int64), 8, 2, 0.5).any()


def test_runs_of_most_pages_go_and_shared_passages_stay(spark):
    rng = random.Random(3)
    body = lambda: " ".join(f"w{rng.randint(0, 999)}" for _ in range(60))
    notice = "please read our terms before you go on reading this"
    passage = body()
    rows, expected = [], {}
    for i in range(30):
        own, more = body(), passage if i % 5 == 0 else body()
        rows.append((i, "http://a.example/x", f"<div><p>{own}</p><p>{notice}</p><p>{more}</p></div>"))
        expected[i] = f"{own}\n\n{more}"
    rows += [(40, "http://a.example/y", rows[0][2]), (41, None, "<p>alone</p>"), (42, "no host", None), (43, "http://b.example", "")]
    expected |= {40: expected[0], 41: "alone", 42: "", 43: ""}
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string").repartition(3)
    assert {r.page_id: r.text for r in main_text(pages).collect()} == expected
    assert main_text(pages.limit(0)).count() == 0


def test_runs_are_counted_over_all_shards_of_a_host(spark):
    rng = random.Random(8)
    body = lambda: " ".join(f"w{rng.randint(0, 999)}" for _ in range(60))
    notice, passage = "please read our terms before you go on reading this", body()
    rows, expected = [], {}
    for i in range(40):
        own = [body(), *([passage] if i % 4 == 0 else [])]
        rows.append((i, "http://a.example/x", "".join(f"<p>{p}</p>" for p in [own[0], *([notice] if i % 3 else []), *own[1:]])))
        expected[i] = "\n\n".join(own)
    # Copies of one page stand in most shards and count once; a small host cuts too, two pages don't tell.
    rows += [(100 + i, f"http://a.example/{i}", rows[0][2]) for i in range(60)]
    expected |= {100 + i: expected[0] for i in range(60)}
    for i, host in enumerate("bbbbbcc"):
        own = body()
        rows.append((200 + i, f"http://{host}.example", f"<p>{own}</p><p>{notice}</p>"))
        expected[200 + i] = own if host == "b" else f"{own}\n\n{notice}"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for chars in (2_000_000, 2_000, 300):
        assert {r.page_id: r.text for r in main_text(pages, shard_chars=chars).collect()} == expected


def test_pages_of_the_table_give_their_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        blocks = [re.sub(r"</?b>", "", x).replace("<br>", " ") for x in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def labelled(n=600):
    rng = random.Random(6)
    bad = ["zorgon", "blatfink", "murkle"]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        parts = [" ".join(f"v{rng.randint(0, 300)}" for _ in range(8)) for _ in range(rng.randint(2, 9))]
        if toxic:
            at = rng.randrange(len(parts))
            parts[at] += f" {rng.choice(bad)}{rng.choice(['', 's', 'ed'])}"
        rows.append((i, ". ".join(parts) + ".", int(toxic)))
    return rows


def test_toxic_sentences_are_learnt_from_documents(spark):
    rows = labelled()
    docs = table(spark, [t for _, t, _ in rows] + [None, "", "?!"], [i for i, _, _ in rows] + [None, 9001, 9002])
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, text int")
    out = toxicity(docs, labels).collect()
    assert len(out) == len(rows) + 3
    truth = {i: (t, y) for i, t, y in rows}
    right = []
    for r in out:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in truth:
            text, toxic = truth[r.doc_id]
            if r.held_out:
                right.append((r.score >= 0.3) == bool(toxic))
            for s in r.sentences if toxic and r.score >= 0.3 else []:
                if s.score > 0.5:
                    assert re.search("zorgon|blatfink|murkle", text[s.start : s.end])
        else:
            assert r.score == 0
    assert np.mean(right) > 0.95
    model = fit(training_rows(docs, labels))
    clean = without_toxic(docs, model)
    assert clean.columns == docs.columns
    kept = {r.doc_id for r in clean.collect()}
    assert {None, 9001, 9002} <= kept and len(kept) < len(rows)
    nothing = fit(training_rows(docs, labels.limit(0)))
    assert score(docs, nothing).where("score > 0.01").count() == 0


def test_labellers_are_weighed_without_labels():
    rng = np.random.default_rng(1)
    good = rng.random(4000) < 0.8
    names = ["symbols", "marked", "letters"]
    votes = np.stack([np.where(rng.random(4000) < a, good, ~good).astype(int) for a in (0.95, 0.9, 0.8)], axis=1)
    votes[rng.random(votes.shape) < 0.1] = -1
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = label_model(patterns, counts.astype(float), names)
    assert ((model.posterior(patterns)[place] > 0.5) == good).mean() > 0.93


def test_quality_agrees_with_the_labels(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_scores(docs).join(labels, "doc_id").where("quality is not null")
    right = scored.agg(
        F.avg(((F.col("posterior") >= 0.5) == (F.col("quality") == 1)).cast("int")), F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int")))
    ).first()
    assert right[0] > 0.95 and right[1] > 0.95


def test_quality_of_odd_texts(spark):
    rows = quality_scores(table(spark, ODD + ODD[:2], [*range(len(ODD)), 0, 1])).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in rows)
    assert quality_scores(table(spark, ODD).limit(0)).count() == 0


def test_a_share_of_hashes_never_comes_to_nothing():
    assert hash_limit(1.0) == 2**63 - 1 and hash_limit(0.0) == -(2**63)
    assert hash_limit(1e-9) + 2**63 == pytest.approx(2**64 * 1e-9, rel=1e-6)
    assert abs(hash_limit(0.5)) < 2


def test_an_id_on_a_third_of_the_rows_is_learnt_once(spark):
    rows = [(1, f"text {i} of the hot id") for i in range(200)] + [(i, f"text {i}") for i in range(2, 300)] + [(2, None), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 300)] + [(1, 1), (None, 1)], "doc_id long, toxic int")
    got = training_rows(docs, labels).collect()
    held = {i for i in range(1, 300) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert len(got) == 299 - len(held) and sum("hot id" in r["text"] for r in got) == (1 not in held)
    assert {r["text"] for r in got} == {r["text"] for r in training_rows(docs.repartition(2), labels).collect()}
    few = training_rows(docs, labels, sample_rows=60).collect()
    assert 20 < len(few) < 100


def test_copies_do_not_fill_the_quality_sample(spark):
    rng = random.Random(2)
    texts = ["the same text in every row, over and over"] * 300 + [" ".join(f"w{rng.randrange(500)}" for _ in range(40)) for _ in range(300)]
    docs = spark.createDataFrame([(7 if i < 300 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = quality_scores(docs, sample_rows=50).collect()
    assert len(rows) == 600 and len({r["score"] for r in rows if r["doc_id"] == 7}) == 1
    # The fit rests on about fifty texts, of which the copies are one at most.
    assert len({round(r["score"], 12) for r in rows}) > 200


def test_gradient_is_the_slope_of_the_likelihood():
    rng = np.random.default_rng(9)
    bags, sentences = [], []
    for _ in range(30):
        k = int(rng.integers(0, 8))
        marks = np.sort(rng.integers(0, 4, k))
        marks = np.unique(marks, return_inverse=True)[1]
        bags.append(np.array([marks, rng.integers(0, 6, k)], np.int32).reshape(2, -1))
        sentences.append((int(marks[-1]) + 1 if k else 0) + int(rng.integers(0 if k else 1, 3)))
    toxic, n = rng.integers(0, 2, 30), np.array(sentences)

    def likelihood(state):
        total = 0.0
        for t, s, b in zip(toxic, n, bags):
            logits = np.full(s, state[-1])
            for sentence, feature in b.T:
                logits[sentence] += state[feature]
            clean = np.prod(1 / (1 + np.exp(logits)))
            total += np.log(1 - clean) if t else np.log(clean)
        return total

    state = rng.normal(0, 0.7, 7)
    numeric = [(likelihood(state + h) - likelihood(state - h)) / 2e-6 for h in np.eye(7) * 1e-6]
    assert gradient(toxic, n, bags, state[:-1], state[-1]) == pytest.approx(numeric, rel=1e-4, abs=1e-5)


def test_expectation_maximisation_equals_a_plain_loop():
    """The same steps, written out vote by vote."""
    names = [f for family in FAMILIES for f in family]
    rng = np.random.default_rng(1)
    patterns = np.unique(rng.integers(-1, 2, (40, len(names))), axis=0)
    counts = rng.integers(1, 50, len(patterns)).astype(float)
    k = 1 + len(FAMILIES)
    one = label_model(patterns, counts, names, rounds=0)
    shares, chances = one.shares.tolist(), one.chances.tolist()
    for _ in range(7):
        weights = []
        for p, n in zip(patterns, counts):
            odds = [shares[c] * np.prod([chances[i][c][v] for i, v in enumerate(p) if v >= 0]) for c in range(k)]
            weights.append([n * o / sum(odds) for o in odds])
        for i in range(len(names)):
            for c in range(k):
                votes = [1 + sum(w[c] for w, p in zip(weights, patterns) if p[i] == v) for v in (0, 1)]
                chances[i][c] = [v / sum(votes) for v in votes]
        mass = [1 + sum(w[c] for w in weights) for c in range(k)]
        shares = [m / sum(mass) for m in mass]
    model = label_model(patterns, counts, names, rounds=7)
    assert model.shares == pytest.approx(shares) and model.chances.ravel() == pytest.approx(np.array(chances).ravel())
