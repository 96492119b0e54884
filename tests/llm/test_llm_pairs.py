"""The pair operators against brute force, with nulls, empty and repeated rows, and empty tables."""

import math
import re

import numpy as np
import pytest

from siltstone.llm.buckets import dealt
from siltstone.llm.components import connected_components
from siltstone.llm.decontaminate import benchmark_overlap, decontaminated
from siltstone.llm.embeddings import SKETCH_BITS, _hashed, candidates, embedding_near_duplicates, most_different, tables_for
from siltstone.llm.line_dedup import line_dedup
from siltstone.llm.ngram_join import bands_for, ngram_jaccard_join, one_of_each_group

DOCS = "doc_id long, text string, id long, digest string, n_hit int, key string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def table(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, 7, "x", 1, "k") for i, t in rows], DOCS).repartition(3)


def sentence(rng, n, vocabulary=400):
    return [f"w{x}" for x in rng.integers(0, vocabulary, n)]


def documents():
    rng = np.random.default_rng(5)
    rows = [(None, None), (900, ""), (901, None), (902, "?!"), (903, "One two"), (904, "one, TWO."), (905, "one two three")]
    for group in range(12):
        base = sentence(rng, 90)
        for copy in range(int(rng.integers(1, 7))):
            other = list(base)
            for place in rng.integers(0, 90, int(rng.integers(0, 5))):
                other[place] = "changed"
            rows.append((group * 10 + copy, " ".join(other)))
    rows += [(950, rows[-1][1]), (951, rows[-1][1].upper()), rows[-1], (952, "é" * 50_000), (953, " ".join(sentence(rng, 20_000)))]
    return rows


def reachable(links, ids):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def test_bands_reach_the_recall():
    bands, rows = bands_for(0.8, 0.9999, 128)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 128
    with pytest.raises(ValueError):
        bands_for(0.8, 0.9999, 2)


def test_ngram_join_against_brute_force(spark):
    rows = documents()
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    links = [
        (a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    named = [(rows[a][0], rows[b][0]) for a, b in links]
    root = reachable(named, [i for i, _ in rows])
    expected = sorted((str(i), sum(k in pair for pair in links), str(root[i])) for k, (i, _) in enumerate(rows))
    got = ngram_jaccard_join(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_links, str(r.component_id)) for r in got) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_document_of_each_group_stays_with_its_columns(spark):
    docs = table(spark, documents())
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {None, 900, 901, 902} <= set(ids)
    assert ngram_jaccard_join(docs.limit(0)).count() == 0 and one_of_each_group(docs.limit(0)).count() == 0


def test_null_and_repeated_ids_keep_one_document_of_each_group(spark):
    rng = np.random.default_rng(11)
    a, b, c, d, e = ("".join(f"{w} " for w in sentence(rng, 80)) for _ in range(5))
    near = lambda text: text + "changed"
    kept = [(5, a), (5, c), (7, b), (7, d), (8, "one two"), (None, None), (None, ""), (9, "?!"), (10, "?!")]
    gone = [(None, a), (None, near(a)), (6, near(c)), (None, b), (8, near(b)), (None, "ONE two"), (5, a)]
    got = one_of_each_group(table(spark, [*kept, *gone, (None, e), (None, near(e)), (None, e)])).collect()
    rows = [(r.doc_id, r.text) for r in got]
    assert sorted(map(str, rows)) in [sorted(map(str, [*kept, (None, x)])) for x in (e, near(e))]


def test_ngram_join_links_texts_whatever_their_ids(spark):
    rng = np.random.default_rng(17)
    a, b, c, d = ("".join(f"{w} " for w in sentence(rng, 80)) for _ in range(4))
    near = lambda text: text + "changed"
    rows = [(5, a), (5, b), (6, near(a)), (7, near(b)), (None, c), (None, near(c)), (None, c), (None, d), (9, near(d)), (4, "one"), (4, "one")]
    sets = [{tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for w in (words(t) for _, t in rows)]
    linked = [[5 * len(x & y) >= 4 * len(x | y) for y in sets] for x in sets]
    root = reachable([(x, y) for x in range(len(rows)) for y in range(x) if linked[x][y]], range(len(rows)))
    expected = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in root if root[m] == root[k] and rows[m][0] is not None]
        expected.append((str(i), sum(linked[k]) - 1, str(min(ids, default=None))))
    got = ngram_jaccard_join(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_links, str(r.component_id)) for r in got) == sorted(expected)
    kept = sorted((str(r.doc_id), r.n_links) for r in got if r.kept)
    # The group without ids keeps one of its two texts, with its copies.
    assert kept in [sorted([("5", 1), ("5", 1), ("9", 1), ("4", 1), ("4", 1), *idless]) for idless in ([("None", 2)] * 2, [("None", 2)])]


def test_blocks_bring_every_pair_of_a_bucket_together(spark):
    rows = [(0, "a", i, 1) for i in range(40)] + [(1, "b", i, 1) for i in range(40)] + [(1, "c", 99, 1)]
    members = spark.createDataFrame(rows, "band int, key string, id long, size long")
    met = set()
    groups = {}
    for r in dealt(members, ["id"], 8, 1000).collect():
        assert (r.band, r.key) == (0, "a")  # the second bucket has the same members
        groups.setdefault((r.i, r.j), []).append((r.block, r.id))
    for (i, j), held in groups.items():
        assert len(held) < 40
        met |= {(min(a, b), max(a, b)) for x, a in held for y, b in held if a != b and {x, y} == {i, j}}
    assert len(met) == 40 * 39 // 2


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(50)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 32))
    rows = [(i, (centres[i % 30] + rng.standard_normal(32) * rng.choice([0.05, 0.2])).tolist()) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(5)] + [(510, [2 * x for x in rows[0][1]]), rows[3]]
    odd = [None, [], [0.0] * 32, [math.nan] + [1.0] * 31, [None] + [1.0] * 31, [math.inf] + [1.0] * 31, [1.0, 2.0]]
    return rows + [(600 + i, v) for i, v in enumerate(odd)] + [(None, rows[5][1])]


def test_embeddings_against_brute_force(spark):
    rows = vectors()
    usable = [k for k, (i, v) in enumerate(rows) if i is not None and v and len(v) == 32 and None not in v and np.isfinite(v).all() and any(v)]
    m = np.array([rows[k][1] for k in usable])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.95
    links = [(rows[usable[a]][0], rows[usable[b]][0]) for a, b in zip(*np.nonzero(np.triu(near, 1)))]
    count = {}
    for a, k in enumerate(usable):
        count.setdefault(rows[k][0], []).append(int(near[a].sum()) - 1)
    root = reachable(links, [i for i, _ in rows])
    docs = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, unit string").repartition(3)
    got = embedding_near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_links in count.get(r.vec_id, [0]) and r.component_id == root[r.vec_id]
        assert r.kept == (r.vec_id == r.component_id)
    assert embedding_near_duplicates(docs.limit(0)).count() == 0


def test_sketches_keep_pairs_at_the_threshold_and_drop_strangers(spark):
    rng = np.random.default_rng(8)
    bound, chance = most_different(), math.acos(0.95) / math.pi
    assert (rng.binomial(SKETCH_BITS, chance, 200_000) > bound).mean() <= 1e-4 and bound < SKETCH_BITS / 4
    rows, one = [], lambda x: x / np.linalg.norm(x)
    for k in range(1500):
        x = one(rng.standard_normal(48))
        rows.append((2 * k, x))
        if k < 150:  # a partner at a cosine of 0.951
            y = rng.standard_normal(48)
            rows.append((2 * k + 1, 0.951 * x + math.sqrt(1 - 0.951**2) * one(y - (y @ x) * x)))
    tables, bits = tables_for(len(rows))
    units = spark.createDataFrame([(i, v.tobytes(), 1) for i, v in rows], "class_id long, unit binary, copies long")
    hashed = units.mapInArrow(_hashed(tables, bits), "class_id long, unit binary, copies long, keys binary, sketch binary")
    ids = {r.class_id for r in candidates(hashed, tables, 0.95).select("class_id").distinct().collect()}
    assert ids >= set(range(300)) and len(ids) < 320


def test_tables_reach_the_recall():
    for rows in (1, 10_000, 10**9):
        tables, bits = tables_for(rows)
        agree = (1 - math.acos(0.95) / math.pi) ** bits
        assert 1 - (1 - agree) ** tables >= 0.9999


def overlap(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, item_text in items:
        v = words(item_text)
        if not v:
            continue
        n = min(10, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(found, key=str)


def test_decontamination_against_brute_force(spark):
    rng = np.random.default_rng(8)
    items = [(i, " ".join(sentence(rng, int(n), 60))) for i, n in enumerate(rng.integers(8, 40, 25))]
    items += [(100, "short one"), (101, "w1"), (102, ""), (103, None), (None, "w2 w3"), (104, items[0][1]), (105, "a " * 40)]
    rows = [(None, None), (1, ""), (2, "a " * 30), (2, "w1"), (3, "Short, ONE")]
    for i in range(60):
        parts = sentence(rng, int(rng.integers(0, 60)), 60)
        source = words(items[int(rng.integers(0, 25))][1])
        a = int(rng.integers(0, len(source)))
        rows.append((10 + i, " ".join([*parts, *source[a : a + int(rng.integers(8, 20))], *sentence(rng, 5, 60)])))
    rows += rows[-3:] + [(None, items[3][1])]
    docs = table(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = benchmark_overlap(docs, bench).collect()
    shown = lambda i, n, h, found: (str(i), n, h, tuple(found))
    assert sorted(shown(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == sorted(shown(i, *overlap(t, items)) for i, t in rows)
    clean = decontaminated(docs, bench)
    assert clean.columns == docs.columns
    for empty in (benchmark_overlap(docs, bench.limit(0)), benchmark_overlap(docs.limit(0), bench)):
        assert empty.where("n_hit > 0").count() == 0


def test_decontamination_tells_rows_of_one_id_apart(spark):
    rng = np.random.default_rng(12)
    hit, clean, other = (" ".join(sentence(rng, 40)) for _ in range(3))
    docs = table(spark, [(None, clean), (None, f"x {hit}"), (None, None), (2, hit), (2, other), (2, ""), (3, hit), (4, clean), (4, clean)])
    bench = spark.createDataFrame([(1, hit)], "item_id long, text string")
    expected = [(None, clean), (None, None), (2, other), (2, ""), (4, clean), (4, clean)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in decontaminated(docs, bench).collect()))) == sorted(map(str, expected))


def test_lines_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(None, None, "s1"), (1, "", "s1"), (2, " \t\r\n\n", None)]
    pool = [f"line {i}" for i in range(40)]
    for i in range(80):
        lines = [pool[min(39, int(rng.exponential(8)))] + rng.choice(["", " ", "\r"]) for _ in range(int(rng.integers(1, 6)))]
        rows.append((10 + i, "\n".join(lines), f"s{rng.integers(0, 9)}"))
    rows += rows[-2:]
    spread, first = {}, {}
    for i, text, site in rows:
        for pos, line in enumerate((text or "").split("\n")):
            key = line.strip(" \t\r")
            if key:
                spread.setdefault(key, set()).add(site)
                first[key] = min(first.get(key, (10**9, 0)), (i, pos))
    boilerplate = {k for k, sites in spread.items() if len(sites - {None}) >= 6}
    assert boilerplate and len(boilerplate) < len(spread)
    expected = []
    for i, text, site in rows:
        kept = [x for p, x in enumerate((text or "").split("\n")) if x.strip(" \t\r") not in boilerplate or first[x.strip(" \t\r")] == (i, p)]
        expected.append((str(i), None if text is None else "\n".join(kept), 0 if text is None else len(text.split("\n")) - len(kept)))
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, h1 int, removed_lines int").repartition(3)
    got = line_dedup(docs)
    assert sorted(map(str, [(str(r.doc_id), r.text, r.removed_lines) for r in got.collect()])) == sorted(map(str, expected))
    assert line_dedup(docs.limit(0)).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
