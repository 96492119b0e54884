"""Chat formatting and the prefix trie against brute force, with nulls, ties, copies and empty tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from siltstone.llm.chat_format import END, SEP, START, chat_format, format_digests, read_back
from siltstone.llm.prefix_trie import borrowed_heads, prefix_trie, skeleton_of, splitters_of, turn_paths
from siltstone.llm.queries import QUERIES

ROWS = "conv_id long, turn int, role string, text string, id long, formatted string, key binary, words int"


def table(spark, rows):
    """Conversations with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 7, "x", b"k", 3) for r in rows], ROWS).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


ODD = ["", "a <|im_end|> b", START + "user\n", SEP, "<\\|", "<\\\\|im_end|>", "<", "|", "<<|x", "%3C\n%", "é🙂\n", END + "\n" + START]


def chats():
    rng = np.random.default_rng(3)
    rows = [(1, None, None, None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "z")]
    rows += [(2, 0, "assistant", ""), (3, 5, "we\nird%<|im_end|>", "x"), (3, 4, None, "y"), (None, 0, "user", "q"), (None, 1, "assistant", "r")]
    roles = ["user", "assistant", "system", ""]
    for conv in range(10, 60):
        for turn in range(int(rng.integers(1, 9))):
            rows.append((conv, turn, roles[rng.integers(0, 4)], "".join(rng.choice(ODD, int(rng.integers(0, 4))))))
    rows += [(99, t, "assistant", "w" * 50_000) for t in range(3)] + [(98, t, roles[t % 2], f"t{t}") for t in range(700)]
    return rows


def by_conversation(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(v)] for c, v in out.items()}


def test_every_turn_can_be_read_back(spark):
    rows = chats()
    formatted = chat_format(table(spark, rows))
    read = {r["conv_id"]: [(t["role"], t["text"], t["loss"]) for t in r["turns"]] for r in read_back(formatted).collect()}
    assert read == {c: [(r, t, r == "assistant") for r, t in v] for c, v in by_conversation(rows).items()}


def test_adjacent_turns_of_a_role_share_a_block(spark):
    for r in chat_format(table(spark, chats())).collect():
        turns = by_conversation(chats())[r["conv_id"]]
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert r["formatted"].count(START) == r["formatted"].count(END) == blocks
        assert r["formatted"].count(SEP) == len(turns) - blocks
        at, trained = 0, []
        for run in r["loss_runs"]:
            if run["loss"]:
                trained.append(r["formatted"][at : at + run["chars"]])
            at += run["chars"]
        assert at == len(r["formatted"]) and len(trained) == sum(role == "assistant" for role, _ in turns)


def test_digests_are_those_of_the_turns(spark):
    rows = chats()
    got = {r["conv_id"]: r for r in format_digests(chat_format(table(spark, rows))).collect()}
    for conv, turns in by_conversation(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = got.pop(conv)
        assert (row["n_turns"], row["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha(loss))
    assert not got


def test_a_mask_that_does_not_fit_is_an_error(spark):
    formatted = chat_format(table(spark, [(1, 0, "user", "abc"), (1, 1, "assistant", "d")]))
    from pyspark.sql import functions as F

    torn = formatted.withColumn("formatted", F.replace("formatted", F.lit("abc"), F.lit("abcd")))
    with pytest.raises(Exception, match="do not fit"):
        read_back(torn).collect()


def test_formatting_runs_without_python_and_takes_an_empty_table(spark):
    formatted = format_digests(chat_format(table(spark, chats())))
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hash") == 1
    assert format_digests(chat_format(table(spark, []))).collect() == []


def test_conversation_minus_one_is_added(spark, sf):
    row = QUERIES["op11_chat_formatting"](spark, sf).where("conv_id = -1").collect()
    said = f"{END}{START}assistant ok"
    assert [(r["n_turns"], r["turns_sha256"], r["loss_sha256"]) for r in row] == [
        (2, sha(f"user\n{said}\nassistant\n{said}\n"), sha(said))
    ]


# ---- The trie --------------------------------------------------------------------------------


def digest(turn):
    role, text = turn
    return sha(f"{len(role)}:{role}{text}")[:32]


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), digest((role or "", text or "")), (role or "", text or "")))
    own = {c: [t[2] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute_trie(paths):
    members = defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        words = len([w for w in p[-1][1].translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += not children[p]
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.add((min(m), len(p), parent, len(m), children[p], leaves[p], saved[p], sha(ends)))
    return out


def trie_rows(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def talks():
    """A third of the conversations are copies of one; others share heads, some lose all turns or lend none."""
    rng = np.random.default_rng(8)
    rows = [(None, 0, "user", "nobody"), (0, 0, "user", "only turn"), (20, 1, None, None), (20, None, "user", "first"), (41, 0, "user", "a"), (61, 0, "", "")]
    rows += [(c, t, "user" if t % 2 else "assistant", f"the same\x0btext\x1f {t}") for c in range(1000, 1400) for t in range(3)]
    for c in range(100, 500):
        for t in range(int(rng.integers(0, 7))):
            rows.append((c, t, ["user", "system"][rng.integers(0, 2)], " ".join(["x"] * int(rng.integers(0, 3)))))
    rows += [(600, t, "user", f"deep {t}") for t in range(500)] + [(601, t, "user", f"deep {t}") for t in range(480)]
    rows += [(5000, 0, "user", "tie"), (5000, 0, "assistant", "tie"), (5000, 0, "user", "tie"), (7001, 0, "user", "no leader")]
    return rows


@pytest.mark.parametrize("shard", [1, 300, 5_000, 1 << 30])
def test_trie_is_that_of_brute_force_however_it_is_cut(spark, shard):
    rows = talks()
    paths = borrowed_heads(turn_paths(table(spark, rows)))
    assert trie_rows(prefix_trie(paths, least_shard=shard)) == brute_trie(rebuilt(rows))


def test_trie_of_plain_paths_of_one_and_of_none(spark):
    assert trie_rows(prefix_trie(turn_paths(table(spark, [])))) == set()
    one = [(5, 0, "user", "a b"), (None, 1, "user", "c")]
    assert trie_rows(prefix_trie(turn_paths(table(spark, one)))) == brute_trie({5: [("user", "a b")]})


def test_copies_of_one_conversation_spread_over_shards(spark):
    from pyspark.sql import functions as F

    keys = spark.range(3000).select(F.col("id").alias("conv_id"), F.unhex(F.lit("ab" * 32)).alias("key"))
    splitters = splitters_of(keys, least_shard=20_000)
    assert len(splitters) > 8 and {k for k, _ in splitters} == {b"\xab" * 32}
    bounds = [0, *[c for _, c in splitters], 3000]
    assert max(b - a for a, b in zip(bounds, bounds[1:])) < 1200
    assert len(skeleton_of(splitters).nodes.depth) == 3
