"""Conversation prefix trie: range shards finish their own nodes, the splitters' paths are combined by reduction."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import groups, stored

DIGEST = 16
# A shard's paths: few bytes while the table is small, so that it spreads; never more than a task holds easily.
LEAST_SHARD, MOST_SHARD, USUAL_SHARDS = 256 << 10, 16 << 20, 1024
SAMPLED_PER_SHARD = 16
SAMPLED_BYTES = 128 << 20
SKELETON_BYTES = 16 << 20


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits, in hex, that stand for a turn's role and text."""
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)


def turn_paths(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Per conversation: conv_id, path as array of (digest, words) in the order of its turns.

    Turns go by number, null first, and those of one number by digest; a null role or text is empty.
    Digests leave for the shuffle in place of the texts. Rows of a null id belong to no conversation.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    words = F.regexp_count(text(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("int")
    turn = F.struct(F.col(turn_col).alias("turn"), turn_digest(text(role_col), text(text_col)).alias("digest"), words.alias("words"))
    turns = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), turn.alias("at"))
    path = F.transform(F.sort_array(F.collect_list("at")), lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return turns.groupBy("conv_id").agg(path.alias("path"))


def borrowed_heads(paths: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Paths whose first h turns are those of conversation c - c % group, then their own after the first h.

    h is crc32 of the decimal c modulo ``most``. A conversation with fewer turns lends all of them, an
    absent one none; a path may come out empty.
    """
    own, leader = F.col("conv_id"), F.col("conv_id") - F.col("conv_id") % group
    lent = F.max(F.when(own == leader, F.slice("path", 1, most - 1))).over(Window.partitionBy(leader))
    h = (F.crc32(own.cast("string")) % most).cast("int")
    head = F.when(lent.isNotNull(), F.slice(lent, F.lit(1), h)).otherwise(F.slice("path", 1, 0))
    return paths.select("conv_id", F.concat(head, F.slice("path", h + 1, F.size("path"))).alias("path"))


# ---- One run of sorted paths -----------------------------------------------------------------


@dataclass
class Nodes:
    """The trie of sorted paths; nodes count in preorder, so that a subtree is the range from itself to ``close``."""

    depth: np.ndarray
    parent: np.ndarray
    close: np.ndarray
    row: np.ndarray  # the first row that passes
    end: np.ndarray  # of each row, the node it ends at
    last: np.ndarray  # the nodes on the last row's path

    def below(self, own: np.ndarray) -> np.ndarray:
        """The sum over each node's subtree."""
        run = np.concatenate([[0], np.cumsum(own)])
        return run[self.close] - run[: len(own)]

    def least(self, value: np.ndarray) -> np.ndarray:
        """The least of each node's subtree."""
        out, parent = value.tolist(), self.parent.tolist()
        for v in range(len(out) - 1, 0, -1):
            if out[v] < out[parent[v]]:
                out[parent[v]] = out[v]
        return np.array(out, np.int64)


def turn_ids(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The digests of all keys in a row as pairs of numbers, and where each key's begin (one more at the end)."""
    keys = keys.cast(pa.large_binary())
    offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset : keys.offset + len(keys) + 1]
    data = keys.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return flat.view(np.uint64).reshape(-1, 2), (offsets - offsets[0]) // DIGEST


def shared_with_last(digests: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many turns each path shares with the path before it; 0 for the first."""
    size = np.diff(first)
    both = np.zeros(len(size), np.int64)
    both[1:] = np.minimum(size[1:], size[:-1])
    head = np.cumsum(both) - both
    step = np.arange(both.sum()) - np.repeat(head, both)
    here = np.repeat(first[:-1], both) + step
    there = np.repeat(np.concatenate([[0], first[:-2]]), both) + step
    apart = np.flatnonzero((digests[here] != digests[there]).any(axis=1))
    row = np.repeat(np.arange(len(size)), both)[apart]
    out = both.copy()
    np.minimum.at(out, row, step[apart])
    return out


def trie(digests: np.ndarray, first: np.ndarray) -> Nodes:
    size, shared = np.diff(first), shared_with_last(digests, first)
    opened = size - shared
    opened[0] += 1  # the root
    base = np.concatenate([[0], np.cumsum(opened)])
    n = base[-1]
    parent = np.arange(-1, n - 1)
    close = np.full(n, n)
    end = np.empty(len(size), np.int64)
    path: list[int] = []
    for i, (keep, low, high) in enumerate(zip((shared + 1).tolist(), base[:-1].tolist(), base[1:].tolist())):
        if i and len(path) > keep:
            close[path[keep:]] = low
            del path[keep:]
        if high > low:
            if i:
                parent[low] = path[-1]
            path.extend(range(low, high))
        end[i] = path[-1]
    row = np.repeat(np.arange(len(size)), opened)
    step = np.arange(n) - base[:-1][row]
    depth = np.where(row > 0, shared[row] + 1, 0) + step
    return Nodes(depth, parent, close, row, end, np.array(path))


def common_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // DIGEST * DIGEST
    x, y = (np.frombuffer(k[:n], np.uint64).reshape(-1, 2) for k in (a, b))
    apart = np.flatnonzero((x != y).any(axis=1))
    return int(apart[0]) if len(apart) else n // DIGEST


# ---- Splitters and their trie ----------------------------------------------------------------


@dataclass
class Skeleton:
    """The splitters (path, conv_id) in order, and the trie of their paths."""

    splitters: list[tuple[bytes, int]]
    nodes: Nodes | None
    paths: list[np.ndarray]  # of each splitter, the nodes on its path, root first


def skeleton_of(splitters: list[tuple[bytes, int]]) -> Skeleton:
    if not splitters:
        return Skeleton([], None, [])
    nodes = trie(*turn_ids(pa.array([k for k, _ in splitters], pa.large_binary())))
    paths = []
    for node in nodes.end.tolist():
        path = [node]
        while path[-1]:
            path.append(int(nodes.parent[path[-1]]))
        paths.append(np.array(path[::-1]))
    return Skeleton(splitters, nodes, paths)


def splitters_of(keys: DataFrame, least_shard: int = LEAST_SHARD) -> list[tuple[bytes, int]]:
    """Bounds between shards of about equal bytes, from a hash sample of the rows.

    The sample holds about 16 rows a shard and 128 MiB at most, the splitters 16 MiB; if paths are so
    long that this is too little, shards grow. A splitter holds the conv_id too, so copies of one
    conversation spread over shards.
    """
    bytes_of = F.length("key") + 32
    total = keys.agg(F.count("*").alias("n"), F.sum(bytes_of).alias("bytes")).first()
    if not total["n"]:
        return []
    shard = min(max(total["bytes"] // USUAL_SHARDS, least_shard), max(MOST_SHARD, least_shard))
    shards = math.ceil(total["bytes"] / shard)
    if shards == 1:
        return []
    rate = min(1.0, SAMPLED_PER_SHARD * shards / total["n"], SAMPLED_BYTES / total["bytes"])
    limit = min(int(-(2**63) + rate * 2**64), 2**63 - 1)
    sample = keys.where(F.xxhash64("conv_id") <= F.lit(limit)).select("key", "conv_id").collect()
    rows = sorted((bytes(r["key"]), r["conv_id"]) for r in sample)
    if not rows:
        return []
    until = np.cumsum([len(k) + 32 for k, _ in rows])
    at = np.searchsorted(until, until[-1] * np.arange(1, shards) / shards)
    chosen = sorted({rows[i] for i in at.tolist()})
    while len(chosen) > 1 and sum(len(k) for k, _ in chosen) > SKELETON_BYTES:
        chosen = chosen[1::2]
    return chosen


def _dealt(skeleton):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        bounds = skeleton.value.splitters
        for batch in batches:
            rows = zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(bounds, row) for row in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *batch.columns], names=["shard", *batch.schema.names])

    return run


EMPTY = hashlib.sha256(b"").hexdigest()
FOUND = (
    "skeleton long, shard int, parent_skeleton long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string, ends binary"
)


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _shards(skeleton):
    """Finished nodes of a shard, and its part of every skeleton node that reaches into it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Skeleton = skeleton.value
        for table in groups(batches, ["shard"]):
            shard = table.column("shard")[0].as_py()
            keys = table.column("key").combine_chunks()
            keys = pa.concat_arrays(keys.chunks) if isinstance(keys, pa.ChunkedArray) else keys
            ids = table.column("conv_id").to_numpy()
            digests, first = turn_ids(keys)
            words = table.column("words").combine_chunks()
            words = pa.concat_arrays(words.chunks) if isinstance(words, pa.ChunkedArray) else words
            words = words.flatten().to_numpy(zero_copy_only=False)
            t = trie(digests, first)
            n = len(t.depth)

            number = np.full(n, -1)
            low, high = keys[0].as_py(), keys[-1].as_py()
            for border, key, path in ((shard - 1, low, np.arange(first[1] + 1)), (shard, high, t.last)):
                if 0 <= border < len(known.splitters):
                    reach = common_turns(key, known.splitters[border][0]) + 1
                    number[path[:reach]] = known.paths[border][:reach]
            own = number < 0

            ending = np.bincount(t.end, minlength=n)
            members = t.below(ending)
            child = np.flatnonzero(t.parent >= 0)
            children = np.bincount(t.parent[child[own[child]]], minlength=n)
            # Of a skeleton node, children and sums leave out what the skeleton adds in the end.
            spoken = np.zeros(n, np.int64)
            deep = t.depth > 0
            spoken[deep] = words[first[:-1][t.row[deep]] + t.depth[deep] - 1]
            leaves = t.below(own & (children == 0))
            saved = t.below(np.where(own, (members - 1) * spoken, 0))
            lowest = np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(lowest, t.end, ids)
            lowest = t.least(lowest)

            digest, ends = [EMPTY] * n, [None] * n
            starts = np.flatnonzero(np.concatenate([[True], t.end[1:] != t.end[:-1]]))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
                node = int(t.end[a])
                if own[node]:
                    digest[node] = hashlib.sha256(_joined(ids[a:b])).hexdigest()
                else:
                    ends[node] = np.ascontiguousarray(ids[a:b]).tobytes()
            up = np.where(t.parent >= 0, t.parent, 0)
            root = t.parent < 0
            hangs = own & ~root & ~own[up]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number, mask=own), pa.array(np.full(n, shard, np.int32)), pa.array(number[up], mask=~hangs),
                    pa.array(lowest), pa.array(t.depth), pa.array(lowest[up], mask=root | ~own | hangs),
                    *map(pa.array, (members, children, leaves, saved, spoken)), pa.array(digest), pa.array(ends, pa.binary()),
                ],
                names=[c.split()[0] for c in FOUND.split(", ")],
            )

    return run


# ---- The skeleton's own nodes ----------------------------------------------------------------


def _finished(skeleton):
    """Skeleton nodes whole: what shards summed, and what their own children and subtrees add."""
    names = ["skeleton", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).sort_by("skeleton")
        get = lambda name: table.column(name).to_numpy()
        t: Nodes = skeleton.value.nodes
        inner = np.bincount(t.parent[1:], minlength=len(t.depth))
        children = get("n_children") + inner
        leaves = get("n_leaves") + t.below(children == 0)
        saved = get("saved_tokens") + t.below((get("n_convs") - 1) * get("words"))
        up = np.where(t.parent >= 0, t.parent, 0)
        conv = get("conv_id")
        columns = [get("skeleton"), conv, t.depth, pa.array(conv[up], mask=t.parent < 0), get("n_convs"), children, leaves, saved]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    return run


def _end_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each skeleton node's ends; its parts come in order and go by one at a time."""
    node, state = None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([state.hexdigest()])], names=["skeleton", "ends_sha256"])
    for batch in batches:
        for i in range(batch.num_rows):
            at = batch.column("skeleton")[i].as_py()
            if at != node:
                if state:
                    yield out()
                node, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(_joined(np.frombuffer(batch.column("ends")[i].as_py(), np.int64)))
    if state:
        yield out()


def prefix_trie(paths: DataFrame, least_shard: int = LEAST_SHARD) -> DataFrame:
    """Every distinct prefix of the paths, from the empty one, with figures of the conversations behind it.

    Takes (conv_id, path as array of (digest, words)), as ``turn_paths`` gives it, one row per conv_id.
    Returns per node: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves (childless nodes of its subtree), saved_tokens (over the subtree, members but
    one times the words of the last turn) and ends_sha256 (the conversations that end here). No paths
    give no nodes; an empty path ends at the root.

    Paths are sorted into ranges. A node whose conversations reach over the border of a range lies on
    the path of the splitter there: those nodes, the skeleton, are broadcast (16 MiB of paths at most)
    and every range gives its part of them; all others are finished where they are. Copies of one
    conversation lie in as many ranges as their rows fill, as conv_id is part of the order. A range
    holds about 16 MiB of digests and is one task's work; so is one conversation, however long. The
    digest of a node's ends runs over them in order, in parts of a range.
    """
    spark = paths.sparkSession
    key = F.unhex(F.array_join(F.transform("path", lambda t: t["digest"]), ""))
    words = F.transform("path", lambda t: t["words"])
    keys = stored(paths.select("conv_id", key.alias("key"), words.alias("words")), "paths")
    skeleton = skeleton_of(splitters_of(keys, least_shard))
    sent = spark.sparkContext.broadcast(skeleton)

    dealt = keys.mapInArrow(_dealt(sent), "shard int, conv_id long, key binary, words array<int>")
    shards = dealt.repartitionById(len(skeleton.splitters) + 1, "shard").sortWithinPartitions("shard", "key", "conv_id")
    found = shards.mapInArrow(_shards(sent), FOUND)
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    if not skeleton.splitters:
        return found.select(*shown)

    found = stored(found, "nodes")
    parts = found.where("skeleton is not null")
    summed = parts.groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    columns = "skeleton long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    whole = summed.repartition(1).mapInArrow(_finished(sent), columns)
    ends = parts.where("ends is not null").select("skeleton", "shard", "ends").repartition("skeleton")
    digests = ends.sortWithinPartitions("skeleton", "shard").mapInArrow(_end_digests, "skeleton long, ends_sha256 string")
    inner = stored(whole.join(digests, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))), "skeleton")
    # As many rows as the skeleton has nodes: a million at most.
    above = F.broadcast(inner.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("above")))
    outer = found.where("skeleton is null").join(above, "parent_skeleton", "left")
    outer = outer.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return outer.select(*shown).unionByName(inner.select(*shown))
