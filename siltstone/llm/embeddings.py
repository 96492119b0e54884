"""Embedding near-duplicates: sign hashes of random hyperplanes, exact cosine, components."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buckets
from .common import forest, groups, mixed, stored
from .components import connected_components

COSINE = 0.95
RECALL = 0.9999
ROWS_PER_BUCKET = 32
BLOCK_ROWS = 2048
MIN_BITS = 4
MAX_BITS = 48
SKETCH_BITS = 128
SKETCH_LOSS = 1e-5


def tables_for(rows: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(tables, bits): bits grow with the logarithm of the rows, tables follow from the recall.

    Two vectors at the threshold fall on one side of a random hyperplane with probability
    1 - angle / pi; all bits of a table agree with that to the power of bits.
    """
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(rows, 1) / ROWS_PER_BUCKET + 1))))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - agree)), bits


def most_different(cosine: float = COSINE, bits: int = SKETCH_BITS, loss: float = SKETCH_LOSS) -> int:
    """In how many of ``bits`` signs two vectors at the threshold differ at most, but for a share of ``loss``."""
    p = math.acos(cosine) / math.pi
    above = 1.0
    for differ in range(bits + 1):
        above -= math.comb(bits, differ) * p**differ * (1 - p) ** (bits - differ)
        if above <= loss:
            return differ
    return bits


def _planes(size: int, n: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, n))


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.float64) for x in column.to_pylist()]


def _checked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector in unit length as bytes, null where it cannot be compared."""
    for batch in batches:
        out = []
        for v in batch.column(1).to_pylist():
            unit = None
            if v and None not in v:
                x = np.array(v, np.float64)
                top = np.abs(x).max()
                if np.isfinite(x).all() and top > 0:
                    x = x / top
                    unit = (x / np.sqrt(x @ x)).tobytes()
            out.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "unit"])


def _hashed(tables: int, bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = np.uint64(1) << np.arange(bits, dtype=np.uint64)
        for batch in batches:
            units = _vectors(batch.column(1))
            sizes = np.array([len(u) for u in units], np.int64)
            keys = np.zeros((len(units), tables), np.uint64)
            sketches = np.zeros((len(units), SKETCH_BITS // 8), np.uint8)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                if int(size) not in planes:
                    planes[int(size)] = _planes(int(size), tables * bits + SKETCH_BITS)
                sides = (np.stack([units[x] for x in at]) @ planes[int(size)]) >= 0
                sketches[at] = np.packbits(sides[:, tables * bits :], axis=1)
                sides = sides[:, : tables * bits]
                code = (sides.reshape(len(at), tables, bits) * weight).sum(axis=2, dtype=np.uint64)
                keys[at] = mixed(code + (np.array([size], np.uint64) << np.uint64(50)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2), pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array([k.tobytes() for k in sketches], pa.binary()),
                ],
                names=["class_id", "unit", "copies", "keys", "sketch"],
            )

    return run


def _promising(differ: int):
    """Of each block pair the rows whose sketch differs from some other row's in ``differ`` bits at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["band", "key", "i", "j"]):
            signs = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(group.num_rows, -1)
            signs = np.unpackbits(signs, axis=1).astype(np.float32) * 2 - 1
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            block = group.column("block").to_numpy()
            a = np.arange(len(signs)) if i == j else np.flatnonzero(block == i)
            b = a if i == j else np.flatnonzero(block == j)
            near = np.zeros(len(signs), bool)
            for low in range(0, len(a), 512):
                part = a[low : low + 512]
                alike = signs[part] @ signs[b].T >= SKETCH_BITS - 2 * differ
                if i == j:
                    alike[np.arange(len(part)), part] = False
                near[part] |= alike.any(axis=1)
                near[b] |= alike.any(axis=0)
            if near.any():
                held = group.drop_columns(["sketch"]).filter(pa.array(near)).combine_chunks()
                yield from held.to_batches()

    return run


def candidates(hashed: DataFrame, tables: int, cosine: float) -> DataFrame:
    """Rows (band, key, i, j, block, class_id) whose vectors are worth to be fetched for an exact comparison.

    Buckets are met with sketches of 16 bytes in place of vectors, so what is shuffled once per table does not
    grow with a vector's length. A pair at the threshold passes but for a share of ``SKETCH_LOSS``.
    """
    members = hashed.selectExpr(
        "class_id", "sketch", "1L as size",
        f"posexplode(transform(sequence(0, {tables - 1}), t -> substring(keys, 8 * t + 1, 8))) as (band, key)",
    )
    pairs = buckets.dealt(members, ["class_id", "sketch"], BLOCK_ROWS, BLOCK_ROWS).repartition("band", "key", "i", "j")
    pairs = pairs.sortWithinPartitions("band", "key", "i", "j")
    return pairs.mapInArrow(
        _promising(most_different(cosine)), "band int, key binary, i int, j int, block int, class_id long"
    )


def _verify(cosine: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["band", "key", "i", "j"]):
            get = lambda name: group.column(name).to_numpy()
            units = np.stack(_vectors(group.column("unit")))
            keys = np.stack([np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()])
            band, i, j = int(get("band")[0]), int(get("i")[0]), int(get("j")[0])
            block, copies, ids = get("block"), get("copies"), get("class_id")
            a = np.arange(len(units)) if i == j else np.flatnonzero(block == i)
            b = a if i == j else np.flatnonzero(block == j)
            found = np.zeros(len(units))
            tree: list[tuple[int, int]] = []
            for low in range(0, len(a), 512):  # 512 rows against the other block: 8 MB of cosines at a time
                part = a[low : low + 512]
                x, y = np.nonzero(units[part] @ units[b].T >= cosine)
                x, y = part[x], b[y]
                new = x < y if i == j else np.ones(len(x), bool)
                x, y = x[new], y[new]
                new = np.ones(len(x), bool)
                for t in range(band):
                    new &= keys[x, t] != keys[y, t]
                x, y = x[new], y[new]
                found += np.bincount(x, copies[y], len(units)) + np.bincount(y, copies[x], len(units))
                tree += forest(len(units), x, y)
            some = np.flatnonzero(found)
            if not len(some):
                continue
            pairs = np.array(tree).reshape(-1, 2).T
            pairs = np.array(forest(len(units), pairs[0], pairs[1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([ids[some], ids[pairs[:, 0]]])),
                    pa.array(np.concatenate([ids[some], ids[pairs[:, 1]]])),
                    pa.array(np.concatenate([found[some], np.zeros(len(pairs))]).astype(np.int64)),
                ],
                names=["a", "b", "n_links"],
            )

    return run


def embedding_near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    recall: float = RECALL,
) -> DataFrame:
    """Per row: id, n_links, component_id, kept.

    Two vectors are linked when their cosine, in double precision, is at least ``cosine``. Vectors that
    point the same way to the last bit are one class, of which one is compared. ``n_links`` counts the
    other rows linked with this one, ``component_id`` is the smallest id reachable by links, ``kept``
    whether that is the row's own. Null, empty and zero vectors, and those with a null or non-finite
    component, link with nothing and are kept, as are rows with a null id. Vectors of different
    lengths are never linked. Of a pair at the threshold ``recall`` is the chance that a table has both
    in one bucket. Every pair of a bucket is compared by sketches, in blocks, and vectors are fetched for
    the rows only that have a partner there within ``most_different`` bits; cosines decide.
    """
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    units = stored(source.mapInArrow(_checked, "id long, unit binary"), "units")
    comparable = units.where("unit is not null and id is not null")
    classes = stored(comparable.groupBy("unit").agg(F.min("id").alias("class_id"), F.count("*").alias("copies")), "classes")
    tables, bits = tables_for(classes.count(), cosine, recall)
    hashed = classes.select("class_id", "unit", "copies").mapInArrow(
        _hashed(tables, bits), "class_id long, unit binary, copies long, keys binary, sketch binary"
    )
    hashed = stored(hashed, "hashed")
    pairs = stored(candidates(hashed, tables, cosine), "candidates")
    dealt = pairs.join(hashed.drop("sketch"), "class_id").repartition("band", "key", "i", "j")
    dealt = dealt.sortWithinPartitions("band", "key", "i", "j", "class_id")
    found = stored(dealt.mapInArrow(_verify(cosine), "a long, b long, n_links long"), "found")
    links = found.where("a = b").groupBy(F.col("a").alias("class_id")).agg(F.sum("n_links").alias("linked"))
    components = connected_components(found.where("a != b")).select(F.col("id").alias("class_id"), "component")
    state = classes.join(links, "class_id", "left").join(components, "class_id", "left").select(
        "unit", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("linked"),
        F.coalesce("component", "class_id").alias("component"),
    )
    linkable = F.when(F.col("id").isNotNull(), F.col("unit")).alias("unit")
    out = units.select("id", linkable).join(state, "unit", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("linked", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
