"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations.

Vectors are compared only within a label. Equal vectors of a label are one class with a count.
In each of ``tables`` tables a class's unit vector is padded to a power of two, turned by random
signs and Hadamard transforms (three times for each hash), and hashed to the closest corner of
the cross-polytope: the largest coordinate and its sign; ``hashes`` corners make a bucket. Probes
put a vector into the buckets of the second-best corner of each hash as well. Pairs that share a
bucket are verified by the cosine in double precision. ``hashes`` grows with the number of rows,
so that buckets don't: one more for each factor of the corners' number.

A pair counts in the smallest bucket that it shares, so nothing need be collected to count links
once: buckets give each class's number of linked vectors, and a spanning forest of their links.
So of buckets with the same members only the smallest can count anything, and vectors are sent to
that one alone; members are compared by their number and 128 bits of hashes.
Buckets above ``block_rows`` are cut into blocks by hash and joined pair of blocks by pair of
blocks, each pair of blocks a task of its own; no partner is dropped.

Vectors that are null, empty, zero, or hold a null or non-finite component, and those without a
label, link with nothing and are kept. Vectors of different lengths aren't compared. Repeated
rows are vectors of their own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.components import Forest, connected
from tidemark.llm.packed import group_runs


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    rows, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, width)
        step *= 2
    return x / np.sqrt(width)


def bucket_keys(x: np.ndarray, tables: int, hashes: int, seed: int) -> np.ndarray:
    """Sorted bucket keys of each row of unit vectors: in each table its own and a probe for each hash."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rng = np.random.default_rng([seed, width])
    every = np.arange(len(x))
    out = []
    for t in range(tables):
        first, second = [], []
        for _ in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width))
            size = np.abs(y)
            one = size.argmax(1)
            first.append(2 * one + (y[every, one] < 0))
            size[every, one] = -1
            two = size.argmax(1)
            second.append(2 * two + (y[every, two] < 0))
        for probe in range(-1, hashes):
            key = np.full(len(x), t, np.int64)
            for h in range(hashes):
                key = key * (2 * width + 1) + (second[h] if h == probe else first[h])
            out.append(key)
    keys = np.sort(np.stack(out, axis=1), axis=1) if out else np.zeros((len(x), 0), np.int64)
    return keys


def usable(vector: Column) -> Column:
    """Whether a vector can be compared."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _units(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _join(ids: np.ndarray, weights: np.ndarray, units: np.ndarray, keys: np.ndarray, bucket: int, least: float, sides: np.ndarray | None):
    """Links of a bucket, or of two of its blocks: linked vectors for each id, and a spanning forest."""
    n = len(ids)
    added, forest, edges = np.zeros(n, np.int64), Forest(n), []
    for low in range(0, n, 256):
        rows = np.arange(low, min(low + 256, n))
        near = units[rows] @ units.T >= least
        near &= rows[:, None] < np.arange(n)[None, :]
        if sides is not None:
            near &= sides[rows][:, None] != sides[None, :]
        i, j = np.nonzero(near)
        i = rows[i]
        for at in range(0, len(i), 1 << 14):
            a, b = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            # only buckets below this one matter: is there a smaller one that both share?
            ka, kb = keys[a], keys[b]
            same = (ka[:, :, None] == kb[:, None, :]).any(2) & (ka < bucket)
            own = ~same.any(1)
            a, b = a[own], b[own]
            np.add.at(added, a, weights[b])
            np.add.at(added, b, weights[a])
            for p, q in zip(a.tolist(), b.tolist(), strict=True):
                if forest.join(p, q):
                    edges.append((int(ids[p]), int(ids[q])))
    return added, edges


def near_duplicates(embeddings: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98, tables: int = 6, hashes: int | None = None, seed: int = 11, block_rows: int = 512) -> DataFrame:
    """Links of cosine ``least`` or more: key, n_links, component_id, kept, as a written table. Keys are integers."""
    with common.Scratch() as tmp:
        return common.stored(_linked(embeddings, key, vector, label, least, tables, hashes, seed, block_rows, tmp), "vectors")


def _linked(embeddings: DataFrame, key: str, vector: str, label: str, least: float, tables: int, hashes: int | None, seed: int, block_rows: int, tmp: common.Scratch) -> DataFrame:
    """Links and components; ``tmp`` holds what is written on the way."""
    import pyarrow as pa

    good = embeddings.where(F.col(label).isNotNull() & usable(F.col(vector)) & F.col(key).isNotNull())
    fingerprint = F.xxhash64(label, vector)
    rows = good.select(F.col(key).cast("long").alias("id"), F.col(label).alias("_label"), F.col(vector).alias("_v"), fingerprint.alias("_f"))
    classes = tmp.stored(rows.groupBy("_label", "_f", "_v").agg(F.min("id").alias("first"), F.count("*").alias("weight")).withColumn("_at", F.xxhash64("_label", F.size("_v"))), "vector-classes", rows=2000)
    if hashes is None:
        total = classes.count()
        width = classes.select(F.max(F.size("_v"))).first()[0] or 1
        corners = 2 << max(1, (width - 1).bit_length())
        hashes = max(2, int(np.ceil(np.log(max(total, 2)) / np.log(corners))))

    def keyed(batches):
        for batch in batches:
            vectors = batch.column(3).to_pylist()
            salt = batch.column(2).to_numpy()
            keys: list = [None] * len(vectors)
            by_size: dict[int, list[int]] = {}
            for k, v in enumerate(vectors):
                by_size.setdefault(len(v), []).append(k)
            for places in by_size.values():
                found = bucket_keys(_units([vectors[k] for k in places]), tables, hashes, seed)
                for k, own in zip(places, found, strict=True):
                    own = (own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(int(salt[k]) & (2**64 - 1))
                    keys[k] = np.unique(own.astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64())), batch.column(3)], ["first", "weight", "keys", "v"])

    of_type = classes.schema["_v"].dataType.simpleString()
    keyed_rows = tmp.stored(classes.select("first", "weight", "_at", "_v").mapInArrow(keyed, f"first long, weight long, keys array<long>, v {of_type}"), "vector-keys", rows=2000)
    members = keyed_rows.select("first", F.explode("keys").alias("bucket"))
    marks = [F.bit_xor(F.xxhash64("first", F.lit(k))).alias(f"mark{k}") for k in (1, 2)]
    shared = members.groupBy("bucket").agg(F.count("*").alias("n"), *marks).where("n > 1")
    counts = tmp.stored(shared.groupBy("n", "mark1", "mark2").agg(F.min("bucket").alias("bucket")).select("bucket", "n"), "buckets")
    slots = F.ceil(F.col("n") / block_rows).cast("int")
    mine = F.pmod(F.xxhash64("first", F.lit("slot")), F.col("slots")).cast("int")
    placed = members.join(counts.withColumn("slots", slots), "bucket").withColumn("slot", mine)
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    low, high = F.least("slot", "other"), F.greatest("slot", "other")
    tasks = other.select("first", "bucket", F.xxhash64("bucket", low, high).alias("task"), F.when(F.col("slot") != F.col("other"), (F.col("slot") > F.col("other")).cast("int")).alias("side"), (low == high).alias("lone"))

    def joined(batches):
        for _, group in group_runs(batches):
            sizes = {len(r[5]) for r in group}
            ids, added, edges = [], [], []
            for size in sizes:
                part = [r for r in group if len(r[5]) == size]
                widths = max(len(r[4]) for r in part)
                keys = np.array([r[4] + [r[4][-1]] * (widths - len(r[4])) for r in part], np.int64)
                sides = None if part[0][2] is None else np.array([r[2] for r in part])
                some, links = _join(np.array([r[3] for r in part], np.int64), np.array([r[6] for r in part], np.int64), _units([r[5] for r in part]), keys, part[0][1], least, sides)
                ids += [r[3] for r in part]
                added += some.tolist()
                edges += links
            linked = [(i, None, n) for i, n in zip(ids, added, strict=True) if n] + [(a, b, 0) for a, b in edges]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in linked], pa.int64()) for k in range(3)], ["a", "b", "n"])

    full = tasks.join(keyed_rows, "first").select("task", "bucket", "side", "first", "keys", "v", "weight")
    found = tmp.stored(full.repartition("task").sortWithinPartitions("task").mapInArrow(joined, "a long, b long, n long"), "vector-links", rows=2000)
    degree = found.where("b IS NULL").groupBy(F.col("a").alias("first")).agg(F.sum("n").alias("_n"))
    components = connected(found.where("b IS NOT NULL").select("a", "b"))
    tmp.frames.append(components)
    roots = components.withColumnRenamed("node", "first")
    said = classes.join(degree, "first", "left").join(roots, "first", "left").select("_label", "_f", "_v", (F.coalesce("_n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "first").alias("component_id"))
    of_rows = embeddings.select(F.col(key).alias(key), F.col(label).alias("_label"), F.col(vector).alias("_v"), F.when(F.col(label).isNotNull() & usable(F.col(vector)) & F.col(key).isNotNull(), fingerprint).alias("_f"))
    out = of_rows.join(said, ["_label", "_f", "_v"], "left").select(key, F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", F.col(key).cast("long")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
