"""Heap Lloyd against plain Lloyd with exact whole numbers."""

import collections
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import heap_lloyd


def lloyd(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Codes, errors, errors of labels and the digest, in plain Python numbers."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(ordered[0][1])
    kept = [r for r in kept if len(r[1]) == width]
    w = width // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(r[1], p) for r in [o for o in ordered if len(o[1]) == width][:entries]] for p in range(parts)]

    def nearest(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = collections.defaultdict(list)
            for _, v, _ in kept:
                groups[nearest(cut(v, p), book)[0]].append(cut(v, p))
            books[p] = [[sum(c) // len(g) for c in zip(*g, strict=True)] if (g := groups.get(e)) else book[e] for e in range(len(book))]
    said = [(i, [nearest(cut(v, p), books[p]) for p in range(parts)], label) for i, v, label in kept]
    of_label = collections.Counter()
    for _, near, label in said:
        of_label[label] += sum(d for _, d in near)
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return collections.Counter((i, "".join(f"{e:02x}" for e, _ in near), sum(d for _, d in near), of_label[label], digest) for i, near, label in said)


def vectors(n, width, seed, levels=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) + 3 * rng.normal(size=(9, width))[rng.integers(0, 9, n)]
    x = np.round(x * levels) / levels if levels else x / np.linalg.norm(x, axis=1)[:, None]
    return [(i, v, i % 4 or None) for i, v in enumerate(x.astype(np.float32).tolist())]


@pytest.mark.parametrize(("rows", "entries", "rounds"), [(vectors(500, 8, 1), 16, 4), (vectors(400, 8, 2, levels=1), 16, 5), (vectors(300, 12, 3), 256, 2), (vectors(40, 4, 4), 256, 4), ([(0, [0.5] * 4, 1)], 256, 4)])
def test_equals_plain_lloyd(spark, rows, entries, rounds, monkeypatch):
    monkeypatch.setattr(heap_lloyd, "BLOCK_BYTES", 64)  # blocks of 64 rows
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = collections.Counter(tuple(r) for r in heap_lloyd.compress(frame, entries=entries, rounds=rounds).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    assert got == lloyd(rows, entries=entries, rounds=rounds)


def test_odd_rows(spark):
    rows = vectors(60, 8, 5)
    rows += [(100, None, 1), (101, [None] * 8, 1), (102, [float("nan")] * 8, 2), (103, [float("inf")] + [0.0] * 7, 2), (104, [1.0] * 4, 3), (105, [], 1), rows[3], rows[3], (None, [0.1] * 8, None), (None, [300.25] * 8, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"code": F.lit("x"), "error": F.lit(1), "id": F.lit(2), "v": F.lit("z"), "ids": F.lit("y"), "_part": F.lit(0)})
    got = collections.Counter(tuple(r) for r in heap_lloyd.compress(frame, entries=8).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    assert got == lloyd([r for r in rows if r[1] is None or len(r[1]) == 8], entries=8)
    assert heap_lloyd.compress(frame.limit(0)).count() == 0
    with pytest.raises(Exception, match="too large"):
        heap_lloyd.compress(spark.createDataFrame([(1, [1e30] * 4, 1)], "vec_id long, embedding array<double>, label int")).count()


def test_many_labels_are_joined_alike(spark, monkeypatch):
    rows = [(i, v, i // 2) for i, v, _ in vectors(200, 8, 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(heap_lloyd, "FEW_LABELS", 3)
    got = collections.Counter(tuple(r) for r in heap_lloyd.compress(frame, entries=16).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    assert got == lloyd(rows, entries=16)


def test_heaps_measure_only_what_drift_may_have_moved():
    """Far groups whose entries barely move: after the first round hardly any part is measured, and all entries are right."""
    rng = np.random.default_rng(7)
    centres = rng.integers(-2000, 2000, (8, 4))
    x = centres[rng.integers(0, 8, 4000)] + rng.integers(-20, 20, (4000, 4))
    now, _, slack = heap_lloyd.nearest(x, centres)
    heaps, drift = heap_lloyd.Heaps.of(now, slack, 8), np.zeros(8)
    measured = 0
    for step in range(6):
        moved = centres + rng.integers(-2, 3, centres.shape)
        own = np.sqrt(((moved - centres) ** 2).sum(1))
        drift, centres = drift + own + own.max(), moved
        heaps, rows, _, _ = heaps.moved(x, centres, drift)
        measured += len(rows)
        assert (heaps.entry() == heap_lloyd.distances(x, centres).argmin(1)).all(), step
        for e, (a, n) in enumerate(zip(np.cumsum(heaps.counts) - heaps.counts, heaps.counts, strict=True)):
            keys = heaps.keys[a : a + n]
            assert all(keys[(k - 1) // 2] <= keys[k] for k in range(1, n)), e
    assert measured < 400
