"""Vector code compression: product codes with codebooks fitted by Heap Lloyd.

Components are scaled and floored to whole numbers, vectors cut into equal consecutive parts, and
each position of parts gets a codebook by Lloyd's algorithm. The rows lie in blocks, and a block
keeps for each part position one heap per entry: its parts, keyed by the lower bound of the distance
to all other entries less the upper bound of that to its own (in roots). When entries move, an
entry's own drift and the largest drift of the others use that slack up. The drifts are added up per
entry, and a key is stored as slack plus the sum at that time, so nothing in a heap need be touched
as they grow: a heap whose smallest key is above the sum holds only parts that stay. From the others,
parts are popped while their bound may be violated, measured exactly against all entries, and pushed
to the heap of the nearest. Ties have no slack, so they are always measured and go to the lower index.

A round reads the blocks and writes them with their heaps and with the sums of the parts that moved;
tasks add these up, and the driver gets one sum per entry and component: the size of the codebooks,
whatever the input. Blocks are bounded in bytes and written to the shared folder in every round.

Rows whose vector is null or holds a null or non-finite component are dropped, and so are vectors
whose length isn't that of the first row kept, empty ones, and all if it doesn't part evenly. The
first codebook's rows are the smallest keys; null keys come last, and equal keys are ordered by
their vectors. Repeated rows are coded like any others. With fewer rows than entries, there are as
many entries as rows. An empty table gives an empty result; extra columns are ignored. Whole numbers
must be small enough for a squared distance in 64 bits; larger ones are refused with an error.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Bytes of whole numbers in a block.
BLOCK_BYTES = 2 << 20
#: Parts measured against all entries at once.
SCAN_ROWS = 4096
#: Labels whose sums are broadcast; more are joined by a shuffle.
FEW_LABELS = 1 << 16
#: Bounds are roots in double precision; slack below this counts as none.
MARGIN = 1e-3


def usable(vector: Column) -> Column:
    """The vector and all its components are there and finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, odd) & (F.size(vector) > 0)


def whole(vectors, scale: int) -> np.ndarray:
    """Scaled and floored components of vectors of one length."""
    x = np.floor(np.asarray(vectors, np.float64) * scale)
    if x.size and not np.abs(x).max() < 2.0**31:
        raise ValueError("a component is too large for squared distances in 64 bits")
    return x.astype(np.int64)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to each entry."""
    reach = int(np.abs(x).max(initial=0)) + int(np.abs(entries).max(initial=0))
    most = x.shape[1] * reach * reach
    if most >= 1 << 63:
        raise ValueError("components are too large for squared distances in 64 bits")
    if most < 1 << 51:  # sums of products are whole numbers that doubles hold
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    return ((x[:, None, :] - entries[None, :, :]) ** 2).sum(2)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest entry, its squared distance, and the slack to the second-nearest."""
    found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    step = max(1, SCAN_ROWS * 16 // max(16, x.shape[1]))
    for at in range(0, len(x), step):
        d = distances(x[at : at + step], entries)
        rows, one = np.arange(len(d)), d.argmin(1)
        near = d[rows, one].copy()
        if d.shape[1] > 1:
            d[rows, one] = d.max() + 1
            slack = np.sqrt(d.min(1)) - np.sqrt(near)
        else:
            slack = np.full(len(d), np.inf)
        for out, value in zip(found, (one, near.astype(np.int64), slack), strict=True):
            out.append(value)
    return tuple(np.concatenate(f) for f in found)


class Heaps:
    """The heaps of a block's parts at one position: keys and rows in heap order, entry after entry."""

    def __init__(self, order: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> None:
        self.order, self.keys, self.counts = order, keys, counts

    @classmethod
    def of(cls, entry: np.ndarray, slack: np.ndarray, entries: int) -> Heaps:
        """A sorted run is a heap."""
        order = np.lexsort((slack, entry))
        return cls(order.astype(np.int32), slack[order], np.bincount(entry, minlength=entries).astype(np.int32))

    @classmethod
    def read(cls, data: bytes, rows: int, entries: int) -> Heaps:
        order, counts = np.frombuffer(data, np.int32, rows), np.frombuffer(data, np.int32, entries, 4 * rows)
        return cls(order, np.frombuffer(data, np.float64, rows, 4 * (rows + entries)), counts)

    def bytes(self) -> bytes:
        return self.order.tobytes() + self.counts.tobytes() + self.keys.tobytes()

    def entry(self) -> np.ndarray:
        """The entry of each row."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.repeat(np.arange(len(self.counts)), self.counts)
        return out

    def moved(self, x: np.ndarray, entries: np.ndarray, drift: np.ndarray) -> tuple[Heaps, np.ndarray, np.ndarray, np.ndarray]:
        """Heaps under new entries whose drifts add up to ``drift``; with the rows measured, their entries before and after."""
        ends = np.cumsum(self.counts)
        starts = ends - self.counts
        held = np.flatnonzero(self.counts)
        hit = held[self.keys[starts[held]] <= drift[held] + MARGIN]
        lists: dict[int, list] = {}

        def opened(e: int) -> list:
            if e not in lists:
                part = slice(starts[e], ends[e])
                lists[e] = list(zip(self.keys[part].tolist(), self.order[part].tolist(), strict=True))
            return lists[e]

        popped, came = [], []
        for e in hit.tolist():
            heap, bound = opened(e), float(drift[e]) + MARGIN
            while heap and heap[0][0] <= bound:
                popped.append(heapq.heappop(heap)[1])
                came.append(e)
        rows = np.array(popped, np.int64)
        now, _, slack = nearest(x[rows], entries)
        for e, key, row in zip(now.tolist(), (slack + drift[now]).tolist(), popped, strict=True):
            heapq.heappush(opened(e), (key, row))
        if not lists:
            return self, rows, np.array(came, np.int64), now
        keys, order, counts = [], [], self.counts.copy()
        for e in range(len(counts)):
            if e in lists:
                counts[e] = len(lists[e])
                keys.append(np.array([k for k, _ in lists[e]], np.float64))
                order.append(np.array([r for _, r in lists[e]], np.int32))
            else:
                keys.append(self.keys[starts[e] : ends[e]])
                order.append(self.order[starts[e] : ends[e]])
        return Heaps(np.concatenate(order), np.concatenate(keys), counts), rows, np.array(came, np.int64), now


class Codebooks:
    """Entries of all part positions, the sums and counts of their parts, and the drifts added up."""

    def __init__(self, first: np.ndarray, parts: int) -> None:
        self.entries = first.reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
        self.sums = np.zeros_like(self.entries)
        self.counts = np.zeros(self.entries.shape[:2], np.int64)
        self.drift = np.zeros(self.entries.shape[:2])

    def update(self, changes: DataFrame) -> None:
        """Add the changes of all blocks, move the entries, and add their drifts up."""
        wide = self.entries.shape[2] + 1
        shape = (*self.entries.shape[:2], wide)

        def added(batches):
            total = np.zeros(shape, np.int64)
            for batch in batches:
                for data in batch.column(0):
                    total += np.frombuffer(data.as_py(), np.int64).reshape(shape)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "value"])

        cells = changes.select("changes").mapInArrow(added, "at long, value long").groupBy("at").agg(F.sum("value").alias("value"))
        with common.batches_of(changes.sparkSession, 16):
            rows = cells.collect()  # at most one row for each component of an entry and each count
        total = np.zeros(shape, np.int64).ravel()
        for row in rows:
            total[row["at"]] = row["value"]
        total = total.reshape(shape)
        self.sums += total[:, :, :-1]
        self.counts += total[:, :, -1]
        moved = np.where(self.counts[:, :, None] > 0, self.sums // np.maximum(self.counts, 1)[:, :, None], self.entries)
        step = np.sqrt(((moved - self.entries).astype(np.float64) ** 2).sum(2))
        for own, total_drift in zip(step, self.drift, strict=True):
            top = own.argmax()
            others = np.full(len(own), own[top])
            others[top] = np.delete(own, top).max(initial=0.0)
            total_drift += own + others
        self.entries = moved

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _points(data: bytes, rows: int, parts: int) -> np.ndarray:
    """Part positions, rows, components."""
    kind = np.dtype(f"i{data[0]}")
    return np.frombuffer(data, kind, offset=1).reshape(rows, parts, -1).transpose(1, 0, 2).astype(np.int64)


def _change(points: np.ndarray, entries: int, rows, before, after) -> np.ndarray:
    """What the parts of some rows add to the entries they came to and take from those they left."""
    out = np.zeros((entries, points.shape[1] + 1), np.int64)
    x = np.concatenate([points[rows], np.ones((len(rows), 1), np.int64)], axis=1)
    np.add.at(out, after, x)
    if before is not None:
        np.subtract.at(out, before, x)
    return out


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """Key, code of each vector, its error, the error of its label, and the digest of the codebooks."""
    rows = vectors.where(usable(F.col(vector))).select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    order = (F.col("id").asc_nulls_last(), F.col("v"))
    widths = rows.orderBy(*order).select(F.size("v").alias("n")).limit(1).collect()
    width = widths[0].n if widths and widths[0].n % parts == 0 else -1
    rows = rows.where(F.size("v") == width)
    first = rows.orderBy(*order).limit(entries).select("v").collect()  # as many rows as entries
    id_type, label_type = (rows.schema[c].dataType for c in ("id", "label"))
    if not first:
        return vectors.sparkSession.createDataFrame([], f"{key} {id_type.simpleString()}, code string, error long, label_error long, codebooks_sha256 string")
    books = Codebooks(whole([r.v for r in first], scale), parts)
    entries, block_rows = len(first), max(64, BLOCK_BYTES // (8 * width))
    fields = f"ids array<{id_type.simpleString()}>, labels array<{label_type.simpleString()}>, points binary, heaps array<binary>, changes binary"
    names = [f.split()[0] for f in fields.split(", ")]

    def as_block(columns, chosen: Codebooks):
        ids, labels, x = columns
        flat = _narrow(x)
        of_parts = x.reshape(len(x), parts, -1).transpose(1, 0, 2)
        heaps, changes = [], []
        for p, points in enumerate(of_parts):
            now, _, slack = nearest(points, chosen.entries[p])
            heaps.append(Heaps.of(now, slack, entries).bytes())
            changes.append(_change(points, entries, np.arange(len(points)), None, now))
        values = [ids, labels, bytes([flat.dtype.itemsize]) + flat.tobytes(), heaps, np.stack(changes).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, arrow, strict=True)], names)

    arrow_ids, arrow_labels = (pa.list_(_arrow_type(t)) for t in (id_type, label_type))
    arrow = [arrow_ids, arrow_labels, pa.binary(), pa.list_(pa.binary()), pa.binary()]
    start = books

    def built(batches):
        ids, labels, x = [], [], []
        for batch in common.sliced(batches, block_rows):
            ids += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
            x.append(whole(batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width), scale))
            while len(ids) >= block_rows:
                held = np.concatenate(x)
                yield as_block((ids[:block_rows], labels[:block_rows], held[:block_rows]), start)
                ids, labels, x = ids[block_rows:], labels[block_rows:], [held[block_rows:]]
        if ids:
            yield as_block((ids, labels, np.concatenate(x)), start)

    with common.Scratch() as tmp:
        blocks = tmp.stored(rows.mapInArrow(built, fields), "vector-blocks", rows=2000)
        for done in range(rounds):
            books.update(blocks)
            if done < rounds - 1:
                following = tmp.stored(blocks.mapInArrow(_stepped(books, parts, arrow, names), fields), "vector-blocks", rows=4)
                tmp.drop(blocks)
                blocks = following
        final = _coded(books, parts, _arrow_type(id_type), _arrow_type(label_type))
        coded = tmp.stored(blocks.mapInArrow(final, f"id {id_type.simpleString()}, label {label_type.simpleString()}, code string, error long"), "vector-codes", rows=4)
        sums = tmp.stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
        if sums.count() <= FEW_LABELS:
            said = coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")))
        else:  # rows of a hot label are dealt over 32 keys
            spread = sums.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(31))))
            said = coded.withColumn("_own", F.pmod(F.xxhash64("id", "code"), F.lit(32)).cast("int")).join(spread, F.col("label").eqNullSafe(F.col("of")) & (F.col("_own") == F.col("_part")))
        out = said.select(F.col("id").alias(key), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
        return common.stored(out, "vector-compression", rows=10_000)


def _arrow_type(of):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(of)


def _each(batches, parts: int):
    """Columns, points and heaps of each block."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids, labels, data, heaps = (batch.column(c)[k] for c in range(4))
            n = len(ids)
            points = _points(data.as_py(), n, parts)
            yield ids, labels, data, points, [h.as_py() for h in heaps]


def _stepped(books: Codebooks, parts: int, arrow: list, names: list):
    """A round's task: heaps brought up to date, and what the moved parts change."""
    entries, drift = books.entries.copy(), books.drift.copy()

    def run(batches):
        for ids, labels, data, points, heaps in _each(batches, parts):
            new, changes = [], []
            for p in range(parts):
                after, rows, came, now = Heaps.read(heaps[p], len(ids), len(entries[p])).moved(points[p], entries[p], drift[p])
                new.append(after.bytes())
                other = came != now
                changes.append(_change(points[p], len(entries[p]), rows[other], came[other], now[other]))
            values = [ids.as_py(), labels.as_py(), data.as_py(), new, np.stack(changes).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, arrow, strict=True)], names)

    return run


def _coded(books: Codebooks, parts: int, id_type, label_type):
    """The last assignment: codes and exact errors."""
    entries, drift = books.entries.copy(), books.drift.copy()

    def run(batches):
        for ids, labels, _, points, heaps in _each(batches, parts):
            codes, error = np.empty((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
            for p in range(parts):
                of = Heaps.read(heaps[p], len(ids), len(entries[p])).moved(points[p], entries[p], drift[p])[0].entry()
                codes[:, p] = of
                error += ((points[p] - entries[p][of]) ** 2).sum(1)
            text = pa.array([row.tobytes().hex() for row in codes], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids.as_py(), id_type), pa.array(labels.as_py(), label_type), text, pa.array(error)], ["id", "label", "code", "error"])

    return run
