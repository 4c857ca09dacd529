"""Exact n-gram Jaccard join with signature trees.

1. Documents with the same set of shingles are one class; its smallest key stands for it.
2. Sets that can't link are kept apart exactly. In one order of all shingles, rare before
   common, a set of n has its first n - ceil(t n) + 1 shingles as its prefix; two sets that
   reach the threshold t share the smallest of their common shingles in both prefixes. Sets
   meet where prefixes share a shingle; pairs whose sizes or bitmaps rule a link out are left
   out, and the components of the rest are the groups: a link never leaves its group. The order
   need not be exact about what is rare, only the same for all sets, so occurrences are counted in a table of ``COUNTERS`` cells by hash, whose size
   doesn't depend on the data; a passage that many documents share so comes last in each.
   The larger the input, the more shingles meet in a cell, until passages of some dozen documents
   look as rare as any other. Prefixes then join what has little in common, and a group grows to a
   large part of the table. Where blocks would so be sent ``SENT`` times and more, shingles that
   are in more than ``FEW`` prefixes are marked in a table of ``MARKS`` bits, come last from then
   on, and the sets with a marked one in their prefix get another. That is done ``ROUNDS`` times at most;
   the order is still the same for all sets.
3. A group, or a pair of blocks of a large group, is one task's work. Its sets are sorted by
   size into the leaves of a signature tree, whose nodes hold the OR of their members' token
   bitmaps and their range of sizes. A dual traversal walks pairs of nodes and leaves out those
   whose largest possible overlap falls short, by size and by bitmap, and those that lie in one
   component already; pairs of leaves that are left are counted exactly.
4. The links found (a spanning forest of each task's, so never more than its members) are
   joined to components.

Groups above ``block_rows`` are cut into blocks by size and hash, and only blocks whose sizes
can meet are paired, so no task holds more than two blocks. Words are runs of bytes other than
space and the ASCII controls 9 to 13, with A-Z lower-cased. Null texts and texts without a word
have an empty set and link with nothing. Repeated keys count as one document if their texts
agree; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.components import Forest, connected
from tidemark.llm.packed import cut_points, deltas, group_runs, mix, packed, unpacked

BITS = 512
LEAF = 32
COUNTERS = 1 << 21
MARKS = 1 << 24
FEW = 16
SENT = 4
ROUNDS = 4
WIDEST = 1 << 14
U = np.uint64


class Words(dict):
    """64-bit hashes of words, made once for each word of a task's current texts."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, n: int, words: Words) -> np.ndarray:
    """Sorted distinct hashes of a text's n-word shingles; all words as one if there are fewer."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(common.LOWER_BYTES).split()
    if not parts:
        return np.empty(0, U)
    h = np.array(list(map(words.__getitem__, parts)), U)
    width = min(n, len(h))
    count = len(h) - width + 1
    mixed = np.full(count, U(width))
    for k in range(width):
        mixed = mix(mixed * U(0x9E3779B97F4A7C15) + h[k : k + count])
    return np.unique(mixed)


def commonness(documents: DataFrame, text: str, n: int, width: int = 1 << 16) -> np.ndarray:
    """A byte for each cell of the table: how often shingles that hash there occur, in quarters of a power of two.

    Tasks add up their own cells; cells go on packed, by ranges of ``width``, and are added there.
    """
    import pyarrow as pa

    def count(batches):
        words, cells = Words(), np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                np.add.at(cells, (shingles(t, n, words) & U(COUNTERS - 1)).astype(np.int64), 1)
        for k in range(COUNTERS // width) if cells.any() else []:
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packed(cells[k * width : (k + 1) * width])], pa.binary())], ["range", "cells"])

    def add(batches):
        for k, rows in group_runs(batches):
            total = np.zeros(width)
            for r in rows:
                total += unpacked(r[1])[0]
            level = np.minimum(np.floor(4 * np.log2(1 + total)), 127).astype(np.uint8)  # the order's first bit is for marks
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["range", "cells"])

    kind = "range int, cells binary"
    sums = documents.select(text).mapInArrow(count, kind).repartition("range").sortWithinPartitions("range").mapInArrow(add, kind)
    out = np.zeros(COUNTERS, np.uint8)
    with common.batches_of(documents.sparkSession):
        rows = sums.collect()  # COUNTERS bytes in all
    for row in rows:
        out[row["range"] * width : (row["range"] + 1) * width] = np.frombuffer(row["cells"], np.uint8)
    return out


def prefix_keys(hashes: np.ndarray, percent: int, common_: np.ndarray, late: np.ndarray | None = None) -> np.ndarray:
    """Sorted keys of a set's prefix in the order of (whether ``late`` has the key, commonness, hash)."""
    size = len(hashes)
    if not size:
        return hashes
    length = size + (-percent * size // 100) + 1
    order = (common_[(hashes & U(COUNTERS - 1)).astype(np.int64)].astype(U) << U(56)) | (hashes >> U(8))
    if length < size:
        if late is None:
            order = np.partition(order, length - 1)[:length]
        else:
            order = np.partition(order | (_is_marked(late, mix(order)).astype(U) << U(63)), length - 1)[:length] & U((1 << 63) - 1)
    return np.unique(mix(order))


def _cell(keys: np.ndarray) -> np.ndarray:
    """The bits of scrambled keys among ``MARKS``."""
    return (keys >> U(64 - (MARKS.bit_length() - 1))).astype(np.int64)


def _is_marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _cell(keys)
    return (marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _own_cell(column) -> np.ndarray:
    """The scrambled keys of a column of sets' own keys."""
    return mix(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U))


def _marks(cells: DataFrame, width: int = 1 << 16) -> np.ndarray:
    """A table of ``MARKS`` bits in which those of a frame's only column, ``cell``, are set."""
    import pyarrow as pa

    def add(batches):
        for k, rows in group_runs(batches):
            bits = np.zeros(width, np.uint8)
            bits[[r[1] % width for r in rows]] = 1
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["range", "bits"])

    ranges = cells.distinct().select(F.floor(F.col("cell") / width).cast("int").alias("range"), "cell").repartition("range").sortWithinPartitions("range")
    out = np.zeros(MARKS // 8, np.uint8)
    with common.batches_of(cells.sparkSession, 1 << 16):
        rows = ranges.mapInArrow(add, "range int, bits binary").collect()  # MARKS bits in all
    for row in rows:
        out[row["range"] * width // 8 : (row["range"] + 1) * width // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a = int(mix(hashes).sum(dtype=U)) if len(hashes) else 0
    b = int(mix(hashes * U(0x9E3779B97F4A7C15) + U(1)).sum(dtype=U)) if len(hashes) else 0
    return np.array([a, b], U).astype(np.int64).tolist()


class Node:
    """A node of a signature tree over the sets ``low`` to ``high`` (exclusive), which are sorted by size."""

    __slots__ = ("bits", "children", "dense", "high", "least", "low", "most")

    def __init__(self, low: int, high: int, sizes: np.ndarray, bits: np.ndarray, dense: np.ndarray, children: tuple):
        self.dense = int(dense[low:high].max())  # shingles of one set that share a bit, at most
        self.low, self.high, self.children = low, high, children
        self.least, self.most = int(sizes[low]), int(sizes[high - 1])
        self.bits = np.bitwise_or.reduce(bits[low:high], axis=0) if not children else children[0].bits | children[1].bits


def _tree(low: int, high: int, *arrays: np.ndarray) -> Node:
    if high - low <= LEAF:
        return Node(low, high, *arrays, ())
    middle = (low + high) // 2
    return Node(low, high, *arrays, (_tree(low, middle, *arrays), _tree(middle, high, *arrays)))


def tree_join(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets, by dual traversal of their signature tree.

    ``side``: with 0 and 1 only pairs across the sides are of interest; the others were another
    task's work.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.lexsort((np.array([int(s[0]) if len(s) else 0 for s in sets], U), sizes))
    sets, sizes = [sets[k] for k in order], sizes[order]
    sides = None if side is None else side[order]
    bits, dense = np.zeros((len(sets), BITS // 64), U), np.zeros(len(sets), np.int64)
    for k, s in enumerate(sets):
        place = (s >> U(20)) % U(BITS)
        np.bitwise_or.at(bits[k], (place // U(64)).astype(np.int64), U(1) << (place % U(64)))
        dense[k] = np.bincount(place.astype(np.int64)).max() if len(s) else 0
    own_bits = np.bitwise_count(bits).sum(1).astype(np.int64)
    forest, links = Forest(len(sets)), []
    roots = np.arange(len(sets))

    def needed(a: int, b: int) -> int:
        return -(-percent * (a + b) // (100 + percent))

    def leaves(p: Node, q: Node) -> None:
        nonlocal roots
        i, j = np.arange(p.low, p.high), np.arange(q.low, q.high)
        want = -(-percent * (sizes[i][:, None] + sizes[j][None, :]) // (100 + percent))
        small = np.minimum(sizes[i][:, None], sizes[j][None, :])
        open_ = (small >= want) & (roots[i][:, None] != roots[j][None, :])
        if p is q:
            open_ &= i[:, None] < j[None, :]
        if sides is not None:
            open_ &= sides[i][:, None] != sides[j][None, :]
        if not open_.any():
            return
        # each bit that one set has and the other lacks is a shingle that they don't share
        lacking = np.bitwise_count(bits[i][:, None, :] & ~bits[j][None, :, :]).sum(2).astype(np.int64)
        also = lacking + own_bits[j][None, :] - own_bits[i][:, None]
        open_ &= (sizes[i][:, None] - lacking >= want) & (sizes[j][None, :] - also >= want)
        rows, columns = np.nonzero(open_.any(1))[0], np.nonzero(open_.any(0))[0]
        if not len(rows):
            return
        left = np.concatenate([sets[i[r]] for r in rows])
        right = np.concatenate([sets[j[c]] for c in columns])
        from_left = np.repeat(rows, sizes[i[rows]])
        from_right = np.repeat(columns, sizes[j[columns]])
        values, place = np.unique(right, return_inverse=True)
        at = np.minimum(np.searchsorted(values, left), len(values) - 1)
        hit = values[at] == left
        has_right = np.zeros((len(j), len(values)), np.float32)
        has_right[from_right, place] = 1
        has_left = np.zeros((len(i), len(values)), np.float32)
        has_left[from_left[hit], at[hit]] = 1
        shared = np.rint(has_left @ has_right.T).astype(np.int64)
        union = sizes[i][:, None] + sizes[j][None, :] - shared
        found = open_ & (100 * shared >= percent * union)
        joined = False
        for r, c in zip(*(x.tolist() for x in np.nonzero(found)), strict=True):
            if forest.join(p.low + r, q.low + c):
                links.append((int(order[p.low + r]), int(order[q.low + c])))
                joined = True
        if joined:
            roots = forest.roots()

    root = _tree(0, len(sets), sizes, bits, dense)
    stack = [(root, root)]
    while stack:
        p, q = stack.pop()
        if p is not q:
            if p.most < needed(p.most, q.least) or q.most < needed(q.most, p.least):  # sizes too far apart
                continue
            # shared tokens have bits in both nodes
            if int(np.bitwise_count(q.bits & p.bits).sum()) * min(p.dense, q.dense) < needed(p.least, q.least):
                continue
        one = roots[p.low]
        if (roots[p.low : p.high] == one).all() and (roots[q.low : q.high] == one).all():
            continue
        if sides is not None and (sides[p.low : p.high] == sides[p.low]).all() and (sides[q.low : q.high] == sides[p.low]).all():
            continue
        if not p.children and not q.children:
            leaves(p, q)
        elif p is q:
            a, b = p.children
            stack += [(a, b), (b, b), (a, a)]
        elif not q.children or (p.children and p.high - p.low >= q.high - q.low):
            stack += [(c, q) for c in p.children[::-1]]
        else:
            stack += [(p, c) for c in q.children[::-1]]
    return links


def _signed(documents: DataFrame, percent: int, cells, n: int, key: str, text: str) -> DataFrame:
    """key, size, set key, the keys of the prefix, and the token bitmap."""
    import pyarrow as pa

    def run(batches):
        words = Words()
        for batch in common.sliced(batches):
            out: list[list] = [[], [], [], [], []]
            for t in batch.column(1).to_pylist():
                hashes = shingles(t, n, words)
                a, b = _set_key(hashes)
                for column, value in zip(out, (len(hashes), a, b, prefix_keys(hashes, percent, cells.value).astype("<u8").tobytes(), _bitmap(hashes)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), *(pa.array(c, pa.binary()) for c in out[3:])], ["key", "n_shingles", "k1", "k2", "keys", "bits"])

    return documents.select(F.col(key).cast("long").alias("key"), text).mapInArrow(run, "key long, n_shingles long, k1 long, k2 long, keys binary, bits binary")


def _bitmap(hashes: np.ndarray) -> bytes:
    """Token bitmap of two bits or more for each shingle, up to ``WIDEST``; a power of two wide."""
    width = min(WIDEST, 64 << max(0, (2 * len(hashes) // 64).bit_length()))
    place = ((hashes >> U(20)) % U(width)).astype(np.int64)
    bits = np.zeros(width, np.uint8)
    bits[place] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _may_link(sizes: tuple[int, int], bitmaps: tuple[bytes, bytes], percent: int) -> bool:
    """Whether two sets' largest possible overlap reaches the threshold."""
    a, b = (np.frombuffer(x, np.uint8) for x in bitmaps)
    while len(a) != len(b):  # the wider one is folded: places are remainders of powers of two
        if len(a) > len(b):
            a = a[: len(a) // 2] | a[len(a) // 2 :]
        else:
            b = b[: len(b) // 2] | b[len(b) // 2 :]
    most = min(sizes[0] - int(np.bitwise_count(a & ~b).sum()), sizes[1] - int(np.bitwise_count(b & ~a).sum()))
    return most >= -(-percent * (sizes[0] + sizes[1]) // (100 + percent))


def _runs(part: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted entries, and the first place and length of each run of one key."""
    order = np.lexsort((own, part))
    part, own = part[order], own[order]
    fresh = np.r_[True, (part[1:] != part[:-1]) | (own[1:] != own[:-1])]
    part, own = part[fresh], own[fresh]
    start = np.nonzero(np.r_[True, part[1:] != part[:-1]])[0]
    return part, own, start, np.diff(np.r_[start, len(part)])


def _star(own: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The others of the given runs with their runs' first."""
    of = np.repeat(np.arange(len(start)), size)
    place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + start[of]
    other = place != start[of]
    return own[start[of]][other], own[place][other]


def _meetings(frame: DataFrame, slices: int, chunk: int = 1 << 21) -> DataFrame:
    """Who shares a prefix shingle: a, b, sure.

    Of up to ``FEW`` sets at a shingle each two are named (``sure`` is false: their bitmaps are
    yet to be compared); more are named with the smallest of them only, which does for putting
    them in one group (``sure``). Where a task alone has more than ``FEW`` rows at a shingle it
    names them at once and sends one on, so a shingle that most rows have sends a few entries
    for each task. The one sent on is marked: it stands for sets that can link where it can't,
    so a run with a mark is named with its smallest, however few are left of it. What goes on
    is sorted, cut into slices of the range of keys, and packed.
    """
    import pyarrow as pa

    def batch(kind, a, b, data):
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(data, pa.binary())], ["slice", "a", "b", "data"])

    def flush(parts, owners):
        part, own, start, size = _runs(np.concatenate(parts), np.concatenate(owners))
        many = size > FEW
        a, b = _star(own, start[many], size[many])
        a, b = np.unique(np.stack([a, b]), axis=1)
        for at in range(0, len(a), 20_000):
            some = a[at : at + 20_000]
            yield batch([-1] * len(some), some, b[at : at + 20_000], [None] * len(some))
        keep = ~np.repeat(many, size)
        keep[start] = True
        marked = np.repeat(many, size)[keep]
        part, own = part[keep], own[keep]
        cuts = cut_points(part, slices).tolist()
        full = [k for k in range(slices) if cuts[k + 1] > cuts[k]]
        for at in range(0, len(full), 64):
            some = full[at : at + 64]
            yield batch(some, [None] * len(some), [None] * len(some), [packed(deltas(part[cuts[k] : cuts[k + 1]]), own[cuts[k] : cuts[k + 1]], marked[cuts[k] : cuts[k + 1]].astype(np.uint8)) for k in some])

    def combined(batches):
        parts, owners, held = [], [], 0
        for rows in batches:
            for own, raw in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                parts.append(np.frombuffer(raw, "<u8"))
                owners.append(np.full(len(parts[-1]), own, np.int64))
                held += len(parts[-1])
                if held >= chunk:
                    yield from flush(parts, owners)
                    parts, owners, held = [], [], 0
        if held:
            yield from flush(parts, owners)

    def met(batches):
        for number, rows in group_runs(batches):
            if number < 0:
                yield pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2)), pa.array([True] * len(rows))], ["a", "b", "sure"])
                continue
            parts, owners, marks = zip(*(unpacked(r[3]) for r in rows), strict=True)
            parts = np.concatenate([np.cumsum(p, dtype=U) for p in parts])
            reduced = np.unique(parts[np.concatenate(marks) > 0])
            part, own, start, size = _runs(parts, np.concatenate(owners))
            many = (size > FEW) | np.isin(part[start], reduced)
            a, b = _star(own, start[many], size[many])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.ones(len(a), bool))], ["a", "b", "sure"])
            for n in range(2, FEW + 1):
                runs = start[(size == n) & ~many]
                if len(runs):
                    i, j = np.triu_indices(n, 1)
                    a, b = np.unique(np.stack([own[(runs[:, None] + i).ravel()], own[(runs[:, None] + j).ravel()]]), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), bool))], ["a", "b", "sure"])

    sent = frame.select("key", "keys").mapInArrow(combined, "slice int, a long, b long, data binary")
    spread = F.when(F.col("slice") < 0, F.pmod(F.xxhash64("a", "b"), F.lit(1 << 20))).otherwise(F.col("slice"))
    return sent.repartition(spread).sortWithinPartitions("slice").mapInArrow(met, "a long, b long, sure boolean")


def _crowded(frame: DataFrame, slices: int, late, chunk: int = 1 << 21) -> DataFrame:
    """Cells of the keys that more than ``FEW`` prefixes have and ``late`` hasn't. Tasks count their own keys and send them packed, by slices."""
    import pyarrow as pa

    def flush(parts):
        keys, n = np.unique(np.concatenate(parts), return_counts=True)
        cuts = cut_points(keys, slices).tolist()
        full = [k for k in range(slices) if cuts[k + 1] > cuts[k]]
        for at in range(0, len(full), 64):
            some = full[at : at + 64]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([packed(deltas(keys[cuts[k] : cuts[k + 1]]), n[cuts[k] : cuts[k + 1]].astype(np.uint32)) for k in some], pa.binary())], ["slice", "data"])

    def counted(batches):
        parts, held = [], 0
        for rows in batches:
            for raw in rows.column(0).to_pylist():
                parts.append(np.frombuffer(raw, "<u8"))
                held += len(parts[-1])
                if held >= chunk:
                    yield from flush(parts)
                    parts, held = [], 0
        if held:
            yield from flush(parts)

    def added(batches):
        for _, rows in group_runs(batches):
            keys, n = zip(*(unpacked(r[1]) for r in rows), strict=True)
            keys, place = np.unique(np.concatenate([np.cumsum(k, dtype=U) for k in keys]), return_inverse=True)
            many = keys[np.bincount(place, np.concatenate(n)) > FEW]
            many = np.unique(_cell(many[~_is_marked(late.value, many)]))
            yield pa.RecordBatch.from_arrays([pa.array(many, pa.int64())], ["cell"])

    sent = frame.select("keys").mapInArrow(counted, "slice int, data binary")
    return sent.repartition("slice").sortWithinPartitions("slice").mapInArrow(added, "cell long")


def _with_marked(frame: DataFrame, late) -> DataFrame:
    """Cells of the sets that have a marked key in their prefix. ``frame``: key, keys."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            own = _own_cell(batch.column(0))
            hit = np.array([bool(_is_marked(late.value, np.frombuffer(raw, "<u8")).any()) for raw in batch.column(1).to_pylist()], bool)
            yield pa.RecordBatch.from_arrays([pa.array(_cell(own[hit]), pa.int64())], ["cell"])

    return frame.select("key", "keys").mapInArrow(run, "cell long")


def _without(frame: DataFrame, moved) -> DataFrame:
    """key and keys of the sets that ``moved`` hasn't."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(~_is_marked(moved.value, _own_cell(batch.column(0)))))

    return frame.select("key", "keys").mapInArrow(run, "key long, keys binary")


def _signed_again(documents: DataFrame, percent: int, cells, late, moved, n: int, key: str, text: str) -> DataFrame:
    """key and keys of the sets that ``moved`` has, in the order that ``late`` makes."""
    import pyarrow as pa

    def run(batches):
        words = Words()
        for batch in common.sliced(batches):
            batch = batch.filter(pa.array(_is_marked(moved.value, _own_cell(batch.column(0)))))
            keys = [prefix_keys(shingles(t, n, words), percent, cells.value, late.value).astype("<u8").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["key", "keys"])

    return documents.select(F.col(key).cast("long").alias("key"), text).mapInArrow(run, "key long, keys binary")


def _possible(pairs: DataFrame, sets: DataFrame, percent: int, tmp: common.Scratch) -> DataFrame:
    """The pairs a, b whose sizes and bitmaps leave a link possible. ``sets``: key, n_shingles, bits."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            a, b, size_a, bits_a, size_b, bits_b = (batch.column(k).to_pylist() for k in range(6))
            keep = [_may_link((m, n), (x, y), percent) for m, x, n, y in zip(size_a, bits_a, size_b, bits_b, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sizes = lambda k: sets.select(F.col("key").alias(k), F.col("n_shingles").alias(f"n{k}"))
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    sized = pairs.distinct().join(sizes("a"), "a").join(sizes("b"), "b").where(100 * small >= percent * large)
    sized = tmp.stored(sized.select("a", "b", "na", "nb"), "sized")
    wanted = tmp.stored(sized.select(F.col("a").alias("key")).union(sized.select("b")).distinct(), "wanted")
    bits = tmp.stored(common.picked(sets.select("key", "bits"), wanted, "key"), "bits")
    side = lambda k: bits.select(F.col("key").alias(k), F.col("bits").alias(f"bits{k}"))
    both = sized.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "na", "bitsa", "nb", "bitsb").mapInArrow(run, "a long, b long")


def _tasks(documents: DataFrame, reps: DataFrame, classes: DataFrame, copies: DataFrame, cells, slices: int, key: str, text: str, n: int, percent: int, block_rows: int, tmp: common.Scratch) -> tuple[DataFrame, DataFrame]:
    """The groups (node, root, size, n) and the tasks that each set is sent to (node, task, side).

    Where sets would go to ``SENT`` tasks or more on average, crowded shingles come last and the
    groups are made again, as long as that takes at least a quarter off.
    """
    spark = documents.sparkSession
    late, moved, before, keys = np.zeros(MARKS // 8, np.uint8), np.zeros(MARKS // 8, np.uint8), None, reps.select("key", "keys")
    again: list[DataFrame] = []
    for k in range(ROUNDS + 1):
        with common.Scratch() as passing:
            met = passing.stored(_meetings(keys, slices).distinct(), "met")
            meeting = connected(met.where("sure").select("a", "b").union(_possible(met.where("NOT sure").select("a", "b"), reps.select("key", "n_shingles", "bits"), percent, passing)))
            passing.frames.append(meeting)
            sized, assigned = _blocks(meeting, classes, percent, block_rows, tmp)
        sent = assigned.count()
        if k == ROUNDS or sent <= SENT * sized.count() or (before is not None and 4 * sent > 3 * before):
            break
        before = sent
        with common.Scratch() as passing:
            crowded = passing.stored(_crowded(keys, slices, spark.sparkContext.broadcast(late)), "crowded")  # MARKS bits, as below
            if crowded.isEmpty():
                break
            late = late | _marks(crowded)
        marked = spark.sparkContext.broadcast(late)
        moved = moved | _marks(_with_marked(keys, marked))
        tmp.drop(sized, assigned, *again)
        moving = spark.sparkContext.broadcast(moved)
        again = [tmp.stored(common.picked(_signed_again(documents, percent, cells, marked, moving, n, key, text), copies, "key", "left_anti"), "signed-again")]
        keys = _without(reps, moving).union(again[0])
    return sized, assigned


def _blocks(meeting: DataFrame, classes: DataFrame, percent: int, block_rows: int, tmp: common.Scratch) -> tuple[DataFrame, DataFrame]:
    """Groups of more than one set, and their tasks: a whole group, or pairs of blocks of a large one."""
    sized = meeting.join(classes.select(F.col("first").alias("node"), "size").groupBy("node").agg(F.max("size").alias("size")), "node")
    counts = meeting.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    sized = tmp.stored(sized.join(counts, "root"), "groups")
    step = 1.05
    bin_ = F.floor(F.log(F.col("size").cast("double")) / float(np.log(step))).cast("int")
    large = sized.where(F.col("n") > block_rows).withColumn("bin", bin_)
    bins = tmp.stored(large.groupBy("root", "bin").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("slots")), "bins")
    reach = int(np.ceil(np.log(100 / percent) / np.log(step))) + 1
    one = bins.select("root", F.col("bin").alias("bin1"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot1"))
    two = bins.select("root", F.col("bin").alias("bin2"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot2")).withColumn("bin1", F.explode(F.sequence(F.col("bin2") - reach, F.col("bin2"))))
    plan = one.join(two, ["root", "bin1"]).where((F.col("bin1") < F.col("bin2")) | (F.col("slot1") <= F.col("slot2")))
    plan = plan.withColumn("task", F.xxhash64("root", "bin1", "slot1", "bin2", "slot2"))
    lone = (F.col("bin1") == F.col("bin2")) & (F.col("slot1") == F.col("slot2"))
    ends = plan.select("root", "task", F.explode(F.when(lone, F.array(F.struct(F.col("bin1").alias("bin"), F.col("slot1").alias("slot"), F.lit(None).cast("int").alias("side")))).otherwise(F.array(F.struct(F.col("bin1").alias("bin"), F.col("slot1").alias("slot"), F.lit(0).alias("side")), F.struct(F.col("bin2").alias("bin"), F.col("slot2").alias("slot"), F.lit(1).alias("side"))))).alias("e")).select("root", "task", "e.*")
    slots = large.join(bins, ["root", "bin"]).withColumn("slot", F.pmod(F.xxhash64("node", F.lit("slot")), F.col("slots")).cast("int"))
    assigned = slots.join(ends, ["root", "bin", "slot"]).select("node", "task", "side")
    whole = sized.where(F.col("n") <= block_rows).select("node", F.xxhash64("root").alias("task"), F.lit(None).cast("int").alias("side"))
    return sized, tmp.stored(whole.unionByName(assigned), "assigned")


def similar(documents: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90, block_rows: int = 1024, rows_per_slice: int = 1000) -> DataFrame:
    """Components of the links of at least ``percent`` per cent Jaccard: key, n_shingles, component_id; a written table.

    Keys are integers. ``block_rows`` bounds the sets of a block; a task holds two at most.
    """
    with common.Scratch() as tmp:
        return common.stored(_similar(documents, key, text, n, percent, block_rows, rows_per_slice, tmp), "similar")


def _similar(documents: DataFrame, key: str, text: str, n: int, percent: int, block_rows: int, rows_per_slice: int, tmp: common.Scratch) -> DataFrame:
    """The components; ``tmp`` holds what is written on the way."""
    import pyarrow as pa

    spark = documents.sparkSession
    cells = spark.sparkContext.broadcast(commonness(documents, text, n))  # COUNTERS bytes
    signed = tmp.stored(_signed(documents, percent, cells, n, key, text), "signed")
    filled = signed.where("n_shingles > 0")
    classes = tmp.stored(filled.groupBy("k1", "k2").agg(F.min("key").alias("first"), F.min("n_shingles").alias("size")), "classes")
    copies = tmp.stored(filled.select("k1", "k2", "key").join(classes.select("k1", "k2", "first"), ["k1", "k2"]).where("key <> first").select("key").distinct(), "copies")
    reps = common.picked(filled, copies, "key", "left_anti")
    slices = 1 << max(4, int(np.ceil(np.log2(max(1, signed.count() / rows_per_slice)))))
    sized, assigned = _tasks(documents, reps, classes, copies, cells, slices, key, text, n, percent, block_rows, tmp)

    def sets_of(batches):
        words = Words()
        for batch in common.sliced(batches):
            sets = [shingles(t, n, words).astype("<u8").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "hashes"])

    texts = common.picked(documents.select(F.col(key).cast("long").alias("node"), F.col(text).alias("_text")), sized.select("node"), "node")
    sets = texts.mapInArrow(sets_of, "node long, hashes binary").join(assigned, "node")

    def joined(batches):
        for _, rows in group_runs(batches):
            rows = sorted({r[2]: r for r in rows}.values(), key=lambda r: r[2])
            sides = None if rows[0][1] is None else np.array([r[1] for r in rows])
            found = tree_join([np.frombuffer(r[3], "<u8") for r in rows], percent, sides)
            yield pa.RecordBatch.from_arrays([pa.array([rows[a][2] for a, _ in found], pa.int64()), pa.array([rows[b][2] for _, b in found], pa.int64())], ["a", "b"])

    links = sets.select("task", "side", "node", "hashes").repartition("task").sortWithinPartitions("task").mapInArrow(joined, "a long, b long")
    linked = connected(links)
    tmp.frames.append(linked)
    roots = classes.join(linked, F.col("first") == F.col("node"), "left").select("k1", "k2", F.coalesce("root", "first").alias("root"))
    return signed.join(roots, ["k1", "k2"], "left").select(F.col("key").alias(key), "n_shingles", F.coalesce(F.when(F.col("n_shingles") > 0, F.col("root")), F.col("key")).alias("component_id"))
