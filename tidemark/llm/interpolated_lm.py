"""Language-model scores by deleted interpolation.

A word's probability after its predecessor mixes the maximum-likelihood estimates of bigram,
unigram and uniform distribution. The weights depend on a bucket of the context's frequency
(powers of two) and are learned by expectation-maximisation on held-out counts: every training
token is held out in turn by taking one off the counts that it is part of.

How the counts travel: a task reads its texts as blocks of about ``block_tokens`` tokens, and a
block sends the hashes of its distinct words and bigrams with its own training counts, sorted,
cut into slices of the hash range and packed. A slice's task adds up what all blocks sent for it
and answers each block with the totals of what that block asked for. So a key is sent once for
each block, however often it occurs there, nothing is sent to all, and no task holds more than
a slice or a block. The number of slices follows the number of rows.

Blobs don't go from every block to every slice. Slices are reached in levels of at most
``2 ** fan_bits`` ways (``Tree``): a node of a level merges what a group of senders sent for its
range of hashes, and asks the next level as one sender; the totals come back along the same
way. A sender makes at most that many blobs, each level has as many nodes as there are slices,
and a node hears of a bounded number of senders, so blobs grow with the input and not with its
square. Up to ``2 ** fan_bits`` slices there is one level; each further one writes its keys once.

Words are runs of bytes other than space and the ASCII controls 9 to 13, with A-Z lower-cased;
each text ends with one end token, which is also the context of its first token. Null and empty
texts are the end token alone. Words are told apart by 64-bit hashes, bigrams by 56 bits.
Repeated rows count and are scored as texts of their own; extra columns are ignored; an empty
table gives an empty result. Without training rows every word is unknown.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.packed import cut_points, deltas, group_runs, mix, packed, unpacked

U = np.uint64
END = b" "  # no word can hold it
BUCKETS = 40
STEP = 0.05
TEXT, WORDS, BIGRAMS = 0, 1, 2
BLOBS = "block long, kind int, slice int, data binary"


@dataclass(frozen=True)
class Tree:
    """Ways from senders to slices: ``widths`` are the bits of the hash that each level looks at.

    A node's number holds the bits of the hash known so far, then as many bits of its group of
    senders as are left; each level takes from the group what it adds to the range.
    """

    widths: tuple[int, ...]

    @classmethod
    def of(cls, bits: int, fan_bits: int) -> Tree:
        levels = -(-bits // fan_bits)
        return cls(tuple(bits * (k + 1) // levels - bits * k // levels for k in range(levels)))

    @property
    def bits(self) -> int:
        return sum(self.widths)

    def parted(self, level: int, node: int, keys: np.ndarray):
        """Nodes that a node of a level asks for its sorted keys, with the places of each one's keys."""
        known, width = sum(self.widths[:level]), self.widths[level]
        left = self.bits - known
        prefix, group = node >> left, node & ((1 << left - width) - 1)
        cuts = cut_points(keys << U(known), 1 << width).tolist()
        for k, (low, high) in enumerate(itertools.pairwise(cuts)):
            if high > low:
                yield (prefix << width | k) << left - width | group, low, high


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in four bytes each where they fit."""
    return counts.astype(np.uint32 if not len(counts) or counts.max() < 2**32 else U)


class Block:
    """Tokens of a block of texts: local word numbers, words' hashes, and the distinct keys."""

    def __init__(self, texts: list[bytes | None]):
        import xxhash

        number: dict[bytes, int] = {END: 0}
        parts, lengths = [], []
        for text in texts:
            words = (text or b"").translate(common.LOWER_BYTES).split()
            parts.append(np.array([number.setdefault(w, len(number)) for w in words] + [0], np.uint32))
            lengths.append(len(words) + 1)
        self.lengths = np.array(lengths, np.int64)
        self.tokens = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in number], U)
        self.order = np.argsort(hashes)
        self.words = hashes[self.order]  # sorted; self.order leads back to local numbers
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        if len(before):
            before[0] = 0  # the token before a text's first is an end token anyway
        self.before = before
        keys = mix(mix(hashes[before] + U(0x9E3779B97F4A7C15)) ^ hashes[self.tokens]) & U(0xFFFFFFFFFFFFFF00)
        self.bigrams, self.bigram_of = np.unique(keys, return_inverse=True)

    def counts(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each sorted word and bigram occurs in the texts marked."""
        marked = np.repeat(train, self.lengths)
        words = np.bincount(self.tokens[marked], minlength=len(self.words))[self.order]
        return words, np.bincount(self.bigram_of[marked], minlength=len(self.bigrams))


def _asked(tree: Tree, level: int, node: int, sender: int, kind: int, keys: np.ndarray, counts: np.ndarray) -> list[list]:
    """What a sender asks the next level: sender, kind, node and packed keys with counts, as columns."""
    found = list(tree.parted(level, node, keys))
    return [[sender] * len(found), [kind] * len(found), [at for at, _, _ in found], [packed(deltas(keys[a:b]), _narrow(counts[a:b])) for _, a, b in found]]


def _sent(blocks: list, kinds: list, slices: list, data: list):
    """Rows of blobs as record batches of a bounded number of them."""
    import pyarrow as pa

    for at in range(0, len(blocks), 256):
        span = slice(at, at + 256)
        yield pa.RecordBatch.from_arrays([pa.array(blocks[span], pa.int64()), pa.array(kinds[span], pa.int32()), pa.array(slices[span], pa.int32()), pa.array(data[span], pa.binary())], ["block", "kind", "slice", "data"])


def _blocks(tree: Tree, block_tokens: int):
    """Map side: blocks' texts, and their packed keys and training counts by node of the first level."""
    import pyarrow as pa
    import zstandard
    from pyspark import TaskContext

    def rows(block, ids, texts, train):
        made = Block(texts)
        marks = np.array(train, bool)
        sizes = np.array([-1 if t is None else len(t) for t in texts], np.int64)
        head = packed(np.array([0 if i is None else i for i in ids], np.int64), np.array([i is None for i in ids], np.uint8), marks.astype(np.uint8), sizes)
        body = zstandard.ZstdCompressor(level=3).compress(b"".join(t for t in texts if t))
        yield [block], [TEXT], [0], [len(head).to_bytes(8, "little") + head + body]
        group = int(mix(np.array([block], U))[0]) & ((1 << tree.bits) - 1)
        for kind, keys, counts in zip((WORDS, BIGRAMS), (made.words, made.bigrams), made.counts(marks), strict=True):
            yield _asked(tree, 0, group, block, kind, keys, counts)

    def run(batches):
        task = TaskContext.get().partitionId()
        block, held, ids, texts, train = 0, 0, [], [], []

        def flush():
            for a, b, c, d in rows(task << 32 | block, ids, texts, train):
                yield from _sent(a, b, c, d)

        for batch in common.sliced(batches):
            for i, t, own in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                t = None if t is None else t.encode("utf-8", "surrogatepass")
                ids.append(i)
                texts.append(t)
                train.append(bool(own))
                held += 1 + len(t or b"") // 6
                if held >= block_tokens:
                    yield from flush()
                    block, held, ids, texts, train = block + 1, 0, [], [], []
        if ids:
            yield from flush()

    return run


def _added(blobs) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Distinct keys of several blobs in order, the place of each blob's keys among them, their totals, and each blob's keys in number."""
    asked, counted = [], []
    for blob in blobs:
        steps, counts = unpacked(blob)
        asked.append(np.cumsum(steps, dtype=U))
        counted.append(counts.astype(np.int64))
    keys, place = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place, np.concatenate(counted))
    return keys, place, total, [len(x) for x in asked]


def _gathered(tree: Tree, level: int):
    """A node's merged keys, asked of the next level in the node's own name."""

    def run(batches):
        for place, group in group_runs(batches):
            keys, _, total, _ = _added(row[2] for row in group)
            yield from _sent(*_asked(tree, level, place & 0xFFFFFFFF, place, place >> 32, keys, total))

    return run


def _returned(batches):
    """A node's totals from the next level, given to each sender for the keys that it asked for."""
    for place, group in group_runs(batches):
        asks = [row for row in group if row[1] is not None]
        _, of, _, sizes = _added(row[3] for row in asks)
        total = np.concatenate([unpacked(row[3])[0].astype(np.int64) for row in sorted((r for r in group if r[1] is None), key=lambda r: r[2])])
        data = [packed(_narrow(total[own])) for own in np.split(of, np.cumsum(sizes)[:-1])]
        n = len(asks)
        yield from _sent([row[1] for row in asks], [place >> 32] * n, [place & 0xFFFFFFFF] * n, data)


def _answers(batches):
    """A slice's totals for each block that asked; and, for words, the slice's tokens and kinds."""
    import pyarrow as pa

    for place_, group in group_runs(batches):
        kind, number = place_ >> 32, place_ & 0xFFFFFFFF
        if kind == TEXT:  # passes through
            for row in group:
                yield pa.RecordBatch.from_arrays([pa.array([row[1]], pa.int64()), pa.array([TEXT], pa.int32()), pa.array([0], pa.int32()), pa.array([row[2]], pa.binary()), pa.array([0], pa.int64()), pa.array([0], pa.int64())], ["block", "kind", "slice", "data", "tokens", "kinds"])
            continue
        keys, place, total, sizes = _added(row[2] for row in group)
        blocks = [row[1] for row in group]
        data = [packed(_narrow(total[own])) for own in np.split(place, np.cumsum(sizes)[:-1])]
        n = len(blocks)
        tokens = [0] * n
        kinds = [0] * n
        if kind == WORDS:
            tokens[0], kinds[0] = int(total.sum()), int((total > 0).sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(data, pa.binary()), pa.array(tokens, pa.int64()), pa.array(kinds, pa.int64())],
            ["block", "kind", "slice", "data", "tokens", "kinds"],
        )


def _merged(batches):
    """A block's text and all its answers as one row."""
    import pyarrow as pa

    for block, group in group_runs(batches):
        text = next(r[3] for r in group if r[1] == TEXT)
        answers = []
        for kind in (WORDS, BIGRAMS):
            parts = [(r[2], unpacked(r[3])[0]) for r in group if r[1] == kind]
            answers.append(np.concatenate([x.astype(np.int64) for _, x in sorted(parts, key=lambda p: p[0])] or [np.empty(0, np.int64)]))
        small = packed(*map(_narrow, answers))
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([text], pa.binary()), pa.array([small], pa.binary())], ["block", "text", "counts"])


@dataclass
class Counted:
    """A block with its answers: counts of each token's bigram, context and word."""

    ids: list
    train: np.ndarray
    lengths: np.ndarray
    pair: np.ndarray
    context: np.ndarray
    word: np.ndarray

    @classmethod
    def read(cls, text: bytes, counts: bytes) -> Counted:
        import zstandard

        size = int.from_bytes(text[:8], "little")
        ids, missing, train, sizes = unpacked(text[8 : 8 + size])
        raw = zstandard.ZstdDecompressor().decompress(text[8 + size :], max_output_size=int(sizes.clip(0).sum()) + 1)
        ends = np.cumsum(sizes.clip(0))
        texts = [raw[e - s : e] if s >= 0 else None for s, e in zip(sizes.clip(-1).tolist(), ends.tolist(), strict=True)]
        block = Block(texts)
        by_hash, pairs = unpacked(counts)
        words = np.empty(len(by_hash), np.int64)
        words[block.order] = by_hash
        return cls([None if m else int(i) for i, m in zip(ids.tolist(), missing.tolist(), strict=True)], train.astype(bool), block.lengths, pairs.astype(np.int64)[block.bigram_of], words[block.before], words[block.tokens])


def bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency: 0 for none, else one more than its power of two."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0).clip(0, BUCKETS - 1)


def learn_weights(cells: list[tuple[int, int, int, int]], uniform: float, turns: int = 60) -> np.ndarray:
    """Mixture weights of each bucket by EM. ``cells``: bucket, grid places of log bigram and unigram estimate (-1: zero), tokens."""
    weights = np.tile(np.array([0.5, 0.4, 0.1]), (BUCKETS, 1))
    weights[0] = [0, 0.8, 0.2]
    by_bucket: dict[int, list] = {}
    for b, two, one, n in cells:
        by_bucket.setdefault(b, []).append((two, one, n))
    for b, own in sorted(by_bucket.items()):
        own.sort()
        two, one, n = (np.array(x) for x in zip(*own, strict=True))
        p = np.stack([np.where(two >= 0, 10.0 ** (-two * STEP), 0), np.where(one >= 0, 10.0 ** (-one * STEP), 0), np.full(len(n), uniform)], axis=1)
        w = weights[b].copy()
        for _ in range(turns):
            share = p * w
            share /= share.sum(1, keepdims=True)
            w = (share * n[:, None]).sum(0) / n.sum()
            w = np.maximum(w, 1e-6 if b else 0)
            w[2] = max(w[2], 1e-6)
            w /= w.sum()
        weights[b] = w
    weights[0, 0] = 0
    weights[0] /= weights[0].sum()
    return weights


def _held_out(tokens: int):
    """Cells of the held-out estimates of all training tokens, with their numbers."""

    def place(p):
        return np.where(p > 0, np.rint(-np.log10(np.maximum(p, 1e-300)) / STEP).astype(np.int64), -1)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for text, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Counted.read(text, counts)
                held = np.repeat(own.train, own.lengths)
                pair, context, word = own.pair[held] - 1, own.context[held] - 1, own.word[held] - 1
                two = place(np.where(context > 0, pair / np.maximum(context, 1), 0))
                one = place(word / max(tokens - 1, 1))
                cell, n = np.unique((bucket(context) << 40) | ((two + 1) << 20) | (one + 1), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n.astype(np.int64))], ["cell", "n"])

    return run


def _counted(given: DataFrame, tree: Tree, block_tokens: int, tmp: common.Scratch) -> tuple[DataFrame, int, int]:
    """Blocks with their answers, training tokens, and distinct ones; ``given``: id, text, train."""
    parts = 2 << tree.bits
    sent = given.mapInArrow(_blocks(tree, block_tokens), BLOBS)
    place = F.when(F.col("kind") == TEXT, F.pmod(F.xxhash64("block"), F.lit(1 << 31))).otherwise(F.shiftleft(F.col("kind").cast("long"), 32).bitwiseOR(F.col("slice").cast("long")))

    def met(frame: DataFrame) -> DataFrame:
        """Rows of a place side by side in one task."""
        return frame.repartition(parts, "place").sortWithinPartitions("place")

    asks = []  # of each level but the last
    for level in range(1, len(tree.widths)):
        asks.append(tmp.stored(sent, "lm-asks", rows=16))
        sent = met(asks[-1].where(F.col("kind") != TEXT).select(place.alias("place"), "block", "data")).mapInArrow(_gathered(tree, level), BLOBS)
    answered = tmp.stored(met(sent.select(place.alias("place"), "block", "data")).mapInArrow(_answers, f"{BLOBS}, tokens long, kinds long"), "lm-answers", rows=16)
    found = answered.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("v")).first()
    tokens, kinds = found["n"], found["v"]
    for asked in reversed(asks):
        told = answered.select(F.col("block").alias("place"), F.lit(None).cast("long").alias("block"), "slice", "data")
        both = told.union(asked.where(F.col("kind") != TEXT).select(place.alias("place"), "block", "slice", "data"))
        back = met(both).mapInArrow(_returned, BLOBS)
        above, answered = answered, tmp.stored(back, "lm-answers", rows=16)
        tmp.drop(above)
    whole = answered.union(asks[0].where(F.col("kind") == TEXT)) if asks else answered
    by_block = whole.select("block", "kind", "slice", "data").repartition(parts, "block").sortWithinPartitions("block")
    merged = tmp.stored(by_block.mapInArrow(_merged, "block long, text binary, counts binary"), "lm-blocks", rows=64)
    tmp.drop(answered, *asks)
    return merged, tokens, kinds


def score_texts(documents: DataFrame, train: Column, *, key: str = "doc_id", text: str = "text", block_tokens: int = 1 << 20, rows_per_slice: int = 4000, fan_bits: int = 10) -> DataFrame:
    """Score every text with a model of the rows where ``train`` holds.

    Gives key, held_out, n_tokens, n_known, train_tokens, base_score, score, as a written table;
    keys are integers. The number of partitions follows that of slices, so what a task reads
    doesn't grow with the input.
    """
    with common.Scratch() as tmp:
        given = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
        tree = Tree.of(max(4, int(np.ceil(np.log2(max(1, documents.count() / rows_per_slice))))), fan_bits)
        return _scored(*_counted(given, tree, block_tokens, tmp), key)


def _scored(merged: DataFrame, tokens: int, kinds: int, key: str) -> DataFrame:
    """Scores of all blocks' texts by the mixture learned from their held-out counts."""
    import pyarrow as pa

    spark = merged.sparkSession
    with common.batches_of(spark, 1):  # a row is a block of texts
        cells = merged.select("text", "counts").mapInArrow(_held_out(tokens), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    uniform = 1 / (kinds + 1)
    weights = learn_weights([(c["cell"] >> 40, ((c["cell"] >> 20) & 0xFFFFF) - 1, (c["cell"] & 0xFFFFF) - 1, c["n"]) for c in cells], uniform)

    def run(batches):
        for batch in batches:
            for text_, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Counted.read(text_, counts)
                starts = np.cumsum(own.lengths) - own.lengths
                base = np.log10((own.word + 0.5) / (tokens + 0.5 * (kinds + 1)))
                w = weights[bucket(own.context)]
                p = w[:, 0] * own.pair / np.maximum(own.context, 1) + w[:, 1] * own.word / max(tokens, 1) + w[:, 2] * uniform
                sums = [np.add.reduceat(x, starts) for x in (base, np.log10(p), (own.word > 0).astype(np.int64))]
                n = len(own.ids)
                columns = [pa.array(own.ids, pa.int64()), pa.array(~own.train), pa.array(own.lengths), pa.array(sums[2]), pa.array([tokens] * n, pa.int64()), pa.array(sums[0]), pa.array(sums[1])]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return common.stored(merged.select("text", "counts").mapInArrow(run, f"`{key}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "lm-scores", rows=1)
