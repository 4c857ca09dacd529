"""Byte-level BPE encoding by corpus-level merge replay, and decoding.

A task takes the distinct words of its block of texts as one corpus, laid out as one array of
symbols. An inverted index leads from each mergeable token pair to its positions in the words;
the merges are applied in rank order, each to all of its positions at once, and only the pairs
of the touched neighbours enter the index anew. The words' ids are then put together text by
text. Nothing is shuffled, and a task holds one block at a time.

Null and empty texts have no ids. Repeated rows are encoded alike, and extra columns are kept
out of the result. Empty tables give empty results. A word of any length is encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm import common

NONE = np.int32(2**31 - 1)
#: Bytes of text and distinct words that a block may gather before it is encoded.
BLOCK_BYTES = 24 << 20


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Merges of a vocabulary, and their replay over a list of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._by_pair: dict[int, int] = {}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], np.fromiter(pairs.values(), np.int64, len(pairs))[order]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NONE where there is none."""
        if not len(self.keys):
            return np.full(len(left), NONE, np.int64)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def _one(self, word: bytes) -> list[int]:
        """One word by itself: the lowest rank first, the leftmost of equals, from a heap of pairs."""
        symbol: list[int] = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(symbol)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        merged = dict(zip(self.keys.tolist(), self.merged.tolist(), strict=True)) if not self._by_pair else self._by_pair
        self._by_pair = merged
        heap = [(rank, k) for k in range(n - 1) if (rank := merged.get(symbol[k] << 32 | symbol[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            nxt = after[k]
            if nxt < 0 or symbol[k] < 0 or merged.get(symbol[k] << 32 | symbol[nxt]) != rank:
                continue  # a part of it went into another merge
            symbol[k], symbol[nxt], after[k] = rank, -1, after[nxt]
            if after[nxt] >= 0:
                before[after[nxt]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] >= 0 and (found := merged.get(symbol[left] << 32 | symbol[after[left]])) is not None:
                    heapq.heappush(heap, (found, left))
        return [x for x in symbol if x >= 0]

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word; a word that is a token itself has that id alone."""
        out: list[np.ndarray | None] = [None] * len(words)
        rest = []
        for k, word in enumerate(words):
            if (rank := self.ranks.get(word)) is not None:
                out[k] = np.array([rank], "<u4")
            elif word:
                rest.append(k)
            else:
                out[k] = np.empty(0, "<u4")
        if not rest:
            return out
        sizes = np.array([len(words[k]) for k in rest])
        symbol = self.single[np.frombuffer(b"".join(words[k] for k in rest), np.uint8)]
        total, ends = len(symbol), np.cumsum(sizes)
        owner = np.repeat(np.arange(len(rest)), sizes)
        after, before = np.arange(1, total + 1), np.arange(-1, total - 1)
        after[ends - 1], before[ends - sizes] = -1, -1
        alive, odd = np.ones(total, bool), set()
        start = np.nonzero(after >= 0)[0]
        rank = self._rank(symbol[start], symbol[after[start]])
        start, rank = start[rank < NONE], rank[rank < NONE]
        order = np.argsort(rank, kind="stable")
        start, rank = start[order], rank[order]
        cuts = np.nonzero(np.diff(rank))[0] + 1
        index: dict[int, list[np.ndarray]] = {int(r): [p] for r, p in zip(rank[np.r_[0, cuts]] if len(rank) else [], np.split(start, cuts), strict=False)}
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            now = heapq.heappop(heap)
            found = index.pop(now, None)
            if found is None:
                continue
            at = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            at = at[alive[at] & (after[at] >= 0)]
            at = at[self._rank(symbol[at], symbol[after[at]]) == now]
            nxt = after[at]
            if len(at) > 1 and np.isin(nxt, at, assume_unique=True).any():  # runs like aaa: every other one, from the left
                taken, last = [], -1
                for p, q in zip(at.tolist(), nxt.tolist(), strict=True):
                    if p != last:
                        taken.append(p)
                        last = q
                at = np.array(taken)
                nxt = after[at]
            if not len(at):
                continue
            symbol[at], alive[nxt] = now, False
            far = after[nxt]
            after[at] = far
            before[far[far >= 0]] = at[far >= 0]
            left = before[at]
            touched = np.concatenate([left[left >= 0], at[far >= 0]])
            rank = self._rank(symbol[touched], symbol[after[touched]])
            touched, rank = touched[rank < NONE], rank[rank < NONE]
            if len(rank):
                if (low := rank < now).any():  # a lower merge came up late: such words are encoded one by one below
                    odd.update(owner[touched[low]].tolist())
                order = np.argsort(rank, kind="stable")
                touched, rank = touched[order], rank[order]
                cuts = np.nonzero(np.diff(rank))[0] + 1
                for r, p in zip(rank[np.r_[0, cuts]].tolist(), np.split(touched, cuts), strict=True):
                    if r in index:
                        index[r].append(p)
                    else:
                        index[r] = [p]
                        heapq.heappush(heap, r)
        counts = np.bincount(owner[alive], minlength=len(rest))
        for k, ids in zip(rest, np.split(symbol[alive].astype("<u4"), np.cumsum(counts)[:-1]), strict=True):
            out[k] = ids
        for k in odd:
            out[rest[k]] = np.array(self._one(words[rest[k]]), "<u4")
        return out


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Codec:
    """Texts to ids and back, with a pattern that parts a text into words."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.replay, self.pattern = MergeReplay(load_ranks(path)), regex.compile(pattern)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; the texts are one corpus."""
        numbers = _Numbers()
        parted = [np.array(list(map(numbers.__getitem__, self.pattern.findall(t))), np.int32) if t else () for t in texts]
        ids = [x.tobytes() for x in self.replay.encode([w.encode("utf-8", "replace") for w in numbers])]
        return [b"".join([ids[k] for k in words.tolist()]) if len(words) else b"" for words in parted]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.replay.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """A worker's codec; each worker loads it once."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _blocks(batches, most: int):
    """Lists of (key, text) of up to ``most`` bytes of text; one longer text is a block of its own."""
    block, held = [], 0
    for batch in common.sliced(batches):
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            block.append((key, text))
            held += len(text or "")
            if held >= most:
                yield block
                block, held = [], 0
    if block:
        yield block


def encode_documents(documents: DataFrame, path: str, pattern: str, *, key: str = "doc_id", text: str = "text", with_ids: bool = True, digests: bool = False) -> DataFrame:
    """Encode every text: key, n_tokens, then ids (binary) and, for ``digests``, checksums of the ids and of what they decode to."""
    import pyarrow as pa

    columns = [f"{key} {documents.schema[key].dataType.simpleString()}", "n_tokens long"]
    columns += ["ids binary"] * with_ids + ["ids_sha256 string", "decoded_sha256 string"] * digests

    def run(batches):
        own = codec(path, pattern)
        for block in _blocks(batches, BLOCK_BYTES):
            ids = own.encode([t for _, t in block])
            out = [[k for k, _ in block], [len(x) // 4 for x in ids]] + [ids] * with_ids
            if digests:
                out.append([hashlib.sha256(x).hexdigest() for x in ids])
                out.append([hashlib.sha256(own.decode(x)).hexdigest() for x in ids])
            yield pa.RecordBatch.from_arrays([pa.array(c) if k else pa.array(c, batch_type) for k, c in enumerate(out)], [c.split()[0] for c in columns])

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(documents.schema[key].dataType)
    return documents.select(key, text).mapInArrow(run, ", ".join(columns))


def decode_documents(encoded: DataFrame, path: str, pattern: str, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of encoded rows: key, text; null ids give the empty text."""
    from pyspark.sql import functions as F

    @F.udf("string", useArrow=True)
    def text(x):
        return codec(path, pattern).decode(x or b"").decode("utf-8", "replace")

    return encoded.select(key, text(ids).alias("text"))
