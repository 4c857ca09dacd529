"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become pieces of at most ``length`` tokens, packed by bulk-synchronous best-fit:

* all pieces are range-sorted over the cluster, long before short, and numbered within their
  length: each task numbers its own, and a task's first number is the count of the tasks before it;
* gaps (sequences with room) are sorted by room. Gaps of one room with neighbouring numbers are
  kept as one run, and so are the pieces of one length, so what a round sweeps is bounded by
  ``length`` and not by the input;
* a round takes the longest pieces left and sweeps the gaps upwards from the smallest that holds
  them (the successor). Of pieces that want the same gaps, those of lowest rank get them, as many
  to a gap as fit; pieces that find no gap open sequences. Gaps taken are put back with the room
  left to them, and the next round begins;
* each task then sweeps its sorted pieces along the sorted runs that the rounds gave out, and so
  finds every piece's sequence and offset.

The number of sequences is that of best-fit decreasing over all pieces at once. The driver holds
a count for each length and task that has it (a task has neighbouring lengths, so these are at
most ``length`` more than there are tasks), and about a dozen runs for each length.

The string of an added token of the JSON vocabulary in a text gets that token's id. Very long texts
are tokenised whole. A text that the fast tokenizer refuses, as its regular expression has no depth
for runs of about a million white-space characters, goes to the ``tokenizers`` library, which gives
the same ids from the JSON file.
A null or empty text is a document of the end token alone. Repeated rows are packed as rows of
their own, equal and null keys included: ranks are by row, so they part like any others. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from functools import partial
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.merge_replay import load_ranks

_encoders: dict = {}


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of the JSON vocabulary beside a file of ranks; none where there is no such file."""
    beside = Path(path).with_suffix(".json")
    if not beside.exists():
        return {}
    return {t["content"]: t["id"] for t in json.loads(beside.read_text(encoding="utf-8"))["added_tokens"]}


def encoder(path: str, pattern: str):
    """A worker's tokenizer over a file of ranks: the fast route to the ids of the JSON vocabulary beside it."""
    if (path, pattern) not in _encoders:
        import tiktoken

        _encoders[path, pattern] = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens=added_tokens(path))
    return _encoders[path, pattern]


def encode_with(path: str, pattern: str):
    """A function from a text to its ids, for texts of any length and make."""
    fast = partial(encoder(path, pattern).encode, allowed_special="all")

    def encode(text: str) -> list[int]:
        try:
            return fast(text)
        except ValueError:  # the expression's stack
            beside = str(Path(path).with_suffix(".json"))
            if beside not in _encoders:
                from tokenizers import Tokenizer

                _encoders[beside] = Tokenizer.from_file(beside)
            return _encoders[beside].encode(text, add_special_tokens=False).ids

    return encode


def cut(total: int, length: int) -> list[tuple[int, int]]:
    """Start and length of each piece: all are full but the first, which takes the rest."""
    first = total % length or length
    return [(0, first)] + [(at, length) for at in range(first, total, length)]


def pieces_of(documents: DataFrame, path: str, pattern: str, *, end: int = 0, length: int = 2048, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise and cut: key, piece, start, length, ids_crc32 and, if asked for, the ids as binary."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    key_type = documents.schema[key].dataType
    arrow_key = to_arrow_type(key_type)
    names = [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [key_type.simpleString(), "int", "long", "long", "long"] + ["binary"] * with_ids

    def run(batches):
        encode = encode_with(path, pattern)
        for batch in common.sliced(batches):
            out: list[list] = [[] for _ in names]
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(t or ""), end], "<u4")
                for piece, (at, n) in enumerate(cut(len(ids), length)):
                    part = ids[at : at + n].tobytes()
                    row = [k, piece, at, n, zlib.crc32(part)] + [part] * with_ids
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            types = [arrow_key, pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return documents.select(key, text).mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, kinds, strict=True)))


def rounds(counts: dict[int, int], length: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing over counts: the runs given out, and the number of sequences opened.

    ``counts``: pieces of each length. A run says where the pieces of one size from one rank on
    go: size, first rank, pieces to a gap, first sequence, offset in the sequence. Runs are
    sorted by size and rank.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # room: runs of sequences that have it, as (first, how many)
    given, opened = [], 0
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        for room in [*sorted(r for r in gaps if r >= size), length + 1]:
            if room > length:  # no gap is left: as many new ones as the pieces need
                room, need = length, -(-left // (length // size))
                runs, opened = [(opened, need)] if need else [], opened + need
            else:
                runs = gaps.pop(room)[::-1]
            for first, n in runs:
                while n and left:
                    each = min(room // size, left)
                    filled = min(n, left // each)
                    given.append((size, rank, each, first, length - room))
                    if room > each * size:
                        gaps.setdefault(room - each * size, []).append((first, filled))
                    rank, left, first, n = rank + filled * each, left - filled * each, first + filled, n - filled
                if n:
                    gaps.setdefault(room, []).append((first, n))
            if not left:
                break
    return np.array(sorted(given), np.int64).reshape(-1, 5), opened


def _numbered(pieces: DataFrame) -> DataFrame:
    """Pieces range-sorted by length, long ones first: ``_task`` and ``_at``, a piece's number among those of its length in that task."""
    import pyarrow as pa

    names = pieces.columns

    def run(batches):
        from pyspark import TaskContext

        task, size, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            start = np.r_[0, np.nonzero(np.diff(lengths))[0] + 1]
            at = np.arange(len(lengths)) - np.repeat(start, np.diff(np.r_[start, len(lengths)]))
            if not len(lengths):
                continue
            if lengths[0] == size:
                at[: len(lengths) if len(start) == 1 else start[1]] += seen
            size, seen = lengths[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(np.full(len(at), task, np.int32)), pa.array(at)], [*names, "_task", "_at"])

    fixed = common.stored(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")  # the range sort samples them, and ranks need fixed rows
    order = [F.col("length").desc(), F.col("_row")]
    schema = pieces.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    ranged = fixed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"{schema}, _task int, _at long")
    numbered = common.stored(ranged, "ranked-pieces")
    common.forget(fixed)
    return numbered


def pack(pieces: DataFrame, *, length: int = 2048) -> DataFrame:
    """Give each piece its sequence_id and its offset there; offsets leave no gap from 0 on. The result is a written table."""
    import pyarrow as pa

    names = pieces.columns
    numbered = _numbered(pieces)
    counted = sorted((r["length"], r["_task"], r["n"]) for r in numbered.groupBy("length", "_task").agg(F.count("*").alias("n")).collect())
    before, totals = {}, {}
    for size, task, n in counted:
        before[task, size] = totals.get(size, 0)
        totals[size] = before[task, size] + n
    runs, _ = rounds(totals, length)
    sent = numbered.sparkSession.sparkContext.broadcast((before, runs))

    def run(batches):
        first, given = sent.value
        starts = given[:, 0] << 44 | given[:, 1]  # ranks below 2**44
        for batch in batches:
            size, at = batch.column("length").to_numpy(), batch.column("_at").to_numpy()
            of = np.stack([batch.column("_task").to_numpy(), size])
            which, place = np.unique(of, axis=1, return_inverse=True)
            rank = at + np.array([first[t, s] for t, s in which.T.tolist()], np.int64)[place.ravel()] if len(at) else at
            own = given[np.searchsorted(starts, size << 44 | rank, side="right") - 1] if len(at) else np.zeros((0, 5), np.int64)
            along = rank - own[:, 1]
            each = np.maximum(own[:, 2], 1)
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(own[:, 3] + along // each), pa.array(own[:, 4] + along % each * size)], [*names, "sequence_id", "offset"])

    schema = pieces.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    placed = common.stored(numbered.mapInArrow(run, f"{schema}, sequence_id long, offset long"), "packed", rows=10_000)
    common.forget(numbered)
    return placed


def sequences(placed: DataFrame) -> DataFrame:
    """The packed rows themselves, of pieces that carry ``ids``: sequence_id, ids, and where each piece begins.

    A sequence has at most ``length`` tokens, so no group is large.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(b"").cast("binary"), lambda all_, x: F.concat(all_, x["ids"])).alias("ids"),
        F.col("p.offset").alias("starts"),
    )
