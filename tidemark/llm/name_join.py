"""Edit-distance name join: pigeonhole segments.

Distances are those of optimal string alignment: insertions, deletions and substitutions of one
code point and exchanges of two neighbours, no substring edited twice. A name of the right side is
cut into ``2 * most + 1`` pieces of near-equal length. ``most`` edits touch at most two pieces each
(an exchange may straddle two), so one piece stays whole. It then stands in the other name, moved by
s code points, where s insertions less deletions lie before it and the rest of the difference in
length, d - s, behind it: |s| + |d - s| <= most. So names of the left side give their substrings at
just these places, and both sides join on length, piece number and substring. Pairs are screened in
the join (letters that differ, plain edit distance within ``2 * most``), then measured exactly.

Names too short for a character a piece are joined separately, by what is left of both names after
up to ``most`` deletions: names within ``most`` edits share such a rest.

Only distinct names are joined. A key that more than ``block`` names of a side hold is dealt in
blocks: each pair of blocks is a join key of its own, so no task gets a whole hot key. Nothing goes
to the driver or into a broadcast that Spark doesn't size itself.

Null and empty names take no part. Repeated rows count as often as they stand, on both sides; rows
of vendors without an id are one vendor, and clients without an id count but are no smallest id and
add nothing to a sum of digests. Empty tables give an empty result.
Extra columns are ignored, whatever their names. Very long names are measured in bounded parts.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Code points of names that one step of ``alignment`` holds at once, per side.
CELLS = 1 << 20


def misspelt(name: Column, key: Column) -> Column:
    """The name with two neighbours exchanged where the key's digest is even and the name has two code points."""
    digest, length = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.length(name)
    at = (digest % F.greatest(length - 1, F.lit(1))).cast("int")
    part = lambda start, count: F.substring(name, start, count)
    exchanged = F.concat(part(F.lit(1), at), part(at + 2, F.lit(1)), part(at + 1, F.lit(1)), part(at + 3, length))
    return F.when((digest % 2 == 0) & (length >= 2), exchanged).otherwise(name)


def alignment(left: list[str], right: list[str], most: int) -> np.ndarray:
    """Distances of pairs of names, ``most + 1`` standing for all that are larger."""
    out = np.full(len(left), most + 1, np.int32)
    lengths = np.array([[len(a), len(b)] for a, b in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
    fitting = np.flatnonzero(np.abs(lengths[:, 0] - lengths[:, 1]) <= most)
    order = fitting[np.argsort(lengths[fitting, 0], kind="stable")]
    start = 0
    while start < len(order):
        step = max(1, CELLS // int(lengths[order[min(start + 1000, len(order) - 1)], 0] + 1))
        rows = order[start : start + step]
        while len(rows) > 1 and len(rows) * (lengths[rows[-1], 0] + most) > CELLS:
            rows = rows[: len(rows) // 2]
        out[rows] = _banded([left[r] for r in rows], [right[r] for r in rows], lengths[rows], most)
        start += len(rows)
    return out


def _points(names: list[str], width: int, none: int) -> np.ndarray:
    out = np.full((len(names), width), none, np.int32)
    for k, name in enumerate(names):
        out[k, : len(name)] = np.frombuffer(name.encode("utf-32-le", "surrogatepass"), "<i4")
    return out


def _banded(left: list[str], right: list[str], lengths: np.ndarray, most: int) -> np.ndarray:
    """The cells within ``most`` of the diagonal, all pairs at once; column o of a row i is the cell (i, i + o - most)."""
    width = int(lengths.max()) + 1
    a, b = _points(left, width, -1), _points(right, width, -2)
    far = most + 1
    before = np.full((len(left), 2 * most + 1), far, np.int32)
    row = before.copy()
    for o in range(most, 2 * most + 1):
        row[:, o] = o - most
    out = np.where(lengths[:, 0] == 0, lengths[:, 1], far)
    for i in range(1, int(lengths[:, 0].max()) + 1):
        new = np.full_like(row, far)
        for o in range(2 * most + 1):
            j = i + o - most
            if j < 0 or j > width:
                continue
            if j == 0:
                new[:, o] = min(i, far)
                continue
            best = row[:, o] + (a[:, i - 1] != b[:, j - 1])
            if o:
                best = np.minimum(best, new[:, o - 1] + 1)
            if o < 2 * most:
                best = np.minimum(best, row[:, o + 1] + 1)
            if i > 1 and j > 1:
                turned = (a[:, i - 1] == b[:, j - 2]) & (a[:, i - 2] == b[:, j - 1])
                best = np.where(turned, np.minimum(best, before[:, o] + 1), best)
            new[:, o] = np.minimum(best, far)
        before, row = row, new
        ended = lengths[:, 0] == i
        out[ended] = row[ended, (lengths[ended, 1] - lengths[ended, 0] + most)]
    return out


def _described(names: DataFrame) -> DataFrame:
    """Distinct names with length and one bit for each letter that occurs an odd number of times: an edit flips two bits at most."""
    letters = F.aggregate(F.split("name", ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(c), F.lit(64)))))
    return names.where("name <> ''").distinct().select("name", F.length("name").alias("length"), letters.alias("letters"))


def _rests(most: int) -> Column:
    """What is left of a name after up to ``most`` deletions."""
    shorter = lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda k: F.concat(F.substring(t, F.lit(1), k - 1), F.substring(t, k + 1, F.length(t))))
    found = F.array(F.col("name"))
    return reduce(lambda so_far, _: F.array_distinct(F.concat(so_far, F.flatten(F.transform(so_far, shorter)))), range(most), found)


def _keyed(names: DataFrame, most: int, whole: bool) -> DataFrame:
    """A row for each key of a name; ``whole`` names give their pieces, the others the substrings where such pieces may stand."""
    pieces = 2 * most + 1
    moves = [(0, 0)] if whole else [(d, s) for d in range(-most, most + 1) for s in range(-most, most + 1) if abs(s) + abs(d - s) <= most]
    places = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(s).alias("s"), F.lit(i).alias("i")) for d, s in moves for i in range(pieces)])
    placed = names.where(F.col("length") >= pieces - (0 if whole else most)).withColumn("place", F.explode(places))
    placed = placed.withColumn("cut", F.col("length") - F.col("place.d")).where(F.col("cut") >= pieces)
    begins, ends = (F.expr(f"cut * (place.i + {k}) div {pieces}").cast("int") for k in (0, 1))
    shift = F.col("place.s")
    placed = placed.withColumns({"begins": begins, "ends": ends}).where((F.col("begins") + shift >= 0) & (F.col("ends") + shift <= F.col("length")))
    text = F.substring("name", F.col("begins") + shift + 1, F.col("ends") - F.col("begins"))
    long = placed.select(F.xxhash64("cut", "place.i", text).alias("key"), "name", "length", "letters")
    few = names.where(F.col("length") < pieces + (0 if whole else most)).withColumn("rest", F.explode(_rests(most)))
    return long.unionByName(few.select(F.xxhash64(F.lit(-1), F.lit(-1), "rest").alias("key"), "name", "length", "letters"))


def _dealt(keyed: DataFrame, blocks: DataFrame, own: str, other: str) -> DataFrame:
    """Rows of hot keys: one block of their own side each, once for every block of the other side."""
    at = keyed.join(blocks, "key", "left").withColumn(own, F.pmod(F.xxhash64("name"), F.coalesce(own, F.lit(1))).cast("int"))
    return at.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))


def name_pairs(left: DataFrame, right: DataFrame, most: int = 2, block: int = 20_000) -> DataFrame:
    """Pairs of distinct names of two frames with a column ``name``, of distance at most ``most``: left, right, distance."""
    with common.Scratch() as tmp:
        a, b = tmp.stored(_described(left.select("name")), "names-left"), tmp.stored(_described(right.select("name")), "names-right")
        a_keys, b_keys = _keyed(a, most, False), _keyed(b, most, True)
        crowded = lambda keyed, as_: keyed.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias(as_))
        blocks = tmp.stored(crowded(a_keys, "a_block").join(crowded(b_keys, "b_block"), "key", "full"), "hot-pieces")
        a_keys, b_keys = _dealt(a_keys, blocks, "a_block", "b_block").alias("a"), _dealt(b_keys, blocks, "b_block", "a_block").alias("b")
        apart = F.abs(F.col("a.length") - F.col("b.length"))
        meets = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("key", "a_block", "b_block")]
        like = [apart <= most, F.bit_count(F.col("a.letters").bitwiseXOR(F.col("b.letters"))) <= 2 * most - apart, F.levenshtein("a.name", "b.name", 2 * most) >= 0]
        found = a_keys.join(b_keys.hint("merge"), reduce(lambda x, y: x & y, meets + like)).select(F.col("a.name").alias("left"), F.col("b.name").alias("right")).distinct()

        def measured(batches):
            for batch in batches:
                of = alignment(batch.column(0).to_pylist(), batch.column(1).to_pylist(), most)
                near = pa.array(of <= most)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near), pa.array(of, pa.int32()).filter(near)], ["left", "right", "distance"])

        return common.stored(found.mapInArrow(measured, "left string, right string, distance int"), "name-pairs", rows=10_000)


def join_names(clients: DataFrame, vendors: DataFrame, most: int = 2, block: int = 20_000) -> DataFrame:
    """For each vendor and distance with a pair: how many clients, the smallest id and the sum of their ids' crc32.

    Takes ``client_id`` and ``name``, ``vendor_id`` and ``name`` as they are; misspell before where that is wanted.
    """
    digest = F.crc32(F.col("client_id").cast("string").cast("binary"))
    of_name = clients.where("name <> ''").groupBy("name").agg(F.count("*").alias("n"), F.min("client_id").alias("first"), F.sum(digest).alias("crc"))
    with common.Scratch() as tmp:
        of_name = tmp.stored(of_name, "client-names")
        pairs = name_pairs(of_name, vendors, most, block)
        tmp.frames.append(pairs)
        said = pairs.join(of_name, F.col("left") == F.col("name")).groupBy("right", "distance").agg(F.sum("n").alias("n_clients"), F.min("first").alias("first_client_id"), F.sum("crc").alias("clients_crc"))
        # a name that a third of the vendors has: its rows are dealt over 16 keys
        spread = said.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(15))))
        rows = vendors.select("vendor_id", F.col("name").alias("right"), F.pmod(F.xxhash64("vendor_id"), F.lit(16)).cast("int").alias("_part"))
        sums = (F.sum("n_clients").alias("n_clients"), F.min("first_client_id").alias("first_client_id"), F.sum("clients_crc").alias("clients_crc"))
        return common.stored(rows.join(spread, ["right", "_part"]).groupBy("vendor_id", "distance").agg(*sums), "name-join", rows=10_000)
