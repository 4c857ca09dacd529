"""The edit-distance name join against brute force."""

import collections
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import name_join


def osa(a, b):
    cells = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        cells[i][j] = min(cells[i - 1][j] + 1, cells[i][j - 1] + 1, cells[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            cells[i][j] = min(cells[i][j], cells[i - 2][j - 2] + 1)
    return cells[-1][-1]


def names(count, seed):
    """Short and long names over few letters, some beyond the basic plane, and close copies of them."""
    rng, out = random.Random(seed), []
    while len(out) < count:
        name = "".join(rng.choice("abé😀 ") for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 9, 12, 16])))
        out.append(name)
        for _ in range(2):
            for _ in range(rng.randint(1, 3)):
                at = rng.randint(0, max(0, len(name) - 1))
                name = rng.choice([name[:at] + rng.choice("abc") + name[at:], name[:at] + name[at + 1 :], name[:at] + "b" + name[at + 1 :], name[:at] + name[at + 1 : at + 2] + name[at : at + 1] + name[at + 2 :]])
            out.append(name)
    return out[:count]


@pytest.mark.parametrize(("most", "block"), [(2, 20_000), (2, 5), (1, 20_000)])
def test_pairs_equal_brute_force(spark, most, block):
    left, right = names(260, 1) + [None, "", "x" * 3000, "x" * 2999 + "y"], names(90, 2) + [None, "", "y" + "x" * 2999]
    frames = [spark.createDataFrame([(n,) for n in side], "name string").withColumn("key", F.lit(1)) for side in (left, right)]
    got = {(r.left, r.right): r.distance for r in name_join.name_pairs(*frames, most=most, block=block).collect()}
    want = {(a, b): d for a in set(left) - {None, ""} for b in set(right) - {None, ""} if abs(len(a) - len(b)) <= most and (d := osa(a, b) if len(a) < 2000 else 1 + a.endswith("y")) <= most}
    assert got == want
    assert len(want) > 60


def test_no_substring_is_edited_twice():
    assert name_join.alignment(["ca", "ab", "abc", "", "a"], ["abc", "ba", "abc", "ab", "wxyz"], 2).tolist() == [3, 1, 0, 2, 3]
    assert name_join.alignment([], [], 2).tolist() == []


def test_vendors_add_up(spark):
    """Repeated rows, null ids and names, a name of a third of all rows, clashing extra columns."""
    clients = [(i, "Ann Berg") for i in range(40)] + [(None, "Ann Berg"), (7, None), (8, ""), (9, "Anne Berg"), (10, "Bob"), (10, "Bob")]
    vendors = [(1, "Ann Berg"), (1, "Ann Berg"), (2, None), (3, ""), (4, "Bo"), (None, "Bobs")] + [(i, "Ann Bergh") for i in range(100, 120)]
    c = spark.createDataFrame(clients, "client_id long, name string").withColumns({"vendor_id": F.lit("x"), "distance": F.lit(1), "key": F.lit(2)})
    v = spark.createDataFrame(vendors, "vendor_id long, name string").withColumns({"n": F.lit("x"), "left": F.lit(1), "_part": F.lit(3)})
    want = collections.defaultdict(list)
    for (ident, a), (vendor, b) in itertools.product(clients, vendors):
        if a and b and (d := osa(a, b)) <= 2:
            want[vendor, d].append(ident)
    got = {(r.vendor_id, r.distance): (r.n_clients, r.first_client_id, r.clients_crc) for r in name_join.join_names(c, v).collect()}
    assert got == {k: (len(ids), min(i for i in ids if i is not None), sum(zlib.crc32(str(i).encode()) for i in ids if i is not None)) for k, ids in want.items()}
    assert name_join.join_names(c.limit(0), v).count() == 0 == name_join.join_names(c, v.limit(0)).count()


def test_misspelt_names(spark):
    rows = [(i, n) for i, n in enumerate(["", "a", "ab", "Ann", "Élan 😀x", None] * 5)] + [(None, "ab")]

    def spelt(ident, name):
        h = zlib.crc32(b"" if ident is None else str(ident).encode())
        if name is None or h % 2 or len(name) < 2:
            return name
        at = h % (len(name) - 1)
        return name[:at] + name[at + 1] + name[at] + name[at + 2 :]

    frame = spark.createDataFrame(rows, "vendor_id long, name string").select("vendor_id", "name", name_join.misspelt(F.col("name"), F.col("vendor_id")).alias("said"))
    assert all(r.said == spelt(r.vendor_id, r.name) for r in frame.collect())
