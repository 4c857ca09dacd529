"""Boundary cases of expressions and operators."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scope, values as v
from tidemark.operators import match, quality, rows
from tidemark.sources import pages
from tidemark.streaming import fold


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "money", "want"),
    [("60,5", False, 60.5), ("1 200 000,50 zł", True, 1200000.5), ("650.000", True, 650000.0), ("650.000", False, 650.0), ("1.200.000", True, 1200000.0), ("1,2,3", False, None), ("abc", False, None), ("47,5 m²", False, 47.5), (None, False, None)],
)
def test_locale_number(spark, text, money, want):
    assert one(spark, v.locale_number(F.lit(text).cast("string"), money)) == want


def test_numbers(spark):
    assert one(spark, v.positive(F.lit("inf"))) is False
    assert one(spark, v.positive(F.lit("1e5"))) is True
    assert one(spark, v.whole(F.lit("1.5"))) is None
    assert one(spark, v.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, v.opaque_id(F.lit("000"))) is False
    assert one(spark, v.opaque_id(F.lit("001\n"))) is False
    assert one(spark, v.opaque_id(F.lit("001"))) is True
    assert one(spark, v.collapsed(F.lit("  A \t b "))) == "a b"
    assert one(spark, v.aware_utc(F.lit("2024-01-01T00:00:00"))) is None
    assert one(spark, v.canonical_url(F.lit("HTTP://Ex.org/a?utm_x=1&b=2&fbclid=3#f"))) == "http://ex.org/a?b=2"
    assert one(spark, v.within(F.lit(0.1 + 0.2), F.lit(0.3))) is True


def test_audit_bounds_and_conflicts(spark):
    row = ("a", "1", "Warszawa", "100000", "10", "2", "2024-01-01T00:00:00Z")
    frame = spark.createDataFrame(
        [row, ("a", "2", " WARSAW ", "10000001", "500", "2", "2024-01-01T00:00:00Z"), ("a", "3", "Warsaw", None, "50", "", "2024-01-01"), ("a", "4", "Warsaw", "800000", "50", "2", "2024-01-01T00:00:00Z"), ("a", "4", "Warsaw", "800000.0", "50", "2", "2024-01-01T00:00:00Z")],
        "source string, listing_id string, city string, price_pln string, area_m2 string, rooms string, observed_at string",
    )
    got = {(r.listing_id, r.quality_flags, r.quality_status) for r in quality.audit(frame).collect()}
    assert ("1", "", "pass") in got
    assert ("2", "price_above_review_max", "review") in got
    assert ("3", "missing_exact_rooms|missing_price|unverified_timestamp_timezone", "review") in got
    assert ("4", "repeated_identity", "review") in got
    with pytest.raises(ValueError):
        quality.audit(frame.drop("city"))


def test_band_bounds_are_inclusive(spark):
    schema = "k int, id int, area double, price double"
    left = spark.createDataFrame([(1, 1, 50.0, 100.0)], schema)
    right = spark.createDataFrame([(1, 2, 50.25, 101.0), (1, 3, 50.3, 100.0), (1, 4, 49.75, 99.0), (2, 5, 50.0, 100.0)], schema)
    got = {r.r_id: r.reason for r in match.band_pairs(left, right, ["k"]).collect()}
    assert got == {2: None, 4: "area"}


def test_upsert_ties_and_late_rows(spark):
    schema = "k int, x string, at int"
    a = spark.createDataFrame([(1, "old", 5), (2, "old", 9)], schema)
    b = spark.createDataFrame([(1, "new", 5), (2, "late", 3), (3, "new", 1)], schema)
    up = lambda tie: {r.k: (r.x, r.first_seen, r.last_seen) for r in rows.upsert(a, b, ["k"], ["x"], "at", tie).collect()}
    assert up("incoming") == {1: ("new", 5, 5), 2: ("old", 3, 9), 3: ("new", 1, 1)}
    assert up("existing")[1] == ("old", 5, 5)


def test_fold_equals_batch_whatever_the_order(spark):
    e = spark.createDataFrame([(k, k % 3, (k * 7) % 11) for k in range(30)], "event_id int, user_id int, ts int")
    a, b = e.where("event_id < 15"), e.where("event_id >= 15")
    want = set(fold.reduced(e).collect())
    assert set(fold.merged(fold.reduced(a), fold.reduced(b)).collect()) == want
    assert set(fold.merged(fold.reduced(b), fold.reduced(a)).collect()) == want


def test_pages():
    html = '<a href="/x#f">1</a><a rel="next" href="?p=2">2</a><a href="https://o.org/">3</a><script type="application/ld+json">{"@graph":[{"@id":"#a","name":"N"},{"@type":"Offer","price":"7","itemOffered":{"@id":"#a"}}]}</script>'
    assert pages.same_origin_links("https://e.org/l", html) == [("https://e.org/x", False), ("https://e.org/l?p=2", True)]
    ((row, reason),) = pages.listings(html, "https://e.org/")
    assert (row["price"], row["currency"], row["link"], reason) == ("7", None, "https://e.org/", None)
    assert pages.listings('<script type="application/ld+json">{"a":1,"a":2}</script>', "https://e.org/") == []
    assert scope.plain_words("https://e.org/%25C5%2582a-B%C3%B3") == "la bo "
    assert pages.robots_allows([("/a", False), ("/a/b", True)], "/a/b/c") is True
    assert pages.robots_allows([("/a", False), ("/a", True)], "/a") is True
    assert pages.robots_allows([("/*.x$", False)], "/q.x") is False


def test_entry_without_the_subpackage(monkeypatch):
    import sys

    import __spark_entry__

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    names = set(__spark_entry__.queries())
    assert "rank_topk_gap" in names and not any(n.startswith("op") for n in names)
