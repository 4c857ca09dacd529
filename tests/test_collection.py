"""Bounded files, bundles, traversal and feeds."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import feed, rows
from tidemark.sources import tables, traversal
from tidemark.sources.traversal import Cursor, Page, Range, walk


def test_csv_fails_and_never_cuts(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text('﻿id, price\n007,1e5\n08,"inf"\nNA,\n')
    frame = tables.read_csv(spark, str(good), need=("id",), typed={"price": "double"}, max_rows=3)
    assert [tuple(r) for r in frame.collect()] == [("007", 1e5), ("08", None), ("NA", None)]
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(good), max_rows=2)
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(good), max_bytes=5)
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(good), need=("area",))
    for text in ("a,a\n1,2\n", "a,\n1,2\n", ""):
        (bad := tmp_path / "bad.csv").write_text(text)
        with pytest.raises(ValueError):
            tables.header(spark, str(bad))
    bad.write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        tables.read_csv(spark, str(bad)).collect()
    assert tables.the_one(["price x", "area"], "price") == "price x"
    with pytest.raises(ValueError):
        tables.the_one(["price x", "price y"], "price")


def test_bundle_stays_in_force_until_the_next_is_whole(spark, tmp_path):
    folder = str(tmp_path / "b")
    tables.save_bundle(spark, folder, {"t": spark.range(2)}, {"n": 2})
    with pytest.raises(ValueError):
        tables.save_bundle(spark, folder, {"t": spark.range(5)}, {"n": float("nan")})
    assert tables.open_bundle(spark, folder, "t").count() == 2
    tables.save_bundle(spark, folder, {"t": spark.range(5)})
    assert tables.open_bundle(spark, folder, "t").count() == 5
    with pytest.raises(ValueError):
        tables.compact_json({"x": "y" * 10}, 5)


def test_ranges_and_cursors():
    assert Range().halves() == [Range(None, 1_000_000), Range(1_000_000, None)]
    assert Range(3_000_000).halves() == [Range(3_000_000, 6_000_000), Range(6_000_000, None)]
    assert Range(10, 20).halves() == [Range(10, 15), Range(15, 20)]
    assert Range(10, 11).halves() == [] and Range(600_000_000).halves() == []
    start = Cursor("s", "full")
    assert Cursor.of(start.text(), "s", "full") == start
    for text, source in (("{}", "s"), (start.text(), "t"), (start.text().replace('"page": 1', '"page": 0'), "s")):
        with pytest.raises(ValueError):
            Cursor.of(text, source, "full")


def test_walk():
    row = lambda k, x=0: {"listing_id": str(k), "url": f"u{k}", "x": x}
    saved = {1: [row(1), row(2)], 2: [row(2, 5), row(3)], 3: [row(4)]}
    fetch = lambda at: Page(saved[at.page], 3)
    whole = walk(Cursor("s", "m"), fetch, max_pages=9, max_listings=9)
    assert (whole.reason, len(whole.rows), whole.duplicates, whole.conflicts, whole.cursor.queue) == ("reported_search_end", 4, 1, 1, ())
    assert whole.rows["2"]["x"] == 5
    part = walk(Cursor("s", "m"), fetch, max_pages=2, max_listings=9)
    assert part.reason == "page_budget" and walk(part.cursor, fetch, max_pages=9, max_listings=9).rows.keys() == {"4"}
    assert walk(Cursor("s", "m"), fetch, max_pages=9, max_listings=2).cursor.queue == (Range(page=2),)
    assert walk(Cursor("s", "m"), lambda at: Page([row(1)], 3), max_pages=9, max_listings=9).reason == "repeated_page"
    capped = walk(Cursor("s", "m"), lambda at: Page([], 1, capped=at.upper is None or at.upper - (at.lower or 0) > 400_000_000), max_pages=999, max_listings=9)
    assert capped.reason == "reported_search_end" and all(u["upper"] is None for u in capped.cursor.unresolved)
    with pytest.raises(ValueError):
        walk(Cursor("s", "m"), lambda at: Page([row(1), row(2) | {"url": "u1"}], 1), max_pages=1, max_listings=9)


def test_feed_contract_clauses(spark):
    good = {"feed": 1, "position": 1, "source": "a", "listing_id": "1", "url": "https://a.org/x", "district": None, "price_pln": 80.0, "area_m2": 5.0, "rooms": 2, "predicted_price_pln": 100.0, "model_gap_fraction": 0.2, "model_gap_pln": 20.0, "observed_at": "2024-01-01T00:00:00Z"}
    wrong = {
        None: {}, "unknown_source": {"source": "b"}, "invalid_listing_id": {"listing_id": "0"}, "unsafe_url": {"url": "http://a.org/x"}, "invalid_values": {"rooms": None}, "invalid_district": {"district": "x" * 121},
        "invalid_observation_time": {"observed_at": "2024-01-01"}, "invalid_gap": {"model_gap_fraction": 0.21},
    }
    made = [good | {"feed": k} | w for k, w in enumerate(wrong.values())] + [good | {"feed": 100, "position": 2, "listing_id": "2"}, good | {"feed": 100, "price_pln": 84.0, "model_gap_fraction": 0.16, "model_gap_pln": 16.0}] + [good | {"feed": 101}] * 2
    schema = "feed int, position int, source string, listing_id string, url string, district string, price_pln double, area_m2 double, rooms int, predicted_price_pln double, model_gap_fraction double, model_gap_pln double, observed_at string"
    out = feed.violations(spark.createDataFrame([tuple(m.values()) for m in made], schema), "feed", F.to_timestamp(F.lit("2024-01-02T00:00:00Z")), {"a": "a.org"})
    got = {(r.feed, r.position): r.violation for r in out.collect()}
    assert [got[k, 1] for k in range(len(wrong))] == list(wrong)
    assert got[100, 1] is None and got[100, 2] == "increasing_gap" and got[101, 1] == "repeated_listing"


def test_freshness_and_artifacts(spark):
    at = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-08"), (3, "2024-01-10")], "k int, d string").select("k", F.col("d").cast("timestamp").alias("at"))
    moment = lambda x: F.lit(x).cast("timestamp")
    got = {r.k: r.stale for r in feed.fresh(at, F.col("at"), moment("2024-01-07"), moment("2024-01-08")).collect()}
    assert got == {1: False, 2: False}
    whole = {"features": ["x"], "metadata": {"trained_at_utc": "2024-01-01T00:00:00+00:00", "capture_time": "2024-01-01T00:00:00+00:00", "split": {"type": "temporal"} | {p: {"listing_keys": [["a", "1"]]} for p in ("train", "validation", "test")}}}
    assert feed.artifact_errors(whole, ["x"], 5) == []
    assert feed.artifact_errors(whole | {"metadata": None}, ["y"], 0) == ["size", "features", "trained_at", "capture_time", "split_type", "split_parts"]
    assert feed.artifact_errors(None, [], 1) == ["not_an_artifact"]


def test_signals_and_nulls(spark):
    robots = spark.createDataFrame([(1, "Content-Signal: search=yes, ai-train=no\nCONTENT-SIGNAL: search=no,ai-input"), (2, None), (3, "")], "k int, t string")
    assert {tuple(r) for r in traversal.content_signals(robots, "k", "t").collect()} == {(1, "search", "no"), (1, "ai-train", "no")}
    assert rows.domain_counts(robots, "t", ["x"]).first().n == 0


def test_distance_of_unknown_places(spark):
    from tidemark.functions import values as v

    places = spark.createDataFrame([(None, 21.0), (52.0, None), (52.2297, 21.0122)], "lat double, lon double")
    assert [r.km for r in places.select(v.haversine_km(F.col("lat"), F.col("lon")).alias("km")).collect()] == [None, None, 0.0]
