"""Runs over sources, snapshots of inventories, pilots and reports."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.errors import BudgetError, ContractError, InputError
from tidemark.operators import contracts, inventory, quality, report, store
from tidemark.sources import collect, tables
from tidemark.sources.traversal import Cursor, Page, Range

PATHS = {"www.a.example": "/o/[^/]+", "www.b.example": "/o/[^/]+"}


def listing(source, ident, **more):
    return {"source": source, "listing_id": ident, "url": f"https://{source}/o/{ident}", "city": "Warszawa", "price_pln": 100, "area_m2": 50, "rooms": 2, "observed_at": "2026-01-01T00:00:00Z"} | more


def test_sources_fail_alone(spark):
    names = [n for n in contracts.CATALOGUE if n not in ("source", "listing_id", "observed_at")]
    empty = spark.createDataFrame([], ", ".join(f"{n} string" for n in ("source", "listing_id", *names, "first_seen", "last_seen")))
    history = spark.createDataFrame([], "source string, listing_id string, price_pln string, area_m2 string, observed_at string")
    state = empty.select("source", "listing_id", "price_pln", "area_m2", "first_seen", "last_seen")
    progress = spark.createDataFrame([(s, "full", "g", "{}", False, 0, "me", 10, None) for s in (*PATHS, "www.c.example")], "source string, mode string, generation string, checkpoint string, completed boolean, updated_at int, lease_owner string, lease_until int, last_error string")

    def broken(at):
        raise OSError("secret of the page")

    fetchers = {"www.a.example": lambda at: Page([listing("www.a.example", str(10 * at.page + k)) for k in (1, 2)], pages=2), "www.b.example": broken, "www.c.example": lambda at: Page([listing("www.b.example", "1", city="X")], pages=1)}
    done = collect.run(spark, fetchers, dict.fromkeys(fetchers, (empty, history, state)), progress, mode="full", owner="me", generation="g", at=F.lit(5), observed_at="t", paths=PATHS)
    assert {k: o.failure for k, o in done.items()} == {"www.a.example": None, "www.b.example": "source_failed", "www.c.example": "contract_failed"}
    first = done["www.a.example"]
    assert (first.walk.reason, first.requests, first.walk.pages) == ("reported_search_end", 2, 2) and tuple(first.capture.report.first()) == (4, 4, 0, 4)
    assert first.capture.progress.where("source = 'www.a.example' AND completed").count() == 1 and Cursor.of(first.walk.cursor.text(), "www.a.example", "full").finished
    short = collect.run(spark, {"www.a.example": fetchers["www.a.example"]}, {"www.a.example": (empty, history, state)}, progress, mode="full", owner="me", generation="g", at=F.lit(5), observed_at="t", paths=PATHS, limits=contracts.Limits(pages=1))["www.a.example"]
    assert short.walk.reason == "page_budget" and not short.walk.cursor.finished
    budget = collect.Budget(1)
    fetch = budget(fetchers["www.a.example"])
    fetch(Range())
    with pytest.raises(BudgetError):
        fetch(Range())
    with pytest.raises(BudgetError):
        collect.Budget(9, deadline=1.0, clock=lambda: 1.0)(fetchers["www.a.example"])(Range())


def test_snapshots_of_an_inventory(spark):
    headers = spark.createDataFrame([], "source string, scope string, prefix string, observed_at int, digest string, n long")
    current = spark.createDataFrame([], "source string, scope string, listing_id string, status string, last_seen_at int, observed_at int")
    told = lambda **rows: spark.createDataFrame(list(rows.items()), "listing_id string, status string")
    take = lambda state, rows, at, **more: inventory.taken(state.headers, state.current, state.history, rows, **(dict(source="s", scope="one", prefix="p", at=F.lit(at), complete=True) | more))
    start = inventory.Taken("", headers, current, current)
    first = take(start, told(p1="available", p2="sold"), 5)
    second = take(first, told(p2="available"), 7)
    assert {r.listing_id: (r.status, r.last_seen_at, r.observed_at) for r in second.current.collect()} == {"p1": ("missing", 5, 7), "p2": ("available", 7, 7)}
    assert second.history.count() == 4 and take(second, told(p2="available"), 7).verdict == "replay"
    back = take(second, told(p1="available", p2="available"), 9)
    assert {r.listing_id: r.status for r in back.current.collect()} == {"p1": "available", "p2": "available"}
    for rows, at, more in ((told(p2="sold"), 7, {}), (told(p2="sold"), 6, {}), (told(q="sold"), 9, {}), (told(p1="sold"), 9, {"complete": False}), (told(p1="x").where("false"), 9, {}), (told(p1="x").union(told(p1="y")), 9, {}), (told(pq="x"), 9, {"scope": "two", "prefix": "pq"}), (told(p1="x"), 9, {"scope": "two"})):
        with pytest.raises(ContractError):
            take(second, rows, at, **more)
    assert take(second, told(q1="sold"), 1, scope="two", prefix="q").verdict == "new"


def test_pilot_and_report(spark, tmp_path):
    unit = {"number": "A1", "slugNumber": "A1", "id": "u", "city": "T", "investment": "I", "building": "A", "status": "available", "isCommercialUnit": False, "area": 40.5, "rooms": 2, "floor": 0, "price": 500000}
    push = "<script>self.__next_f.push([1,%s])</script>"
    pages = spark.createDataFrame([(1, push % json.dumps("1:" + json.dumps({"apartments": [unit]})))], "page_id long, html string")
    prices = spark.createDataFrame([("A1", 500000.0, 1, 9, None)], "unit_number string, price_pln double, valid_from int, valid_until int, reason string")
    found, broken = collect.pilot(pages, prices, observed_at=F.lit(5), city="T", investment="I", url_base="https://u.example/")
    assert [(r.number, r.verdict) for r in found.collect()] == [("A1", "matched")] and broken.count() == 0
    _, broken = collect.pilot(pages.union(spark.createDataFrame([(2, "<p>")], "page_id long, html string")), prices, observed_at=F.lit(10), city="T", investment="I", url_base="https://u.example/")
    assert {r.verdict: r.n for r in broken.collect()} == {"price_not_valid": 1, "unreadable_page": 1}
    frame = spark.createDataFrame([("www.a.example", "1", "Warszawa", "Wola", "500000", "50", "2", "2026-01-01T00:00:00Z"), ("www.b.example", "2", "warsaw", "wola", "501000", "50", "2", "2026-01-02T00:00:00Z"), ("www.b.example", "2", "X", None, None, "50", None, "2026-01-02T00:00:00")], "source string, listing_id string, city string, district string, price_pln string, area_m2 string, rooms string, observed_at string")
    audited, pairs, said = report.made(frame, {"www.a.example": "www.a.example", "www.b.example": "www.b.example"})
    assert audited.count() == 3 and pairs.count() == said["pairs"] == 1 and said["status_counts"] == {"pass": 1, "review": 2} and said["duplicate_rows"] == 1 and said["flag_counts"]["missing_price"] == 1
    assert said["summary of price_pln"]["median"] == 500500.0 and "## flag_counts" in quality.markdown(said)
    tables.save_bundle(spark, str(tmp_path / "b"), {"audit": audited, "pairs": pairs}, said)
    both = tables.open_snapshot(spark, str(tmp_path / "b"), {"audit": {"columns": ["source", "observed_at"], "renamed": {"observed_at": "seen"}, "sources": ("www.b.example",), "order": ["seen"], "limit": 2}, "pairs": {}})
    assert both["audit"].columns == ["source", "seen"] and both["audit"].count() == 2 and both["pairs"].count() == 1
    with pytest.raises(InputError):
        tables.open_snapshot(spark, str(tmp_path / "b"), {"audit": {"limit": 2}})


def test_tables_are_created_once(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS made LOCATION '{tmp_path}/db'")
    try:
        assert store.create_missing(spark, "made.t", "a int, b string").count() == 0
        spark.createDataFrame([(1, "x")], "a int, b string").write.insertInto("made.t")
        assert store.create_missing(spark, "made.t", "a int, b string", {"a": "int"}).count() == 1
        with pytest.raises(ContractError):
            store.create_missing(spark, "made.t", "a int", {"z": "int"})
    finally:
        spark.sql("DROP DATABASE made CASCADE")
