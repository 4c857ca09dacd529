"""Tables and cursors that change together: commits, streams of saved pages, buckets, keyed state, table functions."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.errors import BudgetError, ContractError
from tidemark.operators import inventory
from tidemark.sources import collect, udtf
from tidemark.sources.ledger import Change, Ledger
from tidemark.sources.traversal import Cursor, Page, walk
from tidemark.streaming import captures, fold, inventories

HOW = {"source": "www.a.example", "mode": "full", "owner": "me", "generation": 1, "at": 5, "paths": {"www.a.example": "/o/[^/]+"}, "buckets": 4}


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def values(ledger, name, **more):
    return sorted(r.v for r in ledger.table(name, **more).collect())


def test_commits_are_whole_or_not_at_all(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"))
    assert ledger.table("a") is None
    first = ledger.commit({"a": Change(rows(spark, 1)), "b": Change(rows(spark, 7), "replace")}, scope="s", batch="0", cursor="c0")
    assert (first.version, first.cursors) == (0, {"s": "c0"})

    def killed():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        ledger.commit({"a": Change(rows(spark, 2)), "b": Change(rows(spark, 8), "replace")}, scope="s", batch="1", cursor="c1", before_log=killed)
    assert values(ledger, "a") == [1] and values(ledger, "b") == [7] and ledger.entry() == first
    second = ledger.commit({"a": Change(rows(spark, 2)), "b": Change(rows(spark, 8), "replace")}, scope="s", batch="1", generation=3, cursor="c1")
    assert values(ledger, "a") == [1, 2] and values(ledger, "b") == [8] and values(ledger, "a", entry=ledger.entry(0)) == [1]
    assert ledger.commit({"a": Change(rows(spark, 99))}, scope="s", batch="1", generation=3) == second  # a replay
    with pytest.raises(ContractError, match="newer generation"):
        ledger.commit({"a": Change(rows(spark, 99))}, scope="s", batch="2", generation=2)
    with pytest.raises(ContractError, match="came first"):
        ledger.commit({"a": Change(rows(spark, 99))}, scope="t", batch="0", read=first)
    assert values(ledger, "a") == [1, 2]
    for n in range(3, 9):
        ledger.commit({"a": Change(rows(spark, n))}, scope="s", batch=str(n), generation=3)
    ledger.compacted("a", most=3)
    assert values(ledger, "a") == [1, 2, 3, 4, 5, 6, 7, 8] and len(ledger.entry().parts["a"]["all"]) == 1
    assert ledger.vacuum(keep=1) and values(ledger, "a") == [1, 2, 3, 4, 5, 6, 7, 8] and values(ledger, "b") == [8]


def test_a_commit_touches_its_buckets_only(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"))
    by = {"by": ("v",), "buckets": 16}
    ledger.commit({"a": Change(rows(spark, *range(100)), **by)}, scope="s", batch="0", read=None)
    before = ledger.entry().parts["a"]
    ledger.commit({"a": Change(rows(spark, 5), "replace", **by)}, scope="s", batch="1")
    after = ledger.entry().parts["a"]
    changed = [b for b in after if after[b] != before.get(b)]
    assert len(changed) == 1 and values(ledger, "a", buckets=[int(changed[0])]) == [5]


def test_fold_reads_the_buckets_of_its_batch(spark, tmp_path):
    events = spark.createDataFrame([(u, e, 10 * e) for u in range(40) for e in range(3)], "user_id long, event_id long, ts long")
    ledger = Ledger(spark, str(tmp_path / "l"))
    assert len(fold.step(ledger, events, "0", buckets=8)) == 8
    assert fold.step(ledger, events.where("user_id = 3"), "0", buckets=8) == []  # a replay
    one = spark.createDataFrame([(3, 9, 99), (3, 1, 10)], "user_id long, event_id long, ts long")
    assert len(fold.step(ledger, one, "1", buckets=8)) == 1
    got = {r.user_id: (r.event_id, r.last_seen, r.n) for r in ledger.table("state").collect()}
    assert len(got) == 40 and got[3] == (9, 99, 4) and got[4] == (2, 20, 3)


def page(spark, *listed):
    """Pages of (page_id, listing, price, day)."""
    graph = lambda k, price: json.dumps({"@type": "RealEstateListing", "identifier": str(k), "url": f"https://www.a.example/o/{k}", "offers": {"@type": "Offer", "price": price, "priceCurrency": "PLN"}, "mainEntity": {"@type": "Apartment", "floorSize": 50, "numberOfRooms": 2, "address": {"addressLocality": "Warszawa"}}})
    made = [(p, "https://www.a.example/s", f'<script type="application/ld+json">{graph(k, price)}</script>', f"2026-01-{day:02d}T00:00:00Z") for p, k, price, day in listed]
    return spark.createDataFrame(made, captures.PAGE)


def test_captures_commit_tables_and_cursor_together(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"))
    with pytest.raises(ContractError, match="lease"):
        captures.taken(ledger, page(spark, (1, 11, 100, 1)), "0", **HOW)
    captures.leased(ledger, source="www.a.example", mode="full", owner="me", generation=1, at=0)
    account = captures.taken(ledger, page(spark, (1, 11, 100, 1), (2, 12, 200, 1), (3, 13, 0, 1)), "0", **HOW)
    assert {n: account[n] for n in ("pages", "listings", "accepted", "inserted")} == {"pages": 3, "listings": 3, "accepted": 2, "inserted": 2}
    entry = ledger.entry()

    def killed():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        captures.taken(ledger, page(spark, (4, 11, 110, 2)), "1", before_log=killed, **HOW)
    assert ledger.entry() == entry
    assert captures.taken(ledger, page(spark, (4, 11, 110, 2)), "0", **HOW)["replay"] and ledger.entry() == entry
    captures.taken(ledger, page(spark, (4, 11, 110, 2)), "1", **HOW)
    assert ledger.entry().cursors["www.a.example/full"] == '{"batch":1}'
    prices = lambda name: sorted((r.listing_id, float(r.price_pln)) for r in ledger.table(name).collect())
    assert prices("current") == [("11", 110.0), ("12", 200.0)] and prices("history") == [("11", 100.0), ("11", 110.0), ("12", 200.0)] and prices("catalogue") == prices("current")
    assert ledger.table("progress").first().checkpoint == '{"batch":1}' and ledger.table("accounts").count() == 2
    captures.leased(ledger, source="www.a.example", mode="full", owner="other", generation=2, at=9)
    with pytest.raises(ContractError):
        captures.taken(ledger, page(spark, (5, 11, 120, 3)), "2", **HOW)
    assert prices("current") == [("11", 110.0), ("12", 200.0)]


def snapshots(seed):
    """Snapshots of two scopes in any order, replays, conflicts and partial ones among them."""
    rng, out = random.Random(seed), []
    for scope, at in itertools.product("xy", range(1, 5)):
        units = [(f"p{i}", rng.choice(["available", "sold"])) for i in range(6) if rng.random() < 0.6]
        out.append((scope, at, True, units or [("p0", "sold")]))
    out += [out[1], (*out[2][:3], [("p9", "sold")]), ("x", 9, False, [("p1", "sold")]), ("y", 9, True, []), ("y", 8, True, [("p1", "sold"), ("p1", "sold")])]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_keyed_state_equals_the_batch_operator(spark, tmp_path, seed):
    arriving = snapshots(seed)
    with inventories.keyed_state(spark):
        (tmp_path / "in").mkdir()
        stream = spark.readStream.schema(inventories.SNAPSHOT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        query = lambda: inventories.settled(stream).writeStream.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(str(tmp_path / "out" / f"b={n}"))).outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        for k, one in enumerate(arriving):
            spark.createDataFrame([one], inventories.SNAPSHOT).coalesce(1).write.parquet(str(tmp_path / "in" / f"s{k:03d}"))
            if k in (4, len(arriving) - 1):  # two runs on one checkpoint
                query()
    told = spark.read.schema(inventories.TOLD).parquet(str(tmp_path / "out" / "*"))
    got = {(r.scope, r.listing_id): (r.status, r.last_seen_at) for r in inventories.current(told).collect()}
    state, last, digests = {}, {}, {}
    for scope, at, complete, units in arriving:
        fits = complete and units and len(dict(units)) == len(units) and (scope, at) not in digests and last.get(scope, -1) <= at
        if fits:
            digests[scope, at], last[scope] = units, at
            now = inventory.settled(
                spark.createDataFrame([(i, s, n, n) for (x, i), (s, n) in state.items() if x == scope], "listing_id string, status string, last_seen_at long, status_at long"), spark.createDataFrame(units, "listing_id string, status string"), ["listing_id"], F.lit(at)
            )
            state.update({(scope, r.listing_id): (r.status, r.last_seen_at) for r in now.collect()})
    assert got == state
    refused = sorted(r.verdict for r in told.where("verdict <> 'new'").collect())
    assert {"partial", "not_one_row_for_each_id"} <= set(refused) and len(refused) == len(arriving) - len(digests)


def test_table_functions(spark):
    udtf.register(spark)
    html = '<a href="/a">x</a><a href="b" rel="next">y</a><script type="application/ld+json">[{"@type":"Offer","price":5},{"@type":"Apartment","name":"rent"}]</script>'
    spark.createDataFrame([(1, html), (2, None), (3, "<p>")], "k int, html string").createOrReplaceTempView("some_pages")
    found = spark.sql("SELECT k, position, price, refused FROM some_pages, LATERAL listings(html, 'https://a.example/x/')").collect()
    assert sorted(map(tuple, found)) == [(1, 0, "5", None), (1, 1, None, "rental")]
    links = spark.sql("SELECT k, link, is_next FROM some_pages, LATERAL links(html, 'https://a.example/x/')").collect()
    assert sorted(map(tuple, links)) == [(1, "https://a.example/a", False), (1, "https://a.example/x/b", True)]
    states = spark.sql("SELECT k, state, reason FROM some_pages, LATERAL states(html, 'units') ORDER BY k").collect()
    assert [r.k for r in states] == [1, 3] and all(r.state is None and r.reason for r in states)
    with pytest.raises(Exception, match="takes texts"):
        spark.sql("SELECT * FROM listings(1, 'x')").collect()


def test_spent_budgets_are_told_and_keep_what_was_read():
    row = lambda n: {"listing_id": str(n), "url": f"https://a/{n}"}
    budget = collect.Budget(2)
    done = walk(Cursor("s", "full"), budget(lambda at: Page([row(at.page)], 5)), max_pages=9, max_listings=9)
    assert (done.reason, len(done.rows), done.cursor.queue[0].page) == ("request_budget", 2, 3)
    late = collect.Budget(9, deadline=0.0, clock=lambda: 1.0)
    done = walk(Cursor("s", "full"), late(lambda at: Page([row(at.page)], 5)), max_pages=9, max_listings=9)
    assert (done.reason, done.rows) == ("deadline", {})
    with pytest.raises(BudgetError):
        raise BudgetError("request_budget")


def test_daily_sample(spark, tmp_path):
    field = {n: "1" for n in collect.PREVIEW} | {"district": "D", "observed_at": "2026-01-02T00:00:00Z"}
    preview = lambda source, *rows, **more: spark.createDataFrame([tuple((field | {"source": source, "listing_id": str(k), "price_pln": str(p)} | more)[n] for n in collect.PREVIEW) for k, p in rows], ", ".join(f"{n} string" for n in collect.PREVIEW))
    old = lambda source: spark.createDataFrame([(source, "1", "5", "1", "2026-01-01T00:00:00Z")], "source string, listing_id string, price_pln string, area_m2 string, observed_at string")
    kept = {s: (old(s), old(s).withColumns({"first_seen": F.col("observed_at"), "last_seen": F.col("observed_at")}).drop("observed_at")) for s in "abc"}
    out = collect.daily(spark, str(tmp_path / "d"), {"a": preview("a", (1, 6), (2, 7)), "b": preview("b", (1, 6), rooms="1.5"), "c": preview("x", (1, 6))}, kept)
    assert {s: r["status"] for s, r in out.items()} == {"a": "ok", "b": "failed", "c": "failed"} and collect.status_of(out) == "partial"
    assert (out["a"]["seen_listings"], out["a"]["new_listings"], out["a"]["observations_inserted"]) == (2, 1, 2) and out["b"]["counts"] == {"invalid_number": 1}
    from tidemark.sources import tables

    assert sorted((r.listing_id, r.price_pln) for r in tables.open_bundle(spark, str(tmp_path / "d" / "a"), "current").collect()) == [("1", "6"), ("2", "7")]


def test_pilot_becomes_a_snapshot(spark):
    found = spark.createDataFrame([("A1", "available"), ("A2", "sold")], "number string, status string")
    none = spark.createDataFrame([], "verdict string, n long")
    headers = spark.createDataFrame([], "source string, scope string, prefix string, observed_at int, digest string, n long")
    units = spark.createDataFrame([("s", "one", "pA9", "available", 1, 1)], "source string, scope string, listing_id string, status string, last_seen_at int, observed_at int")
    how = {"source": "s", "scope": "one", "prefix": "p", "at": F.lit(7)}
    done = collect.piloted(found, none, headers, units, units.limit(0), **how)
    assert done.verdict == "new" and sorted((r.listing_id, r.status, r.last_seen_at) for r in done.current.collect()) == [("pA1", "available", 7), ("pA2", "sold", 7), ("pA9", "missing", 1)]
    assert collect.piloted(found, none, done.headers, done.current, done.history, **how).verdict == "replay"
    with pytest.raises(ContractError, match="reconcile"):
        collect.piloted(found, spark.createDataFrame([("prices_disagree", 2)], "verdict string, n long"), headers, units, units, **how)
