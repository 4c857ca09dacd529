"""Whole pipelines, stores and files against hand-made expectations."""


import pytest
from pyspark.sql import functions as F

from tidemark.errors import BudgetError, ContractError, InputError, InsufficientDataError
from tidemark.operators import contracts, match, model, prepare, quality, store
from tidemark.sources import files, tables
from tidemark.sources.ledger import Ledger
from tidemark.streaming import fold

HOSTS = {"www.a.example": "www.a.example", "www.b.example": "www.b.example"}
PATHS = {h: r"/o/[^/]+" for h in HOSTS}


def test_seeded_history_to_ranking(spark):
    seen = files.seeded(spark)
    assert seen.count() == 200 and seen.select("source", "listing_id").distinct().count() == 180
    assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, files.seeded(spark).collect()))
    text = seen.withColumn("observed_at", F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    now = F.to_timestamp(F.lit("2026-02-02T00:00:00Z"))
    train = prepare.prepared(text, now, keep="earliest", hosts=HOSTS)
    latest = prepare.prepared(text, now, keep="latest", hosts=HOSTS)
    assert train.count() == latest.count() == 180 and latest.where("day(observed_at) = 31").count() == 20
    parts = model.disjoint(model.dealt(train))
    sizes = {r.partition: (r.rows, r.days) for r in model.split_report(parts).collect()}
    assert sizes == {"train": (108, 18), "validation": (36, 6), "test": (36, 6)}
    learned = model.Preprocessor.fitted(parts.where("partition = 'train'"))
    fitted = model.trained(parts, learned, trees=60).ensemble
    told = model.scored(model.predicted(latest, learned, fitted), parts)
    assert told.where("is_deal <> (discount >= 0.15)").count() == 0 and told.where("partition = 'unseen'").count() == 0
    test = model.predicted(parts.where("partition = 'test'"), learned, fitted)
    plain = parts.where("partition = 'test'").withColumn("predicted_price_pln", F.lit(parts.where("partition = 'train'").agg(F.median("price_pln")).first()[0]))
    assert model.compared(test, plain)["better"]
    assert model.predicted(latest.where("false"), learned, fitted).columns == [*latest.columns, "predicted_price_pln"]
    with pytest.raises(InsufficientDataError):
        model.dealt(train.limit(29))
    with pytest.raises(InsufficientDataError):
        model.dealt(train.withColumn("observed_at", F.to_timestamp(F.lit("2026-01-01"))))
    groups = model.disjoint(model.dealt(train, "group"))
    assert {r.partition for r in groups.select("partition").distinct().collect()} == set(model.PARTS)
    with pytest.raises(ContractError):
        model.disjoint(parts.union(parts.where("partition = 'train'").limit(1).withColumn("partition", F.lit("test"))))


def test_preprocessor_ignores_what_it_has_not_seen(spark):
    frame = spark.createDataFrame([(1.0, None, "a"), (2.0, None, None), (float("inf"), None, "a")], "x double, y double, k string")
    learned = model.Preprocessor.fitted(frame, ("x", "y"), "k")
    assert learned.fills == {"x": 1.5, "y": 0.0} and learned.known == ("Unknown", "a")
    other = spark.createDataFrame([(None, 3.0, "z"), (9.0, float("nan"), None)], "x double, y double, k string")
    assert [tuple(r[n] for n in learned.names()) for r in learned.applied(other).collect()] == [(1.5, 3.0, 0.0, 0.0), (9.0, 0.0, 1.0, 0.0)]
    assert [r.f_x for r in learned.applied(frame).collect()] == [1.0, 2.0, 1.5]


def test_quantiles_equal_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    for values in ([1.0, 2.0], [5.0], [-3.0, 0.0, 2.0, 1e9, -1e-9], rng.normal(size=500).tolist() + [0.25] * 300, (rng.integers(0, 5, 99) * 1.0).tolist()):
        frame = spark.createDataFrame([("g", x) for x in values] + [("h", 1.0), ("g", None)], "k string, x double")
        got = {r.k: r for r in quality.quantiles(frame, "x", [0.0, 0.01, 0.5, 0.77, 1.0], ["k"]).collect()}
        assert got["g"].n == len(values) and [got["g"][f"q{i}"] for i in range(5)] == pytest.approx(np.quantile(values, [0.0, 0.01, 0.5, 0.77, 1.0]).tolist())
        assert got["h"].q2 == 1.0
    assert quality.quantiles(frame.where("false"), "x", [0.5]).first().q0 is None


def test_clean_keeps_the_valid_and_the_late(spark):
    good = ("a", "1", " WARSAW ", "100.0", "50", "2", "2026-01-01T00:00:00Z", None, "Sale", "999", None)
    names = "source string, listing_id string, city string, price_pln string, area_m2 string, rooms string, observed_at string, availability_observed_at string, transaction_type string, latitude string, distance_km string"
    bad = [good[:k] + (v,) + good[k + 1 :] for k, v in ((2, "Kraków"), (3, "inf"), (4, "0"), (5, "1.5"), (5, None), (6, "someday"), (8, "rent"), (0, " "), (1, None))]
    later = good[:3] + ("120",) + good[4:6] + ("2026-01-05T00:00:00Z",) + good[7:]
    status = good[:3] + ("90",) + good[4:7] + ("2026-02-01T00:00:00Z",) + good[8:]
    frame = spark.createDataFrame([good, *bad, later, status, ("a", "001", *good[2:])], names)
    first = {r.listing_id: r for r in prepare.clean(frame).collect()}
    assert set(first) == {"1", "001"} and first["001"].price_per_m2 == 2.0 and first["1"].city == "Warszawa" and first["1"].latitude is None
    assert {r.listing_id: r.price_pln for r in prepare.clean(frame, "latest").collect()} == {"1": 90.0, "001": 100.0}
    assert prepare.clean(frame.where("false")).count() == 0
    with pytest.raises(InputError):
        prepare.clean(frame.drop("rooms"))
    with pytest.raises(ContractError):
        prepare.available(frame.withColumn("availability_status", F.lit("gone")))


def record(**more):
    base = dict.fromkeys(contracts.CATALOGUE) | {"source": "www.a.example", "listing_id": "7", "url": "https://www.a.example/o/x", "city": "Warszawa", "price_pln": "100", "area_m2": "50", "rooms": "2", "observed_at": "2026-01-01T00:00:00Z"}
    return base | more


def records(spark, *rows):
    return spark.createDataFrame([tuple(r[n] for n in contracts.CATALOGUE) for r in rows], ", ".join(f"{n} string" for n in contracts.CATALOGUE))


def test_record_contracts(spark):
    bad = {
        "invalid_identity": record(listing_id="0"), "other_city": record(city="warszawa"), "invalid_url": record(url="https://www.b.example/o/x"), "invalid_district": record(district="x" * 121), "invalid_number": record(floor="1.5"),
        "not_positive": record(area_m2="0"), "contradictory_rooms": record(rooms_min="3"), "invalid_time": record(observed_at="2026-01-01T00:00:00"), None: record(price_pln=None, rooms=None, rooms_min="4"),
    }
    for k, (why, row) in enumerate(bad.items()):
        row = row if why == "invalid_identity" else row | {"listing_id": str(k + 1)}
        assert [r.reason for r in contracts.catalogue_reasons(records(spark, row), PATHS).collect()] == [why]
    twice = contracts.catalogue_reasons(records(spark, record(), record()), PATHS)
    assert {r.reason for r in twice.collect()} == {"repeated_identity"}
    with pytest.raises(ContractError) as found:
        contracts.demanded(twice, "batch")
    assert found.value.reasons == {"repeated_identity": 2}
    with pytest.raises(ContractError):
        contracts.catalogue_reasons(records(spark, record()).drop("floor"), PATHS)
    with pytest.raises(BudgetError):
        contracts.Limits(pages=0)
    with pytest.raises(BudgetError):
        contracts.Limits(seconds_between=1.9)
    assert contracts.capture_errors({"source": "a", "mode": "m", "observed_at": "t", "pages": 51, "requests": 1, "listings": 0}, source="a", mode="x", observed_at="t", limits=contracts.Limits()) == ["mode", "pages"]
    assert contracts.summed([{"a": 1}, {"a": 2, "b": 3}]) == {"a": 3, "b": 3}


def test_captures_commit_whole_or_not_at_all(spark):
    names = [n for n in contracts.CATALOGUE if n not in ("source", "listing_id", "observed_at")]
    empty = records(spark).withColumnRenamed("observed_at", "last_seen").withColumn("first_seen", F.col("last_seen"))
    history = records(spark).select("source", "listing_id", "price_pln", "observed_at")
    current = empty.select("source", "listing_id", "price_pln", "first_seen", "last_seen")
    progress = spark.createDataFrame([("www.a.example", "full", "g1", "{}", False, 0, "me", 10, "old"), ("www.b.example", "full", "g1", "{}", False, 0, "me", 10, None)], "source string, mode string, generation string, checkpoint string, completed boolean, updated_at int, lease_owner string, lease_until int, last_error string")
    ask = dict(source="www.a.example", mode="full", owner="me", generation="g1", checkpoint='{"page":2}', completed=False, at=F.lit(5), paths=PATHS, values=["price_pln"])
    batch = records(spark, record(), record(listing_id="8", price_pln=None))
    done = store.captured(empty.select("source", "listing_id", *names, "first_seen", "last_seen"), history, current, progress, batch, **ask)
    assert sorted(r.listing_id for r in done.catalogue.collect()) == ["7", "8"] and [r.listing_id for r in done.appended.collect()] == ["7"]
    assert tuple(done.report.first()) == (1, 1, 0, 1)
    assert {r.source: (r.checkpoint, r.updated_at, r.last_error) for r in done.progress.collect()} == {"www.a.example": ('{"page":2}', 5, None), "www.b.example": ("{}", 0, None)}
    again = store.captured(done.catalogue, done.appended.select(*history.columns), done.current, done.progress, records(spark, record(price_pln="999")), **ask)
    assert {r.listing_id: r.price_pln for r in again.catalogue.collect()} == {"7": "100", "8": None} and tuple(again.report.first()) == (1, 0, 1, 0)
    for wrong in ({"owner": "you"}, {"generation": "g0"}, {"at": F.lit(10)}, {"source": "www.b.example"}, {"checkpoint": "x" * 300_000}):
        with pytest.raises(ContractError):
            store.captured(empty.select("source", "listing_id", *names, "first_seen", "last_seen"), history, current, progress, batch, **(ask | wrong))


def test_retries_and_tables(spark, tmp_path):
    waits, calls = [], []

    def failing():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "done"

    assert store.retried(failing, sleep=waits.append) == "done" and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        store.retried(lambda: (_ for _ in ()).throw(OSError()), sleep=waits.append)
    with pytest.raises(KeyError):
        store.retried(lambda: {}["x"], sleep=waits.append)
    with pytest.raises(InputError):
        store.scan(spark.range(3).withColumn("source", F.lit("a")), ["id"], limit=2)
    assert store.scan(spark.range(3).withColumn("source", F.lit("a")), ["id"], limit=3).count() == 3


PRICES = "﻿ Unit ,Kind,From,Until,Town,Base price of the flat (PLN),Price of an m2\nA1/01,Flat,2026-07-01T00:00:00+02:00,2026-08-01T00:00:00+02:00,Town,\"500 000,50\",X\nP1,Parking,,,,,\n"


@pytest.mark.parametrize(
    ("line", "why"),
    [
        (None, None), ("A1/02,House,2026-07-01T00:00:00Z,2026-08-01T00:00:00Z,Town,5,", "other_property_type"), ("A1/02,Flat,2026-07-01T00:00:00Z,2026-08-01T00:00:00Z,Else,5,", "other_context"), ("a,Flat,2026-07-01T00:00:00Z,2026-08-01T00:00:00Z,Town,5,", "invalid_unit"),
        ('A1/02,Flat,2026-07-01T00:00:00Z,2026-08-01T00:00:00Z,Town,"1,2.3",', "invalid_price"), ("A1/02,Flat,2026-07-01T00:00:00Z,2026-08-01T00:00:00Z,Town,5,-1", "invalid_price_per_area"), ("A1/02,Flat,2026-07-01T00:00:00+01:00,2026-08-01T00:00:00Z,Town,5,", "invalid_time"),
        ("A1/02,Flat,2026-08-01T00:00:00Z,2026-07-01T00:00:00Z,Town,5,", "reversed_interval"), ("A1/02,Flat,2026-01-01T00:00:00Z,2026-02-01T00:00:00Z,Town,5,", "not_of_the_day"), ("A1/01,Flat,2026-07-01T00:00:00Z,2026-08-01T00:00:00Z,town,5,7.5", "repeated_identity"),
    ],
)
def test_price_files(spark, tmp_path, line, why):
    path = tmp_path / "p.csv"
    path.write_text(PRICES + (line + "\n" if line else ""), encoding="utf-8")
    layout = files.Layout({"unit_number": "Unit", "property_type": "Kind", "valid_from": "From", "valid_until": "Until"}, "Base price", "Price of", {"Town": "town"}, "Flat", ("Parking",), r"\A[AB][0-3]/[0-9]{2}\z")
    got = files.price_file(spark, str(path), layout, F.lit("2026-07-15").cast("date")).collect()
    first = next(r for r in got if r.unit_number == "A1/01" and r.price_pln == 500000.5)
    assert first.price_per_m2_pln is None and len(got) == 1 + bool(line)
    assert {r.reason for r in got} == ({None, why} if why != "repeated_identity" else {why})


def test_saved_pages_and_pilots(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/a.html").write_bytes("﻿<p>é".encode())
    (tmp_path / "pages/b.html").write_bytes(b"<p>")
    assert sorted(r.html for r in files.saved_pages(spark, str(tmp_path / "pages")).collect()) == ["<p>", "<p>é"]
    for limit in ({"max_file": 4}, {"max_total": 8}, {"max_pages": 1}):
        with pytest.raises(InputError):
            files.saved_pages(spark, str(tmp_path / "pages"), **limit)
    units = spark.createDataFrame([("A1", "sold", 1.0)], "number string, status string, area_m2 double")
    files.save_pilot(spark, str(tmp_path / "out"), units, {"n": 1}, statuses_only=True)
    assert tables.open_bundle(spark, str(tmp_path / "out"), "statuses").columns == ["number", "status"]
    page = quality.markdown({"status": {"a|b": 1, "c": 2}, "rows": 3})
    assert "| a\\|b | 1 |" in page and "* rows: 3" in page


def test_matching_inputs(spark):
    rows = [
        ("www.a.example", "1", "Warsaw", "Wola", "500000", "50", "2", None, "1", "https://www.a.example/b"), ("www.a.example", "1", "Warszawa", " WOLA", "500000", "50", "2", None, "1", "https://www.a.example/a"),
        ("www.b.example", "2", "Warszawa", "wola", "504000.0", "50.1", "2", None, "x", "http://www.b.example/a"), ("www.b.example", "3", "Warszawa", "wola", "500000", "50", "2", None, "2", None),
        ("www.b.example", "4", "Warszawa", "brak", "500000", "50", "2", None, None, None), ("www.b.example", "5", "Warszawa", "wola", "5e5", "50", "2", None, None, None), ("www.b.example", "6", "Warszawa", "wola", "500000", "50", "2", "3", None, None), ("www.c.example", "7", "Warszawa", "wola", "500000", "50", "2", None, None, None),
    ]
    frame = spark.createDataFrame([(*r, "2026-01-01T00:00:00Z") for r in rows], "source string, listing_id string, city string, district string, price_pln string, area_m2 string, rooms string, rooms_min string, floor string, url string, observed_at string")
    told = {r.listing_id: r for r in match.normalised(frame, HOSTS).collect()}
    assert {k: r.reason for k, r in told.items()} == {"1": None, "2": None, "3": None, "4": "unknown_district", "5": "invalid_price", "6": "contradictory_rooms_min"}
    assert (told["1"].url, told["2"].url, told["2"].floor_invalid, told["1"].latest_rows) == ("https://www.a.example/a", None, True, 2)
    (pair,) = match.candidates(frame, HOSTS).collect()
    assert (pair.left_listing_id, pair.right_listing_id, pair.floor_evidence) == ("1", "2", "unknown") and len(pair) == 17


def test_fold_goes_on_and_counts_once(spark, tmp_path):
    def put(name, rows):
        spark.createDataFrame(rows, "event_id long, user_id long, ts long").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "tmp"))
        (tmp_path / "in").mkdir(exist_ok=True)
        next((tmp_path / "tmp").glob("*.parquet")).rename(tmp_path / "in" / name)

    put("a.parquet", [(1, 1, 10), (2, 1, 20), (3, 2, 5)])
    run = lambda: {r.user_id: (r.event_id, r.first_seen, r.last_seen, r.n) for r in fold.folded(spark, str(tmp_path / "in"), folder=str(tmp_path / "state")).collect()}
    assert run() == {1: (2, 10, 20, 2), 2: (3, 5, 5, 1)}
    put("b.parquet", [(2, 1, 20), (4, 1, 5), (5, 2, 9)])  # a replayed event, a late one, a new one
    assert run() == {1: (2, 5, 20, 3), 2: (5, 5, 9, 2)}
    put("c.parquet", [(1, 1, 10)])
    assert run() == {1: (2, 5, 20, 3), 2: (5, 5, 9, 2)} and run() == {1: (2, 5, 20, 3), 2: (5, 5, 9, 2)}
    assert Ledger(spark, str(tmp_path / "state" / "ledger")).table("history").count() == 5
