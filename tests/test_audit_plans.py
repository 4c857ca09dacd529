"""The audit and the preparation move and sort their rows once, and say what they said."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import values as v
from tidemark.operators import prepare, quality

ROW = "source string, listing_id string, city string, price_pln string, area_m2 string, rooms string, observed_at string"


def steps(frame, name):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return sum(line.lstrip(" :+-*()0123456789").startswith(name) for line in plan.splitlines())


def test_audit_sorts_once(spark):
    audited = quality.audit(spark.createDataFrame([], ROW))
    assert (steps(audited, "Exchange hashpartitioning"), steps(audited, "Sort ")) == (1, 1)


def test_numbers_as_numbers_and_as_texts_give_the_same_flags(spark):
    texts = [("a", str(k % 3), "Warszawa", p, "50", r, "2024-01-01T00:00:00Z") for k, (p, r) in enumerate([("0.0", "2"), ("NaN", "2"), ("800000.0", "1.5"), ("-0.0", "2"), ("Infinity", "3"), ("800000.0", None), (None, "2")])]
    frame = spark.createDataFrame(texts, ROW)
    typed = frame.withColumns({n: F.col(n).cast("double") for n in ("price_pln", "area_m2", "rooms")})
    key = lambda f: sorted((r.listing_id, r.quality_flags, r.quality_status) for r in quality.audit(f).collect())
    assert key(typed) == key(frame)
    assert sum("conflicting_identity_timestamp" in flags for _, flags, _ in key(frame)) == 7


@pytest.mark.parametrize("name", ["warsaw", " WARSAW ", "\tWarsaw", "War saw", "", None, "new  york", "New York"])
def test_city_names(spark, name):
    given = spark.createDataFrame([(name,)], "x string")
    city = ("warsaw", "new york", "odd  name")
    want = F.coalesce(v.collapsed(F.col("x")).isin(*city), F.lit(False))
    assert given.select((quality.within_city(F.col("x"), city) == want).alias("same")).first()["same"]


def test_preparation_moves_rows_once(spark):
    ready = prepare.prepared(spark.createDataFrame([], ROW + ", url string"), F.to_timestamp(F.lit("2024-02-01T00:00:00Z")), keep="latest", hosts={"a": "a.example"}, max_age_days=30)
    assert steps(ready, "Exchange") == 1


def test_old_rows_leave_before_but_spoil_nothing_else(spark):
    day = lambda n, zone="Z": f"2024-01-{n:02}T00:00:00{zone}"
    times = {"1": [day(1), day(20)], "2": [day(1)], "3": [day(20), "2023-01-01T00:00:00"], "4": ["2024-03-01T00:00:00Z", day(20)], "5": [day(2)]}
    rows = [("a", ident, "Warszawa", "800000", "50", "2", at, "https://a.example/x") for ident, ats in times.items() for at in ats]
    frame = spark.createDataFrame(rows, ROW + ", url string")
    how = {"now": F.to_timestamp(F.lit("2024-02-01T00:00:00Z")), "keep": "latest", "hosts": {"a": "a.example"}, "max_age_days": 30}
    told = {r.listing_id: r.exclusion_reason for r in prepare.snapshots(frame, **how).collect()}
    assert told == {"1": None, "2": "stale_current_catalogue", "3": "unorderable_observation_time", "4": "future_observation", "5": None}
    assert sorted(r.listing_id for r in prepare.prepared(frame, **how).collect()) == ["1", "5"]


def test_flags_of_a_snapshot_are_united_as_bits(spark):
    """The union of an instant's flags is the audit's own, by name, and takes no aggregate of objects."""
    rows = [("a.example", "1", "https://a.example/x", "Warszawa", p, s, 2, "2026-01-01T00:00:00Z") for p, s in ((500_000.0, 50.0), (600_000.0, 600.0))]
    rows += [("a.example", "2", "https://a.example/x", "Kraków", 500_000.0, None, 2, "2026-01-01T00:00:00Z"), ("a.example", "3", "https://a.example/x", "Warszawa", 500_000.0, 50.0, 2, "2026-01-01T00:00:00Z")]
    frame = spark.createDataFrame(rows, "source string, listing_id string, url string, city string, price_pln double, area_m2 double, rooms int, observed_at string")
    found = prepare.snapshots(frame, F.to_timestamp(F.lit("2026-02-01T00:00:00Z")), keep="latest", hosts={"a.example": "a.example"})
    told = {r.listing_id: (r.quality_flags, r.exclusion_reason) for r in found.collect()}
    audited = {}
    for r in quality.audit(frame).collect():
        audited.setdefault(r.listing_id, set()).update(r.quality_flags.split("|"))
    assert {k: flags for k, (flags, _) in told.items()} == {k: "|".join(sorted(x - {"", "repeated_identity"})) for k, x in audited.items()}
    assert told["1"] == ("area_above_review_max|conflicting_identity_timestamp|price_per_m2_below_review_min", "conflicting_selected_snapshot")
    assert told["3"] == ("", None)
    assert "ObjectHashAggregate" not in found._jdf.queryExecution().executedPlan().toString()
