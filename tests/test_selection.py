"""Every stage of the selection, in its order, and hot rows of the audit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.errors import InputError
from tidemark.operators import quality, selection

BASE = {
    "source": "a.example", "listing_id": "1", "url": "https://a.example/o/flat-1", "city": "Warszawa", "rooms": 2, "floor": 1.0, "price_pln": 200_000.0, "area_m2": 50.0, "observed_at": "2026-01-05T00:00:00Z",
    "predicted_price_pln": 300_000.0, "is_deal": "true", "seen_in_training": "false", "partition": "test",
}
SCHEMA = "source string, listing_id string, url string, city string, rooms int, floor double, price_pln double, area_m2 double, observed_at string, predicted_price_pln double, is_deal string, seen_in_training string, partition string"
NOW = "2026-01-06T00:00:00Z"


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ([{}], None),
        ([{}, {}], None),
        ([{}, {"price_pln": 1.0, "observed_at": "2026-01-01T00:00:00Z"}], None),
        ([{}, {"observed_at": "2026-01-01T00:00:00"}], "unorderable_observation_time"),
        ([{"observed_at": "2026-01-07T00:00:00Z"}], "future_observation"),
        ([{"observed_at": "2025-12-01T00:00:00Z"}], "stale_observation"),
        ([{}, {"price_pln": 210_000.0}], "conflicting_latest_observation"),
        ([{"price_pln": 90_000.0}], "quality_not_pass"),
        ([{"city": "Elsewhere"}], "quality_not_pass"),
        ([{}, {"floor": 2.0}], "conflicting_latest_property_features"),
        ([{"url": "http://a.example/o/flat-1"}], "unsafe_or_noncanonical_url"),
        ([{"url": "https://a.example/o/udzial-1-2-w-mieszkaniu"}], "nonstandard_rights_indicated"),
        ([{"partition": "other"}], "unknown_scoring_provenance"),
        ([{"is_deal": "maybe"}], "unknown_scoring_provenance"),
        ([{"partition": "train", "seen_in_training": "false"}], "contradictory_scoring_provenance"),
        ([{"partition": "test", "seen_in_training": "true"}], "contradictory_scoring_provenance"),
        ([{"predicted_price_pln": -1.0}], "invalid_model_prediction"),
        ([{}, {"predicted_price_pln": 310_000.0}], "conflicting_latest_score"),
        ([{"partition": "train", "seen_in_training": "true"}], "seen_in_training"),
        ([{"is_deal": "0"}], "not_explicitly_flagged_as_deal"),
        ([{"predicted_price_pln": 210_000.0}], "below_discount_threshold"),
    ],
)
def test_stages(spark, changes, reason):
    frame = spark.createDataFrame([tuple((BASE | c).values()) for c in changes], SCHEMA)
    (row,) = selection.judged(frame, F.to_timestamp(F.lit(NOW)), hosts={"a.example": "a.example"}).collect()
    assert row.exclusion_reason == reason


def test_rows_of_no_identity_are_left_out(spark):
    frame = spark.createDataFrame([tuple((BASE | c).values()) for c in ({"listing_id": None}, {"source": "x.example"}, {"source": None})], SCHEMA)
    assert selection.judged(frame, F.to_timestamp(F.lit(NOW)), hosts={"a.example": "a.example"}).count() == 0
    for wrong in ({"max_age_days": 0}, {"threshold": 1.0}):
        with pytest.raises(InputError):
            selection.judged(frame, F.to_timestamp(F.lit(NOW)), **wrong)


def test_rows_without_identity_are_spread(spark):
    """A tenth of the rows has no id: the audit's windows don't gather them."""
    rows = spark.range(20_000).select(F.lit("a").alias("source"), F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("listing_id"), F.lit("Warszawa").alias("city"), (200_000 + F.col("id")).cast("double").alias("price_pln"), F.lit(50.0).alias("area_m2"), F.lit(2).alias("rooms"), F.lit("2026-01-01T00:00:00Z").alias("observed_at"))
    audited = quality.audit(rows)
    assert audited.where("quality_flags LIKE '%repeated%' OR quality_flags LIKE '%conflicting%'").count() == 0
    assert audited.where("quality_flags = 'invalid_listing_id'").count() == 2000
    sizes = [r.n for r in audited.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 3 * np.median(sizes)


def test_quantiles_leave_out_what_is_no_number(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", float("inf")), ("a", 3.0), (None, 5.0), (None, float("-inf")), ("b", float("nan")), ("b", None)], "k string, x double")
    got = {r.k: (r.n, r.q0) for r in quality.quantiles(frame, "x", [0.5], ["k"]).collect()}
    assert got == {"a": (2, 2.0), None: (1, 5.0)}
    assert quality.quantiles(frame, "x", [0.5]).first()["q0"] == 3.0
