"""The quality report of a catalogue: its audit, the pairs to review, and the counts of both as one document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import values as v
from tidemark.operators import match, quality


def made(frame: DataFrame, hosts: dict[str, str], bounds: quality.Thresholds | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """(audited rows, similar pairs, report): the report holds counts and summaries only, so it is small."""
    audited = quality.audit(frame, bounds=bounds)
    pairs = match.candidates(frame, hosts)
    times = frame.select(v.aware_utc(F.col("observed_at").cast("string")).alias("t")).agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count_distinct(F.to_date("t")).alias("days")).first()
    told = quality.repeats(frame.where(~v.missing(F.col("source")) & ~v.missing(F.col("listing_id"))), ["source", "listing_id"]).first()
    excluded = match.normalised(frame, hosts).groupBy(F.coalesce("reason", F.lit("eligible")).alias("reason")).count()
    report = {
        "status_counts": {r["quality_status"]: r["n"] for r in quality.status_counts(audited).collect()},
        "flag_counts": {r["flag"]: r["n"] for r in quality.flag_counts(audited).collect()},
        "missing": {f"{r['source']}: {r['field']}": r["n"] for r in quality.missing_matrix(frame).collect()},
        "identities": told["identities"], "duplicate_rows": told["duplicate_rows"], "pairs": pairs.count(),
        "matching": {r["reason"]: r["count"] for r in excluded.collect()},
        "observed": {"first": str(times["first"]), "last": str(times["last"]), "days": times["days"]},
        **{f"summary of {n}": quality.summary(frame.withColumn(n, F.trim(F.col(n).cast("string"))), n).first().asDict() for n in ("price_pln", "area_m2")},
    }
    return audited, pairs, report
