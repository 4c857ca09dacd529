"""Similar rows of two sources: a band join within blocks.

Rows meet by block and by area bucket: buckets are as wide as the window can be for the largest
area of their size class, and each left row looks into its own and both neighbours, so a dense
block is spread over its buckets instead of meeting in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import values as v
from tidemark.operators import ranks, rows


def band_pairs(left: DataFrame, right: DataFrame, block: list[str], *, area: str = "area", price: str = "price", floor: str | None = None, width: float = 0.1, share: float = 0.005, price_share: float = 0.01) -> DataFrame:
    """Candidate pairs whose areas are within max(width, share of the left one), with the first test that fails.

    Columns: the block, l_* and r_* of both rows, area_diff, price_diff, reason (null: similar).
    Floors, where named, must be equal if both are known.
    """
    ren = lambda f, p: f.select(*block, *[F.col(c).alias(p + c) for c in f.columns if c not in block])
    a, b = ren(left, "l_"), ren(right, "r_")
    # widths grow with the area: buckets of equal width on the scale of ln(area) above the knee
    knee = width / share
    scale = lambda x: F.floor(F.when(x <= knee, x / width).otherwise(F.lit(knee / width) + F.log(x / knee) / -math.log(1 - share))).cast("long")
    a = a.withColumn("_b", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: scale(F.col(f"l_{area}")) + d)))
    b = b.withColumn("_b", scale(F.col(f"r_{area}")))
    l_area, r_area = F.col(f"l_{area}"), F.col(f"r_{area}")
    diff = F.abs(l_area - r_area)
    window = F.greatest(F.lit(width), share * l_area)
    found = a.join(b, [*block, "_b"]).where(diff <= window + 1e-9).drop("_b")
    l_price, r_price = F.col(f"l_{price}"), F.col(f"r_{price}")
    priced = F.abs(l_price - r_price)
    exact = v.within(diff, F.greatest(F.lit(width), share * F.least(l_area, r_area)))
    near = v.within(priced, price_share * F.least(l_price, r_price))
    reason: Column = F.when(~exact, "area")
    if floor:
        reason = reason.when(F.col(f"l_{floor}") != F.col(f"r_{floor}"), "floor")
    reason = reason.when(~near, "price")
    return found.withColumns({"area_diff": diff, "price_diff": priced, "reason": reason})


def budgeted(pairs: DataFrame, order: list[str], accepted: str, max_pairs: int, max_comparisons: int) -> DataFrame:
    """The prefix of candidates that a sequential search with both budgets would look at, each with its number ``n``.

    Numbers and the pairs accepted before each are running sums over range-sorted candidates.
    """
    numbered = ranks.running(pairs, order, {"_a": F.col(accepted).cast("int")}, rank="n")
    return numbered.where((F.col("n") <= max_comparisons) & (F.col("_a") < max_pairs)).drop("_a")


def normalised(frame: DataFrame, hosts: dict[str, str], city: str = "warszawa", alias: str = "warsaw") -> DataFrame:
    """One row for each identity fit for matching, or with the reason why it isn't.

    The latest rows of an identity must agree in what is matched; text is compared in its identity
    form, numbers are plain digits. A floor that isn't a whole number counts as unknown, and is
    said to be (``floor_invalid``). The URL is the smallest safe one of the latest rows.
    """
    c = F.col
    key = ["source", "listing_id"]
    text = lambda n: c(n).cast("string") if n in frame.columns else F.lit(None).cast("string")
    named = v.identity_text(text("city"))
    f = frame.select(
        v.identity_text(c("source")).alias("source"), F.trim(text("listing_id")).alias("listing_id"), v.aware_utc(text("observed_at")).alias("_at"), text("url").alias("url"),
        F.when(named == alias, city).otherwise(named).alias("city"), v.identity_text(text("district")).alias("district"), v.plain_number(text("price_pln")).alias("price"), v.plain_number(text("area_m2")).alias("area"),
        v.plain_whole(text("rooms")).alias("rooms"), v.plain_whole(text("rooms_min")).alias("rooms_min"), v.plain_whole(text("floor"), signed=True).alias("floor"), v.missing(text("floor")).alias("_nofloor"),
    )
    f = f.where(c("source").isin(*hosts) & v.opaque_id(c("listing_id")) & c("_at").isNotNull()).withColumn("floor_invalid", c("floor").isNull() & ~c("_nofloor"))
    f = rows.latest_with_ties(f, key, "_at")
    compared = F.struct("city", "district", "price", "area", "rooms", "rooms_min", "floor", "floor_invalid")
    safe = F.lit(False)
    for source, host in hosts.items():
        safe = safe | ((c("source") == source) & v.safe_url(c("url"), host))
    one = f.groupBy(*key).agg(F.min(compared).alias("_a"), F.max(compared).alias("_b"), F.min(F.when(safe, c("url"))).alias("url"), F.count("*").alias("latest_rows"))
    above = lambda x: F.coalesce(c(x) > 0, F.lit(False))
    out = one.select(*key, "_a.*", "url", "latest_rows", (~c("_a").eqNullSafe(c("_b"))).alias("_mixed"))
    rules = [
        ("ambiguous_latest_match_features", c("_mixed")), ("missing_or_other_city", ~F.coalesce(c("city") == city, F.lit(False))), ("unknown_district", c("district").isNull()),
        ("invalid_price", ~above("price")), ("invalid_area", ~above("area")), ("unknown_exact_rooms", ~above("rooms")), ("contradictory_rooms_min", F.coalesce(c("rooms_min") > c("rooms"), F.lit(False))),
    ]
    return out.withColumn("reason", rows.first_reason(rules)).drop("_mixed")


def candidates(frame: DataFrame, hosts: dict[str, str]) -> DataFrame:
    """Similar listings of two sources, for review: no duplicates are confirmed, and no groups are made.

    Pairs agree in district and exact rooms, and within the tolerances in area and price; order by
    the two identities for a listing of them.
    """
    c = F.col
    left, right = sorted(hosts)
    fit = normalised(frame, hosts).where("reason IS NULL").select("source", "listing_id", "url", "district", "rooms", "area", "price", "floor")
    side = lambda x: fit.where(c("source") == x)
    found = band_pairs(side(left), side(right), ["district", "rooms"], floor="floor").where("reason IS NULL")
    both = c("l_floor").isNotNull() & c("r_floor").isNotNull()
    return found.select(
        *[c(f"{p}_{n}").alias(f"{w}_{n}") for p, w in (("l", "left"), ("r", "right")) for n in ("source", "listing_id", "url")], "district", c("rooms").cast("int").alias("rooms"),
        *[c(f"{p}_{n}").alias(f"{w}_{m}") for n, m in (("area", "area_m2"), ("price", "price_pln")) for p, w in (("l", "left"), ("r", "right"))],
        c("area_diff").alias("area_difference_m2"), (c("price_diff") / F.least("l_price", "r_price")).alias("price_difference_fraction"),
        F.when(both, "both_known_equal").otherwise("unknown").alias("floor_evidence"), F.lit("similar_district_rooms_area_price").alias("evidence"), F.lit("candidate_needs_review").alias("status"),
    )
