"""Contracts of record batches: every row gets the first reason that it breaks one for, and a batch is taken whole or not at all.

Rules are (reason, condition) pairs over texts; the same rules serve a report (rows with reasons)
and a boundary (an error with the reasons' counts).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import BudgetError, ContractError
from tidemark.functions import values as v
from tidemark.operators.rows import first_reason

c = F.col
#: Fields of a sparse catalogue record (fixed values).
CATALOGUE = ("source", "listing_id", "url", "city", "district", "price_pln", "area_m2", "rooms", "rooms_min", "floor", "build_year", "latitude", "longitude", "distance_km", "published_at", "observed_at")
#: Fields that a price record needs (fixed values).
PRICED = ("source", "listing_id", "url", "city", "price_pln", "area_m2", "observed_at")
NUMBERS, WHOLE = ("price_pln", "area_m2", "latitude", "longitude", "distance_km"), ("rooms", "rooms_min", "floor", "build_year")


def there(text: Column) -> Column:
    return ~v.missing(text.cast("string"))


def _numbers(frame: DataFrame, fields: tuple[str, ...]) -> tuple[Column, dict[str, Column]]:
    """Whether any of the numbers is malformed, and the numbers."""
    bad, out = F.lit(False), {}
    for name in fields:
        if name in frame.columns:
            out[name], wrong = v.stored_number(c(name), name in WHOLE)
            bad = bad | wrong
    return bad, out


def with_reason(frame: DataFrame, rules: list[tuple[str, Column]], key: list[str] | None = None) -> DataFrame:
    """The frame with ``reason``: the first rule that a row breaks, ``repeated_identity`` where its key comes again, null if none."""
    rules = [(name, F.coalesce(test, F.lit(False))) for name, test in rules]
    if key:
        frame = frame.withColumn("_again", F.count("*").over(Window.partitionBy(*key)) > 1)
        rules.append(("repeated_identity", c("_again")))
    return frame.withColumn("reason", first_reason(rules)).drop("_again")


def catalogue_reasons(frame: DataFrame, paths: dict[str, str], city: str = "Warszawa") -> DataFrame:
    """Catalogue records with the reason that each is refused for.

    ``paths``: for each source (the URL's host) the pattern of a listing's path. Price, area and
    rooms may be null; time must name its zone; an exact number of rooms is at least the minimum.
    """
    if set(frame.columns) != set(CATALOGUE):
        raise ContractError(f"not the fields of a catalogue record: {sorted(set(frame.columns) ^ set(CATALOGUE))}")
    bad, number = _numbers(frame, NUMBERS + WHOLE)
    url_fits = F.lit(False)
    for host, path in paths.items():
        url_fits = url_fits | ((c("source") == host) & c("url").rlike(r"\Ahttps://" + host.replace(".", r"\.") + path + r"\z") & ~c("url").rlike(r"[?#\x00-\x20\x7f\\]"))
    none_or_above = lambda n: n.isNull() | (n > 0)
    positive = [none_or_above(number[n]) for n in ("price_pln", "area_m2", "rooms", "rooms_min")]
    rules = [
        ("invalid_identity", ~(F.coalesce(c("source").isin(*paths), F.lit(False)) & v.opaque_id(c("listing_id")))),
        ("other_city", ~c("city").eqNullSafe(F.lit(city))),
        ("invalid_url", ~F.coalesce(url_fits, F.lit(False))),
        ("invalid_district", F.length(F.trim("district")) > 120),
        ("invalid_number", bad),
        ("not_positive", ~(positive[0] & positive[1] & positive[2] & positive[3])),
        ("contradictory_rooms", number["rooms"] < number["rooms_min"]),
        ("invalid_time", v.aware_utc(c("observed_at").cast("string")).isNull() | (c("published_at").isNotNull() & v.aware_utc(c("published_at").cast("string")).isNull())),
    ]
    return with_reason(frame, rules, ["source", "listing_id"])


def price_reasons(frame: DataFrame) -> DataFrame:
    """Price records with the reason that each is refused for; the texts of an identity must not be blank, numbers must be numbers."""
    if lost := set(PRICED) - set(frame.columns):
        raise ContractError(f"missing fields: {sorted(lost)}")
    bad, number = _numbers(frame, NUMBERS + WHOLE)
    blank = ~(there(c("source")) & there(c("listing_id")) & there(c("url")) & there(c("city")))
    rules = [("blank_identity", blank), ("invalid_number", bad | number["price_pln"].isNull() | number["area_m2"].isNull()), ("invalid_time", v.aware_utc(c("observed_at").cast("string")).isNull())]
    return with_reason(frame, rules)


def preview_reasons(frame: DataFrame, fields: tuple[str, ...], rooms: tuple[int, int]) -> DataFrame:
    """Preview records (all features known) with reasons; ``rooms``: the least and greatest exact number."""
    if set(frame.columns) != set(fields):
        raise ContractError(f"not the fields of a preview record: {sorted(set(frame.columns) ^ set(fields))}")
    bad, number = _numbers(frame, tuple(n for n in NUMBERS + WHOLE if n in fields))
    rules = [
        ("invalid_identity", ~v.opaque_id(c("listing_id"))),
        ("invalid_number", bad),
        ("not_positive", ~(v.positive(c("price_pln")) & v.positive(c("area_m2")))),
        ("rooms_out_of_domain", ~F.coalesce(number["rooms"].between(*rooms), F.lit(False))),
    ]
    return with_reason(frame, rules, ["source", "listing_id"])


def reason_counts(frame: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of each reason: by, reason (``accepted`` for none), n."""
    return frame.groupBy(*(by or []), F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


def demanded(frame: DataFrame, what: str) -> DataFrame:
    """The batch without its reasons, or a ContractError with their counts if any row has one."""
    broken = frame.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n")).collect()  # a row for each rule
    if broken:
        raise ContractError(what, {r["reason"]: r["n"] for r in sorted(broken)})
    return frame.drop("reason")


@dataclass(frozen=True)
class Limits:
    """A run's budgets, each within its bounds."""

    pages: int = 50
    requests: int = 700
    listings: int = 50_000
    seconds_between: float = 2.0

    def __post_init__(self):
        tests = {"pages": (1, 1000), "requests": (1, 700), "listings": (1, 50_000)}
        for name, (least, most) in tests.items():
            value = getattr(self, name)
            if type(value) is not int or not least <= value <= most:
                raise BudgetError(f"{name} must be a whole number from {least} to {most}")
        if isinstance(self.seconds_between, bool) or not 2 <= self.seconds_between < float("inf"):
            raise BudgetError("at least two seconds between requests")


def capture_errors(capture: dict, *, source: str, mode: str, observed_at: str, limits: Limits) -> list[str]:
    """What a capture's own account contradicts: its scope, its time, or a budget."""
    used = {name: capture.get(name) for name in ("pages", "requests", "listings")}
    tests = {
        "source": capture.get("source") == source,
        "mode": capture.get("mode") == mode,
        "observed_at": capture.get("observed_at") == observed_at,
        **{name: type(n) is int and 0 <= n <= getattr(limits, name) for name, n in used.items()},
    }
    return [name for name, fits in tests.items() if not fits]


def summed(parts: list[dict[str, int]]) -> dict[str, int]:
    """Statistics of several phases added by name."""
    out: dict[str, int] = {}
    for part in parts:
        for name, n in part.items():
            out[name] = out.get(name, 0) + n
    return out
