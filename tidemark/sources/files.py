"""Saved pages, price files of a fixed layout, seeded observations, and what a pilot leaves behind."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import InputError
from tidemark.functions import values as v
from tidemark.operators import contracts
from tidemark.sources import tables

c = F.col


def saved_pages(spark: SparkSession, path: str, *, max_file: int = 8 << 20, max_total: int = 64 << 20, max_pages: int = 1000) -> DataFrame:
    """HTML files as page_id, path, html: UTF-8 with or without a byte order mark; too large or too many files are an error, and none is read before that is known."""
    files = spark.read.format("binaryFile").load(path)
    sizes = files.agg(F.count("*").alias("n"), F.coalesce(F.max("length"), F.lit(0)).alias("most"), F.coalesce(F.sum("length"), F.lit(0)).alias("all")).first()
    if sizes["n"] > max_pages or sizes["most"] > max_file or sizes["all"] > max_total:
        raise InputError(f"{sizes['n']} pages, {sizes['all']} bytes, {sizes['most']} in one")
    text = F.regexp_replace(F.decode("content", "UTF-8"), "\\A\ufeff", "")
    return files.select(F.xxhash64("path").alias("page_id"), "path", text.alias("html"))


@dataclass(frozen=True)
class Layout:
    """Headers of a price file, and the context that every row must be of.

    ``fields``: name of ours to header; unit_number, property_type, valid_from and valid_until are
    needed. ``base_price`` and ``per_area`` are beginnings of headers: exactly one, and at most one,
    must be there. ``context``: header to the value that all rows must have, case aside.
    """

    fields: dict[str, str]
    base_price: str
    per_area: str = ""
    context: dict[str, str] = field(default_factory=dict)
    wanted: str = ""
    passed_over: tuple[str, ...] = ()
    unit: str = r"\A[A-Z0-9/-]+\z"
    zone: str = "Europe/Warsaw"


def price_file(spark: SparkSession, path: str, layout: Layout, day: Column) -> DataFrame:
    """Rows of a price file for a civil day: unit_number, price_pln, price_per_m2_pln, valid_from, valid_until, reason.

    Rows of the property types passed over are left out; any other type than the wanted one, or a
    row that breaks a rule, has a reason, and ``contracts.demanded`` refuses the file as a whole.
    """
    names = tables.header(spark, path)
    if lost := (set(layout.fields.values()) | set(layout.context)) - set(names):
        raise InputError(f"missing columns: {sorted(lost)}")
    price = tables.the_one(names, layout.base_price)
    per_area = [n for n in names if layout.per_area and n.startswith(layout.per_area)]
    if len(per_area) > 1:
        raise InputError("several columns of a price for an area")
    raw = tables.read_csv(spark, path)
    at = {ours: F.trim(c(f"`{header}`")) for ours, header in layout.fields.items()}
    start, end = v.day_bounds(day, layout.zone)
    begins, ends = v.aware_utc(at["valid_from"]), v.aware_utc(at["valid_until"])
    elsewhere = F.lit(False)
    for header, value in layout.context.items():
        elsewhere = elsewhere | ~F.coalesce(F.lower(F.trim(c(f"`{header}`"))) == value.lower(), F.lit(False))
    diagnostic = F.trim(c(f"`{per_area[0]}`")) if per_area else F.lit(None).cast("string")
    known = diagnostic.isNotNull() & ~diagnostic.isin("", "X")
    rules = [
        ("other_context", elsewhere),
        ("other_property_type", ~F.coalesce(at["property_type"] == layout.wanted, F.lit(False))),
        ("invalid_unit", ~at["unit_number"].rlike(layout.unit)),
        ("invalid_price", v.decimal_text(c(f"`{price}`")).isNull()),
        ("invalid_price_per_area", known & v.decimal_text(diagnostic).isNull()),
        ("invalid_time", ~(v.local_offset_fits(at["valid_from"], layout.zone) & v.local_offset_fits(at["valid_until"], layout.zone))),
        ("reversed_interval", ends < begins),
        ("not_of_the_day", ~((begins < end) & (ends >= start))),
    ]
    kept = raw.where(~F.coalesce(at["property_type"].isin(*layout.passed_over), F.lit(False)))
    made = kept.withColumns({"_unit": at["unit_number"]})
    told = contracts.with_reason(made, rules, ["_unit"])
    return told.select(c("_unit").alias("unit_number"), v.decimal_text(c(f"`{price}`")).cast("double").alias("price_pln"), F.when(known, v.decimal_text(diagnostic)).cast("double").alias("price_per_m2_pln"), begins.alias("valid_from"), ends.alias("valid_until"), "reason")


def seeded(spark: SparkSession, identities: int | DataFrame = 180, days: int = 30, again: int = 20, seed: int = 42, start: str = "2026-01-01", hosts: tuple[str, ...] = ("www.a.example", "www.b.example")) -> DataFrame:
    """Made observations of listings, the same for a seed: a few new ones a day, and some of them seen once more a day later for three quarters of the price.

    ``identities``: how many, or a frame of them with a number ``id`` from 0 on.
    """
    k = c("id")
    ids, total = (spark.range(identities), identities) if isinstance(identities, int) else (identities.select("id"), identities.count())
    r = lambda name: F.pmod(F.xxhash64(k, F.lit(seed), F.lit(name)), F.lit(10_000)) / 10_000
    host = F.element_at(F.array(*map(F.lit, hosts)), (k % len(hosts) + 1).cast("int"))
    area = F.round(25 + 95 * r("area"), 1)
    price = F.round(area * (9_000 + 9_000 * r("price")) / 100) * 100
    first = ids.select(
        host.alias("source"), (k + 1).cast("string").alias("listing_id"), F.concat(F.lit("https://"), host, F.lit("/o/"), k + 1).alias("url"), F.lit("Warszawa").alias("city"), F.concat(F.lit("District "), F.floor(5 * r("district"))).alias("district"),
        price.alias("price_pln"), area.alias("area_m2"), F.greatest(F.lit(1), F.floor(area / 22).cast("int")).alias("rooms"), F.floor(10 * r("floor")).cast("int").alias("floor"), (1960 + F.floor(60 * r("year"))).cast("int").alias("build_year"),
        (52.1 + 0.25 * r("lat")).alias("latitude"), (20.85 + 0.4 * r("lon")).alias("longitude"), F.lit(None).cast("double").alias("distance_km"),
        (F.lit(start).cast("timestamp") + F.make_dt_interval((k * days / total).cast("int"))).alias("observed_at"), k.alias("_k"),
    )
    later = first.where(c("_k") < again).withColumns({"price_pln": F.round(c("price_pln") * 0.75, 2), "observed_at": F.lit(start).cast("timestamp") + F.make_dt_interval(F.lit(days))})
    return first.unionByName(later).drop("_k")


def save_pilot(spark: SparkSession, folder: str, found: DataFrame, report: dict, *, statuses_only: bool = False) -> str:
    """What a pilot leaves: the reconciled units (or their statuses alone) and its report, put in force together."""
    frame = found.select("number", "status") if statuses_only else found
    return tables.save_bundle(spark, folder, {"statuses" if statuses_only else "units": frame}, report)


def lines(ranked: DataFrame) -> DataFrame:
    """Ranked candidates as lines for a terminal: position, line; escape sequences and control characters don't get through."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.orderBy(F.desc("gap"), "source", "listing_id"))  # at most 50 rows, see ranked
    money = lambda x: F.regexp_replace(F.format_number(c(x), 0), ",", " ")
    line = F.concat_ws(" | ", v.shown(c("district")), F.concat(money("price_pln"), F.lit(" PLN")), F.concat(F.lit("model "), money("predicted_price_pln")), F.concat(F.lit("gap "), F.format_number(100 * c("gap"), 1), F.lit(" %")), v.shown(c("url")))
    return ranked.select(place.alias("position"), line.alias("line"))
