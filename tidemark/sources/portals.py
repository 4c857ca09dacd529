"""Listing rows from the state that portals embed in their pages, as expressions over JSON variants.

``state.states`` has found a page's state; here it is taken apart on the JVM. A page whose state
doesn't confirm what was asked for gives one row with a page reason; every item of a page that
does gives a row, with the first reason that it is refused for, so nothing is lost silently.
``sparse`` keeps items without price, area or rooms, which the catalogue can do without.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import values as v
from tidemark.operators.rows import first_reason

c = F.col
#: Codes that stand for numbers of rooms and for floors (fixed values).
ROOM_WORDS = {"one": 1, "two": 2, "three": 3}
ROOM_NAMES = {"ONE": 1, "TWO": 2, "THREE": 3, "FOUR": 4}
MORE_ROOM_NAMES = ROOM_NAMES | {"FIVE": 5}
FLOOR_NAMES = {"GROUND": 0, "FIRST": 1, "SECOND": 2, "THIRD": 3, "FOURTH": 4, "FIFTH": 5, "SIXTH": 6, "SEVENTH": 7, "EIGHTH": 8, "NINTH": 9, "TENTH": 10}
STATUSES = ("available", "reserved", "sold", "unavailable")
FIELDS = ("source", "listing_id", "url", "city", "district", "price_pln", "area_m2", "rooms", "rooms_min", "floor", "latitude", "longitude", "distance_km")


@dataclass(frozen=True)
class Portal:
    """What a portal's pages must confirm, and how its listings are addressed."""

    host: str
    city: str = "Warszawa"
    category: int = 14
    category_path: str = ""
    location: str = ""
    path: str = "/d/oferta/[^/]+\\.html"
    rooms: dict[str, int] = field(default_factory=lambda: dict(ROOM_WORDS))


def at(value: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, "$." + path, kind)


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def text_of(found: Column) -> Column:
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))


def whole_of(found: Column) -> Column:
    return F.when(F.schema_of_variant(found) == "BIGINT", F.try_variant_get(found, "$", "long"))


def text(value: Column, path: str) -> Column:
    return text_of(at(value, path))


def whole(value: Column, path: str) -> Column:
    return whole_of(at(value, path))


def _looked(rows: DataFrame, value: str, prefix: str, /, **paths: str) -> tuple[DataFrame, dict[str, Column]]:
    """What stands at paths of a variant column, as columns of a projection of their own: each path is walked once a row."""
    return rows.withColumns({f"_{prefix}_{n}": at(c(value), path) for n, path in paths.items()}), {n: c(f"_{prefix}_{n}") for n in paths}


def number(value: Column, path: str) -> Column:
    return v.json_number(at(value, path))


def lacks(test: Column) -> Column:
    """A requirement that doesn't hold, or can't be looked at."""
    return ~F.coalesce(test, F.lit(False))


def _items(pages: DataFrame, found: Column, page_reason: Column) -> DataFrame:
    """A row for each item of a page that holds, with ``position`` and ``item``; one with ``page_reason`` for others."""
    given = pages.withColumns({"page_reason": page_reason})
    given = given.withColumn("_items", F.when(c("page_reason").isNull(), found))
    return given.select("page_id", "page_url", "page_reason", F.posexplode_outer("_items").alias("position", "item"))


def _made(rows: DataFrame, made: dict[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
    """Fields as columns of a projection of their own, so that rules and results read them instead of working them out again."""
    return rows.withColumns({f"_made_{n}": x for n, x in made.items()}), {n: c(f"_made_{n}") for n in made}


def _told(rows: DataFrame, made: dict[str, Column], rules: list[tuple[str, Column]]) -> DataFrame:
    """Items as listing rows with their reason, and a page's contradictions among the rows that are left."""
    reason = F.when(c("page_reason").isNotNull(), c("page_reason")).when(c("item").isNull(), F.lit("no_items")).otherwise(first_reason(rules))
    out = rows.select("page_id", "position", *[made.get(n, F.lit(None)).cast(k).alias(n) for n, k in zip(FIELDS, ("string",) * 5 + ("double",) * 2 + ("int",) * 3 + ("double",) * 3, strict=True)], reason.alias("reason"))
    same = lambda key: Window.partitionBy("page_id", F.col("reason").isNull(), key)
    # one sort for all that is asked of a listing's rows on a page; only rows that come again are written out to be compared
    line = same("listing_id").orderBy("position")
    whole_line = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = out.withColumns({"_n": F.count("*").over(whole_line), "_place": F.row_number().over(line)})
    out = out.withColumns({"_one": F.when(c("reason").isNull() & (c("_n") > 1), F.to_json(F.struct(*FIELDS))), "_id": F.when(c("reason").isNull(), c("listing_id"))})
    out = out.withColumn("_unlike", F.coalesce(F.min("_one").over(whole_line) != F.max("_one").over(whole_line), F.lit(False)))
    clash = c("_unlike") | (F.min("_id").over(same("url")) != F.max("_id").over(same("url")))
    late = F.when(c("reason").isNull() & clash, "contradictory_page").when(c("reason").isNull() & (c("_place") > 1), "duplicate_on_page")
    return out.withColumn("reason", F.coalesce("reason", late)).drop("_one", "_id", "_n", "_place", "_unlike")


def search_rows(states: DataFrame, portal: Portal, *, page_number: Column, sparse: bool = False) -> DataFrame:
    """Rows of a portal that assigns its state: page_id, position, the listing's fields, reason.

    ``states``: page_id, page_url, state (JSON text; null: no state). The state must be of the
    asked page, category and place. Items must be active sales of the city with an id, a listing's
    URL, a total price in PLN, an area and an exact number of rooms; ``sparse`` does without the
    last three, and reads four or more rooms as a minimum.
    """
    # step by step: a page is parsed once, and what rules and fields look at is made once a row
    states, p = _looked(states.withColumn("_state", F.try_parse_json("state")), "_state", "p", listing="listing.listing", path=f"categories.list['{portal.category}'].path")
    states, q = _looked(states, "_p_listing", "q", category="categoryId", path="requestParams.categoryPath", page="pageNumber", asked="requestParams.page")
    confirmed = (
        (whole_of(q["category"]) == portal.category)
        & (text_of(p["path"]) == portal.category_path)
        & (F.rtrim(text_of(q["path"]), F.lit("/")) == portal.category_path.strip("/"))
        & (whole_of(q["page"]) == page_number - 1)
        & (q["asked"].isNull() | (whole_of(q["asked"]) == page_number - 1))
    )
    states = states.withColumns({"_ads": at(c("_p_listing"), "ads", "array<variant>"), "_confirmed": confirmed})
    page_reason = F.when(c("state").isNull(), "no_state").when(c("_ads").isNull(), "unknown_structure").when(lacks(c("_confirmed")), "unconfirmed_page")
    rows = _items(states, c("_ads"), page_reason)
    rows, f = _looked(
        rows, "item", "f", id="id", url="url", price="price", params="params", district="location.districtName", city="location.cityName", plain_city="location.cityNormalizedName",
        category="category.id", active="isActive", status="status", shown="map.show_detailed",
    )
    rows, g = _looked(rows, "_f_price", "g", budget="budget", free="free", exchange="exchange", currency="regularPrice.currencyCode", value="regularPrice.value")
    rows = rows.withColumns({"_listed": F.try_variant_get(f["params"], "$", "array<variant>"), "_id": whole_of(f["id"]), "_link": text_of(f["url"]), "_object": is_object(f["price"])})
    rows = rows.withColumns({"_pairs": F.transform("_listed", lambda p: F.struct(text(p, "key").alias("key"), at(p, "normalizedValue").alias("value"))), "_full": v.resolved_url(c("_link"), c("page_url"))})
    rows = rows.withColumns({"_params": F.filter("_pairs", lambda p: p["key"].isNotNull()), "_canonical": v.canonical_url(c("_full"))})
    params = c("_params")
    param = lambda name: F.try_element_at(F.filter(params, lambda p: p["key"] == name), F.lit(1))["value"]
    yes = lambda x: F.try_variant_get(x, "$", "boolean")
    rows = rows.withColumns({"_names": F.transform("_params", lambda p: p["key"]), "_m": param("m"), "_room": param("rooms"), "_storey": param("floor_select")})
    names, url = c("_names"), c("_canonical")
    ordinary = ~F.coalesce(yes(g["budget"]) | yes(g["free"]) | yes(g["exchange"]), F.lit(False)) & c("_object")
    pln = ordinary & (text_of(g["currency"]) == "PLN")
    price = F.when(pln, v.json_number_or_text(g["value"]))
    shown = F.coalesce(yes(f["shown"]), F.lit(False))
    place = lambda name: F.when(shown, v.json_number_or_text(at(c("item"), f"map.{name}")))
    rows = rows.withColumns({"_price": price, "_area": v.json_number_or_text(c("_m")), "_code": text_of(c("_room")), "_level": text_of(c("_storey")), "_lat": place("lat"), "_lon": place("lon"), "_district": F.trim(text_of(f["district"]))})
    price, area = F.when(c("_price") > 0, c("_price")), F.when(c("_area") > 0, c("_area"))
    room_code, floor_code = c("_code"), c("_level")
    here = c("_lat").between(-90, 90) & c("_lon").between(-180, 180)
    made = {
        "source": F.lit(portal.host), "listing_id": c("_id").cast("string"), "url": url, "city": F.lit(portal.city),
        "district": F.when(c("_district") != "", c("_district")),
        "price_pln": price, "area_m2": area, "rooms": v.decoded(room_code, portal.rooms), "rooms_min": F.when(F.lit(sparse) & (room_code == "four"), 4),
        "floor": F.when(floor_code.rlike(r"\Afloor_(-1|[0-9]|10)\z"), F.substring(floor_code, 7, 3)),
        "latitude": F.when(here, c("_lat")), "longitude": F.when(here, c("_lon")), "distance_km": v.distance_km(c("_lat"), c("_lon")),
    }
    rows, made = _made(rows, made)
    url = made["url"]
    rules = [
        ("not_an_item", lacks(is_object(c("item")))),
        ("other_category", lacks(whole_of(f["category"]) == portal.category)),
        ("other_city", lacks(text_of(f["city"]) == portal.city)),
        ("contradictory_city", lacks(F.coalesce(text_of(f["plain_city"]), F.lit(portal.city.lower())) == portal.city.lower())),
        ("inactive", lacks(F.coalesce(yes(f["active"]), F.lit(True)) & (F.coalesce(text_of(f["status"]), F.lit("active")) == "active"))),
        ("invalid_identity", lacks(c("_id") > 0)),
        ("invalid_url", lacks(url.rlike(r"\Ahttps://" + portal.host.replace(".", r"\.") + portal.path + r"\z"))),
        ("no_total_price", lacks(made["price_pln"].isNotNull()) & F.lit(not sparse)),
        ("invalid_parameters", (~F.coalesce(F.is_variant_null(f["params"]), F.lit(True)) | F.lit(not sparse)) & lacks(F.size(params) == F.size("_listed"))),
        ("repeated_parameter", F.size(names) != F.size(F.array_distinct(names))),
        ("no_area", made["area_m2"].isNull() & F.lit(not sparse)),
        ("no_exact_rooms", made["rooms"].isNull() & F.lit(not sparse)),
    ]
    return _told(rows, made, rules)


def scripted_rows(states: DataFrame, portal: Portal, *, page_number: Column, sparse: bool = False, most_members: int = 500) -> DataFrame:
    """Rows of a portal that keeps its state in one JSON script; as ``search_rows``.

    Groups (investments) are opened by one level: their members are judged like any item, and the
    group itself is never a row. The place must confirm city and at most one district below it.
    """
    # step by step, as in ``search_rows``
    states = states.withColumn("_state", F.try_parse_json("state")).withColumn("_page", at(c("_state"), "props.pageProps"))
    states, p = _looked(states, "_page", "p", search="data.searchAds", estate="estate", transaction="transaction", location="location", asked="filteringQueryParams.page", address="canonicalURL")
    states = states.withColumns({"_current": whole(p["search"], "pagination.currentPage"), "_all": at(p["search"], "items", "array<variant>")})
    confirmed = (text_of(p["estate"]) == "FLAT") & (text_of(p["transaction"]) == "SELL") & (text_of(p["location"]) == portal.location)
    confirmed = confirmed & (whole_of(p["asked"]) == page_number) & (c("_current") == page_number) & text_of(p["address"]).isNotNull()
    group = lambda x: F.coalesce((text(x, "estate") == "INVESTMENT") & (text(x, "transaction") == "SELL"), F.lit(False)) & at(x, "relatedAds").isNotNull()
    good_group = lambda x: F.coalesce((whole(x, "id") > 0) & (text(x, "href") == F.concat(F.lit("[lang]/investment/"), text(x, "slug"))), F.lit(False)) & at(x, "relatedAds", "array<variant>").isNotNull()
    told = F.transform("_all", lambda x: F.struct(x.alias("item"), (group(x) & good_group(x)).alias("opens")))
    states = states.withColumns({"_told": told, "_confirmed": confirmed})
    items = lambda opens: F.transform(F.filter("_told", lambda x: x["opens"] == opens), lambda x: x["item"])
    states = states.withColumn("_members", F.flatten(F.transform(items(True), lambda x: at(x, "relatedAds", "array<variant>"))))
    page_reason = F.when(c("state").isNull(), "no_state").when(c("_all").isNull(), "unknown_structure").when(lacks(c("_confirmed")), "unconfirmed_page").when(F.size("_members") > most_members, "too_many_members")
    rows = _items(states, F.concat(items(False), c("_members")), page_reason)
    rows, f = _looked(
        rows, "item", "f", id="id", slug="slug", hidden="hidePrice", currency="totalPrice.currency", price="totalPrice.value", area="areaInSquareMeters", rooms="roomsNumber", floor="floorNumber",
        estate="estate", transaction="transaction", href="href", related="relatedAds",
    )
    spot = lambda x: F.struct(text(x, "locationLevel").alias("level"), text(x, "id").alias("id"), text(x, "name").alias("name"))
    rows = rows.withColumns({"_places": F.transform(at(c("item"), "location.reverseGeocoding.locations", "array<variant>"), spot), "_id": whole_of(f["id"]), "_slug": text_of(f["slug"]), "_estate": text_of(f["estate"]), "_deal": text_of(f["transaction"])})
    level = lambda name: F.filter("_places", lambda x: x["level"] == name)
    rows = rows.withColumns({"_cities": level("city_or_village"), "_districts": level("district"), "_number": v.json_number(f["price"]), "_area": v.json_number(f["area"])})
    rows = rows.withColumn("_named", F.array_distinct(F.transform("_districts", lambda x: F.concat_ws("\n", x["id"], F.trim(x["name"])))))
    cities, districts, named = c("_cities"), c("_districts"), c("_named")
    inside = F.lit(portal.location + "/")
    fits = lambda x: F.coalesce(x["id"].startswith(inside) & ~F.substring(x["id"], len(portal.location) + 2, 1000).rlike("/|^$") & (F.trim(x["name"]) != ""), F.lit(False))
    located = (F.size(cities) > 0) & F.forall(cities, lambda x: F.coalesce((x["id"] == portal.location) & (x["name"] == portal.city), F.lit(False))) & F.forall(districts, fits) & (F.size(named) <= 1)
    slug, hidden = c("_slug"), f["hidden"]
    price = F.when((hidden.isNull() | ~F.coalesce(F.try_variant_get(hidden, "$", "boolean"), F.lit(True))) & (text_of(f["currency"]) == "PLN"), c("_number"))
    price, area = F.when(price > 0, price), F.when(c("_area") > 0, c("_area"))
    made = {
        "source": F.lit(portal.host), "listing_id": c("_id").cast("string"), "url": F.concat(F.lit(f"https://{portal.host}/pl/oferta/"), slug), "city": F.lit(portal.city),
        "district": F.element_at(F.split(F.try_element_at(named, F.lit(1)), "\n"), -1), "price_pln": price, "area_m2": area,
        "rooms": v.decoded(text_of(f["rooms"]), MORE_ROOM_NAMES if sparse else ROOM_NAMES), "floor": v.decoded(text_of(f["floor"]), FLOOR_NAMES),
    }
    rows, made = _made(rows, made)
    price, area = made["price_pln"], made["area_m2"]
    rules = [
        ("invalid_group", F.coalesce((c("_estate") == "INVESTMENT") & (c("_deal") == "SELL"), F.lit(False)) & f["related"].isNotNull()),
        ("not_an_individual_sale", lacks((c("_estate") == "FLAT") & (c("_deal") == "SELL"))),
        ("invalid_identity", lacks(c("_id") > 0)),
        ("invalid_url", lacks(slug.rlike(r"\A[A-Za-z0-9][A-Za-z0-9-]*-ID[A-Za-z0-9]+\z"))),
        ("advertising_presentation", lacks(text_of(f["href"]) == F.concat(F.lit("[lang]/ad/"), slug))),
        ("unconfirmed_place", lacks(located)),
        ("no_total_price", price.isNull() & F.lit(not sparse)),
        ("no_area", area.isNull() & F.lit(not sparse)),
        ("no_exact_rooms", made["rooms"].isNull() & F.lit(not sparse)),
    ]
    return _told(rows, made, rules)


#: Fields of a unit of a developer's own list (fixed values).
UNIT = "number string, slugNumber string, id string, city string, investment string, building string, status string, isCommercialUnit boolean, area double, rooms int, floor int, price double"


def unit_rows(lists: DataFrame, *, city: str, investment: str, url_base: str) -> DataFrame:
    """Units of a developer's list with the reason that each is refused for.

    ``lists``: page_id, units (JSON array, as ``state.agreeing`` gives). Commercial units may lack
    rooms; sold and reserved units stay, for the reconciliation to decide. A unit that comes twice
    must come as it was.
    """
    rows = lists.select("page_id", F.posexplode_outer(F.try_variant_get(F.try_parse_json("units"), "$", "array<variant>")).alias("position", "u"))
    u = c("u")
    names = ("number", "slugNumber", "id", "city", "investment", "building", "status")
    clean = {n: F.trim(text(u, n)) for n in names}
    commercial, rooms = at(u, "isCommercialUnit", "boolean"), whole(u, "rooms")
    blank = F.lit(False)
    for n in names:
        blank = blank | lacks((clean[n] != "") & ~clean[n].contains("\ufffd"))
    rules = [
        ("not_a_unit", lacks(is_object(u))),
        ("missing_text", blank),
        ("invalid_number", lacks(clean["number"].rlike(r"\A[A-Za-z0-9]+(/[A-Za-z0-9]+)*\z"))),
        ("slug_differs", lacks(clean["slugNumber"] == F.replace(clean["number"], F.lit("/"), F.lit("-")))),
        ("other_place", lacks((clean["city"] == city) & (clean["investment"] == investment))),
        ("unknown_status", lacks(clean["status"].isin(*STATUSES))),
        ("invalid_commercial_mark", lacks(F.schema_of_variant(at(u, "isCommercialUnit")) == "BOOLEAN")),
        ("invalid_rooms", lacks(rooms > 0) & ~(F.coalesce(commercial, F.lit(False)) & F.coalesce(F.is_variant_null(at(u, "rooms")), F.lit(True)))),
        ("invalid_floor", lacks(whole(u, "floor") >= 0)),
        ("not_positive", lacks((number(u, "area") > 0) & (number(u, "price") > 0))),
    ]
    out = rows.select(
        "page_id", clean["number"].alias("number"), clean["slugNumber"].alias("slug_number"), clean["id"].alias("source_id"), clean["city"].alias("city"), clean["investment"].alias("investment"),
        clean["building"].alias("building"), clean["status"].alias("status"), commercial.alias("is_commercial_unit"), number(u, "area").alias("area_m2"), rooms.cast("int").alias("rooms"),
        whole(u, "floor").cast("int").alias("floor"), number(u, "price").alias("website_price_pln"), F.concat(F.lit(url_base), clean["slugNumber"], F.lit("/")).alias("feature_url"),
        first_reason(rules).alias("reason"),
    ).distinct()
    clash = F.lit(False)
    for key in ("number", "slug_number", "source_id"):
        clash = clash | (F.count("*").over(Window.partitionBy("page_id", "investment", key)) > 1)
    return out.withColumn("reason", F.coalesce("reason", F.when(clash, "contradictory_unit")))


def reconciled(prices: DataFrame, units: DataFrame, observed_at: Column, tolerance: str = "0.01") -> DataFrame:
    """Every unit of either side with its verdict: ``matched``, ``not_offered``, or what forbids the whole join.

    ``prices``: unit_number, price_pln, valid_from, valid_until; ``units``: as ``unit_rows``. One
    full join by number: a price without unit, an available unit without price, a number that
    comes twice, a price not valid at the time, and prices further apart than the tolerance each
    have a verdict of their own; any of these makes the join fail as a whole, see ``join_errors``.
    """
    p = prices.groupBy(c("unit_number").alias("number")).agg(F.count("*").alias("_np"), *[F.min(n).alias(n) for n in ("price_pln", "valid_from", "valid_until")])
    u = units.where("reason IS NULL").groupBy("number").agg(F.count("*").alias("_nu"), *[F.min(n).alias(n) for n in ("status", "is_commercial_unit", "area_m2", "rooms", "floor", "website_price_pln", "feature_url")])
    money = lambda x: c(x).cast("decimal(18,2)")
    offered = (c("status") == "available") & ~c("is_commercial_unit")
    verdict = (
        F.when((c("_np") > 1) | (c("_nu") > 1), "repeated_unit")
        .when(c("_nu").isNull(), "price_without_unit")
        .when(c("_np").isNull() & offered, "unit_without_price")
        .when(c("_np").isNotNull() & c("is_commercial_unit"), "price_of_commercial_unit")
        .when(~offered, "not_offered")
        .when(~F.coalesce(observed_at.between(c("valid_from"), c("valid_until")), F.lit(False)), "price_not_valid")
        .when(~F.coalesce(F.abs(money("price_pln") - money("website_price_pln")) <= F.lit(tolerance).cast("decimal(18,2)"), F.lit(False)), "prices_disagree")
        .otherwise("matched")
    )
    return p.join(u, "number", "full_outer").withColumn("verdict", verdict).drop("_np", "_nu")


def join_errors(found: DataFrame) -> DataFrame:
    """Verdicts that forbid the join, with their numbers; empty where it holds."""
    return found.where(~c("verdict").isin("matched", "not_offered")).groupBy("verdict").agg(F.count("*").alias("n"))
