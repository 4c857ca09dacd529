"""Queries on reading pages, portals, robots files and records: inputs are made of the driver's tables, so SQL can say what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scope
from tidemark.functions import values as v
from tidemark.operators import contracts
from tidemark.plans.catalogue import c, query, t
from tidemark.sources import pages, portals, robots

PATHS = {"www.a.example": r"/d/offer/[^/]+\.html"}
PORTAL = portals.Portal("www.a.example", category_path="homes/flats", path=PATHS["www.a.example"])
SCRIPTED = portals.Portal("www.b.example", location="land/town")


@query("""SELECT o_custkey AS page_id, CAST(o_orderkey + 1 AS VARCHAR) AS listing_id, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS price_pln, CASE WHEN o_orderkey % 90 > 0 THEN CAST(o_orderkey % 90 AS DOUBLE) END AS area_m2,
 CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS rooms,
 CASE WHEN o_orderkey % 11 = 0 THEN 'other_city' WHEN o_orderstatus = 'P' THEN 'inactive' WHEN o_orderkey % 7 = 0 THEN 'no_total_price' WHEN o_orderkey % 90 = 0 THEN 'no_area' WHEN substr(o_orderpriority, 1, 1) > '3' THEN 'no_exact_rooms' END AS reason FROM orders""")
def portal_search_rows(s, d):
    return portals.search_rows(_search_states(s, d), PORTAL, page_number=F.lit(1)).select("page_id", "listing_id", "price_pln", "area_m2", "rooms", "reason")


def _search_states(s, d):
    """A page of search results for each customer, its orders as ads."""
    k = c("o_orderkey")
    code = F.when(c("o_orderpriority") == "1-URGENT", "one").when(c("o_orderpriority") == "2-HIGH", "two").when(c("o_orderpriority") == "3-MEDIUM", "three").otherwise("four")
    value = lambda name, x: F.struct(F.lit(name).alias("key"), x.cast("string").alias("normalizedValue"))
    ad = F.struct(
        (k + 1).alias("id"), F.struct(F.lit(14).alias("id")).alias("category"), F.struct(F.when(k % 11 == 0, "Elsewhere").otherwise("Warszawa").alias("cityName")).alias("location"),
        F.when(c("o_orderstatus") == "P", "old").otherwise("active").alias("status"), F.concat(F.lit("/d/offer/x-"), k, F.lit(".html?utm_source=q")).alias("url"),
        F.struct((k % 7 == 0).alias("free"), F.struct(c("o_totalprice").alias("value"), F.lit("PLN").alias("currencyCode")).alias("regularPrice")).alias("price"),
        F.array(value("m", k % 90), value("rooms", code)).alias("params"),
    )
    ads = t(s, d, "orders").groupBy(c("o_custkey").alias("page_id")).agg(F.collect_list(ad).alias("ads"))  # a page's items
    listing = F.struct(F.lit(14).alias("categoryId"), F.lit(0).alias("pageNumber"), F.struct(F.lit("homes/flats/").alias("categoryPath")).alias("requestParams"), "ads")
    category = F.create_map(F.lit("14"), F.struct(F.lit("homes/flats").alias("path")))
    whole = F.struct(F.struct(listing.alias("listing")).alias("listing"), F.struct(category.alias("list")).alias("categories"))
    return ads.select("page_id", F.lit("https://www.a.example/s").alias("page_url"), F.to_json(whole).alias("state"))


@query("""WITH r AS (SELECT o_custkey AS page_id, CASE WHEN o_orderkey % 11 = 0 THEN 'other_city' WHEN o_orderstatus = 'P' THEN 'inactive' WHEN o_orderkey % 7 = 0 THEN 'no_total_price' WHEN o_orderkey % 90 = 0 THEN 'no_area' WHEN substr(o_orderpriority, 1, 1) > '3' THEN 'no_exact_rooms' ELSE 'accepted' END AS reason FROM orders)
SELECT page_id, reason, count(*) AS n FROM r GROUP BY 1, 2""")
def page_rejections(s, d):
    return contracts.reason_counts(portals.search_rows(_search_states(s, d), PORTAL, page_number=F.lit(1)), ["page_id"])


@query("""SELECT o_custkey AS page_id, CAST(o_orderkey + 1 AS VARCHAR) AS listing_id, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS price_pln, CASE WHEN substr(o_orderpriority, 1, 1) <= '4' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) ELSE 5 END AS rooms, 'D' || (o_orderkey % 3) AS district,
 CASE WHEN o_orderkey % 13 = 0 THEN 'not_an_individual_sale' WHEN o_orderstatus = 'P' THEN 'advertising_presentation' END AS reason FROM orders""")
def portal_scripted_rows(s, d):
    k = c("o_orderkey")
    name = F.when(c("o_orderpriority") == "1-URGENT", "ONE").when(c("o_orderpriority") == "2-HIGH", "TWO").when(c("o_orderpriority") == "3-MEDIUM", "THREE").when(c("o_orderpriority").startswith("4"), "FOUR").otherwise("FIVE")
    slug, district = F.concat(F.lit("x-ID"), k), F.concat(F.lit("D"), k % 3)
    place = lambda level, ident, title: F.struct(F.lit(level).alias("locationLevel"), ident.alias("id"), title.alias("name"))
    places = F.array(place("city_or_village", F.lit("land/town"), F.lit("Warszawa")), place("district", F.concat(F.lit("land/town/"), district), district))
    item = F.struct(
        (k + 1).alias("id"), F.when(k % 13 == 0, "HOUSE").otherwise("FLAT").alias("estate"), F.lit("SELL").alias("transaction"), slug.alias("slug"),
        F.concat(F.when(c("o_orderstatus") == "P", "hpr/").otherwise("[lang]/ad/"), slug).alias("href"), (k % 7 == 0).alias("hidePrice"), F.struct(c("o_totalprice").alias("value"), F.lit("PLN").alias("currency")).alias("totalPrice"),
        F.lit(40).alias("areaInSquareMeters"), name.alias("roomsNumber"), F.struct(F.struct(places.alias("locations")).alias("reverseGeocoding")).alias("location"),
    )
    group = F.struct(F.lit("INVESTMENT").alias("estate"), F.lit("SELL").alias("transaction"), F.lit(1).alias("id"), F.lit("g-ID1").alias("slug"), F.lit("[lang]/investment/g-ID1").alias("href"), F.collect_list(item).alias("relatedAds"))
    grouped = t(s, d, "orders").groupBy(c("o_custkey").alias("page_id")).agg(F.array(group).alias("items"))  # a page's items
    search = F.struct("items", F.struct(F.lit(1).alias("currentPage")).alias("pagination"))
    page = F.struct(F.lit("FLAT").alias("estate"), F.lit("SELL").alias("transaction"), F.lit("land/town").alias("location"), F.lit("/x").alias("canonicalURL"), F.struct(F.lit(1).alias("page")).alias("filteringQueryParams"), F.struct(search.alias("searchAds")).alias("data"))
    states = grouped.select("page_id", F.lit("https://www.b.example/s").alias("page_url"), F.to_json(F.struct(F.struct(page.alias("pageProps")).alias("props"))).alias("state"))
    return portals.scripted_rows(states, SCRIPTED, page_number=F.lit(1), sparse=True).select("page_id", "listing_id", "price_pln", "rooms", "district", "reason")


@query("""WITH u AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'sold' ELSE 'available' END AS status, c_custkey % 17 = 0 AS commercial, abs(round(c_acctbal)) + 1 AS price FROM customer),
p AS (SELECT c_custkey AS k, abs(round(c_acctbal)) + 1 + CASE WHEN c_custkey % 19 = 0 THEN 0.02 ELSE 0.01 END AS price, c_custkey % 23 = 0 AS late FROM customer WHERE c_custkey % 7 > 0 UNION ALL SELECT c_custkey + 1000000, 5, false FROM customer WHERE c_custkey % 29 = 0)
SELECT CASE WHEN u.k IS NULL THEN 'price_without_unit' WHEN p.k IS NULL AND status = 'available' AND NOT commercial THEN 'unit_without_price' WHEN p.k IS NOT NULL AND commercial THEN 'price_of_commercial_unit' WHEN status <> 'available' OR commercial THEN 'not_offered'
 WHEN late THEN 'price_not_valid' WHEN p.k % 19 = 0 THEN 'prices_disagree' ELSE 'matched' END AS verdict, count(*) AS n FROM p FULL JOIN u ON p.k = u.k GROUP BY 1""")
def unit_reconciliation(s, d):
    k, base = c("c_custkey"), F.abs(F.round("c_acctbal")) + 1
    unit = F.struct(
        F.concat(F.lit("A"), k).alias("number"), F.concat(F.lit("A"), k).alias("slugNumber"), k.cast("string").alias("id"), F.lit("T").alias("city"), F.lit("I").alias("investment"), F.lit("A").alias("building"),
        F.when(k % 5 == 0, "sold").otherwise("available").alias("status"), (k % 17 == 0).alias("isCommercialUnit"), F.lit(40.5).alias("area"), F.lit(2).alias("rooms"), F.lit(0).alias("floor"), base.alias("price"),
    )
    lists = t(s, d, "customer").groupBy(F.floor(k / 50).alias("page_id")).agg(F.to_json(F.collect_list(unit)).alias("units"))  # at most 50 units a page
    units = portals.unit_rows(lists, city="T", investment="I", url_base="https://u.example/")
    row = lambda ident, price, until: (F.concat(F.lit("A"), ident).alias("unit_number"), price.alias("price_pln"), F.lit(1).alias("valid_from"), until.alias("valid_until"))
    prices = t(s, d, "customer").where("c_custkey % 7 > 0").select(*row(k, base + F.when(k % 19 == 0, 0.02).otherwise(0.01), F.when(k % 23 == 0, 3).otherwise(9)))
    prices = prices.union(t(s, d, "customer").where("c_custkey % 29 = 0").select(*row(k + 1_000_000, F.lit(5.0), F.lit(9))))
    return portals.reconciled(prices, units, F.lit(5)).groupBy("verdict").agg(F.count("*").alias("n"))


@query("""SELECT s_suppkey AS page_id, 'S' || s_suppkey AS listing_id, CAST(s_suppkey * 1000 AS DOUBLE) + 0.5 AS price_pln, CAST(s_suppkey % 50 AS DOUBLE) AS area_m2, CAST(s_suppkey % 4 + 1 AS INTEGER) AS rooms, 'https://www.a.example/o/' || s_suppkey AS url,
 CASE WHEN s_suppkey % 9 = 0 THEN 'rental' WHEN s_nationkey % 5 = 0 THEN 'other_city' WHEN s_suppkey % 50 = 0 THEN 'no_area' END AS reason FROM supplier WHERE s_suppkey % 9 > 0 OR true""")
def json_ld_listings(s, d):
    k = c("s_suppkey")
    home = F.to_json(F.struct(F.struct(F.concat(k % 50, F.lit(" m²")).alias("value"), F.lit("MTK").alias("unitCode")).alias("floorSize"), (k % 4 + 1).alias("numberOfRooms"), F.struct(F.when(c("s_nationkey") % 5 == 0, "Elsewhere").otherwise("Warszawa").alias("addressLocality")).alias("address")))
    offer = F.concat(F.lit('{"@id":"#o","@type":"Offer","priceCurrency":"PLN","itemOffered":{"@id":"#h"},"price":"'), k * 1000, F.lit(',50 zł"}'))
    listing = F.concat(F.lit('{"@type":"RealEstateListing","offers":{"@id":"#o"},"identifier":"S'), k, F.lit('","url":"../o/'), k, F.lit('?gclid=1#x"'), F.when(k % 9 == 0, ',"name":"for rent"').otherwise(""), F.lit("}"))
    html = F.concat(F.lit('<p>x</p><script type="application/ld+json">{"@graph":['), listing, F.lit(","), offer, F.lit(',{"@id":"#h","@type":"Apartment",'), F.substr(home, F.lit(2)), F.lit("]}</script>"))
    made = t(s, d, "supplier").select(k.cast("long").alias("page_id"), F.lit("https://www.a.example/l/").alias("url"), html.alias("html"))
    return pages.listing_rows(made).select("page_id", "listing_id", "price_pln", "area_m2", "rooms", "url", "reason")


@query("""SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'housing_participation_indicated' WHEN 1 THEN 'partial_ownership_indicated' WHEN 2 THEN 'partial_ownership_indicated' WHEN 3 THEN CASE WHEN p_size % 6 BETWEEN 1 AND 4 THEN 'partial_ownership_indicated' ELSE '' END WHEN 4 THEN 'housing_participation_indicated|partial_ownership_indicated' ELSE '' END AS flags FROM part""")
def rights_flags(s, d):
    k = c("p_partkey") % 7
    slug = F.when(k == 0, "mieszkanie-tbs").when(k == 1, "sprzedam-udzia%C5%82-w-kamienicy").when(k == 2, "Udział-w-LOKALU").when(k == 3, F.concat(F.lit("udzial-"), c("p_size") % 6, F.lit("-5-w-kamienicy"))).when(k == 4, "cesja-najmu-udzial-20%25-czesci").when(k == 5, "dom-z-udzialem-w-drodze-1-4").otherwise("ladne-mieszkanie")
    words = scope.slug_text(F.concat(F.lit("https://a.example/oferta/"), slug))
    named = t(s, d, "part").select("p_partkey", words.alias("w"))
    return named.select("p_partkey", F.array_join(scope.rights_flags(c("w")), "|").alias("flags"))


@query("""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'malformed' WHEN 1 THEN 'other_origin' WHEN 2 THEN 'other_page' WHEN 3 THEN 'rental' WHEN 4 THEN 'other_path' END AS reason FROM pages""")
def search_url_reasons(s, d):
    base, k = "https://s.example/sale/flats", c("page_id") % 6
    url = F.when(k == 0, base + "#x").when(k == 1, "https://s.example.org/sale/flats").when(k == 2, base + "?page=2").when(k == 3, base + "?q=%2577ynajem").when(k == 4, "https://s.example/rent").otherwise(base + "/?page=1&order=new")
    return t(s, d, "pages").select("page_id", scope.search_url_reason(url, "s.example", ("/sale/flats",), F.lit(1)).alias("reason"))


@query("""SELECT p_partkey, NOT ((p_partkey % 3 = 0 AND p_size % 2 = 1) OR (p_partkey % 3 = 1 AND p_size % 5 = 0)) AS allowed FROM part""")
def robots_verdicts(s, d):
    files = s.createDataFrame([(0, "user-agent: *\nDisallow: /\nUser-Agent: Own\nDisallow: /p/\nAllow: /p/even"), (1, "User-agent: *\nDisallow: /*/5$ # fifths"), (2, "Sitemap: x")], "site int, t string")
    rules = robots.rules(robots.lines(files, "site", "t"), "site")
    path = F.when(c("p_partkey") % 3 == 1, F.concat(F.lit("/q/"), F.when(c("p_size") % 5 == 0, "5").otherwise("55x"))).otherwise(F.concat(F.lit("/p/"), F.when(c("p_size") % 2 == 0, "even").otherwise("odd")))
    urls = t(s, d, "part").select("p_partkey", (c("p_partkey") % 3).cast("int").alias("site"), path.alias("path"))
    return robots.allowed(urls, rules, "site", "path", "own").select("p_partkey", "allowed")


@query("""SELECT s_suppkey AS site, agent, CAST(CASE s_suppkey % 3 WHEN 0 THEN s_suppkey % 7 + 1.5 ELSE greatest(120, 7) END AS DOUBLE) AS seconds FROM supplier, (VALUES (0, '*'), (1, 'own'), (1, 'other')) x(kind, agent) WHERE s_suppkey % 3 = kind""")
def robots_delays(s, d):
    """Robots files of suppliers' sites: two delays for all agents, a rate and a delay for two named ones, a delay without an agent."""
    k = c("s_suppkey")
    first = F.concat(F.lit("User-agent: *\nCrawl-delay: 1\nCrawl-delay: "), (k % 7 + 1.5).cast("string"))
    text = F.when(k % 3 == 0, first).when(k % 3 == 1, "User-agent: own\nUser-agent: other\nRequest-rate: 1/2m\nCrawl-delay: 7").otherwise("Crawl-delay: 9")
    return robots.delays(robots.lines(t(s, d, "supplier").select(k.alias("site"), text.alias("t")), "site", "t"), "site")


def _records(s, d):
    """Orders as catalogue records, some of which break the contract."""
    k, none = c("o_orderkey"), F.lit(None)
    return t(s, d, "orders").select(
        F.when(k % 31 == 0, "www.x.example").otherwise("www.a.example").alias("source"), k.cast("string").alias("listing_id"),
        F.concat(F.lit("https://www.a.example/d/offer/x-"), k, F.when(k % 29 == 0, ".html?q").otherwise(".html")).alias("url"), F.when(k % 23 == 0, "Elsewhere").otherwise("Warszawa").alias("city"), none.cast("string").alias("district"),
        F.when(k % 19 == 0, F.lit("true")).when(k % 17 == 0, F.lit("0")).otherwise(c("o_totalprice").cast("string")).alias("price_pln"), F.lit("50").alias("area_m2"), F.when(k % 13 == 0, "2.5").otherwise("2").alias("rooms"), F.when(k % 11 == 0, "3").alias("rooms_min"),
        *[none.cast("string").alias(n) for n in ("floor", "build_year", "latitude", "longitude", "distance_km", "published_at")], F.when(k % 7 == 0, "2026-01-01T00:00:00").otherwise("2026-01-01T00:00:00+01:00").alias("observed_at"),
    )


@query("""SELECT CASE WHEN o_orderkey % 31 = 0 OR o_orderkey = 0 THEN 'invalid_identity' WHEN o_orderkey % 23 = 0 THEN 'other_city' WHEN o_orderkey % 29 = 0 THEN 'invalid_url' WHEN o_orderkey % 19 = 0 OR o_orderkey % 13 = 0 THEN 'invalid_number' WHEN o_orderkey % 17 = 0 THEN 'not_positive' WHEN o_orderkey % 11 = 0 THEN 'contradictory_rooms' WHEN o_orderkey % 7 = 0 THEN 'invalid_time' ELSE 'accepted' END AS reason, count(*) AS n FROM orders GROUP BY 1""")
def catalogue_contract(s, d):
    return contracts.reason_counts(contracts.catalogue_reasons(_records(s, d), PATHS))


@query("""SELECT CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 13 = 0 THEN 'invalid_number' WHEN o_orderkey % 7 = 0 THEN 'invalid_time' ELSE 'accepted' END AS reason, count(*) AS n FROM orders GROUP BY 1""")
def price_contract(s, d):
    return contracts.reason_counts(contracts.price_reasons(_records(s, d)))


@query("""SELECT CASE WHEN o_orderkey = 0 THEN 'invalid_identity' WHEN o_orderkey % 19 = 0 OR o_orderkey % 13 = 0 THEN 'invalid_number' WHEN o_orderkey % 17 = 0 THEN 'not_positive' ELSE 'accepted' END AS reason, count(*) AS n FROM orders GROUP BY 1""")
def preview_contract(s, d):
    fields = ("source", "listing_id", "price_pln", "area_m2", "rooms")
    return contracts.reason_counts(contracts.preview_reasons(_records(s, d).select(*fields), fields, (1, 3)))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount, CASE WHEN o_orderkey % 4 = 1 THEN o_totalprice END AS plain, CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_orderkey AS BIGINT) END AS whole, CASE WHEN o_orderkey % 4 = 1 AND o_orderkey BETWEEN 5 AND 500 THEN CAST(o_orderkey AS INTEGER) END AS bounded,
 o_orderkey % 4 = 2 AS refused, o_totalprice AS from_json FROM orders""")
def strict_numbers(s, d):
    k, price = c("o_orderkey"), F.format_string("%.2f", "o_totalprice")
    amount = F.when(k % 4 == 0, F.concat(F.lit(" "), F.replace(price, F.lit("."), F.lit(",")))).when(k % 4 == 1, price).when(k % 4 == 2, "1,2.3").otherwise("1e5")
    plain = F.when(k % 4 == 1, price).when(k % 4 == 2, "true").otherwise(F.concat(F.lit("-"), price, F.lit(" zł")))
    whole = F.when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, "1.5").otherwise("x")
    stored, refused = v.stored_number(F.when(k % 4 == 2, "true").otherwise(price))
    js = F.try_parse_json(F.concat(F.when(k % 2 == 0, '"').otherwise(""), price, F.when(k % 2 == 0, '"').otherwise("")))
    return t(s, d, "orders").select("o_orderkey", v.decimal_text(amount).cast("decimal(18,2)").alias("amount"), v.plain_number(plain).alias("plain"), v.plain_whole(whole).alias("whole"), v.whole_between(whole, 5, 500).alias("bounded"), refused.alias("refused"), v.json_number_or_text(js).alias("from_json"))


#: The zone's changes of clocks in a year, as days: the last Sundays of March and of October (till 1995 September).
LAST_SUNDAY = "make_date(year({0})::INT, {1}) - dayofweek(make_date(year({0})::INT, {1}))::INT"
CHANGES = f"{LAST_SUNDAY.format('{0}', '3, 31')} AS spring, CASE WHEN year({{0}}) < 1996 THEN {LAST_SUNDAY.format('{0}', '9, 30')} ELSE {LAST_SUNDAY.format('{0}', '10, 31')} END AS autumn"


@query(f"""WITH l AS (SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) + INTERVAL 30 MINUTE AS at_ FROM orders), z AS (SELECT *, {CHANGES.format("at_")} FROM l)
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN true WHEN o_orderkey % 3 = 1 THEN at_ >= spring + INTERVAL 3 HOUR AND at_ < autumn + INTERVAL 3 HOUR ELSE at_ < spring + INTERVAL 2 HOUR OR at_ >= autumn + INTERVAL 2 HOUR END AS fits FROM z""")
def local_offsets(s, d):
    """Times of all hours and months: an hour in spring has no local time, one in autumn has two."""
    local = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (c("o_orderkey") % 24).cast("int"), F.lit(30))
    text = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.when(c("o_orderkey") % 3 == 0, "Z").when(c("o_orderkey") % 3 == 1, "+02:00").otherwise("+01:00"))
    return t(s, d, "orders").select("o_orderkey", v.local_offset_fits(text, "Europe/Warsaw").alias("fits"))


@query(f"""WITH z AS (SELECT o_orderkey, o_orderdate::DATE AS day, {CHANGES.format("o_orderdate")} FROM orders), b AS (SELECT o_orderkey, day, spring, autumn, day > spring AND day <= autumn AS summer, day + 1 > spring AND day + 1 <= autumn AS after FROM z)
SELECT o_orderkey, day::TIMESTAMP - CASE WHEN summer THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS day_start, CAST(24 - CASE WHEN day = spring THEN 1 WHEN day = autumn THEN -1 ELSE 0 END AS BIGINT) AS hours FROM b""")
def civil_days(s, d):
    """Starts and lengths of civil days of all months; days of a change have 23 or 25 hours."""
    start, end = v.day_bounds(F.to_date("o_orderdate"), "Europe/Warsaw")
    return t(s, d, "orders").select("o_orderkey", start.cast("timestamp_ntz").alias("day_start"), ((F.unix_seconds(end) - F.unix_seconds(start)) / 3600).cast("long").alias("hours"))


@query("""SELECT page_id, 'https://h.example/a/' || CASE page_id % 4 WHEN 0 THEN 'b/x' WHEN 1 THEN 'x' WHEN 2 THEN 'b/c?z=1' ELSE '../a/y' END AS link FROM pages WHERE page_id % 4 < 3 UNION ALL SELECT page_id, 'https://h.example/y' FROM pages WHERE page_id % 4 = 3""")
def resolved_links(s, d):
    k = c("page_id") % 4
    link = F.when(k == 0, "./x").when(k == 1, "../x").when(k == 2, "?z=1").otherwise("/y")
    return t(s, d, "pages").select("page_id", v.resolved_url(link, F.lit("https://h.example/a/b/c?q#f")).alias("link"))


@query("SELECT c_custkey, c_name || ' red' AS shown, lower(c_mktsegment) || ' ó' AS name, c_custkey % 4 <> 0 AS same FROM customer")
def text_forms(s, d):
    k = c("c_custkey") % 4
    dirty = F.concat(F.lit("\x07 "), "c_name", F.lit("\n\x1b[31m red\x1b[0m  "))
    name = F.concat(F.lit("  "), "c_mktsegment", F.lit("  "), F.when(k < 2, "Ó").otherwise("Ó"))
    frame = t(s, d, "customer").select("c_custkey", v.shown(dirty).alias("shown"), v.identity_text(name).alias("name"), F.when(k == 1, float("nan")).when(k == 0, 1.0).alias("latitude"), F.lit(None).cast("double").alias("floor"))
    none = F.struct(F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("floor"))
    return frame.select("c_custkey", "shown", "name", v.signature(["latitude", "floor"]).eqNullSafe(none).alias("same"))


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://h.example' WHEN 1 THEN 'https://h.example:8443' END AS origin FROM pages")
def url_origins(s, d):
    k = c("page_id") % 3
    url = F.when(k == 0, "HTTPS://H.example:443/a?b").when(k == 1, "https://h.example:8443/x").otherwise("/relative")
    return t(s, d, "pages").select("page_id", v.origin(url).alias("origin"))
