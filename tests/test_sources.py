"""Pages, portals, robots files and scope rules against hand-made expectations."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.errors import SourceError
from tidemark.functions import scope
from tidemark.sources import pages, portals, robots, state

PAGE = "https://www.example.com/offers/list?page=1"


def script(value):
    return f'<script type="application/ld+json">{json.dumps(value)}</script>'


def listing_rows(spark, *htmls):
    frame = spark.createDataFrame([(k, PAGE, h) for k, h in enumerate(htmls)], "page_id long, url string, html string")
    return sorted((r.asDict() for r in pages.listing_rows(frame).collect()), key=lambda r: (r["page_id"], r["position"]))


def test_linked_graph_is_one_listing(spark):
    graph = {
        "@graph": [
            {"@id": "#home", "@type": "Apartment", "floorSize": {"value": "74,25", "unitCode": "MTK"}, "numberOfRooms": 4, "address": {"addressLocality": "Warszawa", "addressDistrict": "Ochota"}, "geo": {"latitude": "52,2297", "longitude": "21,0122"}, "floorLevel": "parter", "yearBuilt": 1936},
            {"@id": "#offer", "@type": "https://schema.org/Offer", "price": "981 300,75 zł", "itemOffered": {"@id": "#home"}},
            {"@id": "#page", "@type": ["RealEstateListing"], "identifier": "flat/7-b", "url": "/homes/seven?utm_medium=z&k=v#photos", "offers": "#offer"},
        ]
    }
    (row,) = listing_rows(spark, script(graph))
    assert row["reason"] is None and (row["source"], row["listing_id"], row["url"]) == ("www.example.com", "flat/7-b", "https://www.example.com/homes/seven?k=v")
    assert (row["price_pln"], row["area_m2"], row["rooms"], row["floor"], row["build_year"], row["district"], row["distance_km"]) == (981300.75, 74.25, 4, 0, 1936, "Ochota", 0.0)


def test_listings_and_their_refusals(spark):
    home = {"@type": "Apartment", "floorSize": "47,5 m²", "numberOfRooms": "2", "address": {"addressLocality": " WARSAW "}, "offers": {"@type": "Offer", "price": "650.000", "priceCurrency": "PLN"}}
    changed = [
        {}, {"address": {"addressLocality": "Elsewhere"}}, {"numberOfRooms": 1.5}, {"floorSize": {"value": 50, "unitText": "ft2"}}, {"floorSize": 0}, {"name": "na wynajem"},
        {"offers": {"price": 100, "priceCurrency": "EUR"}}, {"offers": {"price": 100, "priceCurrency": "PLN", "priceSpecification": {"unitText": "PLN/m2"}}}, {"offers": {"price": 9, "priceCurrency": "PLN", "businessFunction": "http://x#LeaseOut"}},
    ]
    rows = listing_rows(spark, *[script(home | c) for c in changed], script([home, home]), "<p>none", '<script type="application/ld+json">{"a":1,"a":2}</script>')
    assert [r["reason"] for r in rows] == [None, "other_city", "no_exact_rooms", "unknown_area_unit", "no_area", "rental", "no_total_price", "price_of_an_area", "rental", None, "repeated_identity"]
    assert (rows[0]["price_pln"], rows[0]["listing_id"][:4], rows[0]["url"]) == (650000.0, "url_", PAGE)


def chunks(*texts, tail=""):
    return "".join(f"<script>self.__next_f.push([1,{json.dumps(t)}])</script>" for t in texts) + tail


def test_streamed_state():
    assert state.streamed(chunks('1:{"apart', 'ments":[1]}\n2:I["m"]\n', "3:HL[]\n:HL[1]\n1:" + '{"apartments":[1]}') + "<script>self.__next_f.push([0])</script>") == {"1": {"apartments": [1]}}
    assert state.agreeing({"1": {"apartments": [1]}, "2": [{"apartments": [1]}]}, "apartments") == [1]
    for html, why in (
        (chunks(':{"a":1}'), "line_without_id"), (chunks("z:1"), "line_without_id"), (chunks("1:1\n1:2"), "record_changed"), ("<script>self.__next_f.push([1,2])</script>", "unknown_call"),
        ("<script>self.__next_f.push([3,'x'])</script>", None), ("<script>self.__next_f.push([1,\"1:1\"], 2)</script>", "call_of_more_than_one_value"), ("<p>", "no_records"), (chunks("1:NaN"), None), (chunks("1:Hx"), None), (chunks("1:I{}"), "metadata_without_list"),
    ):
        with pytest.raises(ValueError) as found:
            state.streamed(html)
        assert why is None or (isinstance(found.value, SourceError) and str(found.value) == why)


A = portals.Portal("www.a.example", category_path="homes/flats/sale", path="/d/offer/[^/]+\\.html")


def ad(**more):
    base = {
        "id": 7, "category": {"id": 14}, "location": {"cityName": "Warszawa", "districtName": " Wola "}, "url": "/d/offer/nice-7.html#x", "price": {"regularPrice": {"value": 500000, "currencyCode": "PLN"}},
        "params": [{"key": "m", "normalizedValue": "50.5"}, {"key": "rooms", "normalizedValue": "two"}, {"key": "floor_select", "normalizedValue": "floor_-1"}], "map": {"show_detailed": True, "lat": 52.2297, "lon": "21.0122"},
    }
    return base | more


def searched(spark, ads, sparse=False, **listing):
    whole = {"listing": {"listing": {"categoryId": 14, "pageNumber": 0, "requestParams": {"categoryPath": "homes/flats/sale/"}, "ads": ads} | listing}, "categories": {"list": {"14": {"path": "homes/flats/sale"}}}}
    frame = spark.createDataFrame([(1, "https://www.a.example/s", json.dumps(whole))], "page_id long, page_url string, state string")
    return [r.asDict() for r in portals.search_rows(frame, A, page_number=F.lit(1), sparse=sparse).orderBy("position").collect()]


def test_search_rows(spark):
    (row,) = searched(spark, [ad()])
    assert row["reason"] is None and {k: row[k] for k in ("source", "listing_id", "url", "district", "price_pln", "area_m2", "rooms", "floor", "distance_km")} == {
        "source": "www.a.example", "listing_id": "7", "url": "https://www.a.example/d/offer/nice-7.html", "district": "Wola", "price_pln": 500000.0, "area_m2": 50.5, "rooms": 2, "floor": -1, "distance_km": 0.0,
    }
    bad = {
        "not_an_item": 5, "other_category": ad(category={"id": "14"}), "other_city": ad(location={"cityName": "X"}), "contradictory_city": ad(location={"cityName": "Warszawa", "cityNormalizedName": "x"}), "inactive": ad(status="old"),
        "invalid_identity": ad(id="7"), "invalid_url": ad(url="https://other.example/d/offer/a.html"), "no_total_price": ad(price={"free": True, "regularPrice": {"value": 1, "currencyCode": "PLN"}}),
        "invalid_parameters": ad(params=None), "repeated_parameter": ad(params=[{"key": "m"}, {"key": "m"}]), "no_area": ad(params=[{"key": "rooms", "normalizedValue": "one"}]), "no_exact_rooms": ad(params=[{"key": "m", "normalizedValue": 5}, {"key": "rooms", "normalizedValue": "four"}]),
    }
    assert [r["reason"] for r in searched(spark, list(bad.values()))] == list(bad)
    sparse = searched(spark, [bad["no_total_price"] | {"id": 1, "url": "/d/offer/1.html"}, bad["no_exact_rooms"] | {"id": 2, "url": "/d/offer/2.html"}, ad(id=3, url="/d/offer/3.html", params=None)], sparse=True)
    assert [(r["reason"], r["price_pln"], r["rooms"], r["rooms_min"]) for r in sparse] == [(None, None, 2, None), (None, 500000.0, None, 4), (None, 500000.0, None, None)]
    assert [r["reason"] for r in searched(spark, [ad(), ad()])] == [None, "duplicate_on_page"]
    assert {r["reason"] for r in searched(spark, [ad(), ad(price={"regularPrice": {"value": 1, "currencyCode": "PLN"}})])} == {"contradictory_page"}
    assert {r["reason"] for r in searched(spark, [ad(), ad(id=8)])} == {"contradictory_page"}
    assert [r["reason"] for r in searched(spark, [ad()], pageNumber=1)] == ["unconfirmed_page"]
    assert [r["reason"] for r in searched(spark, None)] == ["unknown_structure"] and [r["reason"] for r in searched(spark, [])] == ["no_items"]


PLACE = "land/town"
B = portals.Portal("www.b.example", location=PLACE)


def flat(**more):
    places = [{"locationLevel": "city_or_village", "id": PLACE, "name": "Warszawa"}, {"locationLevel": "district", "id": PLACE + "/wola", "name": "Wola"}]
    return {"id": 9, "estate": "FLAT", "transaction": "SELL", "slug": "nice-ID9", "href": "[lang]/ad/nice-ID9", "totalPrice": {"value": 7e5, "currency": "PLN"}, "areaInSquareMeters": 40, "roomsNumber": "TWO", "floorNumber": "GROUND", "location": {"reverseGeocoding": {"locations": places}}} | more


def scripted(spark, items, sparse=False, number=1, **page):
    whole = {"props": {"pageProps": {"estate": "FLAT", "transaction": "SELL", "location": PLACE, "canonicalURL": "/x", "filteringQueryParams": {"page": 1}, "data": {"searchAds": {"items": items, "pagination": {"currentPage": 1}}}} | page}}
    frame = spark.createDataFrame([(1, "https://www.b.example/s", json.dumps(whole))], "page_id long, page_url string, state string")
    return [r.asDict() for r in portals.scripted_rows(frame, B, page_number=F.lit(number), sparse=sparse, most_members=3).orderBy("position").collect()]


def test_scripted_rows(spark):
    (row,) = scripted(spark, [flat()])
    assert row["reason"] is None and (row["listing_id"], row["url"], row["district"], row["rooms"], row["floor"], row["price_pln"]) == ("9", "https://www.b.example/pl/oferta/nice-ID9", "Wola", 2, 0, 700000.0)
    two = [{"locationLevel": "city_or_village", "id": PLACE, "name": "Warszawa"}, {"locationLevel": "district", "id": PLACE + "/a/b", "name": "Deep"}]
    bad = {
        "not_an_individual_sale": flat(estate="HOUSE"), "invalid_identity": flat(id=True), "invalid_url": flat(slug="-x"), "advertising_presentation": flat(href="hpr/x"), "unconfirmed_place": flat(location={"reverseGeocoding": {"locations": two}}),
        "no_total_price": flat(hidePrice=True), "no_area": flat(areaInSquareMeters="40"), "no_exact_rooms": flat(roomsNumber="FIVE"),
    }
    assert [r["reason"] for r in scripted(spark, list(bad.values()))] == list(bad)
    assert [(r["reason"], r["rooms"], r["price_pln"]) for r in scripted(spark, [bad["no_exact_rooms"], flat(id=2, slug="b-ID2", href="[lang]/ad/b-ID2", hidePrice=True)], sparse=True)] == [(None, 5, 700000.0), (None, 2, None)]
    group = {"estate": "INVESTMENT", "transaction": "SELL", "id": 5, "slug": "inv-ID5", "href": "[lang]/investment/inv-ID5", "relatedAds": [flat(), flat(id=10, slug="c-IDc", href="[lang]/ad/c-IDc")]}
    assert [(r["listing_id"], r["reason"]) for r in scripted(spark, [group])] == [("9", None), ("10", None)]
    assert [r["reason"] for r in scripted(spark, [group | {"href": "x"}])] == ["invalid_group"]
    assert [r["reason"] for r in scripted(spark, [group | {"relatedAds": [flat()] * 4}])] == ["too_many_members"]
    assert [r["reason"] for r in scripted(spark, [flat()], number=2)] == ["unconfirmed_page"]


def unit(**more):
    return {"number": "A1/02", "slugNumber": "A1-02", "id": "u1", "city": "T", "investment": "I", "building": "A", "status": "available", "isCommercialUnit": False, "area": 40.5, "rooms": 2, "floor": 0, "price": 500000} | more


def test_units_and_reconciliation(spark):
    def told(*units):
        frame = spark.createDataFrame([(1, json.dumps(units))], "page_id long, units string")
        return portals.unit_rows(frame, city="T", investment="I", url_base="https://u.example/")

    bad = {
        "missing_text": unit(building=" "), "invalid_number": unit(number="A//1"), "slug_differs": unit(slugNumber="A1-03"), "other_place": unit(city="X"), "unknown_status": unit(status="new"), "invalid_commercial_mark": unit(isCommercialUnit="no"),
        "invalid_rooms": unit(rooms=None), "invalid_floor": unit(floor=-1), "not_positive": unit(price="5"),
    }
    for why, u in bad.items():
        assert [r.reason for r in told(u).collect()] == [why]
    assert [r.reason for r in told(unit(), unit()).collect()] == [None] and {r.reason for r in told(unit(), unit(area=1.0)).collect()} == {"contradictory_unit"}
    assert [r.reason for r in told(unit(isCommercialUnit=True, rooms=None)).collect()] == [None]
    units = told(*[unit(number=f"A1/{k}", slugNumber=f"A1-{k}", id=f"u{k}", status="sold" if k == 15 else "available", isCommercialUnit=k == 16) for k in range(10, 18)])
    prices = spark.createDataFrame([("A1/10", 500000.01, 1, 9), ("A1/11", 500000.02, 1, 9), ("A1/12", 500000.0, 6, 9), ("A1/13", 500000.0, 1, 9), ("A1/13", 500000.0, 1, 9), ("A1/15", 1.0, 1, 9), ("A1/16", 1.0, 1, 9), ("A1/99", 1.0, 1, 9)], "unit_number string, price_pln double, valid_from int, valid_until int")
    found = portals.reconciled(prices, units, F.lit(5))
    assert {r.number[3:]: r.verdict for r in found.collect()} == {
        "10": "matched", "11": "prices_disagree", "12": "price_not_valid", "13": "repeated_unit", "14": "unit_without_price", "15": "not_offered", "16": "price_of_commercial_unit", "17": "unit_without_price", "99": "price_without_unit",
    }
    assert {r.verdict: r.n for r in portals.join_errors(found).collect()}["unit_without_price"] == 2


def test_robots(spark):
    text = "User-agent: a\nUser-agent: B\nDisallow: /x\nAllow: /x/y\nCrawl-delay: 3\nRequest-rate: 1/2m\n\nUser-agent: *\nDisallow: /*.pdf$\nDisallow: /%7Eme\nDisallow:\nDisallow: /é\nuser-agent: a\nDisallow: /late # note"
    found = robots.lines(spark.createDataFrame([(1, text)], "site int, t string"), "site", "t")
    rules = robots.rules(found, "site")
    assert {(r.agent, r.allow, r.pattern) for r in rules.collect()} == {(a, *p) for a in "ab" for p in ((False, "/x"), (True, "/x/y"))} | {("a", False, "/late"), ("*", False, "/*.pdf$"), ("*", False, "/~me"), ("*", False, "/%C3%A9")}
    assert {(r.agent, r.seconds) for r in robots.delays(found, "site").collect()} == {("a", 120.0), ("b", 120.0)}
    paths = ["/x", "/x/y/z", "/late", "/q.pdf", "/q.pdf?x", "/~me/a", "/é/1", "/%c3%a9", "/ok"]
    urls = spark.createDataFrame([(1, p) for p in paths] + [(2, "/x")], "site int, p string")
    said = lambda agent: {(r.site, r.p): r.allowed for r in robots.allowed(urls, rules, "site", "p", agent).collect()}
    assert [p for p in paths if not said("A")[1, p]] == ["/x", "/late"] and [p for p in paths if not said("z")[1, p]] == ["/q.pdf", "/~me/a", "/é/1", "/%c3%a9"]
    assert said("z")[2, "/x"]


def test_rights_flags(spark):
    cases = {
        "/o/mieszkanie-tbs-odstepne": ["housing_participation_indicated"], "/o/cesja-umowy-najmu-lokalu": ["housing_participation_indicated"], "/o/partycypacja": ["housing_participation_indicated"], "/o/cesja-umowy": [],
        "/o/udzia%C5%82-1-2-mieszkania": ["partial_ownership_indicated"], "/o/udzial-w-mieszkaniu": ["partial_ownership_indicated"], "/o/udzial-50%25-w-kamienicy": ["partial_ownership_indicated"], "/o/sprzedam-udzial-w-kamienicy": ["partial_ownership_indicated"],
        "/o/mieszkanie-z-udzialem-w-gruncie-1-2": [], "/o/sprzedam-udzial-w-drodze": [], "/o/udzial-3-2-w-kamienicy": [], "/o/piekne-mieszkanie": [], "/o/udzial-w-wlasnosciowym-prawie-do-lokalu": ["partial_ownership_indicated"],
        "/udzial-1-2/o": [], "/o/udzial-w-drodze-udzial-w-lokalu": ["partial_ownership_indicated"], "/o/tbs-udzial-1-3-mieszkania": ["housing_participation_indicated", "partial_ownership_indicated"], None: [],
    }
    frame = spark.createDataFrame([(None if k is None else "https://e.org" + k,) for k in cases], "u string")
    words = frame.select("u", scope.slug_text(F.col("u")).alias("w"))
    got = {r.u and r.u[13:]: r.f for r in words.select("u", scope.rights_flags(F.coalesce("w", F.lit(""))).alias("f")).collect()}
    assert got == cases


def test_search_urls(spark):
    ok = "https://s.example/sale/flats"
    cases = {ok: None, ok + "/?page=1": None, ok + "?Page=2": "other_page", ok + "?page=1&page=1": "other_page", ok + "#x": "malformed", "http://s.example/sale/flats": "other_origin", "https://u@s.example/sale/flats": "other_origin", "https://s.example.org/sale/flats": "other_origin",
             "https://s.example/rent": "other_path", ok + "?q=wynajem": "rental", ok + "?q=%2577ynajem": "rental", ok + "?a=b&order=new": None}
    frame = spark.createDataFrame([(k,) for k in cases], "u string")
    got = {r.u: r.r for r in frame.select("u", scope.search_url_reason(F.col("u"), "s.example", ("/sale/flats/",), F.lit(1)).alias("r")).collect()}
    assert got == cases
    assert frame.limit(1).select(scope.search_url_reason(F.lit(ok + "?page=2"), "s.example", ("/sale/flats",), F.lit(2)).alias("r")).first().r is None
