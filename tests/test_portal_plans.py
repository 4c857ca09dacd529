"""A portal's page is parsed once, and its rows are told apart as before."""

import json

from pyspark.sql import functions as F

from tidemark.plans import reading
from tidemark.sources import portals



def test_pages_are_parsed_once(spark):
    states = spark.createDataFrame([], "page_id long, page_url string, state string")
    for read, portal in ((portals.search_rows, reading.PORTAL), (portals.scripted_rows, reading.SCRIPTED)):
        plan = read(states, portal, page_number=F.lit(1))._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("parsejson(") + plan.count("parse_json(") + plan.count("parsejson,") <= 1


def test_rows_that_come_again(spark):
    def ad(ident, path="a", price=5):
        return {"id": ident, "category": {"id": 14}, "location": {"cityName": "Warszawa"}, "url": f"/d/offer/{path}.html", "price": {"regularPrice": {"value": price, "currencyCode": "PLN"}}, "params": [{"key": "m", "normalizedValue": "40"}, {"key": "rooms", "normalizedValue": "two"}]}

    ads = [ad(1), ad(1), ad(2, "b"), ad(2, "b", 6), ad(3, "c"), ad(4, "c"), ad(5, "d"), {"id": 6}, 7]
    state = {"listing": {"listing": {"categoryId": 14, "pageNumber": 0, "requestParams": {"categoryPath": "homes/flats/"}, "ads": ads}}, "categories": {"list": {"14": {"path": "homes/flats"}}}}
    given = spark.createDataFrame([(1, "https://www.a.example/s", json.dumps(state)), (2, "https://www.a.example/s", None), (3, "https://www.a.example/s", "{}")], "page_id long, page_url string, state string")
    got = portals.search_rows(given, reading.PORTAL, page_number=F.lit(1)).orderBy("page_id", "position").collect()
    clash = "contradictory_page"
    assert [r.reason for r in got] == [None, "duplicate_on_page", clash, clash, clash, clash, None, "other_category", "not_an_item", "no_state", "unknown_structure"]
    assert (got[0].price_pln, got[0].area_m2, got[0].rooms, got[0].url) == (5.0, 40.0, 2, "https://www.a.example/d/offer/a.html")
