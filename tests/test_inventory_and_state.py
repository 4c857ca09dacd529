"""Inventory snapshots, leases and embedded page state."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import inventory
from tidemark.sources import state


def test_digests_and_verdicts(spark):
    rows = [("s", 1, "a", "x"), ("s", 1, "b", None), ("s", 2, "b", None), ("s", 2, "a", "x"), ("s", 3, "a", "x"), ("s", 3, "b", ""), ("s", 4, "a", "x"), ("s", 4, "b", None), ("s", 4, "b", None)]
    got = {r.at: r.digest for r in inventory.digests(spark.createDataFrame(rows, "scope string, at int, id string, v string"), ["scope", "at"], ["id", "v"]).collect()}
    assert got[1] == got[2] and len({got[1], got[3], got[4]}) == 3
    schema = "scope string, observed_at int, digest string"
    headers = spark.createDataFrame([("s", 3, "p"), ("s", 5, "q")], schema)
    arriving = spark.createDataFrame([("s", 3, "p"), ("s", 3, "z"), ("s", 4, "p"), ("s", 6, "p"), ("t", 1, "p")], schema)
    out = inventory.admitted(headers, arriving, ["scope"])
    assert {(r.scope, r.observed_at, r.digest): r.verdict for r in out.collect()} == {("s", 3, "p"): "replay", ("s", 3, "z"): "conflict", ("s", 4, "p"): "older", ("s", 6, "p"): "new", ("t", 1, "p"): "new"}
    assert inventory.admitted(headers.where("false"), arriving, ["scope"]).where("verdict <> 'new'").isEmpty()


def test_settled(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2)], "id string, last_seen_at int")
    reported = spark.createDataFrame([("b", "sold"), ("c", "available")], "id string, status string")
    got = {tuple(r) for r in inventory.settled(current, reported, ["id"], F.lit(9)).collect()}
    assert got == {("a", "missing", 1, 9), ("b", "sold", 9, 9), ("c", "available", 9, 9)}


def test_claimed(spark):
    leases = spark.sql("SELECT * FROM VALUES ('a', 'x', TIMESTAMP '2020-01-01 02:00:00'), ('b', NULL, NULL), ('c', 'x', TIMESTAMP '2020-01-01 02:00:00'), ('d', 'x', TIMESTAMP '2020-01-01 02:00:00') AS t(k, owner, until)")
    asked = spark.sql("SELECT k, owner, CAST(at AS TIMESTAMP) AS at FROM VALUES ('a', 'y', '2020-01-01 01:59:59'), ('a', 'z', '2020-01-01 02:00:00'), ('b', 'q', '2020-01-01 00:00:00'), ('b', 'p', '2020-01-01 00:00:00'), ('c', 'x', '2020-01-01 01:00:00'), ('d', 'y', '2020-01-01 01:00:00'), ('e', 'n', '2020-01-01 00:00:00') AS t(k, owner, at)")
    got = {r.k: (r.owner, r.until.hour) for r in inventory.claimed(leases, asked, ["k"]).collect()}
    assert got == {"a": ("z", 4), "b": ("p", 2), "c": ("x", 3), "d": ("x", 2), "e": ("n", 2)}


def script(body, attrs=""):
    return f"<html><script {attrs}>{body}</script></html>"


def test_carriers():
    assert state.assigned(script("w.S = " + json.dumps(json.dumps({"a": 1})) + ";"), "w.S") == {"a": 1}
    assert state.assigned(script('w.S={"a":[1]}; if (w.S == 1) {}'), "w.S") == {"a": [1]}
    assert state.scripted(script('{"p":{}}', 'id="__NEXT_DATA__" type="application/json"')) == {"p": {}}
    push = lambda text: script(f"self.__next_f.push({json.dumps([1, text])})")
    page = push('1:I["m"]\n2:{"flats":[{"n":1') + push('}]}\n:HL["x"]\n3:["$",{"flats":[{"n":1}]}]\n') + script("self.__next_f.push([0])")
    assert state.agreeing(state.streamed(page), "flats") == [{"n": 1}]
    for read, bad in [
        (lambda h: state.assigned(h, "w.S"), script('w.S={"a":1,"a":2}')), (lambda h: state.assigned(h, "w.S"), script("w.S=1") * 2), (state.scripted, script("{}", 'id="__NEXT_DATA__"')),
        (state.scripted, script("[1]", 'id="__NEXT_DATA__" type="application/json"')), (state.streamed, push("what")), (state.streamed, push("1:NaN")), (state.streamed, push("1:1e999")), (state.streamed, push("1:{}\n1:[]")), (state.streamed, script("self.__next_f.push([7,1])")), (state.streamed, None),
        (lambda h: state.agreeing({"1": {"f": [1]}, "2": {"f": [2]}}, "f"), ""),
    ]:
        with pytest.raises(ValueError):
            read(bad)


def test_groups():
    assert state.ungrouped([{"id": 1}, {"id": 2, "relatedAds": [{"id": 3}, {"id": 4}]}, {"id": 5, "relatedAds": []}]) == [{"id": 1}, {"id": 3}, {"id": 4}]
    with pytest.raises(ValueError):
        state.ungrouped([{"relatedAds": [{"relatedAds": [{}]}]}])


def test_states_of_odd_pages(spark):
    rows = [(1, script('{"b":1,"a":"ż"}', 'id="__NEXT_DATA__" type="application/json"')), (2, None), (3, "")]
    out = state.states(spark.createDataFrame(rows, "page_id long, html string")).collect()
    assert len(out) == 9 and {(r.page_id, r.carrier, r.state) for r in out if r.state} == {(1, "scripted", '{"a": "ż", "b": 1}')}
    assert state.states(spark.createDataFrame([], "page_id long, html string")).count() == 0
