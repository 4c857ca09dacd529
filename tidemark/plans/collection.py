"""Queries on collecting and publishing: bounded files, traversal budgets, source-use signals, feeds and artifacts.

The tables play the parts that ``catalogue`` gives them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import work
from tidemark.functions import values as v
from tidemark.operators import feed, rows, selection
from tidemark.plans.catalogue import JUDGED, _judged, c, query, t
from tidemark.sources import tables, traversal


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal FROM customer")
def csv_round_trip(s, d):
    folder = work.passing_folder(s, "csv")
    tables.write_csv(t(s, d, "customer"), folder, ["c_custkey", "c_name", "c_acctbal"])
    return tables.read_csv(s, folder, need=("c_custkey",), typed={"c_acctbal": "double"})


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 1")
def bundle_swap(s, d):
    folder = work.passing_folder(s, "bundle")
    for odd in (0, 1):
        tables.save_bundle(s, folder, {"suppliers": t(s, d, "supplier").where(c("s_suppkey") % 2 == odd)})
    return tables.open_bundle(s, folder, "suppliers").select("s_suppkey", "s_name")


@query("SELECT page_id, 'search' AS signal, CASE WHEN page_id % 2 = 0 THEN 'yes' ELSE 'no' END AS setting FROM pages UNION ALL SELECT page_id, 'ai-train', CASE WHEN page_id % 3 = 0 THEN 'no' ELSE 'yes' END FROM pages")
def content_signals(s, d):
    p = c("page_id")
    text = F.concat(F.lit("User-agent: *\nContent-Signal: search="), F.when(p % 2 == 0, "yes").otherwise("no"), F.lit(", ai-train=yes # note\r\ncontent-signal : ai-train="), F.when(p % 3 == 0, "no").otherwise("maybe"), F.lit(",search=yes,other=no"))
    return traversal.content_signals(t(s, d, "pages").select("page_id", text.alias("robots")), "page_id", "robots")


@query("""WITH n AS (SELECT l_linestatus, page, count(*) AS n FROM (SELECT l_linestatus, l_partkey, min(l_orderkey) AS page FROM lineitem GROUP BY 1, 2) GROUP BY 1, 2),
p AS (SELECT l_linestatus, page, coalesce(n, 0) AS new FROM (SELECT DISTINCT l_linestatus, l_orderkey AS page FROM lineitem) LEFT JOIN n USING (l_linestatus, page))
SELECT l_linestatus, page, new, CAST(taken AS BIGINT) AS taken FROM (SELECT *, sum(new) OVER (PARTITION BY l_linestatus ORDER BY page) AS taken FROM p) WHERE taken <= 100""")
def listing_budget(s, d):
    seen = t(s, d, "lineitem").select("l_linestatus", c("l_orderkey").alias("page"), "l_partkey")
    return traversal.within_budget(seen, ["l_linestatus"], "page", "l_partkey", 100)


@query(f"{JUDGED} SELECT CAST(row_number() OVER (ORDER BY gap DESC, CAST(k AS VARCHAR)) AS INTEGER) AS position, CAST(k AS VARCHAR) AS listing_id, 'Centre ' || (k % 5) AS district, round(predicted - price, 6) AS model_gap_pln FROM j WHERE reason IS NULL ORDER BY position LIMIT 50")
def feed_offers(s, d):
    best = selection.ranked(_judged(s, d)).withColumns({"district": F.concat(F.lit("\x07Centre \n"), c("listing_id").cast("long") % 5), "rooms": F.lit(2)})
    return feed.offers(best).select("position", "listing_id", "district", F.round("model_gap_pln", 6).alias("model_gap_pln"))


@query("""WITH o AS (SELECT *, (1000000 - o_totalprice) / 1000000 AS gap, lag((1000000 - o_totalprice) / 1000000) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders)
SELECT violation, count(*) AS n FROM (SELECT CASE WHEN o_orderkey = 0 THEN 'invalid_listing_id' WHEN o_orderkey % 13 = 0 THEN 'unsafe_url' WHEN o_orderkey % 9 = 0 THEN 'invalid_values' WHEN gap < 0.15 OR o_orderkey % 10 = 0 THEN 'invalid_gap' WHEN gap > before + 1e-9 THEN 'increasing_gap' ELSE 'none' END AS violation FROM o) GROUP BY 1""")
def feed_contract(s, d):
    k, asked = c("o_orderkey"), c("o_totalprice")
    offered = t(s, d, "orders").select(
        "o_custkey", k.alias("position"), F.lit("a").alias("source"), k.cast("string").alias("listing_id"), F.lit(None).cast("string").alias("district"),
        F.concat(F.lit("https://a.example.com/"), F.when(k % 13 == 0, "?").otherwise("x")).alias("url"),
        asked.alias("price_pln"), F.lit(50.0).alias("area_m2"), F.when(k % 9 == 0, 21).otherwise(2).alias("rooms"), F.lit(1e6).alias("predicted_price_pln"),
        ((1e6 - asked) / 1e6 + F.when(k % 10 == 0, 0.01).otherwise(0.0)).alias("model_gap_fraction"), (1e6 - asked).alias("model_gap_pln"), F.lit("2001-08-01T00:00:00Z").alias("observed_at"),
    )
    broken = feed.violations(offered, "o_custkey", F.to_timestamp(F.lit("2001-08-02T00:00:00Z")), {"a": "a.example.com"}, most=1000)
    return broken.groupBy(F.coalesce("violation", F.lit("none")).alias("violation")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, c_custkey % 3 AS model, coalesce(f, -1) AS feed FROM customer LEFT JOIN
(SELECT c_custkey AS k, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS f FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 = c_custkey % 3 AND o_orderdate > TIMESTAMP '1996-01-01' GROUP BY 1) ON k = c_custkey""")
def feed_compare_and_set(s, d):
    state = t(s, d, "customer").select("c_custkey", (c("c_custkey") % 3).alias("model"), F.lit(-1).cast("long").alias("feed"), F.lit("1996-01-01").cast("timestamp_ntz").alias("captured"))
    sent = t(s, d, "orders").select(c("o_custkey").alias("c_custkey"), (c("o_orderkey") % 3).alias("model"), c("o_orderkey").alias("feed"), c("o_orderdate").alias("captured"))
    return feed.feeds_taken(state, sent, ["c_custkey"]).select("c_custkey", "model", "feed")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 7 ELSE c_custkey % 3 END AS model, CASE WHEN c_custkey % 2 = 1 THEN c_name END AS feed FROM customer")
def model_clears_feed(s, d):
    state = t(s, d, "customer").select("c_custkey", (c("c_custkey") % 3).alias("model"), c("c_name").alias("feed"), F.lit(1).alias("captured"))
    return feed.models_taken(state, state.where("c_custkey % 2 = 0").select("c_custkey", F.lit(7).cast("long").alias("model")), ["c_custkey"]).select("c_custkey", "model", "feed")


@query("SELECT o_custkey, count(DISTINCT o_orderpriority) AS parts FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def artifact_overlap(s, d):
    return feed.overlapping(t(s, d, "orders"), ["o_custkey"], "o_orderpriority")


@query("WITH n AS (SELECT DISTINCT p_brand AS scope FROM part) SELECT a.scope, b.scope AS inner_scope FROM n a JOIN n b ON starts_with(b.scope, a.scope) AND a.scope <> b.scope")
def scope_prefix_overlap(s, d):
    return rows.nested_prefixes(t(s, d, "part"), "p_brand")


@query("SELECT o_orderkey, greatest(o_orderdate, max(l_shipdate)) AS clock FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderdate")
def status_clock(s, d):
    shipped = t(s, d, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("at"))
    return t(s, d, "orders").join(shipped, "o_orderkey", "left").select("o_orderkey", F.greatest("o_orderdate", "at").alias("clock"))


@query("SELECT s.status, count(o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) s(status) LEFT JOIN orders ON o_orderstatus = s.status GROUP BY 1")
def domain_counts(s, d):
    return rows.domain_counts(t(s, d, "orders"), "o_orderstatus", ["F", "O", "P", "X"]).withColumnRenamed("o_orderstatus", "status")


@query("SELECT p_name, count(DISTINCT p_partkey) AS ids FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def url_identity_conflicts(s, d):
    return t(s, d, "part").groupBy("p_name").agg(F.count_distinct("p_partkey").alias("ids")).where("ids > 1")


@query("SELECT a.l_orderkey, a.l_linenumber FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber WHERE (a.l_quantity, a.l_returnflag) IS DISTINCT FROM (CASE WHEN b.l_partkey % 7 = 0 THEN NULL ELSE b.l_quantity END, b.l_returnflag)")
def same_time_payload(s, d):
    stored = t(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_partkey")
    arriving = stored.withColumn("l_quantity", F.when(c("l_partkey") % 7 != 0, c("l_quantity")))
    return rows.changed(stored, arriving, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_returnflag"])


@query("SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS spread, min(l_extendedprice) AS least, max(l_extendedprice) AS most FROM lineitem")
def describe_prices(s, d):
    return t(s, d, "lineitem").agg(F.count("l_extendedprice").alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("mean"), F.round(F.stddev_samp("l_extendedprice"), 4).alias("spread"), F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most"))


@query("""SELECT s_suppkey, round(CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal WHEN s_suppkey % 3 > 0 THEN
 2*6371.0088*asin(sqrt(greatest(0.0, least(1.0, pow(sin((radians(s_suppkey % 90)-radians(52.2297))/2),2)+cos(radians(s_suppkey % 90))*cos(radians(52.2297))*pow(sin((radians(21.0)-radians(21.0122))/2),2))))) END, 6) AS km FROM supplier""")
def distance_backfill(s, d):
    k = c("s_suppkey")
    km = F.coalesce(F.when(k % 2 == 0, c("s_acctbal")), v.haversine_km(F.when(k % 3 > 0, (k % 90).cast("double")), F.lit(21.0)))
    return t(s, d, "supplier").select("s_suppkey", F.round(km, 6).alias("km"))


@query("SELECT DISTINCT o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS known, count(*) OVER (PARTITION BY o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS n FROM orders")
def known_and_new(s, d):
    there = t(s, d, "customer").where("c_acctbal > 0").select(c("c_custkey").alias("o_custkey"), F.lit(True).alias("known"))
    return t(s, d, "orders").join(there, "o_custkey", "left").groupBy(c("known").isNotNull().alias("known")).agg(F.count("*").alias("n"))
