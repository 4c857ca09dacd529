"""Queries over the driver's tables, each with DuckDB SQL that says the same.

``orders`` plays the observation history (key o_custkey, time o_orderdate, price o_totalprice),
``lineitem`` two sources (by l_linestatus; block l_suppkey and l_linenumber, area l_quantity,
price l_extendedprice), ``customer`` and ``part`` the catalogues, ``events`` the stream.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import values as v
from tidemark.operators import feed, inventory, match, quality, rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
c = F.col


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query("SELECT c_custkey, lower(trim(c_mktsegment)) AS segment, CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN c_acctbal END AS balance FROM customer WHERE lower(trim(c_mktsegment)) IN ('building','machinery') AND c_acctbal > 0 AND c_nationkey > 0")
def clean_valid_filter(s, d):
    seg = v.collapsed(c("c_mktsegment"))
    return t(s, d, "customer").where(seg.isin("building", "machinery") & v.positive(c("c_acctbal")) & v.whole(c("c_nationkey")).isNotNull()).select("c_custkey", seg.alias("segment"), F.when(c("c_acctbal").between(0, 5000), c("c_acctbal")).alias("balance"))


FIRST = "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate {0}, o_orderkey {0}) = 1"


@query(FIRST.format("ASC"))
def dedup_earliest(s, d):
    return rows.keep_one(t(s, d, "orders"), ["o_custkey"], [c("o_orderdate"), c("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(FIRST.format("DESC"))
def dedup_latest(s, d):
    return rows.keep_one(t(s, d, "orders"), ["o_custkey"], [c("o_orderdate").desc(), c("o_orderkey").desc()]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey)")
def latest_with_ties(s, d):
    return rows.latest_with_ties(t(s, d, "orders"), ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT o_custkey, bool_or(o_totalprice < 2000) AS poisoned, count(*) AS n FROM orders GROUP BY 1")
def poisoned_identities(s, d):
    return rows.poisoned(t(s, d, "orders"), ["o_custkey"], c("o_totalprice") < 2000)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_quantity, 0) AS unit_price FROM lineitem")
def price_per_unit(s, d):
    return t(s, d, "lineitem").select("l_orderkey", "l_linenumber", v.ratio(c("l_extendedprice"), c("l_quantity")).alias("unit_price"))


@query("""SELECT s_suppkey, round(2*6371.0088*asin(sqrt(greatest(0.0, least(1.0, pow(sin((radians(lat)-radians(52.2297))/2),2)+cos(radians(lat))*cos(radians(52.2297))*pow(sin((radians(lon)-radians(21.0122))/2),2))))), 6) AS km
FROM (SELECT s_suppkey, s_suppkey % 90 * 1.0 AS lat, s_acctbal / 100 AS lon FROM supplier)""")
def haversine(s, d):
    return t(s, d, "supplier").select("s_suppkey", F.round(v.haversine_km((c("s_suppkey") % 90).cast("double"), c("s_acctbal") / 100), 6).alias("km"))


@query("""WITH l AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
j AS (SELECT o_custkey, o_orderkey, o_totalprice AS asked, c_mktsegment FROM l JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 0),
m AS (SELECT c_mktsegment, median(asked) AS predicted FROM j GROUP BY 1)
SELECT o_custkey, o_orderkey, round((predicted - asked) / predicted, 9) AS gap FROM j JOIN m USING (c_mktsegment) WHERE (predicted - asked) / predicted >= 0.15 ORDER BY (predicted - asked) / predicted DESC, o_custkey LIMIT 50""")
def rank_topk_gap(s, d):
    latest = rows.keep_one(t(s, d, "orders"), ["o_custkey"], [c("o_orderdate").desc(), c("o_orderkey").desc()])
    joined = latest.join(t(s, d, "customer"), c("o_custkey") == c("c_custkey")).where(v.positive(c("o_totalprice")))
    fitted = quality.quantiles(joined, "o_totalprice", [0.5], ["c_mktsegment"]).select("c_mktsegment", c("q0").alias("predicted"))
    scored = joined.join(fitted, "c_mktsegment").withColumn("g", v.gap(c("predicted"), c("o_totalprice"))).where("g >= 0.15")
    return scored.orderBy(c("g").desc(), "o_custkey").limit(50).select("o_custkey", "o_orderkey", F.round("g", 9).alias("gap"))


@query("SELECT o_orderkey, age, CASE WHEN age < 0 THEN 'future' WHEN age > 7 THEN 'stale' ELSE 'fresh' END AS freshness FROM (SELECT o_orderkey, epoch(now_ - o_orderdate) / 86400.0 AS age FROM orders, (SELECT max(o_orderdate) - INTERVAL 2 DAY AS now_ FROM orders))")
def freshness_filter(s, d):
    o = t(s, d, "orders")
    now = o.agg((F.max("o_orderdate") - F.expr("INTERVAL 2 DAYS")).alias("now_"))
    micros = lambda x: F.unix_micros(c(x).cast("timestamp"))
    age = (micros("now_") - micros("o_orderdate")) / 86400e6
    return o.join(F.broadcast(now)).select("o_orderkey", age.alias("age")).withColumn("freshness", F.when(c("age") < 0, "future").when(c("age") > 7, "stale").otherwise("fresh"))


RAW = """SELECT l_orderkey, l_linenumber, l_linestatus, CASE WHEN l_orderkey % 23 = 0 THEN ' ' ELSE l_linestatus END AS source,
 CASE WHEN l_orderkey % 29 = 0 THEN NULL WHEN l_orderkey % 4 = 0 THEN CAST(l_partkey AS VARCHAR) ELSE l_orderkey || '-' || l_linenumber END AS listing_id,
 CASE l_suppkey % 20 WHEN 0 THEN 'Other' WHEN 1 THEN NULL WHEN 2 THEN ' WARSAW ' ELSE 'Warszawa' END AS city,
 CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN '-1' WHEN l_orderkey % 31 = 0 THEN 'abc' ELSE CAST(l_extendedprice AS VARCHAR) END AS price_pln,
 CASE WHEN l_orderkey % 17 = 0 THEN '' WHEN l_orderkey % 37 = 0 THEN 'inf' ELSE CAST(l_quantity AS VARCHAR) END AS area_m2,
 CASE WHEN l_orderkey % 19 = 0 THEN '1.5' WHEN l_orderkey % 47 = 0 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS rooms,
 CASE WHEN l_orderkey % 6 = 0 THEN '5' WHEN l_orderkey % 7 = 0 THEN '0' WHEN l_orderkey % 8 = 0 THEN '1' END AS rooms_min,
 CASE WHEN l_orderkey % 9 = 0 THEN '-1' WHEN l_orderkey % 10 = 0 THEN '2.5' END AS floor,
 CASE WHEN l_orderkey % 12 = 0 THEN '0' WHEN l_orderkey % 14 = 0 THEN '1999' END AS build_year,
 CAST(l_orderkey % 200 - 100 AS VARCHAR) AS latitude, CAST(l_orderkey % 400 - 200 AS VARCHAR) AS longitude, CAST(l_suppkey - 3 AS VARCHAR) AS distance_km,
 CASE WHEN l_linenumber % 2 = 0 THEN 'Wola' ELSE ' wola ' END AS district, 'u' || CAST(l_partkey % 3 AS VARCHAR) AS url,
 CASE WHEN l_orderkey % 41 = 0 THEN 'someday' WHEN l_orderkey % 43 = 0 THEN strftime(l_shipdate, '%Y-%m-01T00:00:00') ELSE strftime(l_shipdate, '%Y-%m-01T00:00:00Z') END AS observed_at FROM lineitem"""
#: Review bounds that rows of lineitem lie on both sides of.
BOUNDS = quality.Thresholds((10000, 90000), (5, 45), (1000, 1900))
_NUM = "CASE WHEN isfinite(try_cast({0} AS DOUBLE)) THEN try_cast({0} AS DOUBLE) END AS n_{0}"
FLAGGED = f"""WITH r AS ({RAW}), x AS (SELECT *, {', '.join(_NUM.format(n.field) for n in quality.NUMBERS)},
 trim(source) AS s, coalesce(listing_id, '') AS i, try_cast(rtrim(observed_at, 'Z') AS TIMESTAMP) AS instant FROM r),
y AS (SELECT *, CASE WHEN n_price_pln > 0 AND n_area_m2 > 0 THEN n_price_pln / n_area_m2 END AS ratio, s <> '' AND i <> '' AS known,
 row(coalesce(CAST(n_price_pln AS VARCHAR), 'invalid:' || price_pln, ''), coalesce(CAST(n_area_m2 AS VARCHAR), nullif('invalid:' || area_m2, 'invalid:'), ''), coalesce(CAST(n_rooms AS VARCHAR), ''), lower(trim(district)), url) AS payload FROM x),
z AS (SELECT *, count(*) OVER (PARTITION BY s, i) > 1 AS again, min(payload) OVER m <> max(payload) OVER m AS differ FROM y WINDOW m AS (PARTITION BY s, i, instant)),
f AS (SELECT *, list_sort(list_filter([
 CASE WHEN s = '' THEN 'invalid_source' END, CASE WHEN i = '' THEN 'invalid_listing_id' END, CASE WHEN coalesce(lower(trim(city)), '') NOT IN ('warsaw', 'warszawa') THEN 'not_warsaw' END,
 CASE WHEN price_pln IS NULL THEN 'missing_price' WHEN coalesce(n_price_pln, 0) <= 0 THEN 'invalid_price' END, CASE WHEN area_m2 = '' THEN 'missing_area' WHEN coalesce(n_area_m2, 0) <= 0 THEN 'invalid_area' END,
 CASE WHEN rooms IS NULL THEN 'missing_exact_rooms' WHEN rooms = '1.5' THEN 'invalid_rooms' END, CASE WHEN rooms_min = '0' THEN 'invalid_rooms_min' END, CASE WHEN n_rooms > 0 AND n_rooms_min > 0 AND n_rooms < n_rooms_min THEN 'rooms_below_minimum' END,
 CASE WHEN floor = '2.5' THEN 'invalid_floor' END, CASE WHEN build_year = '0' THEN 'invalid_build_year' END, CASE WHEN n_latitude NOT BETWEEN -90 AND 90 THEN 'invalid_latitude' END, CASE WHEN n_longitude NOT BETWEEN -180 AND 180 THEN 'invalid_longitude' END,
 CASE WHEN n_distance_km < 0 THEN 'invalid_distance_km' END, CASE WHEN instant IS NULL THEN 'invalid_observed_at' WHEN NOT ends_with(observed_at, 'Z') THEN 'unverified_timestamp_timezone' END,
 CASE WHEN n_price_pln > 0 AND n_price_pln < 10000 THEN 'price_below_review_min' END, CASE WHEN n_price_pln > 90000 THEN 'price_above_review_max' END, CASE WHEN n_area_m2 > 0 AND n_area_m2 < 5 THEN 'area_below_review_min' END, CASE WHEN n_area_m2 > 45 THEN 'area_above_review_max' END,
 CASE WHEN ratio < 1000 THEN 'price_per_m2_below_review_min' END, CASE WHEN ratio > 1900 THEN 'price_per_m2_above_review_max' END,
 CASE WHEN known AND again THEN 'repeated_identity' END, CASE WHEN known AND instant IS NOT NULL AND differ THEN 'conflicting_identity_timestamp' END], lambda x : x IS NOT NULL)) AS flags FROM z)
SELECT l_orderkey, l_linenumber, array_to_string(flags, '|') AS quality_flags, CASE WHEN len(list_filter(flags, lambda x : x NOT IN ('missing_price','missing_area','missing_exact_rooms'))) > 0 THEN 'review' WHEN len(flags) > 0 THEN 'incomplete' ELSE 'pass' END AS quality_status, ratio AS audit_price_per_m2 FROM f"""


def _raw(s, d):
    """Rows of lineitem as raw observations, with some of everything that an audit can find."""
    k, text = c("l_orderkey"), lambda x: x.cast("string")
    first = lambda *cases: reduce(lambda done, case: done.when(k % case[0] == 0, case[1]), cases[1:], F.when(k % cases[0][0] == 0, cases[0][1]))
    none, month = F.lit(None).cast("string"), F.date_format("l_shipdate", "yyyy-MM-'01T00:00:00'")
    town = c("l_suppkey") % 20
    return t(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus",
        first((23, F.lit(" "))).otherwise(c("l_linestatus")).alias("source"),
        first((29, none), (4, text(c("l_partkey")))).otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("listing_id"),
        F.when(town == 0, "Other").when(town == 1, none).when(town == 2, " WARSAW ").otherwise("Warszawa").alias("city"),
        first((11, none), (13, F.lit("-1")), (31, F.lit("abc"))).otherwise(text(c("l_extendedprice"))).alias("price_pln"),
        first((17, F.lit("")), (37, F.lit("inf"))).otherwise(text(c("l_quantity"))).alias("area_m2"),
        first((19, F.lit("1.5")), (47, none)).otherwise(text(c("l_linenumber"))).alias("rooms"),
        first((6, F.lit("5")), (7, F.lit("0")), (8, F.lit("1"))).alias("rooms_min"),
        first((9, F.lit("-1")), (10, F.lit("2.5"))).alias("floor"),
        first((12, F.lit("0")), (14, F.lit("1999"))).alias("build_year"),
        text(k % 200 - 100).alias("latitude"), text(k % 400 - 200).alias("longitude"), text(c("l_suppkey") - 3).alias("distance_km"),
        F.when(c("l_linenumber") % 2 == 0, "Wola").otherwise(" wola ").alias("district"), F.concat(F.lit("u"), text(c("l_partkey") % 3)).alias("url"),
        first((41, F.lit("someday")), (43, month)).otherwise(F.concat(month, F.lit("Z"))).alias("observed_at"),
    )


@query(FLAGGED)
def audit_flags(s, d):
    return quality.audit(_raw(s, d), bounds=BOUNDS).select("l_orderkey", "l_linenumber", *quality.ADDED)


@query(f"SELECT quality_status, count(*) AS n FROM ({FLAGGED}) GROUP BY 1")
def audit_status_counts(s, d):
    return quality.status_counts(audit_flags(s, d))


@query(f"SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(quality_flags, '|')) AS flag FROM ({FLAGGED}) WHERE quality_flags <> '') GROUP BY 1")
def audit_flag_counts(s, d):
    return quality.flag_counts(audit_flags(s, d))


@query(f"SELECT count(*) AS identities, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM ({RAW}) WHERE trim(source) <> '' AND listing_id IS NOT NULL GROUP BY source, listing_id)")
def audit_repeats(s, d):
    return quality.repeats(_raw(s, d).where("trim(source) <> '' AND listing_id IS NOT NULL"), ["source", "listing_id"])


@query(f"SELECT l_orderkey, l_linenumber, contains(quality_flags, 'repeated_identity') AS repeated FROM ({FLAGGED})")
def audit_repeated_identity(s, d):
    return audit_flags(s, d).select("l_orderkey", "l_linenumber", c("quality_flags").contains("repeated_identity").alias("repeated"))


@query(f"SELECT l_orderkey, l_linenumber FROM ({FLAGGED}) WHERE contains(quality_flags, 'conflicting_identity_timestamp')")
def audit_conflicts(s, d):
    return audit_flags(s, d).where(c("quality_flags").contains("conflicting_identity_timestamp")).select("l_orderkey", "l_linenumber")


_BLANK = ", ".join(f"sum(CAST(trim(coalesce({n}, '')) = '' AS INT)) AS {n}" for n in quality.REPORTED if n != "published_at")


@query(f"SELECT source, field, CAST(n AS BIGINT) AS n FROM (SELECT source, {_BLANK}, count(*) AS published_at FROM ({RAW}) GROUP BY 1) UNPIVOT (n FOR field IN ({', '.join(quality.REPORTED)}))")
def missing_by_source(s, d):
    return quality.missing_matrix(_raw(s, d))


@query("SELECT count(*) AS n, min(l_extendedprice) AS least, max(l_extendedprice) AS most, round(quantile_cont(l_extendedprice, 0.01), 4) AS p01, round(median(l_extendedprice), 4) AS median, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99 FROM lineitem WHERE l_extendedprice > 0")
def numeric_summary(s, d):
    return quality.summary(t(s, d, "lineitem"), "l_extendedprice")


@query("SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1")
def day_histogram(s, d):
    return t(s, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))


@query("SELECT min(o_orderdate) AS first, max(o_orderdate) AS last, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders")
def observation_range(s, d):
    return t(s, d, "orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"), F.count_distinct(F.to_date("o_orderdate")).alias("days"))


def _pairs(s, d):
    li = t(s, d, "lineitem").select("l_suppkey", "l_linenumber", c("l_orderkey").alias("id"), c("l_quantity").alias("area"), c("l_extendedprice").alias("price"), "l_linestatus")
    side = lambda x: li.where(c("l_linestatus") == x).drop("l_linestatus")
    return match.band_pairs(side("O"), side("F"), ["l_suppkey", "l_linenumber"])


PAIRS = """SELECT a.l_suppkey, a.l_linenumber, a.l_orderkey AS l_id, b.l_orderkey AS r_id, a.l_quantity AS l_area, b.l_quantity AS r_area,
 CASE WHEN NOT (abs(a.l_quantity-b.l_quantity) <= greatest(0.1, 0.005*least(a.l_quantity,b.l_quantity)) OR abs(abs(a.l_quantity-b.l_quantity) - greatest(0.1, 0.005*least(a.l_quantity,b.l_quantity))) <= 1e-12*greatest(abs(a.l_quantity-b.l_quantity), 0.1, 0.005*least(a.l_quantity,b.l_quantity))) THEN 'area'
  WHEN NOT (abs(a.l_extendedprice-b.l_extendedprice) <= 0.01*least(a.l_extendedprice,b.l_extendedprice) OR abs(abs(a.l_extendedprice-b.l_extendedprice) - 0.01*least(a.l_extendedprice,b.l_extendedprice)) <= 1e-12*greatest(abs(a.l_extendedprice-b.l_extendedprice), 0.01*least(a.l_extendedprice,b.l_extendedprice))) THEN 'price' END AS reason
FROM lineitem a JOIN lineitem b ON a.l_suppkey = b.l_suppkey AND a.l_linenumber = b.l_linenumber AND a.l_linestatus = 'O' AND b.l_linestatus = 'F' AND abs(a.l_quantity-b.l_quantity) <= greatest(0.1, 0.005*a.l_quantity) + 1e-9"""


@query(f"SELECT l_suppkey, l_linenumber, l_id, r_id FROM ({PAIRS}) WHERE reason IS NULL")
def band_pairs(s, d):
    return _pairs(s, d).where("reason IS NULL").select("l_suppkey", "l_linenumber", "l_id", "r_id")


@query(f"SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM ({PAIRS}) GROUP BY 1")
def band_pairs_rejections(s, d):
    return _pairs(s, d).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH n AS (SELECT *, row_number() OVER w AS n, coalesce(sum(CAST(reason IS NULL AS INT)) OVER (ORDER BY l_suppkey, l_linenumber, l_area, l_id, r_area, r_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM ({PAIRS}) WINDOW w AS (ORDER BY l_suppkey, l_linenumber, l_area, l_id, r_area, r_id))
SELECT count(*) AS comparisons, CAST(coalesce(sum(CAST(reason IS NULL AS INT)), 0) AS BIGINT) AS accepted FROM n WHERE n <= 5000 AND a < 40""")
def band_pairs_budget(s, d):
    pairs = _pairs(s, d).withColumn("ok", c("reason").isNull())
    seen = match.budgeted(pairs, ["l_suppkey", "l_linenumber", "l_area", "l_id", "r_area", "r_id"], "ok", 40, 5000)
    return seen.agg(F.count("*").alias("comparisons"), F.coalesce(F.sum(c("ok").cast("long")), F.lit(0)).alias("accepted"))


@query("SELECT c_custkey, c_name, coalesce(status, 'untracked') AS status FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE status IS NULL OR status = 'O'")
def current_left_availability(s, d):
    latest = t(s, d, "orders").groupBy(c("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status"))
    joined = t(s, d, "customer").join(latest, "c_custkey", "left").where(c("status").isNull() | (c("status") == "O"))
    return joined.select("c_custkey", "c_name", F.coalesce("status", F.lit("untracked")).alias("status"))


@query("SELECT coalesce(k, r) AS id, coalesce(st, 'missing') AS status, k IS NOT NULL AS was_known FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01') FULL JOIN (SELECT o_custkey AS r, max(o_orderstatus) AS st FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1) ON k = r")
def missing_inference(s, d):
    o = t(s, d, "orders").withColumnRenamed("o_custkey", "id")
    reported = o.where("o_orderdate >= '1997-01-01'").groupBy("id").agg(F.max("o_orderstatus").alias("status"))
    return rows.reconcile(o.where("o_orderdate < '1997-01-01'"), reported, ["id"])


@query("SELECT p_partkey AS k, 'left' AS side FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity < 3) UNION ALL SELECT DISTINCT l_partkey, 'right' FROM lineitem WHERE l_quantity < 3 AND l_partkey NOT IN (SELECT p_partkey FROM part)")
def completeness_antijoin(s, d):
    return rows.unmatched(t(s, d, "part").select(c("p_partkey").alias("k")), t(s, d, "lineitem").where("l_quantity < 3").select(c("l_partkey").alias("k")), ["k"])


@query("SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY")
def interval_containment_join(s, d):
    o, li = t(s, d, "orders"), t(s, d, "lineitem")
    return o.join(li, (c("o_orderkey") == c("l_orderkey")) & c("l_shipdate").between(c("o_orderdate"), c("o_orderdate") + F.expr("INTERVAL 30 DAYS"))).select("o_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey WHERE abs(CAST(round(l_extendedprice / l_quantity, -1) AS DECIMAL(18,2)) - CAST(round(p_retailprice, -1) AS DECIMAL(18,2))) <= 10.0")
def decimal_tolerance_join(s, d):
    dec = lambda x: x.cast("decimal(18,2)")
    j = t(s, d, "lineitem").join(t(s, d, "part"), c("l_partkey") == c("p_partkey"))
    return j.where(F.abs(dec(F.round(F.try_divide("l_extendedprice", "l_quantity"), -1)) - dec(F.round("p_retailprice", -1))) <= F.lit("10.00").cast("decimal(4,2)")).select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey AS id FROM customer UNION SELECT o_custkey FROM orders")
def known_ids_union(s, d):
    return t(s, d, "customer").select(c("c_custkey").alias("id")).union(t(s, d, "orders").select("o_custkey")).distinct()


@query("SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F'")
def split_overlap_intersect(s, d):
    side = lambda test: t(s, d, "orders").where(test).select(c("o_custkey").alias("id"))
    return side("o_orderstatus = 'F'").intersect(side("o_orderstatus <> 'F'"))


@query(f"SELECT l_orderkey, l_linenumber, len(list_filter(string_split(quality_flags, '|'), lambda x : x NOT IN ('missing_price','missing_area','missing_exact_rooms',''))) AS n FROM ({FLAGGED})")
def flag_set_difference(s, d):
    left = F.array_except(F.split("quality_flags", r"\|"), F.array(*map(F.lit, (*quality.INCOMPLETE, ""))))
    return audit_flags(s, d).select("l_orderkey", "l_linenumber", F.size(left).cast("long").alias("n"))


CUTS = """d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
x AS (SELECT day, row_number() OVER (ORDER BY day) AS i, sum(n) OVER (ORDER BY day) AS cum, sum(n) OVER () AS total, count(*) OVER () AS days FROM d),
a AS (SELECT arg_min(i, (abs(cum - 0.6::DOUBLE * total), i)) AS train_cut FROM x WHERE i <= days - 2),
b AS (SELECT train_cut, arg_min(i, (abs(cum - 0.8::DOUBLE * total), i)) AS val_cut FROM x, a WHERE i > train_cut AND i <= days - 1 GROUP BY 1)"""


@query(f"WITH {CUTS} SELECT CAST(train_cut AS INTEGER) AS train_cut, CAST(val_cut AS INTEGER) AS val_cut FROM b")
def temporal_split(s, d):
    return rows.temporal_cuts(day_histogram(s, d))


@query(f"""WITH {CUTS}, p AS (SELECT o_orderkey, CASE WHEN i <= train_cut THEN 'train' WHEN i <= val_cut THEN 'validation' ELSE 'test' END AS partition FROM orders JOIN x ON CAST(o_orderdate AS DATE) = day, b)
SELECT partition, count(*) AS n, CAST(sum(CAST(CAST('0x' || substr(h, 1, 15) AS UBIGINT) AS HUGEINT)) AS VARCHAR) || '-' || CAST(sum(CAST(CAST('0x' || substr(h, 16, 15) AS UBIGINT) AS HUGEINT)) AS VARCHAR) AS digest
FROM (SELECT partition, sha256('{{"o_orderkey":' || o_orderkey || '}}') AS h FROM p) GROUP BY 1""")
def split_summary(s, d):
    days = day_histogram(s, d)
    numbered = days.withColumn("i", F.row_number().over(Window.orderBy("day"))).join(F.broadcast(rows.temporal_cuts(days)))
    part = F.when(c("i") <= c("train_cut"), "train").when(c("i") <= c("val_cut"), "validation").otherwise("test")
    p = t(s, d, "orders").withColumn("day", F.to_date("o_orderdate")).join(F.broadcast(numbered), "day").withColumn("partition", part)
    return inventory.digests(p, ["partition"], ["o_orderkey"])


METRICS = "round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse, round(1 - sum(pow(y - p, 2)) / sum(pow(y - m, 2)), 6) AS r2"


@query(f"SELECT {METRICS} FROM (SELECT l_extendedprice AS y, l_quantity * 1500 AS p, avg(l_extendedprice) OVER () AS m FROM lineitem)")
def regression_metrics(s, d):
    li = t(s, d, "lineitem")
    mean = li.agg(F.avg("l_extendedprice").alias("m"))
    return li.join(F.broadcast(mean)).selectExpr("l_extendedprice AS y", "l_quantity * 1500 AS p", "m").agg(
        F.round(F.avg(F.abs(c("y") - c("p"))), 4).alias("mae"), F.round(F.sqrt(F.avg(F.pow(c("y") - c("p"), 2))), 4).alias("rmse"), F.round(1 - F.sum(F.pow(c("y") - c("p"), 2)) / F.sum(F.pow(c("y") - c("m"), 2)), 6).alias("r2")
    )


@query("SELECT c_mktsegment, round(avg(abs(o_totalprice - m)), 4) AS mae FROM orders JOIN customer ON o_custkey = c_custkey, (SELECT median(o_totalprice) AS m FROM orders) GROUP BY 1")
def median_baseline(s, d):
    o = t(s, d, "orders")
    m = quality.quantiles(o, "o_totalprice", [0.5]).select(c("q0").alias("m"))
    return o.join(t(s, d, "customer"), c("o_custkey") == c("c_custkey")).join(F.broadcast(m)).groupBy("c_mktsegment").agg(F.round(F.avg(F.abs(c("o_totalprice") - c("m"))), 4).alias("mae"))


LOOKUP = "SELECT o_orderkey, coalesce(part, 'unseen') AS partition FROM orders LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'test' ELSE 'train' END AS part FROM customer WHERE c_custkey % 3 <> 0) ON o_custkey = c_custkey"


@query(LOOKUP)
def partition_lookup(s, d):
    known = t(s, d, "customer").where("c_custkey % 3 <> 0").select(c("c_custkey").alias("o_custkey"), F.when(c("c_custkey") % 4 == 0, "test").otherwise("train").alias("part"))
    return t(s, d, "orders").join(known, "o_custkey", "left").select("o_orderkey", F.coalesce("part", F.lit("unseen")).alias("partition"))


@query(f"SELECT partition, count(*) AS n FROM ({LOOKUP}) GROUP BY 1")
def partition_counts(s, d):
    return partition_lookup(s, d).groupBy("partition").agg(F.count("*").alias("n"))


@query("SELECT l_linestatus, count(*) AS n, count(DISTINCT l_orderkey) AS ids FROM lineitem GROUP BY 1")
def source_counts(s, d):
    return t(s, d, "lineitem").groupBy("l_linestatus").agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("ids"))


@query("SELECT c_mktsegment, median(o_totalprice) AS price, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY n DESC")
def group_median_count(s, d):
    priced = t(s, d, "orders").join(t(s, d, "customer"), c("o_custkey") == c("c_custkey"))
    return quality.quantiles(priced, "o_totalprice", [0.5], ["c_mktsegment"]).select("c_mktsegment", c("q0").alias("price"), "n").orderBy(c("n").desc())


@query("SELECT round(100 * avg(CAST(CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_extendedprice END IS NULL AS INT)), 6) AS price, round(100 * avg(CAST(l_quantity IS NULL AS INT)), 6) AS area FROM lineitem")
def null_percentage(s, d):
    pct = lambda x: F.round(100 * F.avg(x.isNull().cast("int")), 6)
    return t(s, d, "lineitem").agg(pct(F.when(c("l_orderkey") % 11 != 0, c("l_extendedprice"))).alias("price"), pct(c("l_quantity")).alias("area"))


@query("SELECT CAST(floor(l_extendedprice / 5000) AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def price_histogram(s, d):
    return t(s, d, "lineitem").groupBy(F.floor(c("l_extendedprice") / 5000).alias("bin")).agg(F.count("*").alias("n"))


@query("SELECT o_custkey, o_orderdate, o_orderkey FROM (SELECT * FROM orders WHERE o_orderkey % 2 = 1 QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1) b WHERE NOT EXISTS (FROM orders h WHERE h.o_orderkey % 2 = 0 AND h.o_custkey = b.o_custkey AND h.o_orderdate = b.o_orderdate)")
def history_append_first_wins(s, d):
    o = t(s, d, "orders")
    return rows.append_first_wins(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["o_custkey", "o_orderdate"], [c("o_orderkey")]).select("o_custkey", "o_orderdate", "o_orderkey")


UPSERT = "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, w)) AS o_orderkey, min(o_orderdate) AS first_seen, max(o_orderdate) AS last_seen FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(min(o_orderkey) AS BIGINT) AS o_orderkey, {0} AS w FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE), o_orderkey % 2) GROUP BY 1"


def _upserted(s, d, tie):
    o = t(s, d, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), (c("o_orderkey") % 2).alias("half")).agg(F.min("o_orderkey").alias("o_orderkey"))
    return rows.upsert(o.where("half = 0"), o.where("half = 1"), ["o_custkey"], ["o_orderkey"], "o_orderdate", tie)


@query(UPSERT.format("o_orderkey % 2"))
def current_upsert_newer_wins(s, d):
    return _upserted(s, d, "incoming")


@query(UPSERT.format("1 - o_orderkey % 2"))
def current_upsert_strict(s, d):
    return _upserted(s, d, "existing")


@query("SELECT l_partkey, l_orderkey, l_linenumber, count(*) OVER w AS n, count(DISTINCT l_quantity) OVER w > 1 AS conflict FROM lineitem WINDOW w AS (PARTITION BY l_partkey) QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC) = 1")
def last_wins_pages(s, d):
    return rows.last_wins(t(s, d, "lineitem"), ["l_partkey"], ["l_orderkey", "l_linenumber"], ["l_quantity"]).select("l_partkey", "l_orderkey", "l_linenumber", "n", "conflict")


@query("SELECT page, fingerprint, count(*) OVER (PARTITION BY fingerprint) > 1 AS repeated FROM (SELECT o_custkey AS page, sha256(string_agg(o_orderstatus, ',' ORDER BY o_orderstatus)) AS fingerprint FROM orders GROUP BY 1)")
def page_fingerprint_repeat(s, d):
    pages = t(s, d, "orders").groupBy(c("o_custkey").alias("page")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("o_orderstatus")), ","), 256).alias("fingerprint"))
    return pages.withColumn("repeated", F.count("*").over(Window.partitionBy("fingerprint")) > 1)


@query("SELECT l_orderkey, l_linenumber, first_value(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) <> l_suppkey AS drifted FROM lineitem")
def pagination_drift(s, d):
    first = F.first("l_suppkey").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey"))
    return t(s, d, "lineitem").select("l_orderkey", "l_linenumber", (first != c("l_suppkey")).alias("drifted"))


@query("""SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) ||
 coalesce('?' || nullif(array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&'), lambda p : NOT starts_with(p, 'utm_') AND split_part(p, '=', 1) NOT IN ('fbclid','gclid','msclkid','dclid','yclid') AND p <> ''), '&'), ''), '') AS url FROM pages""")
def url_canonical(s, d):
    return t(s, d, "pages").select("page_id", v.canonical_url(c("url")).alias("url"))


@query("SELECT lower(regexp_extract(url, '://([^/?#:@]+)', 1)) AS host, count(*) AS n FROM pages GROUP BY 1")
def url_host_counts(s, d):
    return t(s, d, "pages").groupBy(v.url_host(c("url")).alias("host")).agg(F.count("*").alias("n"))


@query("SELECT page_id FROM pages WHERE regexp_matches(url, '^https://([a-z0-9-]+[.])*example[.]com/[^ ?#@]*$')")
def url_safe_filter(s, d):
    return t(s, d, "pages").where(v.safe_url(c("url"), "example.com")).select("page_id")


@query("SELECT p_partkey, lower(trim(regexp_replace('  ' || p_name || chr(9) || ' ' || p_type, '\\s+', ' ', 'g'))) AS name FROM part")
def text_normal_form(s, d):
    return t(s, d, "part").select("p_partkey", v.collapsed(F.concat(F.lit("  "), "p_name", F.lit("\t "), "p_type")).alias("name"))


@query("SELECT page_id, 'url_' || substr(sha256(url), 1, 24) AS id FROM pages")
def id_hash_fallback(s, d):
    return t(s, d, "pages").select("page_id", v.url_id(c("url")).alias("id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS DOUBLE) + 0.5 END AS value FROM orders")
def number_parse(s, d):
    whole = F.format_string("%d", F.floor("o_totalprice"))
    text = F.when(c("o_orderkey") % 5 == 0, F.lit("1,2,3")).when(c("o_orderkey") % 5 == 1, F.concat(whole, F.lit(",5 zł"))).when(c("o_orderkey") % 5 == 2, F.concat(F.lit(" "), whole, F.lit(".5"))).otherwise(F.concat(whole, F.lit(" ,50 m²")))
    return t(s, d, "orders").select("o_orderkey", v.locale_number(text).alias("value"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN false WHEN o_orderstatus = 'O' THEN true END AS flag FROM orders")
def tri_state_boolean(s, d):
    text = F.when(c("o_orderstatus") == "F", " FALSE").when(c("o_orderstatus") == "O", "True").otherwise(c("o_orderstatus"))
    return t(s, d, "orders").select("o_orderkey", v.tri_state(text).alias("flag"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority LIKE '%HIGH%' AND o_totalprice BETWEEN 1000 AND 200000 ORDER BY o_totalprice, o_orderkey LIMIT 9 OFFSET 9")
def dashboard_filter_sort(s, d):
    found = t(s, d, "orders").where(c("o_orderpriority").contains("HIGH") & c("o_totalprice").between(1000, 200000))
    return found.orderBy("o_totalprice", "o_orderkey").offset(9).limit(9).select("o_orderkey", "o_totalprice")


@query("SELECT count(*) AS kept FROM events, (SELECT max(ts) AS now_ FROM events) WHERE now_ - ts <= INTERVAL 7 DAY")
def feed_expiry(s, d):
    e = t(s, d, "events").withColumn("ts", c("ts").cast("timestamp"))
    now = F.lit(e.agg(F.max("ts")).first()[0])
    return feed.fresh(e, c("ts"), now, now).agg(F.count("*").alias("kept"))


@query("SELECT user_id, count(*) AS rises FROM (SELECT user_id, value > lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS up FROM events) WHERE up GROUP BY 1")
def feed_order_check(s, d):
    before = F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return t(s, d, "events").withColumn("up", c("value") > before).where("up").groupBy("user_id").agg(F.count("*").alias("rises"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events")
def json_prop_extract(s, d):
    return t(s, d, "events").select("event_id", F.expr("try_variant_get(try_parse_json(props), '$.k', 'double')").alias("k"))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM events GROUP BY 1")
def stream_history_fold(s, d):
    from tidemark.streaming import fold

    return fold.folded(s, f"{d}/events.parquet")


@query("""WITH h AS (SELECT page_id, regexp_extract(url, '^[A-Za-z]+://[^/?#]*') AS o, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS l FROM pages), u AS (SELECT page_id, o, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM h)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS position, link, false AS is_next FROM (SELECT page_id, o || x AS link, min(i) AS i FROM u GROUP BY 1, 2)""")
def link_extract(s, d):
    from tidemark.sources import pages

    return pages.links(t(s, d, "pages"))


def _scored_orders(s, d):
    """Orders as scored observations of their customers' years, with some of everything that excludes an identity."""
    k, o = c("o_custkey"), c("o_orderkey")
    year = F.date_trunc("year", "o_orderdate") + F.when(k % 43 == 0, F.expr("INTERVAL 1 YEAR")).otherwise(F.expr("INTERVAL 0 YEAR"))
    slug = F.when(k % 17 == 0, "udzial-1-2-w-mieszkaniu-").otherwise("mieszkanie-")
    return t(s, d, "orders").select(
        F.lit("a.example.com").alias("source"),
        k.cast("string").alias("listing_id"),
        F.concat(F.when(k % 7 == 0, "http").otherwise("https"), F.lit("://a.example.com/"), slug, k.cast("string")).alias("url"),
        F.lit("Warszawa").alias("city"),
        F.lit(2).alias("rooms"),
        F.when(k % 19 == 0, o % 2).alias("floor"),
        F.when(k % 5 == 0, F.round("o_totalprice") + 150_000).otherwise(170_000.0 + k % 97 * 1500).alias("price_pln"),
        F.when(k % 11 == 0, 5.0).otherwise(50.0).alias("area_m2"),
        F.concat(F.date_format(year, "yyyy-MM-dd'T'HH:mm:ss"), F.when((k % 13 == 0) & (o % 4 == 0), "").otherwise("Z")).alias("observed_at"),
        F.when(k % 31 == 0, -1.0).otherwise(300_000.0 + F.when(k % 37 == 0, o % 2 * 1000).otherwise(0)).alias("predicted_price_pln"),
        F.when(k % 3 == 0, "false").otherwise("true").alias("is_deal"),
        F.when(k % 41 == 0, "true").otherwise("false").alias("seen_in_training"),
        F.when(k % 23 == 0, "other").when((k % 29 == 0) | (k % 41 == 0), "train").otherwise("test").alias("partition"),
    )


#: The stages in the order in which a listing is asked for them, each over all rows of its latest time.
JUDGED = """WITH r AS (SELECT o_custkey AS k, o_orderkey AS o, date_trunc('year', o_orderdate) + CASE WHEN o_custkey % 43 = 0 THEN INTERVAL 1 YEAR ELSE INTERVAL 0 YEAR END AS at_, o_custkey % 13 = 0 AND o_orderkey % 4 = 0 AS naive,
 CASE WHEN o_custkey % 5 = 0 THEN round(o_totalprice) + 150000 ELSE 170000.0 + o_custkey % 97 * 1500 END AS price, 300000.0 + CASE WHEN o_custkey % 37 = 0 THEN o_orderkey % 2 * 1000 ELSE 0 END AS predicted FROM orders WHERE o_custkey > 0),
w AS (SELECT *, bool_or(naive) OVER i AS spoilt, max(CASE WHEN NOT naive THEN at_ END) OVER i AS last_ FROM r WINDOW i AS (PARTITION BY k)),
l AS (SELECT k, bool_or(spoilt) AS spoilt, max(last_) AS last_, count(DISTINCT price) > 1 AS differ, k % 19 = 0 AND count(DISTINCT o % 2) > 1 AS mixed, count(DISTINCT predicted) > 1 AS scores, min(price) AS price, min(predicted) AS predicted, min((predicted - price) / predicted) AS gap FROM w WHERE spoilt OR at_ = last_ GROUP BY k),
j AS (SELECT k, price, predicted, gap, CASE
 WHEN spoilt THEN 'unorderable_observation_time'
 WHEN last_ > TIMESTAMP '2001-08-01' THEN 'future_observation'
 WHEN epoch(TIMESTAMP '2001-08-01' - last_) / 86400.0 > 600 THEN 'stale_observation'
 WHEN differ THEN 'conflicting_latest_observation'
 WHEN k % 11 = 0 THEN 'quality_not_pass'
 WHEN mixed THEN 'conflicting_latest_property_features'
 WHEN k % 7 = 0 THEN 'unsafe_or_noncanonical_url'
 WHEN k % 17 = 0 THEN 'nonstandard_rights_indicated'
 WHEN k % 23 = 0 THEN 'unknown_scoring_provenance'
 WHEN k % 29 = 0 AND k % 41 > 0 THEN 'contradictory_scoring_provenance'
 WHEN k % 31 = 0 THEN 'invalid_model_prediction'
 WHEN scores THEN 'conflicting_latest_score'
 WHEN k % 41 = 0 THEN 'seen_in_training'
 WHEN k % 3 = 0 THEN 'not_explicitly_flagged_as_deal'
 WHEN NOT (gap >= 0.15 OR abs(0.15 - gap) <= 1e-12 * greatest(0.15, abs(gap))) THEN 'below_discount_threshold' END AS reason FROM l)"""


def _judged(s, d):
    from tidemark.operators import selection

    return selection.judged(_scored_orders(s, d), F.to_timestamp(F.lit("2001-08-01T00:00:00Z")), max_age_days=600, hosts={"a.example.com": "a.example.com"})


@query(f"{JUDGED} SELECT coalesce(reason, 'eligible') AS reason, count(*) AS n FROM j GROUP BY 1")
def selection_exclusions(s, d):
    from tidemark.operators import selection

    return selection.exclusions(_judged(s, d))


@query(f"{JUDGED} SELECT CAST(k AS VARCHAR) AS listing_id, round(gap, 9) AS gap FROM j WHERE reason IS NULL ORDER BY gap DESC, CAST(k AS VARCHAR) LIMIT 50")
def selection_ranked(s, d):
    from tidemark.operators import selection

    return selection.ranked(_judged(s, d)).select("listing_id", F.round("gap", 9).alias("gap"))


@query("""WITH k AS (SELECT o_custkey AS k, max(o_orderdate) AS seen FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
r AS (SELECT o_custkey AS k, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT coalesce(k.k, r.k) AS o_custkey, coalesce(r.status, 'missing') AS status, CASE WHEN r.k IS NULL THEN CAST(seen AS DATE) ELSE DATE '1998-09-01' END AS last_seen FROM k FULL OUTER JOIN r ON k.k = r.k""")
def inventory_settled(s, d):
    from tidemark.operators import inventory

    o, cut = t(s, d, "orders"), F.lit("1998-01-01").cast("date")
    known = o.where(c("o_orderdate") < cut).groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_seen_at"))
    reported = o.where(c("o_orderdate") >= cut).groupBy("o_custkey").agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status"))
    out = inventory.settled(known, reported, ["o_custkey"], F.lit("1998-09-01").cast("date"))
    return out.select("o_custkey", "status", c("last_seen_at").cast("date").alias("last_seen"))


@query("""WITH h AS (SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS o, min(o_orderdate) + INTERVAL 90 DAY AS u FROM orders GROUP BY 1),
w AS (SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderpriority)) AS o, min(o_orderdate) + INTERVAL 90 DAY AS u FROM orders JOIN h USING (o_custkey) WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND (o_orderpriority = h.o OR h.u <= o_orderdate) GROUP BY 1)
SELECT o_custkey, coalesce(w.o, h.o) AS owner, CAST(coalesce(w.u, h.u) AS DATE) AS until FROM h LEFT JOIN w USING (o_custkey)""")
def lease_claims(s, d):
    from tidemark.operators import inventory

    o, k = t(s, d, "orders"), ["o_custkey"]
    held = o.groupBy(*k).agg(F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("owner"), (F.min("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("until"))
    asked = o.where(c("o_orderdate") >= F.lit("1995-01-01").cast("date")).select(*k, c("o_orderpriority").alias("owner"), c("o_orderdate").alias("at"))
    return inventory.claimed(held, asked, k, "INTERVAL 90 DAYS").select(*k, "owner", c("until").cast("date").alias("until"))


@query("""SELECT o_orderkey AS page_id, CASE o_orderkey % 3 WHEN 0 THEN 'assigned' WHEN 1 THEN 'scripted' ELSE 'streamed' END AS carrier,
 CASE WHEN o_orderkey % 3 < 2 THEN '{"a": ' || o_orderkey || ', "b": "' || o_orderpriority || '"}' ELSE '{"1": {"a": ' || o_orderkey || ', "b": "' || o_orderpriority || '"}}' END AS state FROM orders WHERE o_orderkey % 7 > 0""")
def embedded_states(s, d):
    from tidemark.sources import state

    k = c("o_orderkey")
    whole = F.to_json(F.struct(c("o_orderpriority").alias("b"), k.alias("a")))
    quoted = F.replace(whole, F.lit('"'), F.lit('\\"'))
    html = F.when(k % 7 == 0, F.lit("<p>none</p>")).when(k % 3 == 0, F.concat(F.lit('<script>window.__PRERENDERED_STATE__ = "'), quoted, F.lit('";</script>'))).when(k % 3 == 1, F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), whole, F.lit("</script>")))
    html = html.otherwise(F.concat(F.lit('<script>self.__next_f.push([1,"1:'), F.substr(quoted, F.lit(1), F.lit(6)), F.lit('"])</script><script>self.__next_f.push([1,"'), F.substr(quoted, F.lit(7)), F.lit('\\n2:I[1]"])</script>')))
    made = t(s, d, "orders").select(k.cast("long").alias("page_id"), html.alias("html"))
    return state.states(made).where("state IS NOT NULL").drop("reason")
