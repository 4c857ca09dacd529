"""Queries on whole pipelines and on the tables they keep: cleaning, snapshots, pairs, splits, models, rankings, merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import work
from tidemark.functions import values as v
from tidemark.operators import artifact, contracts, feed, inventory, match, model, prepare, selection, store
from tidemark.plans.catalogue import FLAGGED, RAW, _raw, audit_flags, c, query, t
from tidemark.sources import collect, files, tables, udtf
from tidemark.streaming import captures, inventories

HOSTS = {"a.example": "a.example", "b.example": "b.example"}


@query(f"""SELECT trim(source) AS source, listing_id, min(at_) AS observed_at FROM (SELECT *, try_cast(rtrim(observed_at, 'Z') AS TIMESTAMP) AS at_ FROM ({RAW}))
WHERE lower(trim(city)) IN ('warsaw', 'warszawa') AND trim(source) <> '' AND listing_id IS NOT NULL AND at_ IS NOT NULL AND isfinite(try_cast(price_pln AS DOUBLE)) AND try_cast(price_pln AS DOUBLE) > 0
 AND isfinite(try_cast(area_m2 AS DOUBLE)) AND try_cast(area_m2 AS DOUBLE) > 0 AND rooms <> '1.5' AND l_orderkey % 3 > 0 GROUP BY 1, 2""")
def clean_listings(s, d):
    sale = F.when(c("l_orderkey") % 3 == 0, "rent").when(c("l_orderkey") % 3 == 1, " Sale").otherwise("sprzedaż")
    return prepare.clean(_raw(s, d).withColumn("transaction_type", sale), "earliest").select("source", "listing_id", c("observed_at").cast("timestamp_ntz").alias("observed_at"))


def _observations(s, d):
    """Orders as observations of their customers by two sources, with some of everything that excludes a snapshot."""
    k, o = c("o_custkey"), c("o_orderkey")
    source = F.when(o % 2 == 0, "a.example").otherwise("b.example")
    at = F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss")
    return t(s, d, "orders").select(
        source.alias("source"), k.cast("string").alias("listing_id"), F.concat(F.lit("https://"), source, F.when(k % 13 == 0, "/x?").otherwise("/x")).alias("url"), F.lit("Warszawa").alias("city"), F.concat(F.lit("D"), k % 3).alias("district"),
        (F.round("o_totalprice") + 150_000).alias("price_pln"), F.when(k % 17 == 0, 5.0).otherwise(50.0).alias("area_m2"), F.lit(2).alias("rooms"), F.when((k % 19 == 0) & (o % 4 < 2), 1).alias("floor"),
        F.concat(at, F.when((k % 11 == 0) & (o % 8 == 0), "").otherwise("Z")).alias("observed_at"),
    )


SNAPSHOTS = """WITH o AS (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS src, date_trunc('month', o_orderdate) AS at_, round(o_totalprice) + 150000 AS price, o_custkey % 11 = 0 AND o_orderkey % 8 = 0 AS naive, CASE WHEN o_custkey % 19 = 0 AND o_orderkey % 4 < 2 THEN 1 END AS floor FROM orders WHERE o_custkey > 0),
w AS (SELECT *, bool_or(naive) OVER i AS spoilt, max(CASE WHEN NOT naive THEN at_ END) OVER i AS chosen FROM o WINDOW i AS (PARTITION BY src, o_custkey)),
g AS (SELECT src, o_custkey AS k, bool_or(spoilt) AS spoilt, max(chosen) AS chosen, count(DISTINCT price) > 1 AS differ, count(DISTINCT row(floor)) > 1 AS mixed, max(price) AS price FROM w WHERE spoilt OR at_ = chosen GROUP BY ALL),
e AS (SELECT *, CASE WHEN spoilt THEN 'unorderable_observation_time' WHEN epoch(TIMESTAMP '1998-01-01' - chosen) < 0 THEN 'future_observation' WHEN epoch(TIMESTAMP '1998-01-01' - chosen) / 86400 > 900 THEN 'stale_current_catalogue' WHEN differ THEN 'conflicting_selected_snapshot'
 WHEN mixed THEN 'conflicting_optional_model_features' WHEN k % 17 = 0 THEN 'quality_not_pass' WHEN k % 13 = 0 THEN 'invalid_portal_offer_url' END AS reason FROM g)"""


@query(f"{SNAPSHOTS} SELECT coalesce(reason, 'retained') AS reason, count(*) AS n FROM e GROUP BY 1")
def snapshot_exclusions(s, d):
    chosen = prepare.snapshots(_observations(s, d), F.to_timestamp(F.lit("1998-01-01T00:00:00Z")), keep="latest", hosts=HOSTS, max_age_days=900)
    return chosen.groupBy(F.coalesce("exclusion_reason", F.lit("retained")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"{SNAPSHOTS} SELECT src || '.example' AS source, CAST(k AS VARCHAR) AS listing_id, price AS price_pln, price / 50 AS price_per_m2, chosen AS observed_at FROM e WHERE reason IS NULL")
def prepared_latest(s, d):
    ready = prepare.prepared(_observations(s, d), F.to_timestamp(F.lit("1998-01-01T00:00:00Z")), keep="latest", hosts=HOSTS, max_age_days=900)
    return ready.select("source", "listing_id", "price_pln", "price_per_m2", c("observed_at").cast("timestamp_ntz").alias("observed_at"))


def _kept(s, frame, what):
    """The frame as a written table in the shared folder: several actions read it, and none of them works it out again."""
    return work.kept(frame, what)


def _ranking(s, d, ready):
    """Latest listings scored by the median of their district among the training listings, best gap first."""
    ready = _kept(s, ready, "latest")
    first = _kept(s, prepare.prepared(_observations(s, d), F.to_timestamp(F.lit("1999-01-01T00:00:00Z")), keep="earliest", hosts=HOSTS), "earliest")
    parts = model.disjoint(model.dealt(first, "temporal"))
    medians = model.by_group_median(parts.where("partition = 'train'"), "district")
    told = ready.join(F.broadcast(medians), "district", "left")  # a row for each district
    return model.scored(told, parts.select("source", "listing_id", "partition"))


SCORED = f"""{SNAPSHOTS}, f AS (SELECT *, min(CASE WHEN NOT naive THEN at_ END) OVER i AS began FROM w WINDOW i AS (PARTITION BY src, o_custkey)),
h AS (SELECT src, o_custkey AS k, began, max(price) AS price FROM f WHERE NOT spoilt AND at_ = began AND began <= TIMESTAMP '1999-01-01' GROUP BY ALL HAVING count(DISTINCT price) = 1 AND count(DISTINCT row(floor)) = 1 AND o_custkey % 17 > 0 AND o_custkey % 13 > 0),
d AS (SELECT CAST(began AS DATE) AS day, count(*) AS n FROM h GROUP BY 1), x AS (SELECT day, row_number() OVER (ORDER BY day) AS i, sum(n) OVER (ORDER BY day) AS cum, sum(n) OVER () AS total, count(*) OVER () AS days FROM d),
a AS (SELECT arg_min(i, (abs(cum - 0.6::DOUBLE * total), i)) AS train_cut FROM x WHERE i <= days - 2), b AS (SELECT train_cut, arg_min(i, (abs(cum - 0.8::DOUBLE * total), i)) AS val_cut FROM x, a WHERE i > train_cut AND i <= days - 1 GROUP BY 1),
p AS (SELECT h.*, CASE WHEN i <= train_cut THEN 'train' WHEN i <= val_cut THEN 'validation' ELSE 'test' END AS partition FROM h JOIN x ON CAST(began AS DATE) = day, b), m AS (SELECT k % 3 AS dist, median(price) AS predicted FROM p WHERE partition = 'train' GROUP BY 1)
SELECT e.src || '.example' AS source, CAST(e.k AS VARCHAR) AS listing_id, coalesce(p.partition, 'unseen') AS partition, e.price, predicted, (predicted - e.price) / predicted AS discount, (predicted - e.price) / predicted >= 0.15 AS is_deal, e.k % 3 AS dist, chosen FROM e JOIN m ON e.k % 3 = dist LEFT JOIN p ON p.src = e.src AND p.k = e.k WHERE reason IS NULL"""


@query(f"SELECT source, listing_id, partition, round(discount, 9) AS discount, is_deal FROM ({SCORED})")
def scored_latest(s, d):
    ready = prepare.prepared(_observations(s, d), F.to_timestamp(F.lit("1998-01-01T00:00:00Z")), keep="latest", hosts=HOSTS, max_age_days=900)
    return _ranking(s, d, ready).select("source", "listing_id", "partition", F.round("discount", 9).alias("discount"), "is_deal")


def _candidates(s, d):
    """The ranking's input to the selection: deals among listings no model has seen."""
    now = F.to_timestamp(F.lit("1998-01-01T00:00:00Z"))
    scored = prepare.of_parts(_ranking(s, d, prepare.prepared(_observations(s, d), now, keep="latest", hosts=HOSTS, max_age_days=900)))
    ready = scored.withColumns({n: c(n).cast("string") for n in ("is_deal", "seen_in_training")} | {"observed_at": F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "ranking_status": F.lit("experimental"), "generated_at": now})
    return selection.ranked(selection.judged(ready, now, max_age_days=900, hosts=HOSTS))


RANKED = f"SELECT * FROM ({SCORED}) WHERE partition IN ('test', 'unseen') AND is_deal ORDER BY discount DESC, source, listing_id LIMIT 50"


@query(f"SELECT source, listing_id, price AS price_pln, round(predicted, 6) AS predicted_price_pln, round(discount, 9) AS gap, 'experimental' AS ranking_status FROM ({RANKED})")
def build_ranking(s, d):
    return _candidates(s, d).select("source", "listing_id", "price_pln", F.round("predicted_price_pln", 6).alias("predicted_price_pln"), F.round("gap", 9).alias("gap"), "ranking_status")


@query(f"""SELECT CAST(row_number() OVER (ORDER BY discount DESC, source, listing_id) AS INTEGER) AS position, source, listing_id, 'https://' || source || '/x' AS url, 'D' || dist AS district, price AS price_pln, CAST(50 AS DOUBLE) AS area_m2, 2 AS rooms, round(predicted, 6) AS predicted_price_pln,
 round(discount, 9) AS model_gap_fraction, round(predicted - price, 6) AS model_gap_pln, strftime(chosen, '%Y-%m-%dT%H:%M:%SZ') AS observed_at FROM ({RANKED})""")
def feed_from_ranking(s, d):
    rounded = {"predicted_price_pln": 6, "model_gap_fraction": 9, "model_gap_pln": 6}
    return feed.offers(_candidates(s, d)).withColumns({n: F.round(n, k) for n, k in rounded.items()})


@query(None)
def ranking_lines(s, d):
    return files.lines(_candidates(s, d))


SIDE = """SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, min(l_suppkey) AS dist, l_linenumber AS rooms, min(l_quantity) AS area, min(l_extendedprice) AS price, CASE WHEN l_orderkey % 3 > 0 THEN l_orderkey % 3 END AS floor
 FROM lineitem WHERE l_orderkey % 41 > 0 AND l_linestatus = {0} GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT row(l_suppkey, l_quantity, l_extendedprice)) = 1"""


@query(f"""SELECT a.id AS left_listing_id, b.id AS right_listing_id, CASE WHEN a.floor = b.floor THEN 'both_known_equal' ELSE 'unknown' END AS floor_evidence, round(abs(a.price - b.price) / least(a.price, b.price), 9) AS price_difference_fraction
FROM ({SIDE.format(chr(39) + 'F' + chr(39))}) a JOIN ({SIDE.format(chr(39) + 'O' + chr(39))}) b ON a.dist = b.dist AND a.rooms = b.rooms AND abs(a.area - b.area) <= greatest(0.1, 0.005 * least(a.area, b.area)) + 1e-12 AND abs(a.price - b.price) <= 0.01 * least(a.price, b.price) + 1e-9 AND (a.floor = b.floor OR a.floor IS NULL OR b.floor IS NULL)""")
def similar_listings(s, d):
    k = c("l_orderkey")
    source = F.when(c("l_linestatus") == "F", "f.example").otherwise("o.example")
    rows = t(s, d, "lineitem").select(
        source.alias("source"), (k * 10 + c("l_linenumber")).cast("string").alias("listing_id"), F.lit(None).cast("string").alias("url"), F.when(k % 41 == 0, "Elsewhere").otherwise(" WARSAW").alias("city"), F.concat(F.lit(" D  "), c("l_suppkey")).alias("district"),
        F.format_string("%.2f", "l_extendedprice").alias("price_pln"), F.format_string("%.2f", "l_quantity").alias("area_m2"), c("l_linenumber").alias("rooms"), F.when(k % 3 == 0, "ground").otherwise((k % 3).cast("string")).alias("floor"), F.lit("2026-01-01T00:00:00Z").alias("observed_at"),
    )
    found = match.candidates(rows, {"f.example": "f.example", "o.example": "o.example"})
    return found.select("left_listing_id", "right_listing_id", "floor_evidence", F.round("price_difference_fraction", 9).alias("price_difference_fraction")).orderBy("left_listing_id", "right_listing_id")


BATCH = "SELECT o_custkey AS k, date_trunc('year', o_orderdate) AS at_, min(round(o_totalprice, 2)) AS price FROM orders WHERE o_orderstatus {0} GROUP BY 1, 2"


@query(f"""WITH h AS ({BATCH.format("<> 'O'")}), n AS ({BATCH.format("= 'O'")}), a AS (SELECT * FROM n WHERE NOT EXISTS (FROM h WHERE h.k = n.k AND h.at_ = n.at_))
SELECT (SELECT count(DISTINCT k) FROM n) AS seen_listings, (SELECT count(DISTINCT k) FROM a WHERE k NOT IN (SELECT k FROM h)) AS new_listings, (SELECT count(DISTINCT k) FROM n) - (SELECT count(DISTINCT k) FROM a WHERE k NOT IN (SELECT k FROM h)) AS existing_listings, (SELECT count(*) FROM a) AS observations_inserted""")
def price_batch_report(s, d):
    return _merged(s, d)[2]


@query(f"""WITH h AS ({BATCH.format("<> 'O'")}), n AS ({BATCH.format("= 'O'")}), a AS (SELECT * FROM n WHERE NOT EXISTS (FROM h WHERE h.k = n.k AND h.at_ = n.at_)), u AS (SELECT *, 0 AS w FROM h UNION ALL SELECT *, 1 FROM a)
SELECT CAST(k AS VARCHAR) AS listing_id, arg_max(price, (at_, w)) AS price_pln, min(at_) AS first_seen, max(at_) AS last_seen FROM u GROUP BY 1""")
def price_state(s, d):
    return _merged(s, d)[1].select("listing_id", "price_pln", "first_seen", "last_seen")


def _merged(s, d):
    """Orders shipped as history and state, open ones as the arriving batch."""
    def prices(test):
        by = t(s, d, "orders").where(test).groupBy(c("o_custkey").cast("string").alias("listing_id"), F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("observed_at"))
        return by.agg(F.min(F.round("o_totalprice", 2)).alias("price_pln")).withColumn("source", F.lit("a"))

    history = prices("o_orderstatus <> 'O'")
    current = history.groupBy("source", "listing_id").agg(F.max_by("price_pln", "observed_at").alias("price_pln"), F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"))
    return store.merged_prices(history, current, prices("o_orderstatus = 'O'"), ["price_pln"])


@query("""WITH r AS (SELECT o_custkey AS k, arg_min(o_orderpriority, (o_orderdate, o_orderpriority, o_orderkey)) AS owner, min((o_orderdate, o_orderpriority, o_orderkey)) AS one FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND (o_custkey % 3 = 0 OR (o_custkey % 3 > 0 AND o_orderpriority = '1-URGENT') OR o_orderdate >= TIMESTAMP '1996-01-01') GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS mode, coalesce(r.owner, CASE WHEN c_custkey % 3 > 0 THEN '1-URGENT' END) AS lease_owner, r.k IS NOT NULL AS granted, CASE WHEN r.k IS NOT NULL AND struct_extract(one, 3) % 2 = 0 THEN 'g' || struct_extract(one, 3) ELSE 'old' END AS generation FROM customer LEFT JOIN r ON k = c_custkey""")
def lease_generations(s, d):
    k = c("c_custkey")
    held = t(s, d, "customer").select(F.lit("s").alias("source"), k.cast("string").alias("mode"), F.lit("old").alias("generation"), F.lit("{}").alias("checkpoint"), F.lit(False).alias("completed"), F.lit("1994-01-01").cast("timestamp_ntz").alias("updated_at"), F.when(k % 3 > 0, "1-URGENT").alias("lease_owner"), F.when(k % 3 > 0, F.lit("1996-01-01").cast("timestamp_ntz")).alias("lease_until"), F.lit(None).cast("string").alias("last_error"))
    asked = t(s, d, "orders").where("o_orderdate >= '1995-01-01'").join(held.select(c("mode").cast("long").alias("o_custkey")), "o_custkey", "left_semi")
    asked = asked.select(F.lit("s").alias("source"), c("o_custkey").cast("string").alias("mode"), c("o_orderpriority").alias("owner"), c("o_orderdate").alias("at"), F.concat(F.lit("g"), "o_orderkey").alias("generation"), (c("o_orderkey") % 2 == 0).alias("restart"), "o_orderkey")
    earliest = asked.groupBy("source", "mode", "owner", "at").agg(F.min_by(F.struct("generation", "restart"), "o_orderkey").alias("r")).select("source", "mode", "owner", "at", "r.*")
    return store.leased(held, earliest).select("mode", "lease_owner", "granted", "generation")


@query("SELECT CAST(c_custkey AS VARCHAR) AS mode, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'me' END AS lease_owner, CASE WHEN c_custkey % 8 = 0 THEN 'source_failed' END AS last_error FROM customer")
def lease_releases(s, d):
    k = c("c_custkey")
    held = t(s, d, "customer").select(F.lit("s").alias("source"), k.cast("string").alias("mode"), F.lit("me").alias("lease_owner"), F.lit(1).alias("lease_until"), F.lit(None).cast("string").alias("last_error"))
    given = t(s, d, "customer").where("c_custkey % 2 = 0").select(F.lit("s").alias("source"), k.cast("string").alias("mode"), F.when(k % 4 == 0, "me").otherwise("other").alias("owner"), F.when(k % 8 == 0, "source_failed").alias("error"))
    return store.released(held, given).select("mode", "lease_owner", "last_error")


@query("""WITH m AS (SELECT median(CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END) AS fill FROM customer WHERE c_nationkey < 15), k AS (SELECT DISTINCT CASE WHEN c_custkey % 7 = 0 THEN 'Unknown' ELSE c_mktsegment END AS x FROM customer WHERE c_nationkey < 15 AND c_mktsegment <> 'MACHINERY')
SELECT c_custkey, round(CASE WHEN c_custkey % 5 > 0 THEN c_acctbal ELSE fill END, 6) AS balance, CAST((SELECT count(*) FROM k WHERE x = CASE WHEN c_custkey % 7 = 0 THEN 'Unknown' ELSE c_mktsegment END) AS DOUBLE) AS known FROM customer, m""")
def preprocessed(s, d):
    rows = t(s, d, "customer").select("c_custkey", "c_nationkey", F.when(c("c_custkey") % 5 > 0, c("c_acctbal")).alias("balance"), F.lit(None).cast("double").alias("nothing"), F.when(c("c_custkey") % 7 > 0, c("c_mktsegment")).alias("segment"), "c_mktsegment")
    learned = model.Preprocessor.fitted(rows.where("c_nationkey < 15"), ("balance", "nothing"), None)
    kinds = model.Preprocessor.fitted(rows.where("c_nationkey < 15 AND c_mktsegment <> 'MACHINERY'"), (), "segment")
    out = kinds.applied(learned.applied(rows))
    return out.select("c_custkey", F.round("f_balance", 6).alias("balance"), (sum((c(n) for n in kinds.names()), F.lit(0.0)) + c("f_nothing")).alias("known"))


@query("SELECT l_returnflag, count(*) AS rows, round(avg(abs(l_extendedprice - l_quantity * 1500)), 4) AS mae, round(sqrt(avg(pow(l_extendedprice - l_quantity * 1500, 2))), 4) AS rmse, round(1 - sum(pow(l_extendedprice - l_quantity * 1500, 2)) / (var_pop(l_extendedprice) * count(*)), 6) AS r2 FROM lineitem GROUP BY 1")
def metrics_by_group(s, d):
    li = t(s, d, "lineitem").withColumn("p", c("l_quantity") * 1500)
    return model.metrics(li, "l_extendedprice", "p", ["l_returnflag"]).select("l_returnflag", "rows", *[F.round(n, k).alias(n) for n, k in (("mae", 4), ("rmse", 4), ("r2", 6))])


def _homes(s, d):
    """Lineitems as observed homes with all of a model's features; their price follows from these, with noise of their own and some bargains."""
    k, part, supp, noise = c("l_orderkey") * 10 + c("l_linenumber"), c("l_partkey"), c("l_suppkey"), F.pmod(c("l_extendedprice"), F.lit(1000)) / 1000
    source = F.when(c("l_linestatus") == "F", "a.example").otherwise("b.example")
    area, year, lat, lon = 20 + 2 * c("l_quantity"), 1930 + part % 90, 52.1 + supp % 50 / 200, 20.85 + part % 80 / 200
    unit = 8_000 + 900 * (part % 5) + 35 * (year - 1930) - 350 * v.haversine_km(lat, lon) / 2 + 1_500 * noise
    return t(s, d, "lineitem").select(
        source.alias("source"), k.cast("string").alias("listing_id"), F.concat(F.lit("https://"), source, F.lit("/x")).alias("url"), F.lit("Warszawa").alias("city"), F.concat(F.lit("D"), part % 5).alias("district"),
        F.round(area * F.greatest(unit, F.lit(4_000)) * F.when(c("l_discount") >= 0.09, 0.75).otherwise(1.0)).alias("price_pln"), area.alias("area_m2"), (1 + c("l_linenumber") % 4).alias("rooms"), F.when(c("l_tax") > 0.01, supp % 10).alias("floor"), year.alias("build_year"),
        lat.alias("latitude"), lon.alias("longitude"), F.lit(None).cast("double").alias("distance_km"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("observed_at"),
    )


#: When the homes are looked at, and the oldest that counts then.
LOOKED, OLDEST = "2001-06-01T00:00:00Z", 400


#: Where the models of this application are saved, and the digests that were approved.
_saved_models: dict = {}


def _model(s, d):
    """A model of the homes' first observations: trained and saved once an application, loaded by the digest that was approved.

    The rate is higher and the trees fewer than the library's own settings, for a shorter run.
    """
    place = (s.sparkContext.applicationId, d)
    if place not in _saved_models:
        now = F.to_timestamp(F.lit(LOOKED))
        first = work.kept(prepare.prepared(_homes(s, d), now, keep="earliest", hosts=HOSTS), "earliest")
        made, _ = artifact.trained(model.dealt(first, "temporal"), captured_at=LOOKED, trees=80, first=80, rate=0.15)
        folder = work.passing_folder(s, "model")
        _saved_models[place] = (folder, artifact.save(s, folder, made))
        work.forget(first)
    folder, approved = _saved_models[place]
    return artifact.load(s, folder, expected=approved)


@query(None)
def gbt_score(s, d):
    """Prices of homes by boosted trees over seven numbers and a category; ``test`` and ``unseen`` homes with their gap."""
    now = F.to_timestamp(F.lit(LOOKED))
    latest = prepare.prepared(_homes(s, d), now, keep="latest", hosts=HOSTS, max_age_days=OLDEST)
    out = prepare.of_parts(_model(s, d).scored(latest))
    return out.select("source", "listing_id", "price_pln", "predicted_price_pln", "discount", "is_deal", "partition")


def _deals(s, d):
    now = F.to_timestamp(F.lit(LOOKED))
    latest = prepare.prepared(_homes(s, d), now, keep="latest", hosts=HOSTS, max_age_days=OLDEST)
    scored = prepare.of_parts(_model(s, d).scored(latest))
    ready = scored.withColumns({n: c(n).cast("string") for n in ("is_deal", "seen_in_training")} | {"observed_at": F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")})
    return selection.ranked(selection.judged(ready, now, max_age_days=OLDEST, hosts=HOSTS))


@query(None)
def ranking_by_model(s, d):
    """The build: homes scored by the saved model, judged by all stages, the best by their gap."""
    return _deals(s, d).select("source", "listing_id", "price_pln", "predicted_price_pln", "gap", "partition")


@query(None)
def feed_by_model(s, d):
    """The same as a feed's offers."""
    return feed.offers(_deals(s, d))


@query(f"SELECT l_linenumber, array_to_string(list_sort(list_distinct(flatten(list(string_split(quality_flags, '|'))))), '|') AS flags FROM ({FLAGGED}) WHERE quality_flags <> '' GROUP BY 1")
def flag_unions(s, d):
    found = audit_flags(s, d).where("quality_flags <> ''").select("l_linenumber", F.explode(F.split("quality_flags", r"\|")).alias("flag")).distinct()
    return found.groupBy("l_linenumber").agg(F.array_join(F.array_sort(F.collect_set("flag")), "|").alias("flags"))  # at most as many as there are flags


@query("WITH e AS (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem) SELECT CAST(least(20, floor((l_extendedprice - low) / (high - low) * 20) + 1) AS INTEGER) AS bin, count(*) AS n FROM lineitem, e GROUP BY 1")
def price_bins(s, d):
    li = t(s, d, "lineitem")
    ends = li.agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")).first()  # one row
    place = F.least(F.lit(20), F.floor((c("l_extendedprice") - ends["low"]) / (ends["high"] - ends["low"]) * 20) + 1).cast("int")
    return li.groupBy(place.alias("bin")).agg(F.count("*").alias("n"))


@query("SELECT phase, CAST(sum(n) AS BIGINT) AS n FROM (SELECT o_orderstatus AS phase, count(*) AS n FROM orders GROUP BY 1, o_orderpriority) GROUP BY 1")
def statistics_added(s, d):
    parts = t(s, d, "orders").groupBy("o_orderpriority", c("o_orderstatus").alias("phase")).agg(F.count("*").alias("n"))
    return parts.groupBy("phase").agg(F.sum("n").alias("n"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') ORDER BY o_orderdate, o_custkey, o_orderkey")
def ordered_scan(s, d):
    return store.scan(t(s, d, "orders").withColumnRenamed("o_orderpriority", "source"), ["o_orderdate", "o_custkey", "o_orderkey"], columns=["o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"], sources=("1-URGENT", "2-HIGH")).drop("o_orderdate")


@query("SELECT c_custkey, c_custkey % 4 > 0 AS kept FROM customer WHERE c_custkey % 4 <> 1 AND (c_custkey % 4 = 0 OR c_custkey % 4 = 3 OR c_custkey % 4 = 2) AND c_custkey % 4 IN (2, 3)")
def available_rows(s, d):
    k = c("c_custkey") % 4
    status = F.when(k == 0, "sold").when(k == 1, "missing").when(k == 2, "available")
    return prepare.available(t(s, d, "customer").withColumn("availability_status", status)).select("c_custkey", (k > 0).alias("kept"))


@query("""SELECT CAST(c_custkey + 1 AS VARCHAR) AS listing_id, CAST(CASE WHEN c_custkey < 20 THEN 2 ELSE 1 END AS BIGINT) AS n, strftime(DATE '2026-01-01' + CAST(floor(c_custkey * 30 / (SELECT count(*) FROM customer)) AS INTEGER), '%Y-%m-%d') AS first_day FROM customer""")
def seeded_observations(s, d):
    """Made observations of the customers' listings."""
    made = files.seeded(s, t(s, d, "customer").select(c("c_custkey").cast("long").alias("id")))
    return made.groupBy("listing_id").agg(F.count("*").alias("n"), F.date_format(F.min("observed_at"), "yyyy-MM-dd").alias("first_day"))


@query("SELECT c_custkey, CAST(CASE WHEN x >= 9223372036854775808 THEN x - 18446744073709551616 ELSE x END AS BIGINT) AS key FROM (SELECT c_custkey, CAST(CAST('0x' || substr(sha256('s' || chr(10) || c_name), 1, 16) AS UBIGINT) AS HUGEINT) AS x FROM customer)")
def lock_keys(s, d):
    return t(s, d, "customer").select("c_custkey", v.lock_key(F.lit("s"), c("c_name")).alias("key"))


@query("""WITH h AS (SELECT o_custkey AS k, o_orderdate AS at_, min(o_orderpriority) AS digest FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1, 2), l AS (SELECT k, max(at_) AS last_ FROM h GROUP BY 1)
SELECT o_orderkey, o_custkey, CASE WHEN digest = o_orderpriority THEN 'replay' WHEN digest IS NOT NULL THEN 'conflict' WHEN last_ > o_orderdate THEN 'older' ELSE 'new' END AS verdict
FROM orders LEFT JOIN h ON h.k = o_custkey AND at_ = o_orderdate LEFT JOIN l ON l.k = o_custkey""")
def inventory_admitted(s, d):
    o = t(s, d, "orders").withColumns({"observed_at": c("o_orderdate"), "digest": c("o_orderpriority")})
    headers = o.where("o_orderstatus <> 'O'").groupBy("o_custkey", "observed_at").agg(F.min("digest").alias("digest"))
    arriving = o.select("o_orderkey", "o_custkey", "observed_at", "digest")
    return inventory.admitted(headers, arriving, ["o_custkey"]).select("o_orderkey", "o_custkey", "verdict")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'b.example' ELSE 'a.example' END AS source, round((1000000 - o_totalprice) / 1000000, 9) AS gap FROM orders WHERE o_orderkey % 5 > 0 AND o_orderkey % 7 > 0""")
def client_offers(s, d):
    k = c("o_orderkey")
    host = F.when(k % 3 == 0, "b.example").otherwise("a.example")
    offered = t(s, d, "orders").select(
        "o_orderkey", F.when(k % 3 == 0, " B ").otherwise("a.example").alias("source"), F.concat(F.when(k % 5 == 0, "http").otherwise("https"), F.lit("://"), host, F.lit("/x")).alias("url"), F.lit("C\x07 d").alias("district"),
        c("o_totalprice").alias("price_pln"), F.when(k % 7 == 0, 0.0).otherwise(50.0).alias("area_m2"), F.lit(1e6).alias("predicted_price_pln"), F.lit(0.9).alias("model_gap_fraction"), F.lit(0.0).alias("model_gap_pln"),
    )
    return feed.client_rows(offered, {"b": "b.example"}, HOSTS).select("o_orderkey", "source", F.round("model_gap_fraction", 9).alias("gap"))


@query("""WITH k AS (SELECT *, c_custkey % 2 = 0 AS known, known AND c_custkey % 3 = 0 AS later, c_custkey % 5 > 0 AS priced, CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey * 10 AS VARCHAR) AS price FROM customer WHERE c_custkey > 0)
SELECT 'catalogue' AS what, id AS listing_id, CASE WHEN later THEN '5' WHEN priced THEN price END AS price_pln, CASE WHEN known THEN '2025-01-01T00:00:00Z' ELSE '2026-01-01T00:00:00Z' END AS first_seen, CASE WHEN later THEN '2027-01-01T00:00:00Z' ELSE '2026-01-01T00:00:00Z' END AS last_seen FROM k
UNION ALL SELECT 'appended', id, price, NULL, '2026-01-01T00:00:00Z' FROM k WHERE priced
UNION ALL SELECT 'current', id, CASE WHEN priced AND NOT later THEN price ELSE '5' END, CASE WHEN known THEN '2025-01-01T00:00:00Z' ELSE '2026-01-01T00:00:00Z' END, CASE WHEN later THEN '2027-01-01T00:00:00Z' WHEN priced THEN '2026-01-01T00:00:00Z' ELSE '2025-06-01T00:00:00Z' END FROM k WHERE known OR priced
UNION ALL SELECT 'progress', 'www.a.example', '{"page":7}', 'true', NULL""")
def capture_commit(s, d):
    """Customers as a capture over a catalogue that knows half of them, some by a later time."""
    k, none = c("c_custkey"), F.lit(None).cast("string")
    people = t(s, d, "customer").where("c_custkey > 0")
    base = {"source": F.lit("www.a.example"), "listing_id": k.cast("string"), "url": F.concat(F.lit("https://www.a.example/o/"), k), "city": F.lit("Warszawa"), "area_m2": F.lit("50"), "rooms": F.lit("2")}
    record = lambda **more: [(base | more).get(n, none).alias(n) for n in contracts.CATALOGUE]
    batch = people.select(*record(price_pln=F.when(k % 5 > 0, (k * 10).cast("string")), observed_at=F.lit("2026-01-01T00:00:00Z")))
    late = F.when(k % 3 == 0, "2027-01-01T00:00:00Z").otherwise("2025-06-01T00:00:00Z")
    known = people.where("c_custkey % 2 = 0").select(*record(price_pln=F.lit("5"), observed_at=late)).withColumn("first_seen", F.lit("2025-01-01T00:00:00Z")).withColumnRenamed("observed_at", "last_seen")
    progress = s.createDataFrame([("www.a.example", "full", "g", "{}", False, 0, "me", 10, None)], "source string, mode string, generation string, checkpoint string, completed boolean, updated_at int, lease_owner string, lease_until int, last_error string")
    state = known.select("source", "listing_id", "price_pln", "first_seen", "last_seen")
    done = store.captured(known, state.select("source", "listing_id", "price_pln", c("last_seen").alias("observed_at")), state, progress, batch, source="www.a.example", mode="full", owner="me", generation="g", checkpoint='{"page":7}', completed=True, at=F.lit(5), paths={"www.a.example": "/o/[^/]+"}, values=["price_pln"])
    none = F.lit(None).cast("string")
    row = lambda what, f, first, last, ident="listing_id", price="price_pln": f.select(F.lit(what).alias("what"), c(ident).alias("listing_id"), c(price).alias("price_pln"), first.cast("string").alias("first_seen"), last.alias("last_seen"))
    return (
        row("catalogue", done.catalogue, c("first_seen"), c("last_seen"))
        .unionByName(row("appended", done.appended, none, c("observed_at")))
        .unionByName(row("current", done.current, c("first_seen"), c("last_seen")))
        .unionByName(row("progress", done.progress, c("completed"), none, "source", "checkpoint"))
    )


@query("""WITH r AS (SELECT o_custkey AS k, CASE WHEN max(o_orderstatus) = 'O' THEN 'available' ELSE 'sold' END AS status FROM orders GROUP BY 1)
SELECT 'p' || coalesce(c_custkey, r.k) AS listing_id, coalesce(status, 'missing') AS status, CASE WHEN r.k IS NULL THEN 1 ELSE 7 END AS last_seen_at FROM customer FULL JOIN r ON c_custkey = r.k""")
def inventory_taken(s, d):
    """All customers as the known inventory, those with orders as the next snapshot's."""
    ident = lambda x: F.concat(F.lit("p"), x).alias("listing_id")
    headers = s.createDataFrame([("s", "one", "p", 1, "x", 1)], "source string, scope string, prefix string, observed_at int, digest string, n long")
    current = t(s, d, "customer").select(F.lit("s").alias("source"), F.lit("one").alias("scope"), ident("c_custkey"), F.lit("available").alias("status"), F.lit(1).alias("last_seen_at"), F.lit(1).alias("observed_at"))
    reported = t(s, d, "orders").groupBy("o_custkey").agg(F.max("o_orderstatus").alias("o")).select(ident("o_custkey"), F.when(c("o") == "O", "available").otherwise("sold").alias("status"))
    done = inventory.taken(headers, current, current, reported, source="s", scope="one", prefix="p", at=F.lit(7), complete=True)
    return done.current.select("listing_id", "status", "last_seen_at")


@query("""SELECT 'A' || c_custkey AS unit_number, CASE WHEN c_custkey % 11 > 0 THEN CAST(c_custkey + 1 AS DOUBLE) + 0.5 END AS price_pln, CASE WHEN c_custkey % 5 = 0 THEN 'other_context' WHEN c_custkey % 7 = 0 THEN 'other_property_type' WHEN c_custkey % 11 = 0 THEN 'invalid_price' WHEN c_custkey % 13 = 0 THEN 'invalid_time' WHEN c_custkey % 17 = 0 THEN 'not_of_the_day' END AS reason FROM customer WHERE c_custkey % 3 > 0""")
def price_file_rows(s, d):
    """A price file written of customers, read by its layout."""
    k, folder = c("c_custkey"), work.passing_folder(s, "prices")
    until = F.when(k % 13 == 0, "2026-08-01T00:00:00+01:00").when(k % 17 == 0, "2026-07-02T00:00:00Z").otherwise("2026-08-01T00:00:00+02:00")
    price = F.when(k % 11 == 0, "1,2.3").otherwise(F.concat(k + 1, F.lit(",50")))
    kind = F.when(k % 3 == 0, "Parking").when(k % 7 == 0, "House").otherwise("Flat")
    made = t(s, d, "customer").select(F.concat(F.lit("A"), k).alias("Unit"), kind.alias("Kind"), F.lit("2026-07-01T00:00:00Z").alias("From"), until.alias("Until"), F.when(k % 5 == 0, "Else").otherwise("TOWN").alias("Town"), price.alias("Base price (PLN)"))
    tables.write_csv(made, folder, made.columns)
    layout = files.Layout({"unit_number": "Unit", "property_type": "Kind", "valid_from": "From", "valid_until": "Until"}, "Base price", context={"Town": "town"}, wanted="Flat", passed_over=("Parking",))
    return files.price_file(s, folder, layout, F.lit("2026-07-15").cast("date")).select("unit_number", "price_pln", "reason")


@query("SELECT s_suppkey AS id, s_name AS name, 'supplier' AS kind FROM supplier UNION ALL SELECT c_custkey, c_name, 'customer' FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def pinned_snapshot(s, d):
    """Two frames of one bundle, read while another bundle comes into force."""
    folder = work.passing_folder(s, "pinned")
    bundle = {"suppliers": t(s, d, "supplier"), "customers": t(s, d, "customer").withColumnRenamed("c_mktsegment", "source")}
    tables.save_bundle(s, folder, bundle)
    both = tables.open_snapshot(s, folder, {"suppliers": {"columns": ["s_suppkey", "s_name"], "limit": 10_000_000}, "customers": {"columns": ["c_custkey", "c_name"], "sources": ("BUILDING", "MACHINERY"), "order": ["c_custkey"]}})
    tables.save_bundle(s, folder, {n: f.where("false") for n, f in bundle.items()})
    rows = lambda f, kind: f.toDF("id", "name").select(c("id").cast("long").alias("id"), "name", F.lit(kind).alias("kind"))
    return rows(both["suppliers"], "supplier").unionByName(rows(both["customers"], "customer"))


def _page(ident, price, rooms, source):
    """A page with one JSON-LD listing."""
    return F.concat(
        F.lit('<script type="application/ld+json">{"@type":"RealEstateListing","identifier":"'), ident, F.lit('","url":"https://'), F.lit(source), F.lit('/o/'), ident, F.lit('","offers":{"@type":"Offer","price":'), price,
        F.lit(',"priceCurrency":"PLN"},"mainEntity":{"@type":"Apartment","floorSize":50,"numberOfRooms":'), rooms, F.lit(',"address":{"addressLocality":"Warszawa"}}}</script>'),
    )


def _saved(s, made, files_):
    """Pages saved in some files of the shared folder, as a collector leaves them."""
    folder = work.passing_folder(s, "saved-pages")
    made.repartition(files_).write.parquet(folder)
    return folder


@query("SELECT CAST(n_nationkey + 1 AS VARCHAR) AS listing_id, CAST((n_nationkey + 1) * 100 AS VARCHAR) AS price_pln, '2026-01-01T00:00:00Z' AS first_seen FROM nation")
def collected_run(s, d):
    """Nations' pages as a stream of files, taken in two runs with one lease; the second goes on with what is new."""
    ident, folder = (c("n_nationkey") + 1).cast("string"), work.passing_folder(s, "capture")
    page = t(s, d, "nation").select(c("n_nationkey").cast("long").alias("page_id"), F.lit("https://www.a.example/s").alias("url"), _page(ident, ((c("n_nationkey") + 1) * 100).cast("string"), F.lit("2"), "www.a.example").alias("html"), F.lit("2026-01-01T00:00:00Z").alias("observed_at"))
    saved = _saved(s, page.where("page_id % 2 = 0"), 2)
    how = {"source": "www.a.example", "owner": "me", "generation": 1, "paths": {"www.a.example": "/o/[^/]+"}, "files": 1, "buckets": 8}
    captures.run(s, saved, folder, **how)
    page.where("page_id % 2 = 1").write.mode("append").parquet(saved)
    ledger = captures.run(s, saved, folder, **how)
    return ledger.table("catalogue").select("listing_id", F.format_string("%.0f", c("price_pln").cast("double")).alias("price_pln"), "first_seen")


CAPTURED = """WITH p AS (SELECT s_suppkey AS k, gen AS g, CASE WHEN gen = 1 AND s_suppkey % 4 = 0 THEN NULL ELSE 1000 * (s_suppkey + 1) + gen END AS price FROM supplier, (SELECT unnest(range(3)) AS gen) WHERE s_suppkey % 3 >= gen AND s_suppkey % 7 > 0)"""


@query(f"""{CAPTURED} SELECT 'catalogue' AS what, CAST(k + 1 AS VARCHAR) AS listing_id, CAST(max(price) AS DOUBLE) AS price_pln, '2026-01-0' || min(g + 1) || 'T00:00:00Z' AS first_seen, '2026-01-0' || max(g + 1) || 'T00:00:00Z' AS last_seen FROM p WHERE price IS NOT NULL GROUP BY k
UNION ALL SELECT 'history', CAST(k + 1 AS VARCHAR), CAST(price AS DOUBLE), NULL, '2026-01-0' || (g + 1) || 'T00:00:00Z' FROM p WHERE price IS NOT NULL
UNION ALL SELECT 'current', CAST(k + 1 AS VARCHAR), CAST(max(price) AS DOUBLE), '2026-01-0' || min(g + 1) || 'T00:00:00Z', '2026-01-0' || max(g + 1) || 'T00:00:00Z' FROM p WHERE price IS NOT NULL GROUP BY k
UNION ALL SELECT 'accounts', 'listings', CAST(count(*) AS DOUBLE), NULL, NULL FROM (SELECT 1 FROM supplier, (SELECT unnest(range(3)) AS gen) WHERE s_suppkey % 3 >= gen)
UNION ALL SELECT 'accounts', 'accepted', CAST(count(price) AS DOUBLE), NULL, NULL FROM p""")
def captured_pages(s, d):
    """Three days of suppliers' saved pages as a stream: catalogue, price history, current prices and the account, put in force batch by batch."""
    k, g = c("s_suppkey"), c("g")
    price = F.when((g == 1) & (k % 4 == 0), "0").otherwise((1000 * (k + 1) + g).cast("string"))
    rooms = F.when(k % 7 == 0, "1.5").otherwise("2")
    days = t(s, d, "supplier").withColumn("g", F.explode(F.array(*map(F.lit, range(3))))).where("s_suppkey % 3 >= g")
    page = days.select((k * 3 + g).cast("long").alias("page_id"), F.lit("https://www.a.example/s").alias("url"), _page((k + 1).cast("string"), price, rooms, "www.a.example").alias("html"), F.concat(F.lit("2026-01-0"), g + 1, F.lit("T00:00:00Z")).alias("observed_at"))
    folder = work.passing_folder(s, "capture")
    ledger = captures.run(s, _saved(s, page, 3), folder, source="www.a.example", owner="me", generation=1, paths={"www.a.example": "/o/[^/]+"}, files=1, buckets=8)
    none = F.lit(None).cast("string")
    told = lambda what, f, first, last: f.select(F.lit(what).alias("what"), "listing_id", c("price_pln").cast("double").alias("price_pln"), first.alias("first_seen"), last.alias("last_seen"))
    count = lambda name: ledger.table("accounts").agg(F.sum(name).cast("double").alias("price_pln")).select(F.lit("accounts").alias("what"), F.lit(name).alias("listing_id"), "price_pln", none.alias("first_seen"), none.alias("last_seen"))
    out = told("catalogue", ledger.table("catalogue"), c("first_seen"), c("last_seen"))
    for more in (told("history", ledger.table("history"), none, c("observed_at")), told("current", ledger.table("current"), c("first_seen"), c("last_seen")), count("listings"), count("accepted")):
        out = out.unionByName(more)
    return out


SNAPSHOTTED = """WITH s AS (SELECT o_custkey AS k, date_trunc('year', o_orderdate) AS at_, count(*) AS n, bool_or(o_orderstatus = 'O') AS open_ FROM orders GROUP BY 1, 2),
u AS (SELECT 'n' || (k % 25) AS scope, at_, k, CASE WHEN open_ THEN 'available' ELSE 'sold' END AS status FROM s), l AS (SELECT scope, max(at_) AS last_ FROM u GROUP BY 1), f AS (SELECT scope, k, max(at_) AS seen FROM u GROUP BY 1, 2)"""


@query(f"""{SNAPSHOTTED} SELECT f.scope, 'u' || f.k AS listing_id, CASE WHEN seen = last_ THEN u.status ELSE 'missing' END AS status, CAST(year(seen) AS BIGINT) AS last_seen_at FROM f JOIN l ON l.scope = f.scope LEFT JOIN u ON u.scope = f.scope AND u.k = f.k AND u.at_ = seen""")
def streamed_inventory(s, d):
    """Customers with orders in a year as that year's inventory of their scope, streamed with keyed state in files of no order within a batch."""
    o = t(s, d, "orders")
    unit = o.groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("observed_at")).agg(F.when(F.bool_or(c("o_orderstatus") == "O"), "available").otherwise("sold").alias("status"))
    snapshots = unit.groupBy(F.concat(F.lit("n"), c("o_custkey") % 25).alias("scope"), "observed_at").agg(F.lit(True).alias("complete"), F.collect_list(F.struct(F.concat(F.lit("u"), "o_custkey").alias("listing_id"), "status")).alias("units"))  # a scope's snapshot of a year
    folder, told = work.passing_folder(s, "snapshots"), work.passing_folder(s, "inventory")
    snapshots.repartition(4).write.parquet(folder)
    with inventories.keyed_state(s):
        stream = s.readStream.schema(inventories.SNAPSHOT).parquet(folder)
        inventories.settled(stream).writeStream.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{told}/batch={n}")).outputMode("update").option("checkpointLocation", f"{told}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return inventories.current(s.read.schema(inventories.TOLD).parquet(f"{told}/*"))


@query("""SELECT s_suppkey AS page_id, 'S' || s_suppkey AS identifier, CAST(s_suppkey * 1000 AS VARCHAR) AS price, CASE WHEN s_suppkey % 9 = 0 THEN 'rental' END AS refused, '/o/S' || s_suppkey AS path FROM supplier""")
def lateral_listings(s, d):
    """Listings and links of suppliers' pages by table functions in SQL."""
    udtf.register(s)
    k = c("s_suppkey")
    html = F.concat(F.lit('<a href="/o/S'), k, F.lit('">x</a><script type="application/ld+json">{"@type":"RealEstateListing","identifier":"S'), k, F.lit('","name":"'), F.when(k % 9 == 0, "for rent").otherwise("flat"), F.lit('","price":'), k * 1000, F.lit("}</script>"))
    t(s, d, "supplier").select(k.alias("page_id"), F.lit("https://a.example/l").alias("url"), html.alias("html")).createOrReplaceTempView("tidemark_pages")
    return s.sql("""SELECT p.page_id, l.identifier, l.price, l.refused, replace(k.link, 'https://a.example', '') AS path FROM tidemark_pages p, LATERAL listings(p.html, p.url) l, LATERAL links(p.html, p.url) k""")


@query("""SELECT 'n' || (c_custkey % 4) AS source, CASE WHEN c_custkey % 4 < 3 THEN count(*) END AS seen, CASE WHEN c_custkey % 4 < 3 THEN count(*) FILTER (c_custkey % 2 = 1) END AS new, CASE WHEN c_custkey % 4 = 3 THEN 'failed' ELSE 'ok' END AS status FROM customer GROUP BY c_custkey % 4""")
def daily_sample(s, d):
    """Customers as four sources' daily previews; one breaks its contract and leaves the others alone."""
    k, at = c("c_custkey"), F.lit("2026-01-02T00:00:00Z")
    fields = {"district": F.lit("D"), "floor": F.lit("1"), "build_year": F.lit("1990"), "latitude": F.lit("52"), "longitude": F.lit("21"), "distance_km": F.lit("1"), "area_m2": F.lit("50"), "observed_at": at}
    previews, tables_ = {}, {}
    for n in range(4):
        people = t(s, d, "customer").where(k % 4 == n)
        rows = people.select(F.lit(f"n{n}").alias("source"), (k + 1).cast("string").alias("listing_id"), (k + 1).cast("string").alias("price_pln"), F.lit("1.5" if n == 3 else "2").alias("rooms"), *[x.alias(name) for name, x in fields.items()])
        known = rows.where("CAST(listing_id AS INT) % 2 = 1")
        previews[f"n{n}"] = rows.select(*collect.PREVIEW)
        old = known.select("source", "listing_id", F.lit("1").alias("price_pln"), "area_m2", F.lit("2025-01-01T00:00:00Z").alias("observed_at"))
        tables_[f"n{n}"] = (old, old.select("source", "listing_id", "price_pln", "area_m2", c("observed_at").alias("first_seen"), c("observed_at").alias("last_seen")))
    out = collect.daily(s, work.passing_folder(s, "daily"), previews, tables_, most=1 << 40)
    rows = [(name, said.get("seen_listings"), said.get("new_listings"), said["status"]) for name, said in sorted(out.items())]
    return s.createDataFrame(rows, "source string, seen long, new long, status string")  # a row for each source
