"""Row choice and table operations: deduplication, snapshots, merges, reconciliation.

All of them are shuffles on the identity key alone; choices within a key are windows whose
top-1 filters Spark turns into group limits, or aggregates with map-side combination.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(frame: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which should end in a unique column."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return frame.withColumn("_place", place).where("_place = 1").drop("_place")


def latest_with_ties(frame: DataFrame, key: list[str], time: str) -> DataFrame:
    """All rows of each key's latest time."""
    return frame.withColumn("_last", F.max(time).over(Window.partitionBy(*key))).where(F.col(time) == F.col("_last")).drop("_last")


def poisoned(frame: DataFrame, key: list[str], bad: Column) -> DataFrame:
    """Keys of which any row is bad: one of them spoils the identity."""
    return frame.groupBy(*key).agg(F.bool_or(bad).alias("poisoned"), F.count("*").alias("n"))


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that fails, null if none; null conditions count as not failing."""
    made = reduce(lambda c, r: c.when(r[1], F.lit(r[0])), rules[1:], F.when(rules[0][1], F.lit(rules[0][0])))
    return made


def append_first_wins(history: DataFrame, batch: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Rows of a batch that enter an append-only history: the first of each key, and none that is there."""
    return keep_one(batch, key, order).join(history.select(*key).distinct(), key, "left_anti")


def upsert(current: DataFrame, delta: DataFrame, key: list[str], values: list[str], time: str, tie: str = "incoming") -> DataFrame:
    """Current state after a delta: the newest row of each key, with first and last time seen.

    On equal times ``tie`` says who wins: ``incoming`` or ``existing``. Older rows never roll the
    state back. Both tables need key, values, time; the result adds first_seen and last_seen.
    """
    mine = F.lit(1 if tie == "existing" else 0)
    both = current.select(*key, *values, time, mine.alias("_w")).unionByName(delta.select(*key, *values, time, F.lit(1 - (tie == "existing")).alias("_w")))
    picked = F.max_by(F.struct(*values), F.struct(time, "_w"))
    out = both.groupBy(*key).agg(picked.alias("_v"), F.min(time).alias("first_seen"), F.max(time).alias("last_seen"))
    return out.select(*key, "_v.*", "first_seen", "last_seen")


def reconcile(known: DataFrame, reported: DataFrame, key: list[str], status: str = "status") -> DataFrame:
    """Status of all known and reported keys: the reported one, or ``missing`` for known keys that a complete report lacks."""
    a, b = known.select(*key, F.lit(True).alias("_known")).distinct(), reported.select(*key, F.col(status).alias("_status"))
    joined = a.join(b, key, "full_outer")
    return joined.select(*key, F.coalesce("_status", F.lit("missing")).alias(status), F.col("_known").isNotNull().alias("was_known"))


def unmatched(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys of one side only, with the side: both must be empty for a complete join."""
    a, b = left.select(*key).distinct(), right.select(*key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def last_wins(pages: DataFrame, key: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """The last row of each key over ordered pages, with how often it came and whether its payload changed."""
    by = Window.partitionBy(*key)
    said = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in payload])
    counted = pages.withColumns({"n": F.count("*").over(by), "conflict": F.min(said).over(by) != F.max(said).over(by)})
    return keep_one(counted, key, [F.col(c).desc() for c in order])


def temporal_cuts(days: DataFrame) -> DataFrame:
    """Cut points of a split by whole days (day, n): train_cut and val_cut as numbers of days.

    The cumulative count nearest to 60 per cent of the rows, but for the last two days, ends the
    training days; the one nearest to 80 per cent, but for the last day, the validation days.
    There is a row for each day, so the ordered window over all of them stays small.
    """
    everything = Window.orderBy("day")
    total = F.sum("n").over(Window.partitionBy())
    d = days.withColumns({"i": F.row_number().over(everything), "cum": F.sum("n").over(everything), "total": total, "days": F.count("*").over(Window.partitionBy())})
    train = d.where("i <= days - 2").agg(F.min_by("i", F.struct(F.abs(F.col("cum") - 0.6 * F.col("total")), "i")).alias("train_cut"))
    val = d.join(F.broadcast(train)).where("i > train_cut AND i <= days - 1")
    return val.groupBy("train_cut").agg(F.min_by("i", F.struct(F.abs(F.col("cum") - 0.8 * F.col("total")), "i")).alias("val_cut"))


def domain_counts(frame: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Rows of each value of a domain, 0 for those that don't come; other values don't count."""
    values = frame.sparkSession.createDataFrame([(x,) for x in domain], f"{column} string")
    n = frame.groupBy(column).agg(F.count("*").alias("n"))
    return values.join(n, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def nested_prefixes(frame: DataFrame, column: str) -> DataFrame:
    """Distinct scopes of which one begins another: scope, inner_scope.

    Each scope meets the others in an equi-join on its own beginnings, so no pairs are tried.
    """
    inner = frame.select(F.col(column).alias("inner_scope")).where(F.length("inner_scope") > 0).distinct()
    starts = inner.withColumn("scope", F.explode(F.transform(F.sequence(F.lit(1), F.length("inner_scope")), lambda n: F.col("inner_scope").substr(F.lit(1), n)))).where("scope <> inner_scope")
    return starts.join(inner.select(F.col("inner_scope").alias("scope")), "scope").select("scope", "inner_scope")


def changed(stored: DataFrame, arriving: DataFrame, key: list[str], payload: list[str]) -> DataFrame:
    """Keys that both sides have with different payloads; nulls equal each other."""
    side = lambda f, n: f.select(*key, F.struct(*payload).alias(n))
    return side(stored, "_a").join(side(arriving, "_b"), key).where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*key)
