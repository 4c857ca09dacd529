"""Tables that captures are merged into: reports of what was new, price history from a catalogue, whole captures, leases.

Every operator takes the tables as frames and gives the new ones; ``tidemark.sources.tables`` puts
several of them in force at once, which is what makes a capture atomic.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators import contracts, rows

KEY, TIME = ["source", "listing_id"], "observed_at"
T = TypeVar("T")
c = F.col


def create_missing(spark: SparkSession, name: str, schema: str, columns: dict[str, str] | None = None) -> DataFrame:
    """A catalogue table, created empty as Parquet if it isn't there; one that is there must have the columns asked for."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.saveAsTable(name, format="parquet", mode="ignore")
    found = spark.table(name)
    if lost := set(columns or {}) - set(found.columns):
        raise ContractError(f"table {name} lacks {sorted(lost)}")
    return found


def scan(frame: DataFrame, order: list[str], *, columns: list[str] | None = None, sources: tuple[str, ...] | None = None, limit: int | None = None) -> DataFrame:
    """An ordered scan of a snapshot: some sources, some columns; more rows than ``limit`` are an error, never cut."""
    from tidemark.sources.tables import at_most

    out = frame if sources is None else frame.where(c("source").isin(*sources))
    out = out.select(*(columns or out.columns))
    return (out if limit is None else at_most(out, limit)).orderBy(*order)


def merged_prices(history: DataFrame, current: DataFrame, batch: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows to append, current table, report of one row) after a batch of price records.

    The first payload of a (key, time) stays; only rows that enter the history move the current
    state, the newer or equal time wins. The report has seen_listings, new_listings,
    existing_listings, observations_inserted.
    """
    added = rows.append_first_wins(history, batch, [*KEY, TIME], [c(x) for x in values])
    latest = rows.keep_one(added, KEY, [c(TIME).desc()])
    old = current.select(*KEY, *values, c("last_seen").alias(TIME))
    state = rows.upsert(old, latest, KEY, values, TIME, "incoming")
    first = current.select(*KEY, c("first_seen").alias("_first"))
    early = added.groupBy(*KEY).agg(F.min(TIME).alias("_early"))
    state = state.join(first, KEY, "left").join(early, KEY, "left").withColumn("first_seen", F.least("first_seen", "_first", "_early")).drop("_first", "_early")
    fresh = added.select(*KEY).distinct().join(current.select(*KEY), KEY, "left_anti")
    seen = batch.select(*KEY).distinct().agg(F.count("*").alias("seen_listings")).withColumn("_k", F.lit(1))
    new = fresh.agg(F.count("*").alias("new_listings")).withColumn("_k", F.lit(1))
    put = added.agg(F.count("*").alias("observations_inserted")).withColumn("_k", F.lit(1))
    report = seen.join(new, "_k").join(put, "_k").select("seen_listings", "new_listings", (c("seen_listings") - c("new_listings")).alias("existing_listings"), "observations_inserted")
    return added, state, report


def priced(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows that are price records: price and area known."""
    return catalogue.where(c("price_pln").isNotNull() & c("area_m2").isNotNull())


@dataclass
class Capture:
    """Frames that are put in force together, and the cursor that goes with them."""

    catalogue: DataFrame
    appended: DataFrame
    current: DataFrame
    progress: DataFrame
    report: DataFrame


def captured(catalogue: DataFrame, history: DataFrame, current: DataFrame, progress: DataFrame, batch: DataFrame, *, source: str, mode: str, owner: str, generation: str, checkpoint: str, completed: bool, at: Column, paths: dict[str, str], values: list[str], max_checkpoint: int = 256 * 1024) -> Capture:
    """A capture's effect on all tables, or an error that leaves them as they were.

    The batch must keep its contract and be of one source; the lease must be held by ``owner``, of
    this ``generation`` and not run out at ``at``. The catalogue takes strictly newer rows, so that
    a replay changes nothing.
    """
    if len(checkpoint.encode()) > max_checkpoint:
        raise ContractError("the checkpoint is too large")
    clean = contracts.demanded(contracts.catalogue_reasons(batch, paths), "catalogue batch")
    if not clean.where(c("source") != source).isEmpty():
        raise ContractError("rows of another source")
    mine = (c("source") == source) & (c("mode") == mode)
    held = mine & (c("lease_owner") == owner) & (c("generation") == generation) & (c("lease_until") > at)
    if progress.where(held).isEmpty():
        raise ContractError("the lease is lost")
    names = [n for n in contracts.CATALOGUE if n not in (*KEY, TIME)]
    old = catalogue.select(*KEY, *names, c("last_seen").alias(TIME))
    newer = rows.upsert(old, clean.select(*KEY, *names, TIME), KEY, names, TIME, "existing")
    newer = newer.join(catalogue.select(*KEY, c("first_seen").alias("_f")), KEY, "left").withColumn("first_seen", F.least("first_seen", "_f")).drop("_f")
    added, state, report = merged_prices(history, current, priced(clean).select(*KEY, *values, TIME), values)
    put = lambda name, value: F.when(mine, value).otherwise(c(name)).alias(name)
    moved = {"checkpoint": F.lit(checkpoint), "completed": F.lit(completed), "updated_at": at, "last_error": F.lit(None).cast("string")}
    after = progress.select(*[put(n, moved[n]) if n in moved else c(n) for n in progress.columns])
    return Capture(newer, added, state, after, report)


def leased(progress: DataFrame, requests: DataFrame, hold: str = "INTERVAL 2 HOURS") -> DataFrame:
    """Progress rows after requests (source, mode, owner, at, generation, restart): one row for each scope, ``granted`` says who has it.

    A lease is granted where it is free, run out or held by the same owner; the earliest request
    wins, ties by owner. A restart takes a new generation and an empty cursor, so that a writer of
    the old generation can't commit any more. Scopes not seen before begin with the request's generation.
    """
    scope = ["source", "mode"]
    held = progress.withColumn("_known", F.lit(True))
    asked = requests.join(held.select(*scope, c("lease_owner").alias("_o"), c("lease_until").alias("_u")), scope, "left")
    free = c("_o").isNull() | (c("_o") == c("owner")) | (c("_u") <= c("at"))
    won = asked.where(free).groupBy(*scope).agg(F.min(F.struct("at", "owner", "generation", "restart")).alias("_w"))
    out = held.join(won, scope, "full_outer")
    begins = c("_w").isNotNull() & (c("_known").isNull() | c("_w.restart"))
    return out.select(
        *scope,
        F.when(begins, c("_w.generation")).otherwise(c("generation")).alias("generation"),
        F.when(begins, F.lit("{}")).otherwise(c("checkpoint")).alias("checkpoint"),
        F.when(begins, F.lit(False)).otherwise(c("completed")).alias("completed"),
        F.when(begins, c("_w.at")).otherwise(c("updated_at")).alias("updated_at"),
        F.coalesce("_w.owner", "lease_owner").alias("lease_owner"),
        F.coalesce(c("_w.at") + F.expr(hold), c("lease_until")).alias("lease_until"),
        F.when(begins, F.lit(None).cast("string")).otherwise(c("last_error")).alias("last_error"),
        c("_w").isNotNull().alias("granted"),
    )


def released(progress: DataFrame, releases: DataFrame, codes: tuple[str, ...] = ("source_failed", "database_failed")) -> DataFrame:
    """Progress after releases (source, mode, owner, error): only the holder releases, and leaves the code of what went wrong."""
    scope = ["source", "mode"]
    if not releases.where(c("error").isNotNull() & ~c("error").isin(*codes)).isEmpty():
        raise ContractError("an unknown error code")
    out = progress.join(releases.select(*scope, c("owner").alias("_owner"), c("error").alias("_error")).distinct(), scope, "left")
    mine = F.coalesce(c("lease_owner") == c("_owner"), F.lit(False))
    put = {"lease_owner": F.when(~mine, c("lease_owner")), "lease_until": F.when(~mine, c("lease_until")), "last_error": F.when(mine, c("_error")).otherwise(c("last_error"))}
    return out.select(*[put.get(n, c(n)).alias(n) for n in progress.columns])


def retried(action: Callable[[], T], *, tries: int = 3, wait: float = 1.0, passing: tuple[type[BaseException], ...] = (OSError, TimeoutError), sleep: Callable[[float], None] = time.sleep) -> T:
    """An action's result; passing failures are tried again after waits that double, others come through at once."""
    for attempt in range(1, tries + 1):
        try:
            return action()
        except passing:
            if attempt == tries:
                raise
            sleep(wait * 2 ** (attempt - 1))
    raise AssertionError("unreachable")
