"""Runs over several sources: each is walked within its budgets and committed by itself; one that fails leaves the others alone."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import BudgetError, ContractError, EngineError, SourceError
from tidemark.operators import contracts, inventory, store
from tidemark.operators.contracts import Limits
from tidemark.sources import portals, state, tables
from tidemark.sources.traversal import Cursor, Page, Range, Walk, walk

#: Fields of a preview row (fixed values).
PREVIEW = ("source", "listing_id", "price_pln", "area_m2", "rooms", "district", "floor", "build_year", "latitude", "longitude", "distance_km", "observed_at")


@dataclass
class Budget:
    """Counts requests, tries again and redirects among them, and refuses the one beyond the limit or the deadline."""

    most: int
    deadline: float | None = None
    clock: Callable[[], float] = time.monotonic
    used: int = 0

    def __call__(self, fetch: Callable[[Range], Page]) -> Callable[[Range], Page]:
        def counted(at: Range) -> Page:
            if self.used >= self.most:
                raise BudgetError("request_budget")
            if self.deadline is not None and self.clock() >= self.deadline:
                raise BudgetError("deadline")
            self.used += 1
            return fetch(at)

        return counted


@dataclass
class Outcome:
    """What became of one source: its walk and the frames to put in force, or a code for its failure."""

    walk: Walk | None = None
    capture: store.Capture | None = None
    failure: str | None = None
    requests: int = 0
    account: dict = field(default_factory=dict)


def run(spark: SparkSession, fetchers: dict[str, Callable[[Range], Page]], tables: dict[str, tuple[DataFrame, DataFrame, DataFrame]], progress: DataFrame, *, mode: str, owner: str, generation: str, at: Column, observed_at: str, paths: dict[str, str], cursors: dict[str, Cursor] | None = None, limits: Limits | None = None, values: tuple[str, ...] = ("price_pln", "area_m2")) -> dict[str, Outcome]:
    """Walk every source from its cursor and make its capture; ``tables``: each source's catalogue, history and current state.

    A source that spends its requests or its time ends with that reason in its account and keeps what
    was read. One whose pages can't be read fails as ``source_failed``, one whose rows or lease are
    refused as ``contract_failed``; the text of the error isn't kept, as it may hold what a page said.
    """
    limits = limits or Limits()
    out: dict[str, Outcome] = {}
    for source, fetch in sorted(fetchers.items()):
        budget = Budget(limits.requests)
        done = out[source] = Outcome()
        try:
            done.walk = walk((cursors or {}).get(source) or Cursor(source, mode), budget(fetch), max_pages=limits.pages, max_listings=limits.listings)
            done.account = {"source": source, "mode": mode, "observed_at": observed_at, "pages": done.walk.pages, "requests": budget.used, "listings": len(done.walk.rows), "reason": done.walk.reason}
            if wrong := contracts.capture_errors(done.account, source=source, mode=mode, observed_at=observed_at, limits=limits):
                raise ContractError("the capture's account", dict.fromkeys(wrong, 1))
            rows = [tuple(None if (x := r.get(n)) is None else str(x) for n in contracts.CATALOGUE) for r in done.walk.rows.values()]
            batch = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in contracts.CATALOGUE))
            catalogue, history, current = tables[source]
            done.capture = store.captured(catalogue, history, current, progress, batch, source=source, mode=mode, owner=owner, generation=generation, checkpoint=done.walk.cursor.text(), completed=done.walk.cursor.finished, at=at, paths=paths, values=list(values))
        except (SourceError, OSError):
            done.failure = "source_failed"
        except EngineError:
            done.failure = "contract_failed"
        done.requests = budget.used
    return out


def daily(spark: SparkSession, folder: str, previews: dict[str, DataFrame], tables_: dict[str, tuple[DataFrame, DataFrame]], *, rooms: tuple[int, int] = (1, 20), most: int = 50_000, values: tuple[str, ...] = ("price_pln", "area_m2")) -> dict[str, dict]:
    """The daily sample: each source's preview rows checked, merged into its price history, and reported by itself.

    ``previews``: rows of each source as strings with the fields ``PREVIEW``; ``tables_``: its history
    and current state. A source whose rows break the contract, are of several times or another source,
    or are too many is told as ``failed`` with the counts of what broke, and leaves its tables and the
    other sources alone. What was merged is written as one bundle a source; the report says what was new.
    """
    out: dict[str, dict] = {}
    for source, rows in sorted(previews.items()):
        history, current = tables_[source]
        try:
            checked = contracts.preview_reasons(rows.select(*[f for f in PREVIEW if f != "observed_at"]), tuple(f for f in PREVIEW if f != "observed_at"), rooms)
            contracts.demanded(checked, "preview rows")
            told = rows.agg(F.count("*").alias("n"), F.count_distinct("observed_at").alias("times"), F.count_if(~F.coalesce(F.col("source") == source, F.lit(False))).alias("others")).first()
            if told["n"] > most or told["times"] > 1 or told["others"]:
                raise ContractError("not one sample of the source", told.asDict())
            added, state, report = store.merged_prices(history, current, rows.select(*store.KEY, *values, store.TIME), list(values))
            save = lambda added=added, state=state, report=report, source=source: tables.save_bundle(spark, f"{folder}/{source}", {"appended": added, "current": state, "report": report})
            run_id = store.retried(save)
            said = tables.open_bundle(spark, f"{folder}/{source}", "report").first().asDict()
            out[source] = {"status": "ok", "exported": told["n"], "run": run_id} | said
        except EngineError as e:
            out[source] = {"status": "failed", "exported": 0, "counts": dict(getattr(e, "reasons", {}))}
    return out


def status_of(sources: dict[str, dict]) -> str:
    """``ok`` where all sources are, ``failed`` where none is, else ``partial``."""
    ok = [s["status"] == "ok" for s in sources.values()]
    return "ok" if all(ok) else "partial" if any(ok) else "failed"


def piloted(found: DataFrame, wrong: DataFrame, headers: DataFrame, current: DataFrame, history: DataFrame, *, source: str, scope: str, prefix: str, at: Column) -> inventory.Taken:
    """A pilot's reconciled units as a complete inventory snapshot; any verdict that forbids them refuses the whole of it."""
    told = {r["verdict"]: r["n"] for r in wrong.collect()}  # a row for each verdict
    if told:
        raise ContractError("the pilot's units don't reconcile", told)
    reported = found.select(F.concat(F.lit(prefix), "number").alias("listing_id"), "status")
    return inventory.taken(headers, current, history, reported, source=source, scope=scope, prefix=prefix, at=at, complete=True)


def pilot(pages: DataFrame, prices: DataFrame, *, observed_at: Column, city: str, investment: str, url_base: str, name: str = "apartments") -> tuple[DataFrame, DataFrame]:
    """(reconciled units, verdicts that forbid them) of a developer's pages and a price file's rows; pages without one agreed list count as ``unreadable_page``."""
    found = state.lists(pages, name)
    units = portals.unit_rows(found.where("reason IS NULL"), city=city, investment=investment, url_base=url_base)
    both = portals.reconciled(contracts.demanded(prices, "price file") if "reason" in prices.columns else prices, units, observed_at)
    broken = units.where("reason IS NOT NULL").select(F.col("reason").alias("verdict")).unionByName(found.where("reason IS NOT NULL").select(F.lit("unreadable_page").alias("verdict")))
    return both, portals.join_errors(both).unionByName(broken.groupBy("verdict").agg(F.count("*").alias("n")))
