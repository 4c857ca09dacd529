"""Saved pages as a stream: parsed in executors, merged into the tables of a ledger, one commit a batch.

Pages lie in files of a folder. The stream's checkpoint is the cursor over the files; a batch is parsed
by a function from pages to listings with reasons, its accepted records are merged into catalogue,
price history and current prices, and all these, the progress row and the batch's account come into
force in one entry of the ledger, under the generation of the lease. A run that stops anywhere goes
on with the batch that wasn't committed; one that lost its lease to a newer generation commits nothing.
Only the buckets that a batch touches are read and written. No listing passes through the driver.

The account is observed while the parsed rows are written: pages, listings and refused rows are
counted by the same pass, and no second one is made for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import work
from tidemark.errors import ContractError
from tidemark.operators import contracts, store
from tidemark.operators.rows import keep_one
from tidemark.sources import pages as page_sources
from tidemark.sources.ledger import Change, Ledger, bucket

PAGE = "page_id long, url string, html string, observed_at string"
#: Tables are dealt by identity into so many buckets where a ledger is begun; it keeps that number.
BY, BUCKETS = ("listing_id",), 64
VALUES = ("price_pln", "area_m2")
ACCOUNT = "batch string, pages long, listings long, accepted long, inserted long"
c = F.col


def parsed(pages: DataFrame, latest_year: int = 2100) -> DataFrame:
    """Listings of JSON-LD pages as catalogue records with their page and reason."""
    found = page_sources.listing_rows(pages.select("page_id", "url", "html"), latest_year=latest_year)
    return found.join(pages.select("page_id", "observed_at").distinct(), "page_id")


def records(found: DataFrame) -> DataFrame:
    """Accepted rows as the catalogue's texts, the last page's of each identity and time."""
    known = [n for n in contracts.CATALOGUE if n in found.columns]
    last = keep_one(found.where("reason IS NULL"), ["source", "listing_id", "observed_at"], [c("page_id").desc(), c("position").desc()])
    return last.select(*[(c(n).cast("string") if n in known else F.lit(None).cast("string")).alias(n) for n in contracts.CATALOGUE])


def _tables(ledger: Ledger, entry, mine: list[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Catalogue, history and current prices of some buckets, empty where the ledger hasn't them yet."""
    spark = ledger.spark
    texts = [n for n in contracts.CATALOGUE if n != "observed_at"]
    schemas = {
        "catalogue": ", ".join(f"{n} string" for n in (*texts, "first_seen", "last_seen")),
        "history": ", ".join(f"{n} string" for n in ("source", "listing_id", *VALUES, "observed_at")),
        "current": ", ".join(f"{n} string" for n in ("source", "listing_id", *VALUES, "first_seen", "last_seen")),
    }
    found = [ledger.table(n, buckets=mine, entry=entry) for n in schemas]
    return tuple(f if f is not None else spark.createDataFrame([], s) for f, s in zip(found, schemas.values(), strict=True))


def leased(ledger: Ledger, *, source: str, mode: str, owner: str, generation: int, at: int, hold: int = 7200) -> None:
    """Take or renew the lease of a source's scope; a newer generation takes it from an older one."""
    entry = ledger.entry()
    if generation < entry.generations.get(f"{source}/{mode}", generation):
        raise ContractError("a newer generation holds this scope")
    row = ledger.spark.createDataFrame([(source, mode, str(generation), entry.cursors.get(f"{source}/{mode}", "{}"), False, at, owner, at + hold, None)], "source string, mode string, generation string, checkpoint string, completed boolean, updated_at long, lease_owner string, lease_until long, last_error string")
    rest = ledger.table("progress", entry=entry)
    if rest is not None:
        row = rest.where((c("source") != source) | (c("mode") != mode)).unionByName(row)
    ledger.commit({"progress": Change(row, "replace")}, scope=f"{source}/{mode}", batch=f"lease-{generation}-{owner}-{at}", generation=generation, read=entry)


def taken(ledger: Ledger, batch: DataFrame, number: str, *, source: str, mode: str, owner: str, generation: int, at: int, paths: dict[str, str], parse: Callable[[DataFrame], DataFrame] = parsed, buckets: int = BUCKETS, before_log: Callable[[], None] | None = None) -> dict:
    """One batch of pages merged and committed; returns its account. A batch committed before changes nothing."""
    spark, scope, entry = ledger.spark, f"{source}/{mode}", ledger.entry()
    if entry.batches.get(scope) == number:
        return {"batch": number, "replay": True}
    seen = Observation(f"capture-{number}")
    found = work.kept(parse(batch).observe(seen, F.count("*").alias("listings"), F.count_if(c("reason").isNull()).alias("accepted")), "captured-rows")
    account = dict(seen.get) | {"batch": number, "pages": found.select("page_id").distinct().count()}
    ready = records(found)  # several times of an identity where a batch has them: all enter the history, the last one the catalogue
    mine = sorted(r[0] for r in ready.select(bucket(BY, buckets)).distinct().collect())  # a row for each bucket
    catalogue, history, current = _tables(ledger, entry, mine)
    progress = ledger.table("progress", entry=entry)
    if progress is None:
        raise ContractError("the lease is lost")
    last = keep_one(ready, store.KEY, [c("observed_at").desc()])
    done = store.captured(catalogue, history, current, progress, last, source=source, mode=mode, owner=owner, generation=str(generation), checkpoint=f'{{"batch":{number}}}', completed=False, at=F.lit(at), paths=paths, values=list(VALUES))
    began = ready.groupBy(*store.KEY).agg(F.min("observed_at").alias("_began"))
    listed = done.catalogue.join(began, store.KEY, "left").withColumn("first_seen", F.least("first_seen", "_began")).drop("_began")
    added, state, _ = store.merged_prices(history, current, store.priced(ready).select(*store.KEY, *VALUES, store.TIME), list(VALUES))
    put = Observation(f"history-{number}")
    by = {"by": BY, "buckets": buckets}

    def told() -> DataFrame:
        """The account's row, once the history is written and has counted itself."""
        account["inserted"] = put.get["inserted"]
        return spark.createDataFrame([tuple(account[n] for n in ("batch", "pages", "listings", "accepted", "inserted"))], ACCOUNT)

    changes = {"catalogue": Change(listed, "replace", **by), "history": Change(added.observe(put, F.count("*").alias("inserted")), **by), "current": Change(state, "replace", **by), "progress": Change(done.progress, "replace"), "accounts": Change(told)}
    ledger.commit(changes, scope=scope, batch=number, generation=generation, cursor=f'{{"batch":{number}}}', read=entry, before_log=before_log)
    work.forget(found)
    return account


def run(spark: SparkSession, pages: str, folder: str, *, source: str, owner: str, generation: int, paths: dict[str, str], mode: str = "full", at: int = 0, files: int = 10, parse: Callable[[DataFrame], DataFrame] = parsed, buckets: int = BUCKETS) -> Ledger:
    """Take all pages that are there and weren't taken, ``files`` of them a batch; the ledger after it."""
    ledger = Ledger(spark, f"{folder}/ledger")
    leased(ledger, source=source, mode=mode, owner=owner, generation=generation, at=at)
    stream = spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files).parquet(pages)

    def step(batch: DataFrame, number: int) -> None:
        taken(Ledger(batch.sparkSession, f"{folder}/ledger"), batch, str(number), source=source, mode=mode, owner=owner, generation=generation, at=at, paths=paths, parse=parse, buckets=buckets)

    running = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/checkpoint-{source}-{mode}").trigger(availableNow=True).start()
    running.awaitTermination()
    return ledger
