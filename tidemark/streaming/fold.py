"""Micro-batches folded into current state: late rows enter, replayed ones don't count again, and nothing rolls the state back.

State and history lie in a ledger, dealt into hash buckets of the key. A batch finds its buckets (a
bounded number), reads the history and state of these alone, adds the events that history hasn't
seen, and commits the new history, the new state of these buckets and its own number in one entry.
A batch that was killed changes nothing; one that runs again after its commit is a replay. The
stream's checkpoint lies beside the ledger: a run that is given the folder of an earlier one goes on
where it stopped. No watermark drops late rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import work
from tidemark.sources.ledger import Change, Ledger, bucket

EVENT = ["user_id", "event_id"]
BUCKETS = 64
#: Parts that a bucket's history may have before they are written as one.
PARTS = 20


def reduced(events: DataFrame) -> DataFrame:
    """One row for each user: the latest event, first and last time, number of events."""
    return events.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("n"))


def merged(state: DataFrame, delta: DataFrame) -> DataFrame:
    both = state.unionByName(delta)
    return both.groupBy("user_id").agg(F.max_by("event_id", F.struct("last_seen", "event_id")).alias("event_id"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("n").alias("n"))


def unseen(events: DataFrame, history: DataFrame | None) -> DataFrame:
    """The first row of each event that history lacks."""
    once = events.groupBy(*EVENT).agg(F.min_by(F.struct(*events.columns), F.struct("ts")).alias("_e")).select("_e.*")
    return once if history is None else once.join(history, EVENT, "left_anti")


def step(ledger: Ledger, batch: DataFrame, number: str, buckets: int = BUCKETS) -> list[int]:
    """Fold one batch; returns the buckets that it read and wrote."""
    entry = ledger.entry()
    if entry.batches.get("fold") == number:
        return []
    mine = sorted(r[0] for r in batch.select(bucket(("user_id",), buckets)).distinct().collect())  # a row for each bucket
    if not mine:
        return []
    new = work.kept(unseen(batch, ledger.table("history", buckets=mine, entry=entry)), "fold-new")
    delta, before = reduced(new), ledger.table("state", buckets=mine, entry=entry)
    if before is not None:
        delta = merged(before, delta)
    by = {"by": ("user_id",), "buckets": buckets}
    ledger.commit({"history": Change(new.select(*EVENT), **by), "state": Change(delta, "replace", **by)}, scope="fold", batch=number, read=entry)
    work.forget(new)
    ledger.compacted("history", PARTS)
    return mine


def folded(spark: SparkSession, path: str, *, folder: str | None = None, files: int = 50) -> DataFrame:
    """Run the fold over the files of a folder (or one file) that it hasn't read, and return the state in force.

    ``folder``: where checkpoint and ledger are, shared by the cluster; without one, a new folder is
    made in the shared folder, and the run starts from nothing. ``files``: as many a batch.
    """
    base = folder or work.passing_folder(spark, "fold")
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():  # a stream reads folders
        reader, path = reader.option("pathGlobFilter", at.getName()), at.getParent().toString()
    stream = reader.parquet(path)
    running = stream.writeStream.foreachBatch(lambda batch, number: step(Ledger(batch.sparkSession, f"{base}/ledger"), batch, str(number)) and None).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    state = Ledger(spark, f"{base}/ledger").table("state")
    return reduced(spark.createDataFrame([], schema)) if state is None else state
