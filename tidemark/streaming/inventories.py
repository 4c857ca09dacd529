"""Inventory snapshots as a stream with keyed state: one state for each scope, for any order of arrival.

Each row is one snapshot of a scope, with its units. The state of a scope holds the digests of its
snapshots by time, the time of the last one, and each unit's status with when it was last seen. A
snapshot of an older time, a replay, a conflict (another snapshot of a time that is known), and one
that is partial, empty or repeats an id change nothing and are told with their reason; a new one
settles the scope: reported units are seen, all others known turn ``missing``. What comes out is a row
for each unit and snapshot that was taken, and one without a unit for each that was refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SNAPSHOT = "scope string, observed_at long, complete boolean, units array<struct<listing_id: string, status: string>>"
TOLD = "scope string, observed_at long, verdict string, listing_id string, status string, last_seen_at long"
#: The state store that keyed state needs.
PROVIDER = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The session's settings for queries with keyed state, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in PROVIDER}
    try:
        for k, v in PROVIDER.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def digest(units: list[tuple[str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{i}\t{s}" for i, s in sorted(units)).encode()).hexdigest()


class Scope(StatefulProcessor):
    """The state of one scope and what a snapshot does to it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.digests = handle.getMapState("digests", "observed_at long", "digest string")
        self.last = handle.getValueState("last", "observed_at long")
        self.units = handle.getMapState("units", "listing_id string", "status string, last_seen_at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803
        import pandas as pd

        frames = pd.concat(list(rows), ignore_index=True)
        out: list[tuple] = []
        # a batch reads a scope's units once and writes each that changed once, whatever its snapshots
        before: dict[str, tuple] | None = None
        now: dict[str, tuple] = {}
        for at, complete, units in sorted(zip(frames["observed_at"], frames["complete"], frames["units"], strict=True), key=lambda r: r[0]):
            told = [(u["listing_id"], u["status"]) for u in (units if units is not None else [])]
            verdict = self._verdict(int(at), bool(complete), told)
            if verdict == "new":
                if before is None:
                    before = {k[0]: tuple(v) for k, v in self.units.iterator()}
                    now = dict(before)
                out += self._settled(key[0], int(at), told, now)
            else:
                out.append((key[0], int(at), verdict, None, None, None))
        for ident, value in now.items():
            if before.get(ident) != value:
                self.units.updateValue((ident,), value)
        names = [c.split()[0] for c in TOLD.split(", ")]
        yield pd.DataFrame(out, columns=names).astype({"observed_at": "Int64", "last_seen_at": "Int64"})

    def _verdict(self, at: int, complete: bool, told: list) -> str:
        if not complete:
            return "partial"
        if not told or len({i for i, _ in told}) < len(told) or any(i is None for i, _ in told):
            return "not_one_row_for_each_id"
        if self.digests.containsKey((at,)):
            return "replay" if self.digests.getValue((at,))[0] == digest(told) else "conflict"
        return "older" if self.last.exists() and self.last.get()[0] > at else "new"

    def _settled(self, scope: str, at: int, told: list, now: dict[str, tuple]) -> list[tuple]:
        """The units after a new snapshot, in ``now`` as well."""
        self.digests.updateValue((at,), (digest(told),))
        self.last.update((at,))
        here = {i: (s, at) for i, s in told}
        for known, (_, seen) in list(now.items()):
            here.setdefault(known, ("missing", seen))
        now.update(here)
        return [(scope, at, "new", i, s, seen) for i, (s, seen) in sorted(now.items())]

    def close(self) -> None:
        pass


def settled(snapshots: DataFrame) -> DataFrame:
    """What becomes of a stream (or a table) of snapshots; see ``TOLD``. A batch's snapshots of a scope are taken by their times."""
    return snapshots.groupBy("scope").transformWithStateInPandas(statefulProcessor=Scope(), outputStructType=TOLD, outputMode="Update", timeMode="None")


def current(told: DataFrame) -> DataFrame:
    """The state in force after all that was told: scope, listing_id, status, last_seen_at, of each scope's last snapshot taken."""
    new = told.where("verdict = 'new'")
    last = new.groupBy("scope").agg(F.max("observed_at").alias("observed_at"))
    return new.join(last, ["scope", "observed_at"]).select("scope", "listing_id", "status", "last_seen_at")
