"""Keyed inventory state is read once and written once a batch for each unit."""

import pandas as pd

from tidemark.streaming.inventories import Scope


class Kept:
    def __init__(self):
        self.held, self.reads, self.writes = {}, 0, 0

    def updateValue(self, key, value):
        self.writes += 1
        self.held[key] = value

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held[key]

    def iterator(self):
        self.reads += 1
        return iter(list(self.held.items()))

    def exists(self):
        return bool(self.held)

    def get(self):
        return self.held[()]

    def update(self, value):
        self.held[()] = value


def test_units_are_read_and_written_once_a_batch():
    scope = Scope()
    scope.digests, scope.last, scope.units = Kept(), Kept(), Kept()
    units = lambda *names: [{"listing_id": n, "status": "available"} for n in names]
    first = pd.DataFrame({"observed_at": [3, 1, 2], "complete": [True] * 3, "units": [units("a"), units("a", "b"), units("b", "c")]})
    (told,) = scope.handleInputRows(("s",), iter([first]), None)
    assert len(told) == 2 + 3 + 3 and (scope.units.reads, scope.units.writes) == (1, 3)
    assert scope.units.held == {("a",): ("available", 3), ("b",): ("missing", 2), ("c",): ("missing", 2)}
    again = pd.DataFrame({"observed_at": [4, 3], "complete": [True] * 2, "units": [units("a", "b"), units("b")]})
    (told,) = scope.handleInputRows(("s",), iter([again]), None)
    assert sorted(zip(told["verdict"], told["listing_id"].fillna(""))) == [("conflict", ""), ("new", "a"), ("new", "b"), ("new", "c")]
    assert scope.units.reads == 2 and scope.units.writes == 5 and scope.units.held[("c",)] == ("missing", 2)
