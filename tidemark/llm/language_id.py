"""Language ID by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram's vector binds (multiplies) its letters'
vectors, each permuted (rotated) by its place; a document's vector bundles (adds) those of all
its n-grams, and a language's prototype bundles its documents', each divided by its number of
n-grams. A document gets the language whose prototype has the largest cosine; the score is that
cosine, at least 0. Whatever parts words counts as one more letter.

Letters are lower-cased and dealt by code point over ``LETTERS`` vectors, so the vectors have a
fixed size. Bundles of tasks are summed by Spark; what reaches the driver is one vector for
each language. Null texts and texts without a letter are ``und`` with score 0, and so are all
texts where nothing was learned. Ties go to the language that sorts first. Repeated rows are
judged alike, extra columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

WIDTH = 1024
LETTERS = 1024
GRAM = 3
UND = "und"


def letter_vectors(seed: int = 7) -> np.ndarray:
    """The vectors of all letters; row 0 is the word boundary's."""
    return np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (LETTERS, WIDTH))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its letter's number: 0 for what isn't a letter."""
    to = np.zeros(0x110000, np.int16)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            to[point] = 1 + (ord(c.lower()[0]) * 2654435761 >> 7) % (LETTERS - 1) if point > 0x24F else 1 + ord(c.lower()[0]) % (LETTERS - 1)
    return to


class Profiler:
    """n-grams of texts and their bound vectors."""

    def __init__(self, letters: np.ndarray):
        self.letter = _letters()
        self.turned = [np.roll(letters, GRAM - 1 - k, axis=1) for k in range(GRAM)]

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the distinct n-grams that hold a letter, and how often each occurs; empty without a letter."""
        points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.letter[points].astype(np.int64)
        keep = np.ones(len(letters), bool)
        keep[1:] = (letters[1:] > 0) | (letters[:-1] > 0)  # one boundary between words
        letters = np.concatenate([[0], letters[keep], [0]])
        if not letters.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        code = np.zeros(max(0, len(letters) - GRAM + 1), np.int64)
        for k in range(GRAM):
            code = code * LETTERS + letters[k : k + len(code)]
        return np.unique(code[code > 0], return_counts=True)

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        """A row for each n-gram: its letters' rotated vectors multiplied."""
        out = self.turned[GRAM - 1][grams % LETTERS].copy()
        for k in range(GRAM - 2, -1, -1):
            grams = grams // LETTERS
            out *= self.turned[k][grams % LETTERS]
        return out

    def bundles(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The vectors of several documents, from their n-grams and counts."""
        if not rows:
            return np.zeros((0, WIDTH), np.float32)
        every, place = np.unique(np.concatenate([g for g, _ in rows]), return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), [len(g) for g, _ in rows])
        order = np.argsort(place, kind="stable")
        place, owner, number = place[order], owner[order], np.concatenate([c for _, c in rows])[order]
        out = np.zeros((len(rows), WIDTH), np.float32)
        for k in range(0, len(every), 4096):  # a dense block of counts at a time, whatever the texts' lengths
            some = slice(*np.searchsorted(place, (k, k + 4096)))
            counts = np.zeros((len(rows), min(4096, len(every) - k)), np.float32)
            counts[owner[some], place[some] - k] = number[some]
            out += counts @ self.vectors(every[k : k + 4096]).astype(np.float32)
        return out


_profilers: dict[int, Profiler] = {}


def profiler(seed: int) -> Profiler:
    if seed not in _profilers:
        _profilers[seed] = Profiler(letter_vectors(seed))
    return _profilers[seed]


def learn(documents: DataFrame, *, text: str = "text", lang: str = "lang", seed: int = 7, most: int = 1000) -> dict[str, np.ndarray]:
    """Prototypes of all languages of the rows given; rows without a language or a letter teach nothing.

    A prototype of each language is held by the driver and sent to all tasks, so more than ``most`` are an error.
    """
    import pyarrow as pa

    def run(batches):
        own, sums = profiler(seed), {}
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams, n = own.grams(t)
                if len(grams):
                    for g, w in zip(grams.tolist(), (n / n.sum()).tolist(), strict=True):
                        sums.setdefault(name, {}).setdefault(g, 0.0)
                        sums[name][g] += w
            if sum(map(len, sums.values())) > 200_000:
                yield from flush(own, sums)
        yield from flush(own, sums)

    def flush(own, sums):
        for name, counted in sums.items():
            grams, weights = np.array(list(counted), np.int64), np.array(list(counted.values()))
            total = np.zeros(WIDTH)
            for k in range(0, len(grams), 4096):
                total += weights[k : k + 4096] @ own.vectors(grams[k : k + 4096])
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([total.tolist()], pa.list_(pa.float64()))], ["lang", "v"])
        sums.clear()

    parts = documents.where(F.col(lang).isNotNull()).select(lang, text).mapInArrow(run, "lang string, v array<double>")
    summed = parts.select("lang", F.posexplode("v").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))
    with common.batches_of(documents.sparkSession):
        found = summed.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} languages")
    return {r["lang"]: np.array([x["x"] for x in r["v"]]) for r in found}


def predict(documents: DataFrame, prototypes: dict[str, np.ndarray], *, key: str = "doc_id", text: str = "text", seed: int = 7, also: dict[str, Column] | None = None) -> DataFrame:
    """Language of every text: key, the columns of ``also``, lang_pred, score."""
    import pyarrow as pa

    names = sorted(prototypes)
    matrix = np.array([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-12) for n in names], np.float32).reshape(len(names), WIDTH)
    kept = [key, *(also or {})]

    def run(batches):
        own = profiler(seed)
        for batch in common.sliced(batches, 250):
            rows = [own.grams(t) for t in batch.column("_text").to_pylist()]
            said, score = [UND] * len(rows), [0.0] * len(rows)
            for k in range(0, len(rows), 125) if names else []:
                full = [j for j in range(k, min(k + 125, len(rows))) if len(rows[j][0])]
                bundle = own.bundles([rows[j] for j in full])
                cosine = (bundle @ matrix.T) / np.maximum(np.linalg.norm(bundle, axis=1, keepdims=True), 1e-12)
                for j, c in zip(full, cosine, strict=True):
                    best = int(c.argmax())
                    said[j], score[j] = names[best], float(min(max(c[best], 0.0), 1.0))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(said, pa.string()), pa.array(score, pa.float64())], [*kept, "lang_pred", "score"])

    given = documents.select(key, *(c.alias(n) for n, c in (also or {}).items()), F.col(text).alias("_text"))
    schema = ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in kept) + ", lang_pred string, score double"
    return given.mapInArrow(run, schema)
