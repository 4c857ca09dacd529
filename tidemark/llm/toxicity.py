"""Toxicity: a lexicon trie met by Levenshtein automata, and scores of the words around each hit.

The lexicon (terms, and stems that stand for all words beginning with them) and the weights
come from a bounded sample of labelled rows. All terms' Levenshtein automata are run at once
over the trie, as one automaton whose states are sets of (trie node, edits), made as they are
needed; a word of five letters or more is a hit if it is a term, begins with a stem, or is one
edit from a term. A hit counts as quoted if it stands between an opening mark and the one that
closes it, both in one context window. Counts of plain, quoted and misspelled hits, their weights and their density
go into a logistic regression, fitted on the same sample.

Whole texts are read, very long ones too. Null and empty texts have no hits. Without labelled rows of both kinds
nothing is learned and every score is 0. Repeated rows are judged alike, extra columns are
ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Marks stripped from both ends of a word, and those that open or close a quotation (fixed values).
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#%&$-_«»„“”‘’`~"
#: Opening marks and those that close them.
PAIRS = {'"': '"', "'": "'", "«": "»", "»": "«", "„": "“”", "“": "”", "‘": "’", "‚": "‘’"}
MARKS = "\"'«»„“”‘’‚"
#: Words that a quotation may hold: the context window of a hit.
CONTEXT = 40
FEATURES = 9
STEMS = (4, 5, 6)
STATES = 200_000


class Trie:
    """Terms and stems, and the automaton of all words within one edit of a term."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float], fuzzy_from: int = 5):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[float | None] = [None]
        self.stem: list[float | None] = [None]
        self.long: list[bool] = [False]
        for words, weights in ((terms, self.term), (stems, self.stem)):
            for word, weight in words.items():
                at = 0
                for c in word:
                    if c not in self.children[at]:
                        self.children[at][c] = len(self.children)
                        self.children.append({})
                        self.term.append(None)
                        self.stem.append(None)
                        self.long.append(False)
                    at = self.children[at][c]
                weights[at] = weight
                self.long[at] = len(word) >= fuzzy_from
        self._reset()

    def _reset(self) -> None:
        self.sets: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.steps: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """The state of a set of nodes with the fewest edits each, letters of terms left out (insertions) followed."""
        for node, edits in list(nodes.items()):
            if edits == 0:
                for child in self.children[node].values():
                    nodes.setdefault(child, 1)
        key = tuple(sorted(nodes.items()))
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        """Read a character: follow it, or spend the one edit on another letter or on none."""
        reached: dict[int, int] = {}
        for node, edits in self.sets[state]:
            if (child := self.children[node].get(c)) is not None:
                reached[child] = min(edits, reached.get(child, 9))
            if edits == 0:
                reached[node] = min(1, reached.get(node, 9))
                for child in self.children[node].values():
                    reached[child] = min(1, reached.get(child, 9))
        return self._state(reached)

    def find(self, word: str) -> tuple[float, bool] | None:
        """Weight of the term or stem that a word is a hit of, and whether it is misspelled."""
        if len(self.sets) > STATES:
            self._reset()
        state, stem, node = self.start, None, 0
        for c in word:
            if (following := self.steps[state].get(c)) is None:
                following = self.steps[state][c] = self._step(state, c)
            state = following
            if node >= 0:
                node = self.children[node].get(c, -1)
                if node >= 0 and self.stem[node] is not None and stem is None:
                    stem = self.stem[node]
            if stem is None and not self.sets[state]:
                return None
        if node >= 0 and self.term[node] is not None:
            return self.term[node], False
        if stem is not None:
            return stem, False
        near = [self.term[n] for n, _ in self.sets[state] if self.term[n] is not None and self.long[n]] if len(word) >= 5 else []
        return (max(near), True) if near else None


@dataclass
class Model:
    """Lexicon and weights; ``weights`` is None where nothing was learned."""

    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray | None = None


class Scorer:
    """A worker's trie, with what it found for the words it has met."""

    def __init__(self, model: Model):
        self.trie, self.weights = Trie(model.terms, model.stems), model.weights
        self.known: dict[str, tuple[float, bool] | None] = {}

    def hits(self, text: str | None) -> tuple[list[tuple[int, float, bool, bool]], int]:
        """(place, weight, misspelled, quoted) of each hit; and the number of words."""
        words = (text or "").lower().split()
        known = self.known
        if len(known) > 300_000:
            known.clear()
        found = set()
        for word in set(words):
            if word not in known:
                known[word] = self.trie.find(word.strip(PUNCTUATION))
            if known[word] is not None:
                found.add(word)
        out = []
        if found:
            quoted = quotations(words)
            for k, word in enumerate(words):
                if word in found:
                    weight, misspelled = known[word]
                    out.append((k, weight, misspelled, quoted is not None and quoted[k]))
        return out, len(words)

    def features(self, text: str | None) -> list[float]:
        return self.summed(*self.hits(text))

    @staticmethod
    def summed(hits: list[tuple[int, float, bool, bool]], n: int) -> list[float]:
        plain = [h for h in hits if not h[2] and not h[3]]
        quoted = [h for h in hits if not h[2] and h[3]]
        wrong = [h for h in hits if h[2] and not h[3]]
        wrong_quoted = [h for h in hits if h[2] and h[3]]
        return [
            1.0,
            float(bool(plain)),
            math.log1p(len(plain)),
            math.log1p(len(quoted)),
            math.log1p(len(wrong)),
            math.log1p(len(wrong_quoted)),
            min(1.0, 10 * len(hits) / max(1, n)),
            max((h[1] for h in plain), default=0.0) / 5,
            max((h[1] for h in wrong), default=0.0) / 5,
        ]

    def score(self, text: str | None) -> tuple[float, int]:
        """Score of a text, and its hits."""
        hits, n = self.hits(text)
        if self.weights is None:
            return 0.0, len(hits)
        z = float(np.dot(self.weights, self.summed(hits, n)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), len(hits)


def quotations(words: list[str]) -> list[bool] | None:
    """Which words stand in a quotation; None where no word does.

    Marks are paired in reading order. A word that begins with a mark opens a quotation, one that ends
    with the mark that fits (sentence marks aside) closes the innermost of that kind, and what was
    opened inside it stays unclosed. A mark that stands alone closes if it can, and else opens. Words
    from opening to closing are quoted, at most ``CONTEXT`` of them; a mark without its pair quotes nothing.
    """
    open_: list[tuple[str, int]] = []
    found: list[tuple[int, int]] = []

    def close(mark: str, at: int) -> bool:
        fits = [k for k, (o, _) in enumerate(open_) if mark in PAIRS[o]]
        if not fits:
            return False
        start = open_[fits[-1]][1]
        del open_[fits[-1] :]
        if at - start < CONTEXT:
            found.append((start, at))
        return True

    for k, word in enumerate(words):
        if not any(m in word for m in MARKS):
            continue
        ends = word.rstrip(".,;:!?")
        if len(ends) == 1 and ends in MARKS:
            if not close(ends, k) and ends in PAIRS:
                open_.append((ends, k))
            continue
        for mark in word:
            if mark not in PAIRS:
                break
            open_.append((mark, k))
        if core := ends.rstrip(MARKS):
            for mark in ends[len(core) :]:
                close(mark, k)
    if not found:
        return None
    out = [0] * (len(words) + 1)
    for start, end in found:
        out[start] += 1
        out[end + 1] -= 1
    return [n > 0 for n in itertools.accumulate(out[:-1])]


def _candidates(text: str | None) -> set[tuple[str, int]]:
    """Words that a text uses unquoted somewhere, as (word, 0), and the beginnings of the longer ones as (stem, 1)."""
    used = (text or "").lower().split()
    quoted = quotations(used)
    plain = set(used) if quoted is None else {w for w, q in zip(used, quoted, strict=True) if not q}
    words = {w for w in (x.strip(PUNCTUATION) for x in plain) if w}
    return {(w, 0) for w in words} | {(w[:n], 1) for w in words for n in STEMS if len(w) > n}


def _stems(stems: dict[str, tuple[int, float]], terms: dict[str, int]) -> dict[str, float]:
    """Stems that stand for many words: of a family the longest that loses nearly none of its texts, and none that one term explains."""
    out = {}
    for stem, (n, weight) in stems.items():
        one = max((k for t, k in terms.items() if t.startswith(stem)), default=0)
        longer = any(s != stem and s.startswith(stem) and k >= 0.95 * n for s, (k, _) in stems.items())
        if n >= 1.5 * one and not longer:
            out[stem] = weight
    return {s: w for s, w in out.items() if not any(s[:n] in out for n in range(1, len(s)))}


def regression(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, turns: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) / len(y) + l2 * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(y) + l2 * np.eye(len(w)), grad)
    return w


def learn(documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", toxic: str = "toxic", fit_rows: int = 12_000, least: int = 4, purity: float = 5.0) -> Model:
    """Lexicon and weights from about ``fit_rows`` labelled rows, chosen by a hash of their key; equal texts count once.

    A term or stem needs ``least`` toxic texts that use it unquoted, a share among them ``purity``
    times that among the others, and a log-likelihood ratio that chance seldom reaches among so
    many candidates. Quoted use doesn't count for the lexicon, on either side; what it means for
    a text is left to the regression.
    """
    import pyarrow as pa

    spark = documents.sparkSession
    known = labels.where(F.col(toxic).isin(0, 1)).select(key, F.col(toxic).cast("int").alias("_toxic"))
    total = known.count()
    if not total:
        return Model()
    known = known.where(F.pmod(F.xxhash64(key, F.lit("toxicity")), F.lit(1_000_000)) < int(1e6 * min(1.0, fit_rows / total)))
    sample = common.stored(documents.select(key, F.col(text).alias("_text")).join(known, key).select("_toxic", "_text").distinct(), "toxicity-sample")

    def count(batches):
        counts = (Counter(), Counter())
        for batch in batches:
            for label, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[label].update(_candidates(t))
                counts[label]["", 2] += 1
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield from flush(counts)
        yield from flush(counts)

    def flush(counts):
        for label in (0, 1):
            both = list(counts[label])
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in both], pa.string()), pa.array([k for _, k in both], pa.int32()), *(pa.array([n if label == side else 0 for n in counts[label].values()], pa.int64()) for side in (0, 1))], ["word", "kind", "clean", "toxic"])
            counts[label].clear()

    counted = sample.mapInArrow(count, "word string, kind int, clean long, toxic long").groupBy("word", "kind").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = common.stored(counted.where((F.col("toxic") >= least) | (F.col("kind") == 2)), "toxicity-terms")
    rows = counted.where("kind = 2").collect()
    clean, bad = (rows[0]["clean"], rows[0]["toxic"]) if rows else (0, 0)
    if not clean or not bad:
        common.forget(sample, counted)
        return Model()
    ratio = (F.col("toxic") / bad) / ((F.col("clean") + 0.5) / clean)
    chance = F.log(F.lit((clean + bad) / bad)) * F.col("toxic") * 2  # for terms that are all but absent elsewhere
    chance = chance + F.when(F.col("clean") > 0, 2 * F.col("toxic") * F.log(F.col("toxic") / (F.col("toxic") + F.col("clean"))) + 2 * F.col("clean") * F.log(F.col("clean") * (clean + bad) / (F.col("toxic") + F.col("clean")) / clean)).otherwise(0)
    surely = chance >= 2 * math.log(200 * (clean + bad)) + 16
    best = counted.where((F.col("kind") < 2) & (ratio >= purity) & surely).withColumn("ratio", ratio).collect()  # terms of the bounded sample
    stems = _stems({r["word"]: (r["toxic"], math.log(r["ratio"])) for r in best if r["kind"] == 1}, {r["word"]: r["toxic"] for r in best if r["kind"] == 0})
    terms = {r["word"]: math.log(r["ratio"]) for r in best if r["kind"] == 0}
    model = Model(terms, stems)

    def rows_of(batches):
        scorer = Scorer(model)
        for batch in batches:
            x = [scorer.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    with common.batches_of(spark):
        found = sample.mapInArrow(rows_of, "y int, x array<double>").groupBy("y", "x").agg(F.count("*").alias("n")).collect()
    found = sorted((r["y"], tuple(r["x"]), r["n"]) for r in found)
    x = np.repeat(np.array([f[1] for f in found]), [f[2] for f in found], axis=0)
    y = np.repeat(np.array([f[0] for f in found], float), [f[2] for f in found])
    common.forget(sample, counted)
    return Model(terms, stems, regression(x, y))


def score(documents: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", also: dict[str, Column] | None = None, threshold: float = 0.3) -> DataFrame:
    """Score of every text: key, the columns of ``also``, score, predicted, n_hits."""
    import pyarrow as pa

    kept = [key, *(also or {})]

    def run(batches):
        scorer = Scorer(model)
        for batch in common.sliced(batches):
            both = [scorer.score(t) for t in batch.column("_text").to_pylist()]
            scores = [s for s, _ in both]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array([n for _, n in both], pa.int64())],
                [*kept, "score", "predicted", "n_hits"],
            )

    given = documents.select(key, *(c.alias(n) for n, c in (also or {}).items()), F.col(text).alias("_text"))
    schema = ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in kept) + ", score double, predicted int, n_hits long"
    return given.mapInArrow(run, schema)
