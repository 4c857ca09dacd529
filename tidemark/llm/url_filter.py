"""URL filter: a ratio of two smoothed variable-order Markov models over characters.

URLs that a rule decides teach the models: allowed ones the accepting model, blocked ones
the rejecting model. Every other URL is judged by the difference of the two models'
log-likelihoods, divided by its length, against a threshold calibrated on a fifth of the
ruled URLs that the models haven't seen. Counts are taken over all rows; a model is a dense
array whose size depends on the alphabet and the order alone, so that is all that is sent.

Nulls and URLs without ``://``: host and path are empty, no rule fits, and the model judges
the empty text (score 0, which counts as allowed unless the threshold says otherwise).
Repeated rows are judged alike. Extra columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Symbols of the models: letters, any digit, the marks of URLs, anything else (fixed values).
MARKS = "./-_?=&#:%~+"
SYMBOLS = 26 + 1 + len(MARKS) + 2
START, OTHER = SYMBOLS - 1, SYMBOLS - 2
ORDER = 3


@dataclass(frozen=True)
class Rule:
    """``host/path`` prefix and what it says; it holds for the host and its subdomains."""

    prefix: str
    verdict: str

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.prefix.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty for null or where ``://`` is missing."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), common.UPPER, common.UPPER.lower())
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Prefix and verdict of the longest rule that fits; null where none does."""
    prefix = verdict = None
    for rule in sorted(rules, key=lambda r: (-len(r.prefix), r.prefix)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        prefix = F.when(fits, F.lit(rule.prefix)) if prefix is None else prefix.when(fits, F.lit(rule.prefix))
        verdict = F.when(fits, F.lit(rule.verdict)) if verdict is None else verdict.when(fits, F.lit(rule.verdict))
    if prefix is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return prefix, verdict


def _symbols() -> np.ndarray:
    to = np.full(128, OTHER, np.int64)
    for c in range(26):
        to[97 + c] = to[65 + c] = c
    to[48:58] = 26
    for k, c in enumerate(MARKS):
        to[ord(c)] = 27 + k
    return to


def codes(url: str | None) -> tuple[np.ndarray, np.ndarray]:
    """For each character of a URL the number of its context of ORDER symbols, and its own symbol."""
    points = np.frombuffer((url or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    own = np.where(points < 128, _TO[np.minimum(points, 127)], OTHER)
    padded = np.concatenate([np.full(ORDER, START), own])
    context = np.zeros(len(own), np.int64)
    for back in range(ORDER, 0, -1):
        context = context * SYMBOLS + padded[ORDER - back : ORDER - back + len(own)]
    return context, own


_TO = _symbols()
CELLS = SYMBOLS ** (ORDER + 1)


def count_cells(batches):
    """Map side: cells (class, context and symbol) of a task's URLs, each with its count."""
    import pyarrow as pa

    counts = np.zeros((2, CELLS), np.int32)
    for batch in common.sliced(batches):
        for url, accepted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            context, own = codes(url)
            np.add.at(counts[int(accepted)], context * SYMBOLS + own, 1)
    side, cell = np.nonzero(counts)
    if len(cell):
        yield pa.RecordBatch.from_arrays([pa.array(side * CELLS + cell, pa.int64()), pa.array(counts[side, cell].astype(np.int64))], ["cell", "n"])


def log_ratios(accepted: np.ndarray, rejected: np.ndarray) -> np.ndarray:
    """Log of the ratio of the two models' probabilities for each cell.

    Each model mixes the orders 0 to ORDER by Witten-Bell weights: a context seen n times
    with t different followers keeps n / (n + t) for itself and leaves the rest to the next
    shorter context; the shortest leaves it to the uniform distribution.
    """

    def model(counts: np.ndarray) -> np.ndarray:
        counts = counts.astype(np.float64).reshape((SYMBOLS,) * (ORDER + 1))
        below = np.full((SYMBOLS,), 1 / SYMBOLS)
        for order in range(ORDER + 1):
            here = counts.sum(axis=tuple(range(ORDER - order))) if order < ORDER else counts
            n, kinds = here.sum(-1, keepdims=True), (here > 0).sum(-1, keepdims=True)
            below = np.where(n > 0, (here + kinds * below) / np.maximum(n + kinds, 1), below)
        return below.ravel()

    return np.log(model(accepted) / model(rejected)).astype(np.float32)


def mean_ratio(url: str | None, ratios: np.ndarray) -> float:
    """Log-likelihood difference of a URL for each character; 0 for an empty one."""
    context, own = codes(url)
    return float(ratios[context * SYMBOLS + own].mean()) if len(own) else 0.0


def calibrated(scores: list[tuple[float, int, int]]) -> float:
    """The threshold with the best mean of both classes' shares that it judges right.

    ``scores``: value, accepted and rejected rows. Without rows of both classes: 0.
    """
    scores = sorted(scores)
    good, bad = sum(s[1] for s in scores), sum(s[2] for s in scores)
    if not good or not bad:
        return 0.0
    best, at, passed_good, passed_bad = 0.5, 0.0, good, bad
    for k, (value, a, r) in enumerate(scores):
        share = (passed_good / good + 1 - passed_bad / bad) / 2
        if share > best:
            best, at = share, value if k == 0 else (scores[k - 1][0] + value) / 2
        passed_good, passed_bad = passed_good - a, passed_bad - r
    return at


def filter_urls(pages: DataFrame, rules: list[Rule], *, key: str = "page_id", url: str = "url", bins_per_unit: int = 200) -> DataFrame:
    """Judge every URL: key, host, path, rule, verdict, score.

    ``bins_per_unit`` sets how finely scores are grouped for the calibration, which gathers
    counts for each bin only.
    """
    host, path = host_and_path(F.col(url))
    frame = pages.select(F.col(key), F.col(url).alias("_url"), host.alias("host"), path.alias("path"))
    prefix, said = rule_for(F.col("host"), F.col("path"), rules)
    frame = frame.withColumns({"rule": prefix, "_said": said})
    ruled = frame.where(F.col("_said").isNotNull()).select("_url", (F.col("_said") == "allow").alias("accepted"))
    unseen = common.fold("_url", 5) == 0
    cells = ruled.where(~unseen).mapInArrow(count_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(2 * CELLS)
    counts[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy()
    ratios = log_ratios(counts[CELLS:], counts[:CELLS])
    spark = pages.sparkSession
    sent = spark.sparkContext.broadcast(ratios)  # CELLS floats, whatever the input

    @F.pandas_udf("double")
    def score(urls):
        return urls.map(lambda u: mean_ratio(u, sent.value), na_action=None).astype("float64")

    held = ruled.where(unseen).select(F.floor(score("_url") * bins_per_unit).alias("bin"), "accepted")
    bins = held.groupBy("bin").agg(F.sum(F.col("accepted").cast("long")).alias("a"), F.sum((~F.col("accepted")).cast("long")).alias("r")).collect()
    threshold = calibrated([((b["bin"] + 0.5) / bins_per_unit, b["a"], b["r"]) for b in bins])
    return frame.withColumn("score", score("_url")).select(
        key, "host", "path", "rule", F.coalesce("_said", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"), "score"
    )
