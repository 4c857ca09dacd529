"""Quality rules: base counts of a text, and a linear-chain CRF that labels its lines.

Every line with a word is labelled content or boilerplate by Viterbi decoding; a document stays
if the base rules pass and content lines hold at least ``share`` of its words.

The CRF is fitted on a bounded sample of documents with a quality label. No line has a label of
its own: labels are hidden, and what is known of them is soft evidence, as odds. Lines of a good
document are mostly content and those of a bad one mostly boilerplate; a line that repeats an
earlier one, or is full of symbols, is likely boilerplate wherever it stands. The fit maximises
the likelihood of that evidence over all labellings of each whole document (expectation by
forward-backward with and without the evidence; L2), so that labels may change within a document
and the steps between them are learned. Without labelled rows of both kinds every line counts as
content. All lines of the sampled documents are used.

Null and empty texts have no words and so fail. Ties in decoding go to content. Repeated rows
are judged alike, extra columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Characters that count as symbols (fixed values).
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FEATURES = 12
BOILERPLATE, CONTENT = 0, 1
#: Places of features that are evidence by themselves, and what each kind of evidence says: log
#: odds for content of a line in a good and in a bad document, of a repeated line, and of a line
#: with more than a tenth of its bytes symbols.
SYMBOL_SHARE, REPEATED = 2, 10
ODDS_GOOD, ODDS_BAD, ODDS_REPEATED, ODDS_SYMBOLS, MANY_SYMBOLS = 3.0, -3.0, -4.0, -4.0, 0.1


@dataclass(frozen=True)
class Crf:
    """Weights of both labels for each feature, and of each step from label to label."""

    emit: np.ndarray
    step: np.ndarray

    @classmethod
    def empty(cls) -> Crf:
        return cls(np.zeros((FEATURES, 2)), np.zeros((2, 2)))

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        """The likeliest labels of a document's lines."""
        score = x @ self.emit
        n = len(score)
        best, back = score[0].copy(), np.zeros((n, 2), np.int8)
        s00, s01, s10, s11 = self.step.ravel().tolist()
        b0, b1 = best.tolist()
        for k, (e0, e1) in enumerate(score[1:].tolist(), 1):
            to0, to1 = (b0 + s00, b1 + s10), (b0 + s01, b1 + s11)
            back[k] = (to0[1] >= to0[0], to1[1] >= to1[0])
            b0, b1 = max(to0) + e0, max(to1) + e1
        labels = np.empty(n, np.int8)
        labels[-1] = b1 >= b0
        for k in range(n - 1, 0, -1):
            labels[k - 1] = back[k, labels[k]]
        return labels


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur at least twice in the list, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    if len(number) == len(words):
        return 0
    ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ids ^= ids >> np.uint64(29)
    ids *= np.uint64(0xBF58476D1CE4E5B9)
    ids ^= ids >> np.uint64(32)
    mixed, factor = np.zeros(n, np.uint64), 0xD6E8FEB86659FD93
    for k in range(window):
        mixed = mixed * np.uint64(factor) + ids[k : k + n]
    _, inverse, counts = np.unique(mixed, return_inverse=True, return_counts=True)
    at = np.nonzero(counts[inverse] > 1)[0]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return int((np.cumsum(change)[:-1] > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int, list[bytes], list[bool]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; then the lines with a word, and which of them are repeats."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, common.WORD_BREAKS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines, again = [], []
    for line in raw.split(b"\n"):
        if line.strip(common.WORD_BREAKS):
            lines.append(line)
            again.append(line in seen)
            seen.add(line)
    return len(words), len(text or "") - spaces, symbols, sum(again), repeated_words(words), lines, again


def line_features(line: bytes, again: bool) -> tuple[list[float], int]:
    """Features of a line, and its words."""
    words = line.split()
    n, size = len(words), max(1, len(line))
    text = line.decode("utf-8", "replace")
    letters = sum(map(str.isalpha, text)) or 1
    upper = sum(map(str.isupper, text))
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        1.0,
        min(np.log1p(n) / 4, 2.0),
        (size - len(line.translate(None, b"#*$%&<>"))) / size * 10,
        line.count(b"|") / n * 2,
        line.count(b"!") / n * 2,
        upper / letters * 3,
        (size - len(line.translate(None, b"0123456789"))) / size * 5,
        1 - len(set(words)) / n,
        same / n * 3,
        min(len(text) / n / 10, 3.0),
        float(again),
        float(line.rstrip()[-1:] in (b".", b"!", b"?")),
    ], n


def features(lines: list[bytes], again: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    both = [line_features(*x) for x in zip(lines, again, strict=True)]
    return np.array([b[0] for b in both]).reshape(-1, FEATURES), np.array([b[1] for b in both], np.int64)


def _scan(step: np.ndarray, first: np.ndarray, longest: int) -> np.ndarray:
    """Products of each chain's 2 x 2 steps from its first line up to each line, scaled to 1; ``first`` marks chains' first lines.

    Doubling spans: as many passes as the binary logarithm of the longest chain.
    """
    out = step / step.max((1, 2), keepdims=True)
    whole = first.copy()  # whether the product reaches back to its chain's first line
    reach = 1
    while reach < longest:
        open_ = np.nonzero(~whole[reach:])[0] + reach
        out[open_], whole[open_] = (made := out[open_ - reach] @ out[open_]) / made.max((1, 2), keepdims=True), whole[open_ - reach]
        reach *= 2
    return out


def marginals(score: np.ndarray, step: np.ndarray, first: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each line's labels, and of each step's (zero for a chain's first line), of chains laid end to end."""
    near = np.exp(np.clip(score - score.max(1, keepdims=True), -200, 0))
    hop = np.exp(np.clip(step, -100, 100))
    own = np.where(first[:, None, None], near[:, None, :], hop * near[:, None, :])
    ahead = _scan(own, first, longest).sum(1)
    last = np.r_[first[1:], True]
    back = np.where(last[:, None, None], 1.0, np.r_[own[1:], own[:1]])  # what follows a line
    behind = _scan(back[::-1].transpose(0, 2, 1), last[::-1], longest)[::-1].sum(1)
    ahead /= ahead.sum(1, keepdims=True)
    one = ahead * behind
    before = np.r_[ahead[:1], ahead[:-1]]
    pair = before[:, :, None] * hop * (near * behind)[:, None, :]
    pair[first] = 0
    return one / one.sum(1, keepdims=True), pair / np.maximum(pair.sum((1, 2), keepdims=True), 1e-300)


def evidence(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Log odds for content of lines, from their document's label and their looks."""
    return np.where(label == 1, ODDS_GOOD, ODDS_BAD) + ODDS_REPEATED * x[:, REPEATED] + ODDS_SYMBOLS * (x[:, SYMBOL_SHARE] > 10 * MANY_SYMBOLS)


def fit(documents: list[tuple[np.ndarray, int]], steps: int = 150, rate: float = 0.2, l2: float = 1e-4, l2_step: float = 0.02) -> Crf:
    """Likelihood of the evidence at its highest, from (features of all lines, label) of each document.

    ``l2_step`` holds steps back: evidence that mostly speaks for whole documents would else make
    any change of label within one too dear.
    """
    documents = [(x, y) for x, y in documents if len(x)]
    if len({y for _, y in documents}) < 2:
        return Crf.empty()
    x = np.concatenate([d[0] for d in documents])
    sizes = np.array([len(d[0]) for d in documents])
    label = np.repeat([d[1] for d in documents], sizes)
    first = np.zeros(len(x), bool)
    first[np.cumsum(sizes) - sizes] = True
    known = np.stack([np.zeros(len(x)), evidence(x, label)], axis=1)
    # both labels weigh alike, whatever their shares
    weight = np.where(label == 1, 0.5 / (label == 1).sum(), 0.5 / (label == 0).sum())
    emit, step = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    moment = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(step), np.zeros_like(step)]
    for turn in range(1, steps + 1):
        score = x @ emit
        free, free_steps = marginals(score, step, first, int(sizes.max()))
        told, told_steps = marginals(score + known, step, first, int(sizes.max()))
        g_emit = x.T @ ((told - free) * weight[:, None]) - l2 * emit
        g_step = ((told_steps - free_steps) * weight[:, None, None]).sum(0) - l2_step * step
        for k, (at, g) in enumerate(((emit, g_emit), (step, g_step))):
            m, v = moment[2 * k], moment[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            at += rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return Crf(emit, step)


def fitted(documents: DataFrame, labels: DataFrame | None, *, key: str = "doc_id", text: str = "text", quality: str = "quality", fit_rows: int = 1500) -> Crf:
    """A CRF from all lines of about ``fit_rows`` labelled documents, chosen by a hash of their key."""
    if labels is None:
        return Crf.empty()
    known = labels.where(F.col(quality).isin(0, 1)).select(key, F.col(quality).cast("int").alias("_label"))
    total = known.count()
    if not total:
        return Crf.empty()
    known = known.where(F.pmod(F.xxhash64(key, F.lit("crf")), F.lit(1_000_000)) < int(1e6 * min(1.0, fit_rows / total)))

    def lines(batches):
        import pyarrow as pa

        for batch in common.sliced(batches):
            for label, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                *_, rows, again = base_counts(t)
                x, _ = features(rows, again)
                yield pa.RecordBatch.from_arrays([pa.array([label], pa.int32()), pa.array([x.astype("<f4").tobytes()])], ["label", "x"])

    with common.batches_of(documents.sparkSession):
        rows = documents.select(key, F.col(text).alias("_text")).join(known, key).select("_label", "_text").mapInArrow(lines, "label int, x binary").collect()
    rows = sorted((r["label"], bytes(r["x"])) for r in rows)
    return fit([(np.frombuffer(x, "<f4").reshape(-1, FEATURES).astype(float), label) for label, x in rows])


def judge(documents: DataFrame, crf: Crf, *, key: str = "doc_id", text: str = "text", share: float = 0.5, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts and verdicts: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_words, line_labels, kept.

    ``line_labels`` has a character for each line with a word: ``c`` content, ``b`` boilerplate.
    ``keep``: input columns to hand on.
    """
    import pyarrow as pa

    emit, step = crf.emit, crf.step
    columns = [key, *[c for c in keep if c != key]]
    count = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        own = Crf(emit, step)
        for batch in common.sliced(batches):
            out: list[list] = [[] for _ in range(9)]
            for t in batch.column("_text").to_pylist():
                *numbers, lines, again = base_counts(t)
                n_words, n_repeat = numbers[0], numbers[4]
                failed = n_words < 20 or 100 * n_repeat > 30 * n_words
                content, marks = 0, ""
                if lines:
                    x, n = features(lines, again)
                    labels = own.viterbi(x)
                    content, marks = int(n[labels == CONTENT].sum()), "".join("bc"[k] for k in labels)
                for column, value in zip(out, [*numbers, failed, content, marks, not failed and content >= share * n_words], strict=True):
                    column.append(value)
            types = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.string(), pa.bool_()]
            made = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + made, names)

    names = [*columns, *count, "base_failed", "content_words", "line_labels", "kept"]
    given = documents.select(*columns, F.col(text).alias("_text"))
    schema = ", ".join([f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns] + [f"{c} long" for c in count] + ["base_failed boolean, content_words long, line_labels string, kept boolean"])
    return given.mapInArrow(run, schema)
