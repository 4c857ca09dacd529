"""Personal data: labelers vote, expectation-maximisation weighs them, a classifier decides the spans.

``base_spans`` are the plain forms of e-mail addresses, IPv4 addresses, payment cards and phone
numbers; they are always spans. Wider patterns find candidates: the plain forms and disguised or
loosely written ones (``ann [at] mail [dot] org``, grouped or spaced digits, IPv6, national numbers).
Six labelers look at each: a plain-form regex, a check (digits, parts, Luhn), a gazetteer (top-level
domains, issuers, calling codes, reserved networks), words of context before it, its neighbours, and
its grouping. Each votes for, against, or abstains. Votes are counted over all documents; for each
kind, expectation-maximisation estimates how reliable the labelers are and how likely each pattern of
votes is personal data. A logistic span classifier over votes and surface (separators, neighbouring
characters) is trained on those soft labels, and a candidate of probability ``LEAST`` or more is added
where it overlaps no base span; of overlapping ones the likelier stays.

A pass over the texts writes base spans and candidates; counts are bounded by the patterns there are
(``PATTERNS``), so the driver gets at most that many rows whatever the input. No pattern can be slow on
a long run of equal characters: each is anchored at a mark and bounded, or takes its run whole.

Null and empty texts have no spans. Repeated rows are found and counted like any others, null keys are
kept. Offsets are code points, ends exclusive. Tables without rows give empty results; extra columns
are ignored unless kept.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ("form", "check", "gazetteer", "context", "neighbours", "grouping")
#: Separators, character before, character after: see ``_surface``.
SURFACE = (4, 4, 4)
PATTERNS = len(KINDS) * 3 ** len(LABELERS) * int(np.prod(SURFACE))
#: Probability from which a candidate is a span.
LEAST = 0.5
#: Code points read before a candidate for its context.
BEFORE = 48
SPAN = "kind int, start int, end int"

# --- fixed values of the base forms: characters and lengths as the contract states them
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_FOUR = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# --- gazetteers (fixed values)
DOMAINS = frozenset("com org net edu gov mil int info biz io dev app co me eu us uk de fr es it nl pt pl at ch be se no dk fi ie cz ru ua br mx ar in cn jp kr au ca nz za".split())
ISSUERS = re.compile(r"4(?:\d{12}|\d{15}|\d{18})$|5[1-5]\d{14}$|2(?:2[2-9]|[3-6]\d|7[01]|720)\d{12,13}$|3[47]\d{13}$|6(?:011|5\d\d|4[4-9]\d)\d{12}$|35\d{14}$|3(?:0[0-5]|[68]\d)\d{11}$|62\d{14,17}$")
CALLING = re.compile(r"(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[1-368]|2[2-6]\d|29[0-9]|35\d|37\d|38\d|42[0-3]|50\d|59\d|67\d|68\d|69\d|85\d|88\d|96\d|97\d|99\d)")
CUES = (
    ("mail", "e-mail", "email", "contact", "kontakt", "contacto", "correo", "courriel", "write", "schreib", "reach", "send"),
    ("ip", "host", "server", "address", "addr", "login", "adresse", "client", "servidor", "serveur"),
    ("card", "visa", "mastercard", "karte", "carte", "tarjeta", "payment", "paid", "pay", "cc"),
    ("phone", "tel", "call", "mobile", "cell", "fax", "telefon", "teléfono", "téléphone", "handy", "ring", "whatsapp"),
)
AGAINST = frozenset("version v release order invoice isbn issn no nr ref id section page chapter amount total price sum date since from between build rev part item sku serial tracking pi".split())
_WORDS = re.compile(r"[^\W\d_](?:[\w-]*\w)?")

# --- wider forms
_AT = re.compile(r"[@＠]|[\[({<] ?[Aa][Tt] ?[\])}>]| at | AT ")
_NAME = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_SPOKEN_NAME = re.compile(r"(?<![A-Za-z0-9._%+-])(?:[A-Za-z0-9_%+-]{1,30}(?: dot | ?[\[({<]dot[\])}>] ?)){0,3}[A-Za-z0-9._%+-]{1,64}\Z")
_DOT = r"(?: ?[\[({<] ?(?:[Dd][Oo][Tt]|\.) ?[\])}>] ?| (?:dot|DOT) |\.| \. )"
_SITE = re.compile(rf" ?[A-Za-z0-9][A-Za-z0-9-]{{0,62}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}")
_FOUR_WIDE = re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:(?: ?[\[(](?:\.|dot)[\])] ?| \. | dot |\.|,)[0-9]{1,3}){3}(?![0-9A-Za-z])")
_SIX = re.compile(r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])")
_GAP = r"\x20\xa0 –‑"
_CARD_WIDE = re.compile(rf"(?<![0-9A-Za-z])[0-9](?:[./_{_GAP}-]{{0,2}}[0-9]){{12,18}}(?![0-9A-Za-z])")
_PHONE_WIDE = re.compile(rf"(?<![0-9A-Za-z])(?:\+ ?|\()?[0-9](?:[().\-/{_GAP}]{{0,3}}[0-9]){{6,14}}(?![0-9A-Za-z])")
_DATE = re.compile(r"(?:[0-3]?\d[./-][01]?\d[./-](?:19|20)\d\d|(?:19|20)\d\d[./-][01]?\d[./-][0-3]?\d)")
_V6_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of all plain forms, by start, then kind."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (site := _DOMAIN.match(text, at + 1)):
            found.append((EMAIL, start, site.end()))
            free = site.end()
        else:
            free = at + 1
        at = text.find("@", free)
    for m in _FOUR.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append((IP, m.start(), m.end()))
    for m in _DIGITS.finditer(text):
        if 14 <= m.end() - m.start() <= 37 and 14 <= len(digits := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(digits):
            found.append((CARD, m.start(), m.end()))
    for m in _PLUS.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((PHONE, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def _wide(text: str):
    """Kind, start and end of all candidates beyond the base forms."""
    for m in _AT.finditer(text):
        ahead = text[max(0, m.start() - 65) : m.start()].removesuffix(" ")
        name = _NAME.search(ahead) if m.group() in "@＠" else _SPOKEN_NAME.search(ahead) or _NAME.search(ahead)
        if name and (site := _SITE.match(text, m.end())):
            yield EMAIL, m.start() - (text[m.start() - 1] == " ") - len(name.group()), site.end()
    for pattern in (_FOUR_WIDE, _SIX):
        for m in pattern.finditer(text):
            if pattern is _FOUR_WIDE or (m.group().count(":") >= 3 and _V6_DIGIT.search(m.group())):
                yield IP, m.start(), m.end()
    for kind, pattern in ((CARD, _CARD_WIDE), (PHONE, _PHONE_WIDE)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def votes(text: str, kind: int, start: int, end: int, is_base: bool) -> tuple[int, ...]:
    """What each labeler says: 1, 0 or -1."""
    own, said = text[start:end], text[max(0, start - BEFORE) : start].lower()
    digits = _NOT_DIGIT.sub("", own)
    before, after = text[start - 1 : start], text[end : end + 1]
    glued = (before and (before.isalnum() or before in "=\"'#&/\\@_")) or (after and (after.isalnum() or after in "=\"'&/\\@_%"))
    six = kind == IP and ":" in own
    if kind == EMAIL:
        host = re.split(_DOT, _AT.split(own, maxsplit=1)[-1].strip())
        top = host[-1].lower()
        check = 1 if top.isalpha() and 2 <= len(top) <= 24 and all(h and not h.startswith("-") and not h.endswith("-") for h in host) else -1
        known = 1 if top in DOMAINS else -1
        spaced = " " in own
        marked = "@" in own or "＠" in own or any(c in own for c in "[({<")
        grouping = 1 if not spaced or (marked and "@" not in own) or (" at " in own.lower() and " dot " in own.lower()) else -1
    elif six:
        check, known, grouping = 1, (-1 if own.lower().startswith(("fe80", "::1")) else 1), (1 if own.count(":") >= 4 else -1)
    elif kind == IP:
        parts = [int(p) for p in re.findall(r"[0-9]+", own)]
        check = 1 if max(parts) <= 255 else -1
        known = -1 if parts[0] in (0, 127, 255) or parts[0] < 4 and max(parts) < 30 else 1
        grouping = 1 if len(set(_separators(own))) == 1 and "," not in own else -1
    elif kind == CARD:
        check = 1 if luhn(digits) else -1
        known = 1 if ISSUERS.match(digits) else -1
        sizes = [len(g) for g in re.findall(r"[0-9]+", own)]
        even = len(set(_separators(own))) <= 1
        grouping = 1 if even and (len(sizes) == 1 or sizes[:-1] == [4] * (len(sizes) - 1) or sizes in ([4, 6, 5], [4, 6, 4])) else -1
    else:
        plus = own.startswith(("+", "00"))
        number = digits[2:] if own.startswith("00") else digits
        national = len(digits) == 10 and digits[0] in "23456789" and digits[3] in "23456789"
        check = 1 if 10 <= len(number) <= 15 and (plus or national or digits[0] == "0") else -1
        known = (1 if CALLING.match(number) else -1) if plus else 1 if national or (digits[0] == "0" and digits[1:2] != "0") else -1
        sizes = [len(g) for g in re.findall(r"[0-9]+", own)]
        dated = _DATE.match(own) or (own.count(".") == 3 and len(sizes) == 4 and "(" not in own)
        grouping = -1 if dated or len(sizes) > 7 or (len(sizes) == 1 and not plus) else 1
    words = _WORDS.findall(said)[-4:]
    context = 1 if any(w in CUES[kind] for w in words) else -1 if words and words[-1] in AGAINST else 0
    return (1 if is_base else 0, check, known, context, -1 if glued else 1, grouping)


def _separators(own: str) -> list[str]:
    return re.findall(r"[^0-9A-Fa-f]+", own)


def _surface(text: str, start: int, end: int) -> tuple[int, int, int]:
    """None, blanks, marks or words between; nothing, blank, mark or other before and after."""
    own = text[start:end]
    apart = 3 if re.search(r"[A-Za-z]{2,}[\])}>]| at | dot ", own) else 1 if " " in own else 2 if re.search(r"[^0-9A-Za-z]", own) else 0
    side = lambda c: 0 if not c else 1 if c.isspace() else 2 if not c.isalnum() else 3
    return apart, side(text[start - 1 : start] if start else ""), side(text[end : end + 1])


def pattern_of(vote: tuple[int, ...], surface: tuple[int, ...]) -> int:
    """Votes and surface as one number."""
    out = 0
    for value, size in itertools.chain(((v + 1, 3) for v in vote), zip(surface, SURFACE, strict=True)):
        out = out * size + value
    return out


def parted(pattern: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Votes and surface of a pattern."""
    values = []
    for size in reversed((3,) * len(LABELERS) + SURFACE):
        pattern, value = divmod(pattern, size)
        values.append(value)
    values.reverse()
    return tuple(v - 1 for v in values[: len(LABELERS)]), tuple(values[len(LABELERS) :])


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Base spans and wider finds with their patterns; a wider find with the place of a base span is that span."""
    plain = set(base)
    spans = [*base, *sorted({s for s in _wide(text) if s not in plain})]
    return [(*s, pattern_of(votes(text, *s, s in plain), _surface(text, s[1], s[2]))) for s in spans]


def scan(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base spans and candidates of each text."""
    key_type = documents.schema[key].dataType.simpleString()
    spans = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end")]))
    found = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end", "pattern")]))

    def run(batches):
        for batch in common.sliced(batches):
            base = [base_spans(t or "") for t in batch.column(1).to_pylist()]
            wide = [candidates(t, b) if t else [] for t, b in zip(batch.column(1).to_pylist(), base, strict=True)]
            named = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in b] for b in base]
            more = [[dict(zip(("kind", "start", "end", "pattern"), s, strict=True)) for s in w] for w in wide]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(named, spans), pa.array(more, found)], ["key", "base", "found"])

    return documents.select(key, text).mapInArrow(run, f"key {key_type}, base array<struct<kind:int,start:int,end:int>>, found array<struct<kind:int,start:int,end:int,pattern:int>>")


@dataclass
class Model:
    """Reliabilities of the labelers (kind, class, labeler, vote) and weights of the classifier (kind, feature)."""

    prior: np.ndarray
    votes: np.ndarray
    weights: np.ndarray

    def probability(self, kind: int, pattern: int) -> float:
        return float(1 / (1 + np.exp(-_features(pattern) @ self.weights[kind])))


def _features(pattern: int) -> np.ndarray:
    vote, surface = parted(pattern)
    out = [1.0]
    for v in vote:
        out += [float(v == 1), float(v == -1)]
    for value, size in zip(surface, SURFACE, strict=True):
        out += [float(value == k) for k in range(1, size)]
    return np.array(out)


#: Pseudo-counts of votes -1, 0 and 1: a labeler is better than chance until the data say otherwise.
TRUST = {0: np.array([6.0, 4.0, 2.0]), 1: np.array([2.0, 4.0, 6.0])}


def reliabilities(vote: np.ndarray, weight: np.ndarray, steps: int = 200, tolerance: float = 1e-9) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation over distinct vote patterns: prior, P(vote | class) and the posterior of each pattern.

    Labelers are independent within a class; counts are smoothed by ``TRUST``.
    """
    posterior = 1 / (1 + np.exp(-vote.sum(1).astype(float)))
    prior, table = 0.5, np.zeros((2, vote.shape[1], 3))
    for _ in range(steps):
        share = np.stack([(1 - posterior) * weight, posterior * weight])
        new_prior = (share[1].sum() + 1) / (weight.sum() + 2)
        for c in (0, 1):
            for k in range(vote.shape[1]):
                counts = np.array([share[c][vote[:, k] == v].sum() for v in (-1, 0, 1)]) + TRUST[c]
                table[c, k] = counts / counts.sum()
        logs = np.stack([np.log(p) + sum(np.log(table[c, k, vote[:, k] + 1]) for k in range(vote.shape[1])) for c, p in ((0, 1 - new_prior), (1, new_prior))])
        posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if abs(new_prior - prior) < tolerance:
            break
        prior = new_prior
    return new_prior, table, posterior


def classifier(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method; the first column is the constant and isn't shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (target - p)) - shrink * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(bend + 1e-9 * np.eye(len(w)), slope)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(counts: list[tuple[int, int, int]]) -> Model:
    """The model from (kind, pattern, number of candidates)."""
    prior, table, weights = np.full(len(KINDS), 0.5), np.zeros((len(KINDS), 2, len(LABELERS), 3)), np.zeros((len(KINDS), len(_features(0))))
    for kind in range(len(KINDS)):
        own = sorted((p, n) for k, p, n in counts if k == kind)
        vote = np.array([parted(p)[0] for p, _ in own], int).reshape(-1, len(LABELERS))
        number = np.array([n for _, n in own], float)
        distinct, at = np.unique(vote, axis=0, return_inverse=True) if len(own) else (vote, np.zeros(0, int))
        prior[kind], table[kind], said = reliabilities(distinct, np.bincount(at.ravel(), number, len(distinct)))
        # a candidate that every labeler refuses and one that all accept: what the kind may not show in these data
        ends = np.stack([_features(pattern_of((v,) * len(LABELERS), (0, 1, 1))) for v in (-1, 1)])
        x = np.concatenate([np.array([_features(p) for p, _ in own]).reshape(-1, ends.shape[1]), ends])
        weights[kind] = classifier(x, np.concatenate([said[at.ravel()], [0.0, 1.0]]), np.concatenate([number, [1.0, 1.0]]))
    return Model(prior, table, weights)


def learn(scanned: DataFrame) -> Model:
    """Votes counted over all rows; at most ``PATTERNS`` counts come back."""
    found = scanned.select(F.explode("found").alias("f")).groupBy("f.kind", "f.pattern").count()
    return fit([tuple(r) for r in found.collect()])


def chosen(base: list[dict], found: list[dict], model: Model, known: dict) -> list[tuple[int, int, int]]:
    """Base spans and the candidates added to them, by start, then kind."""
    spans = [(b["kind"], b["start"], b["end"]) for b in base]
    more = []
    for f in found:
        at = (f["kind"], f["pattern"])
        if at not in known:
            known[at] = model.probability(*at)
        if known[at] >= LEAST:
            more.append((-known[at], f["start"], f["kind"], f["end"]))
    for _, start, kind, end in sorted(more):
        if all(end <= s or e <= start for _, s, e in spans):
            spans.append((kind, start, end))
    return sorted(spans, key=lambda s: (s[1], s[0]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def judge(scanned: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Per document: plain forms of each kind, the digest of their places, and all spans."""
    key_type = scanned.schema["key"].dataType.simpleString()
    names = [key, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches):
        known: dict = {}
        for batch in batches:
            rows = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            counts = [pa.array([sum(b["kind"] == k for b in base) for base, _ in rows], pa.int64()) for k in range(len(KINDS))]
            digest = [hashlib.sha256(joined([(b["kind"], b["start"], b["end"]) for b in base]).encode()).hexdigest() for base, _ in rows]
            spans = [joined(chosen(base, found, model, known)) for base, found in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digest, pa.string()), pa.array(spans, pa.string())], names)

    return scanned.mapInArrow(run, ", ".join([f"{key} {key_type}", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"]))


def mask(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; null texts stay null."""
    names, at = documents.columns, documents.columns.index(text)

    def run(batches):
        known: dict = {}
        for batch in common.sliced(batches):
            said = []
            for t in batch.column(at).to_pylist():
                base = base_spans(t or "")
                found = [dict(zip(("kind", "start", "end", "pattern"), f, strict=True)) for f in candidates(t or "", base)]
                out, free = [], 0
                for kind, start, end in chosen([dict(zip(("kind", "start", "end"), b, strict=True)) for b in base], found, model, known):
                    if end > free:
                        out += [t[free:start], f"[{KINDS[kind].upper()}]"]
                        free = end
                said.append(None if t is None else "".join([*out, t[free:]]))
            columns = [pa.array(said, pa.string()) if k == at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents.mapInArrow(run, documents.schema)


def find(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One reading of all texts, a model from their votes, and every document's spans; a written table."""
    with common.Scratch() as tmp:
        scanned = tmp.stored(scan(documents, key, text), "span-candidates")
        return common.stored(judge(scanned, learn(scanned), key), "personal-spans")
