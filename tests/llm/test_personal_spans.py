"""Personal data: base forms against plain regular expressions, planted disguised forms, the fit against enumeration."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import personal_spans as P


def plain(text):
    """The base forms by the regular expressions as the contract gives them."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        total = sum(int(c) if k % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for k, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_base_forms_equal_the_expressions():
    rng = random.Random(4)
    pieces = ["ann", "@", ".", "-", "+", " ", "1", "22", "4111 1111", "255", "256", "(", ")", "é", "a@b.c", "10.0.0.1", "+1 (988) 555-2485", "4111111111111111", "\n", "_", "%", "٣", "@@", "--", "0" * 20, "007.1.2.3"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert P.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    began = time.time()
    for run in ("a", "1", "1.", "1 ", "+1 ", "a@", "@", " at ", "a@b.", "1:", "(", "[at] ", "1-", "é", "a.b@c", ":", "::1"):
        P.candidates(text := run * (600_000 // len(run)), P.base_spans(text))
    assert time.time() - began < 60


def documents(count, seed=1):
    """Texts with one planted span each, or a decoy."""
    rng, out = random.Random(seed), []
    card = lambda: next(c for c in (f"4{rng.randrange(10**15):015d}" for _ in itertools.count()) if P.luhn(c))
    for k in range(count):
        n = rng.randrange(1000, 9999)
        c = card()
        shown, kind, hidden = rng.choice([
            (f"ann{n}@mail.example.com", "email", False), (f"bo{n} [at] mail [dot] example [dot] org", "email", True), (f"cy{n} (at) example.net", "email", True), (f"di dot eve{n} at mail dot example dot com", "email", True),
            (f"10{n % 10}.44.12.{n % 250}", "ip", False), (f"10{n % 10}[.]44[.]12[.]{n % 250}", "ip", True),
            (c, "card", False), (f"{c[:4]}.{c[4:8]}.{c[8:12]}.{c[12:]}", "card", True),
            (f"+1 (631) 555-{n}", "phone", False), (f"(631) 555-{n}", "phone", True),
            (f"order 2024-01-0{n % 9 + 1} no {n}", None, False), (f"version 1.2.{n}", None, False), (f"see you at noon. Then {n}", None, False), (f"serial {n}123456789012{n}", None, False),
        ])
        lead = {"email": "write to", "ip": "the server", "card": "paid by card", "phone": "call me:", None: "and"}[kind] if rng.random() < 0.5 else "so"
        text = f"The {rng.choice(['sun', 'sea'])} is up and {lead} {shown} then rest."
        out.append((k, text, None if kind is None else f"{kind}:{text.index(shown)}:{text.index(shown) + len(shown)}", hidden))
    return out


def test_planted_spans_are_found_and_decoys_left(spark):
    rows = documents(600)
    frame = spark.createDataFrame(rows, "doc_id long, text string, want string, hidden boolean")
    got = {r.doc_id: r for r in P.find(frame).collect()}
    hits = {h: [got[k].spans == want for k, _, want, hidden in rows if want and hidden == h] for h in (False, True)}
    assert all(hits[False]) and np.mean(hits[True]) > 0.9
    assert np.mean([got[k].spans == "" for k, _, want, _ in rows if want is None]) > 0.95
    for k, text, _, _ in rows:
        base = plain(text)
        assert [got[k][f"n_{kind}"] for kind in P.KINDS] == [sum(b[0] == i for b in base) for i in range(4)]
        said = ",".join(f"{P.KINDS[b[0]]}:{b[1]}:{b[2]}" for b in base)
        assert got[k].base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(got[k].spans.split(","))


def test_masked_texts(spark):
    rows = documents(200, 2)
    frame = spark.createDataFrame([(k, t) for k, t, _, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    model = P.learn(P.scan(frame))
    got = {r.doc_id: r.text for r in P.mask(frame, model).collect()}
    assert got[900] is None and got[901] == ""
    for k, text, want, hidden in rows:
        if want and not hidden:
            kind, start, end = want.split(":")
            assert got[k] == text[: int(start)] + f"[{kind.upper()}]" + text[int(end) :]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "ann@mail.com"), (3, "😀 ann@mail.com"), (3, "😀 ann@mail.com"), (4, "x " * 500_000 + "ann@mail.com")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"spans": F.lit("x"), "key": F.lit(1), "base": F.lit("y"), "found": F.lit(2)})
    got = sorted(((r.doc_id, r.spans, r.n_email) for r in P.find(frame).collect()), key=str)
    assert got == sorted([(1, "", 0), (2, "", 0), (None, "email:0:12", 1), (3, "email:2:14", 1), (3, "email:2:14", 1), (4, "email:1000000:1000012", 1)], key=str)
    assert P.find(frame.limit(0)).count() == 0


def test_expectation_maximisation_recovers_reliabilities():
    """Votes drawn from known reliabilities; the posterior is checked against the full product over classes."""
    rng = np.random.default_rng(3)
    truth = rng.random(40_000) < 0.3
    right = np.array([0.9, 0.8, 0.7, 0.85, 0.6, 0.75])
    vote = np.where(rng.random((len(truth), 6)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    vote[rng.random(vote.shape) < 0.2] = 0
    distinct, at, number = np.unique(vote, axis=0, return_inverse=True, return_counts=True)
    prior, table, said = P.reliabilities(distinct, number.astype(float))
    assert abs(prior - 0.3) < 0.02
    assert np.allclose(table[1, :, 2] / 0.8, right, atol=0.03) and np.allclose(table[0, :, 0] / 0.8, right, atol=0.03)
    for row, p in zip(distinct[:50], said, strict=False):
        odds = [q * np.prod([table[c, k, v + 1] for k, v in enumerate(row)]) for c, q in ((0, 1 - prior), (1, prior))]
        assert abs(odds[1] / sum(odds) - p) < 1e-4
    assert np.mean((said[at.ravel()] > 0.5) == truth) > 0.9


def test_classifier_is_at_the_optimum():
    rng = np.random.default_rng(5)
    x = np.concatenate([np.ones((300, 1)), rng.integers(0, 2, (300, 5))], 1).astype(float)
    target, weight = rng.random(300), rng.integers(1, 9, 300).astype(float)
    w = P.classifier(x, target, weight)

    def loss(v):
        p = 1 / (1 + np.exp(-x @ v))
        return -(weight * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() + 0.5 * (v[1:] ** 2).sum()

    assert all(loss(w) <= loss(w + 0.01 * d) for d in np.concatenate([np.eye(6), -np.eye(6)]))


def test_patterns_are_numbers_of_votes_and_surface():
    for vote in itertools.product((-1, 0, 1), repeat=6):
        for surface in ((0, 0, 0), (3, 2, 1), (1, 3, 3)):
            assert P.parted(P.pattern_of(vote, surface)) == (vote, surface)
