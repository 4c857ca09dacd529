"""Operators of the subpackage against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, interpolated_lm, jaccard_join, language_id, merge_replay, packing, quality_crf, registry, tool_calls, toxicity, url_filter, vector_dedup
from tidemark.llm.components import Forest, connected

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, _label int"
ODD = [
    (1, None, None, None, None, "x", 1, 1),
    (2, "", "en", None, 0, "x", 1, 1),
    (3, " \n\t ", "en", "s", 3, "x", 1, 1),
    (4, "A b c", "en", "s", 5, "x", 1, 1),
    (5, "a B c", "en", "s", 5, None, None, None),
    (5, "a B c", "en", "s", 5, None, None, None),
    (6, "word é 日本 😀 " * 20_000, "en", "s", 0, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def sample(spark):
    return common.table(spark, "/root/testdata/sf0.01", "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return common.table(spark, "/root/testdata/sf0.01", "labels")


def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- 1


def test_url_rules_and_verdicts(spark):
    urls = ["https://A.Example.com/en/7?x", "http://x.com/en/1", "http://x.com/de/1", "http://b.example.net/de/8#f", "http://q.net/de/9", "http://com/en/", "no scheme", None, "http://notcom/en/", "http://x.org/es/?a://b", "://h?q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    got = {r.page_id: r for r in url_filter.filter_urls(pages, registry.RULES).collect()}
    assert [got[k].rule for k in range(11)] == ["example.com/en/7", "com/en/", None, "example.net/de/8", "net/de/", "com/en/", None, None, None, "org/es/", None]
    assert (got[0].host, got[0].path) == ("a.example.com", "/en/7") and (got[6].host, got[7].path) == ("", "")
    assert (got[9].host, got[9].path, got[10].host) == ("x.org", "/es/", "h")
    assert [got[k].verdict for k in (0, 1, 3, 4, 9)] == ["allow", "block", "block", "allow", "block"]
    assert all(r.verdict in ("allow", "block") for r in got.values())
    assert url_filter.filter_urls(pages.where("false"), registry.RULES).count() == 0


def test_url_models_tell_classes_apart():
    good, bad = np.zeros(url_filter.CELLS), np.zeros(url_filter.CELLS)
    for k in range(200):
        for side, url in ((good, f"http://news{k}.org/a/{k}"), (bad, f"http://spam-{k}.biz/x?y={k}")):
            context, own = url_filter.codes(url)
            np.add.at(side, context * url_filter.SYMBOLS + own, 1)
    ratios = url_filter.log_ratios(good, bad)
    assert url_filter.mean_ratio("http://news999.org/a/9", ratios) > 0 > url_filter.mean_ratio("http://spam-77.biz/x?y=1", ratios)
    assert url_filter.calibrated([(0.1, 0, 5), (0.9, 5, 0)]) == 0.5 and url_filter.calibrated([]) == 0


# --- 2


def best_fit_decreasing(lengths, room):
    """Sequences that plain best-fit needs, piece by piece."""
    import bisect

    gaps, opened = [], 0
    for size in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, size)
        left = gaps.pop(at) if at < len(gaps) else room
        opened += left == room
        if left > size:
            bisect.insort(gaps, left - size)
    return opened


def test_rounds_equal_plain_best_fit():
    rng = random.Random(1)
    for room in (1, 8, 64, 300) * 20:
        lengths = [rng.choice([rng.randint(1, room), rng.randint(1, max(1, room // 8)), room // 3 or 1]) for _ in range(rng.randint(0, 400))]
        counts = collections.Counter(lengths)
        runs, opened = packing.rounds(counts, room)
        assert opened == best_fit_decreasing(lengths, room)
        filled = collections.defaultdict(list)
        for size, n in counts.items():
            own = runs[runs[:, 0] == size]
            for rank in range(n):
                _, first, each, sequence, offset = own[np.searchsorted(own[:, 1], rank, side="right") - 1].tolist()
                filled[sequence + (rank - first) // each].append((offset + (rank - first) % each * size, size))
        for places in filled.values():
            ends = np.cumsum([size for _, size in sorted(places)])
            assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= room
        assert set(filled) == set(range(opened))


def test_packing_of_repeated_rows(spark):
    """One key and length holds nearly all rows; null keys and extra columns of the same names as the operator's."""
    rows = [(7, "a b c")] * 3000 + [(None, "x")] * 50 + [(8, "word " * 3000)] * 3 + [(9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"piece": F.lit(1), "_at": F.lit(1), "_task": F.lit(1), "length": F.lit("x")}).repartition(7)
    got = packing.pack(packing.pieces_of(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)).collect()
    assert collections.Counter(r.doc_id for r in got) == {7: 3000, None: 50, 8: 6, 9: 1}
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    assert all(o == sum(n for _, n in sorted(v)[:k]) for v in places.values() for k, (o, _) in enumerate(sorted(v)))
    assert len(places) == best_fit_decreasing([r.length for r in got], 2048)


def test_packing(spark, odd, sample):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    special = spark.createDataFrame([(2 * 10**6, "a <|endoftext|> b")], "doc_id long, text string")
    docs = sample.select("doc_id", "text").union(odd.where("doc_id <> 5").select(F.col("doc_id") + 10**6, "text")).union(special)
    pieces = packing.pieces_of(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True)
    got = packing.pack(pieces).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(by) == set(texts)
    for doc, rows in by.items():
        rows.sort(key=lambda r: r.piece)
        ids = whole.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        assert [x for r in rows for x in np.frombuffer(r.ids, "<u4").tolist()] == ids
        assert all(r.length == 2048 for r in rows[1:]) and rows[0].length <= 2048
        assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.start == sum(q.length for q in rows[: r.piece]) for r in rows)
    held = collections.defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(held) == best_fit_decreasing([r.length for r in got], 2048)
    assert packing.pack(pieces.where("false")).count() == 0
    assert packing.sequences(spark.createDataFrame(got, pieces.schema.add("sequence_id", "long").add("offset", "long"))).count() == len(held)


def test_added_tokens_get_the_ids_of_the_contract(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["ab <|endoftext|> cd", "<|endoftext|><|endoftext|>", "a<|endoftext|>\n\n b", "<|endoftext<|endoftext|>|>", "<|endoftext|", "it's  é 日本 😀<|endoftext|>  ", "<|ENDOFTEXT|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.pieces_of(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True).collect()}
    assert got == {k: [*whole.encode(t, add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}
    assert got[0] == [397, 220, 50256, 22927, 0]


# --- 3


def test_merge_replay_equals_tiktoken(spark, odd):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    want = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=merge_replay.load_ranks(path), special_tokens={})
    rng = random.Random(4)
    texts = ["aaaaaaaaaaaaaa", "<|endoftext|>", "ababab" * 50] + ["".join(rng.choice("abcdeéßñ ioutnrsl0123.,日 \n") for _ in range(rng.randint(0, 80))) for _ in range(500)]
    codec = merge_replay.codec(path, P.PATTERN)
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(text)
        assert codec.decode(ids).decode() == text
    rows = merge_replay.encode_documents(odd, path, P.PATTERN, digests=True).collect()
    for r, (_, text, *_) in zip(sorted(rows, key=lambda r: r.doc_id), ODD, strict=True):
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest() and r.n_tokens == len(r.ids) // 4
    back = merge_replay.decode_documents(spark.createDataFrame(rows), path, P.PATTERN).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t, *_ in ODD)


# --- 4


def test_toxicity_held_out(spark, odd):
    sample, labels = (common.table(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    model = toxicity.learn(sample, labels.where(common.fold("doc_id", 4) != 2))
    rows = toxicity.score(sample, model, also={"held_out": common.fold("doc_id", 4) == 2}).join(labels, "doc_id").where("held_out").collect()
    bad = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in bad) >= 0.85 * len(bad)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert toxicity.score(odd, model).count() == len(ODD)
    assert toxicity.learn(sample, labels.where("false")).weights is None
    assert {r.score for r in toxicity.score(odd, toxicity.Model()).collect()} == {0.0}


def test_levenshtein_trie_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    terms = {"stupid": 1.0, "moron": 2.0, "loser": 3.0, "scum": 4.0}
    trie, rng = toxicity.Trie(terms, {"vequ": 5.0}), random.Random(2)
    for _ in range(3000):
        word = list(rng.choice(list(terms)))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(word) + 1)
            word[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "s"])
        word = "".join(word)
        near = [w for t, w in terms.items() if len(t) >= 5 and len(word) >= 5 and distance(word, t) == 1]
        want = (terms[word], False) if word in terms else (max(near), True) if near else None
        assert trie.find(word) == want, word
    assert trie.find("vequanything") == (5.0, False)
    quoted = toxicity.Scorer(toxicity.Model(terms, {})).hits('he said "you moron" and left')[0]
    assert quoted == [(3, 2.0, False, True)]


# --- 5


def brute_base(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    again = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)]


def test_quality_rules(spark, odd, sample, labels):
    crf = quality_crf.fitted(sample, labels)
    rng = random.Random(1)
    made = [(k, "\n".join(" ".join(rng.choice(["a", "b|", "é#"]) for _ in range(rng.randint(0, 15))) for _ in range(rng.randint(0, 6)))) for k in range(200)]
    docs = odd.where("doc_id < 6").select("doc_id", "text").union(spark.createDataFrame([(k + 100, x) for k, x in made], "doc_id long, text string"))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_crf.judge(docs, crf).collect())
    want = sorted((d, *(b := brute_base(t)), b[0] < 20 or 100 * b[4] > 30 * b[0]) for d, t in texts)
    assert got == want
    judged = quality_crf.judge(sample, crf).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in judged) >= 0.98 * len(judged)
    assert quality_crf.judge(empty(spark), crf).count() == 0
    assert quality_crf.judge(odd, quality_crf.Crf.empty()).where("kept = base_failed").count() == 0


def test_viterbi_equals_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    crf = quality_crf.Crf(rng.normal(size=(quality_crf.FEATURES, 2)), rng.normal(size=(2, 2)))
    for n in (1, 2, 5):
        x = rng.normal(size=(n, quality_crf.FEATURES))
        score = lambda y: sum((x @ crf.emit)[k, y[k]] for k in range(n)) + sum(crf.step[y[k], y[k + 1]] for k in range(n - 1))  # noqa: B023, E731
        assert tuple(crf.viterbi(x)) == max(itertools.product((0, 1), repeat=n), key=score)


# --- 6


def brute_components(docs, n, percent):
    def shingles(text):
        w = (text or "").encode().translate(common.LOWER_BYTES).split()
        return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[k : k + n]) for k in range(len(w) - n + 1)])

    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(sets)
    forest = Forest(len(ids))
    for i, a in enumerate(ids):
        for j in range(i):
            x, y = sets[a], sets[ids[j]]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                forest.join(i, j)
    return {(d, len(sets[d]), ids[forest.root(k)]) for k, d in enumerate(ids)}


@pytest.mark.parametrize(("n", "percent", "rows"), [(3, 90, 1024), (3, 90, 16), (5, 80, 16)])
def test_jaccard_join(spark, n, percent, rows):
    rng = random.Random(n)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randint(0, 30)) for _ in range(rng.choice([1, 2, 4, 12, 60, 200]))] for _ in range(25)]
    docs = [(1, None), (2, ""), (3, "x"), (4, "X"), (5, " \t")]
    for k in range(600):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(w) // 20))):
            w[rng.randrange(len(w))] = "z" + str(rng.randint(0, 99))
        docs.append((100 + k, " ".join(w)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("root", F.lit(0)).repartition(5)
    assert {tuple(r) for r in jaccard_join.similar(frame, n=n, percent=percent, block_rows=rows).collect()} == brute_components(docs, n, percent)


def test_jaccard_join_of_shared_paragraphs(spark):
    """Many sets of one partition share a paragraph, one set of the other does: only some of the many link with it."""
    rng = random.Random(11)
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    common_ = [words(30) for _ in range(14)]
    large, small = [(k, " ".join(common_)) for k in range(5000, 5060)], []
    for group in range(6):
        paragraph = words(100)
        large += [(100 * group + k, " ".join([paragraph, *rng.sample(common_, 10)])) for k in range(jaccard_join.FEW + 4)]
        large.append((100 * group + 90, f"{paragraph} {words(3)}"))
        small.append((100 * group + 91, f"{words(3)} {paragraph}"))
    one = lambda rows: spark.sparkContext.parallelize(rows, 1)
    frame = spark.createDataFrame(one(large).union(one(small)), "doc_id long, text string")
    assert frame.rdd.getNumPartitions() == 2
    got = {tuple(r) for r in jaccard_join.similar(frame).collect()}
    assert got == brute_components(large + small, 3, 90)
    assert {(100 * g + 91, 101, 100 * g + 90) for g in range(6)} <= got


def test_jaccard_join_of_one_passage_in_a_fifth(spark):
    """A passage that a fifth of all texts share neither joins them to one group nor hides their own copies."""
    rng = random.Random(21)
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage, docs = words(60), []
    for k in range(600):
        own = words(120)
        text = f"{own} {passage}" if k % 5 == 0 else own
        docs.append((k, text))
        if k % 50 == 0:
            docs.append((1000 + k, text + " end"))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = {tuple(r) for r in jaccard_join.similar(frame).collect()}
    assert got == brute_components(docs, 3, 90)
    assert sum(component != doc for doc, _, component in got) == 12
    cells = jaccard_join.commonness(frame, "text", 3)
    words_ = jaccard_join.Words()
    met = collections.Counter(key for _, text in docs for key in jaccard_join.prefix_keys(jaccard_join.shingles(text, 3, words_), 90, cells).tolist())
    assert max(met.values()) <= 2  # the passage is in no prefix


def test_jaccard_join_where_no_shingle_looks_common(spark, monkeypatch):
    """Passages that some dozen texts share don't send each text to the blocks of all others, even if the counts can't tell them apart."""
    rng = random.Random(31)
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passages, docs = [words(30) for _ in range(12)], []
    for k in range(400):
        text = " ".join([words(100), *rng.sample(passages, 2)])
        docs += [(k, text), (1000 + k, text + " end")] if k % 40 == 0 else [(k, text)]
    docs += [(2000 + k, f"{passages[0]} {passages[1]} {passages[2]} {k}") for k in range(20)]  # crowded in all their shingles
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(jaccard_join, "commonness", lambda *_: np.zeros(jaccard_join.COUNTERS, np.uint8))
    sent, stored = [], common.Scratch.stored

    def spied(self, frame, what, *rest):
        out = stored(self, frame, what, *rest)
        if what == "assigned":
            sent.append(out.count())
        return out

    monkeypatch.setattr(common.Scratch, "stored", spied)
    got = {tuple(r) for r in jaccard_join.similar(frame, block_rows=16).collect()}
    assert got == brute_components(docs, 3, 90)
    assert sum(component != doc for doc, _, component in got) == 10 + 19
    assert sent[0] > 10 * len(docs)
    assert sent[-1] < len(docs)


def test_picked_by_ranges(spark):
    wide = spark.createDataFrame([(f"t{k}", k % 40 if k % 7 else None) for k in range(120)], "t string, key long")
    with common.Scratch() as tmp:
        keys = tmp.stored(spark.range(0, 60, 3).select(F.col("id").alias("key")), "keys")
        none = tmp.stored(spark.range(0).select(F.col("id").alias("key")), "keys")
        for how in ("left_semi", "left_anti"):
            rows = lambda f: sorted((r.t, r.key or -1) for r in f.collect())
            want = rows(wide.join(keys, "key", how))
            for most in (100, 6, 1):
                assert rows(common.picked(wide, keys, "key", how, most=most)) == want
        plan = common.picked(wide, keys, "key", "left_anti", most=6)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        assert common.picked(wide, none, "key").count() == 0


def test_jaccard_join_odd_rows(spark, odd):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similar(odd).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4)} <= got
    assert jaccard_join.similar(empty(spark)).count() == 0


@pytest.mark.parametrize("bound", [1 << 18, 3])
def test_components(spark, bound):
    rng = random.Random(3)
    edges = [(rng.randint(0, 900), rng.randint(0, 900)) for _ in range(700)] + [(k, k + 1) for k in range(2000, 2100)]
    forest = Forest(3000)
    for a, b in edges:
        forest.join(a, b)
    got = {tuple(r) for r in connected(spark.createDataFrame(edges, "a long, b long"), finish_rows=bound).collect()}
    assert got == {(x, forest.root(x)) for e in edges for x in e}


# --- 7


def test_language_held_out(spark, odd, sample):
    prototypes = language_id.learn(sample.where(common.fold("doc_id", 5) != 0))
    rows = language_id.predict(sample, prototypes, also={"lang": F.col("lang"), "held_out": common.fold("doc_id", 5) == 0}).where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r for r in language_id.predict(odd, prototypes).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and got[4].lang_pred in prototypes
    assert {r.lang_pred for r in language_id.predict(odd, {}).collect()} == {"und"}
    assert language_id.learn(empty(spark)) == {}


def test_bundles_are_sums_of_bound_vectors():
    own = language_id.profiler(7)
    grams, n = own.grams("Ab c")
    letters = language_id.letter_vectors(7).astype(int)
    want = np.zeros(language_id.WIDTH)
    for g, k in zip(grams.tolist(), n.tolist(), strict=True):
        parts = [g // language_id.LETTERS**2, g // language_id.LETTERS % language_id.LETTERS, g % language_id.LETTERS]
        want += k * np.prod([np.roll(letters[p], 2 - i) for i, p in enumerate(parts)], axis=0)
    assert np.array_equal(own.bundles([(grams, n)])[0], want)


# --- 8


def test_canonical_arguments(spark):
    cases = {'{"b": 1, "a": {"d": [1, "x", null], "c": 1.5}}': '{"a":{"c":1.5,"d":[1,"x",null]},"b":1}', "{}": "{}", '{"b":1,"a":2,"a":1}': '{"a":"1","a":"2","b":"1"}', "[1]": None, "x": None, None: None}
    frame = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.c for r in frame.select("t", tool_calls.canonical(F.col("t")).alias("c")).collect()} == cases
    bare = spark.createDataFrame([(1, None, 0, None, "{}", None), (1, "b", 1, "f", '{"a":1,"a":2}', None)], "conv_id long, call_id string, position long, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([], "conv_id long, call_id string, position long, content string")
    got = {r.call_id: (r.status, r.message) for r in tool_calls.link(bare, results, {"f": {"a": ("number", True)}}).collect()}
    assert got == {None: ("unknown_tool", '{"arguments":{}}'), "b": ("invalid_arguments", '{"arguments":{"a":"1","a":"2"},"id":"b","name":"f"}')}


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [(1, "a", 0, "add", '{"y":2,"x":1}', []), (1, "b", 1, "add", '{"x":"q"}', ["a"]), (1, "c", 2, "nope", "{}", ["b", "zz"]), (1, "d", 3, "add", '{"x":1}', ["e"]), (1, "e", 4, "add", '{"x":1}', ["d"]), (1, None, 5, "add", None, None), (2, "a", 9, "add", '{"x":1}', [])],
        "conv_id long, call_id string, position long, name string, arguments string, needs array<string>",
    )
    results = spark.createDataFrame([(1, "a", 1, "ok"), (1, "a", 2, "twice"), (1, "z", 3, "lost"), (2, "a", 3, "early")], "conv_id long, call_id string, position long, content string")
    got = {(r.conv_id, r.call_id, r.position): r for r in tool_calls.link(calls, results, {"add": {"x": ("number", True), "y": ("number", False)}}).collect()}
    status = {k: (r.status, r.level, r.n_results) for k, r in got.items()}
    assert status == {
        (1, "a", 0): ("linked", 0, 2), (1, "b", 1): ("invalid_arguments", 1, 0), (1, "c", 2): ("unknown_tool", 2, 0), (1, "d", 3): ("cyclic", None, 0),
        (1, "e", 4): ("cyclic", None, 0), (1, None, 5): ("invalid_arguments", 0, 0), (1, "z", 3): ("orphan_result", None, 1), (2, "a", 9): ("early_result", 0, 1),
    }
    assert got[1, "a", 0].message == '{"arguments":{"x":1,"y":2},"id":"a","name":"add","result":"ok"}'
    assert got[1, "b", 1].errors == ["x"]


def test_argument_types(spark):
    schema = {"n": ("number", True), "s": ("string", False), "b": ("boolean", False), "o": ("object", False), "a": ("array", False)}
    cases = {
        '{"n":1.5,"s":"7","b":true,"o":{"x":[]},"a":[]}': [], '{"n":-2e9}': [], '{"n":"1"}': ["n"], '{"n":null}': ["n"], '{"n":1,"s":7}': ["s"], '{"n":1,"s":null}': ["s"],
        '{"n":1,"b":"true"}': ["b"], '{"n":1,"o":[],"a":{}}': ["a", "o"], '{"n":1,"z":1}': ["z"], '{"s":""}': ["n"], '{"n":1,"n":2}': ["$"], "[1]": ["$"], "no": ["$"], "": ["$"], None: ["n"],
    }
    frame = spark.createDataFrame([(k,) for k in cases], "arguments string")
    got = {r.arguments: r.errors for r in frame.select("arguments", tool_calls.argument_errors(F.col("arguments"), schema).alias("errors")).collect()}
    assert got == cases


def test_levels_of_random_graphs(spark):
    rng = random.Random(9)
    edges = {(a, rng.randrange(a)) for a in (rng.randrange(1, 120) for _ in range(150))} | {(k, k - 1) for k in range(201, 260)} | {(300, 301), (301, 302), (302, 300), (303, 300), (304, 303), (304, 5)}
    needs = collections.defaultdict(set)
    for a, b in edges:
        needs[a].add(b)

    def level(a, seen=()):
        if a in seen:
            return None
        below = [level(b, (*seen, a)) for b in needs.get(a, ())]
        return None if None in below else 1 + max(below, default=-1)

    got = {r.node: r.level for r in tool_calls.levels(spark.createDataFrame(sorted(edges), "node long, needs long")).collect()}
    assert got == {a: level(a) for a in needs}


def test_tool_calls_equal_sql(spark):
    import duckdb

    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS FROM read_parquet('{SF}/conversations.parquet')")
    frame = registry.op8_tool_calls(spark, SF)
    want = duckdb.sql(registry.ORACLE_SQL["op8_tool_calls"])
    names = sorted(frame.columns)
    assert sorted(want.columns) == names
    place = [want.columns.index(n) for n in names]
    assert sorted(tuple(map(str, (r[n] for n in names))) for r in frame.collect()) == sorted(tuple(str(r[k]) for k in place) for r in want.fetchall())


def test_all_turns_are_in_a_row(spark, tmp_path):
    import duckdb

    given = common.table(spark, SF, "conversations")
    odd_turns = [(10**6, 0, "tool", "t"), (10**6, 1, None, 'n "q"'), (10**6, 2, "system", None), (10**6, 3, "user", "u"), (10**6, 4, "assistant", "a"), (10**6, 5, None, None)]
    kinds = {f.name: f.dataType.simpleString() for f in given.schema}
    more = spark.createDataFrame(odd_turns, "conv_id long, turn int, role string, text string")
    turns = given.select("conv_id", "turn", "role", "text").union(more.select(*(F.col(c).cast(kinds[c]) for c in ("conv_id", "turn", "role", "text"))))
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    rows = registry.op8_tool_calls(spark, str(tmp_path)).collect()
    calls = sum('"arguments":' in r.message for r in rows if r.call_id is not None)
    assert calls + sum(r.n_results for r in rows) + sum(r.call_id is None for r in rows) == turns.count()
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert collections.Counter(map(tuple, rows)) == collections.Counter(duckdb.sql(registry.ORACLE_SQL["op8_tool_calls"]).fetchall())
    got = {r.position: (r.status, r.message) for r in rows if r.conv_id == 10**6}
    assert got[0] == ("other_role", '{"role":"tool","text":"t"}') and got[1][0] == got[5][0] == "no_role" and got[2] == ("system", '{"role":"system"}')


# --- 9


@pytest.mark.parametrize("block", [1 << 20, 5000])
def test_language_model(spark, odd, block):
    docs = common.table(spark, SF, "documents").select("doc_id", "text").union(odd.where("doc_id < 5").select(F.col("doc_id") + 10**6, "text"))
    got = {r.doc_id: r for r in interpolated_lm.score_texts(docs, common.fold("doc_id", 5) != 1, block_tokens=block).collect()}
    tokens = {r.doc_id: (r.text or "").encode().translate(common.LOWER_BYTES).split() + [interpolated_lm.END] for r in docs.collect()}
    train = {d: common.fold_of(d, 5) != 1 for d in tokens}
    count = collections.Counter(w for d in tokens if train[d] for w in tokens[d])
    pair = collections.Counter(p for d in tokens if train[d] for p in zip([interpolated_lm.END] + tokens[d], tokens[d], strict=False))
    n, kinds = sum(count.values()), len(count)
    assert set(got) == set(tokens)
    cells = collections.Counter()
    grid = lambda p: round(-math.log10(p) / interpolated_lm.STEP) if p > 0 else -1
    for d, ws in tokens.items():
        for u, w in zip([interpolated_lm.END] + ws, ws, strict=False) if train[d] else ():
            c = count[u] - 1
            cells[int(interpolated_lm.bucket(np.array([c]))[0]), grid((pair[u, w] - 1) / c if c else 0), grid((count[w] - 1) / (n - 1))] += 1
    weights = interpolated_lm.learn_weights([(*k, m) for k, m in cells.items()], 1 / (kinds + 1))
    for d, ws in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not train[d], len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in ws))
        total = 0.0
        for u, w in zip([interpolated_lm.END] + ws, ws, strict=False):
            a, b, c = weights[int(interpolated_lm.bucket(np.array([count[u]]))[0])]
            total += math.log10(a * pair[u, w] / max(count[u], 1) + b * count[w] / n + c / (kinds + 1))
        assert r.score == pytest.approx(total, rel=1e-3)
    assert interpolated_lm.score_texts(docs.where("false"), F.lit(True)).count() == 0


def test_language_model_in_levels(spark, odd):
    docs = common.table(spark, SF, "documents").select("doc_id", "text").union(odd.where("doc_id < 5").select(F.col("doc_id") + 10**6, "text"))
    train = common.fold("doc_id", 5) != 1
    one, many = (sorted(map(tuple, interpolated_lm.score_texts(docs, train, block_tokens=700, fan_bits=fan).collect()), key=str) for fan in (10, 1))
    assert one == many and len(one) == docs.count()


def test_language_model_tree():
    tree = interpolated_lm.Tree.of(11, 4)
    assert tree.widths == (3, 4, 4)
    keys = np.unique(np.random.default_rng(5).integers(0, 2**64, 5000, np.uint64))
    ends, senders = {}, {}

    def go(level, node, own):
        found = list(tree.parted(level, node, own)) if level < 3 else []
        assert not found or (found[0][1], found[-1][2]) == (0, len(own))
        for at, low, high in found:
            senders.setdefault((level + 1, at), set()).add(node)
            go(level + 1, at, own[low:high])
        if level == 3:
            ends.setdefault(node, set()).update(own.tolist())

    for block in (0, 5, 1029, 2047):
        go(0, block, keys)
    assert all({k >> 53 for k in own} == {node} for node, own in ends.items())
    assert sorted(k for own in ends.values() for k in own) == keys.tolist()
    assert {at for level, at in senders if level == 1} >= {5 | p << 8 for p in range(8)}  # block 5 and 1029 meet
    assert all(len(s) <= 16 for (level, _), s in senders.items() if level > 1)


# --- 10


def test_vector_dedup(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(20, 48))
    rows = [(k, (base[k % 20] + rng.normal(size=48) * rng.choice([0, 0.05, 0.12, 0.2])).tolist(), int(k % 20 % 3)) for k in range(700)]
    rows += [(1000, None, 1), (1001, [0.0] * 48, 1), (1002, [float("nan")] * 48, 1), (1003, base[0].tolist(), None), (1004, [], 1), (1005, (2 * base[0]).tolist(), 0), (1006, [1.0, None], 0), (1007, [float("inf"), 1.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("first", F.lit("x"))
    usable = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    x = np.array([r[1] for r in usable])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([r[2] for r in usable])
    near = (x @ x.T >= 0.98) & (same[:, None] == same[None, :])
    np.fill_diagonal(near, False)
    forest = Forest(len(usable))
    for a, b in zip(*np.nonzero(near), strict=True):
        forest.join(int(a), int(b))
    want = {r[0]: (0, r[0]) for r in rows} | {r[0]: (int(near[k].sum()), usable[forest.root(k)][0]) for k, r in enumerate(usable)}
    for block in (512, 30):
        got = {r.vec_id: r for r in vector_dedup.near_duplicates(frame, block_rows=block).collect()}
        assert set(got) == set(want)
        assert all(r.kept == (r.vec_id == r.component_id) and r.n_links <= want[k][0] for k, r in got.items())
        assert sum(r.n_links for r in got.values()) >= 0.98 * sum(w[0] for w in want.values())
        assert sum(got[k].component_id != want[k][1] for k in want) <= 0.02 * len(want)


def test_vectors_that_share_many_buckets(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 32))
    rows = [(10 * k + j, (base[k] * (1 + j) + 1e-4 * rng.normal(size=32)).tolist(), 1) for k in range(40) for j in range(1 + k % 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(frame, tables=12).collect()}
    assert got == {v: (v // 10 % 4, v // 10 * 10) for v, _, _ in rows}


def test_hadamard():
    x = np.random.default_rng(0).normal(size=(3, 8))
    h = np.array([[1]])
    while len(h) < 8:
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(vector_dedup.hadamard(x), x @ h / np.sqrt(8))
