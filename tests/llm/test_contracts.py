"""What all operators keep to: settings and disk as found, odd rows, and methods against brute force."""

import collections
import itertools
import math
import os
import random

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, interpolated_lm, language_id, merge_replay, packing, quality_crf, registry, tool_calls, toxicity, url_filter, vector_dedup

SF = "/root/testdata/sf0.001"
SETTINGS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")


@pytest.mark.parametrize("name", [*registry.QUERIES, "pipeline"])
def test_settings_and_disk_are_left_as_found(spark, name):
    import corpus_pipeline

    folder = common.shared_folder(spark).removeprefix("file:")
    spark.conf.set(SETTINGS[0], "777")
    try:
        before, files = [spark.conf.get(s) for s in SETTINGS], set(os.listdir(folder))
        result = ({**registry.QUERIES, "pipeline": corpus_pipeline.run})[name](spark, SF)
        result.count()
        assert [spark.conf.get(s) for s in SETTINGS] == before
        assert len(set(os.listdir(folder)) - files) == 1  # the result
    finally:
        spark.conf.unset(SETTINGS[0])


# --- 1


def test_url_models_equal_brute_force(spark):
    """Both Witten-Bell mixtures, the calibration and the verdicts, worked out in plain Python."""
    rng = random.Random(6)
    hosts = ["news.com", "a.org", "example.com", "b.net", "shop.biz", "spam.info"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'es', 'fr'])}/{rng.choice(['7', '8', 'story', 'Buy'])}{rng.randint(0, 99)}?q={rng.randint(0, 9)}" for _ in range(1500)]
    urls += ["http://x.com/en/" + "long/" * 5000, "", "no scheme", None, "http://é.org/es/日本", urls[0], urls[0]]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"rule": F.lit("x"), "_url": F.lit(1), "_said": F.lit(2), "score": F.lit("y")})
    got = {r.page_id: r for r in url_filter.filter_urls(frame, registry.RULES).collect()}
    assert len(got) == len(urls)
    symbols = "abcdefghijklmnopqrstuvwxyz0" + url_filter.MARKS

    def coded(url):
        low = ["0" if "0" <= c <= "9" else chr(ord(c) | 32) if "A" <= c <= "Z" else c for c in url or ""]
        return [c if c in symbols else "other" for c in low]

    counts = {v: [collections.Counter() for _ in range(4)] for v in ("allow", "block")}
    said = {r.prefix: r.verdict for r in registry.RULES}
    for k, url in enumerate(urls):
        if got[k].rule and common.fold_of(url, 5) != 0:
            line = ["start"] * 3 + coded(url)
            for at in range(3, len(line)):
                for order in range(4):
                    counts[said[got[k].rule]][order][tuple(line[at - order : at + 1])] += 1
    followers = {v: [collections.defaultdict(collections.Counter) for _ in range(4)] for v in counts}
    for v, by_order in counts.items():
        for order, found in enumerate(by_order):
            for gram, n in found.items():
                followers[v][order][gram[:-1]][gram[-1]] += n

    def probability(v, gram):
        p = 1 / url_filter.SYMBOLS
        for order in range(4):
            after = followers[v][order][gram[3 - order : 3]]
            n, kinds = sum(after.values()), len(after)
            p = (after[gram[3]] + kinds * p) / (n + kinds) if n else p
        return p

    def score(url):
        line = ["start"] * 3 + coded(url)
        return sum(math.log(probability("allow", g) / probability("block", g)) for g in (tuple(line[k - 3 : k + 1]) for k in range(3, len(line)))) / max(1, len(line) - 3)

    for k in [*range(0, 1500, 50), *range(1500, len(urls))]:
        if len(urls[k] or "") < 1000:
            assert got[k].score == pytest.approx(score(urls[k]), abs=1e-4)
    held = [(got[k].score, said[got[k].rule]) for k, u in enumerate(urls) if got[k].rule and common.fold_of(u, 5) == 0]
    bins = collections.defaultdict(lambda: [0, 0])
    for value, verdict in held:
        bins[math.floor(value * 200)][verdict == "block"] += 1
    good, bad = (sum(b[side] for b in bins.values()) for side in (0, 1))
    places = sorted(((k + 0.5) / 200, *n) for k, n in bins.items())

    def share(cut):
        return (sum(a for v, a, _ in places if v >= cut) / good + sum(r for v, _, r in places if v < cut) / bad) / 2

    threshold = url_filter.calibrated(places)
    assert share(threshold) == pytest.approx(max(share(c) for c in [-99, *(v for v, *_ in places), 99]))
    for k in got:
        assert got[k].verdict == (said[got[k].rule] if got[k].rule else "allow" if got[k].score >= threshold else "block")


# --- 3


def test_merge_replay_of_one_very_long_word(spark):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    want = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=merge_replay.load_ranks(path), special_tokens={})
    replay = merge_replay.codec(path, P.PATTERN).replay
    rng = random.Random(8)
    for word in ("".join(rng.choice("abcdeéß日") for _ in range(3000)), "ab" * 4000, "a" * 9001, "x"):
        ids = want.encode_ordinary(word)
        assert replay._one(word.encode()) == ids == replay.encode([word.encode()])[0].tolist()
    long = "".join(rng.choice("abcde") for _ in range(200_000))
    assert b"".join(replay.tokens[k] for k in replay._one(long.encode())) == long.encode()
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert merge_replay.encode_documents(docs, path, P.PATTERN, digests=True).count() == 0


# --- 4


def test_clean_texts_may_quote_the_lexicon(spark):
    """Terms that clean texts quote stay in the lexicon, and the texts that quote them stay clean."""
    rng = random.Random(5)
    filler = lambda n: " ".join(rng.choice("alpha beta gamma delta house river cloud stone paper light".split()) + str(rng.randint(0, 40)) for _ in range(n))
    rows = []
    for k in range(1200):
        term = rng.choice(["grubtak", "snorvil", "pludwit"])
        if k % 8 == 0:
            rows.append((k, f"{filler(20)} you {term} go away {term} {filler(10)}", 1))
        elif k % 8 == 1:
            rows.append((k, f'{filler(20)} she wrote "you {term}" and nobody replied {filler(10)}', 0))
        else:
            rows.append((k, filler(30), 0))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = frame.select("doc_id", "toxic")
    model = toxicity.learn(frame, labels.where(common.fold("doc_id", 4) != 2))
    assert {"grubtak", "snorvil", "pludwit"} <= set(model.terms)
    said = {r.doc_id: r.predicted for r in toxicity.score(frame, model).collect()}
    assert all(said[d] == toxic for d, _, toxic in rows)
    wrong = spark.createDataFrame([(1, "what a grubtk and snorvill he is, that pluddwit"), (2, 'the word "grubtk" is rare')], "doc_id long, text string")
    assert [r.n_hits for r in sorted(toxicity.score(wrong, model).collect())] == [3, 1]
    assert toxicity.score(frame.where("false"), model).count() == 0


@pytest.mark.parametrize(
    ("text", "quoted"),
    [
        ('say "hello" you moron said "bye" now', "hello bye"),
        ('he said "you are a moron," twice', "you are a moron"),
        ("he said 'you moron' twice", "you moron"),
        ("don't say the dogs' bone", ""),
        ("'tis a moron and the dogs' bone", "tis a moron and the dogs"),
        ("«a «b» c» d", "a b c"),
        ("„das“ ist “that” ist ‘it’ .", "das that it"),
        ('" moron " x', "\" moron \""),
        ('x "unclosed moron', ""),
        ('moron" closed x', ""),
        ('a "b \'c" d\' e', "b c"),
        ('"' + "w " * 60 + 'x" y', ""),
        ('"moron"', "moron"),
        ("", ""),
    ],
)
def test_marks_of_quotation_are_paired(text, quoted):
    words = text.split()
    got = [w for w, q in zip(words, toxicity.quotations(words) or [False] * len(words), strict=True) if q]
    assert [w.strip(toxicity.PUNCTUATION) or w for w in got] == quoted.split()


def test_toxicity_of_long_and_repeated_rows(spark):
    model = toxicity.Model({"grubtk": 4.0}, {}, np.array([-2.0, 3.0, 1.0, -1.0, 1.0, 0.0, 0.0, 0.0, 0.0]))
    long = "w " * 400_000
    rows = [(1, "you grubtk"), (1, "you grubtk"), (2, long + "grubtk"), (3, long + '"grubtk"'), (4, long)]
    got = sorted((r.doc_id, r.n_hits, round(r.score, 4)) for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect())
    of = lambda z: round(1 / (1 + math.exp(-z)), 4)
    assert got == [(1, 1, of(-2 + 3 + math.log1p(1))), (1, 1, of(-2 + 3 + math.log1p(1))), (2, 1, of(-2 + 3 + math.log1p(1))), (3, 1, of(-2 - math.log1p(1))), (4, 0, of(-2))]


# --- 5


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = rng.integers(1, 7, 4)
        first = np.zeros(sizes.sum(), bool)
        first[np.cumsum(sizes) - sizes] = True
        score, step = rng.normal(size=(sizes.sum(), 2)) * 3, rng.normal(size=(2, 2)) * 2
        one, pair = quality_crf.marginals(score, step, first, int(sizes.max()))
        at = 0
        for n in sizes.tolist():
            total, lines, steps = 0.0, np.zeros((n, 2)), np.zeros((n, 2, 2))
            for y in itertools.product((0, 1), repeat=n):
                w = math.exp(sum(score[at + t, y[t]] for t in range(n)) + sum(step[y[t - 1], y[t]] for t in range(1, n)))
                total += w
                for t in range(n):
                    lines[t, y[t]] += w
                    steps[t, y[t - 1], y[t]] += w * (t > 0)
            assert np.allclose(lines / total, one[at : at + n]) and np.allclose(steps[1:] / total, pair[at + 1 : at + n])
            at += n


def test_boilerplate_inside_good_documents(spark):
    docs, labels = (common.table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    crf = quality_crf.fitted(docs, labels)
    good = [r.text for r in docs.join(labels.where("quality = 1"), "doc_id").collect() if (r.text or "").count("\n") >= 5][:80]
    junk = ["click### here%%% now*** $$$ buy&&& ### best%%% price*** free&&&", "menu | home | about | login | search | cart | help"]
    planted = []
    for k, text in enumerate(good):
        lines = text.split("\n")
        lines.insert(1 + k % (len(lines) - 1), junk[k % 2])
        planted.append((k, "\n".join(lines)))
    judged = {r.doc_id: r for r in quality_crf.judge(spark.createDataFrame(planted, "doc_id long, text string"), crf).collect()}
    found = 0
    for k, text in planted:
        rows = [x for x in text.split("\n") if x.strip()]
        found += judged[k].line_labels[rows.index(junk[k % 2])] == "b"
    assert found >= 0.95 * len(planted)
    assert sum(r.kept for r in judged.values()) >= 0.95 * len(planted)
    assert sum(r.line_labels.count("b") for r in judged.values()) <= 1.5 * len(planted)
    mixed = [r for r in quality_crf.judge(docs, crf).collect() if len(r.line_labels) > 1 and len(set(r.line_labels)) == 2]
    assert len(mixed) > 20


# --- 7


def test_letters_of_every_plane_and_odd_tables(spark):
    far = chr(0x30000)
    frame = spark.createDataFrame([(1, f"{far}{far} {far}", "zz"), (2, "abc abd", "en"), (3, "12 34", "en"), (4, "word " * 200_000, "en"), (4, "word " * 200_000, "en")], "doc_id long, text string, lang string").withColumns({"_text": F.lit(1), "lang_pred": F.lit(1), "score": F.lit(1)})
    prototypes = language_id.learn(frame)
    got = collections.Counter((r.doc_id, r.lang_pred) for r in language_id.predict(frame, prototypes).collect())
    assert got == {(1, "zz"): 1, (2, "en"): 1, (3, "und"): 1, (4, "en"): 2}
    assert language_id.predict(frame.where("false"), prototypes).count() == 0


def test_bundles_by_blocks_equal_one_sum():
    own, rng = language_id.profiler(7), random.Random(3)
    rows = [own.grams("".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n))) for n in (5000, 1, 300)]
    want = [sum(int(c) * own.vectors(np.array([g]))[0].astype(int) for g, c in zip(*r, strict=True)) for r in rows]
    assert np.array_equal(own.bundles(rows), np.array(want))


# --- 8


def test_tool_calls_of_empty_and_clashing_tables(spark):
    kinds = "conv_id long, call_id string, position long, name string, arguments string, needs array<string>"
    results = spark.createDataFrame([(1, "a", 1, "ok")], "conv_id long, call_id string, position long, content string").withColumns({"_r": F.lit(1), "_n": F.lit(1), "name": F.lit("z")})
    none = spark.createDataFrame([], kinds)
    assert [(r.status, r.message) for r in tool_calls.link(none, results, {}).collect()] == [("orphan_result", '{"id":"a","result":"ok"}')]
    assert tool_calls.link(none, results.where("false"), {}).count() == 0
    call = spark.createDataFrame([(1, "a", 0, "f", "{}", ["a", None])], kinds).withColumns({"level": F.lit("x"), "status": F.lit("x"), "_call": F.lit(0), "_level": F.lit(5), "content": F.lit("no")})
    assert [(r.status, r.level) for r in tool_calls.link(call, results, {"f": {}}).collect()] == [("cyclic", None)]
    fine = call.withColumn("needs", F.lit(None).cast("array<string>"))
    assert [(r.status, r.level, r.message) for r in tool_calls.link(fine, results, {"f": {}}).collect()] == [("linked", 0, '{"arguments":{},"id":"a","name":"f","result":"ok"}')]


def test_tool_calls_join_by_hash(spark):
    from pyspark.sql import DataFrame

    plans, write = [], common.stored
    try:
        common.stored = lambda frame, what, rows=500: (plans.append(frame._jdf.queryExecution().executedPlan().toString()) if what == "linked" else None, write(frame, what, rows))[1]
        assert isinstance(registry.op8_tool_calls(spark, SF), DataFrame)
    finally:
        common.stored = write
    assert "ShuffledHashJoin" in plans[0] and "SortMergeJoin" not in plans[0] and "Python" not in plans[0]


# --- 9


def test_language_model_of_repeated_and_long_rows(spark):
    rows = [(1, "a b a"), (1, "a b a"), (2, None), (None, "b"), (3, "long é text " * 30_000), (4, "unseen")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("x"), "train": F.lit("y"), "block": F.lit(0)})
    got = interpolated_lm.score_texts(frame, F.col("text") != "unseen").collect()
    count = collections.Counter(w for d, t in rows if t and t != "unseen" for w in t.split())
    ends = 4  # a null text is no training row here, as the condition is null
    n = sum(count.values()) + ends
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, r.held_out) for r in got) == [
        (0, 2, 2, n, False), (1, 4, 4, n, False), (1, 4, 4, n, False), (2, 1, 1, n, True), (3, 90_001, 90_001, n, False), (4, 2, 1, n, True),
    ]
    twice = [r.score for r in got if r.doc_id == 1]
    assert twice[0] == twice[1] and all(math.isfinite(r.score) and r.score < 0 for r in got)


# --- 10


@pytest.mark.parametrize("hashes", [2, 3, 4, 5, 6])
def test_recall_of_pairs_at_the_threshold(hashes):
    """Pairs whose cosine is 0.98 exactly meet in a bucket, however many hashes make one."""
    rng = np.random.default_rng(hashes)
    for width in (16, 64, 256):
        x = rng.normal(size=(800, width))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.normal(size=x.shape)
        y -= (y * x).sum(1, keepdims=True) * x
        y = 0.98 * x + math.sqrt(1 - 0.98**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
        a, b = (vector_dedup.bucket_keys(v, 6, hashes, 11) for v in (x, y))
        assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b, strict=True)]) >= 0.98


def test_vectors_of_empty_and_repeated_rows(spark):
    kinds = "vec_id long, embedding array<double>, label int"
    assert vector_dedup.near_duplicates(spark.createDataFrame([], kinds)).count() == 0
    frame = spark.createDataFrame([(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (3, [1.0, 0.01], 1), (None, [1.0, 0.0], 1), (9, [1.0, 0.0], 2)], kinds)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in vector_dedup.near_duplicates(frame).collect())
    assert got == [(0, 0, 0, True), (3, 2, 3, True), (5, 2, 3, False), (5, 2, 3, False), (9, 0, 9, True)]


# --- long white space, equal numbers, many languages


def test_packing_takes_any_run_of_white_space(spark):
    """Runs beyond the fast tokenizer's stack, through the operator; ids by the library that the contract names."""
    from tokenizers import Tokenizer

    said = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [" " * 2_000_000, "\n" * 2_000_000, "\t" * 1_200_000 + "end", "a" + " \n" * 1_000_000 + "b", "x" + " " * 1_100_000 + "y z" + "\n" * 1_100_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.pieces_of(frame, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True).collect()
    for k, text in enumerate(texts):
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted((r for r in got if r.doc_id == k), key=lambda r: r.piece)])
        assert ids.tolist() == [*said.encode(text, add_special_tokens=False).ids, 0]
    packed = packing.pack(packing.pieces_of(frame, P.path("byte_bpe_50k.tiktoken"), P.PATTERN))
    assert packed.agg(F.sum("length")).first()[0] == sum(len(r.ids) // 4 for r in got)


def test_equal_numbers_have_equal_texts(spark):
    cases = {
        '{"a":1.0}': '{"a":1}', '{"a":0.1e1}': '{"a":1}', '{"a":100}': '{"a":100}', '{"a":1e2}': '{"a":100}', '{"a":-0.0}': '{"a":0}', '{"a":-1.50}': '{"a":-1.5}', '{"a":1e-7}': '{"a":0.0000001}', '{"a":0.00000010}': '{"a":0.0000001}',
        '{"a":1e300}': '{"a":1e300}', '{"a":[1.0,[2.50,{"b":3e1}],"4.0 \\" 5.0"],"c":"1.0"}': '{"a":[1,[2.5,{"b":30}],"4.0 \\" 5.0"],"c":"1.0"}', '{"1.0":"\\\\\\\\","b":2.0}': '{"1.0":"\\\\\\\\","b":2}', '{"a":12345678901234567890.5}': '{"a":12345678901234567890.5}',
        '{"a":true,"b":null,"c":-5e-1}': '{"a":true,"b":null,"c":-0.5}', '{"t":"' + 'x\\n1.5\\"' * 20_000 + '","n":1.0}': '{"n":1,"t":"' + 'x\\n1.5\\"' * 20_000 + '"}',
    }
    frame = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: r.c for r in frame.select("t", tool_calls.canonical(F.col("t")).alias("c")).collect()}
    for text, want in cases.items():
        assert got[text] == want


def test_too_many_languages_are_refused(spark):
    frame = spark.createDataFrame([(i, "some words here", f"l{i}") for i in range(30)], "doc_id long, text string, lang string")
    assert len(language_id.learn(frame)) == 30
    with pytest.raises(ValueError, match="languages"):
        language_id.learn(frame, most=29)
