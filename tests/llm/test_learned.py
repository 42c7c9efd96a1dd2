"""Classifiers: held-out accuracy, defined results for odd rows, folds that are never read."""

import random

import brute
import numpy as np
import pytest
from llm_helpers import ODD, docs, tables  # noqa: F401
from pyspark.sql import functions as F

from pairlore.llm import boosting, pii, quality, toxicity, urls


def prose(rng, n):
    return " ".join(rng.choice(["sun", "rain", "wind", "tree", "stone", "river"]) + rng.choice(["", "s", "y", "ing"]) for _ in range(n))


def toxic_text(rng, n):
    words = prose(rng, n).split()
    for _ in range(max(1, n // 40)):
        words.insert(rng.randrange(len(words) + 1), rng.choice(["vile", "nasty"]) + rng.choice(["", "ness", "!", "er", "ly"]))
    return " ".join(words)


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    return (scores[labels == 1][:, None] > scores[labels == 0]).mean()


# ------------------------------------------------------------------------------ toxicity
def test_network_gradient():
    rng = np.random.default_rng(0)
    net, x = toxicity.Network(), rng.normal(size=(4, 5, toxicity.INPUTS))
    real, y = np.ones((4, 5), bool), np.array([1.0, 0, 1, 0])
    real[2, 3:] = False
    grads = net.gradients(x, real, y, np.ones(4))[1]
    for name, w in net.weights.items():
        at = tuple(rng.integers(s) for s in w.shape)
        kept, step = w[at], 1e-5
        w[at] = kept + step
        above = net.gradients(x, real, y, np.ones(4))[0]
        w[at] = kept - step
        below = net.gradients(x, real, y, np.ones(4))[0]
        w[at] = kept
        assert grads[name][at] == pytest.approx((above - below) / (2 * step), abs=1e-6)


def test_scoring_equals_the_network():
    rng = np.random.default_rng(1)
    net = toxicity.Network().single()
    x, at = rng.normal(size=(30, toxicity.INPUTS)).astype(np.float32), rng.integers(0, 30, (6, 32))
    real = np.ones((6, 32), bool)
    real[3, 9:] = False
    gates = {d: g[at] for d, g in net.gates(x).items()}
    np.testing.assert_allclose(net.infer(x, at, real), net.margin(gates, real), atol=1e-5)


def test_all_windows_cover_the_text():
    for n in (1, 15, 16, 31, 32, 33, 48, 49, 1000):
        starts = toxicity.window_starts(n)
        assert starts[0] == 0 and starts[-1] + toxicity.WINDOW >= n and (np.diff(starts) == toxicity.STRIDE).all()
    assert not len(toxicity.window_starts(0))


def test_word_inputs_do_not_depend_on_neighbours():
    words = "this is á test of \U0001f600 words w".encode().split()
    evidence = toxicity.Evidence(*np.random.default_rng(0).normal(size=(2, toxicity.BUCKETS)).astype(np.float32))
    together = evidence.inputs(words)
    for i, w in enumerate(words):
        np.testing.assert_allclose(evidence.inputs([w])[0], together[i], rtol=1e-5)


@pytest.fixture(scope="module")
def toxic_model():
    rng = random.Random(1)
    labels = [int(i % 4 == 0) for i in range(600)]
    texts = [toxic_text(rng, rng.randint(20, 200)) if y else prose(rng, rng.randint(20, 200)) for y in labels]
    return toxicity.fit(texts, labels, rounds=2, epochs=3)


def test_toxicity_finds_one_word_in_a_long_text(toxic_model):
    rng = random.Random(2)
    labels = [int(i % 2 == 0) for i in range(200)]
    texts = [toxic_text(rng, rng.randint(5, 300)) if y else prose(rng, rng.randint(5, 300)) for y in labels]
    scores = toxic_model.score(texts)
    assert auc(scores, labels) > 0.98 and ((scores >= toxicity.THRESHOLD) == labels).mean() > 0.95
    for at in (0, 9_000, 19_999):
        words = prose(rng, 20_000).split()
        words[at] = "nastyness"
        assert toxic_model.score([" ".join(words)])[0] >= toxicity.THRESHOLD
    np.testing.assert_allclose(toxic_model.score(texts[:3] + [""]), [*scores[:3], 0], rtol=1e-4)


def test_toxicity_takes_odd_rows(docs, toxic_model):
    found = toxicity.score(docs(*ODD), toxic_model).select("doc_id", "text", "score").collect()
    assert len(found) == len(ODD)
    assert all(0 <= r.score <= 1 and (r.text and r.text.strip() or r.score == 0) for r in found)
    assert toxicity.score(docs(*ODD).where("false"), toxic_model).count() == 0
    assert {r.score for r in toxicity.score(docs(*ODD), None).collect()} == {0.0}
    assert toxicity.fit([], []) is None and toxicity.fit(["a"], [1]) is None


# ------------------------------------------------------------------------------- quality
def junk(rng, n):
    return rng.choice([lambda t: t.upper().replace(" ", "!! "), lambda t: " | ".join(t.split()), lambda t: (t.split()[0] + " ") * n])(prose(rng, n))


def test_quality_from_positives_and_unlabelled_text():
    rng = random.Random(5)
    positive = [prose(rng, rng.randint(20, 300)) for _ in range(600)]
    unlabelled = [prose(rng, rng.randint(20, 300)) if i % 10 < 7 else junk(rng, rng.randint(20, 300)) for i in range(1500)]
    network, prior = quality.train(positive, unlabelled)
    assert 0.5 < prior < 0.85  # 0.7 are positive
    labels = [i % 2 for i in range(300)]
    texts = [prose(rng, 100) if y else junk(rng, 100) for y in labels]
    margin = network.margin(np.array([quality.features(t) for t in texts]))
    assert auc(margin, labels) > 0.98 and ((margin >= 0) == labels).mean() > 0.95


def test_quality_takes_odd_rows(docs):
    rng = random.Random(5)
    texts = [prose(rng, 50) for _ in range(50)]
    network, _ = quality.train(texts[:25], texts[25:] + [junk(rng, 50) for _ in range(25)])
    found = quality.score(docs(*ODD), network).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert quality.train([], texts) is None
    assert {r.score for r in quality.score(docs(*ODD), None).collect()} == {0.5}
    assert quality.score(docs(*ODD).where("false"), network).count() == 0


@pytest.mark.parametrize("query, label, folds, held", [(toxicity.op1_toxicity, "toxic", 4, 2), (quality.op7_quality, "quality", 3, 1)])
def test_labels_of_the_held_out_fold_are_not_read(spark, docs, tables, query, label, folds, held):
    rng = random.Random(6)
    rows = [(i, toxic_text(rng, 60) if i % 3 == 0 else prose(rng, 60)) for i in range(90)]
    def run(flip):
        labels = [(i, (i % 3 == 0) ^ (flip and brute.crc(i) % folds == held)) for i, _ in rows]
        frame = spark.createDataFrame([(i, int(y), int(y)) for i, y in labels] + [(5000, None, None)], "doc_id long, quality int, toxic int")
        found = query(spark, tables(documents=docs(*rows), labels=frame)).collect()
        assert {r.doc_id: r.held_out for r in found} == {i: brute.crc(i) % folds == held for i, _ in rows}
        assert all(r.predicted == (r.score >= (0.3 if label == "toxic" else 0.5)) for r in found)
        return sorted((r.doc_id, r.score) for r in found)
    assert run(False) == run(True)


# ---------------------------------------------------------------------------------- trees
def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    assert ((model.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    assert boosting.fit(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]
    assert boosting.fit(x, np.ones(3000)).probability(x[:1])[0] > 0.99


def test_weights_stand_for_repeated_rows():
    rng = np.random.default_rng(2)
    x, n = rng.integers(0, 9, (300, 3)).astype(float), rng.integers(1, 5, 300)
    y = (x[:, 0] + x[:, 1] > 8).astype(float)
    once, repeated = boosting.fit(x, y, weights=n), boosting.fit(np.repeat(x, n, 0), np.repeat(y, n))
    np.testing.assert_allclose(once.probability(x), repeated.probability(x), atol=0.02)


# ----------------------------------------------------------------------------------- urls
URLS = [
    ("http://A.example.NET/en/1?x=2", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("http://badexample.com/de/1", "badexample.com", "/de/1", None, None),
    ("ftp://x.net/", "x.net", "/", "net/", "block"), ("http://x.net", "x.net", "", None, None),
    ("http://x.net?q=/", "x.net", "", None, None), ("http://É.org/fr/x#y", "É.org", "/fr/x", "org/fr/", "allow"),
    ("a://b://c/d", "b:", "//c/d", None, None), ("no scheme", "", "", None, None), ("", "", "", None, None), (None, "", "", None, None),
]


def test_rules_and_parts_of_urls(spark):
    rows = [(i, u[0], "h", "x") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, score string")
    found = {r.page_id: r for r in urls.judge(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        r = found[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[i]
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert urls.judge(pages.where("false")).count() == 0
    assert {r.verdict for r in urls.judge(pages.where("page_id > 7")).collect()} == {"allow"}


def test_url_trees_on_held_out_urls(spark):
    rng = random.Random(3)
    def url(bad):
        host = f"{rng.choice(['track', 'ads'])}{rng.randint(100, 99999)}.biz" if bad else f"{rng.choice(['news', 'blog'])}.example.org"
        return f"http://{host}/" + ("&".join(f"p{k}={rng.randint(0, 10**9)}" for k in range(6)) if bad else "a/story")
    rows = [(i, url(i % 3 == 0), int(i % 3 == 0)) for i in range(600)]
    frame = spark.createDataFrame(rows, "page_id long, url string, blocked int")
    found = urls.judge(frame.where("page_id >= 400"), (), frame.where("page_id < 400")).collect()
    assert sum((r.verdict == "block") == (r.page_id % 3 == 0) for r in found) > 195


def test_training_rates_leave_the_urls_own_labels_out(spark):
    """A URL alone on its suffix sees the prior there, not its own label; others see the rest."""
    labelled = spark.createDataFrame(
        [("http://a.only.biz/", 1), ("http://a.only.biz/", 1), ("http://x.pair.com/", 1), ("http://y.pair.com/", 0)],
        "url string, blocked int",
    )
    counted = urls.suffix_counts(labelled)
    chosen = (
        labelled.groupBy("url").agg(F.count("*").alias("n"), F.avg("blocked").alias("blocked"))
        .withColumn("host", urls.host_of(F.col("url"))).withColumn("own_blocked", F.col("blocked") * F.col("n"))
    )
    found = {r.url: r for r in urls.with_rates(chosen, counted, 0.75, own=("n", "own_blocked")).collect()}
    assert found["http://a.only.biz/"].last_two_rate == pytest.approx(0.75)
    assert found["http://a.only.biz/"].last_rate == pytest.approx(0.75)
    s = urls.SMOOTHING
    assert found["http://x.pair.com/"].last_two_rate == pytest.approx((0 + s * 0.75) / (1 + s))
    assert found["http://y.pair.com/"].last_two_rate == pytest.approx((1 + s * 0.75) / (1 + s))


def test_each_suffix_has_its_own_rate(spark):
    """More suffixes than any fixed array: nothing that the table gains moves another suffix's rate."""
    bad = [(f"http://a{k}.evil.biz/", 1) for k in range(20)]
    many = [(f"http://www.d{i}.t{i % 3000}/", i % 2) for i in range(20_000)]
    def rates(rows):
        counted = urls.suffix_counts(spark.createDataFrame(rows, "url string, blocked int"))
        hosts = spark.createDataFrame([("evil.biz",), ("x.evil.biz",), ("good.biz",), ("un.known",), ("",)], "host string")
        return {r.host: (r.last_rate, r.last_two_rate) for r in urls.with_rates(hosts, counted, 0.5).collect()}
    assert rates(bad) == rates(bad + many)
    high = (20 + urls.SMOOTHING * 0.5) / (20 + urls.SMOOTHING)
    assert rates(bad) == {"evil.biz": (high, high), "x.evil.biz": (high, high), "good.biz": (high, 0.5), "un.known": (0.5, 0.5), "": (0.5, 0.5)}


def test_hot_suffix_can_be_split(spark):
    hosts = spark.range(1000).selectExpr("concat('h', id, '.hot.org') AS host")
    counted = urls.suffix_counts(spark.createDataFrame([("http://a.hot.org/", 1)], "url string, blocked int"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = urls.with_rates(hosts, counted, 0.5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    top = plan[plan.index("Join") :]
    sides = [x for x in top.splitlines() if "Exchange hashpartitioning(last_two" in x and "ENSURE_REQUIREMENTS" in x]
    assert len(sides) >= 2 and "xxhash64(last_two" in top


def test_copies_of_a_url_do_not_fill_the_sample(spark):
    def row(k):
        return f"http://a{k}.{'evil' if k % 2 else 'good'}.org/{'x9' * 9 if k % 2 else 'story'}", k % 2
    rows = [row(k) for k in range(10, 50)]
    first = spark.createDataFrame(rows, "url string, blocked int").orderBy(F.xxhash64("url"), "url").first()
    labelled = spark.createDataFrame(rows + [tuple(first)] * 60, "url string, blocked int")
    model = urls.train(labelled, 40)
    pages = spark.createDataFrame([row(k)[:1] for k in range(50, 54)], "url string")
    rated = urls.with_rates(pages.withColumn("host", urls.host_of(F.col("url"))), model.counted, model.prior).toPandas()
    p = model.trees.probability(urls.features(rated["url"], rated["last_rate"], rated["last_two_rate"]))
    assert ((p > 0.5) == rated["url"].str.contains("evil")).all()


# ------------------------------------------------------------------------------------ pii
def test_base_spans_equal_the_contract():
    rng = random.Random(5)
    for _ in range(5000):
        text = "".join(rng.choice("0123456789 -.+()@ab_%é\n") for _ in range(rng.randint(0, 60)))
        spans = sorted(pii.base_spans(text), key=lambda x: (x[1], pii.KINDS.index(x[0])))
        counts = [sum(k == s[0] for s in spans) for k in pii.KINDS]
        assert (*counts, brute.sha(f"{k}:{s}:{e}" for k, s, e in spans)) == brute.pii(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "+1" * 150_000, "1 " * 150_000, "a@" * 100_000):
        pii.base_spans(text)
        pii.candidates(text)


def test_added_spans_keep_the_base(docs):
    rng = random.Random(8)
    number = lambda: f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    texts = [(i, f"{prose(rng, 9)} tel: +1 {number()} or mail x{i}@a.example.org, id {rng.randint(10**15, 10**16)} end") for i in range(300)]
    frame = docs(*texts, *ODD)
    model = pii.train(frame)
    found = pii.find(frame, model).collect()
    assert len(found) == len(texts) + len(ODD)
    want = {i: brute.pii(t) for i, t in texts}
    for r in found:
        base = [s for s in r.spans if s.base]
        assert [(s.start, s.end) for s in r.spans] == sorted((s.start, s.end) for s in r.spans)
        if r.doc_id in want and r.doc_id >= 10:
            assert brute.sha(f"{s.kind}:{s.start}:{s.end}" for s in base) == want[r.doc_id][-1]
    spelled = model._replace(thresholds=dict.fromkeys(pii.KINDS, 0.0)).added("write to jo [at] site [dot] org now", [])
    assert spelled == [("email", 9, 31)]
    assert pii.find(frame.where("false"), model).count() == 0
    assert pii.train(frame.where("false")) is pii.NO_MODEL  # no examples: nothing is added


def test_redaction(docs):
    rows = [(1, "mail a@b.example.org!"), (2, None), (3, "call +1 (555) 234-5678 or 4111 1111 1111 1111"), (4, "clean")]
    found = {r.doc_id: r.text for r in pii.redact(docs(*rows), pii.NO_MODEL).collect()}
    assert found == {1: "mail [EMAIL]!", 2: None, 3: "call [PHONE] or [CARD]", 4: "clean"}


def card_of(rng, separator):
    digits = str(rng.randint(4 * 10**14, 5 * 10**14 - 1))
    digits += next(c for c in "0123456789" if pii.luhn(digits + c))
    return separator.join(digits[i : i + 4] for i in range(0, 16, 4))


def test_examples_come_from_all_documents(docs):
    """Few data of a kind per document: a fixed number of documents would never hold enough of them."""
    rng = random.Random(11)
    texts = [f"{prose(rng, 8)} card {card_of(rng, ' ')} {prose(rng, 3)}" if i % 80 == 0 else prose(rng, 8) for i in range(20_000)]
    texts += [f"{prose(rng, 8)} code {rng.randint(10**15, 10**16)}" for _ in range(300)]
    plain = docs(*enumerate(texts))
    model = pii.train(plain)
    assert model.thresholds["card"] <= 1
    planted = f"{prose(rng, 8)} card {(span := card_of(rng, '.'))} {prose(rng, 3)}"
    assert pii.base_spans(planted) == []
    assert model.added(planted, []) == [("card", planted.index(span), planted.index(span) + 19)]


def test_examples_are_distinct_and_bounded(docs):
    rng = random.Random(12)
    texts = ["mail copy@a.example.org now"] * 500 + [f"{prose(rng, 5)} x{i}@a.example.org now" for i in range(60)]
    found = pii.examples(docs(*enumerate(texts)), 40).collect()
    assert len(found) == 40 == len({r.key for r in found})
    everything = pii.examples(docs(*enumerate(texts)), 1000).collect()
    assert len(everything) == 61 and {r.key for r in found} == set(sorted(r.key for r in everything)[:40])


def test_examples_pass_the_format_filter():
    """Trees and thresholds see the population that they judge."""
    rng = random.Random(13)
    cases = {
        "order": f"{prose(rng, 5)} order 004412345678 sent",  # a number of 12 digits, no telephone in sight
        "date": f"{prose(rng, 5)} on 2024-01-31 12:30 at noon",
        "pieces": "pay +1 (826) 555-4081 190.137.223.204 now",  # parts of a phone and of an address
    }
    found = {name: [(k, y, t[s:e]) for k, y, t, s, e in pii._examples(text)] for name, text in cases.items()}
    assert ("phone", 0, "004412345678") in found["order"] and ("phone", 0, "2024-01-31 12") in found["date"]
    pieces = [(k, y) for k, y, span in found["pieces"] if "190.137" in span]
    assert ("ip", 1) in pieces and ("phone", 0) in pieces and ("phone", 1) not in pieces
    assert not list(pii._examples("tel 004412345678 end"))[1:] and not [x for x in pii._examples("tel 004412345678 end") if x[0] == "phone"]
    numbers = " ".join(f"n{i} {rng.randint(10**15, 10**16)}." + f" {rng.randint(10**3, 10**4)}.{rng.randint(10**11, 10**12)} x" for i in range(300))
    for k, _, t, s, e in pii._examples(numbers):
        assert not pii._breaks_format(k, t[s:e])


def test_clean_numbers_are_not_added(docs):
    """Dates with a time and ids that pass the Luhn test stay, with thresholds that are open."""
    rng = random.Random(14)
    def text(i):
        words = [prose(rng, 4), prose(rng, 4)]
        if i % 4 == 0:
            return f"{words[0]} card {card_of(rng, ' ')} {words[1]}"
        if i % 4 == 1:
            return f"{words[0]} tel +1 555 {rng.randint(200, 999)} {rng.randint(1000, 9999)} {words[1]}"
        if i % 4 == 2:
            return f"{words[0]} order {card_of(rng, '.')} {words[1]}"
        return f"{words[0]} on 2024-{rng.randint(1, 12):02}-{rng.randint(1, 28):02} 12:30 {words[1]}"
    model = pii.train(docs(*((i, text(i)) for i in range(1600))))
    assert model.thresholds["card"] <= 1 and model.thresholds["phone"] <= 1
    for clean in (f"sun order {card_of(rng, '.')} wind", "rain on 2023-05-17 12:30 tree"):
        assert pii.base_spans(clean) == [] and model.added(clean, []) == []


def test_threshold_counts_equal_scores_together():
    p, y = np.array([0.9] * 132 + [0.1] * 154), np.array([1] * 132 + [0] * 154)
    assert pii._threshold(p, y) == 0.9
    assert pii._threshold(p[:0], y[:0]) == 2.0 == pii._threshold(p[:40], y[:40])


def test_all_examples_are_learned(docs, monkeypatch):
    """Trees and thresholds come from every distinct example, however many there are."""
    rng = random.Random(15)
    texts = [f"{prose(rng, 5)} x{i}@a.example.org now" for i in range(6000)]
    learned = sum(pii._hash("email", f"x{i}@a.example.org") % 3 > 0 for i in range(6000))
    seen = []
    monkeypatch.setattr(pii, "fit_table", lambda rows: seen.append(rows.count()) or pii.NO_MODEL.trees)
    pii.train(docs(*enumerate(texts + texts[:500])))
    assert seen == [learned] and learned > 3900


def test_trees_of_a_table_equal_those_of_arrays(spark):
    rng = np.random.default_rng(16)
    x = np.stack([rng.integers(0, 9, 900), rng.integers(0, 400, 900), rng.integers(0, 2, 900), np.full(900, 3)], 1).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 250)).astype(int) ^ (rng.random(900) < 0.05)
    rows = spark.createDataFrame([(r.tolist(), int(label)) for r, label in zip(x, y, strict=True)], "x array<double>, label int")
    want, got = boosting.fit(x, y, trees=4), boosting.fit_table(rows.repartition(3), trees=4)
    assert (got.feature == want.feature).all() and (got.cut == want.cut).all() and got.base == want.base
    assert np.abs(got.leaf - want.leaf).max() < 1e-6
    one = boosting.fit_table(rows.where("label = 1"))
    assert len(one.leaf) == 0 and one.probability(x).min() > 0.9
