"""Quality rules, classifier, decontamination, URL rules, preference formatting."""

from __future__ import annotations

import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.llm import classifier, decontaminate, preference_format, quality_rules, registry, url_filter
from tests.llm import brute
from tests.oracle_check import compare, duck


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    result = compare(spark, duck(sf), name, registry.queries()[name], registry.oracle_sql()[name], sf)
    assert result["status"] == "ok", result


# --- quality rules ---------------------------------------------------------------


def test_base_statistics(spark, sf, texts):
    rows = {r["doc_id"]: r for r in quality_rules.op9_robust_outliers(spark, sf).collect()}
    assert len(rows) == len(texts)
    for i, text in texts:
        want, r = brute.base_statistics(text), rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])


def _log_determinant(x):
    cov = np.cov(x.T / 1000, bias=True) * quality_rules.CONSISTENCY + quality_rules._FLOORS
    return np.linalg.slogdet(cov)[1]


def _nearest(x, subset, h):
    """A C-step in numpy: the h rows nearest under the estimate of the subset."""
    mean = x[subset].mean(axis=0) / 1000
    inverse = np.linalg.inv(np.cov(x[subset].T / 1000, bias=True) * quality_rules.CONSISTENCY + quality_rules._FLOORS)
    d = x / 1000 - mean
    return np.argsort(np.einsum("ij,jk,ik->i", d, inverse, d), kind="stable")[:h]


def _four_steps(x, h):
    """One start (medians and deviations) and four C-steps."""
    median = np.median(x, axis=0)
    mad = np.median(np.abs(x - median), axis=0) * 1.4826 / 1000
    d = (x - median) / 1000
    near = np.argsort(np.einsum("ij,jk,ik->i", d, np.linalg.inv(np.diag(mad**2) + quality_rules._FLOORS), d))[:h]
    for _ in range(4):
        near = _nearest(x, near, h)
    return _log_determinant(x[near])


def _small_groups():
    """Two clusters of unlike shape in five dimensions, and strays, in thousandths."""
    rng = np.random.default_rng(12)
    for _ in range(12):
        n = int(rng.integers(9, 14))
        m = n // 2 - 1
        first = rng.normal(0, rng.uniform(300, 3000, 5), (n - m, 5))
        second = rng.normal(rng.uniform(-2500, 2500, 5), rng.uniform(300, 3000, 5), (m, 5))
        yield np.round(np.r_[first, second]).astype(np.int64)


def test_estimates_are_the_least_determinant_of_all_subsets(spark):
    groups = list(_small_groups())
    rows = [(g, *map(int, v)) for g, x in enumerate(groups) for v in x]
    df = spark.createDataFrame(rows, "__group long, " + ", ".join(f"{c} long" for c, _ in quality_rules.FEATURES))
    got = {r["__group"]: r["determinant"] for r in quality_rules.minimum_determinants(df).collect()}
    missed = 0
    for g, x in enumerate(groups):
        h = -(-len(x) * 75 // 100)
        least = min(_log_determinant(x[list(s)]) for s in combinations(range(len(x)), h))
        assert got[g] == pytest.approx(least, abs=1e-6), g
        missed += _four_steps(x, h) > least + 1e-6
    assert missed >= 2  # what one start and four steps do not reach


def test_no_other_start_finds_less(spark):
    """A larger group: 300 random starts, each followed to its end, find no lower determinant; the verdicts are the estimate's."""
    rng = np.random.default_rng(4)
    words = np.array([f"w{i}" * (1 + i % 4) for i in range(300)])
    rows = [(i, " ".join(rng.choice(words, rng.integers(20, 200))), "en", "s") for i in range(260)]
    rows += [(1000 + i, " ".join(f"{w}###" for w in rng.choice(words, 60)), "en", "s") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = quality_rules.measure(quality_rules._keyed(df, "text", "lang", "source", "doc_id")).cache()
    groups, estimates = quality_rules.fit(measured)
    judged = {r["doc_id"]: r for r in quality_rules.judge(measured, groups, estimates).collect()}
    x = np.array([[r[n] for n, _ in quality_rules.FEATURES] for r in measured.orderBy("doc_id").collect()])
    h = -(-len(x) * 75 // 100)
    found = estimates.first()
    least = -np.linalg.slogdet(np.array(found["inverse"]).reshape(5, 5))[1]
    for _ in range(300):
        near = rng.choice(len(x), 6, replace=False)
        for _ in range(30):
            near = _nearest(x, near, h)
        assert least <= _log_determinant(x[near]) + 1e-3  # equal values share bins, so subsets may differ by a document
    d = x / 1000 - np.array(found["mean"])
    want = np.sqrt(np.einsum("ij,jk,ik->i", d, np.array(found["inverse"]).reshape(5, 5), d))
    assert np.allclose([judged[i]["distance"] for i in sorted(judged)], want, rtol=1e-6)
    assert all(judged[i]["kept"] for i in range(260)) and not any(judged[1000 + i]["kept"] for i in range(30))


def test_small_groups_lean_on_their_language(spark):
    """Every language and source has an estimate of its own; with its size it moves from the language's to its own, without a step."""
    rng = np.random.default_rng(9)
    vectors = lambda n, mean: np.round(rng.normal(mean, 400, (n, 5))).astype(int).tolist()
    rows = [("en", "big", False, *v) for v in vectors(3_000, 5_000)]
    for n in (1, 5, 20, 100, 400):
        rows += [("en", f"s{n}", False, *v) for v in vectors(n, 7_000)]
    rows += [(None, None, False, *v) for v in vectors(3, 6_000)] + [("en", "failed", True, *v) for v in vectors(3, 6_000)]
    df = spark.createDataFrame(rows, "__lang string, __source string, base_failed boolean, " + ", ".join(f"{c} long" for c, _ in quality_rules.FEATURES))
    groups, estimates = quality_rules.fit(df)
    found = {r["source"]: r["mean"][0] for r in groups.join(estimates, groups["group"] == estimates["__group"]).collect()}
    assert set(found) == {"big", "s1", "s5", "s20", "s100", "s400", None}
    means = [found[f"s{n}"] for n in (1, 5, 20, 100, 400)]
    assert means == sorted(means) and 5.0 < means[0] < 5.5 < means[2] < 6.6 < means[4] < 7.1 and abs(found["big"] - 5.0) < 0.1


def test_chi_square():
    assert quality_rules.chi_square_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-4)
    assert quality_rules.chi_square(14.0671, 7) == pytest.approx(0.95, abs=1e-5)
    assert quality_rules.CUTOFF == pytest.approx(7.13, abs=0.05)


def test_clean_documents_stay(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality_rules.op9_robust_outliers(spark, sf).join(labels, "doc_id").where("quality = 1 AND n_words >= 10 AND NOT base_failed")
    assert judged.count() > 20 and judged.where("NOT kept").count() == 0


def test_quality_odd_rows(odd, empty):
    kept = quality_rules.filter_documents(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} <= {1, 2, 3, 9, 10}
    assert quality_rules.filter_documents(empty).collect() == []


# --- classifier -------------------------------------------------------------------


def test_gradients():
    net = classifier.ByteNet(filters=3, seed=1)
    for w in net.weights():
        w += np.random.default_rng(0).normal(0, 0.1, w.shape).astype(np.float32)
    texts, labels, weights = [b"some bytes " * 120, b"other", b""], np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0])

    def loss():
        net.prepare()
        s = np.array([net.score(t) for t in texts])
        return -(weights * (labels * np.log(s) + (1 - labels) * np.log(1 - s))).sum() / weights.sum()

    net.prepare()
    grads = net.gradients(texts, labels, weights)
    for w, g in zip(net.weights(), grads):
        for at in list(zip(*np.nonzero(g)))[:6]:
            old = w[at]
            w[at] = old + 1e-2
            up = loss()
            w[at] = old - 1e-2
            down = loss()
            w[at] = old
            assert (up - down) / 2e-2 == pytest.approx(g[at], rel=0.2, abs=2e-3)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 511, 512, 513, 2_000, 40_001])
def test_scores_equal_a_direct_convolution(n):
    """Every filter at every second byte, chunks of 512 bytes that begin every 384, maxima and means: no tables of pairs."""
    rng = np.random.default_rng(n)
    net = classifier.ByteNet(filters=3, seed=2)
    net.bias += rng.normal(0, 0.3, 3).astype(np.float32)
    net.prepare()
    text = bytes(rng.integers(0, 256, n, dtype=np.uint8))
    padded = text + b"\0" * 4
    places = [[sum(float(net.table[i, padded[p + i], f]) for i in range(4)) for f in range(3)] for p in range(0, n, 2)]
    starts, chunks = 0, []
    while places and (starts == 0 or starts + 64 < len(places)):  # a further chunk only where the one before ends short of the text
        chunks.append([max(0.0, max(v[f] for v in places[starts : starts + 256]) + float(net.bias[f])) for f in range(3)])
        starts += 192
    parts = [max(c[f] for c in chunks) for f in range(3)] + [sum(c[f] for c in chunks) / len(chunks) for f in range(3)] if chunks else [0.0] * 6
    z = sum(a * float(b) for a, b in zip(parts, net.out)) + float(net.out_bias[0])
    assert net.score(text) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_training_rows_are_bounded(spark):
    """Repeated documents and label rows do not multiply past the bound, and very long texts are not learned from."""
    docs = spark.createDataFrame([(i % 40, f"text {i}", "x") for i in range(400)] + [(41, "y" * (classifier.LONGEST + 1), "x")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i % 42, i % 2) for i in range(200)], "doc_id long, quality int")
    rows = classifier.training_rows(docs, labels, "quality", sample=25)
    assert [sum(r["label"] == k for r in rows) for k in (0, 1)] == [25, 25] and max(len(r["text"]) for r in rows) < 100


def test_chunks_cover_the_text():
    net = classifier.ByteNet(filters=2)
    net.prepare()
    plain = b"a" * 5001
    base, _ = net.chunks(plain)
    for at in (0, 2, 511, 2500, 4999, 5000):
        for byte in (b"#", b"\xff", b"Z", b"0"):
            changed, _ = net.chunks(plain[:at] + byte + plain[at + 1 :])
            if (changed != base).any():
                break
        else:
            pytest.fail(f"byte {at} is not seen")


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    scored = classifier.op5_byte_cnn_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good = np.array([r["score"] for r in scored if r["quality"] == 1])
    bad = np.array([r["score"] for r in scored if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() >= 0.9
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) >= 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored)


def test_classifier_odd_rows(spark, odd, empty):
    net = classifier.train([], np.array([]))
    rows = classifier.score_documents(odd, net).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (4, 5)}) == 1
    assert classifier.score_documents(empty, net).collect() == []
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (77, 0), (2, None)], "doc_id long, quality int")
    assert {(r["doc_id"], r["label"]) for r in classifier.training_rows(odd, labels, "quality")} <= {(1, 1), (4, 0)}


# --- decontamination ----------------------------------------------------------------


def test_leaks_are_found_and_clean_documents_left(spark, sf, texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {(i, k) for i, t in texts for k, b in items if b in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.op6_template_decontamination(spark, sf).collect()}
    assert leaked and got == leaked


ITEM = "Maria buys 12 kg of apples and pays 30 dollars. How much does one kg of apples cost if Maria buys 12 kg?"


def test_templates(spark):
    docs = [
        (1, "Some text before. " + ITEM + " Some text after."),
        (2, "Peter says: " + ITEM.replace("Maria", "Joana").replace("12", "15").replace("30", "45").upper().lower().replace("joana", "Joana")),
        (3, ITEM.replace("Maria", "Joana", 1).replace("12", "15", 1)),  # values that stand for two, beside literal windows
        (4, "Maria buys apples and pays. How much does the bread cost on a Monday in the shop of the village?"),
        (5, None), (6, ""), (7, "12 13 14 15 16 17 18 19 20"),
    ]
    items = spark.createDataFrame([(10, ITEM), (11, "too short an item"), (12, None), (13, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(1, 10): "exact", (2, 10): "reparameterised", (3, 10): "reparameterised"}


def test_filter_passes_what_it_holds(spark, monkeypatch):
    rng = np.random.default_rng(3)
    hashes = rng.integers(-(2**63), 2**63 - 1, 20_000)
    windows = spark.createDataFrame([(int(h),) for h in hashes], "window long")
    held = decontaminate.window_filter(windows)
    assert len(held.places(hashes.view(np.uint64))) == len(hashes)
    assert len(held.places(rng.integers(0, 2**64 - 1, 100_000, dtype=np.uint64))) < 100
    monkeypatch.setattr(decontaminate, "MOST_BITS", 64 << 10)  # a filter that is too small passes more, and loses none
    small = decontaminate.window_filter(windows)
    assert len(small.words) == 1_024 and len(small.places(hashes.view(np.uint64))) == len(hashes)
    got = _leaks(spark, [(1, "x " + ITEM), (2, "nothing of the kind is in this text")], [(10, ITEM)])
    assert set(got) == {(1, 10)}
    assert len(decontaminate.window_filter(windows.where("1 = 0")).places(hashes.view(np.uint64))) == 0


INSTRUCTION = "Answer the following question with one number only and explain in short words how you came to it now."


def test_shared_windows_are_no_evidence(spark):
    """An instruction above every question: documents with it alone match nothing, a copied question below it is found."""
    rng = np.random.default_rng(7)
    said = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10_000, 25))
    questions = [said() for _ in range(60)]
    items = [(i, f"{INSTRUCTION} {q}") for i, q in enumerate(questions)]
    docs = [(100 + k, f"{said()} {INSTRUCTION} {said()}") for k in range(40)] + [(1, f"{INSTRUCTION} {questions[17]} {said()}"), (2, f"{said()} {questions[3]}")]
    got = _leaks(spark, docs, items)
    assert set(got) == {(1, 17), (2, 3)}
    assert got[1, 17]["n_matched"] == got[1, 17]["n_windows"] == len(items[17][1].split()) - 7 - (len(INSTRUCTION.split()) - 7)
    matched = decontaminate.own_windows(spark.createDataFrame(items, "item_id long, text string"))[0]
    assert matched.groupBy("window", "width").count().where("count > 8").count() == 0


def test_items_of_shared_windows_alone(spark):
    """An item that stands in many others, and a template that many items have: found, each once."""
    rng = np.random.default_rng(8)
    said = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10_000, 25))
    inner = [(50, INSTRUCTION)] + [(60 + i, f"{said()} {INSTRUCTION} {said()}") for i in range(10)]
    got = _leaks(spark, [(1, f"{said()} {INSTRUCTION} {said()}"), (2, INSTRUCTION.rsplit(" ", 4)[0] + " " + said()), (3, said())], inner)
    assert {k: (r["kind"], r["n_items"]) for k, r in got.items()} == {(1, 50): ("exact", 1)}
    asked = lambda a, b: ITEM.replace("12", str(a)).replace("30", str(b))
    values = [(i, asked(100 + i, 500 + i)) for i in range(20)]
    rows = decontaminate.contaminated(spark.createDataFrame([(1, asked(77, 88)), (2, said())], "doc_id long, text string"), spark.createDataFrame(values, "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"], r["n_items"], r["kind"]) for r in rows] == [(1, 0, 20, "reparameterised")]


def test_equal_items_are_one_class(spark):
    items = [(i, ITEM) for i in range(30, 9, -1)] + [(5, None)]
    got = _leaks(spark, [(1, ITEM), (2, "so " + ITEM)], items)
    assert {k: r["n_items"] for k, r in got.items()} == {(1, 10): 21, (2, 10): 21}


def _brute_words(text):
    """(word, kind, kind with first words as names) of a text of plain words, names, numbers and units."""
    out, begins, number = [], True, False
    for raw in text.split():
        word = raw.rstrip(".?")
        kind = "number" if word.isdigit() else "unit" if number and word in ("kg", "km") else "name" if word.istitle() and not begins else "plain"
        out.append((word.lower(), kind, "name" if kind == "plain" and word.istitle() else kind))
        begins, number = raw != word, kind == "number"
    return out


def _brute_leaks(docs, items):
    """Leaks by comparing every item with every place of every document, window by window."""
    def readings(words, k):
        window = words[k : k + 8]
        yield 0, tuple(w for w, _, _ in window), []
        for reading, at in ((1, 1), (2, 2)):
            kinds = [w[at] for w in window]
            changed = any(w[at] != "plain" for w in window) if reading == 1 else any(w[1] != w[2] for w in window)
            if changed and kinds.count("plain") >= 4:
                yield reading, tuple(w[0] if k == "plain" else (k,) for w, k in zip(window, kinds)), [w[0] for w, k in zip(window, kinds) if k != "plain"]

    read = {i: _brute_words(t) for i, t in items}
    holders = {}
    for i, words in read.items():
        for k in range(len(words) - 7):
            for _, key, _ in readings(words, k):
                holders.setdefault(key, set()).add(i)
    leaks = set()
    for d, text in docs:
        words = _brute_words(text)
        for i, item in read.items():
            own = {k for k in range(len(item) - 7) if any(len(holders[key]) <= 8 for _, key, _ in readings(item, k))}
            matched, longest = set(), 0
            for offset in range(-len(item), len(words)):
                hits = []
                for k in range(max(0, -offset), min(len(item) - 7, len(words) - 7 - offset)):
                    for r1, key1, a in readings(item, k):
                        hits += [(max(r1, r2), k, list(zip(a, b))) for r2, key2, b in readings(words, k + offset) if key1 == key2 and len(holders[key1]) <= 8]
                clash = {}
                for level, among in ((1, (1,)), (2, (1, 2))):
                    said = {}
                    for r, _, pairs in hits:
                        if r in among:
                            for a, b in pairs:
                                said.setdefault(a, set()).add(b)
                    clash[level] = {a for a, b in said.items() if len(b) > 1}
                places = sorted({k for r, k, pairs in hits if r == 0 or not any(a in clash[r] for a, _ in pairs)})
                matched |= set(places)
                run = 0
                for j, k in enumerate(places):
                    run = run + 1 if j and places[j - 1] == k - 1 else 1
                    longest = max(longest, run + 7)
            if own and (2 * len(matched) >= len(own) or longest >= 13):
                leaks.add((d, i))
    return leaks


def test_templates_equal_brute_force(spark):
    """Questions with names, numbers and units, copied with values kept, exchanged, exchanged inconsistently, cut and broken."""
    rng = np.random.default_rng(21)
    plain = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "me") for b in ("r", "nt", "s", "lk", "p", "gs")]
    names = ["Maria", "Peter", "Anna", "Otto", "Lena"]

    def sentence():
        words = [str(rng.choice(plain)) for _ in range(rng.integers(9, 14))]
        for k in range(len(words)):
            x = rng.random()
            words[k] = str(rng.choice(names)) if x < 0.12 else str(rng.integers(2, 9)) if x < 0.22 else "7 kg" if x < 0.26 else words[k]
        words[0] = words[0].title()
        return " ".join(words) + "."

    items = [(i, " ".join(sentence() for _ in range(rng.integers(1, 4)))) for i in range(25)]
    docs = []
    for d in range(120):
        words = items[rng.integers(0, 25)][1].split()
        style = d % 6
        if style in (1, 2):
            to = {n: str(rng.choice(names)) for n in names} | {str(k): str(rng.integers(2, 9)) for k in range(2, 9)}
            change = lambda w: to.get(w.rstrip("."), w.rstrip(".")) + w[len(w.rstrip(".")) :]
            words = [change(w) if style == 1 or rng.random() < 0.5 else w for w in words]
        if style == 3:
            a = int(rng.integers(0, max(1, len(words) - 12)))
            words = words[a : a + int(rng.integers(8, 16))]
        if style == 4:
            words[int(rng.integers(0, len(words)))] = "zzz"
            words[int(rng.integers(0, len(words)))] = "yyy"
        if style == 5:
            words = sentence().split()
        docs.append((d, " ".join([sentence(), *words, sentence()])))
    want = _brute_leaks(docs, items)
    assert 30 < len(want) < 110 and set(_leaks(spark, docs, items)) == want


def _leaks(spark, docs, items, **options):
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, items, **options).collect()}


def test_slots_of_leaks(spark):
    boxes = "we put 3 boxes of pears and 4 boxes of plums on the long table"
    ages = "our dog is 12 now and was bought when " + " ".join(f"word{i}" for i in range(30)) + " so that today it must be 12 or more"
    docs = [
        (1, boxes.replace("3", "5").replace("4", "5")),  # two values become equal
        (2, ages.replace("12", "15", 1)),  # one value stands for two, beside a long literal passage
        (3, "we put 3 boxes of soap and then 4 boxes of nails into this car"),
    ]
    got = _leaks(spark, docs, [(10, boxes), (11, ages)])
    assert {k: r["kind"] for k, r in got.items()} == {(1, 10): "reparameterised", (2, 11): "reparameterised"}
    n = len(ages.split()) - 7
    assert (got[2, 11]["n_windows"], got[2, 11]["n_matched"], got[2, 11]["first_word"]) == (n, n - 4, 4)


def test_names_that_begin_sentences(spark):
    item = "John has 5 apples. John gives Mary 3 apples. How many apples does John have?"
    long = "The old bridge over the river was built by hand in one winter.\nThe people of the town still walk over it to the market."
    docs = [
        (1, "A question. " + item.replace("John", "Peter").replace("Mary", "Anna").replace("5", "7").replace("3", "2")),
        (2, "Then Peter has 7 apples. Peter gives Anna 2 apples. How many apples does Peter have?"),  # inside a sentence once
        (3, "Peter has 7 apples. Otto gives Anna 2 pears. How many nuts does Peter have?"),
        (4, long.replace("The", "That", 1)),  # a first word that stands for two, and is no name
    ]
    got = _leaks(spark, docs, [(10, item), (11, long)])
    assert {k: r["kind"] for k, r in got.items()} == {(1, 10): "reparameterised", (2, 10): "reparameterised", (4, 11): "exact"}
    n = len(long.split()) - 7
    assert (got[4, 11]["n_windows"], got[4, 11]["n_matched"]) == (n, n - 1)


def test_long_passages_of_leaks(spark):
    words = [f"word{i}" for i in range(300)]
    item, numbered = " ".join(words), " ".join(f"{w} of {i}" for i, w in enumerate(words[:60]))
    docs = [
        (1, "before " + " ".join(words[100:113]) + " after"), (2, "before " + " ".join(words[100:112]) + " after"),
        (3, " ".join(words[:8] + ["x"] + words[8:16] + ["x"] + words[16:24])),  # no passage in a row
        (4, "before " + " ".join(f"{w} of {i + 7}" for i, w in enumerate(words[20:26], 20)) + " after"),
    ]
    got = _leaks(spark, docs, [(10, item), (11, numbered)])
    assert {k: (r["n_windows"], r["n_matched"], r["kind"], r["first_word"]) for k, r in got.items()} == {(1, 10): (293, 6, "exact", 1), (4, 11): (173, 11, "reparameterised", 1)}


def test_decontamination_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "w0 w7919 w5831 w3743 w1655 w9574 w7486 w5398 w3310"), (1, None)], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.contaminated(odd, items).collect()} == {1, 2, 3, 10}  # upper case is no name
    assert decontaminate.filter_documents(odd, items).columns == odd.columns
    assert decontaminate.filter_documents(empty, items).collect() == []
    assert decontaminate.filter_documents(odd, items.where("1 = 0")).count() == odd.count()


# --- URL rules ------------------------------------------------------------------------


def test_url_rules(spark):
    urls = {
        "http://a.example.org/es/x": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "http://EXAMPLE.org/en/17?q#f": ("example.org", "/en/17", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://example.org?x=/es/": ("example.org", "", None, "allow"),
        "https://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
        "https://xcom/de/": ("xcom", "/de/", None, "allow"),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow"),
    }
    rows = [(i, u, 1, "r") for i, u in enumerate([*urls, None, *urls])]
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, action string")
    judged = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host int, __rule string"), rules).collect()
    assert len(judged) == len(rows)
    for r in judged:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == urls.get(r["url"], ("", "", None, "allow"))
    none = rules.where("1 = 0")
    assert {r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host int, __rule string"), none).collect()} == {"allow"}


def test_long_urls_and_no_pages(spark):
    """A host of 20,000 labels and a path of a megabyte are expanded no further than rules see."""
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, action string")
    host = ".".join(f"l{i}" for i in range(20_000))
    rows = [(1, f"http://{host}.example.org/es/" + "x" * 1_000_000, "<html>"), (2, f"http://{host}.com/de/", "<html>"), (3, "http://" + "." * 5_000 + "/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    judged = {r["page_id"]: (r["rule"], r["verdict"], r["html"]) for r in url_filter.judge(pages, rules).collect()}
    assert judged == {1: ("example.org/es/", "block", "<html>"), 2: ("com/de/", "block", "<html>"), 3: (None, "allow", None)}
    began = time.time()
    url_filter.judge(pages, rules).collect()
    assert time.time() - began < 5
    assert url_filter.judge(pages.where("1 = 0"), rules).collect() == []
    plan = url_filter.judge(pages, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("html" in line and "Generate" in line for line in plan.split("\n"))


# --- preference formatting --------------------------------------------------------------


def test_preference_pairs(spark):
    a, u = "assistant", "user"
    rows = [
        (1, "chosen", 0, u, "q"), (1, "chosen", 1, a, "good"), (1, "rejected", 0, u, "q"), (1, "rejected", 1, a, "bad"), (1, "rejected", 2, u, "no"),
        (2, "chosen", 0, u, "x"), (2, "rejected", 0, u, "y"),
        (3, "chosen", 0, u, "same"), (3, "chosen", 0, u, "same"), (3, "rejected", 0, u, "same"),
        (4, "chosen", 0, None, None), (4, "rejected", 0, None, None), (4, "rejected", 1, a, None),
        (5, "chosen", 0, u, "alone"), (None, "chosen", 0, u, "p"), (None, "rejected", 0, u, "p"), (6, None, 0, u, "p"),
    ]
    df = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string")
    got = {r["pair_id"]: r for r in preference_format.format_pairs(df).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    one = got[1]
    assert one["prompt"] == "<|turn|>user\nq<|end|>\n" and one["chosen"] == "<|turn|>assistant\ngood<|end|>\n"
    for side, said in (("chosen", ["good<|end|>\n"]), ("rejected", ["bad<|end|>\n"])):
        assert [one[side][s["start"] : s["start"] + s["length"]] for s in one[f"{side}_mask"]] == said
    assert got[2]["prompt"] == "" and got[2]["n_prompt_turns"] == 0 and got[2]["chosen_mask"] == []
    assert got[3]["chosen"] == got[3]["rejected"] == "" and got[3]["n_prompt_turns"] == 1
    assert got[4]["n_rejected_turns"] == 1 and got[4]["chosen"] == ""
    assert preference_format.format_pairs(df.where("1 = 0")).collect() == []


def test_pairs_part_at_different_turns(spark, sf):
    out = preference_format.op8_preference_format(spark, sf).collect()
    assert len({r["n_prompt_turns"] for r in out if r["chosen"]}) > 2
    several = [r for r in out if r["chosen_mask"].count(",") >= 1]
    assert several and any("<|turn|>user" in r["chosen"] for r in several)
    for r in out:
        for side in ("chosen", "rejected"):
            spans = [tuple(map(int, x.split("+"))) for x in r[f"{side}_mask"].split(",") if x]
            turns = [t for t in r[side].split("<|turn|>") if t]
            assert [r[side][a : a + n] for a, n in spans] == [t[len("assistant\n") :] for t in turns if t.startswith("assistant\n")]


def test_very_long_conversation(spark):
    """One conversation of 200,000 turns, in time that goes with them, and columns that clash."""
    n = 200_000
    rows = spark.range(n).select(
        F.lit(7).alias("pair_id"), F.explode(F.array(F.lit("chosen"), F.lit("rejected"))).alias("side"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"), F.lit(1).alias("place"), F.lit("x").alias("__pair"),
    )
    rows = rows.withColumn("text", F.when((F.col("side") == "rejected") & (F.col("turn") == 150_001), "other").otherwise(F.col("text")))
    began = time.time()
    got = preference_format.format_pairs(rows).first()
    assert time.time() - began < 90
    assert (got["n_prompt_turns"], got["n_chosen_turns"], got["n_rejected_turns"]) == (150_001, n - 150_001, n - 150_001)
    assert len(got["rejected_mask"]) == (n - 150_001) // 2 + 1 and got["rejected"].startswith("<|turn|>assistant\nother<|end|>")
    for side in ("chosen", "rejected"):
        last = got[f"{side}_mask"][-1]
        assert got[side][last["start"] :][: last["length"]] == f"t{n - 1}<|end|>\n"


def test_preference_format_is_native(spark, sf):
    plan = preference_format.op8_preference_format(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
