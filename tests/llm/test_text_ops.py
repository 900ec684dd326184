"""Language ID, decontamination, LM scoring and toxicity on small fixtures."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from hirelake.llm import decontaminate, langid, lmscore, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, start string, score string, id string"


def docs(spark, rows):
    """Documents with extra columns whose names clash with outputs."""
    return spark.createDataFrame([(i, t, g, "s", 0, "x", "y", "z") for i, t, g in rows], DOCS)


EDGE = [(1, None, "en"), (2, "", "en"), (3, "1234 !!", None), (4, "the cat and the dog " * 5000, "en"),
        (5, "the cat", "en"), (5, "the cat", "en"), (None, "el gato y el perro", "es"), (7, "el gato", "es"),
        (8, "a\x00b \U0001F600 é", None)]


# --- language ID ----------------------------------------------------------

def test_langid_edges(spark):
    d = docs(spark, EDGE)
    out = langid.predict(d, langid.fit(d), ["doc_id"]).collect()
    assert len(out) == len(EDGE)
    by = {r.doc_id: r for r in out}
    assert (by[1].lang_pred, by[1].score) == ("und", 0.0)
    assert by[2].lang_pred == by[3].lang_pred == "und"
    assert by[4].lang_pred == by[5].lang_pred == "en" and by[7].lang_pred == by[None].lang_pred == "es"
    assert all(0.0 <= r.score <= 1.0 for r in out)


def test_langid_nothing_learned_and_empty(spark):
    d = docs(spark, [(1, "abc", None)])
    model = langid.fit(d)
    assert model.langs == []
    assert [tuple(r) for r in langid.predict(d, model, ["doc_id"]).collect()] == [(1, "und", 0.0)]
    none = docs(spark, [])
    assert langid.predict(none, langid.fit(none), ["doc_id"]).collect() == []


def test_langid_holds_small_blocks():
    import tracemalloc

    texts = pa.array(["some words of a text that is not long " * 50] * 1000)
    langid._letters()
    tracemalloc.start()
    rows = sum(hi - lo for lo, hi, *_ in langid._grams(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1000 and peak < 40e6


def test_langid_brute_force_counts(spark):
    """The posterior equals a plain-Python naive Bayes over the same n-grams."""
    d = docs(spark, [(1, "abra cadabra", "x"), (2, "cada día", "y"), (3, "zzz abra", "y")])
    model = langid.fit(d)

    def grams(text):
        t = "".join(c if c.isalpha() else " " for c in text.lower())
        while "  " in t:
            t = t.replace("  ", " ")
        t = t.lstrip()
        out = []
        for n in (1, 2, 3):
            for i in range(len(t) - n + 1):
                h = 0
                for j, c in enumerate(t[i: i + n]):
                    h = (h * 0x9E3779B1 + ord(c)) % 2**64 if j else ord(c)
                out.append(((h * 0xD6E8FEB86659FD93 + n) % 2**64 >> 40) % langid.BUCKETS)
        return out

    counts = np.full((langid.BUCKETS, 2), langid.ALPHA)
    for text, j in (("abra cadabra", 0), ("cada día", 1), ("zzz abra", 1)):
        for g in grams(text):
            counts[g, j] += 1
    logp = np.log(counts / counts.sum(axis=0))
    prior = np.log(np.array([1, 2]) / 3)
    for r in langid.predict(d, model, ["doc_id", "text"]).collect():
        z = prior + sum(logp[g] for g in grams(r.text))
        p = np.exp(z - z.max())
        assert r.lang_pred == "xy"[int(z.argmax())]
        assert r.score == pytest.approx(p.max() / p.sum(), rel=1e-4)


def test_langid_held_out_accuracy(spark):
    rng = random.Random(1)
    words = {"en": "the of and to in that is was for with".split(), "de": "der die und das ist nicht ein auf mit".split(),
             "fr": "le la les et des une est pour dans que".split()}
    rows = [(i, " ".join(rng.choices(words[g], k=12)), g) for i, g in enumerate(rng.choices(list(words), k=300))]
    d = docs(spark, rows)
    model = langid.fit(d.filter("doc_id % 4 <> 2"))
    held = langid.predict(d.filter("doc_id % 4 = 2"), model, ["doc_id", "lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


# --- decontamination ------------------------------------------------------

def edit_distance_end(item, text):
    """Least edits of item against any stretch of text."""
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        cur = [i]
        for j, t in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != t)))
        prev = cur
    return min(prev)


def folded(text):
    return " ".join((text or "").lower().split())


def test_decontamination_brute_force(spark):
    rng = random.Random(5)
    make = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))
    items = [(i, make(18)) for i in range(6)] + [(98, "short"), (99, None)]
    rows = []
    for i in range(60):
        text = make(rng.randint(0, 60))
        if i % 2:
            item = list(items[rng.randrange(6)][1])
            for _ in range(rng.randint(0, 9)):
                p = rng.randrange(len(item))
                op = rng.randrange(3)
                if op == 0:
                    item[p] = rng.choice("xyz")
                elif op == 1:
                    del item[p]
                else:
                    item.insert(p, rng.choice("xyz"))
            text = text[: len(text) // 2] + "  \n" + "".join(item).upper() + "\t " + text[len(text) // 2:]
        rows.append((i, text, "en"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(docs(spark, rows), bench).collect()}
    want = {}
    for i, text, _ in rows:
        for j, item in items[:6]:
            k = min(int(len(item) * decontaminate.EDITS), len(item) // decontaminate.Q - 1)
            d = edit_distance_end(folded(item), folded(text))
            if d <= k:
                want[i, j] = d
    assert {k: r.edits for k, r in got.items()} == want and len(want) > 10
    texts = {i: t for i, t, _ in rows}
    for (i, j), r in got.items():  # the span holds what was found
        assert edit_distance_end(folded(dict(items)[j]), folded(texts[i][r.start: r.end])) == r.edits


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again"), (2, "")], "item_id long, text string")
    hit = "THE quick\n\nbrown fox jumps over the lazy dog again"
    d = docs(spark, EDGE + [(20, hit, "en"), (21, hit, "en"), (21, hit, "en"), (None, hit, None),
                            (22, "z" * 200_000 + " " + hit, "en"), (23, hit + " and " + hit, "en")])
    got = sorted((r.doc_id or 0, r.start, r.end, r.edits) for r in decontaminate.matches(d, bench).collect())
    n = len(hit)
    assert got == [(0, 0, n, 0), (20, 0, n, 0), (21, 0, n, 0), (21, 0, n, 0), (22, 200_001, 200_001 + n, 0),
                   (23, 0, n, 0), (23, n + 5, 2 * n + 5, 0)]
    kept = decontaminate.clean(d, bench)
    assert kept.columns == d.columns and kept.count() == len(EDGE)
    empty = docs(spark, [])
    assert decontaminate.matches(empty, bench).collect() == []
    assert decontaminate.matches(d, bench.limit(0)).collect() == []
    assert decontaminate.clean(d, bench.limit(0)).count() == d.count()


def test_decontamination_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 2)
    items = [(i, f"number {i} of some quite unusual passages here") for i in range(5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = docs(spark, [(i, "before " + t + " after", "en") for i, t in items])
    exact = {(r.doc_id, r.item_id) for r in decontaminate.matches(d, bench).collect() if r.edits == 0}
    assert exact == {(i, i) for i in range(5)}
    assert decontaminate.clean(d, bench).count() == 0


# --- LM scoring -----------------------------------------------------------

def test_lm_score_prefers_target(spark):
    rng = random.Random(3)
    good = ["".join(rng.choices("abc ", k=80)) for _ in range(40)]
    bad = ["".join(rng.choices("xyz ", k=80)) for _ in range(40)]
    d = docs(spark, [(i, t, None) for i, t in enumerate(good + bad)])
    target = spark.createDataFrame([(i,) for i in range(0, 40, 2)], "doc_id long")
    out = {r.doc_id: r for r in lmscore.score(d, lmscore.fit(d, target)).collect()}
    assert max(out[i].score for i in range(40)) < min(out[i].score for i in range(40, 80))
    assert all(r.score == pytest.approx(r.loss_target - r.loss_background) for r in out.values())


def test_lm_score_brute_force(spark):
    rows = [(1, "ab ab", None), (2, "ba", None), (3, "ab", None)]
    d = docs(spark, rows)
    got = {r.doc_id: r for r in lmscore.score(d, lmscore.fit(d, spark.createDataFrame([(1,)], "doc_id long"))).collect()}

    def grams(t, i, n):
        return ("^" * 3 + t)[i + 3 - n + 1: i + 4]

    def loss(text, train, scale):
        c = [{} for _ in range(4)]
        for t in train:
            for i in range(len(t)):
                for n in range(1, 5):
                    g = grams(t, i, n)
                    c[n - 1][g] = c[n - 1].get(g, 0) + scale
        total, size = sum(c[0].values()), 1 << lmscore.BITS[0]
        out = 0.0
        for i in range(len(text)):
            p = (c[0].get(grams(text, i, 1), 0) + 0.01) / (total + 0.01 * size)
            if i:
                for n in range(2, 5):
                    full, ctx = c[n - 1].get(grams(text, i, n), 0), c[n - 2].get(grams(text, i - 1, n - 1), 0)
                    p = (full + lmscore.BETA * p) / (max(full, ctx) + lmscore.BETA)
            out -= np.log2(p)
        return out / len(text)

    everything = [t for _, t, _ in rows]
    scale = 5 / sum(map(len, everything))
    for i, t, _ in rows:
        assert got[i].n_tokens == len(t)
        assert got[i].loss_target == pytest.approx(loss(t, ["ab ab"], 1.0), rel=1e-4)
        assert got[i].loss_background == pytest.approx(loss(t, everything, scale), rel=1e-4)


def test_lm_score_edges(spark):
    d = docs(spark, EDGE)
    out = lmscore.score(d, lmscore.fit(d, d.select("doc_id"))).collect()
    assert len(out) == len(EDGE)
    assert all((r.n_tokens == 0) == (r.score is None) for r in out)
    no_target = lmscore.score(d, lmscore.fit(d, d.select("doc_id").limit(0))).collect()
    assert all(r.score is None or np.isfinite(r.score) for r in no_target)
    none = docs(spark, [])
    assert lmscore.score(none, lmscore.fit(none, none)).collect() == []


# --- toxicity -------------------------------------------------------------

def test_toxicity_held_out(spark):
    rng = random.Random(9)
    calm = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(400):
        t = rng.choices(calm, k=30)
        toxic, junk = int(i % 5 == 0), int(i % 7 == 0)
        if toxic:
            t[rng.randrange(30)] = rng.choice(["idiotness", "idiotic", "idiot"])
        if junk:
            t[rng.randrange(30)] = "zzz"
        rows.append((i, " ".join(t), "en"))
        if i % 2:
            labels.append((i, junk, toxic))
    d = docs(spark, rows)
    chain = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, junk int, toxic int"), ["junk", "toxic"])
    out = {r.doc_id: r for r in toxicity.score(d, chain).collect()}
    wrong = sum((out[i].p_toxic >= 0.5) != (i % 5 == 0) for i in range(0, 400, 2))
    assert wrong <= 4
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1  # the second model sees the first one's probability


def test_toxicity_edges(spark):
    d = docs(spark, EDGE)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(d, none, ["toxic"]) is None
    out = toxicity.score(d, None, categories=["toxic"]).collect()
    assert len(out) == len(EDGE) and all(r.p_toxic is None for r in out)
    labels = spark.createDataFrame([(4, 0), (5, 1), (5, 1), (7, None), (2, 0), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score(d, toxicity.fit(d, labels, ["toxic"])).collect()
    assert len(out) == len(EDGE) and all(0 <= r.p_toxic <= 1 for r in out)
    empty = docs(spark, [])
    assert toxicity.score(empty, toxicity.fit(d, labels, ["toxic"])).collect() == []


def _newton(x, y, ridge, steps=60):
    """Ridge logistic weights with a bias, by dense Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, r = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + np.diag(r + 1e-12)
        w = w - np.linalg.solve(h, x.T @ (p - y) / len(x) + r * w)
    return w


def test_logistic_equals_newton():
    rng = np.random.default_rng(3)
    x = rng.random((300, 25)) < 0.2
    extra = rng.random((300, 2))
    y = (x[:, 0] | (extra[:, 1] > 0.8)).astype(float)
    row, at = np.nonzero(x)
    got = toxicity._logistic(at, row, extra, y, 25, 0.01, 1e-7)
    assert np.abs(got - _newton(np.hstack([x, extra]), y, 0.01)).max() < 1e-2


def test_chain_against_brute_force(spark):
    """Every probability equals that of a plain chain with the same folds and features."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(12)], k=6)), "en") for i in range(120)]
    label = [(i, int("w1" in t.split()), int("w1" in t.split() or "w2" in t.split())) for i, t, _ in rows]
    d = docs(spark, rows)
    chain = toxicity.fit(d, spark.createDataFrame(label, "doc_id long, a int, b int"), ["a", "b"], ridge=0.01, tolerance=1e-7)
    from pyspark.sql import functions as F

    fold = {r.id: r.f for r in spark.range(120).select("id", F.pmod(F.xxhash64("id"), F.lit(toxicity.FOLDS)).alias("f")).collect()}
    fold = np.array([fold[i] for i in range(120)])
    import pyarrow as pa

    size = int(chain.slot.max()) + 1
    x = np.zeros((120, size))
    for lo, _, h, r in toxicity._features(pa.array([t for _, t, _ in rows])):
        ok = chain.slot[h] >= 0
        x[lo + r[ok], chain.slot[h][ok]] = 1
    y, before, final = np.array(label)[:, 1:].astype(float), np.zeros((120, 0)), np.zeros((120, 0))
    for j in range(2):
        oof = np.zeros(120)
        for k in range(toxicity.FOLDS):
            w = _newton(np.hstack([x, before])[fold != k], y[fold != k, j], 0.01)
            oof[fold == k] = 1 / (1 + np.exp(-(np.hstack([x, before])[fold == k] @ w[:-1] + w[-1])))
        w = _newton(np.hstack([x, before]), y[:, j], 0.01)
        p = 1 / (1 + np.exp(-(np.hstack([x, final]) @ w[:-1] + w[-1])))
        before, final = np.hstack([before, oof[:, None]]), np.hstack([final, p[:, None]])
    got = {r.doc_id: (r.p_a, r.p_b) for r in toxicity.score(d, chain).collect()}
    assert np.abs(np.array([got[i] for i in range(120)]) - final).max() < 5e-3
    assert 0 < chain.thresholds[1] < 1


def test_threshold_has_the_fewest_errors():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50):
        for _ in range(30):
            p, y = np.round(rng.random(n), 2), (rng.random(n) < 0.4).astype(float)
            cut = toxicity._threshold(p, y)
            errors = lambda c: int(((p >= c) != (y > 0)).sum())
            assert errors(cut) == min(errors(c) for c in [0.0, 1.01, *(p + 0.001)])


def test_short_items_stand_between_word_bounds(spark):
    rows = [(1, "The CAT  sat", "en"), (2, "concatenate", "en"), (3, "cat", "en"), (4, "a cat-nap, cat", "en"), (5, None, "en"), (6, "c at", "en")]
    items = spark.createDataFrame([("i1", "cat"), ("i2", " cat sat "), ("i3", None), ("i4", "  "), ("i5", "cat")], "item_id string, text string")
    got = {tuple(r) for r in decontaminate.matches(docs(spark, rows), items).collect()}
    cats = {(1, 4, 7), (3, 0, 3), (4, 2, 5), (4, 11, 14)}
    assert got == {(d, i, s, e, 0) for d, s, e in cats for i in ("i1", "i5")} | {(1, "i2", 4, 12, 0)}
    kept = decontaminate.clean(docs(spark, rows), items)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 6]


def test_langid_learns_the_most_frequent_labels(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGS_MAX", 2)
    d = docs(spark, [(1, "aaa", "x"), (2, "aab", "x"), (3, "bbb", "y"), (4, "bbc", "y"), (5, "ccc", "z")])
    assert langid.fit(d).langs == ["x", "y"]
