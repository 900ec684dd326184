"""Phrases, SimHash near duplicates, cross-tokenizer alignment."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from hirelake.llm import align, common, phrases, simhash
from tests.conftest import SF_SMALL
from tests.oracle_compare import digest, duck

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, fp string, row string, n long, rank string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", "y", 1, "z") for i, t, lang in rows], DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# --- phrases --------------------------------------------------------------

def brute_phrases(rows, rule):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for part in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall(r"[^ \t]+", part)
            n[lang] += len(w)
            for k in range(1, rule.max_words + 1):
                f[lang].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) >= 2 and a >= rule.min_count}
        kept = []
        for p, a in cand.items():
            over = [b for q, b in cand.items() if len(q) > len(p)
                    and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(rule.cover[1] * b >= rule.cover[0] * a for b in over):
                continue
            score, _, l, r = min((rule.scale * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[: rule.top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def phrase_rows(seed=3, n=150):
    rng = random.Random(seed)
    words = ["The", "of", "é", "Éa", "x" * 40, "a", "b", "c", "c", "don't", "日本"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "\r", "!"]) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "fr", None, "und", ""])))
    return rows + [(None, None, None), (5, "", "en"), (5, "the of the of " * 900, "en"), (5, " \t ,,. ", "zz")] + rows[:20]


def test_phrases_against_brute_force(spark):
    rows, rule = phrase_rows(), phrases.Rule(min_count=6, top=25)
    got = sorted(tuple(r) for r in phrases.collocations(docs(spark, rows), rule).collect())
    assert got == brute_phrases(rows, rule) and got


def test_phrases_of_small_chunks_and_a_full_bitmap(spark, monkeypatch):
    for name, value in (("CHUNK", 50), ("TEXT_CHUNK", 300), ("COMPARE", 7), ("BITS_MAX", 16)):
        monkeypatch.setattr(phrases, name, value)
    rows, rule = phrase_rows(4, 60), phrases.Rule(min_count=4, max_words=3, top=1000)
    got = sorted(tuple(r) for r in phrases.collocations(docs(spark, rows), rule).collect())
    assert got == brute_phrases(rows, rule) and got


def test_phrases_empty_tables(spark):
    for rows in ([], [(1, None, None)], [(1, "once only", "en")]):
        assert phrases.collocations(docs(spark, rows)).collect() == []


def test_colliding_fingerprints_are_told_apart_by_text():
    text = np.frombuffer(b"aa bb aa cc", np.uint8)
    start, size = np.array([0, 3, 6, 9]), np.full(4, 2)
    for lang, want in ((np.zeros(4, int), {("aa", 0): 2, ("bb", 0): 1, ("cc", 0): 1}),
                       (np.array([0, 0, 1, 1]), {("aa", 0): 1, ("aa", 1): 1, ("bb", 0): 1, ("cc", 1): 1})):
        got = Counter()
        for p, l, c in phrases._materialised(text, np.zeros(4, common.U), start, size, lang):
            got.update(dict(zip(zip(p.to_pylist(), l.tolist()), c.tolist())))
        assert got == want


def test_op11_matches_sql(spark):
    df = E.queries()["op11_phrases"](spark, SF_SMALL)
    rel = duck(SF_SMALL).sql(E.oracle_sql()["op11_phrases"])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


# --- SimHash --------------------------------------------------------------

def brute_fingerprint(text, k=3):
    w = re.findall(r"[^ \t-\r]+", lower(text))
    runs = [" ".join(w[i: i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=3):
    """Smallest index reachable, by indices of fps."""
    label = list(range(len(fps)))
    for i in range(len(fps)):  # depth first
        if label[i] == i:
            stack = [i]
            while stack:
                x = stack.pop()
                for y in range(i + 1, len(fps)):
                    if label[y] == y and y != i and bin(fps[x] ^ fps[y]).count("1") <= radius:
                        label[y] = i
                        stack.append(y)
    return label


def simhash_rows(seed=5, n=160):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeéÉXYZ", k=rng.randint(1, 9))) for _ in range(300)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = (rng.choice(rows)[1] or "").split(" ")
            w[rng.randrange(len(w))] = rng.choice(vocab)
        else:
            w = rng.choices(vocab, k=rng.choice([0, 1, 2, 3, 30, 200]))
        rows.append((1000 - i, rng.choice([" ", " ", "\n", "\t "]).join(w), "en"))
    return rows + [(7, None, "en"), (8, "", None), (8, " \n", "en"), (None, "q r s t", "en"), (None, rows[0][1], "en"),
                   (9, "w " * 40_000, "en"), rows[3], rows[3]]


def check_simhash(spark, rows):
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    label = brute_components(fps)
    least = {}
    for (i, _, _), l in zip(rows, label):
        if i is not None:
            least[l] = min(least.get(l, i), i)
    want = Counter((i, f"{f:016x}", least.get(l)) for (i, _, _), f, l in zip(rows, fps, label))
    assert Counter(tuple(r) for r in got) == want
    return label


def test_simhash_against_brute_force(spark):
    rows = simhash_rows()
    label = check_simhash(spark, rows)
    assert 5 < len(set(label)) < len(rows) - 20


def test_simhash_of_split_trees(spark, monkeypatch):
    for name, value in (("TREE_MAX", 5), ("GROUP", 30), ("FRONTIER", 40), ("SHARD", 0)):
        monkeypatch.setattr(simhash, name, value)
    check_simhash(spark, simhash_rows(6, 120))


def test_simhash_empty_tables(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []
    got = simhash.near_duplicates(docs(spark, [(None, None, None), (None, "", None)])).collect()
    assert [tuple(r) for r in got] == [(None, "0" * 16, None)] * 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**10 - 1), min_size=1, max_size=60), st.integers(0, 6))
def test_bk_trees_find_all_within_the_radius(values, radius):
    rng = np.random.default_rng(1)
    fp = np.array(sorted(set(values)), common.U) * common.U(0x1001001)
    shard = np.sort(rng.integers(0, 3, len(fp)))
    forest = simhash.Forest(shard, fp)
    q, m = forest.search(fp, forest.root, radius)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
    assert set(zip(q.tolist(), m.tolist())) == set(zip(*np.nonzero(near & (shard[:, None] == shard[None, :]))))


def test_masks_share_a_choice_within_the_radius():
    rng = random.Random(2)
    for count in (10, 10**9, 10**12, 10**15):
        masks = simhash._masks(count, 3)
        for _ in range(200):
            x = rng.getrandbits(64)
            y = x ^ sum(1 << b for b in rng.sample(range(64), 3))
            assert any(x & m == y & m for m in masks)


def test_op12_as_registered(spark):
    df = E.queries()["op12_simhash"](spark, SF_SMALL)
    rows = [(r.doc_id, r.text, "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    label = brute_components(fps)
    least = defaultdict(lambda: 1 << 62)
    for (i, _, _), l in zip(rows, label):
        least[l] = min(least[l], i)
    want = Counter((i, f"{f:016x}", least[l]) for (i, _, _), f, l in zip(rows, fps, label))
    assert Counter(tuple(r) for r in df.collect()) == want


# --- alignment ------------------------------------------------------------

def brute_alignment(texts):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, sha) by byte loops."""
    enc = align.Encoder(PATH_A, PATH_B)
    docs_, count = [], Counter()
    for t in texts:
        s = (" " + (t or "")).encode()
        a = enc.a.encode(s.decode(), add_special_tokens=False).ids if t else []
        b = enc.b.encode(t) if t else []
        if t and (b"".join(enc.bytes_a[i] for i in a) != s or b"".join(enc.bytes_b[i] for i in b) != s):
            a = b = []
        span = []
        for ids, table in ((a, enc.bytes_a), (b, enc.bytes_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i])))
                at = out[-1][1]
            span.append(out)
        links = [(i, j) for i, (p, q) in enumerate(span[0]) for j, (x, y) in enumerate(span[1]) if p < y and x < q]
        cuts = sorted({q for _, q in span[0]} & {y for _, y in span[1]})
        groups, lo = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(ids[i]) for i, (p, q) in enumerate(sp) if lo <= p and q <= c)
                                   for ids, sp in ((a, span[0]), (b, span[1]))))
            lo = c
        docs_.append((a, b, links, groups))
        count.update({(a[i], b[j]) for i, j in links})
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for a, b, links, groups in docs_:
        ns = [(count[a[i], b[j]], most[a[i]]) for i, j in links]
        out.append((len(a), len(b), len(groups), len(links), sum(n == m for n, m in ns), sum(n for n, _ in ns),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return out


def alignment_texts(seed=7, n=80):
    rng = random.Random(seed)
    parts = ["the ", "Wörter ", "don't ", "été,", "\n", "\n ", " \n", "  ", "\t", "日本 語", " ", "　", "\x85", "😀", "x.y", "<|endoftext|> ",
             "<s>", "</s> ", "<unk>", "▁", "\x00", "a\r\n", "12 345", "ordan ", "é", "ǅ ", "ß", "‍", " a", "Ωμ "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(n)]
    return texts + [None, "", " ", "  ", "\n", "▁", "a▁b", "plain words only here"] + texts[:5]


def test_encoder_equals_the_libraries():
    enc = align.Encoder(PATH_A, PATH_B)
    texts = alignment_texts(8, 1500)
    for _ in range(2):  # the second time from the cache
        got = []
        for lo, hi, buf, off in common.text_blocks(pa.array(texts), 4000):
            a, cut_a, b, cut_b, _ = enc.block(*align._with_space(buf, off))
            got += [(a[cut_a[i]: cut_a[i + 1]].tolist(), b[cut_b[i]: cut_b[i + 1]].tolist()) for i in range(hi - lo)]
        want = [enc.whole([(" " + t).encode()])[0][:2] if t else ([], []) for t in texts]
        assert got == want


def test_encoder_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(align, "POOL", 60)
    monkeypatch.setattr(align, "SLOTS", 16)
    enc = align.Encoder(PATH_A, PATH_B)
    for k in range(10):
        t = [f"alpha{k} beta gamma{k % 3} delta. epsilon", "beta beta"]
        for lo, hi, buf, off in common.text_blocks(pa.array(t)):
            a, cut_a, b, cut_b, _ = enc.block(*align._with_space(buf, off))
            for i in range(2):
                assert (a[cut_a[i]: cut_a[i + 1]].tolist(), b[cut_b[i]: cut_b[i + 1]].tolist()) == \
                    enc.whole([(" " + t[i]).encode()])[0][:2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.lists(st.integers(1, 4), min_size=1, max_size=40), st.integers(1, 9))
def test_merge_path_pieces_are_equal_and_lose_nothing(a, b, work):
    total = max(sum(a), sum(b))
    ea, eb = (np.cumsum([*x, total + 1 - sum(x)]) for x in (a, b))
    i, j = align.diagonals(ea, eb, work)
    assert all(x == work for x in np.diff(i + j)[:-1]) and i[-1] + j[-1] == len(ea) + len(eb)
    la, lb, ca, cb = align.overlaps(ea, eb, work)
    sa, sb = ea - np.diff(ea, prepend=0), eb - np.diff(eb, prepend=0)
    want = {(x, y) for x in range(len(ea)) for y in range(len(eb)) if sa[x] < eb[y] and sb[y] < ea[x]}
    assert len(la) == len(want) and set(zip(la.tolist(), lb.tolist())) == want
    assert sorted(ea[ca].tolist()) == sorted(set(ea.tolist()) & set(eb.tolist())) and (ea[ca] == eb[cb]).all()


def check_alignment(spark, texts):
    got = align.aligned(docs(spark, [(i % 50 or None, t, "en") for i, t in enumerate(texts)]), PATH_A, PATH_B).collect()
    want = Counter((i % 50 or None, *x) for i, x in enumerate(brute_alignment(texts)))
    assert Counter(tuple(r) for r in got) == want


def test_alignment_against_brute_force(spark):
    check_alignment(spark, alignment_texts() + ["long words " * 3000])


def test_alignment_in_many_blocks(spark, monkeypatch):
    for name, value in (("WORK", 7), ("TOKENS", 30), ("PAIRS", 40), ("FLUSH", 50)):
        monkeypatch.setattr(align, name, value)
    check_alignment(spark, alignment_texts(9, 60))


def test_alignment_empty_tables(spark):
    assert align.aligned(docs(spark, []), PATH_A, PATH_B).collect() == []
    got = align.aligned(docs(spark, [(1, None, "en"), (1, "", "en")]), PATH_A, PATH_B).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "")] * 2


def test_op13_as_registered(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    short = [r for r in rows if len(r.text or "") < 3000]
    got = {r.doc_id: r for r in E.queries()["op13_alignment"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for r, want in zip(short, brute_alignment([r.text for r in short])):
        x = got[r.doc_id]  # counts need the whole corpus
        assert (x.n_a, x.n_b, x.n_groups, x.n_links, x.groups_sha256) == (*want[:4], want[6])
