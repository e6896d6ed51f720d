"""Near-duplicate operators against brute force, and their edge cases."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import embed_dedup, ngram_join
from opinara.llm.common import word_hashes
from opinara.llm.components import components


def roots(ids, links):
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, num):
    sets = {i: shingles(t, width) for i, t in rows}
    ids = [i for i, s in sets.items() if s]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return {(i, len(sets[i]), c) for i, c in roots(sets, links).items()}


def family(seed, n_copies, n_words, most):
    """A text and copies of it in which up to ``most`` words are other ones."""
    r = random.Random(seed)
    base = [r.choice("the of and a to in".split()) if r.random() < 0.3 else f"w{seed}x{r.randrange(10**6)}" for _ in range(n_words)]
    out = [" ".join(base)]
    for _ in range(n_copies):
        w = list(base)
        for _ in range(r.randrange(most + 1)):
            w[r.randrange(n_words)] = f"e{r.randrange(10**9)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("width", "num", "block"), [(3, 90, 128), (3, 90, 8), (5, 80, 8), (2, 40, 16), (3, 100, 8)])
def test_join_equals_brute_force(spark, monkeypatch, width, num, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "CHUNK", 3000)
    monkeypatch.setattr(ngram_join, "ASKING", 16)
    monkeypatch.setattr(ngram_join, "HUBS", 3)
    texts = [t for s, (c, n, m) in enumerate([(40, 60, 6), (30, 148, 14), (12, 12, 2), (10, 400, 30), (6, 5, 1), (6, 3, 1)]) for t in family(s, c, n, m)]
    texts += ["", None, " \t\n", "One", "one", "ONE two", "one two", "a b c a b c", "c a b c a b", "x " * 3000]
    random.Random(1).shuffle(texts)
    rows = [(7 * i + 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, sid string, node int").repartition(5)
    got = {tuple(r) for r in ngram_join.jaccard_components(df, width=width, num=num, den=100).collect()}
    assert got == brute(rows, width, num)


def test_join_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.jaccard_components(empty).collect() == []
    df = spark.createDataFrame([(None, "a b c"), (2, "a b c"), (1, "A b C"), (1, "other words here"), (3, None)], "doc_id long, text string")
    got = sorted(((r[0] is None, r[0] or 0, r[1], r[2]) for r in ngram_join.jaccard_components(df, width=3, num=90).collect()), key=repr)
    assert got == sorted([(True, 0, 1, None), (False, 2, 1, 1), (False, 1, 1, 1), (False, 1, 1, 1), (False, 3, 0, 3)], key=repr)
    kept = ngram_join.one_of_each(df.withColumn("extra", F.lit(1)), width=3, num=90)
    assert kept.columns == ["doc_id", "text", "extra"] and 2 not in {r[0] for r in kept.collect()}


def test_words_of_like_letters_are_told_apart(spark):
    a, b = "a", "b"
    for _ in range(10):  # a sequence and its complement, which powers of one base modulo 2**64 do not tell apart
        a, b = a + b, b + a
    cases = [a, b, a[:64], b[:64], a[:16], b[:16], "ab", "ba"]
    assert len({int(word_hashes(x)[0]) for x in cases}) == len(cases)
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    assert {r[2] for r in ngram_join.jaccard_components(df, width=3, num=90).collect()} == set(range(len(cases)))
    with pytest.raises(ValueError, match="limit"):
        ngram_join.jaccard_components(df, num=0)


def test_index_finds_all_with_the_overlap():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 120, r.integers(5, 80)).astype(np.uint64)) for _ in range(60)]
    index = ngram_join.Index(sets)
    for q in sets:
        found, overlap = index.overlaps(q, 50, 100)
        least = -(-50 * len(q) // 100)
        fits = {k for k, s in enumerate(sets) if 2 * len(s) >= len(q) and len(s) <= 2 * len(q)}
        want = {k: len(np.intersect1d(q, sets[k])) for k in fits}
        assert {k: o for k, o in zip(found.tolist(), overlap.tolist(), strict=True) if o >= least} == {k: o for k, o in want.items() if o >= least}


def test_components_of_paths_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (5, 5), (None, 3)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "GROUP", 40)
    monkeypatch.setattr(embed_dedup, "STORED", 16)
    r = np.random.default_rng(3)
    base = r.normal(size=(30, 16))
    rows = [(i, (base[i % 30] + r.normal(size=16) * r.choice([0, 0.05, 0.2, 1])).tolist()) for i in range(150)]
    rows += [(500 + i, v) for i, v in enumerate([None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]])]
    rows += [(600, rows[0][1]), (601, [2 * x for x in rows[0][1]])]
    df = spark.createDataFrame([(*x, 0) for x in rows], "vec_id long, embedding array<double>, node int").repartition(3)
    got = {r["vec_id"]: tuple(r)[1:] for r in embed_dedup.near_duplicates(df).collect()}
    good = {i: np.array(v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    cos = lambda a, b: len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.95
    links = [(a, b) for a in good for b in good if a < b and cos(good[a], good[b])]
    comp = roots([i for i, _ in rows], links)
    want = {i: (sum(i in x for x in links), comp[i], comp[i] == i) for i, _ in rows}
    assert got == want
    assert embed_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_error_bound_holds():
    r = np.random.default_rng(5)
    x = r.normal(size=(200, 64)) * np.exp(r.normal(size=(200, 64)))
    q, s, e = embed_dedup.quantise(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (q.astype(float) * s[:, None]) @ (q.astype(float) * s[:, None]).T
    assert (np.abs(unit @ unit.T - near) <= e[:, None] + e + e[:, None] * e + 1e-6).all()


def test_finite_vectors_of_any_size_link(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1e-200, 1e-200]), (4, [3e-320, 3e-320]), (5, [-1e200, 1e200]), (6, [1e308, -1e308]), (7, [0.0, 0.0]), (8, [float("inf"), 1.0]), (9, [1.0, 1.0])]
    with np.errstate(all="raise"):
        assert (np.abs(embed_dedup.levelled(np.array([r[1] for r in rows[:6]]))).max(axis=1) >= 0.5).all()
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 9: (4, 1), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8)}


def test_vectors_move_no_more_often_with_more_groups(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "GROUP", 40)
    monkeypatch.setattr(embed_dedup, "STORED", 8)
    x = np.random.default_rng(7).normal(size=(2000, 64))
    x[1999] = x[3] * 1.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    sc = spark.sparkContext._jsc.sc()

    def shuffled():
        spark.range(1).count()
        time.sleep(0.3)  # the status store is told now and then
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorSummary("driver").totalShuffleWrite()

    before = shuffled()
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()}
    assert got == {i: (1, 3) if i in (3, 1999) else (0, i) for i in range(2000)}
    assert shuffled() - before < 4 * x.nbytes  # before, the vectors once for each of 50 groups: 15.9 MB
    # groups that their bytes make many are compared in whole
    monkeypatch.setattr(embed_dedup, "GROUP_BYTES", 100 * 64 * 8)
    assert {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()} == got
