"""Token counts against the library, the Merkle manifest and periodic runs against plain twins, edge cases, and SQL."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest

from opinara.llm import merkle, period_runs, queries, token_count

TEXTS = [
    "One two  three\tfour\nfive", "", None, " ", "it's a test, isn't it. Don't!\n\nNew  line ", "żółć é 漢字 テスト 😀😀  x y", "x" * 3000, "a<|endoftext|>b <|endoftext|>", "<|endoftext|>", "<|endoftext",
    "\nlead", "trail\n", "a\x1cb \x85 　c​d", "1234567 89 ___ --- ...", "word " * 500, "la la la la la la", "a b a b a b a b a b c",
]


def frame(spark, texts=TEXTS):
    rows = [(None if i == 3 else i // 2, t, ("de", None, "", "en")[i % 4], None if i == 4 else len(t or ""), "src" if i % 5 else None, 1, "x", True) for i, t in enumerate(texts)]
    rows += rows[-3:]  # repeated rows; ids are shared by two rows each
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, source string, n_tokens int, g string, root boolean")


# ---- token counts ---------------------------------------------------------------------------


def test_counts_are_the_librarys(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    df = frame(spark)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(tokenizer.encode(r.text or "", add_special_tokens=False).ids), n > 1024) for r in df.collect())
    got = token_count.count_tokens(df, P.path("byte_bpe_50k.json"))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got.collect()) == want
    assert token_count.count_tokens(frame(spark, []), P.path("byte_bpe_50k.json")).collect() == []


def test_counts_of_random_texts_and_little_memory():
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(P.path("byte_bpe_50k.json")), random.Random(3)
    bits = ["a", "the", " ", "  ", "\n", "\t", "'s", "<|endoftext|>", "é", "漢", "😀", "\x1c", "\x85", "　", "1", "23", "_", "...", "\r\n", " \n", "x" * 70, "́", "\x00"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["ab" * 20_000]
    counter = token_count.Counter(P.path("byte_bpe_50k.json"), remember=50)
    got = [n for at in range(0, len(texts), 100) for n in counter.count(texts[at : at + 100])]
    assert got == [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_another_kind_of_vocabulary_is_refused():
    with pytest.raises(ValueError):
        token_count.Counter(P.path("word_bpe_49k.json"))


# ---- Merkle manifest ------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """Whole levels in lists; every proof folded by hand."""
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: sha(*map(said, (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text)))

    def levels(low):
        out = [low]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def way(tree, i):
        return [(t[(i >> k) ^ 1] if (i >> k) ^ 1 < len(t) else None, (i >> k) & 1) for k, t in enumerate(tree[:-1])]

    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {g: sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r))) for g in names}
    trees = {g: levels([leaf(r) for r in own[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(own[g]):
            steps = way(trees[g], i) + way(top, k)
            h = leaf(r, 1) if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 else leaf(r)
            for sibling, right in steps:
                h = sha(h) if sibling is None else sha(sibling, h) if right else sha(h, sibling)
            out.append((str(r.doc_id), leaf(r), trees[g][-1][0], top[-1][0], sha(*(s for s, _ in steps if s)), h, h == top[-1][0]))
    return sorted(out)


@pytest.mark.parametrize("height", [1, 3, 10])
def test_manifest_equals_a_plain_one(spark, height):
    df = frame(spark).repartition(3)
    got = merkle.verify_documents(df, height).collect()
    assert sorted((str(r[0]), *tuple(r)[1:7]) for r in got) == plain_manifest(df.collect())
    assert any(not r.verified for r in got) and any(r.verified for r in got)


def test_manifest_of_many_leaves_in_small_blocks(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    got = merkle.verify_documents(df, 2).collect()
    assert sorted((str(r[0]), *tuple(r)[1:7]) for r in got) == plain_manifest(df.collect())
    # a version has its leaf's ancestors of its own and no other node
    assert {r.copied for r in got if r.verified} == {0} and all(r.copied > 1 for r in got if not r.verified)


def test_manifest_of_nothing_and_of_one(spark):
    assert merkle.verify_documents(frame(spark, [])).collect() == []
    df = spark.createDataFrame([(5, "s", "en", 1, "t")], "doc_id long, source string, lang string, n_chars long, text string")
    (row,) = merkle.verify_documents(df).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")


def test_a_version_shares_all_but_ancestors():
    leaves = [sha(str(i)) for i in range(11)]
    tree = merkle.Tree(leaves)
    for i in range(11):
        changed = [*leaves[:i], sha("new"), *leaves[i + 1 :]]
        new = merkle.Tree(changed)
        assert tree.version(i, sha("new")) == [new.levels[k + 1][i >> k + 1] for k in range(4)]
    assert merkle.Tree(leaves).root == tree.root


# ---- periodic runs --------------------------------------------------------------------------


def plain_runs(w):
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def random_words(rng, most):
    k, w = rng.choice([1, 2, 2, 3, 5]), []
    while len(w) < rng.randrange(most):
        p = rng.randrange(1, 30)
        w += ([rng.randrange(k) for _ in range(p)] * 8)[: rng.randrange(1, 7 * p + 2)]
        if rng.random() < 0.3:
            w *= rng.randrange(1, 6)
        if w and rng.random() < 0.2:
            w[rng.randrange(len(w))] = 9
    return w[: 2 * most]


def test_runs_equal_plain_ones_however_words_are_appended():
    rng = random.Random(11)
    for _ in range(250):
        w = random_words(rng, 300)
        want, step, catchers = plain_runs(w), rng.choice([1, 7, 50, 10_000]), period_runs.Catchers()
        for at in range(0, len(w), step):
            catchers.append(np.array(w[at : at + step], np.int64))
        assert [tuple(r) for r in catchers.runs().tolist()] == want


def test_long_sequences_in_parts():
    part = period_runs.PART
    for w, want in ((np.zeros(3 * part, int), [[0, 3 * part, 1]]), (np.arange(3 * part) % 777, [[0, 3 * part, 777]]), (np.arange(3 * part), [])):
        assert period_runs.runs_of(w).tolist() == want
    w = np.concatenate([np.arange(part - 50) + 10, np.tile(np.arange(30) + 2, 9)[:-5], [1], np.arange(5)])
    assert period_runs.runs_of(w).tolist() == [[part - 50, part - 50 + 265, 30]]


def plain_rows(rows, plant=True):
    out = []
    for r in rows:
        w = [x for x in (r.text or "").translate({c: " " for c in range(9, 14)}).split(" ") if x]
        h, n = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1, len(w)
        if plant and h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w)
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        best = max(runs, key=lambda t: ((t[1] - t[0]) / t[2], -t[0], -t[2]), default=None)
        four = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        out.append((str(r.doc_id), len(runs), *four, sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=repr)


def test_runs_of_documents(spark, data):
    told = lambda df: sorted(((str(r[0]), *tuple(r)[1:]) for r in df.collect()), key=repr)
    df = frame(spark)
    assert told(period_runs.run_digests(df)) == plain_rows(df.collect(), plant=False)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert told(queries.op13_period_runs(spark, data)) == plain_rows(docs.collect())
    assert period_runs.run_digests(frame(spark, [])).collect() == []


def test_runs_and_collapsed_text(spark):
    rows = {r.doc_id: r for r in period_runs.periodic_runs(spark.createDataFrame([(1, "so la la la la la la do", 0), (2, None, 0)], "doc_id long, text string, runs int")).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(1, 6, 1)] and rows[1].collapsed == "so la do"
    assert rows[2].runs == [] and rows[2].collapsed == "" and rows[2].n_words == 0


# ---- SQL ------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_period_runs"])
def test_sql(spark, data, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    df = queries.QUERIES[name](spark, data)
    said = con.execute(queries.ORACLES[name])
    names = [c[0] for c in said.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(said.fetchall(), key=repr)
