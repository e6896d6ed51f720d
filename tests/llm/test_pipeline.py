"""The pipeline's stages, each on its own input, and its rows against plain Python."""

import collections
import hashlib
import re

import duckdb
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from opinara.llm import bpe, pii, queries


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), docs.schema)
        if name != "source mixing":
            assert out.count() <= docs.count()
        docs = out
    assert docs.count() > 0


def plain_pipeline(rows, change, con):
    """The pipeline on (doc_id, source, text) by plain Python and the SQL of single operators."""
    words = lambda t: [x for x in (t or "").translate({c: " " for c in range(9, 14)}).split(" ") if x]
    line = lambda x: re.sub(" {2,}", " ", re.sub("[0-9]+", "0", re.sub("[\t\x0b\x0c\r]", " ", x.lower()))).strip(" ")
    told = lambda name, rows: con.execute(queries.ORACLES[name]).df() if con.register("documents", pd.DataFrame(rows, columns=["doc_id", "source", "text"])) else None
    # quality rules: verdicts by SQL, frequent lines by counting
    good = told("op4_line_quality", rows)
    good = set(good[good["kept"]]["doc_id"])
    texts, held = collections.defaultdict(set), collections.defaultdict(set)
    for _, s, t in rows:
        texts[s].add(t)
        for x in {line(x) for x in (t or "").split("\n")} - {""}:
            held[s, x].add(t)
    often = {k for k, v in held.items() if len(v) > 5 and len(v) > 0.002 * len(texts[k[0]])}
    rows = [(i, s, "\n".join(x for x in t.split("\n") if (s, line(x)) not in often)) for i, s, t in rows if i in good]
    # one document of each group
    sets = {}
    for i, _, t in rows:
        w = words(t.translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least, where = {i: i for i in sets}, collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    def top(i):
        while least[i] != i:
            i = least[i]
        return i
    for i, s in sets.items():
        for j, n in collections.Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                least[b] = a
    rows = [(i, s, change(t)[0]) for i, s, t in rows if top(i) == i]
    # the mix: words taken by SQL, whole copies by the seeded draw
    taken = {r.doc_id: r.taken / r.size for r in told("op10_source_mix", rows).itertuples() if r.size > 0}
    out = []
    for i, _, t in rows:
        times = taken.get(i, 0)
        chance = int(hashlib.md5(f"{i}|10".encode()).hexdigest()[:12], 16) % 1_000_000 / 1_000_000
        out += [(i, t)] * (int(times) + (times - int(times) > chance))
    return out


def test_rows_equal_plain_python(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = []
    for i, t in plain_pipeline([tuple(r) for r in docs.select("doc_id", "source", "text").collect()], pii.pseudonymiser(pii.passing_key(spark)), duckdb.connect()):
        ids = own.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, data).collect())) == sorted(want)


def test_a_key_must_be_named_or_passes_away(spark):
    with pytest.raises(ValueError):
        pii.session_key(spark)
    assert len(pii.passing_key(spark)) == 32 and pii.passing_key(spark) == pii.passing_key(spark)
    spark.conf.set("spark.opinara.pii.key", "named")
    try:
        assert pii.passing_key(spark) == pii.session_key(spark) == b"named"
    finally:
        spark.conf.unset("spark.opinara.pii.key")


def test_clashing_columns_stay(spark):
    clash = ["drop_lines", "_h", "_d", "_host", "_id", "_doc", "_copies", "_copy", "row", "n_email", "size", "taken", "hit.s"]
    said = [f"{w} words make a text of which no other one holds even a part, number {w} and {w * 3}, call +49 30 901820 or {w}@example.org soon" for w in range(40)]
    rows = [(i, t if i != 3 else None, "en", ("a", None)[i % 2], len(t), *(f"{c} {i}" for c in clash)) for i, t in enumerate([*said, "", said[0], "x " * 30_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in clash))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.schema.names == docs.schema.names, name
        for r in out.collect():
            assert all(r[c] == f"{c} {r['doc_id']}" for c in clash), name
    assert corpus_pipeline.encoded(spark, docs, "").count() == len(rows)


def test_empty_documents(spark, data, tmp_path):
    spark.read.parquet(f"{data}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
