import json
import random

import pytest
from pyspark.sql import functions as F

from opinara.functions.text import URL
from opinara.operators import agreement, checks, labels, prepare, quantify, sampling
from opinara.plans.views import AREAS, view
from opinara.sources import logs, shapes

RAW = ("play", "b0", "1", "nice kurta", None, "2026-01-01", "2026-01-01", 5, 0, None)


def test_second_append_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([RAW, RAW, (*RAW[:2], "2", *RAW[3:])], logs.ENVELOPE)
    path = str(tmp_path / "raw")
    assert tuple(logs.write_append_dedup(rows, path).first()) == (2, 1, 2)
    assert tuple(logs.write_append_dedup(rows, path).first()) == (0, 3, 2)


def test_raw_reader_prunes_and_skips_torn_lines(spark, tmp_path):
    at = tmp_path / "raw" / "source=play" / "brand=b0"
    at.mkdir(parents=True)
    (at / "1.jsonl").write_text(json.dumps({"source_id": "1", "raw_text": "x"}) + "\n\n{torn\n")
    (tmp_path / "raw" / "source=forum").mkdir()
    got = logs.read_raw(spark, str(tmp_path / "raw"), source="play").collect()
    assert [(r["source"], r["brand"], r["source_id"]) for r in got] == [("play", "b0", "1")]
    rows, torn = logs.read_jsonl_tolerant(spark, str(at), "source_id string, raw_text string")
    assert rows.count() == 1 and torn.count() == 1


def test_manifest_finds_changes(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one")
    (tmp_path / "b.txt").write_text("two")
    now = logs.file_manifest(spark, str(tmp_path))
    before = spark.createDataFrame(now.collect(), now.schema)
    assert before.count() == 2
    (tmp_path / "a.txt").write_text("other")
    (tmp_path / "b.txt").unlink()
    got = {r["path"].rsplit("/", 1)[1]: r["problem"] for r in logs.verify_manifest(before, logs.file_manifest(spark, str(tmp_path))).collect()}
    assert got == {"a.txt": "changed", "b.txt": "missing"}


def test_csv_snapshot_and_gold(spark, tmp_path):
    df = spark.createDataFrame([("play", "pre", "OA-01", 0.5), ("play", "pre", "OA-02", None)], "source string, temporal_stance string, opportunity_area string, oi double")
    logs.write_index_csv(df, str(tmp_path / "i"))
    assert [r["opportunity_area"] for r in logs.read_gold_csv(spark, str(tmp_path / "i"), df.schema.simpleString()[7:-1].replace(":", " ")).collect()] == ["OA-01", "OA-02"]
    assert logs.snapshot({"t": df.withColumn("body", F.lit("x"))}, ("source", "oi"), str(tmp_path / "s")).first()["n_rows"] == 2
    assert spark.read.parquet(str(tmp_path / "s" / "t")).columns == ["source", "oi"]


DROP = "utterance_text string, source string, brand string, source_id string, near_dup_of string, n_ids int, brand_fixed boolean"
LONG = "this is a long enough text about a kurta that fits rather badly indeed"


@pytest.mark.parametrize(
    ("text", "near", "n", "fixed", "reason"),
    [
        ("", None, 1, True, "no_text"), (None, None, 1, True, "no_text"), ("it is good", None, 1, True, "too_short"), (LONG, "play:9", 1, True, "near_dup"), (LONG, "play:1", 1, True, None),
        ("see https://x.example now please", None, 1, True, "spam"), (LONG, None, 9, True, "spam"), ("app is not working", None, 1, True, "not_shopping"),
        ("I would rather buy the kurta at beta", None, 1, False, "wrong_brand"), ("I would rather buy the kurta at beta", None, 1, True, None),
    ],
)
def test_drop_rules(spark, text, near, n, fixed, reason):
    df = spark.createDataFrame([(text, "play", "alpha", "1", near, n, fixed)], DROP)
    got = df.select(prepare.drop_reason({"alpha": "(?i)\\balpha\\b", "beta": "(?i)\\bbeta\\b"})).first()[0]
    assert got == reason and URL


def test_near_duplicates_point_to_the_first(spark):
    rows = [("play", "b", "2", "t", 2), ("play", "b", "1", "t", 3), ("play", "b", "3", "u", 1)]
    df = spark.createDataFrame(rows, "source string, brand string, source_id string, text_sha1 string, captured_at int")
    assert {r["source_id"]: r["near_dup_of"] for r in prepare.mark_near_duplicates(df).collect()} == {"2": None, "1": "play:2", "3": None}


def test_counts_need_source_and_stance(spark):
    with pytest.raises(ValueError):
        quantify.cell_counts(spark.range(1), ("brand", "temporal_stance"))


def test_gates(spark, data):
    cells = quantify.aggregate(view(spark, data, "labelled"), view(spark, data, "areas"))
    gated = {r[0] for r in cells.where("gate_reason is not null").select("opportunity_area").distinct().collect()}
    assert gated <= {"OA-09", "OA-10"} and cells.where("gate_reason is not null and (oi is not null or proportion is not null)").count() == 0
    assert {a[0] for a in AREAS if a[3] in ("weak", "none")} == {"OA-09", "OA-10"}


def test_window_rules(spark):
    w = spark.createDataFrame([("appstore", "a", 88.16), ("appstore", "b", 3.18), ("appstore", "c", 88.22)], "source string, brand string, span_days double")
    got = {r["brand"]: r["compliant"] for r in quantify.window_compliant(w, "a", 3.0).collect()}
    assert got == {"a": True, "b": False, "c": True}
    assert all(r["compliant"] for r in quantify.window_compliant(w, "z", 3.0).collect())
    warn = lambda *spans: quantify.window_parity(spark.createDataFrame([("s", str(i), x) for i, x in enumerate(spans)], w.schema), 3.0).first()["warn"]
    assert warn(40.0, 1094.0) and not warn(89.4, 90.0) and not warn(40.0)


def test_unmatched_sources_are_not_compared(spark, data):
    with pytest.raises(ValueError):
        quantify.check_matched(view(spark, data, "sources"), ["play", "forum"])
    quantify.check_matched(view(spark, data, "sources"), ["play", "appstore"])


def test_perfect_agreement_and_symmetry(spark):
    df = spark.createDataFrame([("x", "y", 1.0), ("x", "x", 2.0), ("y", "y", 1.0), ("z", "y", 1.0), (None, "y", 1.0)], "a string, b string, w double")
    k = lambda a, b, w=None: agreement.agreement(agreement.contingency(df, {"f": (F.col(a), F.col(b))}, w)).first()
    assert k("b", "b")["kappa"] == 1.0 and k("a", "b")["kappa"] == pytest.approx(k("b", "a")["kappa"])
    assert k("a", "b", F.col("w"))["kappa"] == pytest.approx(k("a", "b", F.col("w") * 10)["kappa"]) and k("a", "b")["n"] == 4


def test_one_constant_label_has_no_kappa(spark):
    df = spark.createDataFrame([("x", "x")], "a string, b string")
    row = agreement.agreement(agreement.contingency(df, {"f": (F.col("a"), F.col("b"))})).first()
    assert row["kappa"] is None and row["ac1"] is None and agreement.reliability_gate(agreement.agreement(agreement.contingency(df, {"f": (F.col("a"), F.col("b"))}))).first()["verdict"] == "FAIL"


def test_two_and_two_point_zero_are_one_label(spark):
    df = spark.createDataFrame([("2", 2.0), ("1", 1.0)], "a string, b double")
    assert agreement.agreement(agreement.contingency(df, {"f": (F.col("a"), F.col("b"))})).first()["observed"] == 1.0


def test_samples_do_not_depend_on_partitions(spark, data):
    rows = view(spark, data, "labelled")
    one, two = (sampling.sample_per_cell(r, 3, 5).select("utterance_id").collect() for r in (rows, rows.repartition(7)))
    assert sorted(one) == sorted(two) and len(one)


def test_evidence_is_exact(spark):
    label = F.struct(F.col("q").alias("evidence_quote"), F.col("a").alias("opportunity_area"), F.col("c").alias("confidence"))
    rows = [("late and torn", "OA-01", 0.5, "It came late and torn."), ("Late and torn", "OA-01", 0.5, "It came late and torn."), ("late  and torn", "OA-01", 0.5, "late and torn"), ("", "none", 0.5, "x"), ("", "OA-01", 0.0, "x"), ("", "OA-01", 0.5, "x")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, q string, a string, c double, t string")
    got = [r[0] for r in df.orderBy("i").select(labels.evidence_fault(label, F.col("t"))).collect()]
    assert got == [None, "quote not in text", "quote differs in white space", None, None, "empty quote"]


def test_nulls_of_the_second_lane_do_not_overwrite(spark):
    a = spark.createDataFrame([("1", "OA-01", 2, 0), ("1", "OA-09", 1, 1)], "utterance_id string, opportunity_area string, severity int, labelled_at int")
    b = spark.createDataFrame([("1", "OA-02", None, 0)], a.schema)
    row = labels.consolidate(a, b, b.limit(0), ("opportunity_area", "severity")).first()
    assert (row["opportunity_area"], row["severity"], row["escalated"], row["laneC_severity"]) == ("OA-02", 2, True, None)


def test_placeholders(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,«later»\n")
    found = checks.placeholder_sweep(spark, str(tmp_path)).collect()
    assert [(r["line"], r["kind"]) for r in found] == [(2, "guillemet placeholder")]
    with pytest.raises(ValueError):
        checks.placeholder_sweep(spark, str(tmp_path), strict=True)


def test_unique_and_required(spark):
    df = spark.createDataFrame([(1, "x"), (1, ""), (2, None)], "id int, v string")
    got = sorted((r["rule"], r["key"]) for r in checks.check_constraints(df, "id", [checks.required("v")]).collect())
    assert got == [("required v", "1"), ("required v", "2"), ("unique id", "1")]


def test_unknown_payloads_are_kept_apart(spark):
    df = spark.createDataFrame([(1, '{"reviews": [{"id": "a"}]}'), (2, '{"data": {"items": [{"id": "b"}, {"id": "c"}]}}'), (3, "{}"), (4, "?")], "n int, payload string")
    rows, unknown = shapes.extract_rows(df)
    assert sorted((r["n"], r["id"]) for r in rows.collect()) == [(1, "a"), (2, "b"), (2, "c")] and sorted(r["n"] for r in unknown.collect()) == [3, 4]


def test_large_lexicon_equals_contains(spark, data):
    import duckdb

    from opinara.operators.lexicon import lexicon_table_hits, parts_of

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    con.execute(r"""CREATE TABLE lex AS SELECT concat('g', CAST(hash(p) % 3 AS STRING)) AS grp, p AS phrase FROM (SELECT DISTINCT substr(lower(text), CAST(1 + i * 7 AS INT), CAST(3 + i % 9 AS INT)) AS p FROM documents, range(900) t(i)) x WHERE length(p) > 2 LIMIT 100000""")
    lex = spark.createDataFrame(con.execute("SELECT * FROM lex").df())
    assert lex.count() > 30_000
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    want = con.execute("SELECT doc_id, count(phrase), coalesce(sum(length(phrase)), 0) FROM documents LEFT JOIN lex ON contains(lower(text), phrase) GROUP BY doc_id").fetchall()
    few = lexicon_table_hits(docs, lex, part_chars=400_000)
    assert len(parts_of(lex, part_chars=100_000)) > 1 and str(few._jdf.queryExecution().optimizedPlan()).count("contains") == 0
    for hits in (few, lexicon_table_hits(docs, lex)):
        each = hits.select("doc_id", F.size("hits").alias("n"), F.aggregate("hits", F.lit(0), lambda a, h: a + F.length(h["phrase"])).alias("c"))
        assert sorted(map(tuple, each.collect())) == sorted((a, b, int(c)) for a, b, c in want)


def test_lexicon_edges(spark):
    from opinara.operators.lexicon import lexicon_table_hits

    docs = spark.createDataFrame([(1, "The KURTA fits"), (2, None), (3, "")], "k int, text string")
    lex = spark.createDataFrame([("a", "kurta"), ("b", "kurta"), (None, "fit"), ("a", None), ("a", "kurta"), ("e", "")], "grp string, phrase string")
    got = {r.k: r.hits and [tuple(h) for h in r.hits] for r in lexicon_table_hits(docs, lex).collect()}
    assert got == {1: [(None, "fit"), ("a", "kurta"), ("b", "kurta"), ("e", "")], 2: None, 3: [("e", "")]}
    assert [r.hits for r in lexicon_table_hits(docs, lex.limit(0)).orderBy("k").collect()] == [[], None, []]


def test_exact_medians_by_brackets(spark):
    import statistics

    from opinara.operators.reports import exact_medians

    rng, groups = random.Random(2), {}
    for g, kind in enumerate(("spread", "ties", "two", "one", "same", None)):
        make = {"spread": lambda: rng.gauss(0, 1), "ties": lambda: float(rng.choice([1, 1, 1, 2, 3])), "two": lambda: float(rng.choice([0, 9])), "one": lambda: 4.0, "same": lambda: 7.0, None: lambda: rng.random() ** 9}[kind]
        groups[kind] = [make() for _ in range(1 if kind == "one" else 4001 + g % 2)]
    rows = [(k, x) for k, xs in groups.items() for x in xs] + [("spread", None), ("spread", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for limit in (20, 1000, 100_000):
        got = {r.g: r.median for r in exact_medians(df, ("g",), "v", bracket_rows=limit).collect()}
        assert got == pytest.approx({k: statistics.median(xs) for k, xs in groups.items()})


def test_samples_know_null_cells_and_read_once(spark):
    rows = spark.range(3000).select(F.col("id").alias("utterance_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("source"), F.when(F.col("id") % 2 > 0, "b").alias("brand"))
    got = sampling.sample_per_cell(rows, 7, 5)
    counts = {(r.source, r.brand): r["count"] for r in got.groupBy("source", "brand").count().collect()}
    assert len(counts) == 6 and set(counts.values()) == {7}
    want = {}
    for r in rows.select("*", sampling.draw(5, "utterance_id").alias("d")).collect():
        want.setdefault((r.source, r.brand), []).append((r.d, r.utterance_id))
    assert sorted(r.utterance_id for r in got.collect()) == sorted(i for cell in want.values() for _, i in sorted(cell)[:7])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    report = {(r.source, r.brand): (r.available, r.sampled) for r in sampling.sample_report(rows, got, 7).collect()}
    assert set(report.values()) == {(500, 7)}
    strata = sampling.stratified_sample(rows, ("source", "brand"), 13, 1).groupBy("source", "brand").count().collect()
    assert [r["count"] for r in strata] == [2] * 6


def test_usage_within_a_second_and_without_a_time(spark):
    at = ["2026-01-01 00:00:00.1", "2026-01-01 00:00:00.9", "2026-01-01 00:01:00.5", None, "2026-01-01 01:03:59.999999", "2026-01-01 01:04:59.999998"]
    df = spark.createDataFrame([(i, "A", t, 1, None) for i, t in enumerate(at)], "k int, lane string, at string, prompt_tokens int, completion_tokens int").withColumn("at", F.col("at").cast("timestamp"))
    got = {r.k: (r.calls, r.tokens, r.over_limit) for r in sampling.rolling_usage(df, 1, 100).collect()}
    assert got == {0: (1, 1, False), 1: (2, 2, True), 2: (2, 2, True), 3: (None, None, None), 4: (1, 1, False), 5: (2, 2, True)}


def test_a_hash_on_a_third_of_rows_is_dealt_over_all_tasks(spark):
    rows = spark.range(30_000).select(F.lit("play").alias("source"), F.lit("b").alias("brand"), F.col("id").cast("string").alias("source_id"), F.col("id").alias("captured_at"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.sha1((F.col("id") % 9_000).cast("string"))).alias("text_sha1"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = prepare.mark_copies(rows)
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
        got = marked.agg(F.count_if((F.col("text_sha1") == "hot") & (F.col("near_dup_of") == "play:0")), F.count_if(F.col("near_dup_of").isNull()), F.max("n_ids")).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tuple(got) == (9_999, 1 + 6_000, 10_000)


def test_large_files_are_hashed_in_parts(spark, tmp_path):
    import hashlib

    kinds = {"a.bin": b"x" * 10, "b c%20ü+#.bin": bytes(range(256)) * 40_000}
    for name, data in kinds.items():
        (tmp_path / name).write_bytes(data)
    for whole in (0, 100, 1 << 30):
        got = logs.file_manifest(spark, str(tmp_path), whole=whole).collect()
        assert sorted((r["sha256"], r["bytes"]) for r in got) == sorted((hashlib.sha256(d).hexdigest(), len(d)) for d in kinds.values()), whole


def test_history_stays_where_it_is(spark, tmp_path):
    name = "history_" + tmp_path.name.replace("-", "_")
    logs.bucketed_history(spark, name, str(tmp_path / "h"), "utterance_id bigint, classifier_version string", buckets=8)
    for low in (0, 50):
        logs.add_history(spark.range(low, low + 50).select(F.col("id").alias("utterance_id"), F.lit("v1").alias("classifier_version")), name)
    rows = spark.range(0, 200, 3).withColumnRenamed("id", "utterance_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = labels.pending(rows, spark.table(name), "v1")
        ids = sorted(r[0] for r in left.collect())
        plan = left._jdf.queryExecution().executedPlan().toString().split("Final Plan")[-1].split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ids == [i for i in range(0, 200, 3) if i >= 100]
    assert plan.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 8" in plan  # the new rows move, the history does not
    # another session finds the rows under the same path
    spark.sql(f"DROP TABLE {name}")
    assert logs.bucketed_history(spark, name, str(tmp_path / "h"), "utterance_id bigint, classifier_version string", buckets=8).count() == 100
    spark.sql(f"DROP TABLE {name}")


def test_a_file_for_each_row_and_no_tasks_for_files_of_the_other_size(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("a",), (None,), ("ü\nb",)], "text string").coalesce(1)
    assert logs.write_each(rows, f"file://{tmp_path}") == logs.write_each(rows, f"file://{tmp_path}") == 4
    assert sorted(p.read_bytes() for p in tmp_path.glob("*/*")) == sorted([b"a\n", b"a\n", b"\n", "ü\nb\n".encode()])
    for whole in (0, 100):
        files = logs.file_manifest(spark, f"file://{tmp_path}/*", whole=whole)
        scans = [line for line in files._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan binaryFile" in line]
        assert len(scans) == 2 and files.count() == 4
        small = spark.read.format("binaryFile").load(f"file://{tmp_path}/*").where(F.col("_metadata.file_size") <= whole)
        assert (small.rdd.getNumPartitions() == 0) == (whole == 0)


def test_documents_do_not_get_a_folder_each(spark, data, tmp_path, monkeypatch):
    from opinara.plans.registry import file_queries

    monkeypatch.setattr(logs, "shared_folder", lambda spark: f"file://{tmp_path}/f")
    file_queries.s05_large(spark, data).collect()
    assert len(list((tmp_path / "f").iterdir())) < 10


def test_batches_go_on_from_one_range_into_the_next(spark):
    rows = spark.range(0, 3000, 3).select(F.col("id"), F.when(F.col("id") % 2 == 0, "a").alias("c"))
    for cell in ((), ("c",)):
        got = {r.id: (r.batch_no, r.batch_id) for r in sampling.batch_rows(rows.repartition(5), 7, "id", cell, lane_rows=90).collect()}
        whole = {r.id: (r.batch_no, r.batch_id) for r in sampling.batch_rows(rows, 7, "id", cell).collect()}
        assert got == whole and len(got) == 1000
        sides = {0: sorted(i for i in got if i % 2 == 0), 1: sorted(i for i in got if i % 2)} if cell else {0: sorted(got)}
        assert all(got[i][0] == k // 7 and got[i] == got[ids[k // 7 * 7]] for ids in sides.values() for k, i in enumerate(ids))


def test_usage_is_a_running_sum_and_equals_counting(spark):
    rng, minute = random.Random(5), 60_000_000
    times = [rng.choice([rng.randrange(40 * minute), minute * rng.randrange(40), minute * rng.randrange(40) - 1]) for _ in range(400)]
    rows = [(i, rng.choice(["A", None]), t, rng.randrange(5), rng.choice([None, 3])) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "k int, lane string, u long, prompt_tokens int, completion_tokens int").withColumn("at", F.timestamp_micros("u")).drop("u")
    out = sampling.rolling_usage(df, 1, 100)
    seen = lambda r: [x for x in rows if x[1] == r[1] and r[2] - minute < x[2] <= r[2]]
    want = {r[0]: (len(seen(r)), sum(x[3] + (x[4] or 0) for x in seen(r))) for r in rows}
    assert {r.k: (r.calls, r.tokens) for r in out.collect()} == want and out.columns == [*df.columns, "calls", "tokens", "over_limit"]
    frames = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("specifiedwindowframe(")[1:]]
    assert frames and all("unboundedpreceding" in x.split(")")[0] for x in frames)


def test_texts_of_one_partition_are_searched_by_all_cores_and_once(spark):
    from opinara.operators.lexicon import lexicon_table_hits

    docs = spark.createDataFrame([(i, f"kurta {i}") for i in range(400)], "k int, text string").coalesce(1)
    hits = lexicon_table_hits(docs, spark.createDataFrame([("a", "kurta"), ("b", "7")], "grp string, phrase string"))
    assert hits.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert hits.select(F.size("hits")).groupBy().sum().first()[0] == 400 + sum("7" in str(i) for i in range(400))


def test_texts_are_hashed_once_for_counting_and_once_for_the_rows(spark):
    rows = spark.range(200).select(F.lit("play").alias("source"), F.lit("b").alias("brand"), F.col("id").cast("string").alias("source_id"), F.col("id").alias("captured_at"), F.sha1((F.col("id") % 90).cast("string")).alias("text_sha1"))
    marked = prepare.with_repeats(prepare.mark_near_duplicates(rows), 2)
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert {(r.n_ids, r.n) for r in marked.groupBy("n_ids").agg(F.count("*").alias("n")).collect()} == {(3, 60), (0, 140)}


def test_a_large_lexicon_stays_off_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from opinara.operators.lexicon import lexicon_table_hits

    plain, told = DataFrame.collect, []

    def collect(df):
        rows = plain(df)
        told.append(len(rows))
        return rows

    lex = spark.range(20_000).select((F.col("id") % 3).cast("string").alias("grp"), F.concat(F.lit("p"), "id", F.lit("q")).alias("phrase"))
    docs = spark.range(50).select("id", F.concat_ws(" ", F.lit("P7Q"), F.concat(F.lit("p"), F.col("id") * 1000, F.lit("q")), F.lit("p99999q")).alias("text"))
    monkeypatch.setattr(DataFrame, "collect", collect)
    hits = lexicon_table_hits(docs, lex, part_chars=30_000)
    monkeypatch.undo()
    assert max(told, default=0) <= 1  # all 20,000 before
    got = {r.id: [tuple(h) for h in r.hits] for r in hits.collect()}
    assert got == {i: sorted([("1", "p7q")] + [(str(1000 * i % 3), f"p{1000 * i}q")] * (i < 20)) for i in range(50)}


def test_slabs_and_pieces_of_any_size_find_the_same(spark, monkeypatch):
    import pyarrow as pa

    from opinara.operators import lexicon

    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("ab é\U0001f600") for _ in range(n))
    texts = [word(rng.choice([0, 1, 5, 40, 300])) for _ in range(60)] + [None, "", "a" * 200, "x" + "ab" * 80]
    phrases = {word(rng.choice([1, 2, 3, 7])) for _ in range(200)} | {t[k : k + n] for t in texts if t for k in (0, 3) for n in (40, 64, 65, 120)} | {"a" * n for n in (63, 64, 65, 100, 199, 201)} | {"ab" * 32 + "é", "ab" * 40, "b" + "ab" * 60, ""}
    groups = {p: sorted(rng.sample(["=a", "=b", "=\U0001f600", "=￿", "-"], rng.randrange(1, 4)), key=lambda g: g.encode()) for p in phrases}
    files = lexicon.parts_of(spark.createDataFrame([(g, p) for p, gs in groups.items() for g in gs], "grp string, phrase string"), part_chars=2_000)
    want = [None if t is None else [(None if g == "-" else g[1:], p) for g, p in sorted(((g, p) for p in phrases if p in t for g in groups[p]), key=lambda x: (x[0].encode(), x[1].encode()))] for t in texts]
    assert len(files) > 1
    for slab, told, piece, kept, compared in ((1 << 20, 1 << 20, 32 << 20, 64 << 20, 1 << 16), (150, 7, 300, 0, 3)):
        for name, value in (("SLAB", slab), ("TOLD", told), ("PIECE", piece), ("KEPT", kept), ("COMPARED", compared)):
            monkeypatch.setattr(lexicon, name, value)
        lexicon._KEPT.clear()
        given = [pa.array(texts[:30], pa.string()), pa.array([], pa.string()), pa.array(["cut", *texts[30:]], pa.string()).slice(1)]
        slabs = list(lexicon._slabs(iter(given)))
        got = [row for s in slabs for part in lexicon._search(s, files) for row in part.to_pylist()]
        assert [r and [(h["grp"], h["phrase"]) for h in r] if r is not None else None for r in got] == want
        assert (len(slabs) > 10) == (slab == 150)


def test_many_files_are_listed_and_read_by_tasks(spark, tmp_path):
    import hashlib

    for name, data in {"0/a": b"one", "0/b c%20ü+#": b"x" * 50, "1/a.txt": b"two", "1/_a": b"hidden", "1/.a": b"hidden", "1/empty": b"", "1/deep/a": b"deep", "k=1/part-0": b"k", "k=1/other": b"o", "_k=2/j=3/part-1": b"kj"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    for pattern in ("[01]", "0", "0/a", "*/part-*", "?", "{0,1}/a*", "k=1", "_k=2", "*/deep", "*/deep/*"):
        path = f"file://{tmp_path}/{pattern}"
        by_spark = sorted(map(tuple, logs.file_manifest(spark, path).collect()))
        for whole in (0, 10, 1 << 30) if pattern == "0" else (10,):
            assert sorted(map(tuple, logs.file_manifest(spark, path, whole=whole, listed=0).collect())) == by_spark, pattern
    assert {r.sha256 for r in logs.file_manifest(spark, f"{tmp_path}/0", listed=1).collect()} == {hashlib.sha256(d).hexdigest() for d in (b"one", b"x" * 50)}
    many = logs.file_manifest(spark, f"file://{tmp_path}/0", listed=1)
    # Spark's reader, whose listing the driver holds, is not asked
    assert "binaryFile" not in many._jdf.queryExecution().executedPlan().toString() and many.count() == 2


def test_more_files_than_the_driver_lists(spark, data, tmp_path, monkeypatch):
    from opinara.plans.registry import file_queries

    asked, reader = [], type(spark.read)
    plain = reader.format
    monkeypatch.setattr(reader, "format", lambda self, name: asked.append(name) or plain(self, name))
    monkeypatch.setattr(logs.file_manifest, "__defaults__", (logs.WHOLE_FILE, 100))
    rows = file_queries.s05_large(spark, data).collect()
    n = spark.read.parquet(f"{data}/documents.parquet").count()
    assert n > 100 and [(r.n_files, r.n_alike) for r in rows] == [(n, n)] and "binaryFile" not in asked
