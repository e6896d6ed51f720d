import json

from pyspark.sql import functions as F

from opinara.functions.segment import segment
from opinara.operators.prepare import normalise
from opinara.sources.logs import ENVELOPE
from opinara.streaming import jobs


def lines(*ids):
    row = {"source": "play", "brand": "b", "raw_text": "The kurta was nice to wear at home. But small. The refund took weeks.", "captured_at": "2026-01-01T00:00:00Z"}
    return "".join(json.dumps(row | {"source_id": i}) + "\n" for i in ids)


def test_ingest_takes_each_key_once(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    run = lambda: jobs.stream_ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination(120)
    ids = lambda: sorted(r[0] for r in spark.read.schema(ENVELOPE).parquet(str(tmp_path / "t")).select("source_id").collect())
    (tmp_path / "in" / "1.jsonl").write_text(lines("1", "1", "2"))
    assert run()
    (tmp_path / "in" / "2.jsonl").write_text(lines("2", "3", "3"))
    assert run() and ids() == ["1", "2", "3"]
    # years later, after a restart, with many keys
    monkeypatch.setattr(jobs, "FEW_KEYS", 1)
    (tmp_path / "in" / "3.jsonl").write_text(lines("1", "4", "3").replace("2026-", "2036-"))
    assert run() and ids() == ["1", "2", "3", "4"]
    assert not (tmp_path / "c" / "state").exists()


def test_a_batch_that_runs_again_writes_over_itself(spark, tmp_path):
    import shutil

    (tmp_path / "in").mkdir()
    run = lambda: jobs.stream_ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination(120)
    for k in ("1", "2"):
        (tmp_path / "in" / f"{k}.jsonl").write_text(lines(k, "9"))
        assert run()
    # the log of the last batch's end is lost, as in a crash between its write and its commit
    for gone in ("1", ".1.crc"):
        (tmp_path / "c" / "commits" / gone).unlink(missing_ok=True)
    assert run()
    assert sorted(r[0] for r in spark.read.schema(ENVELOPE).parquet(str(tmp_path / "t")).select("source_id").collect()) == ["1", "2", "9"]
    shutil.rmtree(tmp_path / "t")


def test_running_counts_hold_open_windows(spark, tmp_path):
    log = spark.createDataFrame([(0, "spam"), (5, "spam"), (4000, None)], "s int, reason string").withColumns({"at": F.timestamp_seconds("s"), "source": F.lit("play")})
    key = ("start", "source", "reason")
    for part in ("s < 5", "s >= 5"):
        log.where(part).write.mode("append").parquet(str(tmp_path / "l"))
        counts = jobs.stream_drop_counts(spark.readStream.schema(log.schema).parquet(str(tmp_path / "l")))
        assert jobs.upsert_stream(counts, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination(120)
    got = jobs.running(spark, str(tmp_path / "t"), counts.schema, key).collect()
    assert sorted((r.reason or "", r.n) for r in got) == [("", 1), ("spam", 2)]


def test_stateless_steps_equal_the_batch_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text(lines("1", "2"))
    stream = jobs.stream_normalise_segment(jobs.read_stream(spark, str(tmp_path / "in"))).select("utterance_id")
    q = stream.writeStream.format("memory").queryName("cut").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    batch = segment(normalise(spark.read.schema(ENVELOPE).json(str(tmp_path / "in")))).select("utterance_id")
    assert sorted(spark.table("cut").collect()) == sorted(batch.collect())


def test_pending_in_micro_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text(lines("1", "2", "3"))
    rows = jobs.read_stream(spark, str(tmp_path / "in")).withColumnRenamed("source_id", "utterance_id")
    done = spark.createDataFrame([("1", "v2"), ("2", "v1")], "utterance_id string, classifier_version string")
    seen = []
    q = jobs.stream_pending(rows, lambda: done, "v2", lambda df: seen.extend(r["utterance_id"] for r in df.collect()), str(tmp_path / "c"))
    assert q.awaitTermination(120) and sorted(seen) == ["2", "3"]


def test_usage_and_drop_counts(spark, tmp_path):
    spark.createDataFrame([(0, "A", 1, 2, "spam"), (5, "A", 1, None, "spam"), (500, "B", 1, 1, "no_text")], "s int, lane string, prompt_tokens int, completion_tokens int, reason string").withColumns({"at": F.timestamp_seconds("s"), "source": F.lit("play")}).write.parquet(str(tmp_path / "l"))
    log = spark.readStream.schema(spark.read.parquet(str(tmp_path / "l")).schema).parquet(str(tmp_path / "l"))
    for name, df in (("usage", jobs.stream_usage(log)), ("drops", jobs.stream_drop_counts(log))):
        q = df.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    assert max((r["calls"], r["tokens"]) for r in spark.table("usage").where("lane = 'A'").collect()) == (2, 4)
    assert sum(r["n"] for r in spark.table("drops").collect()) == 3


def test_each_row_is_counted_once_in_whatever_order_rows_come(spark, monkeypatch, tmp_path):
    import os

    from opinara.plans.registry import file_queries

    monkeypatch.setattr(file_queries.logs, "shared_folder", lambda spark: str(tmp_path / "c"))
    any_order = F.udf(lambda: os.urandom(8), "binary").asNondeterministic()
    rows = spark.range(200_000).withColumn("r", any_order()).repartition(4, "r").sortWithinPartitions("r")
    rows = rows.select(F.timestamp_micros(F.col("id") * 1000).alias("at"), F.lit("A").alias("lane"), F.lit(1).alias("prompt_tokens"), F.lit(0).alias("completion_tokens"))
    out = file_queries.counted(spark, rows, lambda df: jobs.stream_usage(df, "10 seconds", "10 seconds"), ("start", "lane"))
    assert out.agg(F.sum("calls"), F.sum("tokens")).first()[:] == (200_000, 200_000)


def test_rows_of_known_keys_do_not_move(spark, tmp_path, monkeypatch):
    frame, moved = type(spark.range(1)), []
    whole = frame.dropDuplicates
    monkeypatch.setattr(frame, "dropDuplicates", lambda self, *a: moved.append(self.count()) or whole(self, *a))
    monkeypatch.setattr(jobs, "FEW_KEYS", 1)
    (tmp_path / "in").mkdir()
    for k, ids in enumerate((("1", "2", "3"), ("1", "2", "3"), ("3", "4", "5", "5"))):
        (tmp_path / "in" / f"{k}.jsonl").write_text(lines(*ids))
        assert jobs.stream_ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination(120)
    assert moved == [3, 0, 3]
    assert sorted(r[0] for r in spark.read.schema(ENVELOPE).parquet(str(tmp_path / "t")).select("source_id").collect()) == ["1", "2", "3", "4", "5"]
