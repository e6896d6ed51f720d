"""Queries on readers, writers and streams: what is written to the shared folder is read back and compared."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from opinara.sources import logs
from opinara.streaming import jobs

from .batch_queries import index
from .registry import query
from .report_queries import INDEX, R
from .text_queries import SAID_IN_U, SCORED, TWO_BRANDS, scored, uttered
from .views import table, view, with_views


def envelopes(spark, d, more=()):
    """The said texts as raw rows."""
    at = F.date_format(F.timestamp_seconds(F.col("captured_at") * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = view(spark, d, "said").select("source", "brand", F.col("source_id").cast("string").alias("source_id"), "raw_text", at.alias("captured_at"), *more)
    return rows.withColumns({"url": F.lit("u"), "posted_at": F.lit(None).cast("string"), "rating": F.lit(None).cast("int"), "helpful_votes": F.lit(None).cast("int"), "meta": F.lit(None).cast("map<string,string>")})


def raw_folder(spark, d):
    """JSON lines by source and brand, with torn lines among them."""
    path = logs.shared_folder(spark)
    rows = envelopes(spark, d)
    fields = [c for c in rows.columns if c not in ("source", "brand")]
    whole = F.to_json(F.struct(*fields))
    torn = F.when(F.col("source_id").cast("long") % 10 == 0, F.substring(whole, 1, 20))
    rows.select("source", "brand", F.explode(F.array_compact(F.array(whole, torn))).alias("value")).write.partitionBy("source", "brand").text(path)
    return path


@query("s01_read_raw", with_views("said") + "SELECT source, brand, CAST(source_id AS STRING) AS source_id, raw_text FROM said WHERE source = 'play'")
def s01(spark, d):
    return logs.read_raw(spark, raw_folder(spark, d), source="play").select("source", "brand", "source_id", "raw_text")


@query("s05_file_manifest", "SELECT sha256(concat(n_name, chr(10))) AS sha256, CAST(strlen(n_name) + 1 AS BIGINT) AS bytes, true AS closed FROM nation")
def s05(spark, d):
    path = logs.shared_folder(spark)
    table(spark, d, "nation").select("n_nationkey", F.col("n_name").cast("string").alias("value")).write.partitionBy("n_nationkey").text(path)
    files = logs.file_manifest(spark, f"{path}/*/part-*")
    return files.select("sha256", "bytes", F.col("closed_at").isNotNull().alias("closed"))


@query("s05_large_files", "SELECT count(*) AS n_files, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes, count(*) AS n_alike FROM documents")
def s05_large(spark, d):
    """A file for each document, all of them hashed in parts and as whole values: the same digests by both."""
    path = logs.shared_folder(spark)
    logs.write_each(table(spark, d, "documents"), path)
    files = f"{path}/*"
    # a row for each file on either side, which Spark takes for fewer than they are: never broadcast
    other = logs.file_manifest(spark, files, whole=1 << 30).select("path", F.col("sha256").alias("other")).hint("merge")
    both = logs.file_manifest(spark, files, whole=0).select("path", "bytes", "sha256").join(other, "path")
    return both.agg(F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"), F.count_if(F.col("sha256") == F.col("other")).alias("n_alike"))


@query(
    "s04_two_appends",
    "WITH e AS (SELECT user_id, event_type, event_id FROM events), a AS (SELECT count(*) AS n, count(DISTINCT (user_id, event_type)) AS k FROM e WHERE event_id % 3 = 0), b AS (SELECT count(*) AS n, count(DISTINCT (user_id, event_type)) AS k FROM e) "
    "SELECT 1 AS run, a.k AS written, a.n - a.k AS skipped, a.k AS total FROM a UNION ALL SELECT 2, b.k - a.k, b.n - (b.k - a.k), b.k FROM a, b UNION ALL SELECT 3, 0, b.n, b.k FROM b",
)
def s04_two(spark, d):
    """A third of the rows, then all, then all again."""
    path = logs.shared_folder(spark)
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id")
    runs = [logs.write_append_dedup(part, path, ("user_id", "event_type"), ("event_type",)).withColumn("run", F.lit(k)) for k, part in enumerate((rows.where("event_id % 3 = 0"), rows, rows), 1)]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@query("s07_labelled_table", with_views("labelled") + "SELECT utterance_id, source, brand, opportunity_area, temporal_stance, severity, confidence, hesitation_marker FROM labelled")
def s07(spark, d):
    path = logs.shared_folder(spark)
    rows = view(spark, d, "labelled").select("utterance_id", "source", "brand", "opportunity_area", "temporal_stance", "severity", "confidence", "hesitation_marker")
    logs.write_table(rows, path)
    return logs.read_table(spark, path, rows.schema)


@query("s08_index_csv", INDEX + "SELECT source, temporal_stance, opportunity_area, brand, n_area, n_cell, round(oi, 9) AS oi, row_number() OVER (ORDER BY source NULLS FIRST, temporal_stance NULLS FIRST, oi DESC NULLS LAST, opportunity_area NULLS FIRST, brand) AS place FROM index_")
def s08(spark, d):
    """The file's lines in order."""
    path = logs.shared_folder(spark)
    rows = R.order_index(index(spark, d)).select("source", "temporal_stance", "opportunity_area", "brand", "n_area", "n_cell", "oi")
    logs.write_index_csv(rows, path)
    place = Window.orderBy(F.monotonically_increasing_id())  # one file of aggregates
    back = spark.read.schema(rows.schema).option("header", True).csv(path).withColumn("place", F.row_number().over(place))
    return back.withColumn("oi", F.round("oi", 9))


@query("s09_snapshot", with_views("labelled", "ledger") + "SELECT 'labelled' AS \"table\", count(*) AS n_rows, 3 AS n_columns FROM labelled UNION ALL SELECT 'ledger', count(*), 2 FROM ledger")
def s09(spark, d):
    path = logs.shared_folder(spark)
    tables = {name: view(spark, d, name) for name in ("labelled", "ledger")}
    counts = logs.snapshot(tables, ("utterance_id", "source", "severity", "event_id", "lane"), path)
    width = {name: len(spark.read.parquet(f"{path}/{name}").columns) for name in tables}
    return counts.withColumn("n_columns", F.element_at(F.create_map(*(F.lit(x) for kv in width.items() for x in kv)), F.col("table")))


@query("s11_read_gold_csv", with_views("gold") + "SELECT utterance_id, opportunity_area, temporal_stance, severity, hesitation_marker, sampling_weight FROM gold")
def s11(spark, d):
    path = logs.shared_folder(spark)
    rows = view(spark, d, "gold").select("utterance_id", "opportunity_area", "temporal_stance", "severity", "hesitation_marker", "sampling_weight")
    rows.write.option("header", True).csv(path)
    return logs.read_gold_csv(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema))


# ---- streams: what is there is taken in, and the query stops -----------------------------------------


def taken(spark, stream, mode="append"):
    """A stream's rows so far, as a table."""
    path = logs.shared_folder(spark)
    made = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{path}/rows").option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start()
    made.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


@query("r01_stream_ingest", with_views("said") + "SELECT source, brand, CAST(source_id AS STRING) AS source_id, raw_text FROM said")
def r01(spark, d):
    """Keys repeat within a batch, and all return in a second one after a restart."""
    path = logs.shared_folder(spark)
    rows = envelopes(spark, d)
    first = rows.where("pmod(cast(source_id as long), 3) <> 0")
    first.unionByName(first).write.json(f"{path}/in")
    for _ in range(2):
        jobs.stream_ingest(spark, f"{path}/in", f"{path}/rows", f"{path}/log").awaitTermination()
        rows.write.mode("append").json(f"{path}/in")
    jobs.stream_ingest(spark, f"{path}/in", f"{path}/rows", f"{path}/log").awaitTermination()
    return spark.read.schema(logs.ENVELOPE).parquet(f"{path}/rows").select("source", "brand", "source_id", "raw_text")


@query("r02_stream_pending", with_views("labelled") + "SELECT utterance_id FROM labelled WHERE utterance_id % 3 <> 0")
def r02(spark, d):
    """The label history is a bucketed table, which a micro-batch's join leaves where it is."""
    path = logs.shared_folder(spark)
    rows = view(spark, d, "labelled").select("utterance_id")
    rows.write.parquet(f"{path}/in")
    name = "history_" + path.rsplit("/", 1)[1]
    logs.bucketed_history(spark, name, f"{path}/history", "utterance_id bigint, classifier_version string", buckets=16)
    for part, version in (("utterance_id % 3 = 0", "v2"), ("true", "v1")):
        logs.add_history(rows.where(part).withColumn("classifier_version", F.lit(version)), name)
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    jobs.stream_pending(stream, lambda: spark.table(name), "v2", lambda batch: batch.write.mode("append").parquet(f"{path}/rows"), f"{path}/log").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/rows")


@query("r03_stream_segment", uttered("nfc_normalize(raw_text)") + f" SELECT source, CAST(source_id AS STRING) AS source_id, s AS start, e AS \"end\", {SAID_IN_U} AS utterance_text FROM u")
def r03(spark, d):
    path = logs.shared_folder(spark)
    envelopes(spark, d).write.json(path)
    out = jobs.stream_normalise_segment(jobs.read_stream(spark, path))
    return taken(spark, out.select("source", "source_id", F.col("span.start").alias("start"), F.col("span.end").alias("end"), "utterance_text"))


def counted(spark, rows, stream, key):
    """Running counts of rows that arrive in two parts, the later ones after a restart; open windows are told too."""
    path = logs.shared_folder(spark)
    at = F.unix_micros("at")
    # asked once: the sketch depends on the order in which rows come to it, and two answers would take rows twice or never
    middle = F.lit(rows.select(F.percentile_approx(at, 0.5)).first()[0])
    for early in (True, False):
        part = rows.where(at <= middle if early else at > middle)
        part.write.mode("append").parquet(f"{path}/in")
        counts = stream(spark.readStream.schema(rows.schema).parquet(f"{path}/in"))
        jobs.upsert_stream(counts, f"{path}/rows", f"{path}/log").awaitTermination()
    return jobs.running(spark, f"{path}/rows", counts.schema, key)


USAGE = with_views("ledger") + """, l AS (SELECT *, CAST(floor(epoch(called_at) / 10) AS BIGINT) * 10 AS s FROM ledger), w AS (SELECT l.*, s - 10 * k AS w FROM l, range(6) o(k))
    SELECT make_timestamp(w * 1000000) AS start, lane, count(*) AS calls, CAST(sum(coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0)) AS BIGINT) AS tokens FROM w GROUP BY w, lane"""


@query("r04_stream_usage", USAGE)
def r04(spark, d):
    rows = view(spark, d, "ledger").select(F.col("called_at").cast("timestamp").alias("at"), "lane", "prompt_tokens", "completion_tokens")
    out = counted(spark, rows, jobs.stream_usage, ("start", "lane"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "lane", "calls", "tokens")


@query("r05_stream_drop_counts", SCORED.replace("@BRANDS@", TWO_BRANDS) + """, t AS (SELECT source, reason, make_timestamp(captured_at * 60000000) AS told FROM s WHERE reason IS NOT NULL)
    SELECT date_trunc('hour', told) AS start, source, reason, count(*) AS n FROM t GROUP BY ALL""")
def r05(spark, d):
    rows = scored(spark, d).where("reason is not null").select(F.timestamp_seconds(F.col("captured_at") * 60).alias("at"), "source", "reason")
    path = logs.shared_folder(spark)
    rows.write.parquet(path)
    out = counted(spark, spark.read.schema(rows.schema).parquet(path), jobs.stream_drop_counts, ("start", "source", "reason"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "source", "reason", "n")
