"""The same steps as Structured Streaming jobs over growing folders and logs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from opinara.functions.segment import segment
from opinara.operators.labels import pending
from opinara.operators.prepare import normalise
from opinara.sources.logs import ENVELOPE, KEY

#: Keys of a micro-batch that are told to all tasks, once counted; more are joined by shuffle.
FEW_KEYS = 200_000


def read_stream(spark: SparkSession, path: str, schema: str = ENVELOPE) -> DataFrame:
    return spark.readStream.schema(schema).json(path)


def stream_ingest(spark: SparkSession, folder: str, table: str, checkpoint: str, key: tuple[str, ...] = KEY) -> StreamingQuery:
    """Take what is new in a folder of JSON lines into a table, exactly once for each key over any time, and stop.

    Each micro-batch appends the keys that no earlier one has, as the partition ``batch`` of its number. A batch that is
    run again after a failure writes over its own partition and compares with those before it, so it ends as it would have
    at first; a key that returns later, after a restart too, is in the table already. The stream keeps no state: the table
    itself is the memory, of which a batch reads the key columns. Keys are compared first, without the rows; where few are
    new they are told to all tasks, so that only their rows move. A batch of few keys is told to all tasks, so that only what
    it may repeat leaves the table's tasks.
    """
    rows = read_stream(spark, folder)
    schema = f"{ENVELOPE}, batch long"

    def take(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        if number > 0:
            there = own.read.schema(schema).parquet(table).where(F.col("batch") < number).select(*key)
            ids = batch.select(*key).distinct()
            few = ids.limit(FEW_KEYS + 1).count() <= FEW_KEYS
            # null-safe: a key part may be null
            alike = lambda a, b: reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in key))
            if few:
                told = F.broadcast(ids)
                there = there.join(told, alike(there, told), "left_semi").distinct()
            # only keys are compared; whole rows move once, and none at all where all keys are there already
            fresh = ids.join(there, alike(ids, there), "left_anti")
            left = fresh.limit(FEW_KEYS + 1).count()
            told = F.broadcast(fresh) if left <= FEW_KEYS else fresh
            batch = batch.join(told, alike(batch, told), "left_semi") if left else batch.limit(0)
        batch.dropDuplicates(list(key)).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(counts: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """A stream of running aggregates into a table of changes: each micro-batch writes the rows that it changed, open windows
    too, as the partition ``batch`` of its number, over whatever an interrupted run of it left. See ``running``."""
    take = lambda batch, number: batch.write.mode("overwrite").parquet(f"{table}/batch={number}")
    return counts.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running(spark: SparkSession, table: str, schema: StructType, key: tuple[str, ...]) -> DataFrame:
    """The counts so far from a table of changes: of each key the row of the last micro-batch that changed it."""
    changes = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(table)
    last = changes.groupBy(*key).agg(F.max_by(F.struct(*schema.names), "batch").alias("r"))
    return last.select("r.*")


def stream_pending(rows: DataFrame, done: Callable[[], DataFrame], version: str, handle: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Hand each new micro-batch's rows that this version has not labelled to ``handle``."""
    return rows.writeStream.foreachBatch(lambda batch, _: handle(pending(batch, done(), version))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_normalise_segment(rows: DataFrame) -> DataFrame:
    """Stateless steps on a stream: the Column functions of the batch job."""
    return segment(normalise(rows))


def stream_usage(ledger: DataFrame, window: str = "60 seconds", slide: str = "10 seconds", delay: str = "2 minutes") -> DataFrame:
    """Calls and tokens of a lane in sliding minutes."""
    out = ledger.withWatermark("at", delay).groupBy(F.window("at", window, slide), "lane").agg(F.count("*").alias("calls"), F.sum(F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0))).alias("tokens"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "lane", "calls", "tokens")


def stream_drop_counts(log: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Running counts of drops by source and reason."""
    out = log.withWatermark("at", delay).groupBy(F.window("at", window), "source", "reason").agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), "source", "reason", "n")
