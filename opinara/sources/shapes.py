"""From payloads of review surfaces to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THREAD = "struct<id:string,text:string,author:string>"
#: Keys under which a payload may hold its records, in order of precedence, and such keys one level down.
RECORD_KEYS = ("questions", "reviews", "content", "data", "results", "items")
INNER_KEYS = ("questions", "reviews", "content", "items")
#: Fields of a record that become columns.
FIELDS = ("id", "text", "date", "votes", "rating")



def flatten_threads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``thread_id, payload`` with JSON {top, replies} -> a row for the top comment and one for each reply."""
    parsed = F.from_json(F.col(payload), f"struct<top:{THREAD},replies:array<{THREAD}>>")
    kind = lambda c, name: F.struct(c["id"].alias("source_id"), c["text"].alias("raw_text"), F.lit(name).alias("comment_kind"))
    rows = df.withColumn("_p", parsed)
    all_ = F.concat(F.array(kind(F.col("_p.top"), "top")), F.transform(F.coalesce("_p.replies", F.array().cast(f"array<{THREAD}>")), lambda r: kind(r, "reply")))
    return rows.withColumn("_r", F.explode(all_)).select("thread_id", "_r.*").where("source_id is not null")


def flatten_submissions(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Submissions (title, blank line, body) and comments as rows; deleted and empty texts go; ids once; epoch to UTC."""
    top = submissions.select(F.col("id").alias("source_id"), F.concat_ws("\n\n", "title", F.nullif(F.col("body"), F.lit(""))).alias("raw_text"), "created_utc", F.lit("submission").alias("kind"))
    below = comments.select(F.col("id").alias("source_id"), F.col("body").alias("raw_text"), "created_utc", F.lit("comment").alias("kind"))
    rows = top.unionByName(below).where(~F.trim("raw_text").isin("", "[deleted]", "[removed]"))
    return rows.withColumn("posted_at", F.timestamp_seconds("created_utc")).drop("created_utc").dropDuplicates(["source_id"])


def extract_rows(df: DataFrame, payload: str = "payload", fields: tuple[str, ...] = FIELDS) -> tuple[DataFrame, DataFrame]:
    """(rows, payloads of unknown shape): a row for each record, with its ``fields`` as text and the whole ``record`` as a
    variant, so that numbers and nested objects stay as they are.

    Records are the array under the first known key that holds one, itself or in an object one level down; a payload that
    is an array holds them itself. A null, torn or too large payload, or one with a key twice in an object, is unknown; an
    empty array has no rows and is known. A payload is parsed once.
    """
    paths = ["$", *(p for k in RECORD_KEYS for p in (f"$.{k}", *(f"$.{k}.{inner}" for inner in INNER_KEYS)))]
    first = lambda v: F.coalesce(*(F.try_variant_get(v, p, "array<variant>") for p in paths))
    found = F.transform(F.array(F.try_parse_json(F.col(payload))), first)[0]  # a lambda's variable is computed once
    # an outer explode, as a filter that a plain one brings would parse once more
    rows = df.select(*df.columns, F.explode_outer(found).alias("record")).where("record is not null")
    rows = rows.select(*df.columns, *(F.try_variant_get("record", f"$.{f}", "string").alias(f) for f in fields), "record")
    return rows, df.where(found.isNull())


def merge_last_wins(existing: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Upsert: of each key the row of highest version."""
    both = existing.unionByName(new, allowMissingColumns=True)
    return both.groupBy(key).agg(F.max_by(F.struct(*both.columns), F.col(version)).alias("r")).select("r.*")


def union_slices(slices: list[DataFrame], key: str = "source_id") -> DataFrame:
    """All slices of one query, each id once."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slices).dropDuplicates([key])
