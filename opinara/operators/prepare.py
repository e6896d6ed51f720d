"""Normalising, near-duplicate marks, ordered drop rules and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import text as T
from opinara.sources.logs import shared_folder

#: A text hash is heavy if more than one row in so many has it.
HEAVY = 10_000
DROP_REASONS = ("no_text", "too_short", "near_dup", "spam", "not_shopping", "wrong_brand")


def require_nonempty_key(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): an id that is not empty and a text that is not null."""
    good = F.coalesce(F.col("source_id") != "", F.lit(False)) & F.col("raw_text").isNotNull()
    return df.where(good), df.where(~good)


def normalise(df: DataFrame, raw: str = "raw_text", compose: bool = True) -> DataFrame:
    """The normalised text, its hash and language, and the emphasis of the raw text."""
    out = df.withColumn("normalised_text", T.normalise(F.col(raw), compose))
    return out.withColumns({"text_sha1": T.text_hash(F.col("normalised_text")), "language": T.detect_language(F.col("normalised_text")), **T.emphasis_flags(F.col(raw))})


def _joined_by_hash(df: DataFrame, each: DataFrame, rows: str = "_n") -> DataFrame:
    """``df`` with the columns of ``each(_h, _n, ...)``, a row for each text hash with its number of rows, null where none is.

    Hashes of more than one row in ``HEAVY`` are fewer than ``HEAVY``, so they are told to all tasks; their rows get a key
    of their own for the shuffle, by which they are dealt evenly. What is left under one hash is no more than one row in
    ``HEAVY``. ``each`` is written, as it is asked three times and would else hash all texts anew each time.
    """
    names, path = [c for c in each.columns if c not in ("_h", rows)], shared_folder(df.sparkSession)
    each.write.parquet(path)
    each = df.sparkSession.read.schema(each.schema).parquet(path)
    total = each.agg(F.sum(rows).alias("_all"))
    heavy = each.join(F.broadcast(total)).where(F.col(rows) * HEAVY > F.col("_all")).drop("_all", rows)  # one row
    told = df.join(F.broadcast(heavy.select(F.col("_h").alias("_hh"), *(F.col(c).alias(f"_h{c}") for c in names))), F.col("text_sha1") == F.col("_hh"), "left")
    own = F.when(F.col("_hh").isNull(), F.col("text_sha1")).otherwise(F.concat(F.lit("-"), F.monotonically_increasing_id()))
    both = told.withColumn("_k", own).join(each.select("_h", *names), F.col("_k") == F.col("_h"), "left")
    out = both.withColumns({c: F.coalesce(f"_h{c}", c) for c in names})
    return out.drop("_h", "_hh", "_k", *(f"_h{c}" for c in names))


def mark_near_duplicates(df: DataFrame, order: tuple[str, ...] = ("captured_at", "source", "brand", "source_id")) -> DataFrame:
    """``near_dup_of``: the key of the first row with the same hash, null for that row itself.

    The first of each hash is a partial aggregate, so a hash that very many rows share does not meet in one task; only
    hashes that repeat are joined back.
    """
    key = F.concat_ws(":", "source", "source_id")
    first = df.groupBy("text_sha1").agg(F.min(F.struct(*order)).alias("_o"), F.count("*").alias("_n")).where("_n > 1")
    first = first.select(F.col("text_sha1").alias("_h"), F.concat_ws(":", "_o.source", F.col("_o.source_id").cast("string")).alias("_first"), "_n")
    both = _joined_by_hash(df, first)
    return both.withColumn("near_dup_of", F.when(F.col("_first") != key, F.col("_first"))).drop("_first")


def repeat_count(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct source ids of each text hash."""
    count = F.approx_count_distinct("source_id") if approximate else F.count_distinct("source_id")
    return df.groupBy("text_sha1").agg(count.alias("n_ids"))


def with_repeats(df: DataFrame, limit: int = 5) -> DataFrame:
    """``n_ids`` where a hash has more ids than the limit, else 0; only those hashes are joined."""
    many = df.groupBy("text_sha1").agg(F.count_distinct("source_id").alias("_ids"), F.count("*").alias("_n")).where(F.col("_ids") > limit)
    both = _joined_by_hash(df.drop("n_ids"), many.withColumnRenamed("text_sha1", "_h"))
    return both.withColumn("n_ids", F.coalesce("_ids", F.lit(0))).drop("_ids")


def mark_copies(df: DataFrame, limit: int = 5, order: tuple[str, ...] = ("captured_at", "source", "brand", "source_id")) -> DataFrame:
    """``near_dup_of`` and ``n_ids`` as by ``mark_near_duplicates`` and ``with_repeats``, from one aggregate and one join."""
    key = F.concat_ws(":", "source", "source_id")
    each = df.groupBy("text_sha1").agg(F.min(F.struct(*order)).alias("_o"), F.count("*").alias("_n"), F.count_distinct("source_id").alias("_ids")).where("_n > 1")
    each = each.select(F.col("text_sha1").alias("_h"), F.concat_ws(":", "_o.source", F.col("_o.source_id").cast("string")).alias("_first"), "_ids", "_n")
    both = _joined_by_hash(df, each)
    return both.withColumns({"near_dup_of": F.when(F.col("_first") != key, F.col("_first")), "n_ids": F.when(F.col("_ids") > limit, F.col("_ids")).otherwise(0)}).drop("_first", "_ids")


def drop_reason(brands: dict[str, str] | None = None, *, text: str = "utterance_text", min_tokens: int = 3, min_words: int = 10, repeat_limit: int = 5, url_tokens: int = 15) -> Column:
    """The first rule that a row of ``text, source, brand, source_id, near_dup_of, n_ids[, brand_fixed]`` breaks; null: keep.

    ``brands`` are patterns by brand; they matter only where ``brand_fixed`` is false, as on a forum.
    """
    said = F.col(text)
    long = T.has_words(said, min_words)
    own = F.concat_ws(":", "source", "source_id")
    out = (
        F.when(F.coalesce(T.trimmed(said), F.lit("")) == "", "no_text")
        .when(~T.has_content_tokens(said, min_tokens), "too_short")
        .when(F.col("near_dup_of").isNotNull() & (F.col("near_dup_of") != own) & long, "near_dup")
        .when(~T.has_content_tokens(said, url_tokens) & said.rlike(T.URL), "spam")
        .when((F.col("n_ids") > repeat_limit) & long, "spam")
        .when(said.rlike(T.GENERIC) | said.rlike(T.CRASH), "not_shopping")
    )
    if brands:
        mentions = F.array_compact(F.array(*(F.when(said.rlike(p), F.lit(b)) for b, p in brands.items())))
        out = out.when(~F.col("brand_fixed") & (F.size(mentions) > 0) & ~F.array_contains(mentions, F.col("brand")), "wrong_brand")
    return out


def filter_utterances(df: DataFrame, reason: Column, text: str = "utterance_text") -> tuple[DataFrame, DataFrame]:
    """(kept, drop log): the log has the reason and the first 280 characters."""
    scored = df.withColumn("reason", reason)
    return scored.where("reason is null").drop("reason"), scored.where("reason is not null").withColumn(text, F.substring(text, 1, 280))


def normalise_report(df: DataFrame) -> DataFrame:
    """For each source: rows, near-duplicates, part of unknown times, and the languages' counts."""
    per = df.groupBy("source", "language").agg(F.count("*").alias("n"), F.count("near_dup_of").alias("d"), F.count_if(F.col("posted_at").isNull()).alias("u"))
    return per.groupBy("source").agg(
        F.sum("n").alias("n_rows"), F.sum("d").alias("n_near_dup"), (F.sum("u") / F.sum("n")).alias("posted_at_null_rate"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "n")))).alias("languages"),
    )


def drop_report(scored: DataFrame) -> DataFrame:
    """Drops by source and reason, by source, and in all (nulls stand for all), with the part of all rows of the level."""
    base = scored.groupBy("source", "reason").agg(F.count("*").alias("n"))
    rows = base.groupBy("source").agg(F.sum("n").alias("n_rows"))
    total = base.agg(F.sum("n").alias("n_rows")).select(F.lit(None).cast("string").alias("source"), "n_rows")
    drops = base.where("reason is not null").rollup("source", "reason").agg(F.sum("n").alias("n_dropped"))
    by_reason = base.where("reason is not null").groupBy("reason").agg(F.sum("n").alias("n_dropped")).select(F.lit(None).cast("string").alias("source"), "reason", "n_dropped")
    out = drops.unionByName(by_reason)
    return out.join(rows.unionByName(total).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select("source", "reason", "n_dropped", (F.col("n_dropped") / F.col("n_rows")).alias("rate"))


def segment_report(utterances: DataFrame) -> DataFrame:
    out = utterances.agg(F.count_distinct("source", "source_id").alias("n_reviews"), F.count("*").alias("n_utterances"))
    return out.withColumn("ratio", F.col("n_utterances") / F.col("n_reviews"))


def near_dup_floor(dropped: DataFrame, text: str = "utterance_text", longest: int = 20) -> DataFrame:
    """``floor``: the least word count from which asking for one word more drops no further near-duplicate."""
    spark = dropped.sparkSession
    counts = dropped.select(F.least(T.word_count(F.col(text)), F.lit(longest + 1)).alias("words")).groupBy("words").agg(F.count("*").alias("n"))
    curve = spark.range(1, longest + 1).select(F.col("id").cast("int").alias("floor")).join(counts.withColumnRenamed("words", "_w"), F.col("_w") >= F.col("floor"), "left")
    left = curve.groupBy("floor").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("left"))
    after = left.select((F.col("floor") - 1).alias("floor"), F.col("left").alias("next"))
    return left.join(after, "floor").where(F.col("left") == F.col("next")).agg(F.min("floor").alias("floor"))
