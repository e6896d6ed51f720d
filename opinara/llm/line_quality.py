"""Quality rules: base measures of a text, and lines that many documents of a host share.

The line method hashes normalised lines, counts for each host the distinct documents that hold a line, removes lines above
the limits and rejects documents that are depleted by it. Rows of a host with one and the same text are one document, told
apart from others by a hash of the whole text, so exact copies do not make their own text boilerplate; taking one of them
is the work of deduplication. Everything is DataFrame operations. A line occurs once for each document before the shuffle,
and counts are summed on the map side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut

#: A line is boilerplate if more documents of a host than MOST and than RATE of the host's documents hold it.
MOST, RATE = 5, 0.002
#: A document is depleted if fewer words than this are left, or a smaller part of its words.
LEAST_WORDS, LEAST_PART = 10, 0.3
WINDOW = 5


def _blank(text: Column, marks: str) -> Column:
    """``text`` with each of ``marks`` as a space."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), marks, text)


def _neighbours(a: Column, step: int) -> Column:
    """A hash of each place of an array of hashes with the place ``step`` further on, for all places that have one."""
    n = F.greatest(F.size(a) - step, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(1 + step), n), lambda x, y: F.xxhash64(x, y))


def _covered(windows: Column) -> Column:
    """Words within windows that occur twice or more: windows in order of hash, neighbours with one hash, their places."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.zip_with(placed, F.slice(placed, F.lit(2), F.size(placed) - 1), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")))
    starts = F.sort_array(F.array_distinct(F.flatten(twice)))
    return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")), lambda a, s: F.struct((a["n"] + F.least(F.lit(WINDOW), s - a["at"])).alias("n"), s.alias("at")), lambda a: a["n"])


def measures(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` with the measures ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long)
    and ``base_failed``. A null text has no words; whole texts are measured, however long."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.withColumn("_flat", _blank(text, "\t\n\x0b\f\r")).withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)))
    held = held.withColumn("_words", F.array_remove(F.split("_flat", " ", -1), ""))
    # a hash for each word, pair, four and at last five words in a row
    one = F.transform("_words", lambda w: F.xxhash64(w))
    held = held.withColumn("_one", F.when(F.size("_words") > WINDOW, one).otherwise(F.array().cast("array<bigint>")))
    held = held.withColumn("_windows", F.zip_with(_neighbours(_neighbours(F.col("_one"), 1), 2), F.slice("_one", F.lit(5), F.greatest(F.size("_one") - 4, F.lit(0))), lambda x, y: F.xxhash64(x, y)))
    held = held.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.replace("_flat", F.lit(" "), F.lit(""))).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), F.lit(0)).otherwise(_covered(F.col("_windows"))).cast("long"),
        }
    ).drop("_flat", "_lines", "_words", "_one", "_windows")
    return held.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def normalised(text: Column) -> Column:
    """A text for the comparison of lines: in lower case, digits as one 0, white space within a line as one space."""
    plain = _blank(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "\t\x0b\f\r")
    return F.regexp_replace(F.regexp_replace(plain, "[0-9]+", "0"), " {2,}", " ")


def keyed(line: Column) -> Column:
    """A normalised line's key, null if it has no word."""
    bare = F.trim(line)
    return F.when(bare != "", F.xxhash64(bare))


def each_line(text: Column) -> Column:
    """``array<struct<k: key, n: words>>`` of the lines that hold a word."""
    bare = F.array_remove(F.transform(F.split(normalised(text), "\n", -1), lambda x: F.trim(x)), "")
    return F.transform(bare, lambda x: F.struct(F.xxhash64(x).alias("k"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n")))


def frequent_lines(held: DataFrame, most: int, rate: float) -> DataFrame:
    """``held(_host, _doc long, _each)`` -> ``_host, _key``: the lines of a host that are above both limits. Rows of a host
    with one ``_doc`` are one document."""
    rows = held.select("_host", "_doc", F.explode(F.array_distinct(F.transform("_each", lambda x: x["k"]))).alias("_key"))
    counts = rows.distinct().groupBy("_host", "_key").agg(F.count("*").alias("_docs")).where(F.col("_docs") > most)
    hosts = held.select(F.col("_host").alias("_h"), "_doc").distinct().groupBy("_h").agg(F.count("*").alias("_all"))
    return counts.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).where(F.col("_docs") > rate * F.col("_all")).select("_host", "_key")


def judge(docs: DataFrame, **limits) -> DataFrame:
    """A row for each row of ``docs(doc_id, text, host)``: the measures, ``base_failed``, ``n_removed_lines``,
    ``n_left_words`` and ``kept``; ``drop_lines`` are the keys of the lines to remove.

    Limits: ``host`` (column), ``most`` and ``rate`` (a line is removed if more documents of its host hold it than both),
    ``least_words`` and ``least_part`` (what must be left), ``copies_once`` (rows of a host with one and the same text are one
    document, so that exact copies do not make their own text boilerplate; if not, each doc_id with its text is one). Rows that repeat a doc_id are judged each by its own text. Null
    hosts are one host; a null or empty text fails the base rule (no words); very long texts are judged whole; ties do not
    occur; an empty table gives no rows; extra columns are ignored.
    """
    return _judged(docs, **limits).drop("_host", "_doc")


def _judged(docs: DataFrame, *, host: str = "source", most: int = MOST, rate: float = RATE, least_words: int = LEAST_WORDS, least_part: float = LEAST_PART, copies_once: bool = True) -> DataFrame:
    """``judge`` with ``_host`` and ``_doc``, which tell apart the texts of rows that repeat a doc_id."""
    held = measures(docs.select("doc_id", F.col(host).alias("_host"), "text"))
    held = cut(held.withColumn("_each", each_line(F.col("text"))).withColumn("_doc", F.xxhash64("text")).drop("text"))
    told = held if copies_once else held.withColumn("_doc", F.xxhash64("doc_id", "_doc"))
    bad = cut(frequent_lines(told, most, rate))
    flat = held.select("_host", "_doc", F.posexplode("_each").alias("_at", "_l")).select("_host", "_doc", "_at", F.col("_l.k").alias("_key"), F.col("_l.n").alias("_n"))
    near = F.broadcast(bad) if bad.limit(200_001).count() <= 200_000 else bad
    hit = flat.alias("f").join(near.alias("b"), (F.col("f._key") == F.col("b._key")) & F.col("f._host").eqNullSafe(F.col("b._host")))
    # a text's lines are the same in all rows that hold it, so a set of places holds them once
    hit = hit.groupBy(F.col("f._host").alias("_h"), F.col("f._doc").alias("_d")).agg(F.collect_set(F.struct("f._at", "f._n", "f._key")).alias("_hits"))
    gone = F.aggregate("_hits", F.lit(0).cast("long"), lambda a, x: a + x["_n"])
    hit = hit.select("_h", "_d", F.size("_hits").alias("_lines"), gone.alias("_gone"), F.array_distinct(F.transform("_hits", lambda x: x["_key"])).alias("_keys"))
    out = held.drop("_each").join(hit, F.col("_host").eqNullSafe(F.col("_h")) & (F.col("_doc") == F.col("_d")), "left")
    left = F.col("n_words") - F.coalesce("_gone", F.lit(0))
    depleted = F.col("_gone").isNotNull() & ((left < least_words) | (left < least_part * F.col("n_words")))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce("_lines", F.lit(0)).cast("long").alias("n_removed_lines"), left.alias("n_left_words"),
        (~F.col("base_failed") & ~depleted).alias("kept"), F.coalesce("_keys", F.array().cast("array<bigint>")).alias("drop_lines"), "_host", "_doc",
    )


def apply(docs: DataFrame, **limits) -> DataFrame:
    """The kept rows with all their columns, each once and by the verdict on its own text; their text without the lines to
    remove; ``n_chars``, if there, follows. See ``judge`` for limits and edge cases; rows with a null text go."""
    host = limits.get("host", "source")
    verdict = _judged(docs, **limits).where("kept").select(F.col("_host").alias("_h"), F.col("_doc").alias("_d"), "drop_lines").dropDuplicates(["_h", "_d"])
    # rows travel whole under one name, so that no column of theirs clashes with others
    rows = docs.select(F.struct("*").alias("row"), F.col(host).alias("_host"), F.col("text").alias("text"))
    both = rows.join(verdict, F.col("_host").eqNullSafe(F.col("_h")) & (F.xxhash64("text") == F.col("_d")))
    raw, keys = F.split("text", "\n", -1), F.transform(F.split(normalised(F.col("text")), "\n", -1), lambda x: keyed(x))
    paired = F.zip_with(raw, keys, lambda x, k: F.struct(x.alias("x"), k.alias("k")))
    bare = F.array_join(F.transform(F.filter(paired, lambda p: p["k"].isNull() | ~F.array_contains("drop_lines", p["k"])), lambda p: p["x"]), "\n")
    out = both.select("row", F.when(F.size("drop_lines") > 0, bare).otherwise(F.col("text")).alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
