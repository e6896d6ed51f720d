"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Each source's target is its weight's share of the words wanted, at most ``repeats`` times its own words; what a capped
   source leaves goes to the others by weight.
2. The mix has ``floor(wanted / block)`` blocks, which go to sources by highest quotients ``target / (2 * s + 1)``.
3. A source's blocks go to its shards in the same way, in two levels, so that no apportionment sees more rows than the
   shards of one parent. A shard holds a bounded number of words; its documents lie end to end in a seeded order.
4. A shard takes itself whole as often as its quota allows and then so many of its blocks, chosen by a seeded order.

Everything is DataFrame operations; the same input, seed and parameters give the same mix however rows are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, word_count

#: Words of a block and (about) of a shard; sources, or shards of one parent, among which blocks are dealt at once.
BLOCK, SHARD, FANOUT = 256, 65_536, 1024


def apportion(votes: DataFrame, within: list[str], key: str, weight: str, seats: str) -> DataFrame:
    """Add ``quota long``: the seats of each group ``within`` dealt among its rows by Sainte-Laguë's highest quotients.

    ``seats`` is the group's number, equal in all its rows. A divisor a little too large first gives each row so many
    seats that fewer than 2n of the group's n rows' quotients are open; only those few quotients are then ranked. Ties go
    to the lower ``key``, nulls last; rows without weight get none.
    """
    group = Window.partitionBy(*within)
    total, n = F.sum(weight).over(group), F.count("*").over(group)
    known = votes.withColumn("_n", n).withColumn("_divisor", F.when(F.col(seats) > n, total / (F.col(seats) - n)))
    known = known.withColumn("_base", F.coalesce(F.floor(F.col(weight) / F.col("_divisor") + 0.5), F.lit(0)).cast("long"))
    known = known.withColumn("_left", F.col(seats) - F.sum("_base").over(group))
    # a row can win no more of the open seats than its quotients above the final divisor, which is at least
    # total / (seats + n): so much above its base
    most = F.least(F.col("_left"), F.ceil(F.col(weight) * (F.col(seats) + F.col("_n")) / total + 1.5) - F.col("_base"))
    known = known.withColumn("_most", F.greatest(most, F.lit(1)))
    tries = known.where((F.col(weight) > 0) & (F.col("_left") > 0)).select(*within, key, weight, "_left", F.explode(F.sequence(F.col("_base"), F.col("_base") + F.col("_most") - 1)).alias("_s"))
    order = Window.partitionBy(*within).orderBy((F.col(weight) / (2 * F.col("_s") + 1)).desc(), F.col(key).asc_nulls_last(), "_s")
    won = tries.withColumn("_rank", F.row_number().over(order)).where("_rank <= _left").groupBy(*within, key).agg(F.count("*").alias("_won"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*within, key)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return known.alias("a").join(won.alias("b"), on, "left").select("a.*", (F.col("_base") + F.coalesce("_won", F.lit(0))).alias("quota")).drop("_n", "_divisor", "_base", "_left", "_most")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """``sizes(source, source_size)`` -> also ``weight`` and ``target``. Sources in code point order, null last, get the
    weights in turn. A source is full if the level that the others reach, by weight, is above its limit; limits are met in
    order of limit by weight, so one running sum finds the level."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    out = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (rank % len(weights) + 1).cast("int")))
    out = out.withColumn("_limit", repeats * F.col("source_size")).withColumn("_full_at", F.col("_limit") / F.col("weight"))
    order, every = Window.orderBy("_full_at", F.col("source").asc_nulls_last()), Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    wanted = share * F.sum("source_size").over(every)
    rest = wanted - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    level = rest / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    out = out.withColumn("_level", F.when(level <= F.col("_full_at"), level))
    out = out.withColumn("_level", F.first("_level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("_level").isNull() | (F.col("_full_at") < F.col("_level")), F.col("_limit")).otherwise(F.col("weight") * F.col("_level"))
    return out.withColumn("target", target).drop("_limit", "_full_at", "_level")


def _draw(seed: int, *cols: Column | str) -> Column:
    """The seeded order of rows, 32 hexadecimal digits, the same in every engine."""
    return F.md5(F.concat_ws("|", *(F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols), F.lit(str(seed))))


def _number(draw: Column) -> Column:
    """A draw's first 48 bits as a long."""
    return F.conv(F.substring(draw, 1, 12), 16, 10).cast("long")


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2, seed: int = 7, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """``docs(doc_id, source, text)`` -> ``doc_id, source, size, source_size, target, taken``.

    ``size``: words of the whole text (null: 0), however long; ``taken``: words that the mix takes of the document, at most
    ``repeats`` times its size. A document without words is taken 0 times. Rows that repeat a doc_id are separate documents
    that lie side by side in their shard, the shorter first; of rows equal in both, which one has which place is open, and
    the result holds the same rows either way. Null sources form one source, the last; a null doc_id is drawn as an empty
    one. An empty table gives an empty result; other columns are ignored.
    """
    sized = cut(docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")))
    sources = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats))
    wanted = F.sum("target").over(Window.partitionBy())
    dealt = apportion(sources.withColumn("_all", F.lit(0)).withColumn("_seats", F.floor(wanted / block).cast("long")), ["_all"], "source", "target", "_seats")
    # a number for each source, never null, so that later keys are plain equalities
    dealt = dealt.withColumn("_src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    dealt = cut(dealt.withColumnRenamed("quota", "_blocks").withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard)).cast("long")).drop("_all", "_seats"))
    # a shard's parent: at most FANOUT for each source, each of at most shards / FANOUT children
    placed = sized.join(F.broadcast(dealt) if dealt.count() <= 10_000 else dealt, sized["source"].eqNullSafe(dealt["source"])).drop(dealt["source"])
    placed = placed.withColumn("_shard", _number(_draw(seed, "doc_id")) % F.col("_shards")).withColumn("_parent", F.col("_shard") % FANOUT)
    shards = cut(placed.groupBy("_src", "_parent", "_shard").agg(F.sum("size").alias("_words"), F.first("_blocks").alias("_blocks"), F.first("source").alias("source")))
    parents = shards.groupBy("_src", "_parent").agg(F.sum("_words").cast("double").alias("_votes"), F.first("_blocks").alias("_blocks"))
    parents = apportion(parents, ["_src"], "_parent", "_votes", "_blocks").select("_src", "_parent", F.col("quota").alias("_seats"))
    below = shards.join(parents, ["_src", "_parent"]).withColumn("_votes", F.col("_words").cast("double"))
    quotas = cut(apportion(below, ["_src", "_parent"], "_shard", "_votes", "_seats").select("_src", "_shard", F.col("source").alias("_name"), "_words", "quota"))
    # whole passes over the shard, then some of its blocks
    due = F.col("quota") * block
    passes = F.least(F.lit(repeats), F.floor(due / F.greatest(F.col("_words"), F.lit(1)))).cast("long")
    n_blocks = F.ceil(F.col("_words") / block).cast("long")
    extra = F.when(passes >= repeats, F.lit(0)).otherwise(F.least(n_blocks, F.round((due - passes * F.col("_words")) / block))).cast("long")
    drawn = F.array_sort(F.transform(F.sequence(F.lit(0).cast("long"), n_blocks - 1), lambda b: F.struct(_draw(seed + 1, "_name", "_shard", b).alias("h"), b.alias("b"))))
    chosen = F.transform(F.slice(drawn, 1, extra.cast("int")), lambda x: x["b"])
    quotas = quotas.select("_src", "_shard", passes.alias("_passes"), F.when((extra > 0) & (n_blocks > 0), chosen).otherwise(F.array().cast("array<bigint>")).alias("_chosen"))
    line = Window.partitionBy("_src", "_shard").orderBy(_draw(seed + 2, "doc_id"), "doc_id", "size")
    laid = placed.withColumn("_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_start", F.col("_end") - F.col("size"))
    # shards grow with the words: they meet their documents where the window has put these, and are never broadcast
    laid = laid.join(quotas.hint("merge"), ["_src", "_shard"])
    first, last = F.floor(F.col("_start") / block), F.floor((F.col("_end") - 1) / block)
    mine = F.filter("_chosen", lambda b: (b >= first) & (b <= last))
    part = F.aggregate(mine, F.lit(0).cast("long"), lambda acc, b: acc + F.least(F.col("_end"), (b + 1) * block) - F.greatest(F.col("_start"), b * block))
    taken = F.when(F.col("size") > 0, F.col("_passes") * F.col("size") + part).otherwise(F.lit(0)).cast("long")
    return laid.select("doc_id", "source", "size", F.col("source_size"), F.col("target").cast("double").alias("target"), taken.alias("taken"))


def mixed(docs: DataFrame, *, seed: int = 7, **params) -> DataFrame:
    """The mix as rows of ``docs``: each document as often as the words taken of it hold its size, what is left over being
    one more copy with that probability (seeded), so that a source's words stay near its target with whole documents.

    Documents taken 0 times and those without words are left out. Rows that repeat a doc_id share one decision, by the words
    taken of all of them.
    """
    taken = mix(docs, seed=seed, **params).where("size > 0").groupBy("doc_id").agg((F.sum("taken") / F.sum("size")).alias("_times"))
    chance = (_number(_draw(seed + 3, "doc_id")) % 1_000_000) / 1_000_000
    copies = taken.select(F.col("doc_id").alias("_id"), (F.floor("_times") + (F.col("_times") - F.floor("_times") > chance).cast("int")).cast("int").alias("_copies")).where("_copies > 0")
    # rows travel whole under one name, so that no column of theirs clashes with others
    rows = docs.where(word_count(F.col("text")) > 0).select(F.struct("*").alias("row"), F.col("doc_id").alias("_doc"))
    both = rows.join(copies, F.col("_doc").eqNullSafe(F.col("_id")))
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")
