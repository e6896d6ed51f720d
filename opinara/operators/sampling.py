"""Seeded samples, sheets, batches, top rows and pages. Equal input and seed give equal rows on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.sources.logs import shared_folder

#: Parts of a cell from which the least draws are taken first.
SALTS = 64


def draw(seed: int, *keys: str) -> Column:
    """The seeded order of rows. MD5 is slow to guess and the same in every engine."""
    return F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys), F.lit(str(seed))))


def least_drawn(df: DataFrame, k: int, seed: int, cell: tuple[str, ...], id: str, salts: int = SALTS) -> DataFrame:
    """The k rows of least draw of each cell with their place ``_rank``, nulls being a cell too.

    A cell may be nearly all rows, so the k least are taken of each of ``salts`` parts of a cell first, then of those that
    are left, at most k * salts rows; where k is small, Spark cuts parts before it moves them.
    """
    order = lambda *part: Window.partitionBy(*cell, *part).orderBy("_draw", id)
    drawn = df.withColumns({"_draw": draw(seed, id), "_salt": F.pmod(F.xxhash64(F.col(id), F.lit(seed)), F.lit(salts))})
    part = drawn.withColumn("_rank", F.row_number().over(order("_salt"))).where(F.col("_rank") <= k).drop("_rank")
    return part.withColumn("_rank", F.row_number().over(order())).where(F.col("_rank") <= k).drop("_draw", "_salt")


def sample_per_cell(df: DataFrame, target: int, seed: int, cell: tuple[str, ...] = ("source", "brand"), id: str = "utterance_id") -> DataFrame:
    """Exactly ``target`` rows of each cell, or the whole cell if it is smaller."""
    return least_drawn(df, target, seed, cell, id).select(*df.columns)


def sample_report(df: DataFrame, sampled: DataFrame, target: int, cell: tuple[str, ...] = ("source", "brand")) -> DataFrame:
    """Rows there are and rows sampled of each cell, nulls being a cell too."""
    both = df.select(*cell, F.lit(0).alias("_s")).unionByName(sampled.select(*cell, F.lit(1).alias("_s"))).groupBy(*cell)
    out = both.agg(F.count_if(F.col("_s") == 0).alias("available"), F.count_if(F.col("_s") == 1).alias("sampled")).where("available > 0")
    return out.select(*cell, "available", "sampled", (F.col("sampled") / F.col("available")).alias("fraction"), (F.col("available") <= target).alias("censused"))


def stratified_sample(df: DataFrame, keys: tuple[str, ...], total: int, seed: int, id: str = "utterance_id") -> DataFrame:
    """``max(1, total // strata)`` rows of each stratum, all of a smaller one."""
    quota = df.select(*keys).distinct().agg(F.greatest(F.lit(1), F.floor(F.lit(total) / F.greatest(F.count("*"), F.lit(1)))).alias("_quota"))
    ranked = least_drawn(df, total, seed, keys, id)
    return ranked.join(F.broadcast(quota)).where("_rank <= _quota").select(*df.columns)  # one row


def blind_sheet(df: DataFrame, n: int, seed: int, keys: tuple[str, ...] = ("source", "brand"), shown: tuple[str, ...] = ("utterance_id", "source", "brand", "utterance_text"), blanks: tuple[str, ...] = ("opportunity_area", "temporal_stance", "severity", "hesitation_marker", "labeller_note")) -> DataFrame:
    """A stratified sample, topped up to n from the rest, with blank label columns and none of the model's."""
    picked = stratified_sample(df, keys, n, seed)
    rest = df.join(picked.select("utterance_id"), "utterance_id", "left_anti").withColumn("_later", F.lit(1))
    both = picked.withColumn("_later", F.lit(0)).unionByName(rest)
    rows = both.orderBy("_later", draw(seed + 1, "utterance_id"), "utterance_id").limit(n)
    return rows.select(*shown, *(F.lit("").alias(b) for b in blanks))


def disagreement_sheet(df: DataFrame, flag: str, n: int, factor: float, seed: int, id: str = "utterance_id") -> DataFrame:
    """n rows with the disagreeing ones oversampled ``factor`` to one; ``sampling_weight`` is share of all by share drawn."""
    of_bad = int(n * factor / (1 + factor))
    sizes = df.groupBy(flag).agg(F.count("*").alias("_n")).withColumnRenamed(flag, "_f")
    # a literal limit for each side leaves no task more rows to sort out than it asks for
    side = lambda bad, k: df.where(F.col(flag) == bad).orderBy(draw(seed, id), id).limit(k).withColumn("_want", F.lit(k))
    ranked = side(True, of_bad).unionByName(side(False, n - of_bad)).join(F.broadcast(sizes), F.col(flag) == F.col("_f"))
    total = df.agg(F.count("*").alias("_total"))
    drawn = F.least(F.col("_n"), F.col("_want"))
    taken = sizes.agg(F.sum(F.least("_n", F.when(F.col("_f"), of_bad).otherwise(n - of_bad))).alias("_taken"))
    out = ranked.join(F.broadcast(total)).join(F.broadcast(taken))
    return out.withColumn("sampling_weight", (F.col("_n") / F.col("_total")) / (drawn / F.col("_taken"))).withColumn("stratum", F.when(F.col(flag), "disagree").otherwise("agree")).select(*df.columns, "stratum", "sampling_weight")


def product_frame(df: DataFrame, rating: Column, reviews: Column, per_stratum: int, seed: int, id: str) -> DataFrame:
    """So many products of each category, rating band and review-count band."""
    bands = df.withColumns({"rating_band": rating, "count_band": reviews})
    return least_drawn(bands, per_stratum, seed, ("category", "rating_band", "count_band"), id).drop("_rank")


def dedupe_first(df: DataFrame, id: str, order: tuple[str, ...]) -> DataFrame:
    """The first row of each id by a partial aggregate; the table itself is left alone."""
    first = df.groupBy(id).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r"))
    return first.select("r.*")


def top_k_verbatims(df: DataFrame, k: int = 3, stance: str = "temporal_stance") -> DataFrame:
    """The k strongest quotes of each area and stance, and how many there are."""
    cell = Window.partitionBy("opportunity_area", stance)
    order = cell.orderBy(F.desc_nulls_last("severity"), F.desc_nulls_last("confidence"), "utterance_id")
    sizes = df.groupBy("opportunity_area", stance).agg(F.count("*").alias("n_group")).select(F.col("opportunity_area").alias("_a"), F.col(stance).alias("_s"), "n_group")
    top = df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(F.broadcast(sizes), F.col("opportunity_area").eqNullSafe(F.col("_a")) & F.col(stance).eqNullSafe(F.col("_s"))).drop("_a", "_s")


def batch_rows(df: DataFrame, size: int, id: str, cell: tuple[str, ...] = (), lane_rows: int = 100_000) -> DataFrame:
    """Consecutive batches of ``size`` in order of id, with ``batch_no`` and ``batch_id``, named by the first id and size.

    A table of more than ``lane_rows`` rows is written in ranges of about so many; the counts of the ranges give each one's
    first place, so rows are numbered within their range and a batch may go on from one range into the next.
    """
    ranges = -(-df.count() // lane_rows)
    if ranges > 1:
        path = shared_folder(df.sparkSession)
        dealt = df.repartitionByRange(ranges, *cell, id).withColumn("_range", F.spark_partition_id())
        dealt.write.parquet(path)
        df = df.sparkSession.read.schema(dealt.schema).parquet(path)
    else:
        df = df.withColumn("_range", F.lit(0))
    earlier = Window.partitionBy(*cell).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    first_places = df.groupBy(*cell, "_range").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    first_places = first_places.select(F.col("_range").alias("_r"), "_before", *(F.col(c).alias(f"_r{c}") for c in cell))
    place = F.row_number().over(Window.partitionBy(*cell, "_range").orderBy(id)) - 1
    alike = F.col("_range") == F.col("_r")
    for c in cell:
        alike &= F.col(c).eqNullSafe(F.col(f"_r{c}"))
    out = df.withColumn("_place", place).join(first_places, alike)
    out = out.withColumn("batch_no", F.floor((F.col("_place") + F.col("_before")) / size))
    first = F.min(id).over(Window.partitionBy(*cell, "batch_no"))
    batch_id = F.concat(F.substring(F.sha1(first.cast("string")), 1, 12), F.lit(f"_{size}"))
    return out.withColumn("batch_id", batch_id).drop("_range", "_r", "_before", "_place", *(f"_r{c}" for c in cell))


def rolling_usage(ledger: DataFrame, rpm: int, tpm: int, seconds: int = 60) -> DataFrame:
    """Calls and tokens of a lane in the trailing minute at each call, itself included, and whether they are over a limit.

    Times count to the microsecond: a call sees those before it and those of its own microsecond, and none that is
    ``seconds`` old. A call without a time stays, with nulls. A call comes at its time and goes ``seconds`` later, so what is
    there is a running sum, whose work does not grow with the calls of a window. Time is cut into stretches of 8 windows, and
    calls of a stretch's last window are lent to the next: no task holds a lane, and nothing is joined back.
    """
    width, stretch = seconds * 1_000_000, 8 * seconds * 1_000_000
    spent = F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0))
    timed = ledger.select("lane", F.unix_micros("at").alias("_u"), spent.alias("_t"), F.struct(*ledger.columns).alias("_row"))
    u, in_stretch = F.col("_u"), lambda t: F.floor(t / stretch)
    own, later, goes = in_stretch(u), in_stretch(u + width - 1), in_stretch(u + width)
    mark = lambda part, at, n, mine: F.struct(part.alias("part"), at.alias("at"), F.lit(n).alias("n"), F.lit(mine).alias("own"))
    # calls without a time see none; they are dealt by their hash, as they may be many
    apart = mark(F.pmod(F.xxhash64("lane", F.monotonically_increasing_id()), F.lit(1 << 16)), u, 0, True)
    # a call that goes as a stretch begins is not lent to it
    lent, gone = F.when(later != own, mark(later, u, 1, False)), F.when(goes == later, mark(goes, u + width, -1, False))
    marks = F.when(u.isNull(), F.array(apart)).otherwise(F.array_compact(F.array(mark(own, u, 1, True), lent, gone)))
    dealt = timed.withColumn("_m", F.explode(marks)).select("lane", "_t", "_m.*", F.when(F.col("_m.own"), F.col("_row")).alias("_row"))
    w = Window.partitionBy("lane", F.col("at").isNull(), "part").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    known = lambda c: F.when(F.col("at").isNotNull(), F.sum(c).over(w))
    out = dealt.withColumns({"_calls": known(F.col("n").cast("long")), "_tokens": known(F.col("n") * F.col("_t"))}).where("own")
    out = out.select("_row.*", F.col("_calls").alias("calls"), F.col("_tokens").alias("tokens"))
    return out.withColumn("over_limit", (F.col("calls") > rpm) | (F.col("tokens") > tpm))


def escalation_tail(df: DataFrame, tau: float, done: DataFrame | None = None, id: str = "utterance_id") -> DataFrame:
    """Rows of low confidence that were not escalated yet, least sure first."""
    rows = df.where(F.col("confidence") < tau)
    if done is not None:
        rows = rows.join(done.select(id), id, "left_anti")
    return rows.orderBy("confidence", id)


def paginate(df: DataFrame, page: int, size: int = 25, order: tuple[Column, ...] = ()) -> DataFrame:
    """A page of a report; it is a top-k, so no more than page * size rows leave a task."""
    return df.orderBy(*order).offset((page - 1) * size).limit(size)
