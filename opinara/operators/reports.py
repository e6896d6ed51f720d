"""Roll-ups of the labelled table, of cells and of logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.sources.logs import shared_folder

#: Groups that are told to all tasks, once counted; more are joined by shuffle.
FEW_GROUPS = 50_000
AREA = "opportunity_area"
STANCES = ("pre_purchase", "at_purchase", "post_purchase", "unclear")


def stance_resolution_report(df: DataFrame) -> DataFrame:
    """For each source: rows, rows moved by the surface and their part, and both stances' counts by name."""
    counts = [F.count_if(F.col(c) == s).alias(f"{name}_{s}") for c, name in (("temporal_stance", "raw"), ("temporal_stance_resolved", "resolved")) for s in STANCES]
    out = df.groupBy("source").agg(F.count("*").alias("n"), F.count_if("stance_resolved_by_surface").alias("n_moved"), *counts)
    return out.withColumn("share_moved", F.col("n_moved") / F.col("n"))


def exact_medians(df: DataFrame, by: tuple[str, ...], value: str, bracket_rows: int = 100_000, around: float = 0.02) -> DataFrame:
    """``by, median`` of a column, exactly, nulls and NaN left out, without a task that holds a group's values.

    While a group's bracket has more than ``bracket_rows`` rows, sketches, merged from parts, narrow it to what lies about
    its middle; the rows below and within are counted, and a bracket that misses the middle is not taken but tried wider.
    Then the values of each bracket are counted and ordered. The table of groups, as they are reported, is told to all
    tasks if it is small.
    """
    spark = df.sparkSession
    rows = df.select(F.struct(*by).alias("g"), F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)")

    def kept(brackets: DataFrame) -> DataFrame:
        path = shared_folder(spark)
        brackets.write.parquet(path)
        return spark.read.schema(brackets.schema).parquet(path)

    def with_brackets(brackets: DataFrame) -> DataFrame:
        side = brackets.select(F.col("g").alias("_g"), "n", "low", "high", "below", "held")
        side = F.broadcast(side) if side.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS else side
        return rows.join(side, F.col("g").eqNullSafe(F.col("_g")) & F.col("v").between(F.col("low"), F.col("high"))).drop("_g")

    rank = lambda up: F.floor((F.col("n") - (0 if up else 1)) / 2)
    first = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    brackets = kept(first.select("*", F.lit(0).cast("long").alias("below"), F.col("n").alias("held"), F.lit(around).alias("around"), F.lit(False).alias("done")))
    wide = (F.col("held") > bracket_rows) & (F.col("low") < F.col("high")) & ~F.col("done")
    while not brackets.where(wide).isEmpty():
        inside = with_brackets(brackets.where(wide))
        drawn = inside.groupBy("g").agg(F.kll_sketch_agg_double("v", F.lit(800)).alias("sketch")).select(F.col("g").alias("_g"), "sketch")
        both = brackets.where(wide).join(drawn, F.col("g").eqNullSafe(F.col("_g"))).drop("_g")
        # the sketch is asked for hundredths, as it takes fixed ranks only; the bracket's ends are rounded away from the middle
        share = lambda up: (rank(up) - F.col("below")) / F.col("held")
        low = F.get("grid", F.greatest(F.lit(0), F.floor(100 * (share(False) - F.col("around")))).cast("int"))
        high = F.get("grid", F.least(F.lit(100), F.ceil(100 * (share(True) + F.col("around")))).cast("int"))
        grid = F.kll_sketch_get_quantile_double("sketch", F.array(*(F.lit(k / 100) for k in range(101))))
        narrow = kept(both.withColumn("grid", grid).select(F.col("g").alias("_g"), low.alias("_low"), high.alias("_high")))
        few = F.broadcast(narrow) if narrow.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS else narrow
        told = inside.join(few, F.col("g").eqNullSafe(F.col("_g"))).groupBy("g", "_low", "_high").agg(F.count_if(F.col("v") < F.col("_low")).alias("_under"), F.count_if(F.col("v").between(F.col("_low"), F.col("_high"))).alias("_held"))
        both = brackets.join(told.withColumnRenamed("g", "_g"), F.col("g").eqNullSafe(F.col("_g")), "left").drop("_g")
        hit = (F.col("below") + F.col("_under") <= rank(False)) & (rank(True) < F.col("below") + F.col("_under") + F.col("_held"))
        take = F.coalesce(hit & (F.col("_held") < F.col("held")), F.lit(False))
        brackets = kept(both.select(
            "g", "n", F.when(take, F.col("_low")).otherwise(F.col("low")).alias("low"), F.when(take, F.col("_high")).otherwise(F.col("high")).alias("high"),
            F.when(take, F.col("below") + F.col("_under")).otherwise(F.col("below")).alias("below"), F.when(take, F.col("_held")).otherwise(F.col("held")).alias("held"),
            F.when(take, F.lit(around)).otherwise(F.col("around") * 4).alias("around"),
            # few values hold nearly all rows, or the bracket is all there is: no narrower one will do
            (F.col("done") | (F.col("_held").isNotNull() & ~take & (F.col("around") > 0.5))).alias("done"),
        ))
    values = with_brackets(brackets).groupBy("g", "n", "below", "v").agg(F.count("*").alias("c"))
    upto = F.col("below") + F.sum("c").over(Window.partitionBy("g").orderBy("v"))
    placed = values.withColumn("upto", upto)
    middle = lambda up: F.max(F.when((rank(up) < F.col("upto")) & (rank(up) >= F.col("upto") - F.col("c")), F.col("v")))
    return placed.groupBy("g").agg(((middle(False) + middle(True)) / 2).alias("median")).select("g.*", "median")


def ledger_summary(ledger: DataFrame, by: tuple[str, ...] = ("lane", "provider", "model"), approximate: bool = False) -> DataFrame:
    """Calls, good calls, tokens, median latency (exact unless ``approximate``) and waiting time of each group."""
    aggregates = [
        F.count("*").alias("calls"), F.count_if(F.col("outcome") == "ok").alias("ok"), F.sum(F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0))).alias("tokens"),
        *([F.percentile_approx("latency_s", 0.5).alias("median_latency_s")] if approximate else []), F.sum("rate_limit_wait_s").alias("wait_s"),
    ]
    sums = ledger.groupBy(*by).agg(*aggregates)
    if approximate:
        return sums
    medians = exact_medians(ledger, by, "latency_s").select(F.struct(*by).alias("_g"), F.col("median").alias("median_latency_s"))
    both = sums.join(medians, F.struct(*by).eqNullSafe(F.col("_g")), "left")
    return both.select(*by, "calls", "ok", "tokens", "median_latency_s", "wait_s")


def quota_status(ledger: DataFrame, lanes: DataFrame, as_of: Column) -> DataFrame:
    """For each lane of ``lanes(lane, offset_hours, cap_calls, cap_tokens)``: what is used since its local midnight and left."""
    local = lambda t: t + F.make_dt_interval(hours=F.col("offset_hours"))
    used = ledger.join(F.broadcast(lanes), "lane").where((F.col("outcome") == "ok") & (local(F.col("at")) >= F.date_trunc("day", local(as_of))) & (F.col("at") <= as_of))
    used = used.groupBy("lane").agg(F.count("*").alias("_c"), F.sum(F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0))).alias("_t"))
    out = lanes.join(used, "lane", "left").withColumns({"used_calls": F.coalesce("_c", F.lit(0)), "used_tokens": F.coalesce("_t", F.lit(0))})
    left = lambda cap, use: F.greatest(F.lit(0), F.col(cap) - F.col(use))
    return out.select("lane", "used_calls", "used_tokens", left("cap_calls", "used_calls").alias("left_calls"), left("cap_tokens", "used_tokens").alias("left_tokens"))


def overview_kpis(cells: DataFrame, reliability: DataFrame | None = None) -> DataFrame:
    pre = F.sum(F.when(F.col("temporal_stance") == "pre_purchase", F.col("n_area")).otherwise(0))
    out = cells.agg(F.sum("n_area").alias("n"), pre.alias("n_pre"), F.count_distinct("source").alias("n_sources"), F.count("gate_reason").alias("n_gated"))
    out = out.withColumn("share_pre", F.col("n_pre") / F.col("n"))
    return out if reliability is None else out.join(reliability.agg(F.min("kappa").alias("weakest_kappa")))  # two single rows


def stance_composition(cells: DataFrame) -> DataFrame:
    """Counts of each area by stance, their parts of the area, by falling part before purchase."""
    out = cells.groupBy(AREA).pivot("temporal_stance", list(STANCES)).sum("n_area").na.fill(0)
    total = sum((F.col(s) for s in STANCES), F.lit(0))
    out = out.withColumn("total", total).withColumns({f"share_{s}": F.col(s) / F.col("total") for s in STANCES})
    return out.orderBy(F.desc("share_pre_purchase"), AREA)


def prevalence_vs_concentration(cells: DataFrame) -> DataFrame:
    """Area totals, part before purchase, mean of the cells' severity (none counts 1), and both axes' medians."""
    pre = F.sum(F.when(F.col("temporal_stance") == "pre_purchase", F.col("n_area")).otherwise(0))
    out = cells.groupBy(AREA).agg(F.sum("n_area").alias("total"), (pre / F.sum("n_area")).alias("share_pre"), F.avg(F.coalesce("severity_mean", F.lit(1.0))).alias("severity"))
    middle = out.agg(F.median("total").alias("median_total"), F.median("share_pre").alias("median_share"))
    return out.join(F.broadcast(middle))  # one row


def source_counts(cells: DataFrame, sources: DataFrame) -> DataFrame:
    dim = F.broadcast(sources.select("source", F.col("denominator_eligible").alias("carries_rate")))
    return cells.groupBy("source").agg(F.sum("n_area").alias("n")).join(dim, "source", "left")


def counts_of(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def language_mix(df: DataFrame, source: str) -> DataFrame:
    return counts_of(df, "language", F.col("source") == source)


def gate_reason_counts(cells: DataFrame) -> DataFrame:
    return counts_of(cells, "gate_reason", F.col("gate_reason").isNotNull())


def reliability_table(parts: dict[str, DataFrame]) -> DataFrame:
    """Several agreements as one long table."""
    rows = [df.select(F.lit(name).alias("comparison"), "field", "n", "kappa", "kappa_band", "ci_low", "ci_high", "ac1", "ac1_band", "kappa_paradox") for name, df in parts.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def collection_stats(df: DataFrame) -> DataFrame:
    from opinara.functions.times import span_days

    out = df.groupBy("source", "brand").agg(F.count("*").alias("emitted"), F.max("posted_at").alias("newest"), F.min("posted_at").alias("oldest"))
    return out.withColumn("span_days", span_days(F.col("oldest"), F.col("newest")))


def require_collected(stats: DataFrame, expected: DataFrame) -> DataFrame:
    lost = expected.join(stats, ["source", "brand"], "left_anti").limit(5).collect()
    if lost:
        raise ValueError(f"nothing was collected for {[tuple(r) for r in lost]}")
    return stats


def evidence_search(df: DataFrame, *, area: str | None = None, stance: str | None = None, source: str | None = None, min_severity: int | None = None, query: str | None = None) -> DataFrame:
    """Conjunctive filters on evidence; a missing severity counts 1; the query is a pattern without regard to case."""
    for column, value in ((AREA, area), ("temporal_stance", stance), ("source", source)):
        if value is not None:
            df = df.where(F.col(column) == value)
    if min_severity is not None:
        df = df.where(F.coalesce("severity", F.lit(1)) >= min_severity)
    if query:
        df = df.where(F.col("evidence_quote").rlike(f"(?i){query}"))
    return df.orderBy(F.desc_nulls_last("severity"), F.desc_nulls_last("confidence"), "utterance_id")


def gated_split(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    return cells.where("gate_reason is null"), cells.where("gate_reason is not null")


def format_proportion(p: Column, low: Column, high: Column, n: Column, gate: Column) -> Column:
    """``rate% [low–high] n=``; the gate where there is no number."""
    shown = F.format_string("%.1f%% [%.1f–%.1f] n=%d", p * 100, low * 100, high * 100, n.cast("long"))
    return F.when(gate.isNotNull(), gate).when(p.isNull(), "no data").otherwise(shown)


def format_ratio(ratio: Column, p: Column, n1: Column, n2: Column, gate: Column) -> Column:
    shown = F.format_string("%.2fx (p=%.3f, n=%d vs %d)", ratio, p, n1.cast("long"), n2.cast("long"))
    return F.when(gate.isNotNull(), gate).when(ratio.isNull(), "no data").when(p.isNull(), F.format_string("%.2fx (n=%d vs %d)", ratio, n1.cast("long"), n2.cast("long"))).otherwise(shown)


#: Rating bands.
RATING_BANDS = [(3.0, "3.0-3.9"), (4.0, "4.0-4.4"), (4.5, ">=4.5")]


def order_index(df: DataFrame) -> DataFrame:
    return df.orderBy("source", "temporal_stance", F.desc_nulls_last("oi"), AREA)


def emit_index(cells: DataFrame, comparisons: DataFrame) -> DataFrame:
    """The index with its comparison beside, in order."""
    beside = comparisons.select("source", "temporal_stance", AREA, "ratio", "difference", "p", "n_focal", "n_pool", "significant_at_alpha")
    return order_index(cells.join(beside, ["source", "temporal_stance", AREA], "left"))


def never_observed(areas: DataFrame, cells: DataFrame) -> DataFrame:
    """Areas of strong or moderate detectability without any row."""
    return areas.where(F.col("detectability").isin("strong", "moderate")).join(cells.select(AREA).distinct(), AREA, "left_anti")


def blind_spots(areas: DataFrame, cells: DataFrame, sources: DataFrame) -> DataFrame:
    """``section, item, detail``: gated areas, areas never observed, sources without a rate, and gates by number of rows."""
    row = lambda df, section, item, detail: df.select(F.lit(section).alias("section"), item.cast("string").alias("item"), detail.cast("string").alias("detail"))
    gated = areas.where(F.col("detectability").isin("weak", "none") | (F.col("addressability") == 0))
    parts = [
        row(gated, "gated", F.col(AREA), F.col("detectability")),
        row(never_observed(areas, cells), "absent", F.col(AREA), F.col("detectability")),
        row(sources.where(~F.col("denominator_eligible")), "ineligible source", F.col("source"), F.lit("no denominator")),
        row(gate_reason_counts(cells), "gate", F.col("gate_reason"), F.col("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def opportunity_map(cells: DataFrame, areas: DataFrame, source: str, stance: str, brand: str) -> DataFrame:
    """One cell's areas with names, the interval's arms and the formatted rate, by falling index."""
    one = cells.where((F.col("source") == source) & (F.col("temporal_stance") == stance) & (F.col("brand") == brand))
    named = one.join(F.broadcast(areas.select(AREA, "name")), AREA, "left")
    arms = {"arm_low": F.col("proportion") - F.col("ci_low"), "arm_high": F.col("ci_high") - F.col("proportion")}
    cell = format_proportion(F.col("proportion"), F.col("ci_low"), F.col("ci_high"), F.col("n_cell"), F.col("gate_reason"))
    return named.withColumns({**arms, "cell": cell}).orderBy(F.desc_nulls_last("oi"), AREA)


def differential_view(comparisons: DataFrame, areas: DataFrame, source: str, stance: str) -> DataFrame:
    """One surface's comparisons with names and formatted ratio, by falling difference."""
    one = comparisons.where((F.col("source") == source) & (F.col("temporal_stance") == stance)).join(F.broadcast(areas.select(AREA, "name")), AREA, "left")
    cell = format_ratio(F.col("ratio"), F.col("p"), F.col("n_focal"), F.col("n_pool"), F.col("gate_reason"))
    return one.withColumn("cell", cell).orderBy(F.desc_nulls_last("difference"), AREA)
