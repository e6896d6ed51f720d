"""Cells of source, brand, stance and area: counts, rates with intervals, gates, the index and brand comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.stats import gate_reason, opportunity, two_proportion_z, wilson
from opinara.functions.times import span_days

CELL = ("source", "brand", "temporal_stance")
AREA = "opportunity_area"
BELOW_MIN = "cell below minimum n"


def resolve_stance(df: DataFrame, sources: DataFrame) -> DataFrame:
    """``temporal_stance_resolved``: unclear becomes post_purchase where the surface implies it; ``stance_resolved_by_surface``."""
    flags = F.broadcast(sources.select(F.col("source").alias("_s"), "surface_implies_post_purchase"))
    out = df.join(flags, F.col("source") == F.col("_s"), "left")
    moved = (F.col("temporal_stance") == "unclear") & F.coalesce("surface_implies_post_purchase", F.lit(False))
    return out.withColumns({"temporal_stance_resolved": F.when(moved, "post_purchase").otherwise(F.col("temporal_stance")), "stance_resolved_by_surface": F.coalesce(moved, F.lit(False))}).drop("_s", "surface_implies_post_purchase")


def look_up(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """``df`` with the columns of a code list, whose size is fixed, null where the code is unknown; no row is lost."""
    return df.join(F.broadcast(dimension), key, "left")


def denominator_eligible(df: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of eligible sources, rows left out by source)."""
    allowed = F.broadcast(sources.where("denominator_eligible").select("source"))
    return df.join(allowed, "source", "left_semi"), df.join(allowed, "source", "left_anti").groupBy("source").agg(F.count("*").alias("n_excluded"))


def cell_counts(df: DataFrame, keys: tuple[str, ...] = CELL, *, severity: str | None = None, dense: DataFrame | None = None) -> DataFrame:
    """``keys, area, n_area, n_cell[, severity_mean]`` in one aggregation: n_cell is the sum of a cell's areas, null area
    included. ``dense``, a table of areas, adds areas that a cell does not have, with 0. Denominators never mix sources or
    stances, so both must be keys."""
    for must in ("source", "temporal_stance"):
        if must not in keys:
            raise ValueError(f"{must} must be among the keys")
    sums = [F.sum(severity).alias("_sev"), F.count(severity).alias("_nsev")] if severity else []
    grouped = df.groupBy(*keys, AREA).agg(F.count("*").alias("n_area"), *sums)
    # a window over aggregated rows: as many per cell as there are areas
    out = grouped.withColumn("n_cell", F.sum("n_area").over(Window.partitionBy(*keys))).where(F.col(AREA).isNotNull())
    if severity:
        out = out.withColumn("severity_mean", F.col("_sev") / F.col("_nsev")).drop("_sev", "_nsev")
    if dense is not None:
        cells = df.groupBy(*keys).agg(F.count("*").alias("_n"))
        full = cells.join(F.broadcast(dense.select(AREA)), how="cross")  # a code list of a fixed size
        out = full.join(out, [*keys, AREA], "left").withColumns({"n_area": F.coalesce("n_area", F.lit(0)), "n_cell": F.col("_n")}).drop("_n")
    return out


def aggregate(df: DataFrame, areas: DataFrame, *, stance: str = "temporal_stance", alpha: float = 0.05, min_cell: int | None = None, gate_scope: str = "all", reference: tuple[str, str] | None = None, with_severity: bool = False, dense: bool = False) -> DataFrame:
    """The full index table. ``gate_scope='all'`` gives a gated area no number at all; ``'index'`` only no index."""
    rows = df.withColumn("temporal_stance", F.col(stance)) if stance != "temporal_stance" else df
    dim = F.broadcast(areas)
    out = cell_counts(rows, severity="severity", dense=areas if dense else None).join(dim, AREA, "left")
    low, high = wilson(F.col("n_area"), F.col("n_cell"), alpha)
    out = out.withColumns({"proportion": F.col("n_area") / F.col("n_cell"), "ci_low": low, "ci_high": high, "gate_reason": gate_reason(F.col(AREA), F.col("detectability"), F.col("proximity_weight"), F.col("addressability"))})
    out = out.withColumn("oi", opportunity(F.col("proportion"), F.col("proximity_weight"), F.col("addressability"), F.col("gate_reason"), F.col("severity_mean") if with_severity else None))
    out = out.withColumn("oi_includes_severity", F.lit(with_severity))
    if reference:
        out = out.withColumn("is_reference_cell", (F.col("source") == reference[0]) & (F.col("temporal_stance") == reference[1]))
    if min_cell is not None:
        out = min_cell_gate(out, min_cell)
    if gate_scope == "all":
        out = out.withColumns({c: F.when(F.col("gate_reason").isNull(), F.col(c)) for c in ("proportion", "ci_low", "ci_high")})
    return out


def min_cell_gate(df: DataFrame, least: int) -> DataFrame:
    """Cells below ``least`` keep their counts and lose rate, interval and index."""
    small = F.col("n_cell") < least
    out = df.withColumn("below_min_cell", small).withColumns({c: F.when(~small, F.col(c)) for c in ("proportion", "ci_low", "ci_high", "oi")})
    return out.withColumn("gate_reason", F.when(small & F.col("gate_reason").isNull(), BELOW_MIN).otherwise(F.col("gate_reason")))


# ---- windows and comparisons --------------------------------------------------------------------


def observed_windows(df: DataFrame, most_unknown: float = 0.05) -> DataFrame:
    """``source, brand, span_days, n_rows, unknown_rate, too_many_unknown`` of ``posted_at`` timestamps."""
    out = df.groupBy("source", "brand").agg(F.min("posted_at").alias("_a"), F.max("posted_at").alias("_b"), F.count("*").alias("n_rows"), F.count_if(F.col("posted_at").isNull()).alias("_u"))
    rate = F.col("_u") / F.col("n_rows")
    return out.select("source", "brand", span_days(F.col("_a"), F.col("_b")).alias("span_days"), "n_rows", rate.alias("unknown_rate"), (rate > most_unknown).alias("too_many_unknown"))


def require_known_times(windows: DataFrame) -> DataFrame:
    bad = windows.where("too_many_unknown").select("source", "brand").take(5)
    if bad:
        raise ValueError(f"too many unknown times: {[tuple(r) for r in bad]}")
    return windows


def window_compliant(windows: DataFrame, focal: str, tolerance: float) -> DataFrame:
    """``source, brand, compliant, reason``: spans within the tolerance of the focal brand's; all pass without a focal."""
    base = F.broadcast(windows.where(F.col("brand") == focal).select(F.col("source").alias("_s"), F.col("span_days").alias("_focal")))
    out = windows.join(base, F.col("source") == F.col("_s"), "left")
    good = F.coalesce(F.abs(F.col("span_days") - F.col("_focal")) <= tolerance, F.lit(True))
    return out.select("source", "brand", good.alias("compliant"), F.when(~good, F.format_string("window %.2f d against %.2f d", "span_days", "_focal")).alias("reason"))


def window_parity(windows: DataFrame, tolerance: float, ceiling: str | None = None) -> DataFrame:
    """``source, spread_days, warn``: spans of a source's brands that differ too much, or a brand that hit its ceiling."""
    hit = F.bool_or(F.col(ceiling)) if ceiling else F.lit(False)
    out = windows.groupBy("source").agg((F.max("span_days") - F.min("span_days")).alias("spread_days"), F.count("span_days").alias("_n"), hit.alias("_hit"))
    return out.select("source", "spread_days", ((F.col("_n") > 1) & ((F.col("spread_days") > tolerance) | F.col("_hit"))).alias("warn"))


def check_matched(sources: DataFrame, names: list[str]) -> None:
    """Sources of different matched groups are not compared."""
    groups = [r[0] for r in sources.where(F.col("source").isin(names)).select("structurally_matched_group").distinct().limit(3).collect()]
    if len(groups) > 1:
        raise ValueError(f"sources of different matched groups: {groups}")


def compare_focal_to_pool(cells: DataFrame, focal: str, *, compliant: DataFrame | None = None, alpha: float = 0.05) -> DataFrame:
    """Focal brand against the pooled others for each source, stance and area, in one conditional aggregation.

    ``cells`` has n_area, n_cell and gate_reason. The focal brand is never in its pool; brands that ``compliant`` marks as
    not compliant are named but not pooled. Gated areas get no ratio, difference or verdict.
    """
    rows = cells
    if compliant is not None:
        rows = rows.join(F.broadcast(compliant.select("source", "brand", "compliant")), ["source", "brand"], "left")
    ok = F.coalesce("compliant", F.lit(True)) if compliant is not None else F.lit(True)
    mine, pool = F.col("brand") == focal, (F.col("brand") != focal) & ok
    pick = lambda c, which: F.sum(F.when(which, F.col(c)))
    brands = lambda which: F.array_sort(F.collect_set(F.when(which, F.col("brand"))))
    out = rows.groupBy("source", "temporal_stance", AREA).agg(
        pick("n_area", mine).alias("x_focal"), pick("n_cell", mine).alias("n_focal"), pick("n_area", pool).alias("x_pool"), pick("n_cell", pool).alias("n_pool"),
        brands(pool).alias("pool_brands"), brands((F.col("brand") != focal) & ~ok).alias("pool_excluded_for_window"), F.max("gate_reason").alias("gate_reason"),
    ).where("x_focal is not null and x_pool is not null")
    z, p = two_proportion_z(F.col("x_focal"), F.col("n_focal"), F.col("x_pool"), F.col("n_pool"))
    out = out.withColumns({"p_focal": F.col("x_focal") / F.col("n_focal"), "p_pool": F.col("x_pool") / F.col("n_pool"), "z": z, "p": p, "alpha": F.lit(alpha)})
    free = F.col("gate_reason").isNull()
    return out.withColumns(
        {
            "ratio": F.when(free, F.col("p_focal") / F.nullif("p_pool", F.lit(0.0))),
            "difference": F.when(free, F.col("p_focal") - F.col("p_pool")),
            "significant_at_alpha": F.when(free, F.coalesce(F.col("p") < alpha, F.lit(False))),
        }
    )


# ---- rankings -------------------------------------------------------------------------------------


def weight_sensitivity(index: DataFrame, top: int = 3) -> DataFrame:
    """For each source and stance, the leading areas as weighed and with all weights 1, and whether they differ."""
    free = index.where("gate_reason is null and proportion is not null")
    cell = Window.partitionBy("source", "brand", "temporal_stance")
    flat = F.col("proportion") * F.col("addressability")
    ranked = free.withColumns({"_w": F.row_number().over(cell.orderBy(F.desc_nulls_last("oi"), AREA)), "_f": F.row_number().over(cell.orderBy(flat.desc_nulls_last(), F.col(AREA)))})
    lead = lambda r: F.transform(F.array_sort(F.collect_list(F.when(F.col(r) <= top, F.struct(F.col(r).alias("r"), F.col(AREA).alias("a"))))), lambda x: x["a"])
    out = ranked.groupBy("source", "brand", "temporal_stance").agg(lead("_w").alias("weighted"), lead("_f").alias("unweighted"))
    return out.withColumn("changes", F.col("weighted") != F.col("unweighted"))


def robustness_rank(areas: DataFrame, reference: str) -> DataFrame:
    """``source, area, rank, reference_rank, flips`` of each source's areas by count against the reference source."""
    totals = areas.where(F.col(AREA).isNotNull()).groupBy("source", AREA).agg(F.sum("n_area").alias("n"))
    ranked = totals.withColumn("rank", F.rank().over(Window.partitionBy("source").orderBy(F.desc("n"))))
    ref = ranked.where(F.col("source") == reference).select(F.col(AREA).alias("_a"), F.col("rank").alias("reference_rank"))
    return ranked.where(F.col("source") != reference).join(ref, F.col(AREA) == F.col("_a")).select("source", AREA, "rank", "reference_rank", (F.col("rank") != F.col("reference_rank")).alias("flips"))


def trend_eligibility(df: DataFrame, cutoff: float | None) -> DataFrame:
    """``source, null_rate, eligible``: a source may carry a trend if its rate of unknown times is low; no cutoff, no trend."""
    out = df.groupBy("source").agg((F.count_if(F.col("posted_at").isNull()) / F.count("*")).alias("null_rate"))
    return out.withColumn("eligible", F.lit(False) if cutoff is None else F.col("null_rate") <= cutoff)
