"""Queries on cells, windows, comparisons, samples and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import stats
from opinara.functions.times import in_window
from opinara.operators import quantify as Q
from opinara.operators import sampling

from .registry import query
from .views import table, view, with_views

Z = stats.z_of(0.05)
RD = lambda df, *names: df.withColumns({n: F.round(n, 9) for n in names})

ELIGIBLE = "resolved AS (SELECT l.*, CASE WHEN temporal_stance = 'unclear' AND surface_implies_post_purchase THEN 'post_purchase' ELSE temporal_stance END AS stance, temporal_stance = 'unclear' AND surface_implies_post_purchase AS moved FROM labelled l LEFT JOIN sources s USING (source)), eligible AS (SELECT r.* FROM resolved r JOIN sources s USING (source) WHERE s.denominator_eligible)"
CELLS = "cells AS (SELECT source, brand, stance AS temporal_stance, opportunity_area, count(*) AS n_area, CAST(sum(count(*)) OVER (PARTITION BY source, brand, stance) AS BIGINT) AS n_cell, avg(severity) AS severity_mean FROM eligible GROUP BY source, brand, stance, opportunity_area)"
GATE = "CASE WHEN opportunity_area = 'none' THEN NULL WHEN detectability IN ('weak', 'none') THEN 'detectability ' || detectability WHEN detectability IS NULL THEN 'not present in taxonomy' WHEN proximity_weight IS NULL THEN 'no proximity weight' WHEN addressability = 0 THEN 'not addressable' END"
NUMBERS = f"""numbers AS (SELECT *, n_area / n_cell AS p_, (n_area / n_cell + {Z * Z} / (2 * n_cell)) / (1 + {Z * Z} / n_cell) AS mid,
    {Z} * sqrt((n_area / n_cell) * (1 - n_area / n_cell) / n_cell + {Z * Z} / (4.0 * n_cell * n_cell)) / (1 + {Z * Z} / n_cell) AS half, {GATE} AS gate_reason FROM cells LEFT JOIN areas USING (opportunity_area))"""
INDEX = with_views("labelled", "sources", "areas") + f", {ELIGIBLE}, {CELLS}, {NUMBERS}"
INDEX += ", index_ AS (SELECT source, brand, temporal_stance, opportunity_area, n_area, n_cell, severity_mean, detectability, addressability, proximity_weight, gate_reason, CASE WHEN gate_reason IS NULL THEN p_ END AS proportion, CASE WHEN gate_reason IS NULL THEN greatest(mid - half, 0) END AS ci_low, CASE WHEN gate_reason IS NULL THEN least(mid + half, 1) END AS ci_high, CASE WHEN gate_reason IS NULL THEN p_ * proximity_weight * addressability END AS oi FROM numbers)"


def resolved(spark, d):
    return Q.resolve_stance(view(spark, d, "labelled"), view(spark, d, "sources"))


def eligible(spark, d):
    return Q.denominator_eligible(resolved(spark, d), view(spark, d, "sources"))[0]


def index(spark, d, **how):
    return Q.aggregate(eligible(spark, d), view(spark, d, "areas"), stance="temporal_stance_resolved", **how)


SHOW = ("source", "brand", "temporal_stance", "opportunity_area", "n_area", "n_cell", "proportion", "ci_low", "ci_high", "oi", "gate_reason")
SHOWN = "SELECT source, brand, temporal_stance, opportunity_area, n_area, n_cell, round(proportion, 9) AS proportion, round(ci_low, 9) AS ci_low, round(ci_high, 9) AS ci_high, round(oi, 9) AS oi, gate_reason FROM index_"
NUMERIC = ("proportion", "ci_low", "ci_high", "oi")


@query("a07_cell_counts", with_views("labelled") + "SELECT source, brand, temporal_stance, opportunity_area, count(*) AS n_area, CAST(sum(count(*)) OVER (PARTITION BY source, brand, temporal_stance) AS BIGINT) AS n_cell FROM labelled GROUP BY source, brand, temporal_stance, opportunity_area")
def a07(spark, d):
    return Q.cell_counts(view(spark, d, "labelled"))


@query("j01_cell_counts_dense", with_views("labelled", "areas") + "SELECT c.source, c.brand, c.temporal_stance, a.opportunity_area, c.n AS n_cell, count(l.utterance_id) AS n_area FROM (SELECT source, brand, temporal_stance, count(*) AS n FROM labelled GROUP BY ALL) c CROSS JOIN areas a LEFT JOIN labelled l ON l.source = c.source AND l.brand = c.brand AND l.temporal_stance = c.temporal_stance AND l.opportunity_area = a.opportunity_area GROUP BY ALL")
def j01(spark, d):
    return Q.cell_counts(view(spark, d, "labelled"), dense=view(spark, d, "areas"))


@query("a09_j04_severity_mean", with_views("labelled") + "SELECT source, brand, temporal_stance, opportunity_area, round(avg(severity), 9) AS severity_mean FROM labelled GROUP BY ALL")
def a09(spark, d):
    out = Q.cell_counts(view(spark, d, "labelled"), severity="severity")
    return RD(out, "severity_mean").select("source", "brand", "temporal_stance", "opportunity_area", "severity_mean")


@query("a10_a11_a12_index", INDEX + SHOWN)
def a10(spark, d):
    return RD(index(spark, d), *NUMERIC).select(*SHOW)


@query("a11_index_gate_scope", INDEX.replace("CASE WHEN gate_reason IS NULL THEN p_ END", "p_").replace("CASE WHEN gate_reason IS NULL THEN greatest(mid - half, 0) END", "greatest(mid - half, 0)").replace("CASE WHEN gate_reason IS NULL THEN least(mid + half, 1) END", "least(mid + half, 1)") + SHOWN)
def a11(spark, d):
    return RD(index(spark, d, gate_scope="index"), *NUMERIC).select(*SHOW)


SMALL = "CASE WHEN n_cell >= 12 THEN %s END"


@query("a13_min_cell_gate", INDEX + "SELECT source, brand, temporal_stance, opportunity_area, n_area, n_cell, round(CASE WHEN n_cell >= 12 THEN proportion END, 9) AS proportion, round(CASE WHEN n_cell >= 12 THEN oi END, 9) AS oi, n_cell < 12 AS below_min_cell, CASE WHEN n_cell < 12 AND gate_reason IS NULL THEN 'cell below minimum n' ELSE gate_reason END AS gate_reason FROM index_")
def a13(spark, d):
    out = index(spark, d, min_cell=12)
    return RD(out, "proportion", "oi").select("source", "brand", "temporal_stance", "opportunity_area", "n_area", "n_cell", "proportion", "oi", "below_min_cell", "gate_reason")


@query("a14_reference_cell", INDEX + "SELECT source, temporal_stance, opportunity_area, brand, source = 'play' AND temporal_stance = 'pre_purchase' AS is_reference_cell FROM index_")
def a14(spark, d):
    return index(spark, d, reference=("play", "pre_purchase")).select("source", "temporal_stance", "opportunity_area", "brand", "is_reference_cell")


@query("j02_area_lookup", with_views("labelled", "areas") + "SELECT utterance_id, name, detectability, proximity_weight FROM labelled LEFT JOIN areas USING (opportunity_area)")
def j02(spark, d):
    return Q.look_up(view(spark, d, "labelled"), view(spark, d, "areas"), "opportunity_area").select("utterance_id", "name", "detectability", "proximity_weight")


@query("j03_source_lookup", with_views("labelled", "sources") + "SELECT utterance_id, denominator_eligible, structurally_matched_group FROM labelled LEFT JOIN sources USING (source)")
def j03(spark, d):
    return Q.look_up(view(spark, d, "labelled"), view(spark, d, "sources"), "source").select("utterance_id", "denominator_eligible", "structurally_matched_group")


@query("p05_excluded_sources", with_views("labelled", "sources") + "SELECT source, count(*) AS n_excluded FROM labelled JOIN sources USING (source) WHERE NOT denominator_eligible GROUP BY source")
def p05(spark, d):
    return Q.denominator_eligible(view(spark, d, "labelled"), view(spark, d, "sources"))[1]


@query("p06_resolve_stance", with_views("labelled", "sources") + f", {ELIGIBLE} SELECT utterance_id, stance AS temporal_stance_resolved, moved AS stance_resolved_by_surface FROM resolved")
def p06(spark, d):
    return resolved(spark, d).select("utterance_id", "temporal_stance_resolved", "stance_resolved_by_surface")


@query("p01_in_window", with_views("event_cells") + "SELECT event_id FROM event_cells WHERE posted_at IS NULL OR posted_at >= (SELECT max(ts) FROM events) - INTERVAL 10 DAYS")
def p01(spark, d):
    last = table(spark, d, "events").agg(F.max("ts").alias("_last"))
    return view(spark, d, "event_cells").join(F.broadcast(last)).where(in_window(F.col("posted_at"), F.col("_last"), 10)).select("event_id")


# ---- windows and comparisons ---------------------------------------------------------------------

WINDOWS = "w AS (SELECT source, brand, (epoch_us(max(posted_at)) - epoch_us(min(posted_at))) / 86400e6 AS span_days, count(*) AS n_rows, count(*) FILTER (WHERE posted_at IS NULL) / count(*) AS unknown_rate FROM event_cells GROUP BY source, brand)"
COMPLIANT = WINDOWS + ", f AS (SELECT source, span_days AS focal FROM w WHERE brand = 'b0'), c AS (SELECT w.source, brand, coalesce(abs(span_days - focal) <= 3, true) AS compliant FROM w LEFT JOIN f USING (source))"


def windows(spark, d):
    return Q.observed_windows(view(spark, d, "event_cells"))


@query("a15_f17_observed_windows", with_views("event_cells") + f", {WINDOWS} SELECT source, brand, round(span_days, 9) AS span_days, n_rows, round(unknown_rate, 9) AS unknown_rate, unknown_rate > 0.05 AS too_many_unknown FROM w")
def a15(spark, d):
    return RD(windows(spark, d), "span_days", "unknown_rate")


@query("a16_window_compliant", with_views("event_cells") + f", {COMPLIANT} SELECT source, brand, compliant FROM c")
def a16(spark, d):
    return Q.window_compliant(windows(spark, d), "b0", 3.0).select("source", "brand", "compliant")


@query("j14_compliant_rows", with_views("event_cells") + f", {COMPLIANT} SELECT event_id FROM event_cells JOIN c USING (source, brand) WHERE compliant")
def j14(spark, d):
    ok = Q.window_compliant(windows(spark, d), "b0", 3.0).where("compliant")
    return view(spark, d, "event_cells").join(ok, ["source", "brand"], "left_semi").select("event_id")


@query("a17_window_parity", with_views("event_cells") + f", {WINDOWS} SELECT source, round(max(span_days) - min(span_days), 9) AS spread_days, count(*) > 1 AND max(span_days) - min(span_days) > 3 AS warn FROM w GROUP BY source")
def a17(spark, d):
    return RD(Q.window_parity(windows(spark, d), 3.0), "spread_days")


def _erfc_sql(x: str) -> str:
    t, fit = f"(1 / (1 + ({x}) / 2))", str(stats._ERFC[-1])
    for c in reversed(stats._ERFC[:-1]):
        fit = f"({fit} * {t} + {c})"
    return f"({t} * exp(-({x}) * ({x}) + {fit}))"


EVENT_CELLS = "g AS (SELECT source, brand, temporal_stance, opportunity_area, count(*) AS n_area, CAST(sum(count(*)) OVER (PARTITION BY source, brand, temporal_stance) AS BIGINT) AS n_cell FROM event_cells GROUP BY source, brand, temporal_stance, opportunity_area)"
COMPARED = with_views("event_cells") + f""", {COMPLIANT}, {EVENT_CELLS}, s AS (SELECT source, temporal_stance, opportunity_area,
    CAST(sum(n_area) FILTER (WHERE brand = 'b0') AS BIGINT) AS x_focal, CAST(sum(n_cell) FILTER (WHERE brand = 'b0') AS BIGINT) AS n_focal,
    CAST(sum(n_area) FILTER (WHERE brand <> 'b0' AND compliant) AS BIGINT) AS x_pool, CAST(sum(n_cell) FILTER (WHERE brand <> 'b0' AND compliant) AS BIGINT) AS n_pool,
    coalesce(string_agg(brand, ',' ORDER BY brand) FILTER (WHERE brand <> 'b0' AND compliant), '') AS pool, coalesce(string_agg(brand, ',' ORDER BY brand) FILTER (WHERE NOT compliant), '') AS excluded
    FROM g JOIN c USING (source, brand) GROUP BY ALL), q AS (SELECT *, (x_focal + x_pool) / (n_focal + n_pool) AS pooled FROM s WHERE x_focal IS NOT NULL AND x_pool IS NOT NULL),
    z AS (SELECT *, (x_focal / n_focal - x_pool / n_pool) / nullif(sqrt(pooled * (1 - pooled) * (1 / n_focal + 1 / n_pool)), 0) AS z FROM q)
    SELECT source, temporal_stance, opportunity_area, x_focal, n_focal, x_pool, n_pool, pool, excluded, round((x_focal / n_focal) / nullif(x_pool / n_pool, 0), 9) AS ratio, round(x_focal / n_focal - x_pool / n_pool, 9) AS difference,
    round(z, 9) AS z, round({_erfc_sql('abs(z) / sqrt(2)')}, 9) AS p, coalesce({_erfc_sql('abs(z) / sqrt(2)')} < 0.05, false) AS significant_at_alpha FROM z"""


def compared(spark, d):
    cells = Q.cell_counts(view(spark, d, "event_cells")).withColumn("gate_reason", F.lit(None).cast("string"))
    return Q.compare_focal_to_pool(cells, "b0", compliant=Q.window_compliant(windows(spark, d), "b0", 3.0))


@query("a19_compare_focal_to_pool", COMPARED)
def a19(spark, d):
    out = compared(spark, d).withColumns({"pool": F.array_join("pool_brands", ","), "excluded": F.array_join("pool_excluded_for_window", ",")})
    out = RD(out, "ratio", "difference", "z", "p")
    return out.select("source", "temporal_stance", "opportunity_area", "x_focal", "n_focal", "x_pool", "n_pool", "pool", "excluded", "ratio", "difference", "z", "p", "significant_at_alpha")


@query("a18_f24_two_proportion_z", with_views("labelled") + f"""SELECT a.source AS source, round(z, 9) AS z, round({_erfc_sql('abs(z) / sqrt(2)')}, 9) AS p FROM (SELECT source, (count(*) FILTER (WHERE toxic = 1) / count(*) - count(*) FILTER (WHERE quality = 1) / count(*)) /
    nullif(sqrt(((count(*) FILTER (WHERE toxic = 1) + count(*) FILTER (WHERE quality = 1)) / (2 * count(*))) * (1 - (count(*) FILTER (WHERE toxic = 1) + count(*) FILTER (WHERE quality = 1)) / (2 * count(*))) * (2 / count(*))), 0) AS z FROM labelled GROUP BY source) a""")
def a18(spark, d):
    rows = view(spark, d, "labelled").groupBy("source").agg(F.sum("toxic").alias("x1"), F.sum("quality").alias("x2"), F.count("*").alias("n"))
    z, p = stats.two_proportion_z(F.col("x1"), F.col("n"), F.col("x2"), F.col("n"))
    return rows.select("source", F.round(z, 9).alias("z"), F.round(p, 9).alias("p"))


@query("a33_sample_size", with_views("labelled") + f"SELECT source, CAST(ceil({Z**2} * p * (1 - p) / pow(CAST(0.1 AS DOUBLE) / 2, 2)) AS BIGINT) AS n FROM (SELECT source, count(*) FILTER (WHERE quality = 1) / count(*) AS p FROM labelled GROUP BY source) x")
def a33(spark, d):
    rows = view(spark, d, "labelled").groupBy("source").agg((F.sum("quality") / F.count("*")).alias("p"))
    return rows.select("source", stats.sample_size(F.col("p"), F.lit(0.1)).alias("n"))


@query("p11_rating_bands", "SELECT event_id, CASE WHEN value IS NULL THEN NULL WHEN value >= 4.5 THEN '>=4.5' WHEN value >= 4.0 THEN '4.0-4.4' WHEN value >= 3.0 THEN '3.0-3.9' ELSE '<3.0' END AS band FROM events")
def p11(spark, d):
    from opinara.operators.reports import RATING_BANDS

    return table(spark, d, "events").select("event_id", stats.band(F.col("value"), RATING_BANDS, "<3.0").alias("band"))


@query("a46_weight_sensitivity", INDEX + """, f AS (SELECT *, row_number() OVER (PARTITION BY source, brand, temporal_stance ORDER BY oi DESC NULLS LAST, opportunity_area) AS w, row_number() OVER (PARTITION BY source, brand, temporal_stance ORDER BY proportion * addressability DESC NULLS LAST, opportunity_area) AS u FROM index_ WHERE gate_reason IS NULL AND proportion IS NOT NULL)
    SELECT source, brand, temporal_stance, string_agg(opportunity_area, ',' ORDER BY w) FILTER (WHERE w <= 3) AS weighted, string_agg(opportunity_area, ',' ORDER BY u) FILTER (WHERE u <= 3) AS unweighted,
    string_agg(opportunity_area, ',' ORDER BY w) FILTER (WHERE w <= 3) <> string_agg(opportunity_area, ',' ORDER BY u) FILTER (WHERE u <= 3) AS changes FROM f GROUP BY ALL""")
def a46(spark, d):
    out = Q.weight_sensitivity(index(spark, d))
    return out.withColumns({"weighted": F.array_join("weighted", ","), "unweighted": F.array_join("unweighted", ",")})


@query("a47_robustness_rank", INDEX + ", t AS (SELECT source, opportunity_area, sum(n_area) AS n FROM index_ GROUP BY ALL), k AS (SELECT *, rank() OVER (PARTITION BY source ORDER BY n DESC) AS r FROM t) SELECT a.source, a.opportunity_area, CAST(a.r AS INT) AS rank, CAST(b.r AS INT) AS reference_rank, a.r <> b.r AS flips FROM k a JOIN k b USING (opportunity_area) WHERE a.source <> 'play' AND b.source = 'play'")
def a47(spark, d):
    return Q.robustness_rank(index(spark, d), "play")


@query("a48_trend_eligibility", with_views("event_cells") + "SELECT source, round(count(*) FILTER (WHERE posted_at IS NULL) / count(*), 9) AS null_rate, count(*) FILTER (WHERE posted_at IS NULL) / count(*) <= 0.05 AS eligible FROM event_cells GROUP BY source")
def a48(spark, d):
    return RD(Q.trend_eligibility(view(spark, d, "event_cells"), 0.05), "null_rate")


# ---- samples --------------------------------------------------------------------------------------

DRAW = "md5(concat_ws('|', CAST(utterance_id AS STRING), '%d'))"
SAMPLED = f"sampled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, brand ORDER BY {DRAW % 7}, utterance_id) AS k FROM labelled) x WHERE k <= 15)"


def sampled(spark, d):
    return sampling.sample_per_cell(view(spark, d, "labelled"), 15, 7)


@query("w01_sample_per_cell", with_views("labelled") + f", {SAMPLED} SELECT utterance_id FROM sampled")
def w01(spark, d):
    return sampled(spark, d).select("utterance_id")


@query("a06_sample_report", with_views("labelled") + f", {SAMPLED} SELECT l.source, l.brand, count(*) AS available, count(s.utterance_id) AS sampled, round(count(s.utterance_id) / count(*), 9) AS fraction, count(*) <= 15 AS censused FROM labelled l LEFT JOIN sampled s USING (utterance_id) GROUP BY l.source, l.brand")
def a06(spark, d):
    return RD(sampling.sample_report(view(spark, d, "labelled"), sampled(spark, d), 15), "fraction")


STRATA = f"strata AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, brand ORDER BY {DRAW % 3}, utterance_id) AS k FROM labelled) x WHERE k <= greatest(1, 60 // (SELECT count(*) FROM (SELECT DISTINCT source, brand FROM labelled) y)))"


@query("w03_stratified_sample", with_views("labelled") + f", {STRATA} SELECT utterance_id FROM strata")
def w03(spark, d):
    return sampling.stratified_sample(view(spark, d, "labelled"), ("source", "brand"), 60, 3).select("utterance_id")


@query("w04_j16_blind_sheet", with_views("labelled") + f", {STRATA}, b AS (SELECT l.*, s.utterance_id IS NULL AS later FROM labelled l LEFT JOIN strata s USING (utterance_id)) SELECT utterance_id, '' AS severity FROM b ORDER BY later, {DRAW % 4}, utterance_id LIMIT 60")
def w04(spark, d):
    return sampling.blind_sheet(view(spark, d, "labelled"), 60, 3).select("utterance_id", "severity")


@query("w05_disagreement_sheet", with_views("labelled") + f""", f AS (SELECT *, quality <> toxic AS differs FROM labelled), n AS (SELECT differs, count(*) AS n FROM f GROUP BY differs),
    r AS (SELECT *, row_number() OVER (PARTITION BY differs ORDER BY {DRAW % 5}, utterance_id) AS k FROM f), w AS (SELECT *, least(n, CASE WHEN differs THEN 30 ELSE 10 END) AS m FROM n)
    SELECT utterance_id, CASE WHEN differs THEN 'disagree' ELSE 'agree' END AS stratum, round((w.n / (SELECT sum(n) FROM n)) / (w.m / (SELECT sum(m) FROM w)), 9) AS sampling_weight FROM r JOIN w USING (differs) WHERE k <= CASE WHEN differs THEN 30 ELSE 10 END""")
def w05(spark, d):
    rows = view(spark, d, "labelled").withColumn("differs", F.col("quality") != F.col("toxic"))
    return RD(sampling.disagreement_sheet(rows, "differs", 40, 3.0, 5), "sampling_weight").select("utterance_id", "stratum", "sampling_weight")


@query("w06_product_frame", "SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (PARTITION BY p_type, CASE WHEN p_size >= 25 THEN 1 ELSE 0 END, CASE WHEN p_retailprice >= 1000 THEN 1 ELSE 0 END ORDER BY md5(concat_ws('|', CAST(p_partkey AS STRING), '2')), p_partkey) AS k FROM part) x WHERE k <= 3")
def w06(spark, d):
    part = table(spark, d, "part").withColumn("category", F.col("p_type"))
    return sampling.product_frame(part, F.when(F.col("p_size") >= 25, 1).otherwise(0), F.when(F.col("p_retailprice") >= 1000, 1).otherwise(0), 3, 2, "p_partkey").select("p_partkey")


@query("w08_top_k_verbatims", with_views("labelled") + "SELECT * FROM (SELECT opportunity_area, temporal_stance, utterance_id, CAST(row_number() OVER (PARTITION BY opportunity_area, temporal_stance ORDER BY severity DESC NULLS LAST, confidence DESC NULLS LAST, utterance_id) AS INT) AS rank, count(*) OVER (PARTITION BY opportunity_area, temporal_stance) AS n_group FROM labelled) x WHERE rank <= 3")
def w08(spark, d):
    return sampling.top_k_verbatims(view(spark, d, "labelled")).select("opportunity_area", "temporal_stance", "utterance_id", "rank", "n_group")


@query("w10_batch_rows", with_views("labelled") + "SELECT utterance_id, n // 20 AS batch_no, concat(substr(sha1(CAST(min(utterance_id) OVER (PARTITION BY n // 20) AS STRING)), 1, 12), '_20') AS batch_id FROM (SELECT utterance_id, row_number() OVER (ORDER BY utterance_id) - 1 AS n FROM labelled) x")
def w10(spark, d):
    return sampling.batch_rows(view(spark, d, "labelled").select("utterance_id"), 20, "utterance_id").select("utterance_id", "batch_no", "batch_id")


@query("w11_rolling_usage", with_views("ledger") + """, l AS (SELECT *, CASE WHEN event_id % 50 <> 3 THEN CAST(epoch_us(called_at) AS BIGINT) END AS u FROM ledger),
    x AS (SELECT event_id, u, count(*) OVER w AS calls, sum(coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0)) OVER w AS tokens FROM l WHERE u IS NOT NULL WINDOW w AS (PARTITION BY lane ORDER BY u RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW))
    SELECT event_id, calls, CAST(tokens AS BIGINT) AS tokens, calls > 3 OR tokens > 100 AS over_limit FROM l LEFT JOIN x USING (event_id)""")
def w11(spark, d):
    """Some calls have no time."""
    ledger = view(spark, d, "ledger").withColumn("at", F.when(F.col("event_id") % 50 != 3, F.col("called_at").cast("timestamp")))
    return sampling.rolling_usage(ledger, 3, 100, 3600).select("event_id", "calls", "tokens", "over_limit")


@query("w12_j12_escalation_tail", with_views("labelled") + "SELECT utterance_id, confidence FROM labelled WHERE confidence < 0.3 AND utterance_id % 4 <> 0")
def w12(spark, d):
    rows = view(spark, d, "labelled")
    return sampling.escalation_tail(rows, 0.3, rows.where("utterance_id % 4 = 0")).select("utterance_id", "confidence")


@query("p08_paginate", with_views("labelled") + "SELECT utterance_id FROM labelled ORDER BY confidence DESC, utterance_id LIMIT 25 OFFSET 25")
def p08(spark, d):
    return sampling.paginate(view(spark, d, "labelled"), 2, 25, (F.desc("confidence"), F.asc("utterance_id"))).select("utterance_id")


@query("w07_dedupe_first", with_views("lane_a") + "SELECT utterance_id, opportunity_area FROM lane_a WHERE labelled_at = 0")
def w07(spark, d):
    return sampling.dedupe_first(view(spark, d, "lane_a"), "utterance_id", ("labelled_at",)).select("utterance_id", "opportunity_area")
