"""Queries on reports and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.operators import quantify as Q
from opinara.operators import reports as R

from .batch_queries import COMPARED, ELIGIBLE, INDEX, compared, index, resolved
from .registry import query
from .views import table, view, with_views

RD = lambda df, *names: df.withColumns({n: F.round(n, 9) for n in names})
AREA = "opportunity_area"


def ledger(spark, d):
    return view(spark, d, "ledger").withColumn("at", F.col("called_at").cast("timestamp")).drop("called_at")


@query("a34_stance_resolution_report", with_views("labelled", "sources") + f", {ELIGIBLE} SELECT source, count(*) AS n, count(*) FILTER (WHERE moved) AS n_moved, round(count(*) FILTER (WHERE moved) / count(*), 9) AS share_moved, count(*) FILTER (WHERE temporal_stance = 'unclear') AS raw_unclear, count(*) FILTER (WHERE stance = 'post_purchase') AS resolved_post_purchase FROM resolved GROUP BY source")
def a34(spark, d):
    return RD(R.stance_resolution_report(resolved(spark, d)), "share_moved").select("source", "n", "n_moved", "share_moved", "raw_unclear", "resolved_post_purchase")


@query("a35_ledger_summary", with_views("ledger") + "SELECT lane, count(*) AS calls, count(*) FILTER (WHERE outcome = 'ok') AS ok, CAST(sum(coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0)) AS BIGINT) AS tokens, round(median(latency_s), 6) AS median_latency_s, round(sum(rate_limit_wait_s), 3) AS wait_s FROM ledger GROUP BY lane")
def a35(spark, d):
    out = R.ledger_summary(ledger(spark, d)).select("lane", "calls", "ok", "tokens", "median_latency_s", "wait_s")
    return out.withColumns({"median_latency_s": F.round("median_latency_s", 6), "wait_s": F.round("wait_s", 3)})


LANES = [("A", 5, 500, 10_000), ("B", -8, 100, 20_000), ("C", 0, 300, 200_000)]


@query("a36_quota_status", with_views("ledger") + """, q AS (SELECT * FROM (VALUES ('A', 5, 500, 10000), ('B', -8, 100, 20000), ('C', 0, 300, 200000)) t(lane, h, cap_calls, cap_tokens)), now_ AS (SELECT max(ts) AS t FROM events),
    u AS (SELECT lane, count(*) AS c, sum(coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0)) AS k FROM ledger JOIN q USING (lane), now_ WHERE outcome = 'ok' AND called_at + h * INTERVAL 1 HOUR >= date_trunc('day', t + h * INTERVAL 1 HOUR) GROUP BY lane)
    SELECT lane, coalesce(c, 0) AS used_calls, CAST(coalesce(k, 0) AS BIGINT) AS used_tokens, greatest(0, cap_calls - coalesce(c, 0)) AS left_calls, CAST(greatest(0, cap_tokens - coalesce(k, 0)) AS BIGINT) AS left_tokens FROM q LEFT JOIN u USING (lane)""")
def a36(spark, d):
    last = table(spark, d, "events").agg(F.max("ts").cast("timestamp").alias("t")).first()[0]
    return R.quota_status(ledger(spark, d), spark.createDataFrame(LANES, "lane string, offset_hours int, cap_calls long, cap_tokens long"), F.lit(last))


@query("a37_overview_kpis", INDEX + "SELECT CAST(sum(n_area) AS BIGINT) AS n, CAST(coalesce(sum(n_area) FILTER (WHERE temporal_stance = 'pre_purchase'), 0) AS BIGINT) AS n_pre, count(DISTINCT source) AS n_sources, count(gate_reason) AS n_gated, round(coalesce(sum(n_area) FILTER (WHERE temporal_stance = 'pre_purchase'), 0) / sum(n_area), 9) AS share_pre FROM index_")
def a37(spark, d):
    return RD(R.overview_kpis(index(spark, d)), "share_pre")


PIVOT = ", ".join(f"CAST(coalesce(sum(n_area) FILTER (WHERE temporal_stance = '{s}'), 0) AS BIGINT) AS {s}" for s in R.STANCES)


@query("a38_stance_composition", INDEX + f"SELECT opportunity_area, {PIVOT}, CAST(sum(n_area) AS BIGINT) AS total, round(coalesce(sum(n_area) FILTER (WHERE temporal_stance = 'pre_purchase'), 0) / sum(n_area), 9) AS share_pre_purchase FROM index_ GROUP BY opportunity_area")
def a38(spark, d):
    return RD(R.stance_composition(index(spark, d)), "share_pre_purchase").select(AREA, *R.STANCES, "total", "share_pre_purchase")


@query("a39_prevalence_vs_concentration", INDEX + ", g AS (SELECT opportunity_area, sum(n_area) AS total, coalesce(sum(n_area) FILTER (WHERE temporal_stance = 'pre_purchase'), 0) / sum(n_area) AS share_pre, avg(coalesce(severity_mean, 1)) AS severity FROM index_ GROUP BY opportunity_area) SELECT opportunity_area, CAST(total AS BIGINT) AS total, round(share_pre, 9) AS share_pre, round(severity, 9) AS severity, round((SELECT median(total) FROM g), 9) AS median_total, round((SELECT median(share_pre) FROM g), 9) AS median_share FROM g")
def a39(spark, d):
    return RD(R.prevalence_vs_concentration(index(spark, d)), "share_pre", "severity", "median_total", "median_share")


@query("a40_source_counts", with_views("labelled", "sources") + "SELECT source, count(*) AS n, denominator_eligible AS carries_rate FROM labelled JOIN sources USING (source) GROUP BY ALL")
def a40(spark, d):
    return R.source_counts(Q.cell_counts(view(spark, d, "labelled")), view(spark, d, "sources"))


@query("a41_language_mix", "SELECT lang AS language, count(*) AS n FROM documents WHERE source = 'src3' GROUP BY lang")
def a41(spark, d):
    return R.language_mix(table(spark, d, "documents").withColumnRenamed("lang", "language"), "src3")


@query("a42_gate_reason_counts", INDEX + "SELECT gate_reason, count(*) AS n FROM index_ WHERE gate_reason IS NOT NULL GROUP BY gate_reason")
def a42(spark, d):
    return R.gate_reason_counts(index(spark, d))


@query("a45_collection_stats", with_views("event_cells") + "SELECT source, brand, count(*) AS emitted, max(posted_at) AS newest, min(posted_at) AS oldest, round((epoch_us(max(posted_at)) - epoch_us(min(posted_at))) / 86400e6, 9) AS span_days FROM event_cells GROUP BY source, brand")
def a45(spark, d):
    return RD(R.collection_stats(view(spark, d, "event_cells")), "span_days")


@query("p07_evidence_search", with_views("labelled") + "SELECT utterance_id FROM labelled WHERE source = 'play' AND coalesce(severity, 1) >= 2 AND regexp_matches(evidence_quote, '(?i)the')")
def p07(spark, d):
    return R.evidence_search(view(spark, d, "labelled"), source="play", min_severity=2, query="the").select("utterance_id")


@query("p09_gated_split", INDEX + "SELECT gate_reason IS NULL AS free, count(*) AS n FROM index_ GROUP BY 1")
def p09(spark, d):
    free, gated = R.gated_split(index(spark, d))
    return free.select(F.lit(True).alias("free")).unionByName(gated.select(F.lit(False).alias("free"))).groupBy("free").agg(F.count("*").alias("n"))


@query("p10_format_cells", INDEX + "SELECT source, brand, temporal_stance, opportunity_area, CASE WHEN gate_reason IS NOT NULL THEN gate_reason ELSE 'n=' || CAST(n_cell AS STRING) END AS cell FROM index_")
def p10(spark, d):
    cell = R.format_proportion(F.col("proportion"), F.col("ci_low"), F.col("ci_high"), F.col("n_cell"), F.col("gate_reason"))
    return index(spark, d).select("source", "brand", "temporal_stance", AREA, F.when(F.col("gate_reason").isNull(), F.regexp_extract(cell, "n=[0-9]+$", 0)).otherwise(cell).alias("cell"))


@query("w09_order_index", INDEX + "SELECT source, temporal_stance, opportunity_area, brand FROM index_")
def w09(spark, d):
    return R.order_index(index(spark, d)).select("source", "temporal_stance", AREA, "brand")


@query("q07_j05_emit_index", INDEX + "SELECT source, brand, temporal_stance, opportunity_area, round(oi, 9) AS oi, CAST(NULL AS DOUBLE) AS ratio FROM index_")
def q07(spark, d):
    return RD(R.emit_index(index(spark, d), compared(spark, d)), "oi").select("source", "brand", "temporal_stance", AREA, "oi", F.col("ratio"))


@query("j15_never_observed", with_views("labelled", "areas") + "SELECT opportunity_area FROM areas WHERE detectability IN ('strong', 'moderate') AND opportunity_area NOT IN (SELECT CASE WHEN opportunity_area < 'OA-05' THEN opportunity_area ELSE 'none' END FROM labelled)")
def j15(spark, d):
    rows = view(spark, d, "labelled").withColumn(AREA, F.when(F.col(AREA) < "OA-05", F.col(AREA)).otherwise("none"))
    return R.never_observed(view(spark, d, "areas"), rows).select(AREA)


@query("q06_blind_spots", INDEX + """SELECT 'gated' AS section, opportunity_area AS item, detectability AS detail FROM areas WHERE detectability IN ('weak', 'none') OR addressability = 0
    UNION ALL SELECT 'absent', opportunity_area, detectability FROM areas WHERE detectability IN ('strong', 'moderate') AND opportunity_area NOT IN (SELECT opportunity_area FROM index_)
    UNION ALL SELECT 'ineligible source', source, 'no denominator' FROM sources WHERE NOT denominator_eligible UNION ALL SELECT 'gate', gate_reason, CAST(count(*) AS STRING) FROM index_ WHERE gate_reason IS NOT NULL GROUP BY gate_reason""")
def q06(spark, d):
    return R.blind_spots(view(spark, d, "areas"), index(spark, d), view(spark, d, "sources"))


@query("q08_opportunity_map", INDEX + "SELECT opportunity_area, name, round(proportion - ci_low, 9) AS arm_low, round(ci_high - proportion, 9) AS arm_high FROM index_ LEFT JOIN (SELECT opportunity_area, name FROM areas) a USING (opportunity_area) WHERE source = 'play' AND temporal_stance = 'post_purchase' AND brand = 'en'")
def q08(spark, d):
    out = R.opportunity_map(index(spark, d).drop("name"), view(spark, d, "areas"), "play", "post_purchase", "en")
    return RD(out, "arm_low", "arm_high").select(AREA, "name", "arm_low", "arm_high")


@query("q09_differential_view", "SELECT opportunity_area, difference, significant_at_alpha FROM (" + COMPARED + ") x WHERE source = 'click'")
def q09(spark, d):
    out = R.differential_view(compared(spark, d), view(spark, d, "areas"), "click", "post_purchase")
    return RD(out, "difference").select(AREA, "difference", "significant_at_alpha")
