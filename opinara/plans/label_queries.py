"""Queries on label responses, lanes, agreement and table checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.operators import agreement as A
from opinara.operators import checks, labels
from opinara.operators.sampling import dedupe_first

from .registry import query
from .views import AREAS, table, view, with_views

CODES = [a[0] for a in AREAS]
RD = lambda df, *names: df.withColumns({n: F.round(n, 9) for n in names})
ID = "utterance_id % "


# ---- responses: batches of labels with planted faults ----------------------------------------------


def requests(spark, d):
    rows = view(spark, d, "labelled")
    return rows.select(F.floor(F.col("utterance_id") / 20).alias("batch_id"), F.col("utterance_id").cast("string").alias("utterance_id"), F.col("utterance_text").alias("text"), F.col("utterance_id").alias("n"), "opportunity_area", "temporal_stance", "hesitation_marker", "severity", "confidence", "evidence_quote")


def responses(spark, d):
    k = F.col("n")
    item = F.struct(
        F.when(k % 29 == 0, F.concat(F.lit("x"), "utterance_id")).otherwise(F.col("utterance_id")).alias("utterance_id"), F.lit("D").alias("tree_node"), F.lit(None).cast("string").alias("sub_node"),
        F.when(k % 37 == 0, "OA-77").otherwise(F.col("opportunity_area")).alias("opportunity_area"), "temporal_stance", "hesitation_marker",
        F.when(k % 17 == 0, 5).otherwise(F.col("severity")).cast("int").alias("severity"), F.when(k % 31 == 0, 1.2).otherwise(F.col("confidence")).alias("confidence"),
        F.when(k % 19 == 0, F.concat(F.lit("~"), "evidence_quote")).otherwise(F.col("evidence_quote")).alias("evidence_quote"),
    )
    rows = requests(spark, d).where("n % 23 <> 0").groupBy("batch_id").agg(F.collect_list(item).alias("l"))
    wrapped = F.when(F.col("batch_id") % 3 == 0, F.to_json(F.struct(F.col("l").alias("labels")))).when(F.col("batch_id") % 3 == 1, F.to_json(F.struct(F.col("l").alias("results")))).otherwise(F.to_json("l"))
    return rows.select("batch_id", F.when(F.col("batch_id") == 7, "sorry").otherwise(wrapped).alias("payload"))


def ingested(spark, d):
    return labels.ingest_labels(requests(spark, d).select("batch_id", "utterance_id", "text"), responses(spark, d), CODES)


FAULTS = with_views("labelled") + """, k AS (SELECT *, utterance_id // 20 AS batch_id FROM labelled), live AS (SELECT * FROM k WHERE batch_id <> 7 AND utterance_id % 23 <> 0),
    j AS (SELECT *, CASE WHEN utterance_id % 29 = 0 THEN 'id was not asked for' WHEN utterance_id % 17 = 0 AND utterance_id % 31 = 0 THEN 'schema: severity,confidence' WHEN utterance_id % 17 = 0 THEN 'schema: severity' WHEN utterance_id % 31 = 0 THEN 'schema: confidence'
    WHEN utterance_id % 37 = 0 THEN 'area not in taxonomy' WHEN utterance_id % 19 = 0 THEN 'quote not in text' END AS reason FROM live)"""


@query("q01_ingest_labels", FAULTS + " SELECT CAST(utterance_id AS STRING) AS utterance_id, CASE WHEN utterance_id % 13 = 0 THEN 'none' ELSE opportunity_area END AS opportunity_area FROM j WHERE reason IS NULL")
def q01(spark, d):
    return ingested(spark, d)[0].select("utterance_id", "opportunity_area")


@query("q01_j10_j11_quarantine", FAULTS + """ SELECT reason, count(*) AS n FROM (SELECT reason FROM j WHERE reason IS NOT NULL UNION ALL SELECT 'response does not parse' FROM k WHERE batch_id = 7 GROUP BY batch_id
    UNION ALL SELECT 'id was not returned' FROM k WHERE batch_id <> 7 AND (utterance_id % 23 = 0 OR utterance_id % 29 = 0)) x GROUP BY reason""")
def q01_quarantine(spark, d):
    return ingested(spark, d)[1].groupBy("reason").agg(F.count("*").alias("n"))


@query("a49_quarantine_rate", FAULTS + """ SELECT batch_id, reason, count(*) AS n, round(count(*) / max(asked), 9) AS rate FROM (SELECT batch_id, reason FROM j WHERE reason IS NOT NULL UNION ALL SELECT 7, 'response does not parse' FROM k WHERE batch_id = 7 GROUP BY batch_id
    UNION ALL SELECT batch_id, 'id was not returned' FROM k WHERE batch_id <> 7 AND (utterance_id % 23 = 0 OR utterance_id % 29 = 0)) x JOIN (SELECT batch_id, count(*) AS asked FROM k GROUP BY batch_id) y USING (batch_id) GROUP BY batch_id, reason""")
def a49(spark, d):
    return RD(labels.quarantine_rate(ingested(spark, d)[1], requests(spark, d), "batch_id"), "rate")


@query("f18_parse_label_response", FAULTS + " SELECT batch_id, count(*) AS n FROM live GROUP BY batch_id UNION ALL SELECT 7, -1 FROM k WHERE batch_id = 7 GROUP BY batch_id")
def f18(spark, d):
    parsed = labels.parse_label_response(F.col("payload"))
    return responses(spark, d).select("batch_id", F.coalesce(F.size(parsed), F.lit(-1)).cast("long").alias("n"))


@query("f22_build_requests", FAULTS + """, m AS (SELECT batch_id, concat('Label these: [', string_agg(concat('{"id":"', CAST(utterance_id AS STRING), '","text":', CAST(to_json(utterance_text) AS STRING), '}'), ',' ORDER BY CAST(utterance_id AS STRING)), ']') AS payload FROM k GROUP BY batch_id)
    SELECT batch_id, payload, CAST(floor((floor(length(payload) / CAST(3.2 AS DOUBLE)) + 32) * CAST(1.5 AS DOUBLE)) AS BIGINT) AS est_tokens FROM m""")
def f22(spark, d):
    return labels.build_requests(requests(spark, d), "Label these: {items}")


@query("j09_pending", with_views("labelled") + "SELECT utterance_id FROM labelled WHERE utterance_id % 3 <> 0")
def j09(spark, d):
    rows = view(spark, d, "labelled")
    done = rows.where("utterance_id % 3 = 0").withColumn("classifier_version", F.lit("v2")).unionByName(rows.withColumn("classifier_version", F.lit("v1")))
    return labels.pending(rows, done, "v2").select("utterance_id")


@query("u02_u03_id_sets", with_views("labelled", "gold") + "SELECT count(*) FILTER (WHERE utterance_id IN (SELECT utterance_id FROM gold)) AS n_both, count(*) FILTER (WHERE utterance_id NOT IN (SELECT utterance_id FROM gold)) AS n_left FROM labelled")
def u02(spark, d):
    a, b = (view(spark, d, name).select("utterance_id") for name in ("labelled", "gold"))
    both = checks.common_ids(a, b).select(F.lit(1).alias("k")).unionByName(checks.missing_ids(a, b).select(F.lit(0).alias("k")))
    return both.agg(F.count_if(F.col("k") == 1).alias("n_both"), F.count_if(F.col("k") == 0).alias("n_left"))


# ---- lanes --------------------------------------------------------------------------------------------

FIELDS = ("opportunity_area", "temporal_stance", "severity", "confidence")
LANES = with_views("lane_a", "lane_b", "lane_c") + """, m AS (SELECT a.utterance_id, coalesce(b.opportunity_area, a.opportunity_area) AS opportunity_area, coalesce(b.temporal_stance, a.temporal_stance) AS temporal_stance,
    coalesce(b.severity, a.severity) AS severity, coalesce(b.confidence, a.confidence) AS confidence, b.utterance_id IS NOT NULL AS escalated, c.opportunity_area AS "laneC_opportunity_area", c.temporal_stance AS "laneC_temporal_stance", c.severity AS "laneC_severity"
    FROM lane_a a LEFT JOIN lane_b b USING (utterance_id) LEFT JOIN lane_c c ON c.utterance_id = a.utterance_id WHERE a.labelled_at = 0)"""


def merged(spark, d):
    return labels.consolidate(*(view(spark, d, f"lane_{x}") for x in "abc"), FIELDS)


@query("q02_j06_j07_consolidate", LANES + ' SELECT utterance_id, opportunity_area, temporal_stance, severity, round(confidence, 9) AS confidence, escalated, "laneC_opportunity_area", "laneC_temporal_stance", "laneC_severity" FROM m')
def q02(spark, d):
    return RD(merged(spark, d), "confidence").select("utterance_id", "opportunity_area", "temporal_stance", "severity", "confidence", "escalated", "laneC_opportunity_area", "laneC_temporal_stance", "laneC_severity")


@query("a44_dedupe_report", with_views("lane_a", "lane_b") + "SELECT 'A' AS lane, count(*) AS n_read, count(DISTINCT utterance_id) AS n_kept, count(*) - count(DISTINCT utterance_id) AS n_dropped FROM lane_a UNION ALL SELECT 'B', count(*), count(DISTINCT utterance_id), count(*) - count(DISTINCT utterance_id) FROM lane_b")
def a44(spark, d):
    return labels.dedupe_report({"A": view(spark, d, "lane_a"), "B": view(spark, d, "lane_b")})


@query("a28_disagreement_flag", LANES + ' SELECT utterance_id, opportunity_area IS DISTINCT FROM "laneC_opportunity_area" OR temporal_stance IS DISTINCT FROM "laneC_temporal_stance" AS differs FROM m')
def a28(spark, d):
    return merged(spark, d).select("utterance_id", A.disagreement_flag((F.col("opportunity_area"), F.col("temporal_stance")), (F.col("laneC_opportunity_area"), F.col("laneC_temporal_stance"))).alias("differs"))


def _agreement_sql(pairs: str) -> str:
    """``pairs``: a SELECT of field, a, b, w without nulls."""
    return f""", t AS (SELECT field, a, b, sum(w) AS w, count(*) AS n FROM ({pairs}) x WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY field, a, b), s AS (SELECT field, sum(w) AS tot, sum(n) AS n, sum(w) FILTER (WHERE a = b) / sum(w) AS po FROM t GROUP BY field),
    v AS (SELECT field, v, sum(pa) AS pa, sum(pb) AS pb FROM (SELECT field, a AS v, w / tot AS pa, 0 AS pb FROM t JOIN s USING (field) UNION ALL SELECT field, b, 0, w / tot FROM t JOIN s USING (field)) y GROUP BY field, v),
    e AS (SELECT field, sum(pa * pb) AS pe, sum((pa + pb) / 2 * (1 - (pa + pb) / 2)) / (count(*) - 1) AS pg FROM v GROUP BY field),
    k AS (SELECT field, CAST(n AS BIGINT) AS n, po, CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) END AS kappa, CASE WHEN pe < 1 THEN sqrt(po * (1 - po) / (tot * pow(1 - pe, 2))) END AS se, (po - pg) / (1 - pg) AS ac1 FROM s JOIN e USING (field))"""


KSHOW = "SELECT field, n, round(po, 9) AS observed, round(kappa, 9) AS kappa, round(se, 9) AS se, round(ac1, 9) AS ac1, CASE WHEN kappa IS NULL THEN NULL WHEN kappa >= 0.81 THEN 'almost perfect' WHEN kappa >= 0.61 THEN 'substantial' WHEN kappa >= 0.41 THEN 'moderate' WHEN kappa >= 0.21 THEN 'fair' WHEN kappa >= 0 THEN 'slight' ELSE 'poor' END AS kappa_band, coalesce(po >= 0.8 AND kappa < 0.61, false) AS kappa_paradox FROM k"
C_PAIRS = """SELECT 'opportunity_area' AS field, opportunity_area AS a, "laneC_opportunity_area" AS b, CAST(1 AS DOUBLE) AS w FROM m UNION ALL SELECT 'temporal_stance', temporal_stance, "laneC_temporal_stance", 1 FROM m UNION ALL SELECT 'severity', CAST(severity AS STRING), CAST("laneC_severity" AS STRING), 1 FROM m"""
KCOLS = ("field", "n", "observed", "kappa", "se", "ac1", "kappa_band", "kappa_paradox")


def lanes_agreement(spark, d):
    return A.annotator_agreement(merged(spark, d), ("opportunity_area", "temporal_stance", "severity"))


@query("a21_a25_annotator_agreement", LANES + _agreement_sql(C_PAIRS) + KSHOW)
def a25(spark, d):
    return RD(lanes_agreement(spark, d), "observed", "kappa", "se", "ac1").select(*KCOLS)


G_PAIRS = "SELECT 'opportunity_area' AS field, g.opportunity_area AS a, m.opportunity_area AS b, sampling_weight AS w FROM gold g LEFT JOIN labelled m USING (utterance_id) UNION ALL SELECT 'temporal_stance', g.temporal_stance, m.temporal_stance, sampling_weight FROM gold g LEFT JOIN labelled m USING (utterance_id)"


def gold_agreement(spark, d):
    return A.human_agreement(view(spark, d, "gold"), view(spark, d, "labelled"), ("opportunity_area", "temporal_stance"), "sampling_weight")


@query("a22_a26_j08_human_agreement", with_views("gold", "labelled") + _agreement_sql(G_PAIRS).replace("(po - pg) / (1 - pg)", "CASE WHEN pg < 1 THEN (po - pg) / (1 - pg) END") + KSHOW)
def a26(spark, d):
    return RD(gold_agreement(spark, d), "observed", "kappa", "se", "ac1").select(*KCOLS)


@query("a26_hesitation_precision", with_views("gold", "labelled") + "SELECT count(*) FILTER (WHERE toxic = 1 AND quality = 1) AS n_true, count(*) FILTER (WHERE toxic = 1) AS n_claimed, round(count(*) FILTER (WHERE toxic = 1 AND quality = 1) / count(*) FILTER (WHERE toxic = 1), 9) AS precision FROM labelled")
def a26_precision(spark, d):
    return RD(A.precision(view(spark, d, "labelled"), F.col("toxic") == 1, F.col("quality") == 1), "precision")


@query("a27_reliability_gate", LANES + _agreement_sql(C_PAIRS) + "SELECT coalesce(string_agg(field, ',' ORDER BY field) FILTER (WHERE coalesce(kappa < 0.61, true)), '') AS failing, CASE WHEN count(*) FILTER (WHERE coalesce(kappa < 0.61, true)) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM k")
def a27(spark, d):
    return A.reliability_gate(lanes_agreement(spark, d)).withColumn("failing", F.array_join("failing", ","))


@query("a43_reliability_table", LANES.replace("WITH lane_a", "WITH labelled AS (SELECT * FROM (" + with_views("labelled")[len("WITH labelled AS (") : -2] + ") z), lane_a") + _agreement_sql(C_PAIRS) + "SELECT 'lanes' AS comparison, field, round(kappa, 9) AS kappa FROM k")
def a43(spark, d):
    from opinara.operators.reports import reliability_table

    return RD(reliability_table({"lanes": lanes_agreement(spark, d)}), "kappa").select("comparison", "field", "kappa")


@query("a29_sweep_tau", with_views("labelled") + ", b AS (SELECT round_even(confidence * 10, 0) / 10 AS bucket, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS n_correct FROM labelled GROUP BY 1) SELECT round(max(bucket), 9) AS tau FROM b WHERE n_correct / n < (SELECT sum(n_correct) / sum(n) FROM b)")
def a29(spark, d):
    return RD(A.sweep_tau(view(spark, d, "labelled"), F.col("quality") == 1)[1], "tau")


RUNS = with_views("runs") + ", ref AS (SELECT utterance_id, label AS r FROM runs WHERE batch = 5 AND repeat = 1), p AS (SELECT batch, repeat, count(*) FILTER (WHERE label = r) AS x, count(label) AS n FROM ref JOIN runs USING (utterance_id) GROUP BY batch, repeat)"


@query("a30_batch_stability_sweep", RUNS + " SELECT batch, n, round(x / n, 9) AS agreement, round((SELECT x / n FROM p WHERE batch = 5 AND repeat = 2), 9) AS floor, (SELECT count(*) FROM ref) - n AS omitted FROM p WHERE repeat = 1")
def a30(spark, d):
    return RD(A.batch_stability_sweep(view(spark, d, "runs")), "agreement", "floor").select("batch", "n", "agreement", "floor", "omitted")


@query("a30_chosen_batch", RUNS + """, f AS (SELECT x AS fx, n AS fn FROM p WHERE batch = 5 AND repeat = 2), g AS (SELECT *, (x + fx) / (n + fn) AS pool, (SELECT count(*) FROM ref) - n AS omitted FROM p, f WHERE repeat = 1),
    z AS (SELECT *, (x / n - fx / fn) / nullif(sqrt(pool * (1 - pool) * (1 / n + 1 / fn)), 0) AS z FROM g), e AS (SELECT batch, NOT (coalesce(abs(z) > 1.959963985, false) AND x / n < fx / fn) AND omitted = 0 AS eligible FROM z)
    SELECT batch, eligible, coalesce(batch = (SELECT max(batch) FROM e WHERE eligible), false) AS chosen FROM e""")
def a30_chosen(spark, d):
    return A.batch_stability_sweep(view(spark, d, "runs")).select("batch", "eligible", "chosen")


@query("a31_batch_accuracy_sweep", with_views("runs") + "SELECT batch, count(label) AS n, count(*) FILTER (WHERE label = concat('OA-', CAST(utterance_id % 13 AS STRING))) AS n_correct, round(count(*) FILTER (WHERE label = concat('OA-', CAST(utterance_id % 13 AS STRING))) / count(label), 9) AS accuracy FROM runs WHERE repeat = 1 GROUP BY batch")
def a31(spark, d):
    gold = table(spark, d, "documents").select(F.col("doc_id").alias("utterance_id"), F.concat(F.lit("OA-"), F.col("doc_id") % 13).alias("label"))
    return RD(A.batch_accuracy_sweep(view(spark, d, "runs"), gold), "accuracy").select("batch", "n", "n_correct", "accuracy")


# ---- checks -------------------------------------------------------------------------------------------


@query("q03_check_gold", with_views("gold") + """SELECT 'out of vocabulary' AS "check", 'problem' AS level, 'opportunity_area=' || opportunity_area AS detail, count(*) AS n FROM gold WHERE opportunity_area = 'OA-05' GROUP BY opportunity_area
    UNION ALL SELECT 'missing column', 'problem', 'labeller_note', 1 UNION ALL SELECT 'severity', 'problem', 'severity without area', count(*) FROM gold WHERE severity IS NOT NULL AND opportunity_area = 'none' HAVING count(*) > 0
    UNION ALL SELECT 'severity', 'problem', 'area without severity', count(*) FROM gold WHERE severity IS NULL AND opportunity_area <> 'none' HAVING count(*) > 0""")
def q03(spark, d):
    gold = view(spark, d, "gold").withColumn("severity", F.col("severity").cast("double"))
    return checks.check_gold(gold, {"opportunity_area": [*(c for c in CODES if c != "OA-05"), "none"], "severity": ["1", "2", "3"]}, ("utterance_id", "labeller_note"))


@query("q04_check_constraints", with_views("labelled") + """SELECT 'allowed brand' AS rule, CAST(utterance_id AS STRING) AS key, brand AS detail FROM labelled WHERE brand NOT IN ('en', 'fr') UNION ALL SELECT 'range confidence', CAST(utterance_id AS STRING), CAST(confidence AS STRING) FROM labelled WHERE confidence > 0.9
    UNION ALL SELECT 'prefix opportunity_area', CAST(utterance_id AS STRING), opportunity_area FROM labelled WHERE opportunity_area = 'none' UNION ALL SELECT 'length utterance_text', CAST(utterance_id AS STRING), CAST(length(utterance_text) AS STRING) FROM labelled WHERE length(utterance_text) > 2000
    UNION ALL SELECT 'reference opportunity_area', CAST(utterance_id AS STRING), opportunity_area FROM labelled WHERE opportunity_area = 'none'""")
def q04(spark, d):
    rows = view(spark, d, "labelled")
    rules = [checks.required("utterance_text"), checks.one_of("brand", ["en", "fr"]), checks.between("confidence", 0, 0.9), checks.needs(F.col("toxic") == 1, "utterance_text"), checks.prefixed("opportunity_area", "OA-"), checks.at_most("utterance_text", 2000)]
    return checks.check_constraints(rows, "utterance_id", rules, references={"opportunity_area": (view(spark, d, "areas"), "opportunity_area")})


@query("u04_offending_values", "SELECT DISTINCT lang FROM documents WHERE lang NOT IN ('en', 'de')")
def u04(spark, d):
    return checks.offending_values(table(spark, d, "documents"), "lang", spark.createDataFrame([("en",), ("de",)], "v string"))


@query("w07_lane_dedupe", with_views("lane_a") + "SELECT opportunity_area, count(*) AS n FROM lane_a WHERE labelled_at = 0 GROUP BY opportunity_area")
def w07(spark, d):
    return dedupe_first(view(spark, d, "lane_a"), "utterance_id", ("labelled_at",)).groupBy("opportunity_area").agg(F.count("*").alias("n"))
