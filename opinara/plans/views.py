"""Views over the shared test tables, written once in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Area codes with name, tree node, detectability, addressability and proximity weight.
AREAS = [
    ("OA-01", "Size unavailable in wanted variant", "V", "strong", 1, 0.9),
    ("OA-02", "Item sold out or delisted after saving", "V", "strong", 1, 1.0),
    ("OA-03", "Size inconsistency across brands", "D", "strong", 1, 0.7),
    ("OA-04", "Quality vs. imagery mismatch", "D", "strong", 1, 0.7),
    ("OA-05", "Fabric / material uncertainty", "D", "moderate", 1, 0.6),
    ("OA-06", "Return process friction", "D", "strong", 1, 0.5),
    ("OA-07", "Refund delay or dispute", "D", "strong", 1, 0.4),
    ("OA-08", "Exchange unavailable or hard", "D", "moderate", 1, 0.4),
    ("OA-09", "Cannot choose between similar options", "D", "weak", 1, 0.9),
    ("OA-10", "Forgot / never came back", "R", "none", 1, 1.0),
    ("OA-11", "Delivery timing uncertainty", "D", "strong", 1, 0.5),
    ("OA-12", "Checkout / payment failure", "X", "strong", 1, 0.3),
]
#: Surfaces: eligible as denominator, fixes the brand, implies the stance after purchase, matched group.
SOURCES = [("play", True, True, True, "app_store_review"), ("appstore", True, True, True, "app_store_review"), ("forum", False, False, False, "discussion")]
AREA_COLUMNS = "opportunity_area string, name string, tree_node string, detectability string, addressability int, proximity_weight double"
SOURCE_COLUMNS = "source string, denominator_eligible boolean, brand_established_by_surface boolean, surface_implies_post_purchase boolean, structurally_matched_group string"

#: Rows for what the shared documents lack: links, empty praise, failures, two scripts, open accents, long runs, marks that
#: cannot be seen, pieces that go on with the one before.
SAID = [
    (-1, "Bahut confuse hu, lu ya nahi SIZE ka issue hai", "en", "play"),
    (-2, "Buy cheap shoes today at https://shop.example and www.example", "en", "play"),
    (-3, "thank you app", "en", "appstore"),
    (-4, "App not working!!", "en", "play"),
    (-5, '\u092f\u0939 \u092c\u0939\u0941\u0924 \u0905\u091a\u094d\u091b\u093e \u0939\u0948 \u0914\u0930 \u092e\u0941\u091d\u0947 \u092a\u0938\u0902\u0926 \u0939\u0948', "hi", "play"),
    (-6, 'Cafe\u0301 tre\u0300s bon, mais u\u0308ber alles reste a\u0300 faire chez vous', "fr", "forum"),
    (-7, "sooooooo bad, I waited!!!! for weeks and weeeeks", "en", "forum"),
    (-8, 'zero\u200bwidth and \ufeffmarks \u2060stay   out\t\tof texts', "en", "appstore"),
    (-9, "Delivery was late and the fabric felt cheap", "en", "forum"),
    (-10, "The dress looked lovely in the picture. The cloth felt thin when it came home. But the return was quick and easy.", "en", "play"),
    (-11, "I ordered two sizes last week from here. It came late and torn. They refused to take it back at all! Why?? Nobody says.", "en", "forum"),
    (-12, 'One parcel came. \U0001f600\U0001f600 The other one did not come...\r\nWhich is sad for all of us! \n\n\n\nNo answer since then', "en", "play"),
    (-13, "   ", "en", "play"),
    (-14, '\u092c\u0939\u0941\u0924 nice app', "hi", "play"),
    (-15, 'good \u092c\u0939\u0941\u0924 \u0916\u0930\u093e\u092c \u0915\u092a\u0921\u093c\u093e \u092e\u093f\u0932\u093e', "hi", "play"),
    (-16, '\u092c\u0939\u0941\u0924 slow \u0939\u0948 \u092f\u0939 app', "hi", "appstore"),
    (-17, 'very nice\xa0app it is not', "en", "play"),
    (-18, '\xa1 thank you app !', "en", "play"),
    (-19, 'app\u2003is\xa0crashing \u2026', "en", "play"),
]

VIEWS = {
    "labelled": """
        SELECT d.doc_id AS utterance_id, d.text AS utterance_text, d.lang AS brand,
               CASE CAST(substr(d.source, 4) AS INT) % 3 WHEN 0 THEN 'play' WHEN 1 THEN 'appstore' ELSE 'forum' END AS source,
               CASE WHEN l.toxic = 1 THEN 'pre_purchase' WHEN d.n_chars < 200 THEN 'at_purchase'
                    WHEN d.n_chars % 3 = 0 THEN 'unclear' ELSE 'post_purchase' END AS temporal_stance,
               CASE WHEN d.doc_id % 13 = 0 THEN 'none' ELSE concat('OA-', lpad(CAST(d.doc_id % 13 AS STRING), 2, '0')) END AS opportunity_area,
               CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE 1 + d.doc_id % 3 END AS severity,
               ((d.doc_id * 37) % 101) / CAST(100 AS DOUBLE) AS confidence, d.n_chars % 5 = 0 AS hesitation_marker,
               l.quality AS quality, l.toxic AS toxic, split_part(d.text, '.', 1) AS evidence_quote
        FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id""",
    "said": """
        SELECT d.doc_id AS source_id, d.text AS raw_text, d.lang AS brand,
               CASE CAST(substr(d.source, 4) AS INT) % 3 WHEN 0 THEN 'play' WHEN 1 THEN 'appstore' ELSE 'forum' END AS source,
               1000000 - d.doc_id AS captured_at, CASE WHEN d.doc_id % 20 = 0 THEN NULL ELSE d.doc_id END AS posted_at
        FROM {documents} d
        UNION ALL SELECT source_id, raw_text, brand, source, 2000000 - source_id, NULL FROM (VALUES """ + ", ".join(f"({i}, '{t}', '{b}', '{s}')" for i, t, b, s in SAID) + """) AS v(source_id, raw_text, brand, source)""",
    "event_cells": """
        SELECT event_id, event_type AS source, concat('b', CAST(user_id % 3 AS STRING)) AS brand,
               concat('k', CAST(event_id % 5 AS STRING)) AS opportunity_area, 'post_purchase' AS temporal_stance,
               CASE WHEN event_id % 20 = 0 THEN NULL ELSE ts END AS posted_at, ts, value
        FROM (SELECT event_id, event_type, user_id, value, CASE WHEN user_id % 3 = 2 THEN least(ts, (SELECT min(ts) + INTERVAL 5 DAYS FROM {events})) ELSE ts END AS ts FROM {events}) e""",
    "ledger": """
        SELECT event_id, ts AS called_at, CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS lane, 'p' AS provider, 'm' AS model,
               CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS outcome, (event_id % 9) * 10 AS prompt_tokens,
               CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 9 END AS completion_tokens, value AS latency_s, value / 10 AS rate_limit_wait_s
        FROM {events}""",
    "runs": """
        SELECT d.doc_id AS utterance_id, b.batch, r.repeat,
               CASE WHEN (d.doc_id * b.batch + r.repeat) % 97 = 0 THEN 'other' ELSE concat('OA-', CAST(d.doc_id % 13 AS STRING)) END AS label
        FROM {documents} d CROSS JOIN (SELECT 5 AS batch UNION ALL SELECT 10 UNION ALL SELECT 20 UNION ALL SELECT 40) b
             CROSS JOIN (SELECT 1 AS repeat UNION ALL SELECT 2) r
        WHERE NOT (b.batch = 40 AND d.doc_id % 50 = 0)""",
}
#: Views over views. Lane C and the gold labels know some rows by ids that no other view has, so joins with them miss.
VIEWS |= {
    "lane_a": f"SELECT utterance_id, opportunity_area, temporal_stance, severity, confidence, 0 AS labelled_at FROM ({VIEWS['labelled']}) x UNION ALL SELECT utterance_id, 'OA-99', temporal_stance, severity, confidence, 1 FROM ({VIEWS['labelled']}) y WHERE utterance_id % 11 = 0",
    "lane_b": f"SELECT utterance_id, concat('OA-', lpad(CAST((utterance_id + 1) % 13 AS STRING), 2, '0')) AS opportunity_area, temporal_stance, CASE WHEN utterance_id % 3 = 0 THEN NULL ELSE severity END AS severity, confidence + 0.5 AS confidence, 0 AS labelled_at FROM ({VIEWS['labelled']}) x WHERE confidence < 0.3",
    "lane_c": f"SELECT CASE WHEN utterance_id % 11 = 0 THEN -1 - utterance_id ELSE utterance_id END AS utterance_id, CASE WHEN utterance_id % 7 = 0 THEN 'none' ELSE opportunity_area END AS opportunity_area, CASE WHEN utterance_id % 5 = 0 THEN 'unclear' ELSE temporal_stance END AS temporal_stance, severity, confidence, 0 AS labelled_at FROM ({VIEWS['labelled']}) x",
    "gold": f"SELECT CASE WHEN utterance_id % 23 = 0 THEN -1 - utterance_id ELSE utterance_id END AS utterance_id, CASE WHEN utterance_id % 35 = 0 THEN 'none' ELSE opportunity_area END AS opportunity_area, temporal_stance, severity, hesitation_marker, CASE WHEN utterance_id % 2 = 0 THEN 0.5 ELSE CAST(2.0 AS DOUBLE) END AS sampling_weight FROM ({VIEWS['labelled']}) x",
}
_TABLES = ("documents", "labels", "events", "pages", "conversations", "benchmark", "customer", "orders", "lineitem", "part", "supplier", "nation", "region")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "areas":
        return spark.createDataFrame(AREAS, AREA_COLUMNS)
    if name == "sources":
        return spark.createDataFrame(SOURCES, SOURCE_COLUMNS)
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in _TABLES if f"{{{t}}}" in text})


def _values(rows: list[tuple], columns: str) -> str:
    show = lambda v: f"'{v}'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)
    names = ", ".join(c.split()[0] for c in columns.split(", "))
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(show, r)) + ')' for r in rows)}) AS t({names})"


def with_views(*names: str) -> str:
    """``WITH`` of the named views, for DuckDB."""
    given = {"areas": _values(AREAS, AREA_COLUMNS), "sources": _values(SOURCES, SOURCE_COLUMNS)}
    return "WITH " + ", ".join(f"{n} AS ({given.get(n) or VIEWS[n].format(**{t: t for t in _TABLES})})" for n in names) + " "
