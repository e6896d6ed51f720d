"""Queries on text functions, segmentation, drop rules, sources and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import segment as S
from opinara.functions import text as T
from opinara.operators import checks, lexicon, prepare
from opinara.sources import logs, shapes

from .registry import query
from .views import table, view, with_views

STOP = "', '".join(T.STOPWORDS)
HINDI = "', '".join(T.HINDI_LATIN)
#: All white space, in a class of DuckDB's expressions.
GAPS = r"\s\x0b\x85\xa0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
TRIM = rf"regexp_replace(%s, '^[{GAPS}]+|[{GAPS}]+$', '', 'g')"
NORMAL = TRIM % r"regexp_replace(regexp_replace(regexp_replace(raw_text, '[\x{200B}-\x{200D}\x{2060}\x{FEFF}\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')"
HASH = "sha1(" + TRIM % rf"regexp_replace(regexp_replace(lower(t), '[^\p{{L}}\p{{N}}_{GAPS}]', '', 'g'), '[{GAPS}]+', ' ', 'g')" + ")"
WORDS = rf"len(list_filter(string_split_regex(%s, '[{GAPS}]+'), lambda x: x <> ''))"
TOKENS = rf"list_filter(regexp_extract_all(lower(%s), '[\p{{L}}\p{{N}}_\x27]+'), lambda x: x NOT IN ('{STOP}'))"


#: The said texts as ``nn.t``: composed, without invisible marks, runs of one character cut to three, spaces joined. SQL has
#: no back-references, so runs are told by comparing a character with the three before it.
STRIP = r"regexp_replace(%s, '[\x{200B}-\x{200D}\x{2060}\x{FEFF}\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')"
CAPS = "array_to_string(list_filter(c, lambda x, i: NOT coalesce(i > 3 AND x = c[i - 1] AND x = c[i - 2] AND x = c[i - 3] AND x NOT IN (chr(10), chr(13), chr(133), chr(8232), chr(8233)), false)), '')"
NORMED = f", q AS (SELECT *, string_split({STRIP % '@RAW@'}, '') AS c FROM said), nn AS (SELECT source, source_id, brand, {TRIM % rf"regexp_replace(regexp_replace({CAPS}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"} AS t FROM q)"
#: Utterances as ``u(source, source_id, t, s, e)``: pieces end where a run of sentence ends stands before white space, and a
#: recursive query walks a text's pieces with the words of the open utterance.
BEGINS = rf"regexp_matches(piece, '(?i)^[{GAPS}]*(%s)($|[^\p{{L}}\p{{N}}\p{{M}}_])')"
UTTERED_OF = (with_views("said") + NORMED).replace("WITH ", "WITH RECURSIVE ", 1) + rf""", x AS (SELECT *, {WORDS % 't'} AS tw, list_filter(string_split(regexp_replace(t, '([.!?\n]+)([{GAPS}])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda v: v <> '') AS l FROM nn),
    y AS (SELECT source_id, unnest(l) AS piece, generate_subscripts(l, 1) AS k FROM x WHERE tw >= 8),
    p AS (SELECT source_id, k, length(piece) AS n, {WORDS % 'piece'} AS w, {BEGINS % S.CONTINUES} AS c, {BEGINS % S.PRONOUN} AS r, sum(length(piece)) OVER (PARTITION BY source_id ORDER BY k) - length(piece) AS o FROM y),
    f AS (SELECT source_id, k, o, n, w, 1 AS g, w AS gw FROM p WHERE k = 1
        UNION ALL SELECT p.source_id, p.k, p.o, p.n, p.w, CASE WHEN p.c OR p.r AND f.gw < 25 THEN f.g ELSE f.g + 1 END, CASE WHEN p.c OR p.r AND f.gw < 25 THEN f.gw + p.w ELSE p.w END FROM f JOIN p ON p.source_id = f.source_id AND p.k = f.k + 1),
    g AS (SELECT source_id, min(o) AS s, max(o + n) AS e FROM f GROUP BY source_id, g HAVING sum(w) > 0),
    u AS (SELECT source, source_id, t, CAST(s AS INT) AS s, CAST(e AS INT) AS e FROM x JOIN g USING (source_id) UNION ALL SELECT source, source_id, t, 0, CASE WHEN tw = 0 THEN 0 ELSE CAST(length(t) AS INT) END FROM x WHERE tw < 8)"""


def uttered(raw: str = "raw_text") -> str:
    return UTTERED_OF.replace("@RAW@", raw)


SAID_IN_U = TRIM % "substr(t, s + 1, e - s)"


def said(spark, d):
    return view(spark, d, "said")


def normal(spark, d):
    """The said texts normalised, without composing, as SQL has no NFC."""
    return prepare.normalise(said(spark, d), compose=False)


@query("f01_f04_normalise", with_views("said") + NORMED.replace("@RAW@", "nfc_normalize(raw_text)") + " SELECT source_id, t AS normalised_text FROM nn")
def f01(spark, d):
    return said(spark, d).select("source_id", T.normalise(F.col("raw_text")).alias("normalised_text"))


@query("f02_f04_strip_and_collapse", with_views("said") + f"SELECT source_id, {NORMAL} AS normalised_text FROM said")
def f02(spark, d):
    return said(spark, d).select("source_id", T.collapse_space(T.strip_invisible(F.col("raw_text"))).alias("normalised_text"))


@query("f03_cap_runs", with_views("said") + f", q AS (SELECT source_id, string_split(raw_text, '') AS c FROM said) SELECT source_id, {CAPS} AS capped FROM q")
def f03(spark, d):
    return said(spark, d).select("source_id", T.cap_runs(F.col("raw_text")).alias("capped"))


@query("f05_text_hash", with_views("said") + f"SELECT source_id, {HASH} AS text_sha1 FROM (SELECT source_id, raw_text AS t FROM said) x")
def f05(spark, d):
    return said(spark, d).select("source_id", T.text_hash(F.col("raw_text")).alias("text_sha1"))


LANGUAGE = f"""CASE WHEN {TRIM % 't'} = '' THEN 'other' WHEN regexp_matches(t, '[\\x{{0900}}-\\x{{097F}}]') THEN 'hi'
    WHEN len(k) = 0 THEN 'other' WHEN h >= 2 OR (h = 1 AND len(k) <= 8) THEN 'hinglish' ELSE 'en' END"""
TOLD = f"""told AS (SELECT *, {LANGUAGE} AS language FROM (SELECT *, len(list_filter(k, lambda x: x IN ('{HINDI}'))) AS h
    FROM (SELECT *, raw_text AS t, regexp_extract_all(lower(raw_text), '[a-z]+') AS k FROM said) x) y)"""


@query("f06_detect_language", with_views("said") + f", {TOLD} SELECT source_id, language FROM told")
def f06(spark, d):
    return said(spark, d).select("source_id", T.detect_language(F.col("raw_text")).alias("language"))


@query("f07_emphasis_caps", with_views("said") + r"SELECT source_id, regexp_matches(raw_text, '(^|[^\p{L}\p{N}\p{M}_])[A-Z]{4,}($|[^\p{L}\p{N}\p{M}_])') AS has_caps_emphasis, regexp_matches(raw_text, '!{2,}') AS has_exclamation_run, len(list_filter(c, lambda x, i: coalesce(i > 2 AND x = c[i - 1] AND x = c[i - 2] AND x NOT IN (chr(10), chr(13), chr(133), chr(8232), chr(8233)), false))) > 0 AS has_repeated_chars FROM (SELECT *, string_split(raw_text, '') AS c FROM said) x")
def f07(spark, d):
    flags = T.emphasis_flags(F.col("raw_text"))
    return said(spark, d).select("source_id", *(flags[k].alias(k) for k in ("has_caps_emphasis", "has_exclamation_run", "has_repeated_chars")))


@query("f08_f13_segment", uttered() + f" SELECT source, source_id, sha1(concat_ws('|', source, CAST(source_id AS STRING), CAST(s AS STRING), CAST(e AS STRING))) AS utterance_id, s AS start, e AS \"end\", {SAID_IN_U} AS utterance_text FROM u")
def f08(spark, d):
    return S.segment(normal(spark, d)).select("source", "source_id", "utterance_id", F.col("span.start").alias("start"), F.col("span.end").alias("end"), "utterance_text")


@query("f13_span_faults", uttered() + " SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad, count(*) FILTER (WHERE s = 0 AND e = length(t)) AS n_whole FROM u")
def f13(spark, d):
    return S.span_faults(S.segment(normal(spark, d)))


@query("a05_segment_report", uttered() + " SELECT count(DISTINCT (source, source_id)) AS n_reviews, count(*) AS n_utterances, count(*) / count(DISTINCT (source, source_id)) AS ratio FROM u")
def a05(spark, d):
    return prepare.segment_report(S.segment(normal(spark, d)))


@query("f12_utterance_id", with_views("said") + "SELECT source_id, sha1(concat_ws('|', source, CAST(source_id AS STRING), '0', CAST(length(raw_text) AS STRING))) AS utterance_id FROM said")
def f12(spark, d):
    return said(spark, d).select("source_id", S.utterance_id(F.col("source"), F.col("source_id").cast("string"), F.lit(0), F.length("raw_text")).alias("utterance_id"))


@query("f14_word_counts", with_views("said") + f"SELECT source_id, CAST({WORDS % 'raw_text'} AS INT) AS n_words, CAST(len({TOKENS % 'raw_text'}) AS INT) AS n_tokens FROM said")
def f14(spark, d):
    return said(spark, d).select("source_id", T.word_count(F.col("raw_text")).alias("n_words"), F.size(T.content_tokens(F.col("raw_text"))).alias("n_tokens"))


LEXICON = {"stop": ("the", "of the"), "french": ("le ", "que", "è")}


@query("f15_lexicon_hits", with_views("said") + "SELECT source_id, len(list_filter(['the', 'of the'], lambda p: contains(lower(raw_text), p))) AS n_stop, len(list_filter(['le ', 'que', 'è'], lambda p: contains(lower(raw_text), p))) AS n_french FROM said")
def f15(spark, d):
    hits = T.lexicon_hits(F.col("raw_text"), LEXICON)
    return said(spark, d).select("source_id", F.size(hits["stop"]).cast("long").alias("n_stop"), F.size(hits["french"]).cast("long").alias("n_french"))


#: A lexicon from the shared tables: words of the benchmark and pairs of words that follow one another in conversations.
PHRASES = r"""words AS (SELECT DISTINCT 'word' AS grp, w AS phrase FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS w FROM benchmark) x),
    two AS (SELECT DISTINCT concat('turn', CAST(turn AS VARCHAR)) AS grp, concat(t[i], ' ', t[i + 1]) AS phrase FROM (SELECT turn, t, unnest(range(1, len(t))) AS i FROM (SELECT turn, regexp_extract_all(lower(text), '[a-z]{2,}') AS t FROM conversations) x) y),
    phrases AS (SELECT * FROM words UNION ALL SELECT * FROM two)"""


def phrases(spark, d):
    said = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))
    words = table(spark, d, "benchmark").select(F.lit("word").alias("grp"), F.explode(said).alias("phrase"))
    turns = table(spark, d, "conversations").select(F.concat(F.lit("turn"), "turn").alias("grp"), F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), F.lit(0)).alias("t"))
    two = turns.select("grp", F.explode(F.transform(F.slice("t", F.lit(1), F.greatest(F.size("t") - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get("t", i + 1)))).alias("phrase")).where("phrase <> ''")
    return words.unionByName(two).distinct()


@query("f15_lexicon_table", f"""WITH {PHRASES}, p AS (SELECT phrase, count(*) AS n, sum(length(grp)) AS k FROM phrases GROUP BY phrase), b AS (SELECT conv_id, turn, lower(text) AS t FROM conversations)
    SELECT conv_id, turn, CAST(sum(n) AS BIGINT) AS n_hits, CAST(sum(k) AS BIGINT) AS group_chars, CAST(sum(length(phrase)) AS BIGINT) AS chars FROM b JOIN p ON contains(t, phrase) GROUP BY conv_id, turn""")
def f15_table(spark, d):
    hits = lexicon.lexicon_table_hits(table(spark, d, "conversations"), phrases(spark, d))
    chars = lambda texts: F.aggregate(texts, F.lit(0).cast("long"), lambda n, x: n + F.length(x))
    each = hits.select("conv_id", "turn", F.array_size("hits").alias("n"), chars(F.col("hits.grp")).alias("k"), chars(F.array_distinct("hits.phrase")).alias("c"))
    return each.groupBy("conv_id", "turn").agg(F.sum("n").alias("n_hits"), F.sum("k").alias("group_chars"), F.sum("c").alias("chars")).where("n_hits > 0")


@query("f16_parse_timestamp_mixed", "SELECT event_id, ts AS parsed FROM events WHERE event_id % 5 <> 4 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 5 = 4")
def f16(spark, d):
    from opinara.functions.times import parse_mixed

    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    shape = F.when(F.col("event_id") % 5 == 0, F.concat(at, F.lit("Z"))).when(F.col("event_id") % 5 == 1, at).when(F.col("event_id") % 5 == 2, F.concat(at, F.lit("+00:00")))
    shape = shape.when(F.col("event_id") % 5 == 3, F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 330 MINUTES"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30"))).otherwise("soon")
    return table(spark, d, "events").select("event_id", parse_mixed(shape).cast("timestamp_ntz").alias("parsed"))


@query("f23_estimate_tokens", "SELECT doc_id, CAST(floor((floor(length(text) / CAST(3.2 AS DOUBLE)) + 32) * CAST(1.5 AS DOUBLE)) AS BIGINT) AS est_tokens FROM documents")
def f23(spark, d):
    return table(spark, d, "documents").select("doc_id", T.estimate_tokens(F.col("text"), 0.5).alias("est_tokens"))


PRINTED = """SELECT count(*) AS n_rows, bit_xor(h) AS mixed, CAST(sum(h) AS VARCHAR) AS summed FROM (SELECT CAST(concat('0x', substr(md5(concat_ws('|', coalesce(concat('=', CAST(doc_id AS STRING)), ''), coalesce('=' || text, ''),
    coalesce('=' || lang, ''), coalesce('=' || source, ''), coalesce('=' || CAST(n_chars AS STRING), ''))), 1, 15)) AS BIGINT) AS h FROM documents) x"""


@query("f25_table_fingerprint", PRINTED)
def f25(spark, d):
    return checks.table_fingerprint(table(spark, d, "documents"))


@query("f25_frozen", f"WITH a AS ({PRINTED}), b AS ({PRINTED} WHERE h <> (SELECT CAST(concat('0x', substr(md5(concat_ws('|', '=0', '=' || text, '=' || lang, '=' || source, '=' || CAST(n_chars AS STRING))), 1, 15)) AS BIGINT) FROM documents WHERE doc_id = 0)) SELECT 'same rows' AS given, a = a AS unchanged FROM a UNION ALL SELECT 'one row less', a = b FROM a, b")
def f25_frozen(spark, d):
    rows = table(spark, d, "documents")
    then = checks.table_fingerprint(rows.repartition(7))
    given = {"same rows": rows, "one row less": rows.where("doc_id <> 0")}
    same, less = (checks.frozen(df, then).select(F.lit(name).alias("given"), "unchanged") for name, df in given.items())
    return same.unionByName(less)


def edged(flags: str, word: str) -> str:
    return rf"'{flags}(^|[^\p{{L}}\p{{N}}_]){word}($|[^\p{{L}}\p{{N}}_])'"


PLANTED = "SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN concat(text, chr(10), 'todo: the «baseline» of ', source, chr(10), '  Lorem ipsum, a Placeholder, tbd??  ', chr(10), 'what ?? XXX xxx fixme', chr(10), 'éTODO, TBDé and कFIXME', chr(10), 'a??b and c???') ELSE text END AS text FROM {documents}"


@query(
    "q05_placeholder_findings",
    rf"""WITH d AS ({PLANTED.format(documents="documents")}), lines AS (SELECT doc_id AS file, unnest(string_split(text, chr(10))) AS t, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line FROM d),
    p AS (SELECT * FROM (VALUES ('«[^»]*»', 'guillemet placeholder'), ({edged('(?i)', 'TODO')}, 'TODO marker'), ({edged('', 'XXX')}, 'XXX marker'), ({edged('(?i)', 'TBD')}, 'TBD marker'), ({edged('(?i)', 'FIXME')}, 'FIXME marker'), ('(^|[^\p{{L}}\p{{N}}_?])\?{{2,}}($|[^\p{{L}}\p{{N}}_?])', 'bare question-mark placeholder'), ({edged('(?i)', 'placeholder')}, 'the word placeholder'), ({edged('(?i)', 'lorem ipsum')}, 'lorem ipsum')) v(pattern, kind))
    SELECT file, CAST(line AS INT) AS line, kind, substr({TRIM % 't'}, 1, 200) AS text FROM (SELECT * FROM lines WHERE regexp_matches(t, '(?i)«|\?\?|todo|xxx|tbd|fixme|placeholder|lorem')) l JOIN p ON regexp_matches(t, pattern)""",
)
def q05(spark, d):
    return checks.placeholder_findings(spark.sql(PLANTED, documents=table(spark, d, "documents")), "doc_id")


# ---- sources -----------------------------------------------------------------------------------


LOGGED = "CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END"


def log_lines(spark, d):
    """The events as a log of JSON lines, of which every tenth is torn."""
    line = F.to_json(F.struct("event_id", F.col("event_type").alias("stage"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "value"))
    return table(spark, d, "events").select(F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value"))


LOG_SCHEMA = "event_id long, stage string, at string, value double"


@query("s02_read_jsonl_tolerant", "SELECT count(*) FILTER (WHERE event_id % 10 <> 0) AS n_rows, count(*) FILTER (WHERE event_id % 10 = 0) AS n_skipped, sum(event_id) FILTER (WHERE event_id % 10 <> 0) AS ids FROM events")
def s02(spark, d):
    rows = logs.parse_jsonl(log_lines(spark, d), LOG_SCHEMA)
    good = F.col("_torn").isNull()
    return rows.agg(F.count_if(good).alias("n_rows"), F.count_if(~good).alias("n_skipped"), F.sum(F.when(good, F.col("event_id"))).alias("ids"))


@query("s03_latest_report", "SELECT stage, max(t) AS logged_at FROM (SELECT event_type AS stage, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS t FROM events WHERE event_id % 10 <> 0) x GROUP BY stage")
def s03(spark, d):
    rows = logs.parse_jsonl(log_lines(spark, d), LOG_SCHEMA).where("_torn is null").drop("_torn")
    return logs.latest_report(rows).select("stage", F.col("at").alias("logged_at"))


@query("s04_new_rows", "SELECT DISTINCT user_id, event_type FROM events WHERE (user_id, event_type) NOT IN (SELECT user_id, event_type FROM events WHERE event_id % 3 = 0)")
def s04(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type")
    return logs.new_rows(rows, table(spark, d, "events").where("event_id % 3 = 0"), ("user_id", "event_type"))


@query("s05_s06_verify_manifest", "SELECT doc_id AS path, CASE WHEN doc_id % 17 = 0 THEN 'missing' ELSE 'changed' END AS problem FROM documents WHERE doc_id % 17 = 0 OR doc_id % 19 = 0")
def s05(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("path"), F.sha2("text", 256).alias("sha256"))
    old = docs.select("path", F.lit("old").alias("sha256"), F.lit(1).alias("closed_at"))
    manifest = old.unionByName(docs.withColumn("closed_at", F.lit(2)))
    now = docs.where("path % 17 <> 0").withColumn("sha256", F.when(F.col("path") % 19 == 0, F.sha2(F.concat("sha256", F.lit("x")), 256)).otherwise(F.col("sha256")))
    return logs.verify_manifest(manifest, now)


@query("s12_flatten_threads", "SELECT conv_id AS thread_id, concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS source_id, text AS raw_text, CASE WHEN turn = (SELECT min(turn) FROM conversations c WHERE c.conv_id = d.conv_id) THEN 'top' ELSE 'reply' END AS comment_kind FROM conversations d")
def s12(spark, d):
    item = F.struct("turn", F.concat_ws("-", "conv_id", "turn").alias("id"), "text", F.col("role").alias("author"))
    threads = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("t"))
    slim = F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["text"].alias("text"), x["author"].alias("author")))
    payload = F.to_json(F.struct(slim[0].alias("top"), F.slice(slim, F.lit(2), F.size(slim)).alias("replies")))
    return shapes.flatten_threads(threads.select(F.col("conv_id").alias("thread_id"), payload.alias("payload")))


@query(
    "s13_flatten_submissions",
    """SELECT concat('s', CAST(conv_id AS STRING)) AS source_id, concat(role, chr(10) || chr(10), text) AS raw_text, 'submission' AS kind, make_timestamp(conv_id * 1000000) AS posted_at FROM conversations WHERE turn = 0
    UNION ALL SELECT concat('c', CAST(conv_id AS STRING), '-', CAST(turn AS STRING)), text, 'comment', make_timestamp(turn * 1000000) FROM conversations WHERE turn > 0 AND (conv_id + turn) % 5 <> 0""",
)
def s13(spark, d):
    rows = table(spark, d, "conversations")
    top = rows.where("turn = 0").select(F.concat(F.lit("s"), "conv_id").alias("id"), F.col("role").alias("title"), F.col("text").alias("body"), F.col("conv_id").alias("created_utc"))
    body = F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, "[deleted]").otherwise(F.col("text"))
    below = rows.where("turn > 0").select(F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), body.alias("body"), F.col("turn").alias("created_utc"))
    return shapes.flatten_submissions(top, below).withColumn("posted_at", F.col("posted_at").cast("timestamp_ntz"))


@query("s14_extract_rows", """SELECT doc_id, CASE WHEN k NOT IN (4, 6) THEN CAST(doc_id AS STRING) END AS id,
    CASE WHEN k = 7 THEN concat('{"said":"', source, '"}') WHEN k NOT IN (4, 6) THEN text END AS text, CASE WHEN k = 7 THEN 'object' WHEN k NOT IN (4, 6) THEN 'string' END AS kind FROM (SELECT *, doc_id % 8 AS k FROM documents) x""")
def s14(spark, d):
    """Payloads of all shapes: known keys alone, two of them at once, one level down, unknown ones, numbers and objects."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.array(F.struct(F.col("doc_id").cast("string").alias("id"), "text")).alias("r"))
    other, deep = F.array(F.struct(F.lit("x").alias("id"))), F.array(F.struct(F.col("doc_id").alias("id"), F.struct(F.col("source").alias("said")).alias("text")))
    shapes_ = (
        F.struct(F.col("r").alias("reviews")), F.struct(F.struct(F.col("r").alias("items")).alias("data")), F.col("r"), F.struct(F.col("r").alias("questions")), F.struct(F.lit(1).alias("other")),
        F.struct(F.struct(other.alias("questions")).alias("data"), F.col("r").alias("reviews")), F.struct(F.struct(F.col("r").alias("results")).alias("data")), F.struct(F.lit("no").alias("content"), F.struct(deep.alias("content")).alias("items")),
    )
    payload = F.coalesce(*(F.when(F.col("doc_id") % 8 == k, F.to_json(shape)) for k, shape in enumerate(shapes_)))
    rows, unknown = shapes.extract_rows(docs.select("doc_id", payload.alias("payload")))
    kind = F.when(F.schema_of_variant(F.try_variant_get("record", "$.text", "variant")).startswith("OBJECT"), "object").otherwise("string")
    return rows.select("doc_id", "id", "text", kind.alias("kind")).unionByName(unknown.select("doc_id"), allowMissingColumns=True)


@query("s15_coalesce_fields", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN source ELSE text END AS filled, substr(sha1(concat_ws('|', source, text)), 1, 20) AS fallback FROM documents")
def s15(spark, d):
    docs = table(spark, d, "documents")
    k = F.col("doc_id") % 3
    filled = T.first_filled(F.when(k == 0, F.col("lang")), F.when(k == 1, F.col("source")).otherwise(F.lit("")), F.col("text"))
    return docs.select("doc_id", filled.alias("filled"), T.content_id(F.col("source"), F.col("text")).alias("fallback"))


@query("s16_compose_text", r"SELECT page_id, regexp_replace(concat_ws('. ', nullif(trim(regexp_replace(url, '<[^>]+>', '', 'g'), ' '), ''), nullif(trim(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), ' '), '')), '^[. ]+|[. ]+$', '', 'g') AS text FROM pages")
def s16(spark, d):
    return table(spark, d, "pages").select("page_id", T.compose_text(F.col("url"), F.col("html")).alias("text"))


@query("s17_content_id", "SELECT doc_id, 'cs:' || substr(sha1(concat_ws('|', source, text)), 1, 20) AS id FROM documents")
def s17(spark, d):
    return table(spark, d, "documents").select("doc_id", T.content_id(F.col("source"), F.col("text"), prefix="cs:").alias("id"))


@query("s18_merge_last_wins", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def s18(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id")
    return shapes.merge_last_wins(rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1"), "user_id", "event_id")


@query("s19_u01_union_slices", "SELECT doc_id FROM documents WHERE lang IN ('en', 'fr') OR doc_id % 2 = 0")
def s19(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return shapes.union_slices([docs.where("lang = 'en'"), docs.where("lang = 'fr'"), docs.where("doc_id % 2 = 0")], "doc_id").select("doc_id")


# ---- drop rules --------------------------------------------------------------------------------


@query("p02_require_nonempty_key", with_views("said") + "SELECT source, count(*) FILTER (WHERE source_id % 7 <> 0 AND source_id % 11 <> 0) AS kept, count(*) FILTER (WHERE source_id % 7 = 0 OR source_id % 11 = 0) AS rejected FROM said GROUP BY source")
def p02(spark, d):
    rows = said(spark, d).withColumns({"source_id": F.when(F.col("source_id") % 7 == 0, "").otherwise(F.col("source_id").cast("string")), "raw_text": F.when(F.col("source_id") % 11 != 0, F.col("raw_text"))})
    good, bad = prepare.require_nonempty_key(rows)
    both = good.select("source", F.lit(1).alias("k")).unionByName(bad.select("source", F.lit(0).alias("k")))
    return both.groupBy("source").agg(F.count_if(F.col("k") == 1).alias("kept"), F.count_if(F.col("k") == 0).alias("rejected"))


NEAR = with_views("said") + f""", h AS (SELECT *, {HASH.replace('(t)', '(raw_text)')} AS text_sha1 FROM said),
    f AS (SELECT text_sha1, min((captured_at, source, brand, source_id)) AS o FROM h GROUP BY text_sha1),
    n AS (SELECT h.*, nullif(concat(f.o[2], ':', CAST(f.o[4] AS STRING)), concat(h.source, ':', CAST(h.source_id AS STRING))) AS near_dup_of FROM h JOIN f USING (text_sha1)),
    c AS (SELECT text_sha1, count(DISTINCT source_id) AS n_ids FROM h GROUP BY text_sha1)"""


def near(spark, d):
    return prepare.mark_near_duplicates(said(spark, d).withColumn("text_sha1", T.text_hash(F.col("raw_text"))))


def copies(spark, d):
    return prepare.mark_copies(said(spark, d).withColumn("text_sha1", T.text_hash(F.col("raw_text"))))


@query("a01_near_duplicates", NEAR + " SELECT source_id, near_dup_of FROM n")
def a01(spark, d):
    return near(spark, d).select("source_id", "near_dup_of")


@query("a02_repeat_count", NEAR + " SELECT text_sha1, n_ids FROM c")
def a02(spark, d):
    return prepare.repeat_count(near(spark, d))


ONE_BRAND = "regexp_matches(t, 'German|und') AND NOT brand = 'de'"
TWO_BRANDS = "(regexp_matches(t, 'German|und') OR regexp_matches(t, 'the')) AND NOT (brand = 'de' AND regexp_matches(t, 'German|und') OR brand = 'en' AND regexp_matches(t, 'the'))"
REASON = f"""CASE WHEN {TRIM % 't'} = '' THEN 'no_text' WHEN k < 3 THEN 'too_short' WHEN w >= 10 AND near_dup_of IS NOT NULL THEN 'near_dup'
    WHEN regexp_matches(t, '(?i)https?://|www\\.') AND k < 15 THEN 'spam' WHEN w >= 10 AND n_ids > 5 THEN 'spam'
    WHEN regexp_matches(t, '{T.GENERIC}') OR regexp_matches(t, '{T.CRASH}') THEN 'not_shopping' WHEN source = 'forum' AND @BRANDS@ THEN 'wrong_brand' END"""
SCORED = NEAR + f""", s AS (SELECT *, {REASON} AS reason FROM (SELECT n.*, raw_text AS t, CASE WHEN n_ids > 5 THEN n_ids ELSE 0 END AS n_ids,
    {WORDS % 'raw_text'} AS w, len({TOKENS % 'raw_text'}) AS k FROM n JOIN c USING (text_sha1)) x)"""
BRANDS = {"de": "German|und", "en": "the"}


def scored(spark, d):
    rows = copies(spark, d).withColumns({"utterance_text": F.col("raw_text"), "brand_fixed": F.col("source") != "forum"})
    return rows.withColumn("reason", prepare.drop_reason(BRANDS))


@query("p03_drop_reason", SCORED.replace("@BRANDS@", TWO_BRANDS) + " SELECT source_id, reason FROM s")
def p03(spark, d):
    return scored(spark, d).select("source_id", "reason")


@query("p03_drop_reason_single_brand", SCORED.replace("@BRANDS@", ONE_BRAND) + " SELECT source_id, reason FROM s")
def p03_single(spark, d):
    rows = copies(spark, d).withColumns({"utterance_text": F.col("raw_text"), "brand_fixed": F.col("source") != "forum"})
    return rows.select("source_id", prepare.drop_reason({"de": "German|und"}).alias("reason"))


@query("j13_with_repeats", NEAR + " SELECT source_id, CASE WHEN n_ids > 1 THEN n_ids ELSE 0 END AS n_ids FROM n JOIN c USING (text_sha1)")
def j13(spark, d):
    return prepare.with_repeats(near(spark, d), 1).select("source_id", "n_ids")


@query("p04_filter_utterances", SCORED.replace("@BRANDS@", TWO_BRANDS) + " SELECT source_id, coalesce(reason, 'kept') AS side, CASE WHEN reason IS NULL THEN '' ELSE substr(t, 1, 280) END AS text FROM s")
def p04(spark, d):
    kept, dropped = prepare.filter_utterances(scored(spark, d).drop("reason"), prepare.drop_reason(BRANDS))
    return kept.select("source_id", F.lit("kept").alias("side"), F.lit("").alias("text")).unionByName(dropped.select("source_id", F.col("reason").alias("side"), F.col("utterance_text").alias("text")))


@query("a03_normalise_report", NEAR + f", {TOLD.replace('FROM said', 'FROM n')} SELECT source, count(*) AS n_rows, count(near_dup_of) AS n_near_dup, count(*) FILTER (WHERE posted_at IS NULL) / count(*) AS posted_at_null_rate, count(*) FILTER (WHERE language = 'en') AS n_en FROM told GROUP BY source")
def a03(spark, d):
    rows = near(spark, d).withColumn("language", T.detect_language(F.col("raw_text")))
    out = prepare.normalise_report(rows)
    return out.withColumn("n_en", F.coalesce(F.element_at("languages", "en"), F.lit(0))).drop("languages")


DROPS = SCORED.replace("@BRANDS@", ONE_BRAND) + """, g AS (SELECT source, reason, count(*) AS n FROM s GROUP BY source, reason),
    r AS (SELECT source, sum(n) AS n_rows FROM g GROUP BY source UNION ALL SELECT NULL, sum(n) FROM g),
    k AS (SELECT source, reason, sum(n) AS n_dropped FROM g WHERE reason IS NOT NULL GROUP BY GROUPING SETS ((source, reason), (source), (reason), ()))
    SELECT k.source, k.reason, CAST(n_dropped AS BIGINT) AS n_dropped, n_dropped / n_rows AS rate FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source"""


@query("a04_drop_report", DROPS)
def a04(spark, d):
    rows = copies(spark, d).withColumns({"utterance_text": F.col("raw_text"), "brand_fixed": F.col("source") != "forum"})
    return prepare.drop_report(rows.withColumn("reason", prepare.drop_reason({"de": "German|und"})))


@query("a32_near_dup_floor", NEAR + f""", w AS (SELECT least({WORDS % 'raw_text'}, 21) AS words FROM n WHERE near_dup_of IS NOT NULL),
    l AS (SELECT f.floor, (SELECT count(*) FROM w WHERE words >= f.floor) AS left_ FROM range(1, 21) f(floor))
    SELECT CAST(min(a.floor) AS INT) AS floor FROM l a JOIN l b ON b.floor = a.floor + 1 WHERE a.left_ = b.left_""")
def a32(spark, d):
    return prepare.near_dup_floor(near(spark, d).where("near_dup_of is not null"), "raw_text")
