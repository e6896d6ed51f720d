"""The registered queries of this subpackage, one for each operator, each over its whole table, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embed_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import KINDS, pseudonymise

    # the tables of the registered queries are made up, so this query's own key need be no secret
    key = spark.conf.get("spark.opinara.pii.key", "a key for made-up tables").encode()
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key=key).select("doc_id", "text", *(f"n_{k}" for k in KINDS))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_quality import judge

    return judge(table(spark, sf_dir, "documents")).drop("drop_lines")


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .katz import katz_scores

    return katz_scores(table(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_store import read_documents, write_token_files

    out, manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return read_documents(spark, out, manifest)


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import joined, scan

    found, _ = scan(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["rank"] < 3)
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_diff import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import verify_documents

    return verify_documents(table(spark, sf_dir, "documents")).drop("copied")


def op13_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .period_runs import repeated, run_digests

    return run_digests(repeated(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_embedding_dedup, op3_pii_pseudonyms, op4_line_quality, op5_katz_scores, op6_token_store, op7_secret_ledger, op8_byte_bpe, op9_page_text, op10_source_mix, op11_token_counts, op12_merkle_manifest, op13_period_runs)}


def _secret_spans() -> str:
    """All spans of all rules in DuckDB: the pieces between matches and the matches alternate. Its ``(?i)`` knows more
    letters than A-Z, so letters in either case are written as classes."""
    either = {w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")}
    each = []
    for rank, (kind, pattern, group, least) in enumerate((
        ("assign", f"""({'|'.join(either.values())})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 20),
        ("hex", "[0-9a-f]+", 0, 24),
        ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
        ("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}", 0, 1),
        ("forge", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    )):
        each.append(f"SELECT r, {rank} AS rank, '{kind}' AS kind, {least} AS least, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found, regexp_extract_all(t, '{pattern}', {group}) AS parts FROM d")
    return " UNION ALL ".join(each)



#: The CRC-32 of a decimal doc_id in DuckDB, bit by bit.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda c, b:
    list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT)"""


def _leaf(more: str) -> str:
    said = ", ".join(f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in ("doc_id", "source", "lang", f"n_chars{more}", "text"))
    return f"sha256(concat({said}))"


#: SQL of those operators that it can express at all: no keyed permutation, model, file format or merge order.
ORACLES: dict[str, str] = {
    "op7_secret_ledger": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), x AS ({_secret_spans()}),
        m AS (SELECT r, rank, kind, least, unnest(gaps[:len(found)]) AS gap, unnest(found) AS f, unnest(parts) AS part, generate_subscripts(found, 1) AS i FROM x WHERE len(found) > 0),
        e AS (SELECT *, sum(length(gap) + length(f)) OVER (PARTITION BY r, rank ORDER BY i) AS stop FROM m),
        s AS (SELECT r, rank, kind, CAST(stop - length(f) AS BIGINT) AS start, concat_ws(':', kind, CAST(stop - length(f) AS BIGINT), CAST(stop AS BIGINT)) AS span FROM e WHERE length(part) >= least)
        SELECT any_value(doc_id) AS doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
            sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans FROM d LEFT JOIN s USING (r) GROUP BY r""",
    "op10_source_mix": r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
        k AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS src FROM d GROUP BY source),
        l AS (SELECT *, CAST(([3, 1, 2])[1 + (src - 1) % 3] AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS most FROM k),
        q AS (SELECT *, most / weight AS full_at, CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(most) OVER o, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS shares
            FROM l WINDOW o AS (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        v AS (SELECT first(rest / shares ORDER BY full_at, src) AS level FROM q WHERE rest / shares <= full_at),
        t AS (SELECT src, source, source_size, CASE WHEN level IS NULL OR full_at < level THEN most ELSE weight * level END AS target FROM q, v),
        n AS (SELECT CAST(floor(sum(target) / 256) AS BIGINT) AS seats FROM t),
        -- blocks of sources, of their shards' parents and of shards, each by highest quotients
        b1 AS (SELECT src, s FROM (SELECT src, target, unnest(range(seats)) AS s, seats FROM t, n WHERE target > 0) QUALIFY row_number() OVER (ORDER BY target / (2 * s + 1) DESC, src, s) <= seats),
        b AS (SELECT t.*, (SELECT count(*) FROM b1 WHERE b1.src = t.src) AS blocks, greatest(1, CAST(ceil(source_size / 65536) AS BIGINT)) AS shards FROM t),
        p AS (SELECT d.*, b.src, b.source_size, b.target, b.blocks, CAST('0x' || substr(md5(concat_ws('|', doc_id, '7')), 1, 12) AS BIGINT) % shards AS shard FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
        h AS (SELECT src, shard, shard % 1024 AS parent, any_value(source) AS source, any_value(blocks) AS blocks, CAST(sum(size) AS BIGINT) AS words FROM p GROUP BY src, shard),
        a AS (SELECT src, parent, CAST(sum(words) AS DOUBLE) AS votes, any_value(blocks) AS blocks FROM h GROUP BY src, parent),
        a1 AS (SELECT src, parent, s FROM (SELECT *, unnest(range(blocks)) AS s FROM a WHERE votes > 0) QUALIFY row_number() OVER (PARTITION BY src ORDER BY votes / (2 * s + 1) DESC, parent, s) <= blocks),
        a2 AS (SELECT src, parent, count(*) AS seats FROM a1 GROUP BY src, parent),
        h1 AS (SELECT src, shard, s FROM (SELECT h.*, seats, unnest(range(seats)) AS s FROM h JOIN a2 USING (src, parent) WHERE words > 0) QUALIFY row_number() OVER (PARTITION BY src, parent ORDER BY CAST(words AS DOUBLE) / (2 * s + 1) DESC, shard, s) <= seats),
        h2 AS (SELECT src, shard, count(*) AS quota FROM h1 GROUP BY src, shard),
        u AS (SELECT h.*, 256 * coalesce(quota, 0) AS due, least(2, 256 * coalesce(quota, 0) // greatest(words, 1)) AS passes, CAST(ceil(words / 256) AS BIGINT) AS parts FROM h LEFT JOIN h2 USING (src, shard)),
        -- the shard's further blocks, by a seeded order
        w AS (SELECT *, CASE WHEN passes >= 2 THEN 0 ELSE least(parts, round((due - passes * words) / 256)) END AS extra FROM u),
        c AS (SELECT src, shard, i FROM (SELECT *, unnest(range(parts)) AS i FROM w) QUALIFY row_number() OVER (PARTITION BY src, shard ORDER BY md5(concat_ws('|', source, shard, i, '8')), i) <= extra),
        z AS (SELECT *, CAST(sum(size) OVER (PARTITION BY src, shard ORDER BY md5(concat_ws('|', doc_id, '9')), doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM p),
        y AS (SELECT z.r, sum(least(stop, 256 * (i + 1)) - greatest(stop - size, 256 * i)) AS words FROM z JOIN c ON z.src = c.src AND z.shard = c.shard AND 256 * i < stop AND 256 * (i + 1) > stop - size WHERE size > 0 GROUP BY z.r)
        SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN CAST(passes * size + coalesce(y.words, 0) AS BIGINT) ELSE 0 END AS taken FROM z JOIN w ON z.src = w.src AND z.shard = w.shard LEFT JOIN y USING (r)""",
    "op1_ngram_join": r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2])) END) AS s FROM w),
        f AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT r.id, p.b FROM r JOIN p ON r.c = p.a)
        SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(c) AS component_id FROM s JOIN r ON r.id = s.doc_id GROUP BY s.doc_id, len(s)""",
    "op4_line_quality": r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, coalesce(text, '') AS t FROM documents),
        w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
        s AS (SELECT r, CASE WHEN len(w) < 6 THEN [] ELSE list_transform(range(1, len(w) - 3), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4])) END AS s FROM w),
        g AS (SELECT r, unnest(s) AS g, generate_subscripts(s, 1) AS i FROM s),
        c AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1), range(5) o(k) GROUP BY r),
        x AS (SELECT r, source, coalesce(md5(text), '') AS m, unnest(list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(lower(t), '[\x09\x0B-\x0D]', ' ', 'g'), '[0-9]+', '0', 'g'), ' {2,}', ' ', 'g'), chr(10)), lambda v: trim(v, ' ')), lambda v: v <> '')) AS x FROM d),
        h AS (SELECT source, count(DISTINCT coalesce(md5(text), '')) AS a FROM d GROUP BY source),
        f AS (SELECT x.source, x.x FROM x JOIN h ON x.source IS NOT DISTINCT FROM h.source GROUP BY x.source, x.x, h.a HAVING count(DISTINCT m) > 5 AND count(DISTINCT m) > 0.002::DOUBLE * h.a),
        b AS (SELECT x.r, count(*) AS n, sum(len(string_split(x.x, ' '))) AS gone FROM x JOIN f ON x.x = f.x AND x.source IS NOT DISTINCT FROM f.source GROUP BY x.r),
        m AS (SELECT d.doc_id, len(w.w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            len(w.l) - len(list_distinct(w.l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(b.n, 0) AS n_removed_lines, CAST(len(w.w) - coalesce(b.gone, 0) AS BIGINT) AS n_left_words, b.n IS NOT NULL AS hit
            FROM d JOIN w USING (r) LEFT JOIN c USING (r) LEFT JOIN b USING (r))
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
            n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, CAST(n_removed_lines AS BIGINT) AS n_removed_lines, n_left_words,
            NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (hit AND (n_left_words < 10 OR n_left_words < 0.3::DOUBLE * n_words)) AS kept FROM m""",
    "op2_embedding_dedup": """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(list_filter(embedding, lambda x: x <> 0)) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        r AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION SELECT r.id, p.b FROM r JOIN p ON r.c = p.a)
        SELECT e.vec_id, (SELECT count(*) FROM p WHERE a = e.vec_id) AS n_links, min(c) AS component_id, min(c) = e.vec_id AS kept FROM embeddings e JOIN r ON r.id = e.vec_id GROUP BY e.vec_id""",
    "op12_merkle_manifest": f"""WITH RECURSIVE d AS (SELECT doc_id, lang, {_leaf('')} AS leaf, CASE WHEN {CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf(' + 1')} END AS tampered FROM documents),
        x AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
        t AS (SELECT lang, 0 AS lvl, pos, leaf AS h, n FROM x UNION ALL SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
        s AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
        u AS (SELECT 0 AS lvl, pos, h, n FROM s UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, pos // 2, n),
        y AS (SELECT x.*, s.pos AS over, s.h AS subroot FROM x JOIN s ON x.lang IS NOT DISTINCT FROM s.lang),
        z AS (SELECT r, l.lvl AS seq, t.h AS sib, y.pos // (1 << l.lvl) % 2 = 1 AS behind FROM y JOIN (SELECT DISTINCT lang, lvl FROM t WHERE n > 1) l ON l.lang IS NOT DISTINCT FROM y.lang
                LEFT JOIN t ON t.lang IS NOT DISTINCT FROM y.lang AND t.lvl = l.lvl AND t.pos = xor(y.pos // (1 << l.lvl), 1)
            UNION ALL SELECT r, 1000 + l.lvl, u.h, over // (1 << l.lvl) % 2 = 1 FROM y CROSS JOIN (SELECT DISTINCT lvl FROM u WHERE n > 1) l LEFT JOIN u ON u.lvl = l.lvl AND u.pos = xor(over // (1 << l.lvl), 1)),
        k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY seq) AS i FROM z),
        f AS (SELECT r, 0 AS i, coalesce(tampered, leaf) AS h FROM x
            UNION ALL SELECT f.r, f.i + 1, CASE WHEN sib IS NULL THEN sha256(h) WHEN behind THEN sha256(sib || h) ELSE sha256(h || sib) END FROM f JOIN k ON k.r = f.r AND k.i = f.i + 1)
        SELECT doc_id, leaf, subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(coalesce(p.said, '')) AS proof_sha256, g.h AS folded_root, g.h = (SELECT h FROM u WHERE n = 1) AS verified
            FROM y LEFT JOIN (SELECT r, string_agg(sib, '' ORDER BY seq) AS said FROM k GROUP BY r) p USING (r) JOIN (SELECT r, arg_max(h, i) AS h FROM f GROUP BY r) g USING (r)""",
    "op13_period_runs": rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {CRC} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        a AS (SELECT *, h // 10 AS g, len(w) AS n, CASE WHEN len(w) > 0 THEN h // 10 % len(w) END AS a FROM d),
        x AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM a),
        -- a run's words equal those one period on for 5 words or more, so its 5-word windows meet at that distance on end
        s AS (SELECT r, n, unnest(range(n - 4)) AS i, unnest(list_transform(range(1, n - 3), lambda i: md5(array_to_string(w[i : i + 4], ' ')))) AS s FROM x WHERE n > 5),
        p AS (SELECT a.r, a.i, b.i - a.i AS q FROM s a JOIN s b ON a.r = b.r AND a.s = b.s AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
        m AS (SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM p) GROUP BY r, q, k HAVING count(*) + 4 >= 3 * q),
        u AS (SELECT r, start, length, min(q) AS period FROM m GROUP BY r, start, length),
        o AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM u),
        c AS (SELECT v.r, string_agg(v.w, ' ' ORDER BY v.i) AS said FROM (SELECT r, unnest(w) AS w, unnest(range(n)) AS i FROM x) v ANTI JOIN o ON o.r = v.r AND o.i = v.i GROUP BY v.r),
        b AS (SELECT r, count(*) AS n_runs, first(start ORDER BY length / period DESC, start, period) AS start, first(length ORDER BY length / period DESC, start, period) AS length, first(period ORDER BY length / period DESC, start, period) AS period,
            string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS said FROM u GROUP BY r)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(b.said, '')) AS runs_sha256, sha256(coalesce(c.said, '')) AS collapsed_sha256 FROM x LEFT JOIN b USING (r) LEFT JOIN c USING (r)""",
}
