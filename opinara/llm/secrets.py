"""Secret scanning over an incremental blob ledger.

Every version of a text is content-addressed by its SHA-256. The ledger, a Parquet table, holds one row for each pair of
blob and rule version scanned so far, with its findings. A scan addresses the given versions, drops pairs that the ledger
has, searches the remaining blobs once each, appends them, and joins the findings back to every path of a blob. Rules are
regular expressions; a match counts if the characters of its ``group`` number ``least`` or more. Offsets are code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_dir


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The three base kinds in order, then further kinds of this rule version.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),  # a longest run of 20 characters or more
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES, RULE_VERSION = BASE_RULES + MORE_RULES, "1"
#: Parts into which the paths of one blob are dealt when findings join back to them.
SALTS = 64
SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string>"


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's spans in a text as ``array<struct<start,rank,end,kind>>``: leftmost, not overlapping, end exclusive.

    The pieces between matches and the matches alternate, so an offset is the length of all that comes before.
    """
    none = F.array().cast(f"array<{SPAN}>")
    between = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x).cast("long"))
    found = F.arrays_zip(
        between.alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda x: F.length(x).cast("long")).alias("size"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length).alias("part"),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    walked = F.aggregate(
        found,
        start,
        lambda acc, m: F.struct(
            (acc["at"] + m["gap"] + F.coalesce(m["size"], F.lit(0))).alias("at"),
            F.when(
                m["part"] >= rule.least,
                F.concat(acc["out"], F.array(F.struct((acc["at"] + m["gap"]).alias("start"), F.lit(rank).alias("rank"), (acc["at"] + m["gap"] + m["size"]).alias("end"), F.lit(rule.kind).alias("kind")))),
            ).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(rule.pattern), walked).otherwise(none)


def joined(found: Column) -> Column:
    """``kind:start:end`` by start, then by the rules' order, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(versions: DataFrame, ledger: str | None = None, *, rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION, path: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """Scan ``versions`` (one row for each path and version of its text) and return findings for each row, and the ledger.

    Result: the path column, ``blob`` (SHA-256 of the text), ``found`` (array of start, rank, end, kind by start, then
    rank). A null text is the empty blob; very long texts are searched whole; repeated rows and paths give a row each; ties
    in start go by the rules' order; an empty table gives none; other columns are ignored. Running again with the same ledger and rule version searches nothing.
    """
    spark = versions.sparkSession
    ledger = ledger or shared_dir(spark)
    given = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    given = given.withColumn("blob", F.sha2("text", 256))
    try:
        known = spark.read.parquet(ledger).where(F.col("rule_version") == rule_version).select("blob")
    except Exception as error:  # no ledger yet; Spark names the reason in its error class
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        known = spark.createDataFrame([], "blob string")
    new = cut(given.groupBy("blob").agg(F.min("path").alias("path")).join(known, "blob", "left_anti"))
    # one path stands for the blob, so that only its text is moved and searched
    texts = given.alias("g").join(new.alias("n"), (F.col("g.blob") == F.col("n.blob")) & F.col("g.path").eqNullSafe(F.col("n.path")), "left_semi")
    found = F.array_sort(F.concat(*(spans(F.col("text"), rule, k) for k, rule in enumerate(rules))))
    searched = texts.select("blob", found.alias("found"))
    searched = searched.groupBy("blob").agg(F.first("found").alias("found"), F.lit(rule_version).alias("rule_version"))
    searched.write.mode("append").parquet(ledger)
    # two scans at a time may both have appended a blob; a blob may be a third of all rows, so each with findings goes to
    # every one of SALTS parts of its paths, and those without go nowhere
    hits = spark.read.parquet(ledger).where((F.col("rule_version") == rule_version) & (F.size("found") > 0))
    hits = hits.groupBy("blob").agg(F.first("found").alias("found")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    paths = given.select("path", "blob", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int").alias("_salt"))
    none = F.array().cast(f"array<{SPAN}>")
    return paths.join(hits, ["blob", "_salt"], "left").select(F.col("path").alias(path), "blob", F.coalesce("found", none).alias("found")), ledger
