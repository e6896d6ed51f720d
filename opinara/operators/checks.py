"""Checks of tables and texts. Each gives rows that say what is wrong."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions.text import placeholder_kinds, trimmed

CANON = lambda c: F.regexp_replace(F.trim(c.cast("string")), r"^(-?\d+)\.0+$", "$1")


def check_gold(df: DataFrame, vocabularies: dict[str, list[str]], required: tuple[str, ...], area: str = "opportunity_area", severity: str = "severity", free: str = "none") -> DataFrame:
    """``check, level, detail, n`` of a labelled sheet: missing columns, values out of vocabulary (2.0 is 2), severity
    without an area or the other way round (problems), and columns with one value only (warnings)."""
    spark, there = df.sparkSession, set(df.columns)
    missing = [(c,) for c in required if c not in there]
    out = spark.createDataFrame(missing, "detail string").select(F.lit("missing column").alias("check"), F.lit("problem").alias("level"), "detail", F.lit(1).cast("long").alias("n"))
    fields = [c for c in vocabularies if c in there]
    if fields:
        pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("f"), CANON(F.col(c)).alias("v")) for c in fields)))
        allowed = F.create_map(*(x for c in fields for x in (F.lit(c), F.array(*map(F.lit, vocabularies[c])))))
        seen = df.select(pairs.alias("p")).select("p.*").where("v is not null and v <> ''").groupBy("f", "v").agg(F.count("*").alias("n"))
        odd = seen.where(~F.array_contains(F.element_at(allowed, F.col("f")), F.col("v")))
        out = out.unionByName(odd.select(F.lit("out of vocabulary").alias("check"), F.lit("problem").alias("level"), F.concat_ws("=", "f", "v").alias("detail"), "n"))
        constant = seen.groupBy("f").agg(F.count("*").alias("_k"), F.sum("n").alias("n")).where("_k = 1")
        out = out.unionByName(constant.select(F.lit("constant column").alias("check"), F.lit("warning").alias("level"), F.col("f").alias("detail"), "n"))
    if {area, severity} <= there:
        with_severity = F.coalesce(CANON(F.col(severity)), F.lit("")) != ""
        with_area = F.coalesce(F.col(area), F.lit(free)) != free
        detail = F.when(with_severity & ~with_area, "severity without area").when(with_area & ~with_severity, "area without severity")
        odd = df.select(detail.alias("detail")).where("detail is not null").groupBy("detail").agg(F.count("*").alias("n"))
        out = out.unionByName(odd.select(F.lit("severity").alias("check"), F.lit("problem").alias("level"), "detail", "n"))
    return out


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where ``bad`` is true; ``detail`` says with what."""

    name: str
    bad: Column
    detail: Column


def required(column: str) -> Rule:
    return Rule(f"required {column}", F.coalesce(F.trim(F.col(column).cast("string")), F.lit("")) == "", F.lit("empty"))


def one_of(column: str, values: list) -> Rule:
    return Rule(f"allowed {column}", F.col(column).isNotNull() & ~F.col(column).isin(*values), F.col(column).cast("string"))


def between(column: str, low: float, high: float) -> Rule:
    return Rule(f"range {column}", ~F.col(column).between(low, high), F.col(column).cast("string"))


def needs(flag: Column, column: str) -> Rule:
    """Where the flag is set, the column (as a rationale) must be filled."""
    return Rule(f"needs {column}", flag & (F.coalesce(F.col(column).cast("string"), F.lit("")) == ""), F.lit("empty"))


def prefixed(column: str, prefix: str) -> Rule:
    return Rule(f"prefix {column}", ~F.col(column).startswith(prefix), F.col(column).cast("string"))


def at_most(column: str, length: int) -> Rule:
    return Rule(f"length {column}", F.length(column) > length, F.length(column).cast("string"))


def check_constraints(df: DataFrame, key: str, rules: list[Rule], unique: bool = True, references: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """``rule, key, detail``: a row for each rule that a row breaks, all rules in one pass; keys that repeat; and values
    of a column that a referenced table's column does not hold."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(r.bad, F.lit(False)), F.struct(F.lit(r.name).alias("rule"), F.col(key).cast("string").alias("key"), F.coalesce(r.detail, F.lit("")).alias("detail"))) for r in rules)))
    out = df.select(F.explode(found).alias("x")).select("x.*")
    if unique:
        again = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
        out = out.unionByName(again.select(F.lit(f"unique {key}").alias("rule"), F.col(key).cast("string").alias("key"), F.col("n").cast("string").alias("detail")))
    for column, (table, other) in (references or {}).items():
        lost = df.where(F.col(column).isNotNull()).join(table.select(F.col(other).alias("_o")).distinct(), F.col(column) == F.col("_o"), "left_anti")
        out = out.unionByName(lost.select(F.lit(f"reference {column}").alias("rule"), F.col(key).cast("string").alias("key"), F.col(column).cast("string").alias("detail")))
    return out


def placeholder_findings(texts: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """``file, line, kind, text`` for each line and pattern."""
    lines = texts.select(F.col(file).alias("file"), F.posexplode(F.split(F.col(text), "\n")).alias("_n", "_t"))
    return lines.select("file", (F.col("_n") + 1).alias("line"), F.explode(placeholder_kinds(F.col("_t"))).alias("kind"), F.substring(trimmed(F.col("_t")), 1, 200).alias("text"))


def placeholder_sweep(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """The findings in all text files at ``path``; ``strict`` raises if there are any."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    out = placeholder_findings(files)
    if strict and (first := out.limit(5).collect()):
        raise ValueError(f"placeholders left: {[tuple(r) for r in first]}")
    return out


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row that says what a table holds whatever the order of its rows: the number of rows, and the exclusive or and
    sum of 60 bits of each row's MD5. A null is told apart from an empty value."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns or df.columns]
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 15), 16, 10).cast("long")
    return df.agg(F.count("*").alias("n_rows"), F.bit_xor(h).alias("mixed"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("summed"))


def frozen(df: DataFrame, recorded: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``unchanged``: whether the table is as it was when its fingerprint was recorded."""
    now, then = table_fingerprint(df, columns), recorded.select(*(F.col(c).alias(f"_{c}") for c in ("n_rows", "mixed", "summed")))
    same = F.lit(True)
    for c in ("n_rows", "mixed", "summed"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return now.join(then).select(same.alias("unchanged"))  # two single rows


def offending_values(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Values seen that are not allowed."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().join(allowed.select(F.col(allowed.columns[0]).alias(column)), column, "left_anti")


def missing_ids(asked: DataFrame, returned: DataFrame, id: str = "utterance_id") -> DataFrame:
    """Ids that were asked for and did not come back, each once."""
    return asked.select(id).distinct().join(returned.select(id), id, "left_anti")


def common_ids(first: DataFrame, second: DataFrame, id: str = "utterance_id") -> DataFrame:
    """Ids that both tables hold, each once: the pairs that can be compared."""
    return first.select(id).distinct().join(second.select(id), id, "left_semi")
