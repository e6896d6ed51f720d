"""Label requests and responses: validation with quarantine (never repair), pending work and consolidation of lanes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import trimmed

from .sampling import dedupe_first

LABEL = (
    "utterance_id string, tree_node string, sub_node string, opportunity_area string, temporal_stance string, "
    "hesitation_marker boolean, severity int, confidence double, evidence_quote string"
)
ITEM = f"struct<{', '.join(f'{n}:{t}' for n, t in (c.split() for c in LABEL.split(', ')))}>"
#: The vocabularies of a label.
TREE_NODES = ("R", "V", "D", "X", "none")
STANCES = ("pre_purchase", "at_purchase", "post_purchase", "unclear")
NO_AREA = "none"


def parse_label_response(payload: Column) -> Column:
    """The labels of a response: an array, or an object with ``labels`` or ``results``; null for anything else."""
    wrapped = F.from_json(payload, f"struct<labels:array<{ITEM}>,results:array<{ITEM}>>")
    return F.when(trimmed(payload).startswith("["), F.from_json(payload, f"array<{ITEM}>")).otherwise(F.coalesce(wrapped["labels"], wrapped["results"]))


def schema_faults(label: Column) -> Column:
    """Names of the label's fields that break their type, vocabulary or range."""
    bad = {
        "utterance_id": label["utterance_id"].isNull(),
        "tree_node": ~F.coalesce(label["tree_node"].isin(*TREE_NODES), F.lit(False)),
        "opportunity_area": F.coalesce(label["opportunity_area"] == "", F.lit(True)),
        "temporal_stance": ~F.coalesce(label["temporal_stance"].isin(*STANCES), F.lit(False)),
        "hesitation_marker": label["hesitation_marker"].isNull(),
        "severity": label["severity"].isNotNull() & ~label["severity"].isin(1, 2, 3),
        "confidence": ~F.coalesce(label["confidence"].between(0, 1), F.lit(False)),
        "evidence_quote": label["evidence_quote"].isNull(),
    }
    return F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in bad.items())))


def taxonomy_fault(label: Column, areas: list[str], sub_nodes: list[str] | None = None) -> Column:
    """Codes are a list of a fixed size, so they are literals."""
    fault = F.when(~label["opportunity_area"].isin(*areas, NO_AREA), "area not in taxonomy")
    if sub_nodes is not None:
        fault = fault.when(label["sub_node"].isNotNull() & ~label["sub_node"].isin(*sub_nodes), "sub-node not in vocabulary")
    return fault


def evidence_fault(label: Column, text: Column) -> Column:
    """The quote must be in the text to the letter; it may be empty where nothing is claimed."""
    quote = label["evidence_quote"]
    squeeze = lambda c: F.regexp_replace(c, r"(?U)\s+", " ")
    free = (quote == "") & ((label["opportunity_area"] == NO_AREA) | (label["confidence"] == 0))
    return F.when(free | ((quote != "") & F.contains(text, quote)), F.lit(None).cast("string")).when(quote == "", "empty quote").when(F.contains(squeeze(text), squeeze(quote)), "quote differs in white space").otherwise("quote not in text")


def ingest_labels(requests: DataFrame, responses: DataFrame, areas: list[str], sub_nodes: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(labels, quarantine) of ``requests(batch_id, utterance_id, text)`` and ``responses(batch_id, payload)``.

    In order: a response that does not parse, an id that was not asked for, a field out of its schema, a code out of the
    taxonomy, a quote that is not in the text; and an id that was asked for and not returned. Every row goes to one side.
    """
    parsed = responses.withColumn("_l", parse_label_response(F.col("payload")))
    broken = parsed.where("_l is null").select("batch_id", F.lit(None).cast("string").alias("utterance_id"), F.lit("response does not parse").alias("reason"), "payload")
    each = parsed.where("_l is not null").select("batch_id", F.explode("_l").alias("l")).withColumn("utterance_id", F.col("l.utterance_id"))
    asked = requests.select("batch_id", "utterance_id", "text")
    known = each.join(asked, ["batch_id", "utterance_id"], "left")
    faults = schema_faults(F.col("l"))
    reason = (
        F.when(F.col("text").isNull() & F.col("utterance_id").isNotNull(), "id was not asked for")
        .when(F.size(faults) > 0, F.concat(F.lit("schema: "), F.array_join(faults, ",")))
        .otherwise(F.coalesce(taxonomy_fault(F.col("l"), areas, sub_nodes), evidence_fault(F.col("l"), F.col("text"))))
    )
    scored = known.withColumn("reason", reason)
    labels = scored.where("reason is null").select("batch_id", "l.*")
    bad = scored.where("reason is not null").select("batch_id", "utterance_id", "reason", F.to_json("l").alias("payload"))
    missing = asked.join(each.select("batch_id", "utterance_id"), ["batch_id", "utterance_id"], "left_anti").join(broken.select("batch_id"), "batch_id", "left_anti")
    omitted = missing.select("batch_id", "utterance_id", F.lit("id was not returned").alias("reason"), F.lit(None).cast("string").alias("payload"))
    return labels, broken.unionByName(bad).unionByName(omitted)


def pending(rows: DataFrame, done: DataFrame, version: str, id: str = "utterance_id") -> DataFrame:
    """Rows that this version of the classifier has not labelled."""
    return rows.join(done.where(F.col("classifier_version") == version).select(id), id, "left_anti")


def build_requests(rows: DataFrame, template: str, text: str = "text") -> DataFrame:
    """``batch_id, payload, est_tokens`` of rows with a batch_id: the template with its batch as JSON in ``{items}``."""
    from opinara.functions.text import estimate_tokens

    items = F.to_json(F.array_sort(F.collect_list(F.struct(F.col("utterance_id").alias("id"), F.col(text).alias("text")))))
    out = rows.groupBy("batch_id").agg(items.alias("_i"))
    return out.select("batch_id", F.replace(F.lit(template), F.lit("{items}"), F.col("_i")).alias("payload")).withColumn("est_tokens", estimate_tokens(F.col("payload"), 0.5))


CARRIED = ("opportunity_area", "temporal_stance", "severity", "confidence", "hesitation_marker")


def overlay(a: DataFrame, b: DataFrame, columns: tuple[str, ...], id: str = "utterance_id") -> DataFrame:
    """Lane A with each non-null value of lane B put over it, and ``escalated``."""
    low = b.select(F.col(id).alias("_id"), *(F.col(c).alias(f"_b_{c}") for c in columns))
    both = a.join(low, F.col(id) == F.col("_id"), "left")
    return both.withColumns({"escalated": F.col("_id").isNotNull(), **{c: F.coalesce(f"_b_{c}", c) for c in columns}}).drop("_id", *(f"_b_{c}" for c in columns))


def beside(merged: DataFrame, c: DataFrame, columns: tuple[str, ...] = CARRIED, id: str = "utterance_id", prefix: str = "laneC_") -> DataFrame:
    """A second annotator's values in columns of their own, never merged."""
    return merged.join(c.select(id, *(F.col(x).alias(prefix + x) for x in columns)), id, "left")


def consolidate(a: DataFrame, b: DataFrame, c: DataFrame, columns: tuple[str, ...], id: str = "utterance_id", order: str = "labelled_at") -> DataFrame:
    """The first label of each id in each lane, lane B over lane A, lane C beside."""
    a, b, c = (dedupe_first(x, id, (order,)) for x in (a, b, c))
    return beside(overlay(a, b, columns, id), c, tuple(x for x in columns), id)


def dedupe_report(lanes: dict[str, DataFrame], id: str = "utterance_id") -> DataFrame:
    """``lane, n_read, n_kept, n_dropped``."""
    parts = [df.select(F.lit(lane).alias("lane"), F.col(id).alias("_id")) for lane, df in lanes.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    out = rows.groupBy("lane").agg(F.count("*").alias("n_read"), F.count_distinct("_id").alias("n_kept"))
    return out.withColumn("n_dropped", F.col("n_read") - F.col("n_kept"))


def quarantine_rate(quarantine: DataFrame, requested: DataFrame, lane: str = "lane") -> DataFrame:
    """``lane, reason, n, rate`` of requested rows."""
    asked = requested.groupBy(lane).agg(F.count("*").alias("_asked"))
    return quarantine.groupBy(lane, "reason").agg(F.count("*").alias("n")).join(asked, lane).select(lane, "reason", "n", (F.col("n") / F.col("_asked")).alias("rate"))
