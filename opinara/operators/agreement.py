"""Agreement of annotators, always from a contingency table: after one shuffle only its few cells are left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.stats import landis_koch, two_proportion_z

LABEL = lambda c: F.regexp_replace(c.cast("string"), r"^(-?\d+)\.0+$", "$1")  # noqa: E731  2 and 2.0 are one label


def contingency(df: DataFrame, fields: dict[str, tuple[Column, Column]], weight: Column | None = None) -> DataFrame:
    """``field, a, b, w``: all fields at once; pairs with a null are left out."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), LABEL(a).alias("a"), LABEL(b).alias("b")) for f, (a, b) in fields.items())))
    rows = df.select((weight if weight is not None else F.lit(1.0)).cast("double").alias("w"), each.alias("x")).select("x.*", "w")
    return rows.where("a is not null and b is not null").groupBy("field", "a", "b").agg(F.sum("w").alias("w"), F.count("*").alias("n"))


def agreement(table: DataFrame, floor: float = 0.61) -> DataFrame:
    """Of a contingency table for each field: n, observed agreement, Cohen's kappa with error, interval and band, Gwet's
    AC1, and whether the two are in paradox (observed 0.80 or more while kappa is under the floor)."""
    f = Window.partitionBy("field")
    cells = table.withColumn("t", F.sum("w").over(f))
    a = cells.groupBy("field", F.col("a").alias("v")).agg(F.sum(F.col("w") / F.col("t")).alias("pa"))
    b = cells.groupBy("field", F.col("b").alias("v")).agg(F.sum(F.col("w") / F.col("t")).alias("pb"))
    both = a.join(b, ["field", "v"], "full").select("field", F.coalesce("pa", F.lit(0.0)).alias("pa"), F.coalesce("pb", F.lit(0.0)).alias("pb"))
    pi = (F.col("pa") + F.col("pb")) / 2
    chance = both.groupBy("field").agg(F.sum(F.col("pa") * F.col("pb")).alias("expected"), F.sum(pi * (1 - pi)).alias("_g"), F.count("*").alias("q"))
    seen = cells.groupBy("field").agg(F.sum("n").alias("n"), F.sum("w").alias("total"), F.sum(F.when(F.col("a") == F.col("b"), F.col("w")).otherwise(0.0)).alias("_same"))
    out = seen.join(chance, "field").withColumn("observed", F.col("_same") / F.col("total"))
    kappa = F.when(F.col("expected") < 1, (F.col("observed") - F.col("expected")) / (1 - F.col("expected")))
    error = F.when(F.col("expected") < 1, F.sqrt(F.col("observed") * (1 - F.col("observed")) / (F.col("total") * F.pow(1 - F.col("expected"), 2))))
    gamma = F.when(F.col("q") > 1, F.col("_g") / (F.col("q") - 1))
    out = out.withColumns({"kappa": kappa, "se": error, "ac1": F.when(gamma < 1, (F.col("observed") - gamma) / (1 - gamma))})
    return out.select(
        "field", "n", "observed", "expected", "kappa", "se", (F.col("kappa") - 1.96 * F.col("se")).alias("ci_low"), (F.col("kappa") + 1.96 * F.col("se")).alias("ci_high"),
        landis_koch(F.col("kappa")).alias("kappa_band"), "ac1", landis_koch(F.col("ac1")).alias("ac1_band"),
        F.coalesce((F.col("observed") >= 0.8) & (F.col("kappa") < floor), F.lit(False)).alias("kappa_paradox"),
    )


def annotator_agreement(df: DataFrame, fields: tuple[str, ...], prefix: str = "laneC_") -> DataFrame:
    """A23 for each field of the merged lanes against the second annotator's columns."""
    return agreement(contingency(df, {f: (F.col(f), F.col(prefix + f)) for f in fields}))


def human_agreement(gold: DataFrame, model: DataFrame, fields: tuple[str, ...], weight: str | None = None, id: str = "utterance_id") -> DataFrame:
    """Gold against model, joined on the id; ``weight`` is a column of the gold sheet."""
    both = gold.alias("g").join(model.alias("m"), id, "left")
    return agreement(contingency(both, {f: (F.col(f"g.{f}"), F.col(f"m.{f}")) for f in fields}, F.col(f"g.{weight}") if weight else None))


def precision(df: DataFrame, model: Column, human: Column) -> DataFrame:
    out = df.agg(F.count_if(model & human).alias("n_true"), F.count_if(model).alias("n_claimed"))
    return out.withColumn("precision", F.col("n_true") / F.nullif("n_claimed", F.lit(0)))


def reliability_gate(per_field: DataFrame, floor: float = 0.61) -> DataFrame:
    """One row: PASS if every field's kappa reaches the floor, and the fields that do not."""
    bad = F.coalesce(F.col("kappa") < floor, F.lit(True))
    out = per_field.agg(F.array_sort(F.collect_list(F.when(bad, F.col("field")))).alias("failing"))
    return out.withColumn("verdict", F.when(F.size("failing") == 0, "PASS").otherwise("FAIL"))


def disagreement_flag(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    out = F.lit(False)
    for x, y in zip(a, b, strict=True):
        out = out | ~x.eqNullSafe(y)
    return out


def sweep_tau(df: DataFrame, correct: Column, confidence: str = "confidence") -> tuple[DataFrame, DataFrame]:
    """(accuracy of each tenth of confidence, tau): tau is the highest tenth that is less accurate than all together."""
    bucket = F.bround(F.col(confidence) * 10, 0) / 10
    per = df.groupBy(bucket.alias("bucket")).agg(F.sum(correct.cast("int")).alias("n_correct"), F.count("*").alias("n"))
    mean = F.sum("n_correct").over(Window.partitionBy()) / F.sum("n").over(Window.partitionBy())  # over 11 rows
    out = per.withColumn("mean", mean).withColumn("accuracy", F.col("n_correct") / F.col("n"))
    return out, out.where("accuracy < mean").agg(F.max("bucket").alias("tau"))


def batch_stability_sweep(runs: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``runs(utterance_id, batch, repeat, label)`` -> for each batch size its agreement with the smallest size's first
    run, omissions, and a z test against the run-to-run floor (the smallest size's second run); ``eligible`` sizes do not
    fall significantly below the floor and omit nothing, and the largest of them is ``chosen``."""
    least = runs.agg(F.min("batch").alias("_least"))
    marked = runs.join(F.broadcast(least))  # one row
    ref = marked.where("batch = _least and repeat = 1").select("utterance_id", F.col("label").alias("_ref"))
    both = ref.join(marked.where("repeat = 1 or batch = _least"), "utterance_id")
    per = both.groupBy("batch", "repeat").agg(F.count_if(F.col("label").eqNullSafe(F.col("_ref"))).alias("x"), F.count("label").alias("n"), F.first("_least").alias("_least"))
    asked = ref.agg(F.count("*").alias("asked"))
    floor = per.where("batch = _least and repeat = 2").select(F.col("x").alias("_fx"), F.col("n").alias("_fn"))
    out = per.where("repeat = 1").join(F.broadcast(floor)).join(F.broadcast(asked))
    z, p = two_proportion_z(F.col("x"), F.col("n"), F.col("_fx"), F.col("_fn"))
    out = out.withColumns({"agreement": F.col("x") / F.col("n"), "floor": F.col("_fx") / F.col("_fn"), "omitted": F.col("asked") - F.col("n"), "p": p})
    out = out.withColumn("eligible", ~F.coalesce((F.col("p") < alpha) & (F.col("agreement") < F.col("floor")), F.lit(False)) & (F.col("omitted") == 0))
    best = F.max(F.when(F.col("eligible"), F.col("batch"))).over(Window.partitionBy())  # a row for each size
    return out.withColumn("chosen", F.coalesce(F.col("batch") == best, F.lit(False))).select("batch", "n", "agreement", "floor", "omitted", "p", "eligible", "chosen")


def batch_accuracy_sweep(runs: DataFrame, gold: DataFrame) -> DataFrame:
    """``batch, n, n_correct, accuracy, p``: accuracy of each batch size against gold, and its z test against the least."""
    both = runs.where("repeat = 1").join(gold.select("utterance_id", F.col("label").alias("_gold")), "utterance_id")
    per = both.groupBy("batch").agg(F.count("label").alias("n"), F.count_if(F.col("label") == F.col("_gold")).alias("n_correct"))
    first = per.agg(F.min_by(F.struct("n_correct", "n"), "batch").alias("_f"))
    out = per.join(F.broadcast(first))
    _, p = two_proportion_z(F.col("n_correct"), F.col("n"), F.col("_f.n_correct"), F.col("_f.n"))
    return out.select("batch", "n", "n_correct", (F.col("n_correct") / F.col("n")).alias("accuracy"), p.alias("p"))
