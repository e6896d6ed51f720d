"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, spent


def _stars(links: DataFrame) -> DataFrame:
    """One round: every node's larger neighbours, then every node's smaller ones, are tied to the least node seen."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    # in every row a > b now
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    tied = large.join(least, "a")
    return (
        tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .where("a <> b").distinct()
    )


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links(a long, b long)`` -> ``(id, component)`` for every node of a link; component is the least id reachable.

    Each round reads and writes rows in proportion to the links left (a spanning set of stars); minima are taken with
    map-side partial aggregation, so a node with very many links does not meet in one task. Null ends and self links
    are ignored; repeated links do no harm; no links give no rows.
    """
    now = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == tuple(state) or not state[0]:
            break
        mark, before = tuple(state), now
        now = cut(_stars(before))
        spent(before)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select(F.col("b"), F.col("b")).distinct())
