"""Connected components of a link table, without gathering it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.runtime import materialise

#: Rounds after which a run that hasn't settled is given up: far more than the logarithm of any diameter.
MAX_ROUNDS = 50


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): component is the least id that can be reached.

    Alternating large-star and small-star steps: each id hands the least id of its neighbourhood to its neighbours, so the
    rounds grow with the logarithm of the component's diameter. Each round is written, and the loop ends when a round changes
    nothing. Self-links and repeated links are harmless, nulls are dropped.
    """
    edges = links.select(F.col("a").alias("a"), F.col("b").alias("b")).where("a is not null and b is not null").distinct()
    edges = materialise(edges, "links")
    ids = edges.select("a").union(edges.select("b")).distinct().withColumnRenamed("a", "id")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = materialise(_small_star(_large_star(edges)), "star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"the components didn't settle within {MAX_ROUNDS} rounds")
    least = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return ids.join(least, "id", "left").select("id", F.least("id", F.coalesce("component", "id")).alias("component"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b"), F.col("a")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each id links its larger neighbours to its least neighbour or itself. As (a, b) with a > b."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))
    return both.where("b > a").join(least, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each id links itself and its smaller neighbours to its least neighbour."""
    down = _both(edges).where("b < a")
    least = down.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_m"))
    joined = down.join(least, F.col("a") == F.col("_a"))
    return joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).union(joined.select(F.col("a"), F.col("_m").alias("b"))).where("a <> b").distinct()
