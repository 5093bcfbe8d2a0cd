"""Sources mixed to target weights (problem 9).

Temperature mixing: the token shares t of the sources are bent towards the targets q by an exponent, w = t**(1-a) * q**a, normalised.
Bisection finds the greatest exponent at which no source is repeated more often than allowed (or the one of a wanted entropy).
The weights become token budgets, and a source's budget is realised as passes over a permutation of its blocks: whole passes,
then whole blocks in the order of the last pass, then the documents of the one block that the budget ends in.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.encode import TOKENIZERS, encode
from strataloom.runtime import materialise

#: Blocks of a source; steps of the bisections; seed of the permutations.
BLOCKS, STEPS, SEED = 4096, 60, 20240229


@dataclass
class Source:
    """One source's supply and demand; budget and exponent are filled in by ``plan``."""

    name: str
    tokens: int
    target: float
    repeats: int
    budget: float = 0.0


def bent(sources: list[Source], a: float) -> list[float]:
    """The weights at exponent ``a``: 0 gives the token shares, 1 the targets."""
    total = sum(s.tokens for s in sources)
    logs = [(1 - a) * math.log(s.tokens / total) + a * math.log(s.target) for s in sources]
    top = max(logs)
    raw = [math.exp(x - top) for x in logs]
    return [x / sum(raw) for x in raw]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def plan(sources: list[Source], budget: float | None = None, wanted_entropy: float | None = None) -> tuple[float, float]:
    """Fills in the budgets; returns the whole budget in tokens and the exponent.

    Sources without tokens, target or allowed repeats get nothing, and the others' targets are scaled up to sum 1. Without
    ``budget`` it is the greatest one at which the targets themselves can be met, so the exponent is 1. With a greater one the
    exponent falls as far as the repetition limits demand; if even the token shares exceed a limit, that source is cut to it.
    ``wanted_entropy`` bisects for the exponent whose weights have that entropy, before the limits.
    """
    live = [s for s in sources if s.tokens > 0 and s.target > 0 and s.repeats > 0]
    if not live:
        return 0.0, 1.0
    scale = sum(s.target for s in live)
    for s in live:
        s.target /= scale
    if budget is None:
        budget = min(s.tokens * s.repeats / s.target for s in live)
    high = 1.0
    if wanted_entropy is not None:
        ends = [entropy(bent(live, a)) for a in (0.0, 1.0)]
        low_a, high_a = 0.0, 1.0
        for _ in range(STEPS):
            mid = (low_a + high_a) / 2
            if (entropy(bent(live, mid)) < wanted_entropy) == (ends[0] < ends[1]):
                low_a = mid
            else:
                high_a = mid
        high = high_a

    def fits(a: float) -> bool:
        return all(w * budget <= s.tokens * s.repeats * (1 + 1e-12) for s, w in zip(live, bent(live, a)))

    a = high
    if not fits(high):
        low = 0.0
        for _ in range(STEPS):
            mid = (low + high) / 2
            low, high = (mid, high) if fits(mid) else (low, mid)
        a = low
    for s, w in zip(live, bent(live, a)):
        s.budget = min(w * budget, float(s.tokens * s.repeats))
    return budget, a


def sized(documents: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents with at least one token; null and empty texts have none and can't be mixed."""
    return encode(documents, tokenizers, count_only=True, carry=("source",)).where("n_tokens > 0")


def supply(sizes: DataFrame, targets: DataFrame) -> list[Source]:
    """Every source of ``targets`` with its tokens: one row a source, so the list is as short as the table of targets."""
    t = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    totals = sizes.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"))
    got = t.join(totals, "source", "left").orderBy("source").collect()
    return [Source(r["source"], r["n_tokens"] or 0, r["target_share"] or 0.0, r["max_repeats"] or 0) for r in got]


def mix(sizes: DataFrame, targets: DataFrame, budget: float | None = None, seed: int = SEED, wanted_entropy: float | None = None) -> DataFrame:
    """(doc_id, source, repeat_no, n_tokens, order_key): every occurrence of a document in the mix; sorted by order_key it is shuffled.

    ``sizes`` (doc_id, source, n_tokens). A document occurs at most max_repeats times. The documents of a source that ``targets``
    doesn't list don't occur. A source ends within one document of its budget, below it.
    """
    spark = sizes.sparkSession
    sources = supply(sizes, targets)
    plan(sources, budget, wanted_entropy)
    rows = [(s.name, int(s.budget // s.tokens), s.budget - (s.budget // s.tokens) * s.tokens) for s in sources if s.budget > 0]
    budgets = F.broadcast(spark.createDataFrame(rows, "source string, whole int, rest double"))  # one row a source
    docs = sizes.join(budgets, "source").withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(BLOCKS)))
    passes = docs.where("whole > 0").select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(1), "whole")).alias("repeat_no"))
    # The last, partial pass: blocks in its order, summed up over at most BLOCKS rows a source.
    last = docs.where("rest > 0")
    blocks = last.groupBy("source", "block", "whole", "rest").agg(F.sum("n_tokens").alias("_t"))
    order = Window.partitionBy("source").orderBy(F.xxhash64("block", "whole", F.lit(seed)), "block")
    blocks = blocks.withColumn("_upto", F.sum("_t").over(order))
    whole = blocks.where("_upto <= rest").select("source", "block")
    cut = blocks.where("_upto > rest and _upto - _t < rest").select("source", "block", (F.col("rest") - F.col("_upto") + F.col("_t")).alias("_left"))
    inside = last.join(cut, ["source", "block"])
    within = Window.partitionBy("source", "block").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id")
    parts = inside.withColumn("_sum", F.sum("n_tokens").over(within)).where("_sum <= _left")
    partial = last.join(whole, ["source", "block"], "left_semi").select("doc_id", "source", "n_tokens", (F.col("whole") + 1).alias("repeat_no"))
    partial = partial.unionByName(parts.select("doc_id", "source", "n_tokens", (F.col("whole") + 1).alias("repeat_no")))
    out = passes.unionByName(partial)
    return out.select("doc_id", "source", F.col("repeat_no").cast("bigint").alias("repeat_no"), "n_tokens", F.xxhash64("doc_id", "repeat_no", F.lit(seed + 2)).alias("order_key"))


def mixture(documents: DataFrame, targets: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """``mix`` of documents, with their token sizes measured by the public tokenizer."""
    return mix(materialise(sized(documents, tokenizers), "sizes"), targets)


def full_mixture(documents: DataFrame, targets: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """``mix`` of documents with as many tokens as the listed sources have together: the targets are bent where a source would be repeated too often."""
    sizes = materialise(sized(documents, tokenizers), "sizes")
    return mix(sizes, targets, budget=float(sum(s.tokens for s in supply(sizes, targets) if s.target > 0 and s.repeats > 0)))


def even_mixture(documents: DataFrame, targets: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """``mix`` of documents by temperature alone: the token shares of the listed sources, raised to the exponent that gives them the entropy of the targets.

    Bent towards equal targets, t**(1-a) is all that is left of the weights. It has as many tokens as the listed sources have together.
    """
    sizes = materialise(sized(documents, tokenizers), "sizes")
    live = [s for s in supply(sizes, targets) if s.tokens > 0 and s.target > 0 and s.repeats > 0]
    total = sum(s.target for s in live)
    even = targets.where(F.col("target_share") > 0).withColumn("target_share", F.lit(1.0))
    return mix(sizes, even, float(sum(s.tokens for s in live)), wanted_entropy=entropy([s.target / total for s in live]))


def shares(documents: DataFrame, targets: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """One row per source of ``documents`` or ``targets``: what there is, what is wanted and what the mix has.

    (source, n_docs, n_tokens, target_share, max_repeats, mix_tokens, actual_share, repeats, most_repeats, met). repeats is the mean
    number of times a token of the source occurs, met whether the share is within one percent of the target. A source that is
    absent from documents has nothing in the mix; one that targets doesn't list has target 0.
    """
    sizes = materialise(sized(documents, tokenizers), "sizes")
    mixed = materialise(mix(sizes, targets), "mix")
    by_doc = mixed.groupBy("source", "doc_id").agg(F.sum("n_tokens").alias("_t"), F.count(F.lit(1)).alias("_k"))
    used = by_doc.groupBy("source").agg(F.sum("_t").alias("mix_tokens"), F.max("_k").alias("most_repeats"))
    used = used.withColumn("_all", F.sum("mix_tokens").over(Window.partitionBy(F.lit(0))))  # one row a source
    have = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    want = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    rows = have.join(want, have["source"].eqNullSafe(want["source"]), "full").select(F.coalesce(have["source"], want["source"]).alias("source"), "n_docs", "n_tokens", "target_share", "max_repeats")
    rows = rows.join(used.withColumnRenamed("source", "_s"), F.col("source") == F.col("_s"), "left").drop("_s")
    actual = F.coalesce(F.col("mix_tokens") / F.col("_all"), F.lit(0.0))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_docs", "n_tokens")]
    return rows.select(
        "source", *zero, F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"), F.coalesce("mix_tokens", F.lit(0)).alias("mix_tokens"), actual.alias("actual_share"),
        F.coalesce(F.col("mix_tokens") / F.col("n_tokens"), F.lit(0.0)).alias("repeats"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), (F.abs(actual - F.coalesce("target_share", F.lit(0.0))) <= 0.01).alias("met"),
    )
