"""The run ledger folded into states, audits and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The words of the ledger.
STARTED, PROJECT, DONE, FAILED = "started", "project", "done", "failed"
NO_ATTEMPT = ("skipped", "deferred")
KEY = ("project", "run_id", "attempt")


def _same(a: DataFrame, b: DataFrame, columns: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def histories(ledger: DataFrame) -> DataFrame:
    """(project, state, failures, attempts, last_failed_step, interrupted): each project's rows folded in line order.

    A final row is one of step 'project' that isn't a start. Skipped and deferred ones end an attempt and count for nothing else;
    the state is the last other one's. An attempt that started and has no final row is interrupted: it counts as an attempt, and
    the failed step is the last it started, of the one whose first start came last. Rows without a project are ignored. A
    repeated final row counts again, as it does in a fold.
    """
    rows = ledger.where("project is not null")
    final = rows.where((F.col("step") == PROJECT) & ~F.col("status").eqNullSafe(STARTED))
    counted = final.where(~F.coalesce(F.col("state").isin(*NO_ATTEMPT), F.lit(False)))
    failed = F.col("state").eqNullSafe(FAILED)
    folded = counted.groupBy("project").agg(
        F.max_by("state", "line_no").alias("state"), F.count_if(failed).alias("failures"), F.count(F.lit(1)).alias("attempts"),
        F.max_by(F.coalesce("failed_step", F.lit("")), F.when(failed, F.col("line_no"))).alias("last_failed_step"),
    )
    cut = interrupted_attempts(ledger).groupBy("project").agg(F.count(F.lit(1)).alias("interrupted"), F.max_by("step", "first_line").alias("_step"))
    every = rows.select("project").distinct().join(folded, "project", "left").join(cut, "project", "left")
    n = F.coalesce("interrupted", F.lit(0))
    return every.select(
        "project", F.coalesce("state", F.lit("")).alias("state"), F.coalesce("failures", F.lit(0)).alias("failures"), (F.coalesce("attempts", F.lit(0)) + n).alias("attempts"),
        F.coalesce(F.concat("_step", F.lit(" (interrupted)")), "last_failed_step", F.lit("")).alias("last_failed_step"), n.alias("interrupted"),
    )


def interrupted_attempts(ledger: DataFrame) -> DataFrame:
    """(project, run_id, attempt, first_line, step): the attempts that started and have no final row, with the last step they started."""
    rows = ledger.where("project is not null")
    started = rows.where(F.col("status") == STARTED).groupBy(*KEY).agg(F.min("line_no").alias("first_line"), F.max_by("step", "line_no").alias("step"))
    final = rows.where((F.col("step") == PROJECT) & ~F.col("status").eqNullSafe(STARTED)).select(*KEY).distinct()
    return started.join(final, _same(started, final, KEY), "left_anti")


def audit(ledger: DataFrame) -> DataFrame:
    """The ledger without the starts of steps that ended; a start without an end has status 'interrupted'. Keys compare null-safely."""
    key = (*KEY, "step")
    ended = ledger.where(~F.col("status").eqNullSafe(STARTED)).select(*key).distinct()
    starts = ledger.where(F.col("status") == STARTED)
    cut = starts.join(ended, _same(starts, ended, key), "left_anti").withColumn("status", F.lit("interrupted"))
    return ledger.where(~F.col("status").eqNullSafe(STARTED)).unionByName(cut)


def plan(history: DataFrame, stamped: DataFrame, retries: int) -> DataFrame:
    """(project, decision): skip what is done and stamped, give up after too many failures, else post what is stamped and run the rest.

    ``stamped`` (project, stamped). A project that the ledger doesn't know has no history; one without stamp row isn't stamped.
    """
    both = history.join(stamped.groupBy("project").agg(F.bool_or("stamped").alias("stamped")), "project", "full")
    is_stamped = F.coalesce("stamped", F.lit(False))
    tried = F.coalesce("failures", F.lit(0)) + F.coalesce("interrupted", F.lit(0))
    decision = F.when((F.col("state") == DONE) & is_stamped, "skip").when(tried > retries, "give-up").when(is_stamped, "post").otherwise("run")
    return both.select("project", decision.alias("decision"))


def last_activity(ledger: DataFrame) -> DataFrame:
    """(project, step, status, line_no) of each project's last row."""
    return ledger.where("project is not null").groupBy("project").agg(F.max_by("step", "line_no").alias("step"), F.max_by("status", "line_no").alias("status"), F.max("line_no").alias("line_no"))


def finished_runs(ledger: DataFrame, step: str = "pipeline") -> DataFrame:
    """The rows in which ``step`` ended with exit code 0."""
    return ledger.where((F.col("step") == step) & (F.col("exit_code") == 0) & ~F.col("status").eqNullSafe(STARTED))


def newest(runs: DataFrame, n: int) -> DataFrame:
    """The last ``n`` runs, newest first; 0 means all."""
    ordered = runs.orderBy(F.col("line_no").desc())
    return ordered.limit(n) if n else ordered


def peaks(rows: DataFrame, by: str, high: list[str], low: list[str]) -> DataFrame:
    """By ``by``: the maxima of ``high``, the minima of ``low`` and the number of samples."""
    return rows.groupBy(by).agg(*[F.max(c).alias(f"max_{c}") for c in high], *[F.min(c).alias(f"min_{c}") for c in low], F.count(F.lit(1)).alias("samples"))


def deltas(rows: DataFrame, by: list[str], order: list[str], busy: str, total: str) -> DataFrame:
    """``rows`` with busy_percent: the share of ``busy`` in the growth of ``total`` since the row before, 0 where that is none."""
    w = Window.partitionBy(*by).orderBy(*order)
    span = F.col(total) - F.lag(total, 1, 0).over(w)
    share = 100.0 * (F.col(busy) - F.lag(busy, 1, 0).over(w)) / span
    return rows.withColumn("busy_percent", F.when(span > 0, F.bround(share, 1)).otherwise(0.0))
