"""What is told of the catalogue and the ledger: status, progress, flags, the queue; as tables, and as text for a console."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.functions.scalars import bar, percent
from strataloom.operators.ledger import DONE, FAILED, plan

NO_ACTIVITY = "—"
#: Longest wait in seconds of a deferred project.
MOST_DEFERRED = 600


def status(projects: DataFrame, activity: DataFrame) -> DataFrame:
    """(name, size_class, state, last_activity): every project with its last step and status, or NO_ACTIVITY."""
    last = activity.select(F.col("project").alias("_p"), F.concat_ws(" ", "step", "status").alias("_last"))
    return projects.join(last, F.col("name") == F.col("_p"), "left").select("name", "size_class", "state", F.coalesce("_last", F.lit(NO_ACTIVITY)).alias("last_activity"))


def progress(projects: DataFrame) -> DataFrame:
    """(done, total, percent, bar, failed) of the whole catalogue, one row."""
    counts = projects.agg(F.count_if(F.col("state") == "DONE").alias("done"), F.count(F.lit(1)).alias("total"), F.count_if(F.col("state") == "FAILED").alias("failed"))
    return counts.select("done", "total", percent(F.col("done"), F.col("total")).alias("percent"), bar(F.col("done").cast("double"), F.col("total")).alias("bar"), "failed")


def flags(projects: DataFrame) -> DataFrame:
    """(name, flag, detail): what a rebuild reports of single projects: an exclusion with its reason, a missing file, unreadable rows."""
    found = F.array(
        F.when(F.col("excluded_because").isNotNull(), F.struct(F.lit("excluded").alias("flag"), F.col("excluded_because").alias("detail"))),
        F.when(F.col("parquet_missing"), F.struct(F.lit("parquet missing").alias("flag"), F.lit("").alias("detail"))),
        F.when(F.col("rows_unreadable"), F.struct(F.lit("rows unreadable").alias("flag"), F.lit("").alias("detail"))),
    )
    return projects.select("name", F.explode(found).alias("_f")).where("_f is not null").select("name", "_f.flag", "_f.detail")


def flag_counts(projects: DataFrame) -> DataFrame:
    """(missing, unreadable, excluded, without_path): how many projects have each flag, one row."""
    return projects.agg(
        F.count_if("parquet_missing").alias("missing"), F.count_if("rows_unreadable").alias("unreadable"), F.count_if(F.col("excluded_because").isNotNull()).alias("excluded"),
        F.count_if(F.col("parquet_path").isNull()).alias("without_path"),
    )


def of_project(ledger: DataFrame, name: str) -> DataFrame:
    """The ledger's rows of one project."""
    return ledger.where(F.col("project") == name)


def outcomes(ledger: DataFrame) -> DataFrame:
    """(state, n) of the final rows of all attempts."""
    return ledger.where((F.col("step") == "project") & ~F.col("status").eqNullSafe("started")).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def counters(ledger: DataFrame) -> DataFrame:
    """(run_id, skipped, done, failed): the final rows of every run."""
    final = ledger.where((F.col("step") == "project") & ~F.col("status").eqNullSafe("started"))
    return final.groupBy("run_id").agg(F.count_if(F.col("state") == "skipped").alias("skipped"), F.count_if(F.col("state") == DONE).alias("done"), F.count_if(F.col("state") == FAILED).alias("failed"))


def unpinned(rows: DataFrame, pin: str) -> DataFrame:
    """(n_unpinned, n_rows): the rows without a pinned commit."""
    return rows.agg(F.count_if(F.coalesce(F.trim(F.col(pin)), F.lit("")) == "").alias("n_unpinned"), F.count(F.lit(1)).alias("n_rows"))


def work(history: DataFrame, stamped: DataFrame, retries: int) -> DataFrame:
    """(project, decision, attempt, failures): what ``plan`` says of each project, and the number of the attempt that would be next."""
    h = history.select(F.col("project").alias("_p"), "attempts", (F.col("failures") + F.col("interrupted")).alias("_f"))
    joined = plan(history, stamped, retries).join(h, F.col("project") == F.col("_p"), "left")
    return joined.select("project", "decision", (F.coalesce("attempts", F.lit(0)) + 1).alias("attempt"), F.coalesce("_f", F.lit(0)).alias("failures"))


def next_due(jobs: DataFrame, now: float) -> DataFrame:
    """The first of ``jobs`` (pos, not_before) whose wait is over, one row or none."""
    return jobs.where(F.coalesce("not_before", F.lit(0.0)) <= now).orderBy("pos").limit(1)


def deferral(defers: int, poll: float) -> float:
    """Seconds that a project waits whose lock is held elsewhere: twice as long each time, MOST_DEFERRED at most."""
    return min(poll * 2.0**defers, MOST_DEFERRED)


def missing_flags(text: str, required: list[str]) -> list[str]:
    """The flags of ``required`` that a program's text doesn't name whole."""
    import re

    return [f for f in required if not re.search(rf"(?<![\w-]){re.escape(f)}(?![\w-])", text)]


def lines_of(df: DataFrame, widths: dict[str, int], order: list[str]) -> list[str]:
    """A small table as console lines, in order, each column in its width."""
    head = " ".join(f"{c.upper():<{w}}" for c, w in widths.items()).rstrip()
    return [head] + [" ".join(f"{'' if r[c] is None else r[c]:<{w}}" for c, w in widths.items()).rstrip() for r in df.orderBy(*order).collect()]
