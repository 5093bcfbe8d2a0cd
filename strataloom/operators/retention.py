"""What a clean-up of work directories would remove: a report, nothing is deleted here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What may be removed from a finished project, and what must never be.
DISPOSABLE = ("memo", "html")
PROTECTED = ("metrics.tsv", "runs.log", "ctp.duckdb", ".git")
PROTECTED_ENDS = (".parquet", ".validated")


def is_protected(name: Column) -> Column:
    """Whether an entry of this name must stay."""
    return F.coalesce(name.isin(*PROTECTED) | name.endswith(PROTECTED_ENDS[0]) | name.endswith(PROTECTED_ENDS[1]), F.lit(False))


def removable(entries: DataFrame, keepers: DataFrame) -> DataFrame:
    """The ``entries`` (project, name, bytes) of directories without what ``keepers`` (project, name) lists for their project."""
    return entries.join(keepers.select("project", "name").distinct(), ["project", "name"], "left_anti")


def sweep(entries: DataFrame, projects: DataFrame) -> DataFrame:
    """(project, n_entries, bytes, freed, violations, verdict): by project, what is there and what a sweep would free.

    ``entries`` (project, subtree, name, bytes). Only a DONE project's disposable subtrees are freed, and none of a project in whose
    disposable subtrees a protected entry stands: it is refused whole.
    """
    disposable = F.coalesce(F.col("subtree").isin(*DISPOSABLE), F.lit(False))
    sums = entries.groupBy("project").agg(
        F.count(F.lit(1)).alias("n_entries"), F.sum(F.coalesce("bytes", F.lit(0))).alias("bytes"), F.sum(F.when(disposable, F.coalesce("bytes", F.lit(0))).otherwise(0)).alias("_free"),
        F.count_if(disposable & is_protected(F.col("name"))).alias("violations"),
    )
    done = projects.groupBy(F.col("name").alias("_name")).agg(F.bool_or(F.col("state") == "DONE").alias("_done"))
    joined = sums.join(done, F.col("project") == F.col("_name"), "left")
    verdict = F.when(~F.coalesce("_done", F.lit(False)), "kept").when(F.col("violations") > 0, "refused").otherwise("swept")
    return joined.select("project", "n_entries", "bytes", F.when(verdict == "swept", F.col("_free")).otherwise(0).cast("bigint").alias("freed"), "violations", verdict.alias("verdict"))


def totals(swept: DataFrame) -> DataFrame:
    """(verdict, n_projects, bytes, freed) of a sweep."""
    return swept.groupBy("verdict").agg(F.count(F.lit(1)).alias("n_projects"), F.sum("bytes").alias("bytes"), F.sum("freed").alias("freed"))
