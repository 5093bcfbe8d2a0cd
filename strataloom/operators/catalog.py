"""The project catalogue and the corpus view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.contracts import Drift
from strataloom.functions.scalars import percent
from strataloom.operators.footers import drift_rows, footers, sorted_out
from strataloom.runtime import materialise
from strataloom.sources.files import token_files
from strataloom.sources.sinks import upsert

# The states in the order of their reports, and the least size of an acceptable file.
STATES = ("DONE", "RUNNING", "FAILED", "QUEUED")
MIN_BYTES = 10_000


def first_wins(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key by ``order``; rows without a key have no place in the catalogue."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.where(F.col(key).isNotNull()).withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")


def state_of(stamped: str, locked: str, touched: str):
    """A project's state from what its directory holds: DONE before RUNNING before FAILED before QUEUED."""
    return F.when(F.col(stamped), "DONE").when(F.col(locked), "RUNNING").when(F.col(touched), "FAILED").otherwise("QUEUED")


def publishable(projects: DataFrame) -> DataFrame:
    """The projects that are done, have their Parquet file and aren't excluded."""
    return projects.where("state = 'DONE' and parquet_path is not null and not coalesce(parquet_missing, false) and excluded_because is null")


def corpus_view(tokens: DataFrame, projects: DataFrame) -> DataFrame:
    """The tokens of known projects, with the catalogue's category and size_class in front; the file's own size_class becomes size_class_1.

    An inner join: tokens of unknown projects fall away. ``projects`` has one row a name.
    """
    p = projects.select("name", F.col("category").alias("_category"), F.col("size_class").alias("_class"))
    own = [tokens[c].alias("size_class_1" if c == "size_class" else c) for c in tokens.columns]
    return tokens.join(p, tokens["repo_name"] == p["name"]).select(p["_category"].alias("category"), p["_class"].alias("size_class"), *own)


def split_by_schema(spark: SparkSession, paths: list[str]) -> tuple[list[str], dict[str, list[Drift]], list[str]]:
    """(usable, drifted with their drifts, unreadable) of token files: one odd file doesn't break the union of the others. All footers are read in one job."""
    if not paths:
        return [], {}, []
    columns = materialise(footers(spark, paths), "footers")
    verdicts = {r["path"]: r["verdict"] for r in sorted_out(columns).collect()}  # one a file
    drifted: dict[str, list[Drift]] = {p: [] for p in paths if verdicts[p] == "drifted"}
    for r in drift_rows(columns.where("error is null")).collect() if drifted else []:
        drifted[r["path"]].append(Drift(r["kind"], r["column"], r["detail"]))
    return [p for p in paths if verdicts[p] == "usable"], drifted, [p for p in paths if verdicts[p] == "unreadable"]


def accepts(size: int, rows: int, drift: list[Drift]) -> str:
    """Why a file isn't accepted, '' if it is: too small, no rows, or drifted (the first three drifts)."""
    if size <= MIN_BYTES:
        return f"{size} bytes"
    if rows <= 0:
        return "no rows"
    return "; ".join(f"{d.kind} {d.column}: {d.detail}" for d in drift[:3])


def create_view(spark: SparkSession, projects: DataFrame, name: str = "tokens") -> dict[str, list]:
    """(Re)creates the view of all publishable token files; returns what was left out. Without any file the view is empty, never stale."""
    paths = [r[0] for r in publishable(projects).select("parquet_path").orderBy("name").collect()]  # one a project
    usable, drifted, unread = split_by_schema(spark, paths)
    corpus_view(token_files(spark, usable), projects).createOrReplaceTempView(name)
    return {"usable": usable, "drifted": sorted(drifted), "unread": unread}


def join_project(projects: DataFrame, row: DataFrame) -> DataFrame:
    """The catalogue with one project's row put in or replaced: joining twice is joining once."""
    return upsert(projects, row.select(projects.columns), "name")


def state_counts(projects: DataFrame) -> DataFrame:
    """(state, n) of the states that occur, in the order of STATES."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("state"))
    return projects.groupBy("state").agg(F.count(F.lit(1)).alias("n")).orderBy(rank, "state")


def class_breakdown(projects: DataFrame) -> DataFrame:
    """(size_class, done, total, percent) of the size classes that occur."""
    counts = projects.groupBy("size_class").agg(F.count_if(F.col("state") == "DONE").alias("done"), F.count(F.lit(1)).alias("total"))
    return counts.withColumn("percent", percent(F.col("done"), F.col("total")))


def row_checks(tokens: DataFrame, projects: DataFrame) -> DataFrame:
    """(name, said, found, verdict): the stamped number of rows of each project against the tokens'."""
    found = tokens.groupBy("repo_name").agg(F.count(F.lit(1)).alias("_found"))
    joined = projects.select("name", F.col("token_rows").alias("said")).join(found, F.col("name") == F.col("repo_name"), "left")
    n = F.coalesce("_found", F.lit(0))
    verdict = F.when(n == 0, "no rows").when(F.col("said").isNull(), "unstamped").when(F.col("said") != n, "stale").otherwise("ok")
    return joined.select("name", "said", n.alias("found"), verdict.alias("verdict"))
