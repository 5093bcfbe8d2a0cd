"""The project catalogue rebuilt from what lies on disk, extended by one project, and the gates before both."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.contracts import compare, file_schema
from strataloom.operators.catalog import accepts, corpus_view, publishable, state_of
from strataloom.operators.footers import footers, sorted_out
from strataloom.sources.files import METRICS, stamp_facts, token_files, tsv
from strataloom.sources.sinks import replace_table, upsert, write_stamp

# The columns of the catalogue and of what has joined the corpus.
PROJECTS = "name string, url string, category string, size_class string, state string, token_rows bigint, parquet_path string, rows_unreadable boolean, parquet_missing boolean, excluded_because string"
JOINED = "name string, parquet_path string, joined_utc string"
OK, FAILED, UNKNOWN_PROJECT = 0, 1, 2


def probe(root: str, names: list[str]) -> list[dict]:
    """What each project's directory holds: its stamp's text, a lock, anything at all, its Parquet file. Paths are looked at, files aren't opened but for the stamp."""
    out = []
    for name in names:
        folder = Path(root) / name
        stamp, parquet = folder / f"{name}.validated", folder / f"{name}-dataset.parquet"
        out.append({"name": name, "stamp": stamp.read_text() if stamp.exists() else None, "locked": (folder / f"{name}.lock").exists(), "touched": folder.is_dir() and any(folder.iterdir()), "parquet": str(parquet) if parquet.exists() else None})
    return out


PROBE = "name string, stamp string, locked boolean, touched boolean, parquet string"


def project_rows(entries: DataFrame, probes: DataFrame, exclusions: dict[str, str] | None = None) -> DataFrame:
    """The catalogue's rows of ``entries`` (name, url, category, size_class) by ``probes`` (name, stamp, locked, touched, parquet).

    A stamp makes a project DONE, and gives its rows; its Parquet path counts only then, and is flagged if it is missing. A project
    of ``exclusions`` keeps its row, with the reason. A project without probe is queued.
    """
    reasons = F.create_map(*[F.lit(x) for kv in exclusions.items() for x in kv]) if exclusions else F.create_map().cast("map<string,string>")
    p = entries.join(probes.groupBy("name").agg(*[F.first(c, True).alias(c) for c in ("stamp", "parquet")], F.bool_or("locked").alias("locked"), F.bool_or("touched").alias("touched")), "name", "left")
    p = p.withColumn("_stamped", F.col("stamp").isNotNull()).na.fill(False, ["locked", "touched"]).withColumn("_s", stamp_facts(F.col("stamp")))
    done = F.col("_stamped")
    return p.select(
        "name", "url", "category", "size_class", state_of("_stamped", "locked", "touched").alias("state"), F.when(done, F.col("_s.rows")).alias("token_rows"), F.when(done, F.col("parquet")).alias("parquet_path"),
        (done & F.col("_s.unreadable")).alias("rows_unreadable"), (done & F.col("parquet").isNull()).alias("parquet_missing"), F.try_element_at(reasons, F.col("name")).alias("excluded_because"),
    )


def joined_rows(projects: DataFrame, paths: DataFrame | None = None, at: str | None = None) -> DataFrame:
    """(name, parquet_path, joined_utc): the publishable projects, of ``paths`` (path) where they are given, as of ``at``."""
    p = publishable(projects).select("name", "parquet_path", F.lit(at or utc_now()).alias("joined_utc"))
    return p if paths is None else p.join(paths.select(F.col("path").alias("parquet_path")).distinct(), "parquet_path", "left_semi").select("name", "parquet_path", "joined_utc")


def utc_now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def phase_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    """The phases' metrics as a table of fixed types; an absent log is an empty table."""
    return tsv(spark, metrics, METRICS)


def gate(spark: SparkSession, path: str, stamp: str | None = None) -> str:
    """Why a token file isn't accepted, '' if it is: its size, then its rows, then its schema. An accepted file gets its stamp, a refused one none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return "no file"
    size = fs.getContentSummary(target).getLength()
    if why := accepts(size, 1, []):
        return why
    df = spark.read.parquet(path)
    n = df.count()
    why = accepts(size, n, compare(df.schema))
    if not why and stamp:
        write_stamp(stamp, n, size)
    return why


def rebuild(spark: SparkSession, entries: DataFrame, probes: DataFrame, folder: str, metrics: str, exclusions: dict[str, str] | None = None) -> dict:
    """Writes the tables projects, joined and phase_metrics anew below ``folder`` and the view of the corpus; the report says what was left out.

    exit_code is FAILED if a stamp's rows can't be read. A file whose footer can't be read is set aside and reported.
    """
    projects = replace_table(project_rows(entries, probes, exclusions), f"{folder}/projects", "name")
    paths = [r[0] for r in publishable(projects).select("parquet_path").collect()]  # one a project
    verdicts = sorted_out(footers(spark, paths)).collect() if paths else []
    by = {v: sorted(r["path"] for r in verdicts if r["verdict"] == v) for v in ("usable", "drifted", "unreadable")}
    usable = spark.createDataFrame([(p,) for p in by["usable"]], "path string")
    replace_table(joined_rows(projects, usable), f"{folder}/joined", "name")
    replace_table(phase_metrics(spark, metrics), f"{folder}/phase_metrics")
    view = corpus_view(token_files(spark, by["usable"]), projects)
    view.createOrReplaceTempView("tokens")
    broken = projects.where("rows_unreadable").count()
    return {**by, "rows": view.count(), "exit_code": FAILED if broken else OK}


def join(spark: SparkSession, name: str, entries: DataFrame, probes: DataFrame, folder: str, exclusions: dict[str, str] | None = None) -> tuple[int, str]:
    """Adds or replaces one project in the tables below ``folder`` and widens the view to it; (exit code, message).

    UNKNOWN_PROJECT if no entry has the name; FAILED if it isn't done, has no Parquet file, or that drifted or can't be read: then nothing
    changes. An excluded project's row is replaced, but its file doesn't join. Joining twice is joining once.
    """
    row = project_rows(entries.where(F.col("name") == name), probes.where(F.col("name") == name), exclusions)
    own = row.first()
    if own is None:
        return UNKNOWN_PROJECT, f"{name} is in no manifest"
    if own["state"] != "DONE" or not own["parquet_path"]:
        return FAILED, f"{name} is {own['state']} and no validated project with a Parquet file"
    if not own["excluded_because"]:
        try:
            drifts = compare(file_schema(spark, own["parquet_path"]))
        except Exception as e:  # whatever the reader raises, the file doesn't join
            return FAILED, f"{name}: schema not read ({type(e).__name__})"
        if drifts:
            return FAILED, f"{name}: {len(drifts)} drifts: " + "; ".join(f"{d.kind} {d.column}" for d in drifts[:3])
    stored = lambda table, schema: spark.read.schema(schema).parquet(f"{folder}/{table}") if os.path.exists(f"{folder}/{table}") else spark.createDataFrame([], schema)
    projects = replace_table(upsert(stored("projects", PROJECTS), row, "name"), f"{folder}/projects", "name")
    before = stored("joined", JOINED).where(F.col("name") != name)
    joined = before if own["excluded_because"] else before.unionByName(joined_rows(row))
    joined = replace_table(joined, f"{folder}/joined", "name")
    files = [r[0] for r in joined.orderBy("name").select("parquet_path").collect()]  # one a project
    corpus_view(token_files(spark, files), projects).createOrReplaceTempView("tokens")
    return OK, f"{name}: {own['token_rows']} rows; {len(files)} projects"


def publish(spark: SparkSession, path: str, join_step: Callable[[], int] | None = None, anonymize: Callable[[str], list[str]] | None = None) -> tuple[bool, str]:
    """The steps that publish one validated file, each only if those before it passed: schema, anonymize, join; (whether all passed, the step that didn't).

    ``anonymize`` is a hook that writes copies of the file and returns their paths; none written is a failure.
    """
    if join_step and compare(file_schema(spark, path)):
        return False, "schema"
    if anonymize and not anonymize(path):
        return False, "anonymize"
    if join_step and join_step() != OK:
        return False, "join"
    return True, ""
