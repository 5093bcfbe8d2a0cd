"""Manifests: built from a checked frame, or several read as one list of projects."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.contracts import PROVENANCE
from strataloom.functions.mask import UNIVERSAL
from strataloom.operators.catalog import first_wins
from strataloom.operators.enrich import sidecar
from strataloom.operators.sampling import queue
from strataloom.sources.files import InputError, file_facts, frame, manifest_lines
from strataloom.sources.sinks import write_text

# The fields of a manifest's line and of the order file.
MANIFEST_FIELDS = ("name", "url", "category", "file_filter", "size_class", "commit")
ORDER_FIELDS = ("queue_pos", "name", "slug", "host", "u", "head_oid", "labels")


def repeated_projects(rows: DataFrame) -> DataFrame:
    """(name_key, n, first_line, second_line) of the project names that are one but for their case, with the lines of the first two rows."""
    keyed = rows.where("name is not null").select(F.lower("name").alias("name_key"), "line_no")
    first = keyed.groupBy("name_key").agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("first_line")).where("n > 1")
    second = keyed.join(first.select("name_key", "first_line"), "name_key").where("line_no > first_line").groupBy("name_key").agg(F.min("line_no").alias("second_line"))
    return first.join(second, "name_key")


def refuse_repeats(rows: DataFrame, where: str = "frame") -> None:
    """Raises InputError at the first row whose project name repeats an earlier one."""
    found = repeated_projects(rows).orderBy("second_line").first()
    if found:
        raise InputError(f"{where}:{found['second_line']}: the project name {found['name_key']} repeats line {found['first_line']}")


def work_queue(rows: DataFrame, salt: str, limit: int | None = None) -> DataFrame:
    """A checked frame in u order, the slug breaking ties, with queue_pos from 1; the first ``limit`` of it."""
    if limit is not None and limit < 1:
        raise ValueError("a limit is at least 1")
    placed = queue(rows, "slug", salt)
    return placed if limit is None else placed.where(F.col("queue_pos") <= limit)


def manifest_text(queued: DataFrame) -> DataFrame:
    """(queue_pos, line): a manifest's lines."""
    return queued.select("queue_pos", F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in MANIFEST_FIELDS]).alias("line"))


def order_text(queued: DataFrame) -> DataFrame:
    """(queue_pos, line): the order file's lines."""
    cells = [F.col("commit" if c == "head_oid" else c).cast("string") for c in ORDER_FIELDS]
    return queued.select("queue_pos", F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in cells]).alias("line"))


def provenance_status(frame_name: str, digest: str) -> str:
    """Where a sidecar's provenance comes from: the frame's name and the head of its digest."""
    return f"frame:{frame_name}@sha256:{digest[:12]}"


def provenance_gaps(records: DataFrame, fields: list[str] = PROVENANCE) -> DataFrame:
    """(field, n_blank, n_rows) of the provenance fields that are null or blank in every record of a sidecar."""
    counts = records.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.coalesce(F.trim(F.col(f)), F.lit("")) == "").alias(f) for f in fields])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n_blank"), F.col("_n").alias("n_rows")) for f in fields]))
    return counts.select(each.alias("x")).select("x.*").where("n_blank = n_rows")


def check_provenance(gaps: list[str], allow_empty: bool, publishes: bool = True) -> str:
    """'' if a run may go on, a warning if it may with blank columns; raises InputError if it may not.

    A run that publishes with gaps must be told so; being told so without a gap is refused too, as it would hide the next one.
    """
    if allow_empty and not gaps:
        raise InputError("blank provenance is allowed, but no column would be blank")
    if not gaps or not publishes:
        return ""
    if not allow_empty:
        raise InputError(f"{len(gaps)} provenance column(s) would be blank: {', '.join(gaps)}")
    return f"blank provenance on purpose: {', '.join(gaps)}"


def entries(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """(name, url, category, size_class) of several manifests in the order given, the first row of a name winning; and the later rows, as warnings.

    A line without five or six fields stops the read; size classes aren't checked here.
    """
    rows = None
    for i, path in enumerate(paths):
        one = manifest_lines(spark, path).withColumn("manifest_no", F.lit(i))
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.where("size_class is not null or violation like '%fields%'")
    broken = rows.where("violation like '%fields%'").orderBy("manifest_no", "line_no").select("path", "line_no", "violation").first()
    if broken:
        raise InputError(f"{broken[0]}:{broken[1]}: {broken[2]}")
    kept = first_wins(rows, "name", "manifest_no", "line_no")
    later = rows.join(kept.select("manifest_no", "line_no"), ["manifest_no", "line_no"], "left_anti").where("name is not null").orderBy("manifest_no", "line_no")
    warnings = [f"{r['path']}:{r['line_no']}: {r['name']} is named before" for r in later.select("path", "line_no", "name").collect()]  # of hand-written lists
    return kept.select("name", "url", "category", "size_class"), warnings


def build(spark: SparkSession, frame_path: str, salt: str, folder: str, limit: int | None = None) -> dict:
    """Builds manifest.tsv, project_meta.json and manifest.order.tsv of a frame in ``folder``; returns what went in and out.

    Nothing is written if a row is broken or two rows have one project name. A manifest is a work list, so it is as small as its projects are few.
    """
    rows, dropped = frame(spark, frame_path, salt)
    refuse_repeats(rows, frame_path)
    queued = work_queue(rows, salt, limit).cache()
    digest = file_facts(spark, frame_path).first()["sha256"]
    name = Path(frame_path).name
    text = lambda df: "".join(f"{r['line']}\n" for r in df.orderBy("queue_pos").collect())
    records = sidecar(queued.orderBy("queue_pos"), provenance_status(name, digest), UNIVERSAL, PROVENANCE).collect()
    n = queued.count()
    head = f"# {name} (sha256 {digest}), {n} projects in the order of u from the salt {salt!r}\n# {' '.join(MANIFEST_FIELDS)}\n"
    write_text(f"{folder}/manifest.tsv", head + text(manifest_text(queued)))
    write_text(f"{folder}/project_meta.json", json.dumps({r["name"]: {f: r[f] for f in PROVENANCE} for r in records}, indent=1, ensure_ascii=False) + "\n")
    write_text(f"{folder}/manifest.order.tsv", "\t".join(ORDER_FIELDS) + "\n" + text(order_text(queued)))
    queued.unpersist()
    return {"frame_sha256": digest, "rows": rows.count(), "dropped": dropped, "written": n}
