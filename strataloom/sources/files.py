"""Readers: text files with line numbers, manifests, frames, lookups, logs, stamps, Parquet with row numbers."""

from __future__ import annotations

import configparser

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.contracts import CONTRACT, PROVENANCE
from strataloom.functions.mask import UNIVERSAL
from strataloom.functions.scalars import blank_to, included, is_sha, key_values, no_field_breaks, project_name, strip, u_of

# The fields of the line formats.
MANIFEST = ("name", "url", "category", "file_filter", "size_class")
METRICS = "iso_start timestamp, project string, class string, phase string, duration_s bigint, rc bigint, log string"
SAMPLES = (
    "iso timestamp, project string, class string, phase string, elapsed_s bigint, tree_rss_mb bigint, tree_procs bigint, cpu_pct double, mem_used_mb bigint, "
    "disk_free_gb bigint, load1 double"
)
LEDGER = (
    "v bigint, run_id string, project string, queue_pos bigint, queue_total bigint, attempt bigint, manifest_row map<string,string>, pinned_sha string, "
    "snapshot_sha string, checked_out_sha string, file_mask_sha256 string, tools map<string,string>, step string, status string, start_utc string, "
    "end_utc string, duration_s double, exit_code bigint, argv array<string>, log string, detail string, state string, failed_step string"
)
SIZE_CLASSES = ("S", "M", "L")
TOLERANCE = 1e-12


class InputError(ValueError):
    """An input breaks its format; the message names the file and the line."""


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line_no, line), numbered from 1 within each file, of files of any size.

    Each line is a row that lies where Spark's own reader found it; a line's number is its place in its partition after the
    lines of the partitions of the same file before it, whose counts are one row a partition.
    """
    part = F.spark_partition_id()
    read = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_from"), F.monotonically_increasing_id().alias("_id"), part.alias("_part"), F.col("value").alias("line"))
    blocks = read.groupBy("path", "_from", "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("_from")) - F.col("_n")
    starts = blocks.select(F.col("path").alias("_p"), F.col("_from").alias("_f"), "_first", before.alias("_before"))  # one row a split
    numbered = read.join(F.broadcast(starts), (F.col("path") == F.col("_p")) & (F.col("_from") == F.col("_f")))
    return numbered.select("path", (F.col("_before") + F.col("_id") - F.col("_first") + 1).cast("bigint").alias("line_no"), "line")


def stop_at_first(violations: DataFrame) -> None:
    """Raises InputError with the first violation by path and line, if there is any (path, line_no, violation)."""
    first = violations.where("violation is not null").orderBy("path", "line_no").select("path", "line_no", "violation").first()
    if first:
        raise InputError(f"{first[0]}:{first[1]}: {first[2]}")


def manifest_fields(text: DataFrame) -> DataFrame:
    """(path, line_no, the five fields, commit, violation) of the lines (path, line_no, line) that are neither blank nor a comment; commit is null without a sixth field."""
    kept = text.where((strip(F.col("line")) != "") & ~F.col("line").startswith("#")).withColumn("_f", F.split("line", "\t"))
    fields = [F.try_element_at("_f", F.lit(i)).alias(n) for i, n in enumerate((*MANIFEST, "commit"), 1)]
    rows = kept.select("path", "line_no", F.size("_f").alias("_n"), *fields)
    bad = (
        F.when(~F.col("_n").isin(5, 6), F.concat(F.lit("5 or 6 fields expected, found "), "_n"))
        .when((F.col("_n") == 6) & ~is_sha(F.col("commit")), "the pinned commit is no SHA")
        .when(~F.col("size_class").isin(*SIZE_CLASSES), "the size class is none of S, M, L")
    )
    return rows.withColumn("violation", bad).withColumn("file_filter", blank_to(F.col("file_filter"), UNIVERSAL)).drop("_n")


def manifest_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``manifest_fields`` of manifest files."""
    return manifest_fields(lines(spark, paths))


def manifest(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """The rows of one manifest; a broken line stops the read. ``only`` keeps the named projects; a blank mask becomes the universal one."""
    rows = manifest_lines(spark, path)
    stop_at_first(rows)
    rows = rows.drop("violation", "path")
    return rows.where(F.col("name").isin(*only)) if only else rows


def slug_column(columns: list[str], where: str = "frame") -> str:
    """The column of a frame that names the repositories; a frame without it or without a required column is refused."""
    found = next((c for c in ("slug", "name_with_owner") if c in columns), None)
    missing = [c for c in ("host", "repo_url", "head_oid", "u", "size_class", "labels") if c not in columns]
    if found is None or missing:
        raise InputError(f"{where}: missing column(s): {', '.join(([] if found else ['slug or name_with_owner']) + missing)}")
    return found


def check_frame(raw: DataFrame, salt: str, where: str = "frame") -> DataFrame:
    """A raw frame (its cells as strings, and line_no), checked row by row: line_no, slug, host, name, url, commit, u, size_class, labels, category, file_filter, the given provenance, dropped and violation.

    dropped says that ``included`` leaves a row out; such a row isn't checked. violation is the first rule that a row breaks. A
    cell that is missing counts as blank; a category falls back to labels only where its cell is empty, not where it is blank.
    """
    slug_in = slug_column(raw.columns, where)
    dropped = ~included(F.col("included")) if "included" in raw.columns else F.lit(False)
    plain = lambda c: F.coalesce(F.col(c), F.lit("")) if c in raw.columns else F.lit("")
    cell = lambda c: strip(plain(c))
    host, slug = blank_to(F.lower(cell("host")), "github.com"), cell(slug_in)
    u, url = strip(F.col("u")).try_cast("double"), cell("repo_url")
    category = strip(blank_to(plain("category"), plain("labels")))
    bad = (
        F.when(~is_sha(cell("head_oid")), "head_oid is no SHA")
        .when(u.isNull(), "u is no number")
        .when(~((u >= 0) & (u < 1)), "u is outside [0, 1)")
        .when(F.abs(u - u_of(slug, salt)) > TOLERANCE, "u is not that of the slug and the salt")
        .when(~cell("size_class").isin(*SIZE_CLASSES), "the size class is none of S, M, L")
        .when(~no_field_breaks(url), "repo_url holds a tab or a newline")
        .when(url == "", "repo_url is empty")
        .when(project_name(host, slug).isNull(), "no project name comes of host and slug")
        .when(~no_field_breaks(category), "the category holds a tab or a newline")
        .when(~no_field_breaks(cell("file_filter")), "file_filter holds a tab or a newline")
    )
    given = [cell(c).alias(f"given_{c}") for c in PROVENANCE]
    return raw.select(
        "line_no", slug.alias("slug"), host.alias("host"), project_name(host, slug).alias("name"), url.alias("url"), cell("head_oid").alias("commit"), u_of(slug, salt).alias("u"), cell("size_class").alias("size_class"),
        cell("labels").alias("labels"), category.alias("category"), cell("file_filter").alias("file_filter"), *given, dropped.alias("dropped"), F.when(~dropped, bad).alias("violation"),
    )


def frame(spark: SparkSession, path: str, salt: str) -> tuple[DataFrame, int]:
    """(the kept rows of a selection frame in a CSV file, the number that ``included`` drops); the first broken row stops the read, named by file and line."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    slug_column(raw.columns, path)
    rows = check_frame(raw.coalesce(1).withColumn("line_no", F.monotonically_increasing_id() + 2), salt, path)  # one file of a few thousand rows
    stop_at_first(rows.withColumn("path", F.lit(path)))
    return rows.where("not dropped").drop("dropped", "violation"), rows.where("dropped").count()


def lookup(spark: SparkSession, path: str) -> DataFrame:
    """A lookup CSV with header; all columns are strings, so that a name like 360 stays one."""
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", True).csv(path)


def numbered_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet scan with file_path and file_row_number, which together order the rows as they stand."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def token_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Many token files under the contract, matched by name; no path gives an empty table."""
    return spark.read.schema(CONTRACT).parquet(*paths) if paths else spark.createDataFrame([], CONTRACT)


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated log with a header under a fixed schema; an absent file is empty."""
    try:
        return spark.read.option("sep", "\t").option("header", True).schema(schema).csv(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def ledger(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows with line_no and flags as raw JSON, torn lines) of a ledger of JSON lines; blank lines are skipped, an absent file is empty."""
    schema = T.StructType([*T.StructType.fromDDL(LEDGER).fields, T.StructField("_torn", T.StringType())])
    try:
        text = lines(spark, path).where("trim(line) <> ''")
    except AnalysisException:
        text = spark.createDataFrame([], "path string, line_no bigint, line string")
    parsed = text.withColumn("_r", F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_torn"}))
    rows = parsed.where("_r._torn is null").select("line_no", "_r.*", F.get_json_object("line", "$.flags").alias("flags")).drop("_torn")
    return rows, parsed.where("_r._torn is not null").select("path", "line_no", "line")


def stamp_facts(text: Column) -> Column:
    """(rows, bytes, unreadable) of a stamp's text: rows missing is 0, rows that are no number are null and unreadable."""
    said = F.try_element_at(key_values(text), F.lit("rows"))
    rows = F.when(said.isNull(), F.lit(0).cast("bigint")).otherwise(strip(said).try_cast("bigint"))
    return F.struct(rows.alias("rows"), F.try_element_at(key_values(text), F.lit("bytes")).try_cast("bigint").alias("bytes"), rows.isNull().alias("unreadable"))


def stamps(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, rows, bytes, unreadable) of stamps of key=value lines."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), stamp_facts(F.col("value")).alias("_s"))
    return whole.select("path", "_s.*")


def json_documents(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(schema).json(paths)


def file_facts(spark: SparkSession, glob: str) -> DataFrame:
    """(path, bytes, sha256) of small files; the contents are read where they lie."""
    return spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def settings(path: str, section: str, defaults: dict[str, str]) -> dict[str, str]:
    """The ``defaults`` with what an INI file says in ``section``; an absent file or section changes nothing, an unknown key is an error."""
    parser = configparser.ConfigParser(interpolation=None)
    parser.read(path)
    said = dict(parser[section]) if parser.has_section(section) else {}
    if unknown := sorted(set(said) - set(defaults)):
        raise InputError(f"{path}: [{section}] has unknown key(s): {', '.join(unknown)}")
    return defaults | said


def conf(spark: SparkSession, key: str, default: str) -> str:
    """A setting of this library: spark.strataloom.<key>."""
    return spark.conf.get(f"spark.strataloom.{key}", default)

