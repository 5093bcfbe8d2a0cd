"""Guarded lookup joins: firms from the domain of a person."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.contracts import CONTRACT, UNATTRIBUTED, UNATTRIBUTED_CONTRACT, compare, file_schema
from strataloom.functions.scalars import blank_to, strip
from strataloom.sources.files import lookup, numbered_parquet
from strataloom.sources.sinks import write_single_parquet


class Refused(ValueError):
    """A guard refused its input; nothing was written."""


def repeated_keys(df: DataFrame, column: str, line: str | None = None) -> DataFrame:
    """(key, n, second_line) of the keys, stripped of white space and lower-cased, that stand in more than one row; a null key counts as ''.

    ``line`` numbers the rows; second_line, where the key repeats first, orders the report. Without it the column is null. Only
    counts and least lines are aggregated, so a hot key costs no more than another.
    """
    rows = df.select(F.coalesce(F.lower(strip(F.col(column))), F.lit("")).alias("key"), (F.col(line) if line else F.lit(None).cast("bigint")).alias("_line"))
    first = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("_line").alias("_least")).where("n > 1")
    if not line:
        return first.select("key", "n", F.col("_least").alias("second_line"))
    later = rows.join(first, "key").where("_line > _least").groupBy("key").agg(F.min("_line").alias("second_line"))
    return first.join(later, "key", "left").select("key", "n", "second_line")


def guard(df: DataFrame, column: str, name: str) -> None:
    """Refuses a lookup table without ``column`` or with a repeated key: it would multiply the rows it is joined to. Names up to five keys, the first to repeat first."""
    if column not in df.columns:
        raise Refused(f"{name} has no column {column}")
    numbered = df.withColumn("_line", F.monotonically_increasing_id())
    found = [r["key"] for r in repeated_keys(numbered, column, "_line").orderBy("second_line").limit(5).collect()]
    if found:
        raise Refused(f"{name}: {column} repeats: {', '.join(found)}")


def input_form(schema: T.StructType) -> str:
    """'attributed' or 'unattributed', the two forms of a token file that attribution takes, or its first drift from the latter."""
    if not compare(schema, CONTRACT):
        return "attributed"
    drift = compare(schema, UNATTRIBUTED_CONTRACT)
    return f"{drift[0].kind} {drift[0].column}: {drift[0].detail}" if drift else "unattributed"


def first_of_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row of each lower-cased key: the first by ``order``, nulls last."""
    window = Window.partitionBy(F.lower(key)).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_first", F.row_number().over(window)).where("_first = 1").drop("_first")


def attribute_firms(tokens: DataFrame, domain_map: DataFrame, canonical: DataFrame) -> DataFrame:
    """``tokens`` with firm_raw, firm and firm_source: its person_domain looked up in the map, the company in the canonical names.

    Both steps are left joins on small tables whose keys must be unique (``guard``); Catalyst broadcasts them by their size. The
    map's key is lower-cased, not trimmed; a company is trimmed and lower-cased for its name, but firm_raw keeps it as it is.
    One step only: a canonical name isn't looked up again. Unmapped rows get '' in all three. Columns of these names in
    ``tokens`` are replaced; every row comes out once.
    """
    base = tokens.drop("firm_raw", "firm", "firm_source")
    domains = domain_map.select(F.lower("domain").alias("_domain"), F.col("company").alias("_company"), F.col("source").alias("_source"))
    names = canonical.select(F.lower(F.trim("firm_raw")).alias("_raw"), F.col("firm").alias("_firm"))
    joined = base.join(domains, F.lower(base["person_domain"]) == F.col("_domain"), "left").join(names, F.lower(F.trim("_company")) == F.col("_raw"), "left")
    return joined.select(
        *base.columns, F.coalesce("_company", F.lit("")).alias("firm_raw"), F.coalesce(F.nullif("_firm", F.lit("")), F.col("_company"), F.lit("")).alias("firm"), F.coalesce("_source", F.lit("")).alias("firm_source")
    )


def attribute_file(spark: SparkSession, path: str, domain_csv: str, canonical_csv: str) -> int:
    """Attributes one project's Parquet file in place, its rows in their order; returns their number.

    The lookups are guarded before the file is opened, the file must have the contract's columns with or without the firm
    columns, and it stays untouched if anything fails.
    """
    domains, names = lookup(spark, domain_csv), lookup(spark, canonical_csv)
    guard(domains, "domain", domain_csv)
    guard(names, "firm_raw", canonical_csv)
    if (form := input_form(file_schema(spark, path))) not in ("attributed", "unattributed"):
        raise Refused(f"{path}: {form}")
    rows = numbered_parquet(spark, path)
    out = attribute_firms(rows.select(*UNATTRIBUTED, "_row"), domains, names).select(*[f.name for f in CONTRACT.fields], "_row")
    n = rows.count()
    write_single_parquet(out, path, ["_row"])
    return n if os.path.exists(path) else 0


def provenance_by_project(tokens: DataFrame, fields: list[str], defaults: dict[str, str] | None = None) -> DataFrame:
    """(repo_name, fields): each project's provenance, the greatest non-blank value of each field, else its default or ''."""
    best = [F.coalesce(F.max(F.nullif(F.trim(F.col(f)), F.lit(""))), F.lit((defaults or {}).get(f, ""))).alias(f) for f in fields]
    return tokens.groupBy("repo_name").agg(*best)


def sidecar(frame: DataFrame, status: str, mask: str, provenance: list[str]) -> DataFrame:
    """(name, the provenance fields) of a checked frame: what the frame gives, the owner and repo from the slug, and what is fixed."""
    from strataloom.functions.scalars import owner_of, repo_of

    fixed = {
        "clone_url": F.col("url"), "provenance_status": F.lit(status), "size_class": F.col("size_class"), "manifest_category": F.col("category"), "file_mask": blank_to(F.col("file_filter"), mask),
        "owner": blank_to(F.col("given_owner"), owner_of(F.col("slug"), F.col("host"))), "repo": blank_to(F.col("given_repo"), repo_of(F.col("slug"))),
    }
    return frame.select("name", *[fixed.get(f, F.col(f"given_{f}")).alias(f) for f in provenance])
