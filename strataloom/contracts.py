"""The 70-column token contract, schemas as data, and complete drift reports."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The contract's columns in contract order.
PROVENANCE = (
    "clone_url provenance_status source stratum fact contested label_date owner repo roster_name roster_lang language commits size_class size_kb stars "
    "pushed_at license owner_type archived fork history_cluster history_shared_with history_relation history_includes history_first history_created "
    "manifest_category file_mask"
).split()
TOKEN = "file_path token_index source_line source_col source_text token_type token_value is_structural".split()
COMMIT = (
    "cregit_commit_sha original_commit_sha author_name author_email author_date committer_name committer_email committer_date commit_summary personid "
    "person_name person_email person_domain repo_tag"
).split()
FOOTERS = (
    "footer_signed_off_by footer_co_authored_by footer_co_developed_by footer_reviewed_by footer_acked_by footer_tested_by footer_reported_by footer_suggested_by "
    "footer_based_on_patch_by footer_helped_by footer_mentored_by footer_assisted_by footer_thanks_to footer_personids footer_person_names"
).split()
FIRM = "firm_raw firm firm_source".split()
LONGS = {"token_index", "source_line", "source_col", "is_structural"}

COLUMNS = ["repo_name", *PROVENANCE, *TOKEN, *COMMIT, *FOOTERS, *FIRM]
UNATTRIBUTED = COLUMNS[: -len(FIRM)]


def column_type(name: str) -> T.DataType:
    return T.LongType() if name in LONGS else T.ArrayType(T.StringType()) if name in FOOTERS else T.StringType()


#: The contract as a Spark schema; every column is nullable. UNATTRIBUTED_CONTRACT is what a file has before attribution.
CONTRACT = T.StructType([T.StructField(c, column_type(c)) for c in COLUMNS])
UNATTRIBUTED_CONTRACT = T.StructType([T.StructField(c, column_type(c)) for c in UNATTRIBUTED])


class Drift(NamedTuple):
    """One difference from the contract. kind: missing, type, unexpected or order."""

    kind: str
    column: str
    detail: str


def as_rows(schema: T.StructType) -> list[tuple[str, str]]:
    """A schema as data: (name, type) in order."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def compare(actual: T.StructType, contract: T.StructType = CONTRACT) -> list[Drift]:
    """Every drift: the contract's missing and retyped columns in its order, then the unexpected ones in the file's; 'order' only if nothing else drifted.

    The two schemas are joined by name, as tables of (name, type, position). Names are compared exactly. Of a name that a file has
    twice the last type counts.
    """
    joined: dict[str, dict[str, tuple[int, str]]] = {}
    for side, schema in (("contract", contract), ("file", actual)):
        for position, (name, kind) in enumerate(as_rows(schema), 1):
            joined.setdefault(name, {})[side] = (position, kind)
    rows = []
    for name, sides in joined.items():
        match sides:
            case {"contract": (at, wanted), "file": (_, found)} if wanted != found:
                rows.append((0, at, Drift("type", name, f"{wanted} expected, {found} found")))
            case {"contract": (at, wanted)} if "file" not in sides:
                rows.append((0, at, Drift("missing", name, wanted)))
            case {"file": (at, found)} if "contract" not in sides:
                rows.append((1, at, Drift("unexpected", name, found)))
    if not rows:
        moved = [(s["file"][0], n) for n, s in joined.items() if s["file"][0] != s["contract"][0]]
        rows = [(0, 0, Drift("order", n, f"position {at}")) for at, n in sorted(moved)[:1]]
    return [drift for *_, drift in sorted(rows)]


def file_schema(spark: SparkSession, path: str) -> T.StructType:
    """A file's own schema. No schema is imposed: a reader told one would widen and fill silently."""
    return spark.read.parquet(path).schema


def drift_table(spark: SparkSession, drifts: list[Drift]) -> DataFrame:
    return spark.createDataFrame(drifts, "kind string, column string, detail string")


def emit(schema: T.StructType) -> str:
    """A schema as text that can be pasted as a contract."""
    return "\n".join(f'("{name}", "{kind}"),' for name, kind in as_rows(schema))
