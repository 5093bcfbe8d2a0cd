"""The footers of many token files, read in one job, and their drifts from the contract."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.contracts import CONTRACT, as_rows
from strataloom.runtime import spread

# What the footers' types are called in the contract.
_ARROW = {"string": "string", "large_string": "string", "int64": "bigint", "int32": "int", "double": "double", "bool": "boolean"}


def _footer_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def kind(t) -> str:
        return f"array<{kind(t.value_type)}>" if pa.types.is_list(t) or pa.types.is_large_list(t) else _ARROW.get(str(t), str(t))

    for pdf in batches:
        out = []
        for path in pdf["path"]:
            try:
                system, plain = fs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path)}")
                out += [(path, i, f.name, kind(f.type), None) for i, f in enumerate(pq.read_schema(plain, filesystem=system), 1)]
            except Exception as e:  # whatever a broken footer raises, it is set aside and reported
                out.append((path, None, None, None, f"{type(e).__name__}: {e}"[:200]))
        yield pd.DataFrame(out, columns=["path", "position", "name", "type", "error"]).astype({"position": "Int64"})


def footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, position, name, type, error): the columns of every file, their footers read in one job; an unreadable file is one row with its error."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return spread(listed).mapInPandas(_footer_batches, "path string, position bigint, name string, type string, error string")


def drift_rows(columns: DataFrame, contract: T.StructType = CONTRACT) -> DataFrame:
    """(path, kind, column, detail): every drift of ``columns`` (path, position, name, type) from a contract, a full outer join by name within each path.

    'order' is reported once for a path, at its first column out of place, if nothing else drifted.
    """
    spark = columns.sparkSession
    want = F.broadcast(spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(as_rows(contract), 1)], "_at long, _name string, _type string"))  # a schema
    paths = columns.select("path").distinct()
    expected = F.explode(F.array(*[F.struct(F.lit(n).alias("_name"), F.lit(t).alias("_type")) for n, t in as_rows(contract)])).alias("_w")
    missing = paths.select("path", expected).select("path", "_w.*").join(columns.select("path", F.col("name").alias("_name")), ["path", "_name"], "left_anti").select("path", F.lit("missing").alias("kind"), F.col("_name").alias("column"), F.col("_type").alias("detail"))
    both = columns.join(want, F.col("name") == F.col("_name"), "left")
    strange = both.where("_name is null").select("path", F.lit("unexpected").alias("kind"), F.col("name").alias("column"), F.col("type").alias("detail"))
    retyped = both.where("_type <> type").select("path", F.lit("type").alias("kind"), F.col("name").alias("column"), F.concat("_type", F.lit(" expected, "), "type", F.lit(" found")).alias("detail"))
    drifted = missing.union(strange).union(retyped)
    moved = both.where("_at <> position").join(drifted.select("path").distinct(), "path", "left_anti").groupBy("path").agg(F.min_by("name", "position").alias("column"), F.min("position").alias("_p"))
    return drifted.union(moved.select("path", F.lit("order").alias("kind"), "column", F.concat(F.lit("position "), F.col("_p").cast("string"))))


def sorted_out(columns: DataFrame, contract: T.StructType = CONTRACT) -> DataFrame:
    """(path, verdict, n_drifts, error) of every file of ``footers``: 'usable', 'drifted' or 'unreadable'."""
    good = columns.where("error is null")
    n = drift_rows(good, contract).groupBy("path").agg(F.count(F.lit(1)).alias("n_drifts"))
    each = columns.groupBy("path").agg(F.first("error", True).alias("error")).join(n, "path", "left").na.fill(0, ["n_drifts"])
    verdict = F.when(F.col("error").isNotNull(), "unreadable").when(F.col("n_drifts") > 0, "drifted").otherwise("usable")
    return each.select("path", verdict.alias("verdict"), "n_drifts", "error")
