"""Reproducible hash-ordered samples and queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions.scalars import u_of


def with_u(df: DataFrame, slug: str, salt: str) -> DataFrame:
    return df.withColumn("u", u_of(F.col(slug), salt))


def bottom_k(df: DataFrame, slug: str, salt: str, k: int) -> DataFrame:
    """The ``k`` rows of least u, the slug breaking ties: a sample that any smaller k is a part of. Spark takes it without a full sort."""
    return with_u(df, slug, salt).orderBy("u", slug).limit(k)


def queue(df: DataFrame, slug: str, salt: str) -> DataFrame:
    """``df`` with u and queue_pos, its place in u order from 1.

    The rows are ranked within ranges of u and the ranges' counts added up, so no task holds more than one range.
    """
    ranged = with_u(df, slug, salt).withColumn("_range", F.floor(F.col("u") * 1024).cast("int"))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # at most 1024 rows
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy("u", slug))
    return ranged.join(F.broadcast(before), "_range").withColumn("queue_pos", (F.col("_before") + rank).cast("bigint")).drop("_range", "_before")


def repeated_names(df: DataFrame, name: str) -> DataFrame:
    """(name_key, n): names that are one but for their case."""
    return df.groupBy(F.lower(name).alias("name_key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 and name_key is not null")
