"""Ledgers that arrive as files of JSON lines in a folder, followed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.operators.ledger import NO_ATTEMPT, PROJECT, STARTED
from strataloom.sources.files import LEDGER
from strataloom.sources.sinks import replace_table


def follow(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """The ledger rows of every file that appears in ``folder``. Files are put there whole: a growing file is no stream source."""
    return spark.readStream.schema(LEDGER).option("maxFilesPerTrigger", files_per_batch).json(folder)


def outcomes(rows: DataFrame) -> DataFrame:
    """(project, state, n): the running number of final rows by outcome; one state a project and outcome is kept."""
    final = rows.where((F.col("step") == PROJECT) & ~F.col("status").eqNullSafe(STARTED) & F.col("project").isNotNull())
    return final.where(~F.coalesce(F.col("state").isin(*NO_ATTEMPT), F.lit(False))).groupBy("project", "state").agg(F.count(F.lit(1)).alias("n"))


def catch_up(counts: DataFrame, path: str, checkpoint: str) -> None:
    """Takes in what has arrived since the last call and replaces the table at ``path`` by the new counts, written whole before they take its place."""

    def replace(batch: DataFrame, _: int) -> None:
        replace_table(batch, path)

    counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(replace).start().awaitTermination()
