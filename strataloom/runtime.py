"""Session, table and lineage helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "strataloom", cores: int | str = "*") -> SparkSession:
    """A local session with the settings the tests and the bench use; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_machine(master: str) -> bool:
    """Whether a master runs everything in one process, so that a folder of this machine is shared by all its tasks."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or the context's checkpoint folder.

    Where neither is set, a session in one process (tests) gets a temporary folder. On a cluster that would be a folder of each
    machine for itself, so a RuntimeError is raised.
    """
    got = spark.conf.get("spark.checkpoint.dir", None)
    if not got:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        got = current.get() if current.isDefined() else None
    if not got:
        if not one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        got = tempfile.mkdtemp(prefix="strataloom-checkpoint-")
        spark.sparkContext.setCheckpointDir(got)
    return got.rstrip("/")


def clear_scratch(spark: SparkSession) -> bool:
    """Deletes every table that operators wrote into the shared folder in between; results that weren't written out are lost with them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/strataloom")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for a table an operator writes and reads again."""
    return f"{shared_dir(spark)}/strataloom/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in storage that outlives an executor, so a lost executor costs a re-read and no recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes, as stored, that one partition of ``spread`` is meant to hold.
SPREAD_BYTES = 64 << 20
#: What the planner puts for a size it doesn't know is at least this.
UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int:
    """The bytes that the scans under ``df`` read, by the planner's own statistics; a leaf of unknown size, as rows of the driver are, counts as none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < UNKNOWN_BYTES)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` in enough partitions for heavy work on each row, by the hash of ``by`` or in turn.

    Three for each core, so that few rows that are much work don't end up in one task (a stated number keeps adaptive execution
    from joining them again), and more where the input needs more to stay below SPREAD_BYTES each.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(3 * cores, -(-input_bytes(df) // SPREAD_BYTES)), *by)


#: Members of a piece of ``pieces``: two pieces meet in one task.
PIECE = 200


def pieces(members: DataFrame, key: str, member: str, size: int = PIECE) -> DataFrame:
    """(the columns of ``members``, i, j, right): every two pieces i <= j of a key's members; ``right``: of piece j > i.

    A key of up to ``size`` members is one piece; of a larger one every piece meets every other, each two in a group of their own,
    so that no pair is left out and no task holds more than two pieces. Keys of one member fall away.
    """
    sizes = members.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key", F.ceil(F.col("_n") / size).cast("int").alias("_k"))
    cut = members.join(sizes, F.col(key) == F.col("_key")).withColumn("_p", F.pmod(F.xxhash64(member), F.col("_k")).cast("int"))
    met = cut.withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return met.select(*members.columns, F.least("_p", "_q").alias("i"), F.greatest("_p", "_q").alias("j"), (F.col("_p") > F.col("_q")).alias("right"))


def pairs_within(members: DataFrame, key: str, member: str) -> DataFrame:
    """(a, b) with a < b: the distinct pairs of members of a key; hot keys are paired piece by piece."""
    cut = pieces(members.select(key, member).distinct(), key, member, 20 * PIECE)
    left = cut.where((F.col("i") == F.col("j")) | ~F.col("right")).select(key, "i", "j", F.col(member).alias("_a"))
    right = cut.where((F.col("i") == F.col("j")) | F.col("right")).select(key, "i", "j", F.col(member).alias("_b"))
    both = left.join(right, [key, "i", "j"]).where("_a <> _b")
    return both.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
