import pytest
from pyspark.sql import functions as F

from strataloom import runtime


class _Conf:
    def get(self, key, default=None):
        return default


class _Cluster:
    """What shared_dir reads of a session on a cluster without a shared folder."""

    conf = _Conf()

    class sparkContext:  # noqa: N801
        master = "spark://head:7077"

        class _jsc:  # noqa: N801
            @staticmethod
            def sc():
                return _Cluster.sparkContext

        @staticmethod
        def getCheckpointDir():
            return _Cluster.sparkContext

        @staticmethod
        def isDefined():
            return False


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(_Cluster())


@pytest.mark.parametrize("master, one", [("local", True), ("local[8]", True), ("local[*]", True), ("local-cluster[3,2,1024]", False), ("yarn", False)])
def test_only_one_process_counts_as_one_machine(master, one):
    assert runtime.one_machine(master) is one


def test_spread_grows_with_the_input(spark, monkeypatch):
    written = runtime.materialise(spark.range(1000), "spread-test")
    cores = spark.sparkContext.defaultParallelism
    assert runtime.spread(written).rdd.getNumPartitions() == 3 * cores
    assert runtime.spread(spark.createDataFrame([(1,)], "id int")).rdd.getNumPartitions() == 3 * cores
    monkeypatch.setattr(runtime, "SPREAD_BYTES", 50)
    assert runtime.spread(written).rdd.getNumPartitions() == -(-runtime.input_bytes(written) // 50) > 3 * cores


def test_pairs_of_a_hot_key_are_whole(spark, monkeypatch):
    monkeypatch.setattr(runtime, "PIECE", 1)  # pieces of 20
    members = spark.range(90).select(F.lit("hot").alias("key"), "id").union(spark.createDataFrame([("cold", 200), ("cold", 201), ("cold", 201), ("alone", 7), (None, 8), (None, 9)], "key string, id bigint"))
    got = runtime.pairs_within(members, "key", "id").collect()
    assert len(got) == len(set(got)) == 90 * 89 // 2 + 1
    assert all(r["a"] < r["b"] for r in got)
