import pytest

from tidemark import session


def test_partitions_follow_the_data():
    mb = 1024 * 1024
    assert session.shuffle_partitions_for(10 * mb, 8) == 8
    assert session.shuffle_partitions_for(129 * mb * 1000, 8) == 1008
    assert session.shuffle_partitions_for(100 * mb**2, 2000) == 819_200


def test_sizing_sets_only_the_start(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session.size_shuffles(spark, 10 * 1024**3)
    try:
        assert spark.conf.get(key) == "80"
        df = spark.range(1000).groupBy("id").count()
        assert df.count() == 1000
    finally:
        spark.conf.unset(key)


def test_scratch_paths_are_in_the_shared_folder(spark):
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert one != two and one.startswith(session.shared_folder(spark))


class Cluster:
    """A session on a cluster without a shared folder."""

    master = "yarn"

    @property
    def sparkContext(self):
        return self

    @property
    def conf(self):
        return self

    def get(self, key, default=None):
        return default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        session.shared_folder(Cluster())


def test_settings_reach_a_foreign_session(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    session.apply_settings(other)
    assert other.conf.get("spark.sql.session.timeZone") == "UTC"
    assert other.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
