"""Where intermediate tables go."""

import pytest

from eavspark import session


class Conf:
    def __init__(self, value=None):
        self.value = value

    def get(self, key, default=None):
        return self.value if self.value is not None else default


class Cluster:
    """As much of a session as is asked."""

    def __init__(self, master, folder=None, file_system="file:///"):
        self.conf, self.master, self._default = Conf(folder), master, Conf(file_system)
        self.sparkContext = self._jsc = self

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, folder):
        self.own = folder

    def hadoopConfiguration(self):
        return self._default


def test_the_named_folder_is_taken_on_the_default_file_system():
    assert session.shared_dir(Cluster("yarn", "/shared/x/")) == "/shared/x"
    assert session.shared_dir(Cluster("yarn", "/shared/x", "hdfs://name:8020/")) == "hdfs://name:8020/shared/x"
    assert session.shared_dir(Cluster("yarn", "s3a://bucket/x", "hdfs://name:8020")) == "s3a://bucket/x"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_must_name_a_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster(master))


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_one_machine_makes_its_own(master):
    cluster = Cluster(master)
    assert session.shared_dir(cluster) == cluster.own


def test_python_tasks_get_small_batches(spark):
    """Long rows do not meet by the thousand in one batch; a session's own setting stands."""

    def sizes(batches):
        for b in batches:
            yield b.from_pydict({"n": [b.nbytes]}, schema=None)

    try:
        session.small_batches(spark)
        long = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) as t")
        assert max(r.n for r in long.mapInArrow(sizes, "n long").collect()) <= 2 * session.BATCH
        spark.conf.set(session.BATCH_KEY, 1 << 20)
        session.small_batches(spark)
        assert spark.conf.get(session.BATCH_KEY) == str(1 << 20)
    finally:
        spark.conf.unset(session.BATCH_KEY)
