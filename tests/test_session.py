import pytest

from portolan.session import build_session, is_local, scale_conf, scratch_dir, scratch_path


def test_scale_conf_sizes_partitions_from_input():
    big = scale_conf(100 << 40)                                   # 100 TiB
    assert int(big["spark.sql.shuffle.partitions"]) * (256 << 20) == 100 << 40  # 256 MB a task, at any size
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)
    assert int(big["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) == 2 * (256 << 20)
    assert scale_conf(1 << 40)["spark.sql.shuffle.partitions"] == str((1 << 40) // (256 << 20))
    assert scale_conf(10 << 20)["spark.sql.shuffle.partitions"] == "200"  # floor for small inputs


def test_no_machine_local_scratch_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session())
    assert is_local("local[*]") and is_local("local") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")


def test_session_defaults_leave_launch_settings(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    assert build_session() is not None and spark.conf.get("spark.sql.session.timeZone") == before


def test_scratch_folder_is_stable_and_registered(spark):
    first = scratch_dir(spark)
    assert first == scratch_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "a", "/b/") == f"{first}/a/b"
