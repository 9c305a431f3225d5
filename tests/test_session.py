"""Session helpers: the shared checkpoint folder is read, never replaced."""

from nimbusframe.session import ensure_checkpoint_dir, scale_conf, scratch_path


def test_checkpoint_dir_is_kept(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
    assert scratch_path(spark, "x").startswith(first.rstrip("/"))


def test_scale_conf_bounds():
    small = scale_conf(1 << 20, 8)
    big = scale_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # at least 3 x cores
    assert int(big["spark.sql.shuffle.partitions"]) == 204_800  # not capped
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == big["spark.sql.shuffle.partitions"]


def test_scratch_must_be_shared_off_local_mode(spark, monkeypatch):
    import pytest

    from nimbusframe import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_broadcast_hint_needs_proven_bytes(spark):
    from nimbusframe.operators.joins import bounded_broadcast

    df = spark.range(3)
    hinted = lambda n: "ResolvedHint" in bounded_broadcast(df, n)._jdf.queryExecution().analyzed().toString()
    assert hinted(1000) and not hinted(None) and not hinted(10**9)


def test_partitions_are_not_capped():
    from nimbusframe.session import scale_conf

    assert int(scale_conf(100 << 40, 8000)["spark.sql.shuffle.partitions"]) == (100 << 40) // (512 << 20)
