import pytest

from ordersentry import session
from ordersentry.session import ENGINE_CONF, checkpoint_dir, configure


def test_configure_sets_utc_and_engine_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == ENGINE_CONF["spark.sql.adaptive.enabled"]


def test_checkpoint_dir_uses_the_configured_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    path = checkpoint_dir(spark)
    assert path and (before is None or path == before)
    assert checkpoint_dir(spark) == path  # stable


def test_ansi_is_pinned(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    configure(spark)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


class FakeContext:
    def getCheckpointDir(self):
        return None


class FakeSession:
    """A session on a cluster without spark.checkpoint.dir."""
    sparkContext = FakeContext()

    class conf:
        @staticmethod
        def get(key, default=None):
            return "spark://host:7077" if key == "spark.master" else default


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(FakeSession())


def test_no_master_is_set_by_default(monkeypatch):
    seen = []

    class Builder:
        sparkContext = type("C", (), {"setLogLevel": lambda self, level: None})()

        def __getattr__(self, name):
            def call(*args, **kw):
                seen.append((name, args))
                return self
            return call

    monkeypatch.setattr(session, "SparkSession", type("S", (), {"builder": Builder()}))
    monkeypatch.setattr(session, "configure", lambda s: s)
    session.get_session()
    assert "master" not in [n for n, _ in seen]
    assert not any(a and a[0] == "spark.master" for _, a in seen)


def test_one_task_sorts_little_after_a_shuffle(spark):
    """Screening holds a task's rows in several sorts at once."""
    assert int(configure(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").removesuffix("b")) <= 16 << 20


def test_messages_are_cached_and_written_as_they_are(spark):
    """Shredding and column compression take longer than the rest of caching and writing an order."""
    configure(spark)
    assert spark.conf.get("spark.sql.variant.inferShreddingSchema") == "false"
    assert spark.conf.get("spark.sql.inMemoryColumnarStorage.compressed") == "false"
