"""Session helpers: cluster sizing profile, session id."""

from hirebook.session import CLUSTER_CONF, cluster_conf_for, ensure_checkpoint_dir, session_conf, session_id


def test_cluster_profile_applies_sql_settings(spark):
    keys = [k for k in CLUSTER_CONF if k.startswith("spark.sql.")]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        cluster_conf_for(spark)
        assert all(spark.conf.get(k) == CLUSTER_CONF[k] for k in keys)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_session_id_is_stable(spark):
    assert session_id(spark) == session_id(spark) and session_id(spark)


def test_the_launcher_keeps_its_master_and_partitions(monkeypatch):
    import pyspark
    given = set()
    monkeypatch.setattr(pyspark, "SparkConf", lambda: type("Conf", (), {"contains": lambda self, k: k in given})())
    local, cluster = session_conf("local[4]", 12), session_conf(None, 12)
    assert local["spark.sql.shuffle.partitions"] == "12"
    assert cluster["spark.sql.shuffle.partitions"] == CLUSTER_CONF["spark.sql.shuffle.partitions"]
    given.add("spark.sql.shuffle.partitions")
    rest = session_conf(None, 12)
    assert "spark.sql.shuffle.partitions" not in rest and "spark.sql.files.maxPartitionBytes" in rest
    assert session_conf(None, extra={"spark.sql.shuffle.partitions": "5"})["spark.sql.shuffle.partitions"] == "5"


def test_no_private_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})()

    import pytest
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_what_reports_share_is_released(spark, book):
    from hirebook.operators import rental as R
    from hirebook.session import release

    release()
    shared = R.shared_summary(book.relocation, "1996-12-31", "1997-12-31")
    rows = shared.count()
    assert shared.is_cached and release() == 1 and not shared.is_cached and release() == 0
    assert shared.count() == rows


def test_report_queries_do_without_the_training_data_packages(monkeypatch):
    """A missing package of the subpackage leaves out its queries only."""
    import builtins
    import sys

    import __spark_entry__ as E

    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name.split(".")[0] in ("ahocorasick", "xxhash"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, *args, **kwargs)

    for name in [n for n in sys.modules if n.startswith(("hirebook.llm", "corpus_pipeline", "ahocorasick", "xxhash"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", without)
    from hirebook.plans.catalog import QUERIES
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert not any(n.startswith("op") for n in E.queries())
