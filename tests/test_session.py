"""Shared folder handling: tables go under the session's checkpoint folder."""

from strata.session import checkpoint_dir, cut_lineage, fresh_table_path


def test_tables_live_under_the_session_checkpoint_folder(spark):
    base = checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = fresh_table_path(spark, "t"), fresh_table_path(spark, "t")
    assert a != b and a.startswith(base.rstrip("/") + "/tables/t-")


def test_cut_lineage_keeps_rows(spark):
    df = spark.range(100).selectExpr("id", "id * 2 as twice")
    cut = cut_lineage(spark, df)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, df.collect()))


def test_a_cluster_has_to_name_its_shared_folder():
    """Only a local master falls back to a scratch folder."""
    import pytest

    from strata.session import checkpoint_dir as folder

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://head:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        folder(Session())
