from unittest.mock import Mock

import pytest

from millrace.session import is_local, scoped_session, scratch_path
from millrace.sources.jdbc import Database
from millrace.sources.tables import Tables


def test_scoped_setting_holds_until_the_action_and_spares_the_caller(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    scoped = scoped_session(spark, {"spark.sql.shuffle.partitions": "3", "spark.sql.adaptive.enabled": "false"})
    counts = Tables(scoped, folder).orders.groupBy("o_custkey").count()
    assert counts.rdd.getNumPartitions() == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scoped_session_keeps_the_callers_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Manila")
    try:
        assert scoped_session(spark, {}).conf.get("spark.sql.session.timeZone") == "Asia/Manila"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_read_split_sets_the_number_of_partitions(spark, tmp_path):
    spark.range(200_000).repartition(1).write.parquet(str(tmp_path / "ids"))
    small = scoped_session(spark, {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "0"})
    read = lambda session: session.read.parquet(str(tmp_path / "ids")).rdd.getNumPartitions()
    assert read(small) > read(scoped_session(spark, {"spark.sql.files.maxPartitionBytes": "64m"}))


def test_views_of_queries_stay_out_of_the_callers_session(spark, folder):
    import __spark_entry__ as entry_module

    entry_module.queries()["src_temp_view"](spark, folder).collect()
    assert not spark.catalog.tableExists("part")


def test_scratch_is_new_each_time_and_below_the_checkpoint_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir", None) or "/tmp")


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_settings_is_refused(master):
    cluster = Mock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.master = master
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(cluster, "x")
    with pytest.raises(ValueError, match="jdbc.url"):
        Database.of(cluster)


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[2,3]"])
def test_local_masters(master):
    session = Mock()
    session.sparkContext.master = master
    assert is_local(session)


def test_unknown_table(spark, folder):
    with pytest.raises(AttributeError):
        Tables(spark, folder).nonesuch


def test_register_views(spark, folder):
    scoped = scoped_session(spark, {})
    Tables(scoped, folder).register_views("region", "nation")
    joined = scoped.sql("SELECT r_name, n_name FROM region JOIN nation ON r_regionkey = n_regionkey")
    assert joined.count() == 25


def test_parallelism_is_visible(spark, tables):
    assert spark.sparkContext.defaultParallelism == 4
    assert tables.region.rdd.getNumPartitions() >= 1
