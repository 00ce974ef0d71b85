import os
from types import SimpleNamespace

import pytest

from touchtrail import configure, session


def fake(master, named=None, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: named), sparkContext=context)


def test_scratch_is_the_folder_the_cluster_names():
    assert session.scratch_dir(fake("spark://host:7077", named="hdfs://shared/ck/")) == "hdfs://shared/ck"
    assert session.scratch_dir(fake("yarn", checkpoint="hdfs://shared/set")) == "hdfs://shared/set"


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(fake("yarn"))


def test_one_machine_may_use_its_own_folder():
    assert session.scratch_dir(fake("local[2]")) == session.scratch_dir(fake("local[*]"))


def test_configure_leaves_cluster_sizing_alone(spark):
    assert configure(spark).conf.get("spark.sql.shuffle.partitions") == "4"


def left_over(spark):
    folder = session.scratch_dir(spark).removeprefix("file:")
    return {name for name in os.listdir(folder) if name.startswith("touchtrail-")}


def test_a_local_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(fake("local-cluster[2,1,1024]"))


def test_scratch_tables_do_not_stay(spark):
    before = left_over(spark)
    with session.scratch_table(spark.range(3)) as rows:
        assert rows.count() == 3
        assert len(left_over(spark) - before) == 1
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        with session.scratch_table(spark.range(3).selectExpr("id DIV 0 AS x")):
            pass
    assert left_over(spark) == before


def test_stored_rows_are_read_until_they_are_discarded(spark):
    before = left_over(spark)
    path = session.scratch_path(spark)
    assert session.stored(spark.range(5), path).count() == 5
    assert left_over(spark) - before
    session.discard(path)
    session.discard(path)
    assert left_over(spark) == before
