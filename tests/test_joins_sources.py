"""Size-checked broadcast and the shared folder."""

import pytest

from hourglass.operators.joins import bounded_broadcast
from hourglass.session import local_checkpoint_dir


def _is_broadcast_join(df):
    return "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_bounded_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only explicit hints broadcast
    try:
        fact = spark.range(10000).withColumnRenamed("id", "k")
        small = spark.range(50).withColumnRenamed("id", "k")
        assert _is_broadcast_join(fact.join(bounded_broadcast(small, max_rows=100), "k"))
        assert not _is_broadcast_join(fact.join(bounded_broadcast(small, max_rows=10), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("master,ok", [("local", True), ("local[4]", True), ("local[*]", True), ("yarn", False),
                                       ("local-cluster[2,1,1024]", False), ("spark://host:7077", False)])
def test_only_local_masters_get_a_folder_of_their_own(master, ok):
    if ok:
        assert local_checkpoint_dir(master)
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            local_checkpoint_dir(master)
