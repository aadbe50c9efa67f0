"""Session and lineage rules: the cluster's settings win; materialized
tables live under spark.checkpoint.dir."""

from playstream import get_session
from playstream.plans.batch import materialize


def test_cluster_settings_kept(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        s = get_session()                      # as a job under spark-submit would
        assert s.conf.get("spark.sql.shuffle.partitions") == "13"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_materialize_under_checkpoint_dir(spark):
    ckpt = spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(10).withColumnRenamed("id", "v"))
    files = df.inputFiles()
    assert files and all(f.split(":", 1)[-1].lstrip("/").startswith(ckpt.lstrip("/")) for f in files)
    assert df.count() == 10
