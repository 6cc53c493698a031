from blotter.session import cluster_conf, ensure_checkpoint_dir


def test_cluster_conf_sizes_partitions_from_input():
    c = cluster_conf(100 * 2 ** 40)                      # 100 TB
    assert c["spark.sql.shuffle.partitions"] == str(100 * 2 ** 40 // (128 << 20))
    assert c["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == c["spark.sql.shuffle.partitions"]
    assert cluster_conf(10 ** 6)["spark.sql.shuffle.partitions"] == "200"    # floor for small inputs


def test_checkpoint_dir_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() is not None
    assert ensure_checkpoint_dir(spark) == d                # stable, never replaced once set
