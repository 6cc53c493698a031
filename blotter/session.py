"""SparkSession construction and cluster-facing settings.

Settings are chosen for a large cluster and stay correct on ``local[N]``:
UTC session time (hour/month must not depend on where the driver runs),
AQE with partition coalescing and skew-join splitting, and the UI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every blotter session gets. Shuffle partitions is only a start
# value: AQE coalesces small partitions and splits skewed ones at runtime.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # reliable checkpoints (content keys, summary cube) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 128 << 20,
                 min_partitions: int = 200) -> dict[str, str]:
    """Shuffle sizing for a cluster run over ``input_bytes`` of input.

    Start with about one shuffle partition per 128 MB of input so a stage
    over the whole table never has partitions too large for executor memory;
    AQE then coalesces small ones (and splits skewed ones) at runtime.
    Pass the result as ``get_spark(extra=...)``.
    """
    n = max(min_partitions, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def get_spark(master: str | None = None, app_name: str = "blotter",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the blotter defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to an existing session.

    A value the session's owner set explicitly (partition sizes tuned to a
    cluster, say) is left alone; only unset settings get blotter's default.
    """
    try:
        explicit = spark.sparkContext.getConf()
    except Exception:  # Spark Connect: nothing to compare with
        explicit = None
    for k, v in DEFAULT_CONF.items():
        if not k.startswith("spark.sql.") or k.startswith("spark.sql.execution.arrow"):
            continue
        if explicit is not None and k != "spark.sql.session.timeZone" and explicit.contains(k):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a session built elsewhere
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, from ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is. Only
    when it is unset *and* the master is local (tests, laptops) is a scratch
    folder made here; a cluster without the setting is an error rather than
    a silent machine-local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the server's setting applies
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="blotter-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf: the SparkContext setting below is what counts
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/blotter-{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path
