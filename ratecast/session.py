"""Session helpers: conf defaults, shared checkpoint folder, partition sizing."""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the state store the stateful forecaster needs after a streaming aggregation
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(app: str = "ratecast", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is set only when the caller passes one; else spark-submit's stands.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: folders made where ``spark.checkpoint.dir`` is unset, by application (the setting of a running session cannot be changed)
_MADE: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    Read from ``spark.checkpoint.dir`` as the cluster configures it; only when it is
    unset in local mode a fresh private folder is created; on a cluster that is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = _MADE.get(sc.applicationId) or _MADE.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="ratecast-ckpt-"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder: the data
    is computed once, so later branches that read it see identical rows (needed after a
    sampled range partitioning, whose bounds are not reproducible run to run), and a
    lost executor does not force the upstream shuffle to be redone."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
