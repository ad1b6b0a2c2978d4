"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, ANSI arithmetic (division by
# zero raises, so helpers guard with nullif), adaptive execution for runtime
# coalescing and skew-join splitting. The skew split is forced even where it
# costs a later exchange: aggregates that reuse a join's partitioning would
# otherwise keep a hot key's whole partition in one task.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

TASK_SIZE_KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Shuffled bytes (compressed) that adaptive execution puts into one task, where the session names no size.
TASK_SIZE = "8m"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "mercato", extra: dict | None = None) -> SparkSession:
    """A session with the settings every job relies on.

    Master and partition count stay the cluster's own unless the caller passes them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_task_size(spark: SparkSession) -> None:
    """Bound the shuffled bytes of a task in a session that leaves them to Spark.

    Rows of ids shrink to a few bytes in a shuffle and grow to hundreds in the sorts and hash tables of the
    task that reads them, so Spark's own 64 MB unpack to gigabytes. A size the session was given stays.
    """
    if spark.conf.get(TASK_SIZE_KEY, None) is None:
        spark.conf.set(TASK_SIZE_KEY, TASK_SIZE)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``. Where nothing is set, a local session (as in
    tests), whose tasks all see the same disk, uses a folder beside its warehouse; any other raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written intermediate table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/mercato/{name}-{uuid.uuid4().hex}"
