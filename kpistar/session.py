"""SparkSession construction and the shared folder for written tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session settings every plan in this package relies on.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where the split costs a further exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans over many materialised dimensions print long; cap the plan text.
    "spark.sql.maxPlanStringLength": "200000",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "kpistar", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the launcher supplies master and sizing."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    return spark


_LOCAL_DIRS: dict = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    The folder the cluster names in ``spark.checkpoint.dir``, or one already set on
    the SparkContext.  With neither, a cluster session raises: its executors share no
    local folder.  Only a ``local`` master (one process, as in tests) gets its own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = _local_folder(sc.master, sc.applicationId)
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def _local_folder(master: str, application: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="kpistar-ckpt-")
    return _LOCAL_DIRS[application]
