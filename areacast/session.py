"""Session helpers: recommended settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are designed for. AQE re-plans joins from measured
# shuffle sizes (broadcast only when the runtime size is under the threshold),
# coalesces small shuffle partitions and splits skewed join partitions.
RECOMMENDED_CONF = {
    # The only broadcasts are the planner's own, bounded by these sizes
    # (estimated from file statistics, then measured at run time by AQE).
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.enabled": "true",
    # Once a join's build side is measured and every one of its partitions is
    # under this size, AQE hashes it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int = 8, shuffle_partitions: int | None = None,
                  app_name: str = "areacast") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", "8g")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and derived files.

    Taken from the context's checkpoint dir, else from ``spark.checkpoint.dir``
    (and registered as the checkpoint dir). Only when neither is set and the
    master is local, as in tests, a scratch folder is created and registered;
    on a cluster an unset folder is an error, as a driver-local folder would
    not be shared with the executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local context (Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="areacast-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


