"""SparkSession helpers: engine defaults and the shared staging folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. ANSI keeps strict casts strict; UTC pins the
# meaning of load timestamps; AQE re-plans joins/partition counts at runtime
# and splits skewed shuffle partitions.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable checkpoint files once their data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, input_bytes: int) -> dict[str, str]:
    """Starting sizes for a large cluster, to pass as ``extra_conf``.

    Shuffles start with enough partitions for ~200 MB each (at least 3 per
    core) and AQE coalesces what turns out small; scans split files into
    256 MB pieces; broadcasts stay at the default 10 MB threshold, so only
    sides that AQE measures small are broadcast.
    """
    partitions = max(3 * total_cores, input_bytes // (200 * 1024 * 1024))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def get_session(
    master: str | None = None,
    app_name: str = "innkeep",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces small ones); in tests pass ``local[*]`` and a small count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a local-mode session
    (tests, a laptop) with nothing set gets a fresh local folder: on a
    cluster a machine-local folder is invisible to other executors, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: staged tables and checkpoints need a folder "
                "shared by all executors (e.g. on the cluster's distributed file system)"
            )
        configured = tempfile.mkdtemp(prefix="innkeep-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "staging", f"{name}-{uuid.uuid4().hex}")


def remove_staged(spark: SparkSession, path: str) -> bool:
    """Delete a staged folder below the checkpoint folder (recursive).

    Only paths under the session's staging folder are removed; anything else
    is refused, so a wrong argument cannot delete a published table.
    """
    root = os.path.join(checkpoint_dir(spark), "staging")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    qualified = fs.makeQualified(target).toString()
    staging = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(root)).toString()
    if not qualified.startswith(staging.rstrip("/") + "/"):
        raise ValueError(f"not a staged path: {path}")
    return bool(fs.delete(target, True))

