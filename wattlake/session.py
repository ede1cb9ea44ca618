"""Session construction and shared-folder lookup.

On a cluster the session is created by the submitter; these helpers only add
the SQL settings the jobs rely on and never point at machine-local folders.
"""

from __future__ import annotations

import datetime as _dt
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job expects.  AQE re-plans joins and shuffle partition counts
# from runtime sizes and splits skewed join partitions; the session time zone
# is pinned so date stamps do not depend on the executor's locale.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "wattlake",
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`DEFAULT_CONF` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


MB = 1 << 20


def scale_conf(largest_shuffle_bytes: int, partition_bytes: int = 128 * MB) -> dict[str, str]:
    """Shuffle and scan sizing for a run whose largest shuffle moves about
    ``largest_shuffle_bytes``.

    AQE can merge small post-shuffle partitions but cannot split large ones
    (apart from skewed join partitions), so the initial partition count is
    sized for the largest shuffle: ``bytes / partition_bytes``, about 800,000
    for a 100 TB shuffle at 128 MB.  Smaller shuffles of the same run are
    coalesced back to ``partition_bytes`` each.  Scan splits use the same
    target size.
    """
    n = max(1, -(-largest_shuffle_bytes // partition_bytes))
    if n >= 1 << 31:
        raise ValueError(f"{n} shuffle partitions of {partition_bytes} bytes: choose larger partitions")
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    try:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            return d
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Connect)
        pass
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - conf absent
        return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Return the session's checkpoint folder, setting ``fallback`` only when
    none is configured (local runs and tests)."""
    d = checkpoint_dir(spark)
    if not d:
        try:
            spark.sparkContext.setCheckpointDir(fallback)
            d = spark.sparkContext.getCheckpointDir() or fallback
        except Exception:  # noqa: BLE001 - no SparkContext: use the folder as is
            d = fallback
    return d


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors
    share. Only a session that runs within one machine may do without: it gets
    a temporary one."""
    d = checkpoint_dir(spark)
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="wattlake-")).rstrip("/")


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each statement that runs in here removes its shuffle files when it ends;
    otherwise they stay until the driver happens to collect its garbage. The
    setting is the session's: not for statements that run side by side."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate data of this application, below the
    shared folder; ``release_scratch`` removes it."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/wattlake-{spark.sparkContext.applicationId}"


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system holds it."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True))


def release_scratch(spark: SparkSession) -> None:
    """Remove all that this application put in the shared folder: the data
    folders, and the databases over them. Call it when results of earlier
    queries have been written or are no longer needed."""
    root = _scratch(spark)
    for db in spark.catalog.listDatabases():
        if db.locationUri and root.rsplit("/", 1)[-1] in db.locationUri:
            spark.sql(f"DROP DATABASE IF EXISTS {db.name} CASCADE")
    remove_path(spark, root)


def resolve_run_date(spark: SparkSession, run_date: _dt.date | None) -> _dt.date:
    """Fix the processing date once per run so every job of the run stamps the
    same partition, even across midnight."""
    if run_date is not None:
        return run_date
    return spark.sql("SELECT current_date() AS d").first()["d"]
