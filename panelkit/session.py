"""Session helpers: one place for the Spark settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every panelkit job wants; sizes for shuffles are left to AQE.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "panelkit", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the session the platform hands you."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only local/test sessions without the setting get a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
        current = sc._jsc.sc().getCheckpointDir()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", None)
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not reachable from other executors
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="panelkit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


# Intermediates persisted by operators (value-count tables, small join sides).  They
# must outlive the lazy DataFrame an operator returns, so they are released
# explicitly once the caller's actions are done.
_INTERMEDIATES: dict[int, list] = {}


def track(df):
    """Persist ``df`` (memory, spilling to disk) and remember it for :func:`release_intermediates`."""
    from pyspark import StorageLevel
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _INTERMEDIATES.setdefault(id(df.sparkSession), []).append(df)
    return df


_STORED: dict[int, list[str]] = {}


def stored(df, name: str):
    """Write ``df`` as Parquet below the checkpoint folder and read it back; :func:`release_intermediates` removes the files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.setdefault(id(spark), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_intermediates(spark: SparkSession) -> int:
    """Unpersist every intermediate tracked for this session and remove its stored ones; returns how many were released."""
    frames = _INTERMEDIATES.pop(id(spark), [])
    for df in frames:
        df.unpersist(blocking=False)
    paths = _STORED.pop(id(spark), [])
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(frames) + len(paths)
