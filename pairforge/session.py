"""Session construction and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names
(a shared file system).  Only a ``local`` master, whose one process reads and
writes everything, gets a folder below the system temp folder when that is
unset; any other master without the setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every pairforge job relies on.  AQE gives runtime broadcast of
# small shuffle stages (a *checked* size, with the shuffle join beyond it),
# skew-join splitting for hot keys and partition coalescing.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "pairforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.memory", os.environ.get("PAIRFORGE_DRIVER_MEMORY", "12g"))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- remote session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="pairforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "pairforge", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written below the shared scratch folder and read back: it is computed once
    (an eager ``checkpoint()`` computes it twice) and its lineage is cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application,
    so that they can import it wherever the session was started."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- remote session: the server owns its workers' path
        return
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="pairforge-pkg-"), "pairforge.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
