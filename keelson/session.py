"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every session gets unless the caller overrides them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not compile methods above this size; larger generated ones run faster split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Checkpoint files of tables that are no longer referenced are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, app_name: str = "keelson",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Only a local-mode session without one gets a fresh temporary folder;
    on a cluster a missing setting is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    if sc.master.startswith("local"):
        d = tempfile.mkdtemp(prefix="keelson-ckpt-")
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for checkpoints")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/keelson-" + name + "-" + uuid.uuid4().hex[:12]


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if a file or folder is there; a storage fault raises."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, by Spark's own file server;
    functions that run there then import it wherever the application was started."""
    sc = spark.sparkContext
    if getattr(sc, "_keelson_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="keelson-py-"), "keelson.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    sc._keelson_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = ["get_session", "checkpoint_dir", "scratch_path", "path_exists", "ship", "shuffle_partitions"]
