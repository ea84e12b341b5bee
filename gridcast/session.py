"""Session helpers: UTC clock, AQE, checkpoint folder taken from the cluster."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "gridcast", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):  # local mode: the driver JVM is the only executor
            b = b.config("spark.driver.memory", "8g")
    conf = dict(_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """All instants are compared in UTC; wall time is always derived explicitly.

    Also sends the package to the executors, so that Python workers can import it.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors once per Spark context (``addPyFile``)."""
    sc = spark.sparkContext
    if getattr(sc, "_gridcast_shipped", False):
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="gridcast-ship-")) / "gridcast.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f"{here.name}/{f.relative_to(here)}")
    sc.addPyFile(str(target))
    sc._gridcast_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there). Only when it is unset *and* the master is local (tests, laptop)
    do we pick our own scratch folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = sc.getCheckpointDir()
    if d is None:
        d = tempfile.mkdtemp(prefix="gridcast-ckpt-", dir=os.environ.get("GRIDCAST_SCRATCH", "/tmp"))
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint (never local): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A new place in the shared checkpoint folder; what is written there goes when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path
