"""Spark session helpers.

On a cluster the session comes from the platform; these helpers only fill in
what is unset (shuffle partitions for local runs, a checkpoint folder for tests).
"""
from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "keepwise") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, honouring ``spark.checkpoint.dir``.

    Only when the cluster names none (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="keepwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder next to the checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", name)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder: readers of a wide table get only the columns they name."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()      # fits run in several threads


def ship_package(spark: SparkSession) -> None:
    """Make ``keepwise`` importable in Python workers (pandas UDFs, mapInPandas).

    Zips the package once per SparkContext and registers it with ``addPyFile``
    so executors on any node receive it.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    with _SHIPPING:
        if key in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg_dir)
        out = os.path.join(tempfile.mkdtemp(prefix="keepwise-pkg-"), "keepwise.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
            for dirpath, _, files in os.walk(pkg_dir):
                if "__pycache__" in dirpath:
                    continue
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        zf.write(full, os.path.relpath(full, root))
        sc.addPyFile(out)
        _SHIPPED.add(key)
