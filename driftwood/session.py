"""Session helpers: a local session for tests/bench, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "driftwood",
                  extra: dict | None = None) -> SparkSession:
    """A local[N] session with the settings the operators assume (UTC, AQE on, no UI)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster (spark.checkpoint.dir).

    Only a local master without one (unit tests, a laptop) gets a folder made here; a
    cluster has to name a shared one.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):  # executors on other machines would not see the folder
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="driftwood-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for staged tables."""
    return f"{checkpoint_root(spark)}/driftwood/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (pandas UDFs, keyed state).

    The programmatic form of ``--py-files``: once per application, the package is
    zipped into the shared work folder and added with ``addPyFile``.  When the work
    folder is not a local path (a cluster file system), the package is expected to
    be deployed with the job (``--py-files``) and nothing is done here.
    """
    sc = spark.sparkContext
    if getattr(sc, "_driftwood_shipped", False):
        return
    root = checkpoint_root(spark)
    if root.startswith("file:") or root.startswith("/"):
        pkg = os.path.dirname(os.path.abspath(__file__))
        dest = local_fs_path(f"{root}/driftwood/pyfiles-{uuid.uuid4().hex[:12]}")
        os.makedirs(dest, exist_ok=True)
        zpath = os.path.join(dest, "driftwood.zip")
        with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
            for base, dirs, files in os.walk(pkg):
                dirs[:] = [d for d in dirs if d != "__pycache__"]
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(base, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        sc.addPyFile(zpath)
    sc._driftwood_shipped = True


def local_fs_path(path: str) -> str:
    """Strip a file: scheme (for tests that look at files directly)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["local_session", "checkpoint_root", "work_path", "ship_package", "local_fs_path", "DEFAULT_CONF"]
