"""Session construction and the shared scratch folder.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir``; it is only set here when the session has none
(local runs and tests), never overridden.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces/splits
# partitions at runtime, the skew-join rule splits hot keys, and the
# session zone is pinned so time expressions do not depend on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = "local[*]",
    shuffle_partitions: int = 8,
    app: str = "marquee",
    conf: dict | None = None,
) -> SparkSession:
    """A session with the package defaults (see ``DEFAULT_CONF``), a
    scratch folder and the package shipped to the executors. ``master=None``
    keeps the master chosen by spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:      # None: keep the master given by spark-submit
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    ship_package(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; created locally only
    when the session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="marquee-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """The path of a fresh, unique sub-folder of the shared scratch root;
    whoever writes there first creates it."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


_shipped: set[str] = set()
_ship_lock = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on every executor's Python workers
    (the pandas kernels reference its module-level helpers): zip it once per
    application and ``addPyFile`` the archive, which Spark serves to the
    executors and puts on their ``sys.path``."""
    sc = spark.sparkContext
    with _ship_lock:
        if sc.applicationId in _shipped:
            return
        submitted = spark.conf.get("spark.submit.pyFiles", "") or ""
        if "marquee" in submitted:        # already shipped with --py-files
            _shipped.add(sc.applicationId)
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg)
        # on the driver's own disk: Spark serves the archive to the executors
        folder = tempfile.mkdtemp(prefix="marquee-pyfiles-")
        archive = os.path.join(folder, "marquee.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for dirpath, _dirs, files in os.walk(pkg):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(dirpath, name)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)
