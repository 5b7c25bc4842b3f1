"""Spark session defaults for lakeloom jobs.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that are still unset, so cluster-wide values (shuffle partitions,
checkpoint directory, broadcast threshold) always win.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every lakeloom job relies on. Values are applied only when the
# session does not already define them.
DEFAULTS = {
    # runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn sort-merge joins into broadcast joins when a side turns out small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # duplicate JSON keys keep the last value, as Python's json module does
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # vectors and texts are wide rows: keep Arrow batches moderate
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where the session leaves them unset and make the
    package importable in Python workers."""
    conf = spark.conf
    for key, value in DEFAULTS.items():
        if key == "spark.sql.variant.allowDuplicateKeys" or conf.get(key, None) is None:
            conf.set(key, value)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so
    ``mapInPandas`` functions that refer to it can be unpickled there
    (standard ``addPyFile`` code shipping; no data goes this way)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect
        sc = None
    key = id(sc) if sc is not None else id(spark)
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lakeloom-pkg-"), "lakeloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    if sc is not None:
        sc.addPyFile(path)
    else:
        spark.addArtifacts(path, pyfile=True)
    _SHIPPED.add(key)


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "lakeloom") -> SparkSession:
    """Session for tests and the local benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (local tests) a scratch folder is created and registered.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = tempfile.mkdtemp(prefix="lakeloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        pass
    return path
