"""Session construction for tests and the benchmark, and the shared scratch folder."""

from __future__ import annotations

import hashlib
import io
import os
import re
import tempfile
import uuid
import zipfile
from urllib.parse import urlparse

from pyspark.sql import SparkSession

# Settings the jobs are designed for.  On a cluster these belong in the
# cluster's defaults; tests and the benchmark set them here.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # reliably checkpointed intermediate results are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "arenaflow", **extra) -> SparkSession:
    """Local session for tests and the benchmark (UI off, AQE on)."""
    b = SparkSession.builder.master(master).appName(app).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RECOMMENDED_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def may_use_own_folder(master: str) -> bool:
    """Whether driver and executors are one process, so that a local folder is shared by all."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, as a full URI.

    On a cluster the setting is read and never made up: a folder without a scheme is
    taken on the default file system, and an unset one is an error.  Only a
    ``local`` session (tests, the benchmark) gets a folder of its own.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not may_use_own_folder(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="arenaflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    fs, path = hadoop_path(spark, root)
    return fs.makeQualified(path).toString().rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of a URI or of a path on the default file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared checkpoint folder for intermediate files.

    All folders of an application lie in one, which Hadoop deletes when the
    application ends.
    """
    own = f"{ensure_checkpoint_dir(spark)}/arenaflow-scratch/{spark.sparkContext.applicationId}"
    path = f"{own}/{purpose}-{uuid.uuid4().hex}"
    fs, made = hadoop_path(spark, path)
    fs.mkdirs(made)
    fs.deleteOnExit(hadoop_path(spark, own)[1])
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> bool:
    """Makes ``arenaflow`` importable in the Python workers of a local or
    single-machine run (once per application); returns whether it shipped.

    Functions run by ``mapInPandas`` are pickled by reference to this package,
    so the executors must be able to import it.  On a cluster the package is
    submitted with ``--py-files``; when the shared folder is a distributed file
    system nothing is done here.  Otherwise the package sources are zipped into
    the shared scratch folder and distributed with ``addPyFile``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return True
    root = ensure_checkpoint_dir(spark)
    if urlparse(root).scheme not in ("", "file"):
        return False
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _dirs, files in sorted(os.walk(pkg)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    data = buf.getvalue()
    folder = urlparse(scratch_dir(spark, "pyfiles")).path
    out = os.path.join(folder, f"arenaflow-{hashlib.sha1(data).hexdigest()[:16]}.zip")
    with open(out, "wb") as fh:
        fh.write(data)
    try:
        sc.addPyFile(out)
    except Exception as exc:  # the same archive was registered earlier (module reloaded)
        if "already registered" not in str(exc):
            raise
    _SHIPPED.add(sc.applicationId)
    return True
