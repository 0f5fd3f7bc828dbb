"""Session settings and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cores: str = "8", memory: str = "8g", app: str = "daystrata") -> SparkSession:
    """A single-machine session for tests and the benchmark.  On a cluster use the given session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column expression dominates short queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent and the session is local is a temporary folder made.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    named = named or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="daystrata-")
    return _LOCAL_FOLDERS[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder name below :func:`shared_folder`."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def checkpointed(df):
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for functions that run there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "daystrata_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def put_texts(spark: SparkSession, folder: str, texts: dict[str, str]) -> None:
    """Write a few small files by name into a folder of any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, text in texts.items():
        out = files.create(path(f"{folder}/{name}"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
