"""Session helpers.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset, so cluster-provided values always win.
"""

from __future__ import annotations

import os
import sys
import tempfile
import threading
import time
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every shoplens job relies on.  AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "shoplens") -> SparkSession:
    """Local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    parts = shuffle_partitions or (int(cores) * 2 if str(cores).isdigit() else 8)
    builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = builder.config("spark.driver.memory", os.environ.get("SHOPLENS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset (local tests)
    do we create a fresh scratch folder of our own.
    """
    ship_package(spark)
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
        return path
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, whatever their folder.

    A zip of the package goes through Spark's own file distribution, once per
    application.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "shoplens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("shoplens", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# Shuffle files of a write are of no use after it; Spark would keep them until the driver's garbage collection.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING: dict[str, list] = {}
_WRITING_LOCK = threading.Lock()


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """What is run in here removes its shuffle files when it ends, in any number of threads."""
    app = spark.sparkContext.applicationId
    with _WRITING_LOCK:
        state = _WRITING.setdefault(app, [0, None])
        if not state[0]:
            state[1] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        state[0] += 1
    try:
        yield
    finally:
        with _WRITING_LOCK:
            state[0] -= 1
            if not state[0]:
                spark.conf.set(_CLEANUP, state[1])


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Tables that :func:`materialize` writes in here are removed at its end: only for what
    ends in a written table of its own (:func:`kept`), which needs none of them any more."""
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def kept(build, tag: str, codec: str | None = None):
    """The written table of what ``build()`` gives, without those that it was built from."""
    with scratch_tables(SparkSession.active()):
        df = build()
        token = _SCRATCH.set(None)
        try:
            df = materialize(df, tag, codec=codec)
        finally:
            _SCRATCH.reset(token)
    return df


def materialize(df, tag: str = "stage", partition_by: str | None = None, codec: str | None = None):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the files, not from the
    whole plan), computes the input once, and keeps column pruning and filter
    pushdown on the re-read.  Never uses a machine-local folder on a cluster.
    ``partition_by`` names a column with a folder for each of its (few) values; ``codec``
    the compression, that of the session if not given.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/shoplens/{tag}-{uuid.uuid4().hex}"
    t0 = time.perf_counter()
    writer = df.write.mode("overwrite")
    writer = writer.option("compression", codec) if codec else writer
    if _SCRATCH.get() is not None:
        _SCRATCH.get().append(path)
    with _shuffles_removed(spark):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    if os.environ.get("SHOPLENS_TRACE"):
        print(f"[materialize] {tag}: start {t0:.2f} took {time.perf_counter() - t0:.2f}s",
              file=sys.stderr, flush=True)
    return spark.read.parquet(path)


_T0 = time.perf_counter()


def trace(msg: str) -> None:
    """Progress line on stderr when SHOPLENS_TRACE is set."""
    if os.environ.get("SHOPLENS_TRACE"):
        print(f"[{time.perf_counter() - _T0:8.2f}s] {msg}", file=sys.stderr, flush=True)
