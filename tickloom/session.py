"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_folders: dict[str, str] = {}
_scope = threading.local()


def build_session(app_name: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.streaming.minBatchesToRetain", "5")
        .config(STATE_STORE, ROCKS_DB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local master may go without it: there one process holds everything, so a temporary
    folder is as good. On a cluster (``local-cluster`` has executors of its own, too) a missing
    setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tickloom-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Used where a frame feeds several branches: it cuts the lineage, survives lost executors,
    and the scan keeps column pruning, push-down and true size statistics. The files stay as long
    as frames may read them; ``temporary_stages`` ends that.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    paths = getattr(_scope, "paths", None)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Delete what this thread stages inside the block when it ends. For work that is finished
    inside it, such as one streaming batch."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        paths, _scope.paths = _scope.paths, outer
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
