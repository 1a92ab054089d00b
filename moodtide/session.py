"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Cluster defaults. AQE picks the final partition counts, splits skewed join
# partitions and sizes the files of REBALANCE-d writes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python call site of every Column doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Where a local session keeps its fallback; core settings cannot be changed later.
LOCAL_ROOT = "moodtide.local.root"


def build_session(app: str = "moodtide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where it is set.

    Only a local session may fall back to a temporary folder of its own, which is
    removed when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_ROOT, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="moodtide-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set(LOCAL_ROOT, root)
    return root


# Set while a run has intermediate tables of its own (``run_scratch``).
RUN = "moodtide.scratch.run"
_leaving: set[str] = set()


def _hadoop(spark: SparkSession, folder: str):
    """File system and path of a folder; none where the session has no JVM of its own."""
    if not hasattr(spark, "_jvm"):
        return None, None
    handle = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def _folder(spark: SparkSession) -> str:
    """This application's intermediate tables; they go when its JVM ends, if it is this process's."""
    folder = f"{shared_root(spark)}/moodtide/{spark.conf.get('spark.app.id', 'app')}"
    if folder not in _leaving:
        system, handle = _hadoop(spark, folder)
        if system:
            system.mkdirs(handle)
            system.deleteOnExit(handle)
        _leaving.add(folder)
    return folder


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside the block are removed at its end, for sessions that go on.

    What a query returns reads such tables, so it has to be written or fetched inside too.
    """
    before, run = spark.conf.get(RUN, ""), f"run-{uuid.uuid4().hex}"
    folder = f"{_folder(spark)}/{run}"
    spark.conf.set(RUN, run)
    try:
        yield folder
    finally:
        spark.conf.set(RUN, before)
        system, handle = _hadoop(spark, folder)
        if system:
            system.delete(handle, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root; never reused, so reruns cannot clash."""
    run = spark.conf.get(RUN, "")
    return "/".join([_folder(spark), *([run] if run else []), f"{name}-{uuid.uuid4().hex}"])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts lineage.

    Unlike cached blocks the written table survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
