"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Settings the operators rely on. Time columns are compared as UTC instants;
#: AQE splits skewed joins and rebalanced writes and coalesces small partitions.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    # listing tasks in proportion to the cluster, instead of one per partition folder
    listing = max(32, 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listing))
    return spark


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Set one runtime option for the length of a ``with`` block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where it is set.

    A local session without it gets a fresh temporary folder; a cluster session
    without it is an error, because a machine-local folder would be lost with
    its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _store(df: DataFrame, path: str) -> DataFrame:
    # a bare NULL has no type a file could hold
    bare = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
    df = df.withColumns(bare) if bare else df
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Folders written by ``stage`` and not yet removed, by application.
_stages: dict[str, list[str]] = {}


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a query that feeds several branches of a plan (a merge reads its source
    for the update, the key match and the insert), or that must not change
    between them. The files outlive the executors that wrote them. They are removed by
    the end of the ``staging`` block they were written in, else when the program ends.
    """
    path = scratch_path(df.sparkSession, label)
    _stages.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return _store(df, path)


@contextlib.contextmanager
def staging(spark: SparkSession):
    """Remove what ``stage`` wrote in this block once it ends well: for jobs that end in a write."""
    folders = _stages.setdefault(spark.sparkContext.applicationId, [])
    before = len(folders)
    yield
    for path in folders[before:]:
        _delete(spark, path)
    del folders[before:]


@atexit.register
def _clean_up() -> None:
    """Remove stored intermediate results of this program, where its session still runs."""
    spark = SparkSession.getActiveSession()
    with contextlib.suppress(Exception):  # the session may be gone
        for path in _stages.get(spark.sparkContext.applicationId, ()) if spark else ():
            _delete(spark, path)
    for folder in _local_dirs.values():
        shutil.rmtree(folder, ignore_errors=True)


@contextlib.contextmanager
def staged(df: DataFrame, label: str = "stage"):
    """``df`` stored for the length of a ``with`` block.

    The files go when the block ends well; after a failure they stay for a second try.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    yield _store(df, path)
    _delete(spark, path)
