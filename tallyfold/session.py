"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Session-level settings the operators rely on. Cluster sizing (executors,
# memory, shuffle partitions) is left to the submitting job.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "tallyfold", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_session_conf(spark: SparkSession) -> SparkSession:
    """The one setting results depend on, for a session somebody else created."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Work folders of local-mode sessions without the setting, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    The setting names storage every executor can reach. Only a local-mode
    session may fall back to a temporary folder on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        # A core setting cannot be set in a running session, so the folder is remembered here.
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="tallyfold-")
        root = _LOCAL_ROOTS[application]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Statements that end within give their shuffle files back at once.

    Otherwise these stay until the driver collects its garbage, so a job of many
    writes needs disk for all of them together.
    """
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextlib.contextmanager
def many_small_files(spark: SparkSession) -> Iterator[None]:
    """A statement within keeps all cores writing, however few bytes it writes.

    A write into many folders takes as long as it has files, but adaptive execution
    merges tasks below a megabyte, until one task is left to write them all.
    """
    with _setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k"):
        yield


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """The frame's rows as a Parquet table in the shared work folder.

    Cuts the lineage: later steps read the table, however often they use it,
    and a lost executor costs no recomputation of what led to it.
    """
    path = shared_work_dir(df.sparkSession, purpose)
    with released_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever storage it lies; nothing happens if it is absent."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
