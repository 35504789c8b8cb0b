"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(app: str = "roomtrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    ``master`` is left to spark-submit when it is None.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Readings carry local wall-clock times without a zone; UTC keeps their order."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder named in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may fall
    back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="roomtrace-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hands this package to the Python workers of all executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).parent
    # A file of the driver, which Spark copies to every executor.
    archive = Path(tempfile.mkdtemp(prefix="roomtrace-code-")) / "roomtrace-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State of any size lies on the executors' disks; operators with timers need this store.

    Streams that are started later use it; one that has begun keeps the store it began with.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
