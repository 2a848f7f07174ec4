"""Session defaults and stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "emberlog", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults the products rely on; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A fresh path in the folder that the driver and all executors share.

    The folder is the one ``spark.checkpoint.dir`` names. Where it is unset a temporary one is made,
    which only a local master can share with its executors; any other master is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="emberlog-ckpt-"))
    return f"{context.getCheckpointDir()}/emberlog-{uuid.uuid4().hex}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Actions inside run with this setting; then the one before holds again."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def freed_shuffles(spark: SparkSession):
    """Writes inside delete their shuffle files as they end.

    Else the files stay until the driver happens to collect its garbage, so a job of many steps holds those of all.
    """
    return setting(spark, FREE_SHUFFLES, "true")


_collecting: list[list[DataFrame]] = []


@contextmanager
def collected() -> Iterator[list[DataFrame]]:
    """The tables that are stored inside, for those to be discarded that nothing reads afterwards."""
    _collecting.append([])
    try:
        yield _collecting[-1]
    finally:
        _collecting.pop()


def stored(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared checkpoint folder and read them back.

    It cuts the lineage, survives lost executors, and gives later plans true sizes, so Spark can
    pick broadcast joins where a side really is small.
    """
    path = work_folder(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_path = path
    if _collecting:
        _collecting[-1].append(found)
    return found


def discard(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing reads again; frames that are not stored tables are left."""
    for table in tables:
        if path := vars(table).pop("stored_path", None):
            at = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
