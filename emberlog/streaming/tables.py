"""Incremental tables: landing streams into bronze, and the four streaming silver tables."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from emberlog.operators.rows import dedup_ordered
from emberlog.plans import silver
from emberlog.quality.expectations import METRICS, hold, streamed_rows
from emberlog.session import stored
from emberlog.sources import files
from emberlog.sources.landing import FOLDERS, file_versions, landing_schema, read_landing, read_versions

# State lies on the executors' disks, with its changes in the checkpoint, not on their heaps.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
VERSION = "path STRING, modified_at TIMESTAMP"
FILES_PER_READ = 10_000


@contextlib.contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in the disk store; a query takes its settings when it starts."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    with state_on_disk(stream.sparkSession):
        return (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start(path))


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there now, append it to a table, and stop. The checkpoint remembers the rest.

    A full refresh is a run with a new checkpoint and a new path.
    """
    query = start_available(stream, path, checkpoint)
    query.awaitTermination()
    return query


def ingest_bronze(spark: SparkSession, landing: str, out: str, folders: tuple[str, ...] = FOLDERS) -> DataFrame:
    """Append the new files of each landing folder to its bronze table, all folders side by side.

    Returns what the rules of the tables found in the new rows, as the streams' progress reports it.
    """
    started = [start_available(hold(read_landing(spark, landing, f), f"bronze_{f}", "warn"), f"{out}/{f}", f"{out}/_checkpoints/{f}") for f in folders]
    for query in started:
        query.awaitTermination()
    return spark.createDataFrame([row for query in started for row in streamed_rows(query)], METRICS)


def read_bronze(spark: SparkSession, out: str, folder: str) -> DataFrame:
    return spark.read.schema(landing_schema(folder).add("_file_path", "string")).parquet(f"{out}/{folder}")


def bronze_stream(spark: SparkSession, out: str, folder: str) -> DataFrame:
    """A bronze table as a stream."""
    schema = landing_schema(folder).add("_file_path", "string")
    return spark.readStream.schema(schema).parquet(f"{out}/{folder}")


KEYS = {"reports": ("code",), "fights": ("report_code", "fight_id"), "attendance": ("report_code", "player_name"), "actors": ("report_code", "actor_id")}


def read_silver(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A streamed silver table with the newest version of each key, as a batch over all landings gives it."""
    return silver.once(spark.read.parquet(path), KEYS[table])


def stream_reports(spark: SparkSession, bronze: str) -> DataFrame:
    return silver.guild_reports(bronze_stream(spark, bronze, "guild_reports"))


def stream_fights(spark: SparkSession, bronze: str) -> DataFrame:
    """Pulls without report context: a report that lands later would leave it null for good, so
    the context is joined in batch when the table is read (``with_report_context``)."""
    return silver.once(silver.exploded_fights(bronze_stream(spark, bronze, "report_fights")), ["report_code", "fight_id"])


def with_report_context(fights: DataFrame, reports: DataFrame) -> DataFrame:
    return fights.join(silver.report_context(reports), "report_code", "left")


def stream_actors(spark: SparkSession, bronze: str) -> DataFrame:
    return silver.actor_roster(bronze_stream(spark, bronze, "actor_roster"))


# --- a dimension that may land late --------------------------------------------------------

class Settled:
    """A table of streamed rows joined to a dimension, in which rows wait until their dimension row has landed.

    Each step takes the new rows and those still waiting, joins them once, and writes one folder: rows that
    found their dimension row, and rows that wait on. A row is placed as soon as its dimension row is there,
    however late that is. A step that is repeated writes the same folder again.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, empty: DataFrame, context: Callable[[], DataFrame]):
        self.spark, self.path, self.key, self.empty, self.context = spark, path, key, empty, context

    def _steps(self) -> list[str]:
        """Complete steps in order."""
        return [n for n in files.names(self.spark, self.path) if n.startswith("step=") and files.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]

    def _read(self, step: str, placed: bool) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/{step}")
        return rows.filter(F.col("_placed").cast("boolean") == placed).drop("_placed")

    def _waiting(self, before: str) -> DataFrame:
        earlier = [s for s in self._steps() if s < before]
        return self._read(earlier[-1], False).select(*self.empty.columns) if earlier else self.empty

    def take(self, new: DataFrame, step: str) -> None:
        name = f"step={step}"
        rows = new.select(*self.empty.columns).unionByName(self._waiting(name))
        found = rows.join(self.context().withColumn("_placed", F.lit(True)), self.key, "left").withColumn("_placed", F.coalesce("_placed", F.lit(False)))
        found.write.mode("overwrite").partitionBy("_placed").parquet(f"{self.path}/{name}")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Take what has landed, then try the waiting rows once more: their context may have come alone."""
        with state_on_disk(self.spark):
            query = (stream.writeStream.foreachBatch(lambda batch, epoch: self.take(batch, f"{epoch:012d}-000000"))
                     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        steps = self._steps()
        if steps:
            epoch, number = steps[-1].removeprefix("step=").split("-")
            self.take(self.empty, f"{epoch}-{int(number) + 1:06d}")

    def read(self) -> DataFrame:
        """All placed rows, and the rows that still wait, without context."""
        steps = self._steps()
        if not steps:
            return self.empty.join(self.context(), self.key, "left")
        placed = self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{s}" for s in steps]).filter(F.col("_placed").cast("boolean")).drop("_placed", "step")
        return placed.unionByName(self._read(steps[-1], False))


def settled_attendance(spark: SparkSession, bronze: str, path: str, reports: Callable[[], DataFrame]) -> Settled:
    """Attendance with the context of its report; ``reports`` is called anew for each step."""
    empty = silver.attendance_rows(spark.createDataFrame([], landing_schema("raid_attendance")))
    return Settled(spark, path, "report_code", empty, lambda: silver.attendance_context(reports()))


def stream_attendance(spark: SparkSession, bronze: str) -> DataFrame:
    return silver.attendance_rows(bronze_stream(spark, bronze, "raid_attendance"))


# --- files rewritten in place --------------------------------------------------------------

def ingest_rewritten(spark: SparkSession, landing: str, folder: str, out: str, ledger: str) -> int:
    """Append the rows of new and overwritten files to a bronze table; how many file versions were read.

    The stock file source keys on the path and skips a rewritten file. Here the listing is compared with a
    ledger of versions (path, modification time) before any file is opened, and only unknown versions are
    read, ``FILES_PER_READ`` at a time. Rows are written before their versions; a run lost in between reads
    those files again, and the silver level keeps the newest row per key.
    """
    spark.createDataFrame([], VERSION).write.mode("append").parquet(ledger)
    known = spark.read.schema(VERSION).parquet(ledger)
    new = stored(file_versions(spark, landing, folder).join(known, ["path", "modified_at"], "left_anti"))
    count = 0
    for versions in batched(new.orderBy("path").toLocalIterator(), FILES_PER_READ):
        read_versions(spark, folder, [v["path"] for v in versions]).write.mode("append").parquet(f"{out}/{folder}")
        spark.createDataFrame(list(versions), VERSION).coalesce(1).write.mode("append").parquet(ledger)
        count += len(versions)
    return count


def newest_rows(bronze: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Of rewritten files, the newest landing of each key, by its stamp and then the time of the file."""
    return dedup_ordered(bronze, keys, ("_ingested_at", "_modified_at"))
