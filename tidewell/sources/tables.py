"""Stored tables as partitioned parquet directories ``<root>/<namespace>/<table>``.

Jobs may run beside each other, but no two runs of one job. Every commit of a
maintained table adds a row to ``meta.snapshots`` (a folder per table, so tables
never share one); readers of incremental or replaced tables go by that log, so
files of a failed write are never seen. What a load adds to the other tables lies
in a directory named by the load, which a repeated attempt replaces.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidewell.functions.events import hour_index
from tidewell.operators.ranges import in_hours
from tidewell.operators.snapshots import latest_snapshot
from tidewell.schemas import BAD_EVENTS, BRONZE, EXPIRED_TABLES, LOAD, REPLAY_MARKS, SNAPSHOTS, TABLES, USER_PROFILE
from tidewell.session import settings

LOOKED_UP = 64  # directories that are looked up one by one; for more, the names in the table's folder are listed
NAMED_HOURS = 10_000  # hours that are read by the names of their directories
SMALL_TASKS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "4KB"}
# Rows of one run lie in a single hour of these tables, which is therefore cut into smaller tasks and files than Spark would.
SPLIT_TASKS = SMALL_TASKS | {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB"}
OF_ONE_HOUR = (BAD_EVENTS, REPLAY_MARKS)
WRITERS = 8


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as the cluster names it; a local one only where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return configured or os.path.join(tempfile.gettempdir(), "tidewell")


def new_root(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """A table without rows, which the optimizer knows to be empty: joins and unions with it vanish from the plan."""
    return spark.createDataFrame([], schema).limit(0)


class Lake:
    """The tables below one root directory."""

    logged = frozenset(EXPIRED_TABLES) | {USER_PROFILE}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def read(self, name: str) -> DataFrame:
        """The table's rows under its declared schema; no rows before the first write."""
        if name == USER_PROFILE:
            current = self.current_snapshot(name)
            return self.read_parts(name, [] if current is None else [current]).drop("snapshot_id")
        table = self.read_plain(name)
        return with_replay_marks(table, self.read(REPLAY_MARKS)) if name == BAD_EVENTS else table

    def read_plain(self, name: str) -> DataFrame:
        """The rows as they were written, without what is recorded of them elsewhere."""
        return self._stored(name).drop(LOAD)

    def _stored(self, name: str) -> DataFrame:
        schema, (folder, _, table) = TABLES[name].full_schema, self.path(name).rpartition("/")
        if not self._present(folder, {table}):
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def read_parts(self, name: str, values: list[int | None]) -> DataFrame:
        """The rows in the directories of some values of the first partition column; no other directory is listed."""
        table, root = TABLES[name], self.path(name)
        named = {f"{table.partitions[0]}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}" for value in values}
        paths = [f"{root}/{directory}" for directory in sorted(self._present(root, named))]
        if not paths:
            return no_rows(self.spark, table.full_schema)
        return self.spark.read.schema(table.full_schema).option("basePath", root).parquet(*paths)

    def _present(self, root: str, names: set[str]) -> set[str]:
        """Which of the named directories a folder holds."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        store = path(root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if len(names) <= LOOKED_UP:
            return {name for name in names if store.exists(path(f"{root}/{name}"))}
        if not store.exists(path(root)):
            return set()
        return names & {status.getPath().getName() for status in store.listStatus(path(root))}

    def _laid_out(self, df: DataFrame, name: str) -> DataFrame:
        """Declared columns and types, plus the derived hour bucket."""
        table = TABLES[name]
        if "p_hour" in table.partitions and table.time_column:
            df = df.withColumn("p_hour", hour_index(table.time_column))
        if LOAD in table.partitions and LOAD not in df.columns:
            df = df.withColumn(LOAD, F.lit(None))
        return df.select(*[F.col(field.name).cast(field.dataType) for field in table.full_schema])

    def _write(self, df: DataFrame, name: str, mode: str, spread: bool = True) -> None:
        """Write whole partitions in few, evenly sized files.

        REBALANCE lets AQE join small hours into one task and split a hot hour
        over several. A write's cost is also its number of files, so the tasks
        are kept as many as there are cores even when the bytes are few.
        """
        partitions = TABLES[name].partitions
        out = self._laid_out(df, name)
        if partitions and spread:
            out = out.hint("rebalance", *partitions)
        writer = out.write.mode(mode).partitionBy(*partitions)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
        with settings(self.spark, SPLIT_TASKS if name in OF_ONE_HOUR else SMALL_TASKS):
            writer.parquet(self.path(name))

    def append(self, df: DataFrame, name: str) -> None:
        self._not_bronze(name)
        self._write(df, name, "append")
        self._log(name, "append")

    def write_load(self, df: DataFrame, name: str, load_id: int) -> None:
        """All that one load adds to a table, in place of what an earlier attempt of the load left there.

        The rows lie in a directory of the load, which is overwritten whole. ``df`` must not read that directory.
        """
        inner = [column for column in TABLES[name].partitions if column != LOAD]
        out = self._laid_out(df.withColumn(LOAD, F.lit(load_id)), name).drop(LOAD)
        writer = (out.hint("rebalance", *inner) if inner else out).write.mode("overwrite").partitionBy(*inner)
        with settings(self.spark, SPLIT_TASKS if name in OF_ONE_HOUR else SMALL_TASKS):
            writer.option("partitionOverwriteMode", "static").parquet(f"{self.path(name)}/{LOAD}={load_id}")

    def outside_load(self, name: str, load_id: int) -> DataFrame:
        """The table without what a load added."""
        return self._stored(name).filter(~F.col(LOAD).eqNullSafe(F.lit(load_id))).drop(LOAD)

    def overwrite_partitions(self, df: DataFrame, name: str, spread: bool = True) -> None:
        """Replace exactly the partitions that occur in ``df``; the others stay.

        ``df`` must not read the table itself: stage it first.
        """
        if not TABLES[name].partitions:
            raise ValueError(f"{name} has no partitions, use replace()")
        self._not_bronze(name)
        self._write(df, name, "overwrite", spread)
        self._log(name, "overwrite")

    @staticmethod
    def _not_bronze(name: str) -> None:
        """Bronze snapshot ids belong to the streaming sink: a second source of ids would hide a batch from its readers."""
        if name == BRONZE:
            raise ValueError("only the streaming sink commits to bronze")

    def overwrite_many(self, tables: dict[str, DataFrame]) -> None:
        """Overwrite several tables side by side: while one commits on the driver, others use the executors."""
        with settings(self.spark, SMALL_TASKS):
            side_by_side(self.spark, self.overwrite_partitions, [(df, name) for name, df in tables.items()])

    def write_snapshot(self, df: DataFrame, name: str) -> None:
        """Fill the partitions of an uncommitted snapshot as the tasks hold the rows, without a shuffle."""
        self._write(df, name, "overwrite", spread=False)

    def add_version(self, df: DataFrame, name: str) -> None:
        """Rows of an uncommitted version of a table that is divided otherwise first, in few files per division."""
        self._write(df, name, "append")

    def replace(self, df: DataFrame, name: str) -> None:
        """Replace the whole table: write the next version beside the old one, then commit it."""
        version = self.next_snapshot(name)
        self.write_snapshot(df.withColumn("snapshot_id", F.lit(version)), name)
        self.commit(name, version, "replace")

    def stage(self, df: DataFrame, purpose: str, *partitions: str) -> DataFrame:
        """Compute ``df`` once and read it back: cuts lineage, survives lost executors."""
        path = f"{self.root}/staging/{purpose}-{uuid.uuid4().hex}"
        df.write.partitionBy(*partitions).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commits(self, name: str) -> DataFrame:
        """The table's commits in the log, which also holds marks of expiry."""
        return self.read(SNAPSHOTS).filter((F.col("table_name") == name) & (F.col("operation") != "expire"))

    def current_snapshot(self, name: str) -> int | None:
        """Newest committed snapshot; one value."""
        row = latest_snapshot(self.commits(name)).first()
        return row["snapshot_id"] if row else None

    def next_snapshot(self, name: str) -> int:
        newest = self.commits(name).agg(F.max("snapshot_id")).first()[0]
        return 0 if newest is None else newest + 1

    def commit(
        self, name: str, snapshot_id: int, operation: str, source_id: str | None = None, batch_id: int | None = None
    ) -> None:
        row = self.spark.range(1).select(
            F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
            F.current_timestamp().alias("committed_at"),
            F.lit(operation).alias("operation"),
            F.lit(source_id).cast("string").alias("source_id"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        row.write.mode("append").parquet(f"{self.path(SNAPSHOTS)}/table_name={name}")

    def _log(self, name: str, operation: str) -> None:
        if name in self.logged:
            self.commit(name, self.next_snapshot(name), operation)


def side_by_side(spark: SparkSession, job: Callable[..., None], calls: list[tuple]) -> None:
    """Call a job with each of the arguments, in threads of the session; the first failure is raised."""
    with ThreadPoolExecutor(WRITERS) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job), *arguments) for arguments in calls]
        for one in started:
            one.result()


def read_incremental(bronze: DataFrame, last: int | None, current: int) -> DataFrame:
    """Rows of the snapshots in (last, current]; the first run starts from the beginning.

    ``snapshot_id`` is a partition column, so only the new directories are read.
    """
    rows = bronze.filter(F.col("snapshot_id") <= current)
    return rows if last is None else rows.filter(F.col("snapshot_id") > last)


def read_committed(lake: Lake, name: str, last: int | None, current: int) -> DataFrame:
    """Rows of the snapshots in (last, current] that the log names, from their directories alone: older ones are not even listed."""
    ids = read_incremental(lake.commits(name), last, current).select("snapshot_id").distinct().collect()
    return lake.read_parts(name, [row.snapshot_id for row in ids])


def read_hours(lake: Lake, name: str, hours: DataFrame) -> DataFrame:
    """A table's rows in some hours (distinct ``p_hour``, NULL included), from the directories of those hours alone.

    Beyond ``NAMED_HOURS`` hours the driver does not see their names; the table is then read under few bounds and joined.
    """
    named = [row.p_hour for row in hours.limit(NAMED_HOURS + 1).collect()]
    return lake.read_parts(name, named) if len(named) <= NAMED_HOURS else in_hours(lake.read(name), hours)


def with_replay_marks(bad: DataFrame, marks: DataFrame) -> DataFrame:
    """Quarantine rows with the flags of the last replay that read them; rows quarantined after its reading stay open."""
    newest = F.max(F.struct("replayed_at", "read_until", "replay_batch_id")).alias("mark")
    last = marks.groupBy(F.col("event_hash").alias("marked_hash")).agg(newest)
    joined = bad.join(last, F.col("event_hash") == F.col("marked_hash"), "left")
    replayed = F.coalesce(F.col("quarantine_at") <= F.col("mark.read_until"), F.lit(False))
    flags = {
        "is_replayed": F.col("is_replayed") | replayed,
        "replayed_at": F.when(replayed, F.col("mark.replayed_at")).otherwise(F.col("replayed_at")),
        "replay_batch_id": F.when(replayed, F.col("mark.replay_batch_id")).otherwise(F.col("replay_batch_id")),
    }
    return joined.withColumns(flags).select(*bad.columns)


def state_row(spark: SparkSession, pipeline: str, snapshot_id: int) -> DataFrame:
    """The record that says how far a pipeline has read."""
    return spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(snapshot_id).cast("bigint").alias("last_snapshot_id"),
        F.current_timestamp().alias("updated_at"),
    )


def read_gold_partitions(spark: SparkSession, root: str, dataset: str, name: str) -> DataFrame:
    """A dataset laid out as ``<root>/<dataset>/dt=…/hour=…``, partition values as text columns."""
    return spark.read.schema(TABLES[name].full_schema).parquet(f"{root.rstrip('/')}/{dataset}")
