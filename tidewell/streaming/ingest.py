"""Streaming ingest: the event topic appended to bronze, one snapshot per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.bronze import bronze_parse
from tidewell.schemas import BRONZE
from tidewell.sources.tables import Lake


class BronzeSink:
    """Writes micro-batches exactly once.

    A batch fills its own snapshot partitions, then its commit enters the log. A
    re-delivered batch either is in the log and is skipped, or overwrites what
    its failed attempt left under the same snapshot id.
    """

    def __init__(self, lake: Lake, checkpoint: str):
        self.lake = lake
        self.checkpoint = checkpoint.rstrip("/")
        self.source_id: str | None = None

    def _resume(self) -> None:
        """Read the log once per start; the query id is new for every new checkpoint."""
        spark = self.lake.spark
        text = spark.read.text(f"{self.checkpoint}/metadata")
        self.source_id = text.select(F.get_json_object("value", "$.id")).first()[0]
        commits = self.lake.commits(BRONZE)
        done = commits.filter(F.col("source_id") == self.source_id).agg(F.max("batch_id")).first()[0]
        self.last_batch = -1 if done is None else done
        self.next_snapshot = self.lake.next_snapshot(BRONZE)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.source_id is None:
            self._resume()
        if batch_id <= self.last_batch:
            return
        rows = batch.withColumn("snapshot_id", F.lit(self.next_snapshot))
        self.lake.write_snapshot(rows, BRONZE)
        self.lake.commit(BRONZE, self.next_snapshot, "append", self.source_id, batch_id)
        self.last_batch, self.next_snapshot = batch_id, self.next_snapshot + 1


def start_bronze(topic: DataFrame, lake: Lake, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the ingest; every minute unless another trigger is given.

    Stateless and without a shuffle: each task writes what it read.
    """
    return (
        bronze_parse(topic)
        .writeStream.foreachBatch(BronzeSink(lake, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
