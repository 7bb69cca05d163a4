from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidewell import build_session  # noqa: E402
from tidewell.operators.bronze import bronze_parse  # noqa: E402
from tidewell.schemas import BRONZE  # noqa: E402
from tidewell.sources.tables import Lake  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"file://{tmp_path}/lake")


def record(**changes) -> str:
    """The JSON text of a valid event with some fields changed; a field set to ... is left out."""
    event = {
        "user_id": "u_1",
        "event_type": "view",
        "product_id": "p_1",
        "category": "book",
        "price": 100,
        "event_time": "2024-01-01T10:00:00Z",
        "device": "ios",
    }
    event.update(changes)
    return json.dumps({key: value for key, value in event.items() if value is not ...})


def topic_of(spark, texts, at="2024-01-01 10:00:30"):
    """Texts, or (text, topic time) pairs, as topic rows with rising offsets."""
    pairs = [text if isinstance(text, tuple) else (text, at) for text in texts]
    rows = [("t", 0, offset, time, text) for offset, (text, time) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp string, value string")
    return df.withColumns({"timestamp": F.col("timestamp").cast("timestamp"), "value": F.col("value").cast("binary")})


def bronze_of(spark, texts, at="2024-01-01 10:00:30"):
    return bronze_parse(topic_of(spark, texts, at))


def ingest(lake, texts, snapshot_id, at="2024-01-01 10:00:30"):
    rows = bronze_of(lake.spark, texts, at)
    lake.write_snapshot(rows.withColumn("snapshot_id", F.lit(snapshot_id)), BRONZE)
    lake.commit(BRONZE, snapshot_id, "append")


def text_of(df, *columns):
    """Sorted rows with every value as text, for plain comparison."""
    df = df.select(*[F.col(name).cast("string") for name in (columns or df.columns)])
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple(value or "" for value in row))
