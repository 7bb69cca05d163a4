"""Quality job: metrics of the newest batch, and the alerts they give rise to."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.operators.quality import data_quality_metrics, quality_alerts
from tidewell.schemas import METRICS, QUALITY
from tidewell.sources.tables import Lake


def run_quality(lake: Lake) -> DataFrame:
    """Append the metrics of the newest batch and return its alerts."""
    metrics = lake.stage(data_quality_metrics(lake.read(QUALITY)), "metrics")
    lake.append(metrics.withColumn("created_at", F.current_timestamp()), METRICS)
    return quality_alerts(metrics)
