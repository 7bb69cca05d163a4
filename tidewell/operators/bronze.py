"""Raw layer: topic records to bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewell.schemas import BRONZE, TABLES

METADATA = ("topic", "partition", "offset", "timestamp")
# Payload fields that are not read as text. Larger prices than 32 bits hold are kept in raw_value only.
READ_AS = {"price": "int"}


def bronze_parse(topic: DataFrame) -> DataFrame:
    """The columns that bronze declares: topic metadata under ``kafka_``, the record's text, and its payload's fields."""
    text = F.col("value").cast("string")
    of_topic = {f"kafka_{name}": F.col(name) for name in METADATA} | {"raw_value": text}
    declared = TABLES[BRONZE].schema.fields
    payload = ", ".join(f"{f.name} {READ_AS.get(f.name, 'string')}" for f in declared if f.name not in of_topic)

    def value(field: T.StructField) -> Column:
        if field.name in of_topic:
            return of_topic[field.name]
        read = F.col(f"json.{field.name}")
        is_time = isinstance(field.dataType, T.TimestampType)
        return F.try_to_timestamp(read) if is_time else read.cast(field.dataType)

    parsed = topic.withColumn("json", F.from_json(text, payload))
    return parsed.select(*[value(field).alias(field.name) for field in declared])
