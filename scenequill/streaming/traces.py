"""An append-only trace as a stream: optional, as the batch form is the one with a counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

EVENT = "trace_id long, seq long, kind string, content string"


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(EVENT).json(path)


def append_trace(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return events.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
