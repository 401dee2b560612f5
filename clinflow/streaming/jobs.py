"""Structured Streaming wrappers: the batch functions on streams, with checkpoints for recovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clinflow.operators import parse
from clinflow.operators.audit import batch_volume
from clinflow.operators.routing import parse_routing_key
from clinflow.plans.main_job import Config, main_job


def parsed_stream(records: DataFrame) -> DataFrame:
    """(key, value, topic) to metadata rows: stateless, as in a batch."""
    raw = records.select(F.col("key"), F.col("topic"), F.col("value").alias("raw"))
    return parse.reject_malformed(parse.meta_fast(raw))


def landing_stream(records: DataFrame, as_of: str) -> DataFrame:
    return parse_routing_key(records, as_of)


def volume_stream(events: DataFrame, interval: str, late: str, ts: str = "ts", topic: str = "topic") -> DataFrame:
    """Counts by window and topic; a window is final when the watermark has passed it."""
    return batch_volume(events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late), interval, ts, topic)


def run_until_done(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write a stream as parquet until its input is done (a bounded run that stops by itself)."""
    return stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def main_stream(raw: DataFrame, config: Config, path: str, checkpoint: str, as_of: Column) -> StreamingQuery:
    """The main job on each batch of a stream of messages until the input is done.

    A batch's outputs are folders of its number, written anew if the batch is run again, so none is there twice."""

    def put(batch: DataFrame, number: int) -> None:
        for name, rows in main_job(batch, config, f"{path}/staging/batch={number}", as_of).items():
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")

    return raw.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
