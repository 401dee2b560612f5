"""Sinks: partitioned landing zones, rejects, JDBC and streaming upserts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clinflow.operators.audit import reject_schema
from clinflow.sources import avro, database, store
from clinflow.sources.readers import positional

ZONE = ["landing_zone", "message_type", "transaction_date"]


def landing_zone(df: DataFrame, path: str, segments: bool = False, checkpoint: str | None = None) -> StreamingQuery | None:
    """Partitioned files under ``path``; a stream is written until its input is done."""
    parts = [*ZONE, "hl7_segment"] if segments else ZONE
    if df.isStreaming:
        query = df.writeStream.format("parquet").partitionBy(*parts).option("path", path).option("checkpointLocation", checkpoint)
        return query.trigger(availableNow=True).start()
    # rows of a partition meet in few tasks, a hot one is split by AQE: not one file for each task and partition
    df.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(path)
    return None


def avro_rejects(df: DataFrame, path: str, codec: str = "deflate") -> None:
    """Rejects as Avro container files of the nine-field schema, checked field by field. A field without a value is ''."""
    fields = json.loads(reject_schema())["fields"]
    if [(f["name"], f["type"]) for f in fields] != [(f.name, f.dataType.typeName()) for f in df.schema.fields]:
        raise ValueError(f"rejects need the columns {[f['name'] for f in fields]}, all strings")
    rows = df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])
    rows.write.format(avro.register(df.sparkSession)).options(avroSchema=reject_schema(), codec=codec).mode("append").save(path)


def jdbc_batch(df: DataFrame, url: str, name: str, batch: int = 1000, **options: str) -> None:
    """Append to a table in batches, all tasks at once, a transaction each; an error ends the job. ``database.load`` keeps refused rows back instead."""
    df.write.format("jdbc").options(url=url, dbtable=name, batchsize=str(batch), **options).mode("append").save()


def send_failed(spark: SparkSession, failed: str, connect: database.Connect, name: str, staging: str) -> int:
    """Send kept rows again (mended, or because the table takes them now); the folder holds what is refused again; how many these are."""
    again = f"{failed}-again"
    rows = spark.read.parquet(failed).drop("refusal")
    left = database.load(rows, connect, name, staging, again)
    spark.read.schema(spark.read.parquet(failed).schema).parquet(again).checkpoint().write.mode("overwrite").parquet(failed)
    spark.read.parquet(failed).limit(0).write.mode("overwrite").parquet(again)
    return left


def parquet_dynamic(df: DataFrame, path: str, parts: list[str]) -> None:
    """Only the partitions that ``df`` has are replaced."""
    rows = df.hint("rebalance", *parts)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*parts).parquet(path)


def replace_staging(spark: SparkSession, export: str, target: str, cols: list[str]) -> None:
    """A staging table becomes what a pipe-delimited export holds; what it held before goes."""
    positional(spark.read.text(export), cols).write.mode("overwrite").parquet(target)


def upsert_stream(stream: DataFrame, kept: store.Store, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Each batch goes over a keyed store, in the buckets that it touches; a batch that is run again changes nothing. One writer."""

    def put(batch: DataFrame, _: int) -> None:
        store.upsert(store.opened(batch.sparkSession, kept), batch, keys)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
